"""Preparation of a text corpus: filter, deduplicate, redact, mix, encode.

Each stage takes the documents that the one before it kept, written as Parquet and read
again, and returns documents; the last one returns encoded texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from querymill.llm import bpe, minhash, mixing, pii, quality
from querymill.llm.queries import vocabulary
from querymill.session import materialize

SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base and lie within their group's fences.

    A NULL text, an empty one and one of fewer than ten words fail the base and go. NULL in
    lang or source is a group like any other. Repeated rows are judged alike and all stay or
    go; other columns stay as they are. No rows give no rows.
    """
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, one with the smallest doc_id.

    Rows are compared, not ids: of rows with one doc_id those whose texts are near to
    each other are a group like any other, and those with another text stay. A row with
    a NULL doc_id takes part and comes after all others of its group. A text without
    words, NULL included, is near to nothing: all such rows stay, copies included.
    """
    # Stored with its numbers, so that a row has one number wherever it is read; inside a
    # struct of its own, whatever its columns are called.
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = materialize(
        docs.select(whole.alias("row"), F.monotonically_increasing_id().alias("number")), "rows"
    )
    texts = rows.select(F.col("number").alias("doc_id"), F.col("row.text").alias("text"))
    groups = minhash.near_duplicates(texts, SHINGLE_WORDS, SIMILAR_PERCENT)
    order = F.struct(
        F.col("row.doc_id").isNull(), "row.doc_id", F.xxhash64("row.text"), F.col("number")
    )
    members = groups.select(F.col("doc_id").alias("number"), "component_id")
    firsts = (
        rows.select("number", order.alias("order"))
        .join(members, "number")
        .groupBy("component_id")
        .agg(F.min("order")["number"].alias("number"))
    )
    kept = materialize(firsts.select("number"), "kept")
    return rows.join(kept, "number", "left_semi").select("row.*")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind.

    Every row stays, repeated ones too; a NULL or empty text stays as it is. ``n_chars``, if
    there, is set to the new length; other columns stay.
    """
    lengths = "n_chars" if "n_chars" in docs.columns else None
    return pii.redact(docs, pii.train(docs), lengths)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes, a row for each document and epoch.

    Rows without words are not taken. A NULL source is a source like any other; rows of
    one doc_id, source and size, NULLs included, are documents of their own. The text is cut
    where an epoch takes the first words only; other columns but ``n_chars`` stay.
    """
    return mixing.mixed_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, their number, and the text that they decode to.

    One row for each row, with its doc_id, lang and source; a NULL or empty text has no ids and
    decodes to an empty text.
    """
    keep = ["doc_id", "lang", "source"]
    rows = bpe.encode(docs, vocabulary(), keep, decoded=True)
    return rows.withColumn("n_tokens", bpe.n_tokens(F.col("ids")))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
    ("encoded", encoded),
]

# Neither the tagger nor the encoding can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
