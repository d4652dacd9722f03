"""Each operator over its whole table; ``ORACLE`` has the SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from querymill.llm import (
    bpe,
    embedding_dedup,
    html_text,
    minhash,
    mixing,
    passages,
    pii,
    quality,
    resampling,
    search,
    spelling,
    toxicity,
    url_rules,
)
from querymill.llm.common import table
from querymill.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]

TOKENIZER = "word_bpe_49k.json"


def vocabulary(name: str = TOKENIZER) -> str:
    """Content of a public tokenizer's file, read by the driver."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sizes = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    return mixing.mix(sizes).select("doc_id", "size", "source_size", "target", "taken")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    tested = docs.select("doc_id", "text", toxicity.held_out(F.col("doc_id")).alias("held_out"))
    return toxicity.score(tested, model, ["doc_id", "held_out"])


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    return quality.judge(docs).select("doc_id", *quality.BASE, "base_failed", "kept")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(docs, vocabulary(), ["doc_id"], digests=True)


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_text.extract(pages, html_text.train(pages), ["page_id", "url"])


def op8_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


def op9_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return resampling.resample(docs, table(spark, sf_dir, "labels"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find(docs, pii.train(docs), ["doc_id"])


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return search.best_documents(docs, table(spark, sf_dir, "benchmark"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


# The rules of the task.
URL_RULES = [
    url_rules.Rule("allow", "com", "/"),
    url_rules.Rule("block", "example.com", "/en/"),
    url_rules.Rule("allow", "www.example.com", "/en/"),
    url_rules.Rule("block", "net", "/es/"),
    url_rules.Rule("block", "net", "/fr/"),
]
# Where no rule fits: later pages of lists and mobile copies go, articles stay.
URL_GLOBS = [
    url_rules.Glob("allow", "*.org/**.html"),
    url_rules.Glob("block", "m.*.org/**"),
    url_rules.Glob("block", "**?page=**"),
]


def op13_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_rules.judge(pages, URL_RULES, URL_GLOBS, keep=["page_id"])


QUERIES = {
    query.__name__: query
    for query in (
        op1_mixing,
        op2_toxicity,
        op3_embedding_dedup,
        op4_quality_rules,
        op5_bpe,
        op6_minhash_dedup,
        op7_html_text,
        op8_passages,
        op9_resampling,
        op10_pii,
        op11_search,
        op12_spelling,
        op13_url_rules,
    )
}
