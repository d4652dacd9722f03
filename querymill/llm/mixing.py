"""Mixing sources to target weights along a low-discrepancy schedule.

The mix is a sequence of slots, each a block of ``block_words`` words. Slot i takes
the point frac(i * golden ratio) of the unit interval; the sources share the interval
by their targets, so any run of slots holds each source close to its share. The
slots of a source, in order, take its blocks: its documents in shuffled order, end to
end, cut every ``block_words`` words. When the blocks are used up they start anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from querymill.llm.common import WORD
from querymill.session import materialize

# Fixed values of the mix: weights of the sources in order, and how often a source may
# be used up.
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3

BLOCK_WORDS = 32
SLOTS_IN_CHUNK = 8192  # slots ranked in one task
ROWS_IN_BUCKET = 2048  # documents of a source laid end to end in one task
CELLS = 4096  # of the unit interval, for the join of points with shares
STEP = 2654435761  # 2**32 divided by the golden ratio, an odd number


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """``source_size`` and ``target`` words of each source of ``sizes(source, size)``.

    Sources by code point, NULL last, weigh ``WEIGHTS`` in turn and share all words.
    A target stops at ``MAX_EPOCHS`` times its source's words; what is over goes to
    the others by weight. The windows run over one row per source.
    """
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    named = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("place", place)
        .withColumn("weight", F.get(weights, F.col("place") % len(WEIGHTS)))
        .withColumn("most", F.col("source_size") * MAX_EPOCHS)
    )
    # Full sources are first in this order; they all fill up below the common level.
    order = Window.orderBy(F.col("most") / F.col("weight"), "place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (
        F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0))
    ) / F.sum("weight").over(rest)
    return (
        named.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("level", level)
        .withColumn("full", F.col("most") <= F.col("level") * F.col("weight"))
        .withColumn("level", F.max(F.when(~F.col("full"), F.col("level"))).over(everything))
        .select(
            "source",
            "place",
            "source_size",
            F.when(F.col("full"), F.col("most").cast("double"))
            .otherwise(F.coalesce(F.col("level") * F.col("weight"), F.lit(0.0)))
            .alias("target"),
        )
    )


def schedule(goals: DataFrame, n_slots: int) -> DataFrame:
    """``slot, place, rank`` of the schedule: which source, and its how-many-th slot."""
    total = Window.partitionBy()
    upto = F.sum("target").over(Window.orderBy("place")) / F.sum("target").over(total)
    last = F.max(F.when(F.col("target") > 0, F.col("place"))).over(total)
    shares = (
        goals.withColumn("high", F.when(F.col("place") >= last, 1.0).otherwise(upto))
        .withColumn("low", F.lag("high", 1, 0.0).over(Window.orderBy("place")))
        .where("high > low")
        .select(
            "place",
            "low",
            "high",
            F.explode(
                F.sequence(
                    F.floor(F.col("low") * CELLS),
                    F.least(F.floor(F.col("high") * CELLS), F.lit(CELLS - 1)),
                )
            ).alias("cell"),
        )
    )
    turn = F.col("slot").bitwiseAND(F.lit(2**31 - 1)) * F.lit(STEP)
    point = (turn.bitwiseAND(F.lit(2**32 - 1)) + 0.5) / F.lit(float(2**32))
    slots = (
        goals.sparkSession.range(n_slots)
        .select(F.col("id").alias("slot"), point.alias("point"))
        .withColumn("cell", F.floor(F.col("point") * CELLS))
        .join(shares, "cell")
        .where("point >= low AND point < high")
        .select("slot", "place", F.floor(F.col("slot") / SLOTS_IN_CHUNK).alias("chunk"))
    )
    counts = slots.groupBy("place", "chunk").count()
    earlier = Window.partitionBy("place").orderBy("chunk").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = counts.select(
        "place", "chunk", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("offset")
    )
    within = F.row_number().over(Window.partitionBy("place", "chunk").orderBy("slot")) - 1
    return (
        slots.withColumn("within", within)
        .join(offsets, ["place", "chunk"])
        .select("slot", "place", (F.col("offset") + F.col("within")).alias("rank"))
    )


def _laid_out(rows: DataFrame, seed: int) -> DataFrame:
    """``start``: words of the same source before each document, in shuffled order.

    A source's documents fall into buckets by hash, so many that each is small;
    buckets are summed first, then documents within a bucket.
    """
    buckets = 1 << max(0, (rows.count() // ROWS_IN_BUCKET)).bit_length()
    shuffled = F.xxhash64("doc_id", "size", "copy", F.lit(seed))
    bits = buckets.bit_length() - 1
    bucket = F.shiftrightunsigned("order", 64 - bits) if bits else F.lit(0).cast("long")
    # Unsigned order of hashes is the order of buckets, too.
    placed = rows.withColumn("order", shuffled).withColumn("bucket", bucket)
    sums = placed.groupBy("place", "bucket").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("place").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = sums.select(
        "place", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset")
    )
    inside = (
        Window.partitionBy("place", "bucket")
        .orderBy("order", "doc_id", "size", "copy")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        placed.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(offsets, ["place", "bucket"])
        .withColumn("start", F.col("offset") + F.col("inside"))
        .drop("offset", "inside", "bucket", "order")
    )


def mix(sizes: DataFrame, block_words: int = BLOCK_WORDS, seed: int = 1) -> DataFrame:
    """What the mix takes of each document of ``sizes(doc_id, source, size)``.

    Returns doc_id, source, size, source_size, target, copy (which of several equal
    rows), ``taken`` words in all, and ``takes``: for each epoch that takes some, how
    many of the document's words, counted from its first. A NULL size counts as 0;
    documents without words take part with nothing. No document is taken more than
    ``MAX_EPOCHS`` times. The result depends on the rows only, not on their order or
    on partitions. A source's words end within a few blocks of its target.
    """
    alike = (
        sizes.select("doc_id", "source", F.coalesce("size", F.lit(0)).cast("long").alias("size"))
        .groupBy("doc_id", "source", "size")
        .count()
        .select(
            "doc_id", "source", "size", F.explode(F.sequence(F.lit(1), F.col("count"))).alias("copy")
        )
    )
    alike = materialize(alike, "sizes")
    goals = materialize(targets(alike), "targets")
    total = goals.agg(F.sum("source_size")).first()[0] or 0
    n_slots = -(-total // block_words)
    blocks_of = goals.select(
        "place", F.ceil(F.col("source_size") / block_words).alias("n_blocks")
    )
    slots = (
        schedule(goals, n_slots)
        .join(blocks_of, "place")
        .where(F.col("rank") < F.col("n_blocks") * MAX_EPOCHS)
        .select(
            "place",
            (F.col("rank") % F.col("n_blocks")).alias("block"),
            F.floor(F.col("rank") / F.col("n_blocks")).alias("epoch"),
        )
        .groupBy("place", "block")
        .agg(F.sort_array(F.collect_set("epoch")).alias("epochs"))
    )
    named = alike.join(
        goals.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))
    ).drop("_source")
    laid = materialize(_laid_out(named, seed), "laid")
    end = F.col("start") + F.col("size")
    parts = (
        laid.where("size > 0")
        .select(
            "doc_id",
            "place",
            "size",
            "copy",
            "start",
            F.explode(
                F.sequence(F.floor(F.col("start") / block_words), F.floor((end - 1) / block_words))
            ).alias("block"),
        )
        .withColumn(
            "words",
            F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words)
            - F.greatest("start", F.col("block") * block_words),
        )
    )
    keys = ["doc_id", "place", "size", "copy"]
    # A source's slots take its blocks in order, so a document loses its end, if any.
    taken = (
        parts.join(slots, ["place", "block"])
        .groupBy(*keys)
        .agg(
            *[
                F.sum(
                    F.when(F.array_contains("epochs", F.lit(e).cast("long")), F.col("words"))
                    .otherwise(0)
                ).alias(f"_e{e}")
                for e in range(MAX_EPOCHS)
            ]
        )
        .withColumns({f"_{k}": F.col(k) for k in keys})
        .drop(*keys)
    )
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    each = [F.coalesce(F.col(f"_e{e}"), F.lit(0)).cast("long") for e in range(MAX_EPOCHS)]
    return laid.join(taken, same, "left").select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        "copy",
        sum(each[1:], each[0]).alias("taken"),
        F.filter(F.array(*each), lambda n: n > 0).alias("takes"),
    )


def mixed_documents(docs: DataFrame, block_words: int = BLOCK_WORDS, seed: int = 1) -> DataFrame:
    """The mix itself: texts as ``docs`` has them, once for each epoch that takes some.

    ``docs`` needs doc_id, source and text. A document of which an epoch takes the first
    words only comes with its text up to the last of them; one that is not taken does not
    come at all, and so documents without words do not. ``n_chars``, if there, is set to
    the length of the text. Other columns stay as they are.
    """
    # A row lies in a struct of its own, whatever its columns are called.
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        "doc_id",
        "source",
        word_count(F.col("text")).alias("size"),
    )
    key = F.to_json(F.struct("doc_id", "source", "size")).alias("key")
    copies = Window.partitionBy("key").orderBy("copy", "takes")
    taken = (
        mix(rows.select("doc_id", "source", "size"), block_words, seed)
        .select(key, "copy", "takes")
        .select("key", F.row_number().over(copies).alias("number"), "takes")
    )
    equal = Window.partitionBy("key").orderBy("row.text")
    pieces = (
        rows.select("row", "size", key)
        .withColumn("number", F.row_number().over(equal))
        .join(taken, ["key", "number"])
        .select("row", "size", F.explode("takes").alias("take"))
    )
    text = F.col("row.text")
    cut = F.when(F.col("take") == F.col("size"), text).otherwise(first_words(text, F.col("take")))
    out = pieces.select("row", cut.alias("cut"))
    made = {"text": F.col("cut")}
    if "n_chars" in docs.columns:
        made["n_chars"] = F.length("cut").cast(docs.schema["n_chars"].dataType)
    return out.select([made.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of word n."""
    # Each element is a word with the white space before it.
    words = F.regexp_extract_all(text, F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0))
    return F.array_join(F.slice(words, F.lit(1), n.cast("int")), "")
