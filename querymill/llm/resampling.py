"""Quality by importance resampling: documents drawn as if from the target's texts.

Two bag-of-n-grams models over hashed words and word pairs: one of all documents, one
of documents labelled good. A document's log-weight is the sum over its n-grams of the
log-ratio of their probabilities. Adding Gumbel noise and keeping the largest keys
draws documents without replacement, in proportion to their weights.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from querymill.llm.common import WORDS
from querymill.session import materialize

BUCKETS = 1 << 14
SMOOTHING = 1.0
KNOWN_WORDS = 500_000
BINS = 4096
HELD_NGRAMS = 1 << 20
BITMAP_BITS = 1 << 24


class _Hasher:
    """Hashed words and pairs of neighbouring words; words are remembered up to a bound."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def ngrams(self, text: str) -> np.ndarray:
        words = WORDS.findall(text)
        known = self.known
        if len(known) > KNOWN_WORDS:
            known.clear()
        for w in [w for w in set(words) if w not in known]:
            known[w] = zlib.crc32(w.encode("utf-8", "surrogatepass"))
        one = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        two = one[:-1] * np.uint64(2654435761) + one[1:] * np.uint64(40503) + np.uint64(1)
        both = np.concatenate([one, two ^ (two >> np.uint64(29))])
        return (both % np.uint64(BUCKETS)).astype(np.int64)


def _totals(texts: DataFrame) -> np.ndarray:
    """n-grams by bucket in all rows of ``texts(text)``; each task adds up its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _Hasher()
        totals = np.zeros(BUCKETS, np.int64)
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.append(hasher.ngrams(text or ""))
                size += len(held[-1])
                if size > HELD_NGRAMS:
                    totals += np.bincount(np.concatenate(held), minlength=BUCKETS)
                    held, size = [], 0
        if held:
            totals += np.bincount(np.concatenate(held), minlength=BUCKETS)
        seen = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen), pa.array(totals[seen])], names=["bucket", "n"]
        )

    rows = texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = rows.toPandas()  # one row per bucket
    totals = np.zeros(BUCKETS)
    totals[found["bucket"]] = found["n"]
    return totals


def _among(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` with a doc_id among ``ids``.

    A bitmap of hashed ids of a fixed size goes to every task first, so that about only the
    texts that are wanted are shuffled.
    """
    h = F.pmod(F.xxhash64("doc_id"), F.lit(BITMAP_BITS))
    maps = ids.groupBy(F.bitmap_bucket_number(h).alias("_part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(h)).alias("_bits")
    )
    place = F.bitmap_bit_position(h)
    byte = F.substring("_bits", (place / 8).cast("int") + 1, F.lit(1))
    held = F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), (place % 8).cast("int")) == 1
    # At most BITMAP_BITS / 32768 rows of 4 KiB.
    near = docs.withColumn("_part", F.bitmap_bucket_number(h)).join(F.broadcast(maps), "_part")
    near = near.where(held).drop("_part", "_bits")
    # One plan at every size: ids small enough to be sent out today grow with the labels.
    return near.hint("merge").join(ids, "doc_id", "left_semi")


def _gumbel(doc_id: Column, seed: int) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(doc_id, F.lit(seed)), 11)
    return -F.log(-F.log((bits.cast("double") + 0.5) / float(2**53)))


def threshold(keys: DataFrame, k: int) -> float | None:
    """The k-th largest ``key``; None if there are not so many.

    Counts by range narrow down the range that holds it, ``BINS`` ranges each time, so
    the driver sees counts and at last a single value.
    """
    low, high, n = keys.agg(F.min("key"), F.max("key"), F.count("key")).first()
    if k < 1 or n < k:
        return None
    above = 0
    while low < high:
        width = (high - low) / BINS
        if not low < low + width:
            break
        inside = keys.where(F.col("key").between(low, high))
        place = F.least(F.floor((F.col("key") - low) / width), F.lit(BINS - 1)).alias("bin")
        bins = inside.groupBy(place).agg(
            F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")
        )
        for row in sorted(bins.collect(), key=lambda r: -r["bin"]):
            if above + row["n"] >= k:
                low, high = row["low"], row["high"]
                break
            above += row["n"]
    return low


def resample(docs: DataFrame, labels: DataFrame, seed: int = 5) -> DataFrame:
    """``log_weight``, ``key`` and ``kept`` of every document of ``docs(doc_id, text)``.

    ``labels(doc_id, quality)``: the target is all documents of quality 1. As large a share
    of all documents is kept as is good among the labelled ones (all, without labels):
    those with the largest keys. Whole texts count, in the model of all documents as in
    the weights. A NULL, empty or blank text has no n-grams and weight 0. Rows with equal
    doc_id draw the same noise; keys equal to the last one kept are kept, too.
    """
    ids = labels.where("quality = 1").select(F.col("doc_id").cast("long").alias("doc_id"))
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    good = ids.where("doc_id IS NOT NULL").distinct()
    raw, target = _totals(texts.select("text")), _totals(_among(texts, good).select("text"))
    p_raw = (raw + SMOOTHING) / (raw.sum() + SMOOTHING * BUCKETS)
    p_target = (target + SMOOTHING * p_raw * BUCKETS) / (target.sum() + SMOOTHING * BUCKETS)
    shared = docs.sparkSession.sparkContext.broadcast(np.log(p_target / p_raw))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _Hasher()
        for batch in batches:
            sums = [
                float(shared.value[hasher.ngrams(t or "")].sum()) for t in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sums, pa.float64())], names=["doc_id", "log_weight"]
            )

    scored = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, log_weight double"
    )
    keyed = materialize(
        scored.withColumn("key", F.col("log_weight") + _gumbel(F.col("doc_id"), seed)), "keys"
    )
    share = labels.agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0]
    k = round(keyed.count() * (1.0 if share is None else share))
    least = threshold(keyed, k)
    kept = F.lit(False) if least is None else F.col("key") >= least
    return keyed.withColumn("kept", kept)
