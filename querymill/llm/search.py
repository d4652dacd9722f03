"""Ranked search by the Best Position Algorithm over impact lists.

Each term has a list of documents by falling impact, the share that the term has in a
document's score. For a query the lists of its terms are read from the top. A document
met for the first time is looked up in all the lists at once, which shows its places
there, too. A list's best position is the end of what has been seen of it without a gap,
by either way. No unseen document scores above the sum of impacts at the best positions,
so reading ends once the k-th best score lies strictly above that sum.

Lists are made of some ten thousand documents at a time, inside a task. A task searches
one such part after another and carries each query's best documents along, so later
parts end sooner. Of every task at most k documents a query are ranked in the end.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from querymill.session import materialize

TOP = 20
QUERY_BYTES = 8 << 20  # of query texts that are searched for together
PART_POSTINGS = 4_000_000  # impacts that a task holds at once, besides one batch
FIRST_READ = 32  # places of each list; doubles from step to step
MERGE_BUCKETS = 64

# A term is a run of ASCII letters, digits and other bytes from 0x80 on, that
# is of all characters beyond ASCII; only A-Z change to lower case.
_TERM_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def terms(text: bytes | None) -> list[bytes]:
    """Terms of a text in UTF-8, with repeats; none for NULL."""
    return text.translate(_TERM_BYTES).split() if text else []


def weight(df: int, n_documents: int) -> int:
    return math.floor(1000 * math.log((2 * n_documents + 2) / (2 * df + 1)))


def _index(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, terms, counts`` of each document with a term: n of all its terms,
    numbers and counts of those that are asked for."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            sizes, numbers, counts, ends = [], [], [], [0]
            for text in batch.column(1):
                found = terms(text.as_py())
                sizes.append(len(found))
                count = Counter(found)
                hits = count.keys() & known.keys()
                numbers += map(known.__getitem__, hits)
                counts += map(count.__getitem__, hits)
                ends.append(len(numbers))
            offsets = pa.array(ends, pa.int32())
            made = pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(numbers, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64())),
                ],
                names=["doc_id", "n", "terms", "counts"],
            )
            yield made.filter(pa.array([n > 0 for n in sizes], pa.bool_()))

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary"))
    schema = "doc_id long, n long, terms array<int>, counts array<long>"
    return materialize(rows.mapInArrow(run, schema), "index")


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The numbers from each start to before its end, one range after the other."""
    sizes = ends - starts
    at = np.cumsum(sizes) - sizes
    return np.arange(sizes.sum()) + np.repeat(starts - at, sizes)


class Top:
    """The best k documents so far: score falling, then doc_id rising, NULL last."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.score = np.zeros(0, np.int64)
        self.doc_id = np.zeros(0, np.int64)
        self.nameless = np.zeros(0, bool)

    def add(self, score: np.ndarray, doc_id: np.ndarray, nameless: np.ndarray) -> None:
        score = np.concatenate([self.score, score])
        doc_id = np.concatenate([self.doc_id, doc_id])
        nameless = np.concatenate([self.nameless, nameless])
        order = np.lexsort((doc_id, nameless, -score))[: self.k]
        self.score, self.doc_id, self.nameless = score[order], doc_id[order], nameless[order]

    def beats(self, bound: int) -> bool:
        return len(self.score) == self.k and int(self.score[-1]) > bound


class Lists:
    """Impact lists of a part of the documents."""

    def __init__(
        self,
        doc_id: np.ndarray,
        nameless: np.ndarray,
        sizes: np.ndarray,
        ends: np.ndarray,
        numbers: np.ndarray,
        counts: np.ndarray,
        weights: np.ndarray,
        n_documents: int,
        n_terms: int,
    ) -> None:
        """``ends``: of each document's entries in ``numbers`` and ``counts``, after a 0."""
        self.doc_id, self.nameless = doc_id, nameless
        doc = np.repeat(np.arange(len(doc_id)), np.diff(ends))
        length = 75 + (25 * sizes * n_documents) // max(n_terms, 1)
        impact = weights[numbers] * ((1_000_000_000 * counts) // (1000 * counts + 12 * length[doc]))
        some = impact > 0
        doc, numbers, impact = doc[some], numbers[some], impact[some]
        order = np.lexsort((-impact, numbers))
        self.doc, self.impact = doc[order], impact[order]
        self.begin = np.searchsorted(numbers[order], np.arange(len(weights) + 1))
        # Direct access: a document's entries, and where each one stands in its list.
        self.entry_term, self.entry_impact = numbers, impact
        self.entry_place = np.empty(len(order), np.int64)
        self.entry_place[order] = np.arange(len(order))
        self.entries = np.searchsorted(doc, np.arange(len(doc_id) + 1))
        self.seen = np.zeros(len(order), np.int32)
        self.met = np.zeros(len(doc_id), np.int32)
        self.asked = np.zeros(len(weights), np.int64)
        self.turn = 0

    def search(self, numbers: np.ndarray, times: np.ndarray, top: Top) -> int:
        """Adds the best documents to ``top``; returns how many were looked up."""
        self.turn += 1
        turn, n_met = self.turn, 0
        begin, end = self.begin[numbers], self.begin[numbers + 1]
        some = end > begin
        begin, end, times, numbers = begin[some], end[some], times[some], numbers[some]
        self.asked[numbers] = times
        unseen, read, step = begin.copy(), begin.copy(), FIRST_READ
        while (read < end).any():
            upto = np.minimum(read + step, end)
            places = _ranges(read, upto)
            read, step = upto, 2 * step
            self.seen[places] = turn
            docs = np.unique(self.doc[places])
            docs = docs[self.met[docs] != turn]
            if len(docs):
                self.met[docs] = turn
                n_met += len(docs)
                top.add(self._look_up(docs, turn), self.doc_id[docs], self.nameless[docs])
            bound = 0
            for i, last in enumerate(end):
                unseen[i] = self._best_position(int(unseen[i]), int(last), turn)
                if unseen[i] < last:
                    bound += int(times[i]) * int(self.impact[unseen[i] - 1])
            if top.beats(bound):
                break
        self.asked[numbers] = 0
        return n_met

    def _look_up(self, docs: np.ndarray, turn: int) -> np.ndarray:
        """Scores of documents; their places in the lists count as seen."""
        start, end = self.entries[docs], self.entries[docs + 1]
        rows = _ranges(start, end)
        times = self.asked[self.entry_term[rows]]
        self.seen[self.entry_place[rows[times > 0]]] = turn
        total = np.concatenate([[0], np.cumsum(times * self.entry_impact[rows])])
        upto = np.cumsum(end - start)
        return total[upto] - total[upto - (end - start)]

    def _best_position(self, at: int, end: int, turn: int) -> int:
        """The first place from ``at`` on that has not been seen."""
        step = 256
        while at < end:
            gaps = self.seen[at : min(at + step, end)] != turn
            first = int(gaps.argmax())
            if gaps[first]:
                return at + first
            at += len(gaps)
            step *= 2
        return end


def _joined(batches: list[pa.RecordBatch]) -> tuple[np.ndarray, ...]:
    """Arrays of an index's rows: doc_id, whether it is NULL, n, ends, terms, counts."""
    rows = pa.Table.from_batches(batches).combine_chunks()
    ids = rows.column("doc_id")
    numbers, counts = (rows.column(c).combine_chunks() for c in ("terms", "counts"))
    sizes = numbers.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return (
        ids.fill_null(0).to_numpy(),
        ids.is_null().to_numpy(),
        rows.column("n").to_numpy(),
        np.concatenate([[0], np.cumsum(sizes)]),
        numbers.flatten().to_numpy(),
        counts.flatten().to_numpy(),
    )


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += len(batch.column("terms").flatten())
        if n >= PART_POSTINGS:
            yield held
            held, n = [], 0
    if held:
        yield held


def _searched(
    index: DataFrame,
    queries: list[tuple[object, Counter]],
    vocabulary: dict[bytes, int],
    k: int,
    item_type: str,
) -> DataFrame:
    """``query, item_id, doc_id, score``: the best documents of each task for each query."""
    spark = index.sparkSession
    n_documents, n_terms = index.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # One row per term of the queries.
    held = index.select(F.explode("terms").alias("t")).groupBy("t").count().collect()
    df = dict(map(tuple, held))
    weights = np.array([weight(df.get(t, 0), n_documents) for t in range(len(vocabulary))], np.int64)
    asked = [
        (
            np.array([vocabulary[w] for w in count], np.int64),
            np.array(list(count.values()), np.int64),
        )
        for _, count in queries
    ]
    items = [item for item, _ in queries]
    shared = spark.sparkContext.broadcast((weights, asked, items))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, asked, items = shared.value
        tops = [Top(k) for _ in asked]
        for part in _parts(batches):
            lists = Lists(*_joined(part), weights, n_documents, n_terms)
            for (numbers, times), top in zip(asked, tops, strict=True):
                lists.search(numbers, times, top)
        for query, top in enumerate(tops):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(top.score), query), pa.int32()),
                    pa.array(top.doc_id, pa.int64(), mask=top.nameless),
                    pa.array(top.score, pa.int64()),
                ],
                names=["query", "doc_id", "score"],
            )

    found = index.mapInArrow(run, "query int, doc_id long, score long")
    names = spark.createDataFrame(list(enumerate(items)), f"query int, item_id {item_type}")
    return _ranked(found, k).join(F.broadcast(names), "query")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The best k rows of each query, numbered; first in buckets, then of what is left."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    bucket = F.pmod(F.xxhash64("doc_id"), F.lit(MERGE_BUCKETS))
    spread = Window.partitionBy("query", "bucket").orderBy(*order)
    whole = Window.partitionBy("query").orderBy(*order)
    fewer = (
        found.withColumn("bucket", bucket)
        .withColumn("rank", F.row_number().over(spread))
        .where(F.col("rank") <= k)
    )
    return fewer.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k)


def best_documents(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best documents of ``docs(doc_id, text)`` for
    each row of ``items(item_id, text)``.

    A document's score sums the impacts of the item's terms, repeats included. Documents
    that score nothing are not returned; equal scores go by rising doc_id, NULL last.
    Every row of ``docs`` is a document, repeated ids too; every row of ``items`` is a query
    of its own, also where two have one item_id. NULL and blank texts have no terms. Other
    columns are not looked at.

    Queries go to the tasks in blocks of about ``QUERY_BYTES`` of text, each block with a
    pass over all documents, so what is broadcast does not grow with ``items``. A block's
    statistics (terms, documents that hold a term) cover all documents.
    """
    rows = items.select("item_id", F.col("text").cast("string").alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n_blocks = size // QUERY_BYTES + 1
    item_type = items.schema["item_id"].dataType.simpleString()
    results = []
    for block in range(n_blocks):
        here = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block)
        queries = [
            (r["item_id"], Counter(terms((r["text"] or "").encode("utf-8")))) for r in here.collect()
        ]
        vocabulary = {w: i for i, w in enumerate(sorted({w for _, count in queries for w in count}))}
        index = _index(docs, vocabulary)
        results.append(_searched(index, queries, vocabulary, k, item_type))
    return reduce(DataFrame.unionByName, results).select("item_id", "rank", "doc_id", "score")
