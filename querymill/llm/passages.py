"""Removal of byte strings that occur elsewhere, by columns of aligned texts.

Building one Burrows-Wheeler transform of all texts column by column takes as many
rounds as the longest text has bytes, each over the whole collection. Here the
collection is cut into short texts that are aligned first, so that rounds are few and
short ones can be built apart from each other:

* Of each ``LENGTH`` bytes in a row, the 32-byte string with the least hash is the
  anchor. Equal rows of bytes have equal anchors in equal places, so two of them are
  found together where texts are grouped by anchor. Anchors without an equal elsewhere
  are dropped, and with them nearly all text.
* What surrounds an anchor in the rows that chose it makes a short text, aligned with
  the others of its group at the anchor. For a group, the transform is built from the
  last column to the first: each round puts one symbol before each text, sorts the
  texts by it, stable in the order of the round before, and takes the common prefixes
  of neighbours from those before. Where neighbours have ``LENGTH`` symbols in common,
  the row of bytes that begins there occurs elsewhere.
* Of a group of more than ``GROUP`` texts, equal ones are found first, and one of them
  is kept. If too many are left, each text's rows are parted by how far before the
  anchor they begin, in fixed stretches, and the parts grouped anew by the bytes that
  all rows of the stretch have in common; and so on until groups are small.

Between rounds everything lies in files of the shared folder, read and written in
sequence.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from querymill.session import materialize

LENGTH = 400  # bytes
ANCHOR = 32
GROUP = 1024  # texts of a group in one task
WHOLE = 512  # distances before an anchor, before any parting
PARTS = 4
TOGETHER = 8192  # texts whose groups are built side by side
PIECE = 1 << 23  # bytes of a text hashed at a time

_U64 = np.uint64
_PLACES = (1 << 24) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def _anchors_of_piece(data: bytes, length: int) -> tuple[np.ndarray, ...]:
    """Hash, place, and first and last row of bytes of each anchor."""
    count = len(data) - ANCHOR + 1
    eight = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    h = np.zeros(count, _U64)
    for k in range(ANCHOR // 8):
        h = _mix(h + eight[8 * k : 8 * k + count] + _U64(k + 1))
    # Of equal hashes the first in the row: places break the tie.
    key = (h & ~_U64(_PLACES)) | np.arange(count, dtype=_U64)
    width = length - ANCHOR + 1
    blocks = -(-count // width)
    padded = np.full(blocks * width, np.iinfo(_U64).max, _U64)
    padded[:count] = key
    padded = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    rows = count - width + 1
    chosen = (np.minimum(back[:rows], ahead[width - 1 : width - 1 + rows]) & _U64(_PLACES)).astype(
        np.int64
    )
    first = np.flatnonzero(np.append(True, chosen[1:] != chosen[:-1]))
    last = np.append(first[1:], rows) - 1
    places = chosen[first]
    return h[places].view(np.int64), places, first, last


def anchors(data: bytes, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Anchors of a whole text; none if it is shorter than ``length``."""
    found = []
    step = PIECE - length + 1  # each row of bytes lies in one piece
    for at in range(0, max(1, len(data) - length + 1), step):
        piece = data[at : at + PIECE]
        if len(piece) >= length:
            h, place, first, last = _anchors_of_piece(piece, length)
            found.append((h, place + at, first + at, last + at))
    if not found:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(parts) for parts in zip(*found, strict=True))


def _anchored(texts: DataFrame, length: int) -> DataFrame:
    """``ref`` and the anchors of each text, as arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                columns = [[], [], [], []]
                for data in batch.column(1).to_pylist():
                    for column, values in zip(columns, anchors(data, length), strict=True):
                        column.append(values)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *[pa.array(c, pa.list_(pa.int64())) for c in columns]],
                    names=["ref", "anchor", "place", "first", "last"],
                )

    return texts.mapInArrow(
        run,
        "ref binary, anchor array<long>, place array<long>, first array<long>, last array<long>",
    )


_ITEM = (
    "key binary, ref binary, place long, low int, high int, data binary, least int, width int"
)


def _surroundings(chosen: DataFrame, length: int) -> DataFrame:
    """A row for each anchor of each text, with the bytes of the rows that chose it.

    ``low`` and ``high``: how far before the anchor the last and the first row begin.
    ``least`` and ``width``: the stretch of distances that the group is for.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                rows = whole.slice(at, 64).to_pylist()
                out: list[list] = [[] for _ in range(8)]
                for row in rows:
                    for one in row["found"]:
                        values = (
                            one["anchor"].to_bytes(8, "little", signed=True),
                            row["ref"],
                            one["place"],
                            one["place"] - one["last"],
                            one["place"] - one["first"],
                            row["data"][one["first"] : one["last"] + length],
                            0,
                            WHOLE,
                        )
                        for column, value in zip(out, values, strict=True):
                            column.append(value)
                yield _items(out)

    return chosen.mapInArrow(run, _ITEM)


def _items(columns: list[list]) -> pa.RecordBatch:
    types = [pa.binary(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    types += [pa.int32(), pa.int32()]
    names = [part.split()[0] for part in _ITEM.split(", ")]
    arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def repeated_rows(
    groups: np.ndarray, low: np.ndarray, high: np.ndarray, data: list[bytes], length: int
) -> np.ndarray:
    """Which rows of bytes occur twice in their group: ``[text, distance before anchor]``.

    Columns from the last to the first; ``order`` has the texts sorted by what follows
    the column, group by group, ``common`` how much each shares with the one before it.
    ``groups`` must be sorted.
    """
    n, reach = len(data), int(high.max())
    width = reach + length - int(low.min())
    symbols = np.full((width, n), 256, np.int16)
    for k, piece in enumerate(data):
        start = reach - high[k]
        symbols[start : start + len(piece), k] = np.frombuffer(piece, np.uint8)
    found = np.zeros((n, reach + 1), bool)
    order, common = np.arange(n), np.zeros(n, np.int64)
    number = np.cumsum(np.append(False, groups[1:] != groups[:-1]))
    head = np.append(True, number[1:] != number[:-1])
    longest_group = int(np.bincount(number).max())
    for column in range(width - 1, -1, -1):
        symbol = symbols[column][order].astype(np.int64)
        moved = np.argsort(number * 512 + symbol, kind="stable")
        # The transform's column is ``symbol``; ``moved`` is its last-to-first mapping.
        before, after = moved[:-1], moved[1:]
        alike = (symbol[before] == symbol[after]) & ~head[1:]
        least = _range_minimum(common, before + 1, after, alike, longest_group)
        order = order[moved]
        common = np.zeros(n, np.int64)
        common[1:][alike] = least + 1
        if column <= reach:
            twice = common >= length
            twice[:-1] |= common[1:] >= length
            found[order[twice], reach - column] = True
    distance = np.arange(reach + 1)
    return found & (distance >= low[:, None]) & (distance <= high[:, None])


def _range_minimum(
    values: np.ndarray, first: np.ndarray, last: np.ndarray, where: np.ndarray, most: int
) -> np.ndarray:
    """Least of ``values[first..last]`` for the chosen ranges of at most ``most`` values."""
    first, last = first[where], last[where]
    spans = last - first + 1
    result = values[last]
    level, table = 0, values
    longest = min(most, int(spans.max(initial=1)))
    exponents = np.frexp(spans)[1] - 1
    while True:
        mine = exponents == level
        if mine.any():
            result[mine] = np.minimum(table[first[mine]], table[last[mine] - (1 << level) + 1])
        level += 1
        if 1 << level > longest:
            return result
        half = 1 << (level - 1)
        table = np.minimum(table[:-half], table[half:])


def _runs(row: np.ndarray) -> list[tuple[int, int]]:
    """First and last index of each run of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], row.view(np.int8), [0]])))
    return [(a, b - 1) for a, b in edges.reshape(-1, 2).tolist()]


def _build(dealt: DataFrame, length: int) -> DataFrame:
    """``ref, starts, size``: stretches of bytes that occur elsewhere, group by group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, rows in _together(batches):
            found = repeated_rows(group, rows["low"], rows["high"], rows["data"], length)
            refs, starts, sizes = [], [], []
            for k in np.flatnonzero(found.any(axis=1)).tolist():
                place = int(rows["place"][k])
                for a, b in _runs(found[k]):
                    refs.append(rows["ref"][k])
                    starts.append([place - b])
                    sizes.append(b - a + length)
            if refs:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(refs, pa.binary()),
                        pa.array(starts, pa.list_(pa.int64())),
                        pa.array(sizes, pa.int64()),
                    ],
                    names=["ref", "starts", "size"],
                )

    return dealt.mapInArrow(run, "ref binary, starts array<long>, size long")


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, dict]]:
    """Whole groups of texts that come sorted by group, many at a time."""
    rest: pa.Table | None = None

    def unpacked(rows: pa.Table) -> tuple[np.ndarray, dict]:
        lists = {n: rows.column(n).to_pylist() for n in ("ref", "data")}
        return _numbers(rows), lists | {
            n: rows.column(n).to_numpy() for n in ("place", "low", "high")
        }

    for batch in batches:
        for at in range(0, batch.num_rows, TOGETHER):
            rows = pa.Table.from_batches([batch.slice(at, TOGETHER)])
            if rest is not None:
                rows = pa.concat_tables([rest, rows])
            if rows.num_rows < TOGETHER:
                rest = rows
                continue
            number = _numbers(rows)
            end = int(np.searchsorted(number, number[-1]))
            if end:
                yield unpacked(rows.slice(0, end))
            rest = rows.slice(end)
    if rest is not None and rest.num_rows:
        yield unpacked(rest)


def _numbers(rows: pa.Table) -> np.ndarray:
    """Number of each row's group; rows are sorted by group."""
    keys = rows.column("key").to_pylist()
    new = [False] + [keys[k] != keys[k - 1] for k in range(1, len(keys))]
    return np.cumsum(np.array(new, int))


def _parted(items: DataFrame, length: int) -> DataFrame:
    """Each text's rows in parts, each grouped by what all rows of its stretch share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            out: list[list] = [[] for _ in range(8)]
            for row in whole.to_pylist():
                low, high, data = row["low"], row["high"], row["data"]
                width = max(1, row["width"] // PARTS)
                for least in range(row["least"], row["least"] + row["width"], width):
                    a, b = max(low, least), min(high, least + width - 1)
                    if a <= b:
                        core = data[high - least : high - least + length - width + 1]
                        key = hashlib.blake2b(core, digest_size=16, key=row["key"][:16])
                        values = (
                            key.digest() + least.to_bytes(2, "little"),
                            row["ref"],
                            row["place"],
                            a,
                            b,
                            data[high - b : high - a + length],
                            least,
                            width,
                        )
                        for column, value in zip(out, values, strict=True):
                            column.append(value)
            yield _items(out)

    return items.mapInArrow(run, _ITEM)


def _stretches(items: DataFrame, length: int) -> DataFrame:
    """``ref, starts, size`` of all stretches of bytes that occur elsewhere.

    One row may stand for several places of a text: a line that it repeats has many.
    """
    results: list[DataFrame] = []
    columns = items.columns
    while True:
        sizes = items.groupBy("key").count()
        # Of each key's texts: all, unless nothing can be equal or there are too many.
        large = sizes.where(F.col("count") > GROUP).select("key")
        single = sizes.where("count = 1").select("key")
        dealt = (
            items.join(large, "key", "left_anti")
            .join(single, "key", "left_anti")
            .repartition("key")
            .sortWithinPartitions("key")
        )
        results.append(materialize(_build(dealt, length), "built"))
        crowded = materialize(items.join(large, "key", "left_semi"), "crowded")
        if crowded.isEmpty():
            return reduce(DataFrame.unionByName, results)
        # Equal texts, with equal rows to look for: all those rows occur elsewhere.
        same = ["key", "low", "high", "digest"]
        digest = F.sha2("data", 256).alias("digest")
        one = F.min(F.struct("ref", "place")).alias("one")
        alike = materialize(
            crowded.select("key", "low", "high", digest, "ref", "place")
            .groupBy(*same)
            .agg(F.count("*").alias("n"), one),
            "alike",
        )
        copies = alike.where("n > 1").select(*same)
        results.append(
            crowded.select("key", "low", "high", digest, "ref", "place")
            .groupBy("ref", *same)
            .agg(F.collect_list(F.col("place") - F.col("high")).alias("starts"))
            .join(copies, same, "left_semi")
            .select(
                "ref",
                "starts",
                (F.col("high") - F.col("low") + length).cast("long").alias("size"),
            )
        )
        firsts = alike.select("key", "low", "high", "one.ref", "one.place")
        kept = crowded.join(firsts, ["key", "low", "high", "ref", "place"], "left_semi")
        left = alike.groupBy("key").count()
        few = left.where(F.col("count") <= GROUP).select("key")
        many = left.where(F.col("count") > GROUP).select("key")
        items = materialize(
            kept.join(few, "key", "left_semi")
            .select(columns)
            .unionByName(_parted(kept.join(many, "key", "left_semi").select(columns), length)),
            "parted",
        )


def _cut(texts: DataFrame) -> DataFrame:
    """``ref, n_removed, n_spans, kept_sha256`` from texts with their stretches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, spans, hashes = [], [], []
            for data, found in zip(
                batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True
            ):
                kept, free, count, gone = hashlib.sha256(), 0, 0, 0
                end = -1
                spread = {(at, at + s["size"]) for s in found for at in s["starts"]}
                for one in sorted(spread):
                    if one[0] > end:
                        count += 1
                        kept.update(data[free : one[0]])
                        gone += one[1] - one[0]
                        free = end = one[1]
                    elif one[1] > end:
                        gone += one[1] - end
                        free = end = one[1]
                kept.update(data[free:])
                removed.append(gone)
                spans.append(count)
                hashes.append(kept.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(removed, pa.int64()),
                    pa.array(spans, pa.int64()),
                    pa.array(hashes, pa.string()),
                ],
                names=["ref", "n_removed", "n_spans", "kept_sha256"],
            )

    return texts.mapInArrow(
        run, "ref binary, n_removed long, n_spans long, kept_sha256 string"
    )


def repeated_passages(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """What is left of texts without the bytes that occur elsewhere.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. Texts are bytes
    of UTF-8. A byte goes if a string of ``length`` bytes that covers it begins at any
    other place, of the same text or another one; overlapping strings count, strings
    never run across texts, and all are judged on the input.

    Returns doc_id, n_bytes, n_removed, n_spans (longest runs of removed bytes),
    kept_sha256 of the bytes that are left, and whether any byte goes (repeats). A NULL text is an empty one; texts shorter
    than ``length`` stay as they are. Two rows with one text are two places, with one
    doc_id as well. Rows neither merge nor change places.
    """
    data = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    whole = F.sha2(data, 256)
    texts = docs.select(
        "doc_id",
        whole.alias("sha"),
        F.octet_length(data).cast("long").alias("n_bytes"),
        data.alias("data"),
    )
    ref = F.unhex(F.substring("sha", 1, 32)).alias("ref")
    rows = materialize(texts.select("doc_id", "sha", "n_bytes"), "rows")
    long_rows = rows.where(F.col("n_bytes") >= length)
    classes = long_rows.groupBy("sha").agg(
        F.count("*").alias("n_copies"), F.min("doc_id").alias("first_id")
    )
    classes = materialize(classes.select(ref, "sha", "n_copies", "first_id"), "classes")
    long_texts = texts.where(F.col("n_bytes") >= length).select(ref, "doc_id", "data")
    anchored = materialize(_anchored(long_texts.select("ref", "data"), length), "anchors")
    each = anchored.select(
        "ref", F.explode(F.arrays_zip("anchor", "place", "first", "last")).alias("one")
    )
    # An anchor in two places has two hashes of them.
    where = F.xxhash64("ref", "one.place")
    repeated = (
        each.select(F.col("one.anchor").alias("anchor"), where.alias("h"))
        .groupBy("anchor")
        .agg(F.min("h").alias("least"), F.max("h").alias("most"))
        .where("least <> most")
        .select("anchor")
    )
    chosen = (
        each.select("ref", F.col("one.anchor").alias("anchor"), "one")
        .join(repeated, "anchor")
        .groupBy("ref")
        .agg(F.collect_set("one").alias("found"))
    )
    # One text of each class: its copies are known to be repeated all over.
    chosen = chosen.join(classes.select("ref", "first_id", "n_copies"), "ref")
    first = F.col("doc_id").eqNullSafe(F.col("first_id"))
    held = materialize(
        chosen.join(long_texts, "ref").where(first).select("ref", "n_copies", "data", "found"),
        "held",
    )
    stretches = _stretches(_surroundings(held.select("ref", "data", "found"), length), length)
    per_text = stretches.groupBy("ref").agg(
        F.collect_list(F.struct("starts", "size")).alias("stretches")
    )
    cut = _cut(
        held.where("n_copies = 1")
        .dropDuplicates(["ref"])
        .select("ref", "data")
        .join(per_text, "ref")
        .select("ref", "data", "stretches")
    )
    by_text = materialize(
        classes.join(cut, "ref", "left").select(
            "sha", "n_copies", "n_removed", "n_spans", "kept_sha256"
        ),
        "cut",
    )
    copied = F.col("n_copies") > 1
    gone = F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0)))
    return rows.join(by_text, "sha", "left").select(
        "doc_id",
        "n_bytes",
        gone.cast("long").alias("n_removed"),
        F.when(copied, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copied, F.sha2(F.lit("").cast("binary"), 256))
        .otherwise(F.coalesce("kept_sha256", "sha"))
        .alias("kept_sha256"),
        (gone > 0).alias("repeats"),
    )
