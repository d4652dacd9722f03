"""Large CSV files with line breaks in quoted fields, each read by many tasks.

A line break ends a record where the number of quotes before it is even. So a first pass
counts the quotes of each byte range of a file; sums along the file tell which ranges
begin inside a field. In a second pass a task that knows this of its ranges finds all
records that lie within them. Records that cross the end of a range are put together
from pieces the first pass has set aside, however many ranges a field spans.

Counting quotes is right for files quoted as in RFC 4180: a field is quoted as a whole,
or has no quote. The first pass checks every quote's neighbours. A file with any other
quote is read whole, in one task, as Spark's own reader does it.
"""

from __future__ import annotations

import csv
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from querymill.session import MIB, materialize

RANGE_BYTES = 128 * MIB

_QUOTE, _COMMA, _RETURN = 34, 44, 13
_BOM = b"\xef\xbb\xbf"
_BREAK = pa.scalar(b"\n", pa.large_binary())


def range_lines(
    spark: SparkSession, paths: list[str], range_bytes: int, recursive: bool
) -> DataFrame:
    """``value, file, start, path``: lines of all files larger than a range, in order within
    each range of ``range_bytes``.

    The two passes have to see the same ranges. These depend on settings and on the number
    of cores, so the scan is made in a session with fixed settings of its own.
    """
    fixed = spark.newSession()
    fixed.conf.set("spark.sql.files.maxPartitionBytes", str(range_bytes))
    fixed.conf.set("spark.sql.files.minPartitionNum", "1")
    reader = fixed.read.format("text").option("lineSep", "\n")
    lines = reader.option("recursiveFileLookup", recursive).load(paths)
    view = f"lines_{uuid.uuid4().hex}"
    lines.where(F.col("_metadata.file_size") > range_bytes).select(
        "value",
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
    ).createGlobalTempView(view)
    # Through a global view, which is resolved here and then gone, the scan becomes one of
    # the caller's session.
    seen = spark.table(f"global_temp.{view}")
    spark.catalog.dropGlobalTempView(view)
    return seen


class _Lines:
    """Lines of one range in a batch, as bytes and their ends."""

    def __init__(self, values: pa.Array) -> None:
        self.values = values
        ends = np.frombuffer(values.buffers()[1], np.int64)
        self.ends = ends[values.offset : values.offset + len(values) + 1]
        data = values.buffers()[2]
        self.data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        inside = self.data[self.ends[0] : self.ends[-1]]
        self.quotes = np.flatnonzero(inside == _QUOTE) + self.ends[0]
        line = np.searchsorted(self.ends, self.quotes, side="right") - 1
        self.odd = np.bincount(line, minlength=len(values)) & 1
        self.line = line

    def check(self, parity: int) -> tuple[bool, bool, bool]:
        """Whether a quote stands where it may not, if ``parity`` quotes lie before, and if
        one more does; and whether a quote is followed by a carriage return."""
        at, data = self.quotes, self.data
        if not len(at):
            return False, False, False
        first, last = at == self.ends[self.line], at + 1 == self.ends[self.line + 1]
        before = np.where(first, _COMMA, data[np.maximum(at - 1, 0)])
        after = np.where(last, _COMMA, data[np.minimum(at + 1, len(data) - 1)])
        returned = (after == _RETURN) & (at + 2 == self.ends[self.line + 1])
        may_open = (before == _COMMA) | (before == _QUOTE)
        may_close = (after == _COMMA) | (after == _QUOTE) | returned
        inside = (parity + np.arange(len(at))) & 1 == 1
        right = np.where(inside, may_close, may_open)
        other = np.where(inside, may_open, may_close)
        return not right.all(), not other.all(), bool(returned.any())


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.Array]]:
    """``file, start`` and lines of each range's part of each batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        values, file, start = batch.columns
        file, start = file.to_numpy(), start.to_numpy()
        values = values.cast(pa.large_binary())
        cuts = np.flatnonzero((file[1:] != file[:-1]) | (start[1:] != start[:-1])) + 1
        begin = 0
        for end in [*cuts.tolist(), batch.num_rows]:
            yield int(file[begin]), int(start[begin]), values.slice(begin, end - begin)
            begin = end


def _text(lines: list[pa.Array]) -> bytes:
    whole = pa.concat_arrays(lines)
    one = pa.ListArray.from_arrays(pa.array([0, len(whole)], pa.int32()), whole)
    return pc.binary_join(one, _BREAK)[0].as_py()


class _Count:
    """What the first pass finds in one range."""

    FIELDS = (
        "file long, start long, odd boolean, has_odd boolean, head binary, tail binary, "
        "wrong_outside boolean, wrong_inside boolean, returned boolean, no_record boolean, "
        "crlf boolean, lone_return boolean"
    )

    def __init__(self, file: int, start: int) -> None:
        self.file, self.start = file, start
        self.parity, self.has_odd = 0, False
        self.head: list[pa.Array] = []
        self.tail: list[pa.Array] = []
        self.wrong = [False, False]
        self.returned, self.no_record = False, True
        self.first: bytes | None = None

    def add(self, values: pa.Array) -> None:
        lines = _Lines(values)
        if self.first is None:
            self.first = values[0].as_py()
        here, other, returned = lines.check(self.parity)
        self.wrong = [self.wrong[0] | here, self.wrong[1] | other]
        self.returned |= returned
        after = (self.parity + np.cumsum(lines.odd)) & 1
        # Blank lines before the header are no records.
        outside = np.flatnonzero(after == 0)
        blank = np.diff(lines.ends)[outside] <= 1
        self.no_record &= bool(blank.all())
        odd = np.flatnonzero(lines.odd)
        if len(odd):
            if not self.has_odd:
                self.head.append(values.slice(0, int(odd[0]) + 1))
                self.has_odd = True
            self.tail = [values.slice(int(odd[-1]))]
        elif self.has_odd:
            self.tail.append(values)
        else:
            self.head.append(values)
        self.parity = int(after[-1])

    def row(self) -> tuple:
        first = self.first if self.start == 0 and self.first is not None else b""
        return (
            self.file,
            self.start,
            self.parity == 1,
            self.has_odd,
            _text(self.head) if self.has_odd else None,
            _text(self.tail) if self.has_odd else None,
            *self.wrong,
            self.returned,
            self.no_record,
            first.endswith(b"\r"),
            b"\r" in first[:-1],
        )


def _counted(lines: DataFrame) -> DataFrame:
    """First pass: one row for each range."""
    names = [field.split()[0] for field in _Count.FIELDS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(count: _Count) -> pa.RecordBatch:
            values = [pa.array([v], t) for v, t in zip(count.row(), types, strict=True)]
            return pa.RecordBatch.from_arrays(values, names=names)

        types = [pa.int64()] * 2 + [pa.bool_()] * 2 + [pa.binary()] * 2 + [pa.bool_()] * 6
        count: _Count | None = None
        for file, start, values in _ranges(batches):
            if count is None or (count.file, count.start) != (file, start):
                if count is not None:
                    yield made(count)
                count = _Count(file, start)
            count.add(values)
        if count is not None:
            yield made(count)

    return materialize(lines.mapInArrow(run, _Count.FIELDS), "quotes")


def _with_states(counted: DataFrame, own: bool) -> DataFrame:
    """Ranges with ``inside`` (one begins within a field), ``opened`` (where the record
    begins that a range begins within) and ``whole`` (its file cannot be cut)."""
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    of_file = Window.partitionBy("file")
    odd = F.col("odd").cast("long")
    inside = F.coalesce(F.sum(odd).over(before) % 2, F.lit(0)) == 1
    opened = F.max(F.when(F.col("has_odd"), F.col("start"))).over(before)
    crlf = F.lit(False) if own else F.max(F.col("crlf")).over(of_file)
    wrong = F.when(F.col("inside"), F.col("wrong_inside")).otherwise(F.col("wrong_outside"))
    begins_badly = (F.col("start") == 0) & (F.col("no_record") | F.col("lone_return"))
    strange = wrong | begins_badly | (F.col("returned") & ~F.col("crlf"))
    # A quote that is never closed: Spark's reader decides what that means.
    unclosed = F.sum(odd).over(of_file) % 2 == 1
    twice = F.count("*").over(Window.partitionBy("file", "start")) > 1
    return (
        counted.withColumns({"inside": inside, "opened": opened, "crlf": crlf})
        .withColumn("strange", strange)
        .withColumn("whole", F.max("strange").over(of_file) | unclosed | F.max(twice).over(of_file))
    )


class _Ranges:
    """Where the second pass stands in its files: bits by file and start."""

    def __init__(self, rows: list) -> None:
        self.inside = {(r["file"], r["start"]): r["inside"] for r in rows if not r["whole"]}
        self.crlf = {r["file"] for r in rows if r["crlf"]}
        self.whole = {r["file"] for r in rows if r["whole"]}


def _records(lines: DataFrame, ranges: _Ranges, names: list[str], sensitive: bool) -> DataFrame:
    """Second pass: ``record``, all but headers, that lie within one range."""
    shared = lines.sparkSession.sparkContext.broadcast(ranges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        place: tuple[int, int] | None = None
        rest: list[pa.Array] = []
        inside, skipping, header = 0, False, False
        for file, start, values in _ranges(batches):
            if file in known.whole:
                continue
            if place != (file, start):
                place, rest = (file, start), []
                if place not in known.inside:
                    raise ValueError("a file has changed between the two passes over it")
                skipping = known.inside[place]
                inside, header = int(skipping), start == 0
            found = _Lines(values)
            after = (inside + np.cumsum(found.odd)) & 1
            inside = int(after[-1])
            if skipping:
                odd = np.flatnonzero(found.odd)
                if not len(odd):
                    continue
                skipping = False
                values, after = values.slice(int(odd[0]) + 1), after[int(odd[0]) + 1 :]
            ends = np.flatnonzero(after == 0) + 1
            if not len(ends):
                rest.append(values)
                continue
            held = sum(map(len, rest))
            whole = pa.concat_arrays([*rest, values.slice(0, int(ends[-1]))])
            if file in known.crlf:
                cut = pc.binary_slice(whole, 0, -1)
                whole = pc.if_else(pc.ends_with(whole, pattern="\r"), cut, whole)
            rest = [values.slice(int(ends[-1]))]
            if len(ends) < len(whole):
                offsets = pa.array(np.concatenate([[0], ends + held]), pa.int32())
                whole = pc.binary_join(pa.ListArray.from_arrays(offsets, whole), _BREAK)
            whole = whole.filter(pc.greater(pc.binary_length(whole), 0))
            if header and len(whole):
                _check_header(whole[0].as_py(), names, sensitive)
                whole, header = whole.slice(1), False
            yield pa.RecordBatch.from_arrays([whole.cast(pa.binary())], names=["record"])

    return lines.mapInArrow(run, "record binary")


def _check_header(record: bytes, names: list[str], sensitive: bool) -> None:
    text = record.removeprefix(_BOM).decode("utf-8", "replace")
    found = next(csv.reader([text]))
    same = found == names if sensitive else [n.lower() for n in found] == [n.lower() for n in names]
    if not same:
        raise ValueError(f"the header {found} does not fit the schema's {names}")


def _crossing(lines: DataFrame, states: DataFrame) -> DataFrame:
    """``record`` for each record that lies in more than one range, out of its pieces."""
    cut = materialize(states.where("NOT whole"), "cut")
    ends_inside = F.col("inside") != F.col("odd")
    tails = cut.where(F.col("has_odd") & ends_inside).select(
        "file", F.col("start").alias("opened"), "start", F.col("tail").alias("piece"), "crlf"
    )
    heads = cut.where("inside AND has_odd").select(
        "file", "opened", "start", F.col("head").alias("piece"), "crlf"
    )
    pieces = tails.unionByName(heads)
    # Ranges that lie within one field.
    within = cut.where("inside AND NOT has_odd").select("file", "opened", "start", "crlf")
    if not within.isEmpty():
        wanted = {(r["file"], r["start"]) for r in within.select("file", "start").collect()}
        pieces = pieces.unionByName(
            _whole_ranges(lines, wanted).join(within, ["file", "start"])
        )
    text = F.array_join(
        F.transform(
            F.array_sort(F.collect_list(F.struct("start", F.col("piece").cast("string").alias("t")))),
            lambda p: p["t"],
        ),
        "\n",
    )
    made = pieces.groupBy("file", "opened").agg(text.alias("t"), F.first("crlf").alias("crlf"))
    plain = F.regexp_replace(F.regexp_replace("t", "\r\n", "\n"), "\r\\z", "")
    record = F.when(F.col("crlf"), plain).otherwise(F.col("t"))
    return made.select(record.cast("binary").alias("record"))


def _whole_ranges(lines: DataFrame, wanted: set[tuple[int, int]]) -> DataFrame:
    """``file, start, piece`` of ranges that lie within one field."""
    shared = lines.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held = None, []

        def made() -> pa.RecordBatch:
            columns = [pa.array([place[0]]), pa.array([place[1]]), pa.array([_text(held)], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["file", "start", "piece"])

        for file, start, values in _ranges(batches):
            if (file, start) not in shared.value:
                continue
            if place != (file, start):
                if place is not None:
                    yield made()
                place, held = (file, start), []
            held.append(values)
        if place is not None:
            yield made()

    return lines.mapInArrow(run, "file long, start long, piece binary")


def scan_csv_ranges(
    plain: DataFrame,
    paths: list[str],
    schema: StructType,
    options: dict[str, str],
    *,
    recursive: bool = False,
    own: bool = False,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """What ``plain`` reads, with files larger than ``range_bytes`` cut into ranges.

    ``plain`` is Spark's own scan of ``paths`` with ``multiLine``, ``options`` what it was
    given. Smaller files stay with it, and so do files that cannot be cut: those
    with a quote in an unquoted field or text after a closing quote, a quote never
    closed, or a header with a lone carriage return. Lines end with ``\\n``, or with ``\\r\\n``
    in files whose first line does. Rows are the same either way, NULLs, blanks, empty and
    repeated rows included; so is what stops the query: a header that does not
    fit, a malformed row. An empty file has no rows.

    Large files are read twice, and a third time for fields longer than a range. The driver
    sees one row for each range, a field longer than a range becomes one value in one task.
    Texts of the caller's ``OWN`` files (``own``) keep their carriage returns.
    """
    spark = plain.sparkSession
    lines = range_lines(spark, paths, range_bytes, recursive)
    if lines.isEmpty():
        return plain
    states = _with_states(_counted(lines), own)
    found = states.select("file", "start", "inside", "crlf", "whole").collect()
    ranges = _Ranges(found)
    sensitive = spark.conf.get("spark.sql.caseSensitive") == "true"
    records = _records(lines, ranges, schema.fieldNames(), sensitive).unionByName(
        _crossing(lines, states)
    )
    parsing = {k: v for k, v in options.items() if k not in ("header", "enforceSchema", "inferSchema")}
    parsing |= {"mode": "FAILFAST", "multiLine": "true", "lineSep": "\n"}
    row = F.from_csv(F.col("record").cast("string"), schema.toDDL(), parsing)
    rows = records.select(row.alias("r")).select("r.*")
    size, name = F.col("_metadata.file_size"), F.xxhash64("_metadata.file_path")
    uncut: Column = size <= range_bytes
    if ranges.whole:
        uncut = uncut | name.isin(sorted(ranges.whole))
    return plain.where(uncut).unionByName(rows)
