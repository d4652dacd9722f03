"""What several operators of this subpackage share."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: a word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
WORDS = re.compile(WORD)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once for each row.

    Spark copies a column's expression to every place that names it, within lambdas
    even into their loops.
    """
    return F.transform(F.array(value), body)[0]


def drawn(rows: DataFrame, wanted: Column, h: Column, n: int) -> DataFrame:
    """``wanted`` rows whose hash ``h`` (64 bits) lies in a range that holds about the ``2 n``
    least of theirs; all of them, if there are few.

    For a sample of ``n``: the range needs one number from a pass over the hashes, and only
    what lies in it is gathered.
    """
    distinct = rows.where(wanted).agg(F.approx_count_distinct(h, 0.05)).first()[0]
    share = 2 * n / max(distinct, 1)
    # The hash first: it is cheaper than what is wanted.
    return rows.where(wanted if share >= 1 else (h <= int(-(2**63) + share * 2**64)) & wanted)


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Groups of two rows or more, of rows that come sorted by integer keys."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        if rest is not None:
            rows = pa.concat_tables([rest, rows])
        found = np.stack([rows.column(k).to_numpy() for k in keys])
        ends = np.flatnonzero((found[:, 1:] != found[:, :-1]).any(axis=0)) + 1
        at = 0
        for end in ends.tolist():
            if end - at > 1:
                yield rows.slice(at, end - at)
            at = end
        rest = rows.slice(at)
    if rest is not None and rest.num_rows > 1:
        yield rest
