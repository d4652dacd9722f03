"""How rows are spread over tasks and files."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import wraps

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from querymill.functions.dates import ordered_number


def _checked(cols: Sequence[str]) -> list[str]:
    if isinstance(cols, str) or not cols:
        raise ValueError("give a non-empty list of column names")
    return list(cols)


def distribute(df: DataFrame, cols: Sequence[str], hot_keys: str = "split") -> DataFrame:
    """Hash-shuffle rows by ``cols``.

    ``hot_keys="split"`` (default) lets adaptive execution cut a partition that
    is too large into several tasks and merge tiny ones. One (year, month) may
    hold a third of the table, and a single task could not write that.
    ``hot_keys="together"`` keeps all rows of a key in one task, for readers
    of single partitions that need it; the largest key then bounds the job.
    """
    cols = _checked(cols)
    if hot_keys == "split":
        return df.hint("rebalance", *cols)
    if hot_keys == "together":
        return df.repartition(*cols)
    raise ValueError("hot_keys must be 'split' or 'together'")


def repartition_by(
    cols: Sequence[str], hot_keys: str = "split"
) -> Callable[[Callable[..., DataFrame]], Callable[..., DataFrame]]:
    """Decorator: shuffle the DataFrame a function returns by ``cols``."""
    cols = _checked(cols)

    def decorate(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @wraps(function)
        def shuffled(*args, **kwargs) -> DataFrame:
            return distribute(function(*args, **kwargs), cols, hot_keys)

        return shuffled

    return decorate


def interleaved(df: DataFrame, cols: Sequence[str], bits: int = 8) -> DataFrame:
    """Range-shuffle and sort rows so that rows near in all of ``cols`` lie together.

    Written files and row groups then span little of each column, and a filter on any of
    them skips most. Each column's values become ranks of ``bits`` bits by approximate
    quantiles, whatever their spread, and the ranks' bits interleaved make the order. NULL
    and NaN rank highest. Columns are numbers, dates or timestamps; the driver sees
    ``2**bits - 1`` bounds a column. Rows of equal rank are spread by hash, so a value that a
    third of the rows share is no single task.
    """
    cols = _checked(cols)
    if bits < 1 or bits * len(cols) > 62:
        raise ValueError("bits times the number of columns must be 1 to 62")
    values = {
        c: ordered_number(F.col(f"`{c}`"), df.schema[c].dataType.simpleString()) for c in cols
    }
    shares = [i / 2**bits for i in range(1, 2**bits)]
    known = df.agg(
        *[
            F.percentile_approx(F.when(~F.isnan(v), v), shares, 50 * 2**bits).alias(f"q{i}")
            for i, v in enumerate(values.values())
        ]
    ).first()
    taken = set(df.columns)

    def fresh(name: str) -> str:
        while name in taken:
            name += "_"
        taken.add(name)
        return name

    ranks, code = [], F.lit(0).cast("long")
    rows = df
    for i, value in enumerate(values.values()):
        bounds = sorted({b for b in known[f"q{i}"] or [] if abs(b) != float("inf")})
        number, rank = fresh("_number"), fresh("_rank")
        if bounds:
            cut = Bucketizer(
                splits=[-float("inf"), *bounds, float("inf")],
                inputCol=number,
                outputCol=rank,
                handleInvalid="keep",
            )
            present = F.coalesce(value, F.lit(float("nan")))
            rows = cut.transform(rows.withColumn(number, present)).drop(number)
            ranks.append((rank, F.least(F.col(rank), F.lit(2**bits - 1)).cast("long")))
    for bit in range(bits - 1, -1, -1):
        for _, rank in ranks:
            code = F.shiftleft(code, 1).bitwiseOR(F.shiftright(rank, bit).bitwiseAND(F.lit(1)))
    place, spread = fresh("_place"), fresh("_spread")
    whole: list[Column] = [F.col(f"`{c}`") for c in df.columns]
    placed = rows.withColumns({place: code, spread: F.xxhash64(*whole)})
    ordered = placed.repartitionByRange(place, spread).sortWithinPartitions(place)
    return ordered.select(*whole)
