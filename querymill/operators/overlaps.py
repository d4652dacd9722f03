"""Interval overlap join without comparing every pair."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from querymill.functions.dates import ordered_number

GROWTH = 4.0  # of the bins' width from level to level
MAX_LEVELS = 60


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    left_ends: tuple[str, str],
    right_ends: tuple[str, str],
    keys: Sequence[str] = (),
    *,
    closed: bool = True,
) -> DataFrame:
    """All pairs of rows with equal ``keys`` whose intervals overlap.

    An interval is ``[start, end]``, or ``[start, end)`` with ``closed=False``; ends are
    numbers, dates or timestamps, of one type on both sides. An interval with a NULL or
    NaN end, with its end before its start, or an empty half-open one, overlaps nothing;
    infinite ends are allowed. NULL keys match nothing. Repeated rows make repeated
    pairs. Columns of both sides appear, keys once; other names must not clash.

    Intervals are sorted into levels by length, and each level has bins four times as wide
    as the level below. An interval touches at most two bins of its own level. It meets
    intervals of its own level there and shorter ones, which are entered at every longer
    interval's level. So a long interval costs no more entries than a short one, and
    what is compared lies within two bins of the longer one. A pair is kept in the bin where
    the later of the two starts lies, which both have entered: once, with nothing to remove.
    The join is on level, bin and keys; adaptive execution splits bins that hold many rows.
    """
    keys = list(keys)
    clash = (set(left.columns) & set(right.columns)) - set(keys)
    if clash:
        raise ValueError(f"column names clash: {sorted(clash)}")
    kind = left.schema[left_ends[0]].dataType.simpleString()
    for df, ends in ((left, left_ends), (right, right_ends)):
        for end in ends:
            if df.schema[end].dataType.simpleString() != kind:
                raise TypeError("the ends of the intervals differ in type")
    a = _intervals(left, left_ends, keys, kind, closed, "a")
    b = _intervals(right, right_ends, keys, kind, closed, "b")
    extent = _extent(a, b)
    if extent is None:  # no intervals at all
        fields = [*left.schema, *[f for f in right.schema if f.name not in keys]]
        return left.sparkSession.createDataFrame([], StructType(fields))
    low, high, width = extent
    a, b = (_with_level(df, side, low, high, width) for df, side in ((a, "a"), (b, "b")))
    # Levels in use on either side: at most MAX_LEVELS numbers.
    levels = {
        side: sorted(r[0] for r in df.select(f"{side}level").distinct().collect())
        for df, side in ((a, "a"), (b, "b"))
    }
    # Kind 0: a left interval at its own level, right ones as short or shorter. Kind 1: a
    # right interval at its own level, left ones shorter.
    a = _entered(a, "a", levels["b"], own=0, shorter=1, equal=False, low=low, width=width)
    b = _entered(b, "b", levels["a"], own=1, shorter=0, equal=True, low=low, width=width)
    place = ["kind", "at", "bin", *[f"key{i}" for i in range(len(keys))]]
    match = F.lit(True)
    for name in place:
        match &= F.col(f"a{name}") == F.col(f"b{name}")
    later = F.greatest("alow", "blow")
    match &= F.col("abin") == _bin(later, F.col("aat"), low, width)
    if closed:
        match &= (F.col("astart") <= F.col("bend")) & (F.col("bstart") <= F.col("aend"))
    else:
        match &= (F.col("astart") < F.col("bend")) & (F.col("bstart") < F.col("aend"))
    rest = [F.col(f"brow.`{c}`") for c in right.columns if c not in keys]
    return a.join(b, match).select(*[F.col(f"arow.`{c}`") for c in left.columns], *rest)


def _intervals(
    df: DataFrame, ends: tuple[str, str], keys: list[str], kind: str, closed: bool, side: str
) -> DataFrame:
    """Rows with an interval, whole, and its ends also as numbers in the same order.

    Names begin with the side, and the row's own are inside ``row``.
    """
    start, end = (F.col(f"`{e}`") for e in ends)
    real = start <= end if closed else start < end
    if kind in ("float", "double"):
        real &= ~F.isnan(start) & ~F.isnan(end)
    return df.where(real).select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(f"{side}row"),
        *[F.col(f"`{k}`").alias(f"{side}key{i}") for i, k in enumerate(keys)],
        start.alias(f"{side}start"),
        end.alias(f"{side}end"),
        ordered_number(start, kind).alias(f"{side}low"),
        ordered_number(end, kind).alias(f"{side}high"),
    )


def _extent(a: DataFrame, b: DataFrame) -> tuple[float, float, float] | None:
    """The finite ends' range, and the width of the lowest level's bins: about the median
    length of the intervals."""
    ends = a.select(F.col("alow").alias("low"), F.col("ahigh").alias("high")).unionByName(
        b.select(F.col("blow").alias("low"), F.col("bhigh").alias("high"))
    )
    infinite = F.lit(float("inf"))
    finite = F.filter(F.array("low", "high"), lambda e: F.abs(e) < infinite)
    length = F.col("high") - F.col("low")
    row = ends.agg(
        F.min(F.array_min(finite)).alias("low"),
        F.max(F.array_max(finite)).alias("high"),
        F.percentile_approx(F.when(length < infinite, length), 0.5, 1000).alias("width"),
        F.percentile_approx(
            F.when((length < infinite) & (length > 0), length), 0.5, 1000
        ).alias("positive"),
        F.count("*").alias("n"),
    ).first()
    if row["n"] == 0:
        return None
    low = row["low"] if row["low"] is not None else 0.0
    high = row["high"] if row["high"] is not None else 0.0
    span = high - low
    # Points alone: as many bins as there are rows.
    width = row["width"] or row["positive"] or span / row["n"] or 1.0
    return low, high, max(width, span / 2**52)


def _with_level(df: DataFrame, side: str, low: float, high: float, width: float) -> DataFrame:
    """Ends within the finite range, and the level whose bins are as wide as the interval."""
    inside = {
        end: F.least(F.greatest(F.col(end), F.lit(low)), F.lit(high))
        for end in (f"{side}low", f"{side}high")
    }
    length = (F.col(f"{side}high") - F.col(f"{side}low")) / width
    level = F.when(length <= 1, 0).otherwise(
        F.least(F.ceil(F.log(GROWTH, length)), F.lit(MAX_LEVELS))
    )
    return df.withColumns(inside).withColumn(f"{side}level", level.cast("int"))


def _bin(value: Column, level: Column, low: float, width: float) -> Column:
    return F.floor((value - low) / (F.pow(F.lit(GROWTH), level) * width)).cast("long")


def _entered(
    df: DataFrame,
    side: str,
    other_levels: list[int],
    *,
    own: int,
    shorter: int,
    equal: bool,
    low: float,
    width: float,
) -> DataFrame:
    """Each interval in the bins that it touches, at its own level and at the levels of the
    other side's longer intervals (and equally long ones, if ``equal``)."""
    level = F.col(f"{side}level")
    others = F.array(*[F.lit(n) for n in other_levels])
    above = F.filter(others, lambda n: n >= level if equal else n > level)
    places = F.concat(
        F.array(F.struct(F.lit(own).alias("kind"), level.alias("level"))),
        F.transform(above, lambda n: F.struct(F.lit(shorter).alias("kind"), n.alias("level"))),
    )
    placed = df.withColumn(f"{side}place", F.explode(places)).withColumns(
        {
            f"{side}kind": F.col(f"{side}place.kind"),
            f"{side}at": F.col(f"{side}place.level"),
        }
    )
    first, last = (
        _bin(F.col(f"{side}{end}"), F.col(f"{side}at"), low, width) for end in ("low", "high")
    )
    return placed.withColumn(f"{side}bin", F.explode(F.sequence(first, last)))
