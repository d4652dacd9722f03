"""As-of join: each row with the last row of another table at or before its time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from querymill.functions.dates import ordered_number
from querymill.session import materialize

ROWS_PER_BUCKET = 1_000_000
MAX_BUCKETS = 4096  # bounds on the driver, a number each
ACCURACY = 10_000


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    *,
    strict: bool = False,
    ties: Sequence[str] = (),
    rename: str = "{}",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """``left`` with the columns of the last ``right`` row of equal ``keys`` whose time is not
    after the row's own (before it, with ``strict``); NULL where there is none.

    Of right rows with one key and time the one with the greatest ``ties`` counts, by default
    that with the greatest other columns, so give ``ties`` where these have no order. Right
    columns but the keys are named by ``rename``, a pattern such as ``"last_{}"``; names that
    clash are refused. NULL or NaN times and NULL keys match nothing; every left row, repeated
    ones included, appears once.

    Both sides are united and sorted by key and time, which one window then reads, holding
    a row at a time. Keys are cut by time into buckets of about ``rows_per_bucket`` rows, so
    that one key may hold most rows; the last right row of a key's earlier buckets is carried
    over the edge, a row for each key and bucket. Times are compared as they are; the
    buckets' bounds come from approximate quantiles and only say where to cut.
    """
    keys = list(keys)
    rest = [c for c in right.columns if c not in keys]
    names = {c: rename.format(c) for c in rest}
    if set(names.values()) & set(left.columns):
        raise ValueError(f"column names clash: {sorted(set(names.values()) & set(left.columns))}")
    kind = left.schema[left_time].dataType.simpleString()
    if kind != right.schema[right_time].dataType.simpleString():
        raise TypeError("the two times differ in type")

    def known(df: DataFrame, time: str) -> Column:
        present = F.col(f"`{time}`").isNotNull()
        if kind in ("float", "double"):
            present &= ~F.isnan(f"`{time}`")
        for key in keys:
            present &= F.col(f"`{key}`").isNotNull()
        return present

    # One right row for each key and time, found before anything is sorted.
    order = F.struct(*[F.col(f"`{c}`") for c in (ties or [c for c in rest if c != right_time] or rest)])
    content = F.struct(*[F.col(f"`{c}`").alias(names[c]) for c in rest])
    rights = (
        right.where(known(right, right_time))
        .groupBy(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)],
                 F.col(f"`{right_time}`").alias("_time"))
        .agg(F.max_by(content, order).alias("_right"))
    )
    lefts = left.select(
        *[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col(f"`{left_time}`").alias("_time"),
        F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("_left"),
        known(left, left_time).alias("_known"),
    )
    group = [f"_k{i}" for i in range(len(keys))]
    empty_left, empty_right = (F.lit(None).cast(t) for t in (
        lefts.schema["_left"].dataType, rights.schema["_right"].dataType))
    # At equal times a right row comes first, or last where it must not be seen.
    both = lefts.where("_known").select(
        *group, "_time", F.lit(1).alias("_side"), "_left", empty_right.alias("_right")
    ).unionByName(
        rights.select(
            *group, "_time", F.lit(2 if strict else 0).alias("_side"),
            empty_left.alias("_left"), "_right",
        )
    )
    both = _with_buckets(both, left, right, left_time, right_time, kind, rows_per_bucket)
    part = [*group, "_bucket"]
    upto = Window.partitionBy(*part).orderBy("_time", "_side").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    met = both.withColumn("_met", F.last("_right", ignorenulls=True).over(upto)).where("_side = 1")
    if "_carry" in both.columns:
        met = met.withColumn("_met", F.coalesce("_met", "_carry"))
    unknown = lefts.where("NOT _known").select("_left", empty_right.alias("_met"))
    return (
        met.select("_left", "_met")
        .unionByName(unknown)
        .select("_left.*", *[F.col(f"_met.`{names[c]}`").alias(names[c]) for c in rest])
    )


def _with_buckets(
    both: DataFrame,
    left: DataFrame,
    right: DataFrame,
    left_time: str,
    right_time: str,
    kind: str,
    rows_per_bucket: int,
) -> DataFrame:
    """``both`` with ``_bucket`` and, where there are several, ``_carry``: the last right row
    of the key in the buckets before."""
    times = left.select(ordered_number(F.col(f"`{left_time}`"), kind).alias("t")).unionByName(
        right.select(ordered_number(F.col(f"`{right_time}`"), kind).alias("t"))
    )
    size = times.count()
    n = min(MAX_BUCKETS, -(-size // rows_per_bucket))
    bounds: list[float] = []
    if n > 1:
        shares = [i / n for i in range(1, n)]
        found = times.agg(F.percentile_approx("t", shares, ACCURACY)).first()[0] or []
        bounds = sorted({b for b in found if b == b and abs(b) != float("inf")})
    if not bounds:
        return both.withColumn("_bucket", F.lit(0))
    group = [c for c in both.columns if c.startswith("_k")]
    cut = Bucketizer(
        splits=[-float("inf"), *bounds, float("inf")], inputCol="_number", outputCol="_bucket"
    )
    numbered = both.withColumn("_number", ordered_number(F.col("_time"), kind))
    both = cut.transform(numbered).withColumn("_bucket", F.col("_bucket").cast("int")).drop("_number")
    both = materialize(both, "sides")
    last = (
        both.where("_right IS NOT NULL")
        .groupBy(*group, "_bucket")
        .agg(F.max_by("_right", "_time").alias("_last"))
    )
    # A row for each bucket of a key, also where it has left rows only.
    seen = both.select(*group, "_bucket").distinct().join(last, [*group, "_bucket"], "left")
    earlier = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carry = seen.select(
        *group, "_bucket", F.last("_last", ignorenulls=True).over(earlier).alias("_carry")
    )
    return both.join(carry, [*group, "_bucket"])
