"""Limit, preview and latest row per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def limit_rows(
    df: DataFrame, n: int, order_by: Sequence[str | Column] = ()
) -> DataFrame:
    """At most ``n`` rows: any rows, or the first ``n`` in the given order.

    The kept rows pass through one task, so ``n`` is meant to be small (a report
    or a row cap). With an order, each task keeps only its own first ``n``.
    """
    if n < 0:
        raise ValueError("n must not be negative")
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def preview(df: DataFrame, n: int = 5, order_by: Sequence[str | Column] = ()) -> DataFrame:
    """A few rows to look at."""
    return limit_rows(df, n, order_by)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]
) -> DataFrame:
    """The row with the greatest ``order_by`` values in each group.

    An aggregate and not a window: every task first reduces its rows to one per
    key, so a key that holds a third of the table still shuffles as a handful of
    rows. Give enough ``order_by`` columns to leave no ties.
    """
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(*order_by)
    if not rest:
        return df.distinct()
    return (
        df.groupBy(*[F.col(f"`{k}`") for k in keys])
        .agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), order).alias("_latest"))
        .select(*[F.col(f"`{k}`") for k in keys], "_latest.*")
        .select(*[F.col(f"`{c}`") for c in df.columns])
    )


# ---------------------------------------------------------------- many rows in order

SPLITTERS = 32  # ranges that one pass tells apart
SAMPLE = 64 * SPLITTERS
FEW = 10_000  # rows whose order the driver may see
_AS_TEXT = ("timestamp_ntz", "date", "decimal")
_AS_IS = ("tinyint", "smallint", "int", "bigint", "string", "boolean", "binary")
_FLOATS = ("float", "double")


class _Order:
    """A row order by columns: comparisons of rows with given places in it.

    NULL comes first and NaN last when ascending, as in Spark's own sort.
    """

    def __init__(self, df: DataFrame, columns: Sequence[str], descending: Sequence[bool]) -> None:
        self.columns, self.descending = list(columns), list(descending)
        self.types = [df.schema[c].dataType.simpleString() for c in columns]
        for name, kind in zip(self.columns, self.types, strict=True):
            if kind != "timestamp" and not kind.startswith(_AS_TEXT + _AS_IS + _FLOATS):
                raise TypeError(f"cannot order by {name}: {kind}")

    def sort(self) -> list[Column]:
        pairs = zip(self.columns, self.descending, strict=True)
        return [F.desc(f"`{c}`") if down else F.asc(f"`{c}`") for c, down in pairs]

    def values(self) -> list[Column]:
        """The columns in a form whose Python values turn back into the same literals."""
        found = []
        for name, kind in zip(self.columns, self.types, strict=True):
            value = F.col(f"`{name}`")
            if kind == "timestamp":
                value = F.unix_micros(value)
            elif kind.startswith(_AS_TEXT):
                value = value.cast("string")
            elif kind in _FLOATS:
                # As text NaN equals itself; a negative zero becomes a plain one.
                value = (value + F.lit(0.0)).cast("string")
            found.append(value.alias(f"_{len(found)}"))
        return found

    def _literal(self, value: object, kind: str) -> Column:
        if kind == "timestamp":
            return F.timestamp_micros(F.lit(value))
        return F.lit(value).cast(kind)

    def sides(self, i: int, value: object) -> tuple[Column, Column, Column]:
        """Whether column ``i`` comes before ``value``, equals it, comes at it or before."""
        column, literal = F.col(f"`{self.columns[i]}`"), self._literal(value, self.types[i])
        if value is None:
            equal = column.isNull()
            before = column.isNotNull() if self.descending[i] else F.lit(False)
            return before, equal, before | equal
        equal = column.eqNullSafe(literal)
        if self.types[i] in _FLOATS:
            # NaN stated apart: statistics of cached tables leave it out.
            nan = F.isnan(column)
            if value == "NaN":
                before = F.lit(False) if self.descending[i] else ~nan
                return before, nan, nan if self.descending[i] else F.lit(True)
            if self.descending[i]:
                above = nan | (column.isNotNull() & (column > literal))
                return above, equal, above | equal
        if self.descending[i]:
            known = column.isNotNull()
            return known & (column > literal), equal, known & (column >= literal)
        return column.isNull() | (column < literal), equal, column.isNull() | (column <= literal)

    def before(self, place: tuple, or_equal: bool = False) -> Column:
        """Whether a row comes before ``place``; the first column alone is stated, too, which
        scans can use."""
        found: Column = F.lit(or_equal)
        for i in range(len(place) - 1, -1, -1):
            before, equal, at_most = self.sides(i, place[i])
            found = before | (equal & found)
            if i == 0:
                found = at_most & F.coalesce(found, F.lit(False))
        return found

    def equal(self, place: tuple) -> Column:
        found = F.lit(True)
        for i, value in enumerate(place):
            found = found & self.sides(i, value)[1]
        return found


def _place_of(df: DataFrame, order: _Order, n: int, size: int) -> tuple[tuple, int]:
    """The place in the order that the ``n``-th of ``size`` rows has, and how many rows lie
    before it.

    Counts by range narrow down the range that holds it, in the first column until one
    value is left, then among the rows of that value in the next. Each pass reads the
    columns so far and sends the driver one count for each range. What lies at a splitter is
    counted apart, so a value that many rows share is found and does not stall the search.
    """
    inside, passed, seed, column = df, 0, 0, 0
    while size > FEW and column < len(order.columns):
        seed += 1
        value, sort = order.values()[column], order.sort()[column]
        some = inside.sample(min(1.0, 2.0 * SAMPLE / size), seed=seed)
        ordered = some.orderBy(sort).limit(4 * SAMPLE).select(value)
        sample = [r[0] for r in ordered.collect()]
        if not sample:
            continue
        step = max(1, len(sample) // SPLITTERS)
        splitters = list(dict.fromkeys(sample[step // 2 :: step]))
        place = F.lit(0)
        for one in splitters:
            before, equal, _ = order.sides(column, one)
            place += F.when(before, 0).when(equal, 1).otherwise(2)
        counts = dict(map(tuple, inside.groupBy(place.alias("place")).count().collect()))
        for number in sorted(counts):
            size = counts[number]
            if passed + size >= n:
                break
            passed += size
        low, odd = divmod(number, 2)
        if odd:
            inside = inside.where(order.sides(column, splitters[low])[1])
            column += 1
            continue
        if low > 0:
            inside = inside.where(~order.sides(column, splitters[low - 1])[2])
        if low < len(splitters):
            inside = inside.where(order.sides(column, splitters[low])[0])
    here = inside.orderBy(*order.sort()).select(*order.values())
    if column == len(order.columns):
        return tuple(here.first()), passed
    places = [tuple(r) for r in here.limit(n - passed).collect()]
    return places[-1], passed + places.index(places[-1])


def first_rows(
    df: DataFrame, n: int, order_by: Sequence[str], descending: bool | Sequence[bool] = False
) -> DataFrame:
    """The first ``n`` rows in the order of the given columns, for any ``n``.

    Spark's own ordered limit passes all kept rows through one task. Here the place of the
    n-th row is found first, by counts in narrowing ranges, and the result is a filter on
    ``df``: no shuffle, and a bound on the first column that scans push down. Rows come in
    no particular order. Of rows that are equal in ``order_by`` and do not all fit, those
    with the smallest hashes of the whole row are taken; of equal rows, as many as are due.

    ``df`` is read a few times and has to give the same rows each time: materialise it if
    it is costly or not deterministic. Columns of the order are numbers, texts, booleans,
    bytes, dates or timestamps. NULL comes first (last when descending).
    """
    if n < 0:
        raise ValueError("n must not be negative")
    if isinstance(order_by, str) or not order_by:
        raise ValueError("give a non-empty list of column names")
    down = [descending] * len(order_by) if isinstance(descending, bool) else list(descending)
    order = _Order(df, order_by, down)
    if n == 0:
        return df.where(F.lit(False))
    size = df.count()
    if size <= n:
        return df
    place, before = _place_of(df, order, n, size)
    ties = df.where(order.equal(place))
    n_ties, due = ties.count(), n - before
    if due == n_ties:
        return df.where(order.before(place, or_equal=True))
    return df.where(order.before(place)).unionByName(_some_ties(ties, due, n_ties))


def _some_ties(ties: DataFrame, n: int, size: int) -> DataFrame:
    """``n`` of rows that the order does not tell apart, by the hash of the whole row."""
    columns = [F.col(f"`{c}`") for c in ties.columns]
    name = "_hash"
    while name in ties.columns:
        name += "_"
    hashed = ties.withColumn(name, F.xxhash64(*columns))
    order = _Order(hashed, [name], [False])
    place, before = _place_of(hashed, order, n, size)
    last = hashed.where(order.equal(place)).drop(name)
    rest = hashed.where(order.before(place)).drop(name)
    # Equal rows, unless a hash of 64 bits was met twice: as many copies as are due.
    spark, due = ties.sparkSession, n - before
    for row in last.groupBy(*columns).agg(F.count("*").alias("_n")).collect():
        copies = min(due, row["_n"])
        if copies:
            one = spark.createDataFrame([tuple(row)[:-1]], ties.schema).withColumn("_one", F.lit(0))
            numbers = spark.range(copies).select((F.col("id") * 0).cast("int").alias("_one"))
            rest = rest.unionByName(numbers.join(F.broadcast(one), "_one").drop("_one"))
        due -= copies
    return rest
