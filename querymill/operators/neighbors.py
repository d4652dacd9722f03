"""Exact nearest-neighbour prediction without comparing every pair.

Training points are cut into leaves by a small tree of axis splits, and each leaf
keeps the bounding box of its points. A test row is compared with the points of
the leaf whose box is nearest; the distance found rules out every leaf whose box
lies farther away. What is left is visited in rounds, nearest boxes first, until
no box is near enough. The tree comes from a sample, but a poor sample can only
cost time: the result is that of comparing all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from querymill.operators.blocks import BlockSearch
from querymill.session import materialize

# Bounds on what reaches the driver: the tree, one box per leaf, and the sample.
MAX_LEAVES = 8192
SAMPLE_ROWS = 16 * MAX_LEAVES
SAMPLE_CELLS = 8 * SAMPLE_ROWS

# Distances held in memory at once inside a task.
BLOCK_CELLS = 2_000_000

# Features from which a matrix product first tells which distances are worth summing.
PRODUCT_FEATURES = 16


def nearest_neighbor(
    test: DataFrame,
    train: DataFrame,
    key: str,
    label: str,
    features: Sequence[str],
    leaf_rows: int = 2048,
    chunk_rows: int = 16_384,
    max_leaves: int = MAX_LEAVES,
) -> DataFrame:
    """Label of the training row nearest to each test row.

    Euclidean distance in double precision; of equally near rows the one with
    the smallest key counts. ``key`` identifies a row. Made for few dimensions: with
    dozens of unrelated ones boxes rule out little, and nearly all pairs are compared,
    most of them by a matrix product alone. Where ``max_leaves`` leaves of ``leaf_rows`` are
    not enough for the points, leaves are cut further into blocks (see ``blocks``), and what
    a row compares does not grow with the points. Returns ``key``,
    ``nearest_key``, ``predicted`` and ``distance`` for every test row.
    """
    dims = [f"_f{i}" for i in range(len(features))]
    point = [_present(name).alias(dim) for name, dim in zip(features, dims, strict=True)]
    # Equal points give equal distances, so the smallest key of them is enough,
    # and no number of copies makes a leaf large.
    points = materialize(
        train.select(*point, F.struct(F.col(key).alias("k"), F.col(label).alias("l")).alias("n"))
        .groupBy(*dims)
        .agg(F.min("n").alias("n"))
        .select(*dims, F.col("n.k").alias("_near"), F.col("n.l").alias("_label")),
        "points",
    )
    size = points.count()
    if size == 0:
        raise ValueError("no training rows")
    wanted = math.ceil(math.log2(max(size / leaf_rows, 1)))
    depth = min(wanted, int(math.log2(max_leaves)))
    leaf_of = _leaf_function(_sampled_tree(points.select(*dims), size, depth), depth)
    # Stored by leaf, so that a round's scan skips the files of other leaves.
    leaved = points.withColumn("_leaf", leaf_of(*dims))
    points = materialize(leaved.repartitionByRange("_leaf") if depth else leaved, "leaves")
    boxes = (
        points.groupBy("_leaf")
        .agg(
            F.count("*").alias("rows"),
            *[F.min(d).alias(f"lo{d}") for d in dims],
            *[F.max(d).alias(f"hi{d}") for d in dims],
        )
        .toPandas()
        .sort_values("_leaf", ignore_index=True)
    )
    rows = test.select(F.col(key).alias("_key"), *point)
    if wanted > depth:
        blocks = BlockSearch(points, boxes, dims, leaf_rows, chunk_rows, _nearest_in_group(dims))
        best = blocks.run(rows, lambda start, width: _nearest_leaves(boxes, dims, start, width))
    else:
        search = _LeafSearch(points, boxes, dims, chunk_rows)
        label_type = train.schema[label].dataType.simpleString()
        best = _visit_leaves(rows, search, boxes, dims, label_type)
    return best.select(
        F.col("_key").alias(key),
        F.col("_best._near").alias("nearest_key"),
        F.col("_best._label").alias("predicted"),
        F.sqrt("_best._square").alias("distance"),
    )


def _visit_leaves(
    rows: DataFrame, search: _LeafSearch, boxes: pd.DataFrame, dims: list[str], label_type: str
) -> DataFrame:
    """Best point of each row, over rounds of 1, 8, 64, ... leaves per row.

    A row leaves the rounds once its best distance is below the gap to the next
    box. Most do so after one or two, so later rounds see few rows.
    """
    start, width = 0, 1
    first = _nearest_leaves(boxes, dims, start, width)
    asked = rows.withColumn("_leaf", F.explode(first(F.lit(float("inf")), *dims)))
    waiting: DataFrame | None = None
    done: list[DataFrame] = []
    while True:
        asked = materialize(asked, "asked")
        found = search.run(asked, label_type).select(
            "_key", *dims, F.struct("_square", "_near", "_label").alias("_best")
        )
        if waiting is not None:
            found = found.unionByName(waiting.select("_key", *dims, "_best"))
        best = found.groupBy("_key", *dims).agg(F.min("_best").alias("_best"))
        start, width = start + width, width * 8
        if start >= len(boxes):
            done.append(best.select("_key", "_best"))
            break
        following = _nearest_leaves(boxes, dims, start, width)("_best._square", *dims)
        best = materialize(best.withColumn("_next", following), "best")
        done.append(best.where(F.size("_next") == 0).select("_key", "_best"))
        waiting = best.where(F.size("_next") > 0)
        if waiting.isEmpty():
            break
        asked = waiting.select("_key", *dims, F.explode("_next").alias("_leaf"))
    return reduce(DataFrame.unionByName, done)


def _present(name: str) -> Column:
    value = F.col(name).cast("double")
    missing = F.raise_error(F.lit(f"{name} has a missing value, or an infinite one")).cast("double")
    infinite = F.abs(value) == float("inf")
    return F.when(value.isNull() | F.isnan(value) | infinite, missing).otherwise(value)


def _sampled_tree(points: DataFrame, size: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Split dimension and split value of each inner node, level by level."""
    inner = 2**depth - 1
    dims, cuts = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
    if inner == 0:
        return dims, cuts
    wanted = min(SAMPLE_ROWS, 64 * 2**depth)
    # The expected number of rows, so of no part of the table more than of another.
    wanted = max(1, min(wanted, SAMPLE_CELLS // len(points.columns)))
    fraction = wanted / size
    sample = points.sample(fraction=fraction, seed=1) if fraction < 1.0 else points
    members = {0: sample.toPandas().to_numpy(dtype=np.float64)}
    for node in range(inner):
        here = members.pop(node)
        if len(here) > 1:
            dim = int(np.argmax(np.ptp(here, axis=0)))
            values = np.sort(here[:, dim])
            below = values[values < values[-1]]
            if len(below):
                dims[node] = dim
                cuts[node] = min(values[(len(values) - 1) // 2], below[-1])
        right = here[:, dims[node]] > cuts[node]
        members[2 * node + 1], members[2 * node + 2] = here[~right], here[right]
    return dims, cuts


def _leaf_function(tree: tuple[np.ndarray, np.ndarray], depth: int):
    """Leaf that the tree leads a point to, as a function of feature columns."""
    if depth == 0:
        return lambda *features: F.lit(0)
    dims, cuts = tree

    @F.pandas_udf("int")
    def leaf_of(*features: pd.Series) -> pd.Series:
        points = np.column_stack([f.to_numpy(dtype=np.float64) for f in features])
        rows = np.arange(len(points))
        node = np.zeros(len(points), dtype=np.int64)
        for _ in range(depth):
            node = 2 * node + 1 + (points[rows, dims[node]] > cuts[node])
        return pd.Series(node - (2**depth - 1), dtype="int32")

    return leaf_of


def _nearest_leaves(boxes: pd.DataFrame, dims: list[str], start: int, width: int):
    """Leaves number ``start`` to ``start + width`` by the gap to their boxes, as a
    function of the best squared distance so far and the features.

    Boxes farther away than that distance are left out. The gap to a box is
    summed as distances are, so rounding cannot make it exceed the distance to a
    point inside.
    """
    if len(boxes) == 1:
        only = int(boxes["_leaf"][0])
        return lambda square, *features: F.array(F.lit(only))
    leaves = boxes["_leaf"].to_numpy(dtype=np.int32)
    low = boxes[[f"lo{d}" for d in dims]].to_numpy(dtype=np.float64)
    high = boxes[[f"hi{d}" for d in dims]].to_numpy(dtype=np.float64)

    def chosen(gaps: np.ndarray, bound: float) -> np.ndarray:
        if start + width == 1:
            return leaves[gaps.argmin() :][:1]
        near = np.flatnonzero(gaps <= bound)
        near = near[np.argsort(gaps[near], kind="stable")]
        return leaves[near[start : start + width]]

    @F.pandas_udf("array<int>")
    def nearest(square: pd.Series, *features: pd.Series) -> pd.Series:
        points = np.column_stack([f.to_numpy(dtype=np.float64) for f in features])
        bounds = square.to_numpy(dtype=np.float64)
        found = []
        step = max(1, BLOCK_CELLS // len(leaves))
        for first in range(0, len(points), step):
            block = points[first : first + step]
            gaps = np.zeros((len(block), len(leaves)))
            for d in range(points.shape[1]):
                x = block[:, d, None]
                gap = np.maximum(np.maximum(low[:, d] - x, x - high[:, d]), 0.0)
                gaps += gap * gap
            found.extend(map(chosen, gaps, bounds[first : first + step]))
        return pd.Series(found, dtype=object)

    return nearest


class _LeafSearch:
    """Compares test rows with the training points of the leaf they name.

    Leaves with many rows on either side are cut into chunks, and each pair of
    chunks is one group, so a group stays within ``chunk_rows`` (about) on both
    sides however the rows are spread.
    """

    def __init__(
        self, points: DataFrame, boxes: pd.DataFrame, dims: list[str], chunk_rows: int
    ) -> None:
        self.points, self.dims, self.chunk_rows = points, dims, chunk_rows
        self.point_rows = boxes.set_index("_leaf")["rows"]

    def run(self, rows: DataFrame, label_type: str) -> DataFrame:
        """Nearest point per row, leaf and chunk, with its squared distance."""
        with_chunks = self._chunks(rows)
        group = ["_leaf", "_row_chunk", "_point_chunk"]
        left = (
            with_chunks(self.points)
            .withColumn("_row_chunk", F.explode(F.sequence(F.lit(0), F.col("_row_chunks") - 1)))
            .withColumn("_point_chunk", F.pmod(F.xxhash64("_near"), "_point_chunks").cast("int"))
            .select(*group, *self.dims, "_near", "_label")
        )
        right = (
            with_chunks(rows)
            .withColumn("_row_chunk", F.pmod(F.xxhash64("_key"), "_row_chunks").cast("int"))
            .withColumn(
                "_point_chunk", F.explode(F.sequence(F.lit(0), F.col("_point_chunks") - 1))
            )
            .select(*group, *self.dims, "_key")
        )
        types = {f.name: f.dataType.simpleString() for f in self.points.schema}
        key_type = rows.schema["_key"].dataType.simpleString()
        schema = ", ".join(
            [f"_key {key_type}", *[f"{d} double" for d in self.dims]]
            + ["_square double", f"_near {types['_near']}", f"_label {label_type}"]
        )
        return (
            left.groupBy(*group)
            .cogroup(right.groupBy(*group))
            .applyInPandas(_nearest_in_group(self.dims), schema)
        )

    def _chunks(self, rows: DataFrame) -> Callable[[DataFrame], DataFrame]:
        """Function that adds the leaf's chunk numbers and drops leaves not asked for.

        The numbers come from exact counts, at most one row per leaf, so they are
        safe to broadcast.
        """
        asked = rows.groupBy("_leaf").count().toPandas().set_index("_leaf")["count"]
        counts = pd.DataFrame({"rows": asked, "points": self.point_rows}).dropna()
        table = np.ceil(counts / self.chunk_rows).astype("int32").reset_index()
        if len(self.point_rows) == 1:
            of_rows, of_points = table.iloc[0, 1:] if len(table) else (1, 1)
            return lambda df: df.withColumns(
                {"_row_chunks": F.lit(int(of_rows)), "_point_chunks": F.lit(int(of_points))}
            )
        wanted = [int(leaf) for leaf in table["_leaf"]]
        chunks = rows.sparkSession.createDataFrame(
            [tuple(map(int, row)) for row in table.itertuples(index=False, name=None)],
            "_leaf int, _row_chunks int, _point_chunks int",
        )
        return lambda df: df.where(F.col("_leaf").isin(wanted)).join(F.broadcast(chunks), "_leaf")


def _by_sums(rows: np.ndarray, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each row's nearest target, the first of equals, and its squared distance."""
    total = np.zeros((len(rows), len(targets)))
    for d in range(targets.shape[1]):
        gap = rows[:, d, None] - targets[:, d]
        total += gap * gap
    first = total.argmin(axis=1)
    return first, total[np.arange(len(rows)), first]


def _by_product(rows: np.ndarray, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same result: distances are summed where a matrix product leaves room.

    ``slack`` is more than the rounding of the product and of a sum together, for two
    targets. What cannot be told, as where a square overflows, is summed.
    """
    with np.errstate(over="ignore", invalid="ignore"):
        own, others = (rows * rows).sum(axis=1), (targets * targets).sum(axis=1)
        about = rows @ targets.T
        about *= -2.0
        about += own[:, None]
        about += others
        rounding = 16 * (rows.shape[1] + 8) * np.finfo(np.float64).eps
        slack = rounding * (own + others.max()) + 1e-300
        i, j = np.nonzero(~(about > (about.min(axis=1) + slack)[:, None]))
        total = np.zeros(len(i))
        for d in range(targets.shape[1]):
            gap = rows[i, d] - targets[j, d]
            total += gap * gap
    square = np.minimum.reduceat(total, np.searchsorted(i, np.arange(len(rows))))
    hits = np.flatnonzero(total == square[i])
    _, first = np.unique(i[hits], return_index=True)
    return j[hits[first]], square


def _nearest_in_group(dims: list[str]):
    def nearest(points: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = rows[["_key", *dims]]
        if points.empty or rows.empty:
            return out.iloc[:0].assign(_square=0.0, _near=None, _label=None)
        # With points in key order the first minimum is the smallest key.
        points = points.sort_values("_near", ignore_index=True)
        targets = points[dims].to_numpy(dtype=np.float64)
        asked = rows[dims].to_numpy(dtype=np.float64)
        place = np.empty(len(asked), dtype=np.int64)
        square = np.empty(len(asked))
        step = max(1, BLOCK_CELLS // len(targets))
        for start in range(0, len(asked), step):
            block = asked[start : start + step]
            nearest_of = _by_sums if len(dims) < PRODUCT_FEATURES else _by_product
            found = nearest_of(block, targets)
            place[start : start + step], square[start : start + step] = found
        near = points.iloc[place].reset_index(drop=True)
        out = out.reset_index(drop=True)
        return out.assign(_square=square, _near=near["_near"], _label=near["_label"])

    return nearest
