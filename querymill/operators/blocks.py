"""Search in more blocks of points than a driver could hold the boxes of.

The points of each leaf of the sampled tree are put in the order of a curve through the
leaf's box, and neighbours on it are halved into blocks with boxes of their own. The
blocks' boxes are a table, so their number is not bounded by any one machine: ten times the
points give ten times the blocks, each as large as before. A row looks first in the block
nearest to it, and then in every block whose box is not farther away than what it found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from querymill.session import materialize

CODE_BITS = 60
CODE_DIMS = 8  # the widest of a leaf, which the curve runs through
HELD_BLOCKS = 64
GAP_CELLS = 2_000_000  # held in memory at once inside a task


def compare(
    points: DataFrame,
    rows: DataFrame,
    group: list[str],
    dims: list[str],
    chunk_rows: int,
    nearest_in_group,
) -> DataFrame:
    """Nearest point of each row within its groups: ``_key``, features, ``_square``, ``_near``
    and ``_label`` for each row and part of a group.

    Groups with many rows on either side are cut into chunks, and each pair of chunks is
    compared in one task. How many there are is a table, joined to both sides.
    """

    def chunks(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*group).agg(F.ceil(F.count("*") / chunk_rows).cast("int").alias(name))

    met = materialize(
        chunks(rows, "_row_chunks").join(chunks(points, "_point_chunks"), group), "chunks"
    )
    parts = [*group, "_row_chunk", "_point_chunk"]
    left = (
        points.join(met, group)
        .withColumn("_row_chunk", F.explode(F.sequence(F.lit(0), F.col("_row_chunks") - 1)))
        .withColumn("_point_chunk", F.pmod(F.xxhash64("_near"), "_point_chunks").cast("int"))
        .select(*parts, *dims, "_near", "_label")
    )
    right = (
        rows.join(met, group)
        .withColumn("_row_chunk", F.pmod(F.xxhash64("_key"), "_row_chunks").cast("int"))
        .withColumn("_point_chunk", F.explode(F.sequence(F.lit(0), F.col("_point_chunks") - 1)))
        .select(*parts, *dims, "_key")
    )
    types = {f.name: f.dataType.simpleString() for f in [*points.schema, *rows.schema]}
    schema = ", ".join(
        [f"_key {types['_key']}", *[f"{d} double" for d in dims]]
        + ["_square double", f"_near {types['_near']}", f"_label {types['_label']}"]
    )
    return left.groupBy(*parts).cogroup(right.groupBy(*parts)).applyInPandas(nearest_in_group, schema)


def _with_codes(points: DataFrame, boxes: pd.DataFrame, dims: list[str]) -> DataFrame:
    """``points`` with their place on a Z-shaped curve through the box of their leaf."""
    place = {leaf: i for i, leaf in enumerate(boxes["_leaf"])}
    leaves = np.array(list(place))
    low = boxes[[f"lo{d}" for d in dims]].to_numpy(dtype=np.float64)
    wide = boxes[[f"hi{d}" for d in dims]].to_numpy(dtype=np.float64) - low
    used = min(CODE_DIMS, len(dims))
    widest = np.argsort(-wide, axis=1, kind="stable")[:, :used]
    bits = CODE_BITS // used

    @F.pandas_udf("long")
    def code_of(leaf: pd.Series, *features: pd.Series) -> pd.Series:
        values = np.column_stack([f.to_numpy(dtype=np.float64) for f in features])
        at = np.searchsorted(leaves, leaf.to_numpy())
        rows = np.arange(len(values))
        cells = np.zeros((used, len(values)), np.int64)
        for i in range(used):
            d = widest[at, i]
            with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
                share = (values[rows, d] - low[at, d]) / wide[at, d]
            share = np.nan_to_num(share, nan=0.0, posinf=0.0, neginf=0.0)
            cells[i] = np.clip(share * (1 << bits), 0, (1 << bits) - 1).astype(np.int64)
        code = np.zeros(len(values), np.int64)
        for bit in range(bits - 1, -1, -1):
            for i in range(used):
                code = (code << 1) | ((cells[i] >> bit) & 1)
        return pd.Series(code)

    return points.withColumn("_code", code_of("_leaf", *dims))


def _halves(values: np.ndarray, block_rows: int) -> np.ndarray:
    """A number for each row's block: rows are halved by their widest feature until no more
    than ``block_rows`` are left together."""
    block = np.zeros(len(values), np.int64)
    todo, number = [np.arange(len(values))], 0
    while todo:
        rows = todo.pop()
        if len(rows) <= block_rows:
            block[rows] = number
            number += 1
            continue
        widest = int(np.argmax(np.ptp(values[rows], axis=0)))
        half = len(rows) // 2
        order = np.argpartition(values[rows, widest], half)
        todo += [rows[order[:half]], rows[order[half:]]]
    return block


def _cut(points: DataFrame, dims: list[str], block_rows: int) -> DataFrame:
    """``points``, ordered by leaf and code, with ``_block``.

    A task holds some dozens of blocks of neighbours on the curve, and halves them into
    blocks, so that no box spans a turn of the curve.
    """
    held_rows = HELD_BLOCKS * block_rows

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 32
        held: list[pd.DataFrame] = []

        def made() -> pd.DataFrame:
            nonlocal number
            rows = pd.concat(held, ignore_index=True)
            held.clear()
            block = _halves(rows[dims].to_numpy(dtype=np.float64), block_rows)
            rows = rows.assign(_block=block + number)
            number += int(block.max()) + 1
            return rows

        for rows in batches:
            leaf = rows["_leaf"].to_numpy()
            ends = [*(np.flatnonzero(leaf[1:] != leaf[:-1]) + 1).tolist(), len(leaf)]
            start = 0
            for end in ends if len(leaf) else []:
                if held and held[-1]["_leaf"].iloc[-1] != leaf[start]:
                    yield made()
                held.append(rows.iloc[start:end])
                if sum(map(len, held)) >= held_rows:
                    yield made()
                start = end
        if held:
            yield made()

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in points.schema)
    return points.mapInPandas(run, f"{schema}, _block long")


def _chosen(rows: DataFrame, boxes: DataFrame, dims: list[str], chunk_rows: int) -> DataFrame:
    """``_key``, features and ``_block`` for the blocks that each row of
    ``rows(_key, features, _leaf, _square, _met)`` has to see in its leaf: the nearest one
    if ``_square`` is infinite, else all within that squared distance but ``_met``."""

    def choose(blocks: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        columns = ["_key", *dims]
        if blocks.empty or asked.empty:
            return asked[columns].iloc[:0].assign(_block=0)
        low = blocks[[f"lo{d}" for d in dims]].to_numpy(dtype=np.float64)
        high = blocks[[f"hi{d}" for d in dims]].to_numpy(dtype=np.float64)
        number = blocks["_block"].to_numpy()
        points = asked[dims].to_numpy(dtype=np.float64)
        bounds = asked["_square"].to_numpy(dtype=np.float64)
        met = asked["_met"].to_numpy()
        rows_at, blocks_at = [], []
        step = max(1, GAP_CELLS // len(number))
        for first in range(0, len(points), step):
            block = points[first : first + step]
            gaps = np.zeros((len(block), len(number)))
            # Summed as distances are: a gap never exceeds the distance to a point inside.
            for d in range(len(dims)):
                x = block[:, d, None]
                gap = np.maximum(np.maximum(low[:, d] - x, x - high[:, d]), 0.0)
                gaps += gap * gap
            bound = bounds[first : first + step]
            near = (gaps <= bound[:, None]) & (number != met[first : first + step, None])
            seed = np.flatnonzero(np.isinf(bound))
            near[seed] = False
            near[seed, gaps[seed].argmin(axis=1)] = True
            i, j = np.nonzero(near)
            rows_at.append(i + first)
            blocks_at.append(number[j])
        out = asked[columns].iloc[np.concatenate(rows_at)].reset_index(drop=True)
        return out.assign(_block=np.concatenate(blocks_at))

    counts = rows.groupBy("_leaf").agg(F.ceil(F.count("*") / chunk_rows).cast("int").alias("_chunks"))
    counts = materialize(counts, "asked")  # a row for each leaf of the tree
    many = F.sequence(F.lit(0), F.col("_chunks") - 1)
    left = boxes.join(F.broadcast(counts), "_leaf").withColumn("_chunk", F.explode(many))
    right = rows.join(F.broadcast(counts), "_leaf").withColumn(
        "_chunk", F.pmod(F.xxhash64("_key"), "_chunks").cast("int")
    )
    key_type = rows.schema["_key"].dataType.simpleString()
    schema = ", ".join([f"_key {key_type}", *[f"{d} double" for d in dims], "_block long"])
    group = ["_leaf", "_chunk"]
    return (
        left.drop("_chunks")
        .groupBy(*group)
        .cogroup(right.drop("_chunks").groupBy(*group))
        .applyInPandas(choose, schema)
    )


class BlockSearch:
    """Points of a tree's leaves, cut into blocks."""

    def __init__(
        self,
        points: DataFrame,
        leaf_boxes: pd.DataFrame,
        dims: list[str],
        block_rows: int,
        chunk_rows: int,
        nearest_in_group,
    ) -> None:
        self.dims, self.chunk_rows = dims, chunk_rows
        self.nearest_in_group = nearest_in_group
        ordered = _with_codes(points, leaf_boxes, dims).repartitionByRange("_leaf", "_code")
        ordered = ordered.sortWithinPartitions("_leaf", "_code").drop("_code")
        # Written before anything looks at a block: a number means one set of points.
        self.points = materialize(_cut(ordered, dims, block_rows), "blocks")
        self.boxes = materialize(
            self.points.groupBy("_leaf", "_block").agg(
                *[F.min(d).alias(f"lo{d}") for d in dims], *[F.max(d).alias(f"hi{d}") for d in dims]
            ),
            "boxes",
        )
        self.visits = 0  # pairs of a row and a block

    def _visit(self, asked: DataFrame) -> DataFrame:
        chosen = materialize(_chosen(asked, self.boxes, self.dims, self.chunk_rows), "chosen")
        self.visits += chosen.count()
        found = compare(
            self.points, chosen, ["_block"], self.dims, self.chunk_rows, self.nearest_in_group
        )
        best = found.groupBy("_key", *self.dims).agg(
            F.min(F.struct("_square", "_near", "_label")).alias("_best")
        )
        first = chosen.groupBy("_key").agg(F.min("_block").alias("_met"))
        return materialize(best.join(first, "_key"), "best")

    def run(self, rows: DataFrame, leaves_of) -> DataFrame:
        """``_key`` and ``_best`` for every row; ``leaves_of(start, width)`` gives the leaves
        near enough as a function of the best squared distance and the features."""
        infinite = F.lit(float("inf"))
        nearest = F.explode(leaves_of(0, 1)(infinite, *self.dims)).alias("_leaf")
        none = F.lit(-1).cast("long").alias("_met")
        asked = rows.select("_key", *self.dims, nearest, infinite.alias("_square"), none)
        seed = self._visit(materialize(asked, "asked"))
        every = leaves_of(0, 1 << 30)("_best._square", *self.dims)
        square = F.col("_best._square").alias("_square")
        again = seed.select("_key", *self.dims, F.explode(every).alias("_leaf"), square, "_met")
        rest = self._visit(materialize(again, "asked"))
        both = seed.select("_key", "_best").unionByName(rest.select("_key", "_best"))
        return both.groupBy("_key").agg(F.min("_best").alias("_best"))
