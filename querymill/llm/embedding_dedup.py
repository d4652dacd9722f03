"""Near-duplicate vectors by counting collisions of one-dimensional projections.

Vectors of unit length are projected on many random directions. Two vectors collide in
a projection if one lies in the window about the other; vectors of the wanted cosine
collide in at least ``COLLISIONS`` of ``PROJECTIONS`` but for a small chance, and only
pairs that do are compared in full.

A single sorted projection has a fixed share of all vectors within each window, so
windows are not read from one sorted list each: ``tables_for`` the cosine times, ``CELL_PROJECTIONS``
further projections cut space into cells, and pairs are counted within cells, every
pair in all projections. The number of tables is set for the recall. A
crowded cell is cut into blocks and its pairs of blocks go to different tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from querymill.llm.common import groups
from querymill.llm.components import components
from querymill.session import materialize

COSINE = 0.9
RECALL = 0.94  # chance that a pair at the wanted cosine shares a cell
TABLES = 24  # at least; enough for a cosine of 0.9
CELL_PROJECTIONS = 8
CELL_WIDTH = 1.5
# Vectors at the wanted cosine lie within two standard deviations with a chance of
# 0.954, so in 11 or more of 16 projections with one of 0.9999.
PROJECTIONS = 16
COLLISIONS = 11
DEVIATIONS = 2.0
BLOCK = 1024  # vectors of a crowded cell compared with as many others in one task
SEED = 17


def _directions(size: int, seed: int, count: int) -> np.ndarray:
    """Random directions; those for longer vectors go on where shorter ones end."""
    return np.stack(
        [np.random.default_rng([seed, d]).normal(size=count) for d in range(size)]
    ).reshape(size, count)


def tables_for(cosine: float) -> int:
    """Tables in which a pair at ``cosine`` shares a cell with a chance of ``RECALL``."""
    apart = math.sqrt(max(0.0, 2 - 2 * cosine))  # deviation of what parts the pair in a projection
    if not apart:
        return TABLES
    width = CELL_WIDTH / apart
    one = math.erf(width / math.sqrt(2))
    one -= math.sqrt(2 / math.pi) * (1 - math.exp(-width * width / 2)) / width
    return max(TABLES, math.ceil(math.log(1 - RECALL) / math.log1p(-(one**CELL_PROJECTIONS))))


def _unit(rows: list[list[float]]) -> np.ndarray:
    x = np.array(rows, np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _cells(vectors: DataFrame, tables: int) -> DataFrame:
    """``first_id, copies, embedding, cells``: the vector's cell in each table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = tables * CELL_PROJECTIONS
        mix = np.random.default_rng(SEED + 1).integers(1, 2**62, count) * 2 + 1
        known: dict[int, np.ndarray] = {}
        for batch in batches:
            rows = batch.column(2).to_pylist()
            cells: list[np.ndarray | None] = [None] * len(rows)
            for size in {len(r) for r in rows}:
                if size not in known:
                    known[size] = _directions(size, SEED, count)
                mine = [i for i, r in enumerate(rows) if len(r) == size]
                places = _unit([rows[i] for i in mine]) @ known[size]
                offsets = np.linspace(0, CELL_WIDTH, count, endpoint=False)
                steps = np.floor((places + offsets) / CELL_WIDTH).astype(np.int64)
                hashed = (steps * mix).reshape(len(mine), tables, CELL_PROJECTIONS).sum(axis=2)
                hashed ^= hashed >> 31
                hashed += size
                for i, row in zip(mine, hashed, strict=True):
                    cells[i] = row
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cells, pa.list_(pa.int64()))],
                names=["first_id", "copies", "embedding", "cells"],
            )

    return vectors.mapInArrow(
        run, "first_id long, copies long, embedding array<double>, cells array<long>"
    )


_KEY = ["table", "cell", "one", "two"]


def _grouped(cells: DataFrame) -> DataFrame:
    """A row for each vector and group it is compared in.

    ``one`` and ``two`` are the blocks that meet there, ``block`` the vector's own.
    """
    each = cells.select(
        "first_id", "copies", F.posexplode("cells").alias("table", "cell")
    )
    sizes = each.groupBy("table", "cell").count().where("count > 1")
    blocks = F.ceil(F.col("count") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("first_id"), "blocks").cast("int")
    meets = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    return (
        each.join(sizes, ["table", "cell"])
        .withColumn("blocks", blocks)
        .select("first_id", "table", "cell", own.alias("block"), meets)
        .select(
            "first_id",
            "table",
            "cell",
            F.least("block", "other").alias("one"),
            F.greatest("block", "other").alias("two"),
            "block",
        )
    )


def _compare(grouped: DataFrame, cosine: float) -> DataFrame:
    """Links within groups: ``a, b, n``.

    Rows with ``b`` NULL say how many links of ``a`` were found in a group; those with
    ``b`` are enough links to join what hangs together there. Of several tables where
    two vectors meet, the first counts their link.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        window = DEVIATIONS * np.sqrt(2 - 2 * cosine)
        known: dict[int, np.ndarray] = {}
        for table, ids, copies, vectors, cells, sides in map(_unpacked, groups(batches, _KEY)):
            size = vectors.shape[1]
            if size not in known:
                known[size] = _directions(size, SEED + 2, PROJECTIONS)
            i, j = _collisions(vectors @ known[size], window)
            keep = ids[i] != ids[j]
            if sides is not None:
                keep &= sides[i] != sides[j]
            i, j = i[keep], j[keep]
            near = np.einsum("ij,ij->i", vectors[i], vectors[j]) >= cosine
            i, j = i[near], j[near]
            new = ~(cells[i, :table] == cells[j, :table]).any(axis=1)
            i, j = i[new], j[new]
            if not len(i):
                continue
            n = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
            some = np.flatnonzero(n)
            joined = _spanning(i, j, len(ids))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([ids[some], ids[joined[:, 0]]])),
                    pa.array([*[None] * len(some), *ids[joined[:, 1]].tolist()], pa.int64()),
                    pa.array(
                        np.concatenate([n[some], np.zeros(len(joined))]).astype(np.int64)
                    ),
                ],
                names=["a", "b", "n"],
            )

    return grouped.mapInArrow(run, "a long, b long, n long")


def _unpacked(rows: pa.Table) -> tuple:
    rows = rows.combine_chunks()
    one, two = rows.column("one")[0].as_py(), rows.column("two")[0].as_py()
    sides = None if one == two else rows.column("block").to_numpy()

    def matrix(name: str) -> np.ndarray:
        values = rows.column(name).combine_chunks()
        return values.flatten().to_numpy().reshape(rows.num_rows, -1)

    return (
        rows.column("table")[0].as_py(),
        rows.column("first_id").to_numpy(),
        rows.column("copies").to_numpy(),
        _unit(matrix("embedding")),
        matrix("cells"),
        sides,
    )


def _collisions(places: np.ndarray, window: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that collide often enough: all projections count for every pair."""
    first, second = [], []
    # A column for each projection, so that one is read in a row.
    columns = np.ascontiguousarray(places.T)
    step = max(1, 500_000 // len(places))
    for at in range(0, len(places), step):
        rows, others = columns[:, at : at + step], columns[:, at:]
        counts = np.zeros((rows.shape[1], others.shape[1]), np.int8)
        for mine, other in zip(rows, others, strict=True):
            counts += np.abs(mine[:, None] - other) <= window
        i, j = np.nonzero(counts >= COLLISIONS)
        ahead = j > i
        first.append(i[ahead] + at)
        second.append(j[ahead] + at)
    return np.concatenate(first), np.concatenate(second)


def _spanning(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Links that join the same vectors as all links ``(i, j)`` do, no more than vectors."""
    root = np.arange(n)
    picked = []
    while True:
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            break
        low, high = np.minimum(a[apart], b[apart]), np.maximum(a[apart], b[apart])
        # One link for each root that is joined to a smaller one.
        order = np.lexsort((low, high))
        head = np.append(True, high[order][1:] != high[order][:-1])
        where = np.flatnonzero(apart)[order[head]]
        picked.append(np.stack([i[where], j[where]], axis=1))
        root[high[order[head]]] = low[order[head]]
        while (root != root[root]).any():
            root = root[root]
    return np.concatenate(picked) if picked else np.empty((0, 2), int)


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """Links of vectors whose cosine is ``cosine`` or more, and what hangs together.

    ``vectors`` needs ``vec_id`` (long) and ``embedding`` (array of numbers); other
    columns are ignored. Returns vec_id, n_links (other rows linked directly),
    component_id (the smallest vec_id reachable, its own included) and kept (whether
    that is its own). Equal vectors are linked and compared with others once. A vector
    that is NULL, empty or zero, or holds a NULL or non-finite number, is linked with
    nothing, and so is any with a NULL vec_id, whose component is NULL. Vectors of
    different lengths are never linked. Rows with one vec_id are one node as regards
    components. No link has a smaller cosine; some pairs just above it may be missed,
    about six in a hundred at the cosine itself; a smaller one takes more tables.
    """
    x = F.col("embedding").cast("array<double>")
    rows = materialize(
        vectors.select(
            F.col("vec_id").cast("long").alias("vec_id"),
            # Adding 0.0 makes the two zeros one.
            F.transform(x, lambda v: v + 0.0).alias("embedding"),
        ),
        "vectors",
    )
    # NULL or NaN in it makes the test NULL or false.
    sound = F.forall("embedding", lambda v: v.isNotNull() & (F.abs(v) < float("inf")))
    usable = sound & F.exists("embedding", lambda v: v != 0.0) & F.col("vec_id").isNotNull()
    hashed = F.xxhash64("embedding")
    classes = (
        rows.where(usable)
        .groupBy("embedding")
        .agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))
    )
    placed = _cells(classes.select("first_id", "copies", "embedding"), tables_for(cosine))
    cells = materialize(placed, "cells")
    grouped = _grouped(cells).join(cells, "first_id").select(
        *_KEY, "block", "first_id", "copies", "embedding", "cells"
    )
    ordered = grouped.repartition(*[F.col(k) for k in _KEY]).sortWithinPartitions(*_KEY)
    found = materialize(_compare(ordered, cosine), "links")
    counts = found.where("b IS NULL").groupBy("a").agg(F.sum("n").alias("n"))
    labels = components(found.where("b IS NOT NULL"))
    by_class = materialize(
        cells.select("first_id", "copies", "embedding")
        .join(counts.withColumnRenamed("a", "first_id"), "first_id", "left")
        .join(labels.withColumnRenamed("node", "first_id"), "first_id", "left")
        .select(
            F.col("embedding").alias("_embedding"),
            hashed.alias("_hash"),
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "first_id").alias("component_id"),
        ),
        "classes",
    )
    same = (F.col("_hash") == F.when(usable, hashed)) & (F.col("_embedding") == F.col("embedding"))
    component = F.coalesce("component_id", "vec_id")
    return rows.join(by_class, same, "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
