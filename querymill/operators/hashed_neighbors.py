"""Nearest neighbours by hashed candidates, for many dimensions.

With dozens of dimensions boxes rule out little, so an exact search compares nearly all
pairs. Here both sides are hashed by random projections, cut into cells of one width: near
points fall into one cell more often than far ones. Points that share all projections of a
table with a row are its candidates, and the nearest candidate is its neighbour. Cell width,
projections a table and number of tables follow from a wanted recall, by the distances
that a sample of rows has to its true neighbours.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from querymill.operators.blocks import compare
from querymill.operators.neighbors import _nearest_in_group, _present, nearest_neighbor
from querymill.session import materialize

SAMPLE_ROWS = 400  # whose true neighbours are looked for among all points
SAMPLE_POINTS = 2000  # to which these rows' distances are taken
MAX_TABLES = 128
# Comparisons that take as long as sending a row to one more table does.
TABLE_WORK = 4000
MAX_PROJECTIONS = 24
CHUNK_ROWS = 4096


@dataclass(frozen=True)
class Hashing:
    """How points are hashed, and what is expected of it."""

    width: float
    projections: int
    tables: int
    recall: float
    share: float  # of all points that a row has as candidates, summed over tables


def collision(distance: np.ndarray, width: float) -> np.ndarray:
    """Chance that one projection puts two points at ``distance`` into one cell."""
    ratio = np.minimum(width / np.maximum(distance, 1e-300), 1e150)
    normal = np.array([math.erfc(r / math.sqrt(2)) for r in ratio.ravel()]).reshape(ratio.shape)
    rest = (1 - np.exp(-(ratio**2) / 2)) * 2 / (math.sqrt(2 * math.pi) * ratio)
    return np.clip(1 - normal - rest, 0.0, 1.0)


def calibrated(near: np.ndarray, far: np.ndarray, size: int, recall: float) -> Hashing:
    """The hashing with least work whose expected recall is at least ``recall``.

    ``near``: distances of rows to their true neighbours; ``far``: to points at large. Work
    is a trip through the shuffle for each table and a comparison for each candidate.
    """
    scale = float(np.median(near[near > 0])) if (near > 0).any() else float(np.median(far)) or 1.0
    best: Hashing | None = None
    least = math.inf
    for factor in (1, 1.5, 2, 3, 4, 6, 8, 12):
        hit, stray = collision(near, factor * scale), collision(far, factor * scale)
        for k in range(1, MAX_PROJECTIONS + 1):
            share = float((stray**k).mean())
            miss = 1 - hit**k
            for tables in range(1, MAX_TABLES + 1):
                found = 1 - float((miss**tables).mean())
                if found >= recall:
                    work = tables * (TABLE_WORK + share * size)
                    if work < least:
                        least = work
                        best = Hashing(factor * scale, k, tables, found, tables * share)
                    break
    if best is None:
        raise ValueError(f"no {MAX_TABLES} tables give a recall of {recall}")
    return best


def _true_distances(points: DataFrame, dims: list[str], rows: np.ndarray) -> np.ndarray:
    """Distance of each row to its nearest point: one pass over the points, each task with
    one number a row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        least = np.full(len(rows), np.inf)
        for batch in batches:
            values = batch.to_numpy(dtype=np.float64)
            for at in range(0, len(values), 4096):
                part = values[at : at + 4096]
                square = (rows**2).sum(1)[:, None] - 2 * rows @ part.T + (part**2).sum(1)
                least = np.minimum(least, square.min(axis=1, initial=np.inf))
        yield pd.DataFrame({"row": np.arange(len(rows)), "square": least})

    found = points.select(*dims).mapInPandas(run, "row long, square double")
    least = found.groupBy("row").agg(F.min("square").alias("square")).orderBy("row").toPandas()
    return np.sqrt(np.maximum(least["square"].to_numpy(), 0.0))


def calibrate(
    rows: DataFrame, points: DataFrame, dims: list[str], size: int, recall: float
) -> Hashing:
    """``calibrated`` for a bounded sample of rows and of points (see the module's constants)."""

    def sampled(df: DataFrame, wanted: int, count: int) -> np.ndarray:
        share = min(1.0, 1.5 * wanted / max(count, 1))
        return df.select(*dims).sample(share, seed=11).limit(wanted).toPandas().to_numpy(np.float64)

    asked = sampled(rows, SAMPLE_ROWS, rows.count())
    if not len(asked):
        asked = sampled(points, SAMPLE_ROWS, size)
    near = _true_distances(points, dims, asked)
    some = sampled(points, SAMPLE_POINTS, size)
    square = (asked**2).sum(1)[:, None] - 2 * asked @ some.T + (some**2).sum(1)
    return calibrated(near, np.sqrt(np.maximum(square, 0.0)), size, recall)


def _with_cells(df: DataFrame, dims: list[str], hashing: Hashing, seed: int) -> DataFrame:
    """Each row once for each table, with the number of its cell there."""
    draw = np.random.default_rng(seed)
    n = hashing.tables * hashing.projections
    directions = draw.normal(size=(len(dims), n))
    offsets = draw.uniform(0, hashing.width, size=n)
    odd = draw.integers(1, 1 << 62, size=hashing.projections) * 2 + 1

    @F.pandas_udf("array<long>")
    def cells(*features: pd.Series) -> pd.Series:
        values = np.column_stack([f.to_numpy(dtype=np.float64) for f in features])
        found = []
        for at in range(0, len(values), 4096):
            place = np.floor((values[at : at + 4096] @ directions + offsets) / hashing.width)
            place = np.clip(np.nan_to_num(place), -(2.0**62), 2.0**62).astype(np.int64)
            place = place.reshape(len(place), hashing.tables, hashing.projections)
            with np.errstate(over="ignore"):
                mixed = (place * odd).sum(axis=2)
                mixed ^= mixed >> 29
            found.extend(mixed)
        return pd.Series(found, dtype=object)

    return df.select("*", F.posexplode(cells(*dims)).alias("_table", "_cell"))


def hashed_neighbor(
    test: DataFrame,
    train: DataFrame,
    key: str,
    label: str,
    features: Sequence[str],
    recall: float = 0.95,
    chunk_rows: int = CHUNK_ROWS,
    seed: int = 7,
) -> DataFrame:
    """Label of a near training row for each test row: the nearest one for about ``recall``
    of the rows (as expected from the sample), one of the nearest for the others.

    Distances are exact, in double precision; of equally near candidates the smallest key
    counts. A row without candidates is searched for exactly, so every test row is answered.
    Equal training points count once. Cells that hold many points or rows are cut into
    chunks that are compared pair by pair, so no task holds a whole cell. Missing and
    infinite features stop the query. Returns ``key``, ``nearest_key``, ``predicted`` and
    ``distance``.
    """
    dims = [f"_f{i}" for i in range(len(features))]
    point = [_present(name).alias(dim) for name, dim in zip(features, dims, strict=True)]
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
    rows = test.select(F.col(key).alias("_key"), *point)
    hashing = calibrate(rows, points, dims, size, recall)
    found = compare(
        _with_cells(points, dims, hashing, seed),
        _with_cells(rows, dims, hashing, seed),
        ["_table", "_cell"],
        dims,
        chunk_rows,
        _nearest_in_group(dims),
    )
    best = materialize(
        found.groupBy("_key").agg(F.min(F.struct("_square", "_near", "_label")).alias("_best")), "best"
    )
    named = best.select(
        F.col("_key").alias(key),
        F.col("_best._near").alias("nearest_key"),
        F.col("_best._label").alias("predicted"),
        F.sqrt("_best._square").alias("distance"),
    )
    missed = test.join(best.select(F.col("_key").alias(key)), key, "left_anti")
    if missed.isEmpty():
        return named
    exact = points.select(
        *[F.col(d).alias(x) for d, x in zip(dims, features, strict=True)],
        F.col("_near").alias(key),
        F.col("_label").alias(label),
    )
    return named.unionByName(nearest_neighbor(missed, exact, key, label, features))
