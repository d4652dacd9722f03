"""Train/test split and accuracy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The split in use.
TRAIN_FRACTION = 0.8
SEED = 3


def in_train(key: str, fraction: float = TRAIN_FRACTION, seed: int = SEED) -> Column:
    """Whether a row belongs to the training part.

    Decided by a hash of the row's key and the seed, so it does not depend on
    how the rows are laid out, and a retried task decides the same. A NULL key stops
    the query: it would belong to neither part.
    """
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must lie between 0 and 1")
    if fraction == 1.0:
        return F.lit(True)
    bound = f"{int(fraction * 2**32):08x}"
    missing = F.raise_error(F.lit(f"{key} has a missing value")).cast("string")
    text = F.concat(F.coalesce(F.col(key).cast("string"), missing), F.lit(f"|{seed}"))
    return F.substring(F.md5(text.cast("binary")), 1, 8) < bound


def train_test_split(
    df: DataFrame, key: str, fraction: float = TRAIN_FRACTION, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Training rows and test rows."""
    train = in_train(key, fraction, seed)
    return df.where(train), df.where(~train)


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Share of rows whose prediction equals the label, as one row."""
    hit = F.col(label).eqNullSafe(F.col(prediction))
    return df.agg(F.avg(hit.cast("double")).alias("accuracy"))
