"""Projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from querymill.functions import dates


def select_all(df: DataFrame) -> DataFrame:
    return df.select("*")


def with_date_parts(df: DataFrame, date_col: str, on_error: str = "fail") -> DataFrame:
    """Append ``year`` and ``month`` of a date column (text, date or timestamp)."""
    value = F.col(date_col)
    return df.withColumns(
        {"year": dates.year_of(value, on_error), "month": dates.month_of(value, on_error)}
    )


def with_load_timestamp(df: DataFrame, name: str = "ts") -> DataFrame:
    """Append the time of the load, the same on every row."""
    return df.withColumn(name, dates.wall_clock())


def first_columns(df: DataFrame, n: int = 4) -> DataFrame:
    """The first ``n`` columns, by position."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns[:n]])


def drop_label(df: DataFrame, label: str = "species") -> DataFrame:
    """Drop the label column; nothing happens where there is none."""
    return df.drop(label)


def prediction_only(
    df: DataFrame,
    key_cols: Sequence[str] = (),
    source: str = "predicted_score",
) -> DataFrame:
    """Keep the prediction as ``predicted_score``, next to the columns naming the row."""
    return df.select(*key_cols, F.col(source).alias("predicted_score"))
