"""Compare a query's rows with those of its SQL in DuckDB."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _sorted(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].astype(object)
    df = df.where(df.notna(), None)
    text = df.map(lambda v: v if isinstance(v, str) else repr(_plain(v)))
    order = text.sort_values(list(text.columns)).index
    return text.loc[order].reset_index(drop=True)


def _plain(value):
    if isinstance(value, pd.Timestamp):
        return value.isoformat()
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    return value.item() if hasattr(value, "item") else value


def assert_same(found: pd.DataFrame, wanted: pd.DataFrame) -> None:
    assert sorted(found.columns) == sorted(wanted.columns)
    assert len(found) == len(wanted)
    pd.testing.assert_frame_equal(_sorted(found), _sorted(wanted))
