from __future__ import annotations

import os
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from querymill.functions import dates, paths

PATHS = [
    "s3://bucket/a/b/c.txt",
    "s3a://bucket/a",
    "s3://bucket",
    "bucket/a//b",
    "/a",
    "//a",
    "a",
    "a/",
    "",
    "x/two\nlines/y",
    None,
]


@pytest.fixture(scope="module")
def named(spark):
    return spark.createDataFrame([(i, p) for i, p in enumerate(PATHS)], "i int, p string")


def _values(df, column):
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_dirname_and_basename_follow_posix(named):
    p = F.col("p")
    want = [(None, None) if x is None else os.path.split(x) for x in PATHS]
    assert _values(named, paths.dirname(p)) == [w[0] for w in want]
    assert _values(named, paths.basename(p)) == [w[1] for w in want]


def test_bucket_and_prefix(named):
    p = F.col("p")
    assert _values(named, paths.bucket(p))[:4] == ["bucket"] * 4
    assert _values(named, paths.prefix(p))[:4] == ["a/b/c.txt", "a", "", "a//b"]
    assert _values(named, paths.bucket(p))[-1] is None


def test_scheme(named):
    got = _values(named, paths.to_s3a(F.col("p")))
    assert got[0] == "s3a://bucket/a/b/c.txt"
    assert got[1:4] == PATHS[1:4][:1] + ["s3a://bucket", "bucket/a//b"]


def test_tail_name_joins_the_last_parts(named):
    want = [None if x is None else "-".join(x.split("/")[-2:]) for x in PATHS]
    assert _values(named, paths.tail_name(F.col("p"))) == want


TEXTS = ["2024-02-29", "1999-12-31", "2000-01-01 23:59:59", None]


def test_date_parts_of_text(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    t = F.col("t")
    assert _values(df, dates.year_of(t)) == [2024, 1999, 2000, None]
    assert _values(df, dates.month_of(t)) == [2, 12, 1, None]
    assert df.select(dates.year_of(t).alias("y")).schema["y"].dataType.simpleString() == "int"


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("text", ["bad", "2023-02-29", "2024-13-01"])
def test_bad_date_stops_or_gives_null(spark, ansi, text):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([(0, text)], "i int, t string")
        assert _values(df, dates.as_timestamp(F.col("t"), "null")) == [None]
        with pytest.raises(Exception, match="not a timestamp"):
            df.select(dates.as_timestamp(F.col("t"))).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    with pytest.raises(ValueError):
        dates.as_timestamp(F.col("t"), "ignore")


@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_zone_dates_ignore_the_session_zone(spark, session_zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        utc = F.lit("2024-03-01 20:00:00").cast("timestamp_ntz")
        row = spark.range(1).select(
            dates.today("Asia/Singapore", utc).alias("sg"),
            dates.today("America/New_York", utc).alias("ny"),
            dates.yesterday("America/New_York", utc).alias("before"),
            dates.iso_date(dates.yesterday("Asia/Singapore", utc)).alias("iso"),
            dates.year_of(F.lit("2024-01-01")).alias("year"),
            dates.today("UTC").alias("now"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert row.sg == date(2024, 3, 2)
    assert row.ny == date(2024, 3, 1)
    assert row.before == date(2024, 2, 29)
    assert row.iso == "2024-03-01"
    assert row.year == 2024
    assert abs((datetime.now(timezone.utc).date() - row.now).days) <= 1
