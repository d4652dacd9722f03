"""Functions over columns that hold URIs and slash-separated paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_s3a(uri: Column) -> Column:
    """Same object under the scheme Spark reads with."""
    return F.regexp_replace(uri, r"^s3://", "s3a://")


def _without_scheme(uri: Column) -> Column:
    return F.regexp_replace(uri, r"^s3a?://", "")


def bucket(uri: Column) -> Column:
    return F.substring_index(_without_scheme(uri), "/", 1)


def prefix(uri: Column) -> Column:
    """Everything after the bucket, without its leading slash."""
    return F.regexp_extract(_without_scheme(uri), r"(?s)^[^/]*/(.*)$", 1)


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def dirname(path: Column) -> Column:
    """Parent path; trailing slashes go, except where only slashes are left."""
    head = F.regexp_extract(path, r"(?s)^(.*/)[^/]*$", 1)
    return F.when(head.rlike(r"^/+$"), head).otherwise(F.rtrim(head, F.lit("/")))


def tail_name(path: Column, parts: int = 2) -> Column:
    """Last ``parts`` path parts (or all, if fewer) joined by ``-``."""
    return F.replace(F.substring_index(path, "/", -parts), F.lit("/"), F.lit("-"))
