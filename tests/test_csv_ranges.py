"""Large CSV files cut into ranges: the same rows as from one task per file."""

from __future__ import annotations

import random
from pathlib import Path

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from querymill.sources.csv_ranges import range_lines
from querymill.sources.files import scan_csv, scan_declared, scan_prefix

SCHEMA = StructType(
    [StructField("k", LongType()), StructField("t", StringType()), StructField("u", StringType())]
)
HUGE = 1 << 40


def field(draw: random.Random, longest: int) -> str:
    kind = draw.randrange(8)
    if kind == 0:
        return ""
    if kind == 1:
        return '""'
    if kind == 2:
        return "plain text " * draw.randrange(4) + "é"
    letters = draw.choices(["a", "b c", ",", "\n", '""', "\r\n", "ß", "\n\n", " "], k=draw.randrange(longest))
    return '"' + "".join(letters) + '"'


def written(root: str, name: str, content: str) -> str:
    Path(root).mkdir(parents=True, exist_ok=True)
    path = f"{root}/{name}"
    Path(path).write_bytes(content.encode())
    return path


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def same(spark, path: str, range_bytes: int) -> list[tuple]:
    cut = rows(scan_csv(spark, path, schema=SCHEMA, range_bytes=range_bytes))
    assert cut == rows(scan_csv(spark, path, schema=SCHEMA, range_bytes=HUGE))
    return cut


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("longest,range_bytes", [(8, 700), (60, 97)])
def test_random_fields(spark, root, end, longest, range_bytes):
    draw = random.Random(longest)
    lines = [f"{i},{field(draw, longest)},{field(draw, longest)}" for i in range(200)]
    content = end.join(["k,t,u", *lines[:50], "", *lines[50:]])
    path = written(root, "some.csv", content + (end if longest == 8 else ""))
    assert len(same(spark, path, range_bytes)) == 200


def test_a_field_longer_than_many_ranges(spark, root):
    texts = ["x" * 5000, "line\n" * 1500, '""' * 2000, "\n" * 3000, "a\n" + "b" * 4000 + "\nc"]
    lines = [f'{i},"{t}",{i}' for i, t in enumerate(texts)] + ["7,short,", '8,"two\nlines",']
    path = written(root, "long.csv", "k,t,u\n" + "\n".join(lines) + "\n")
    found = same(spark, path, 256)
    assert {r[0]: r[1] for r in found}[1] == texts[1]
    assert len(found) == 7


def test_many_tasks_for_one_file(spark, root):
    lines = [f'{i},"one\ntwo, {i}",x' for i in range(3000)]
    path = written(root, "one.csv", "k,t,u\n" + "\n".join(lines) + "\n")
    cut = scan_csv(spark, path, schema=SCHEMA, range_bytes=4096)
    assert cut.rdd.getNumPartitions() >= 10
    assert cut.count() == 3000
    # Ranges stay as they were counted, whatever the settings are later.
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        assert cut.count() == 3000
        assert rows(cut)[5] == rows(scan_csv(spark, path, schema=SCHEMA, range_bytes=HUGE))[5]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_files_that_cannot_be_cut(spark, root):
    """A quote where none may be: whole files, the rest is still cut."""
    good = "".join(f'{i},"a\nb",c\n' for i in range(300))
    odd = {
        "inner": '1,5" disk,x\n',
        "blank": '1, "a",x\n',
        "unclosed": '1,b,"never closed\n2,b,c\n',
    }
    for name, line in odd.items():
        path = f"{root}/{name}"
        written(path, "bad.csv", "k,t,u\n" + good + line)
        written(path, "good.csv", "k,t,u\n" + good)
        written(path, "small.csv", "k,t,u\n9,z,\n")
        same(spark, path, 500)
    carriage = written(root, "cr.csv", "k,t,u\n" + good.replace("c\n", "c\r\n"))
    same(spark, carriage, 500)


def test_header_and_edges(spark, root):
    body = "".join(f'{i},"a\n{i}",c\n' for i in range(300))
    wrong = written(root, "wrong.csv", "k,other,u\n" + body)
    with pytest.raises(Exception, match="does not fit"):
        scan_csv(spark, wrong, schema=SCHEMA, range_bytes=500).collect()
    short = written(root, "short.csv", "k,t,u\n" + body + "1,2\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        scan_csv(spark, short, schema=SCHEMA, range_bytes=500).collect()
    marked = written(root, "bom.csv", "﻿k,t,u\n" + body)
    assert len(same(spark, marked, 500)) == 300
    late = written(root, "late.csv", "\n\nk,t,u\n\n" + body + "\n\n")
    assert len(same(spark, late, 500)) == 300
    header = written(root, "header.csv", "k,t,u\n")
    assert same(spark, header, 2) == []
    empty = written(root, "empty.csv", "")
    assert rows(scan_csv(spark, empty, schema=SCHEMA, range_bytes=2)) == []


def test_folders_of_our_own_files(spark, root):
    from querymill.sinks.versions import write_version

    texts = [None, "", "\\", '"', "a\r\nb", "\n", "x,y\n" * 50, "\r", "é ", " "]
    made = spark.createDataFrame([(i, t, t) for i, t in enumerate(texts * 30)], SCHEMA)
    write_version(made.coalesce(2), root, "csv")
    for read in (
        scan_prefix(spark, root, "csv", SCHEMA, own_csv=True, range_bytes=300),
        scan_declared(spark, root, "text/csv", SCHEMA, own_csv=True, range_bytes=300),
    ):
        assert rows(read) == rows(made)


def test_ranges_are_disjoint_and_complete(spark, root):
    lines = [f"{i},{'x' * (i % 90)},y" for i in range(2000)]
    path = written(root, "lines.csv", "\n".join(lines))
    seen = range_lines(spark, [path], 1000, False)
    assert sorted(r.value for r in seen.collect()) == sorted(lines)
    assert seen.select("file", "start").distinct().count() > 50
    assert [t.name for t in spark.catalog.listTables("global_temp") if t.name.startswith("lines_")] == []
