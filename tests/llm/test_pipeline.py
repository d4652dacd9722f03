"""The pipeline on a small corpus, against what must come out."""

from __future__ import annotations

import random

import corpus_pipeline
from querymill.llm.queries import vocabulary
from querymill.llm.bpe import Encoder


def test_pipeline(spark, tmp_path):
    draw = random.Random(6)

    def prose(n):
        return " ".join("".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 7))) for _ in range(n))

    texts = [prose(80) for _ in range(60)]
    texts += [texts[3], texts[4] + " more"]  # 60, 61: copies of 3 and 4
    texts += ["too short", "", None, "& # $ " * 30, "same five words again here " * 20]
    texts[10] += " mail to ab.12@mail1.example.com today"
    rows = [(i, t, "en", f"s{i % 2}", len(t or "")) for i, t in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        if name != "encoded":
            assert docs.columns == schema.replace(",", "").split()[::2]
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept.append({r.doc_id: r for r in docs.collect()})
    assert set(kept[0]) == set(range(62))
    assert set(kept[1]) == set(range(60)) == set(kept[2])
    assert "<EMAIL>" in kept[2][10].text and kept[2][10].n_chars == len(kept[2][10].text)
    assert set(kept[3]) <= set(range(60)) and len(kept[3]) > 40
    encoder = Encoder(vocabulary())
    for i, r in kept[4].items():
        assert r.n_tokens == len(r.ids) == len(r.text.split(" "))
        letters = "".join(t.removesuffix("</w>") for t in r.text.split(" "))
        assert letters and i in kept[3] and encoder.tokens[r.ids[0]] in r.text
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == sum(1 for _ in docs.collect())


def test_near_duplicates_by_row(spark):
    """Repeated and NULL ids, and two texts under one id of which one is a copy."""
    draw = random.Random(8)
    one, two, three, four = (" ".join(f"w{draw.randrange(10**6)}" for _ in range(60)) for _ in range(4))
    rows = [(1, one), (1, one), (2, one), (2, two), (None, one), (None, three), (None, three)]
    rows += [(5, four), (4, four + " more"), (None, four), (7, None), (7, None), (None, "  ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = corpus_pipeline.near_duplicates(spark, docs, "")
    assert got.columns == docs.columns
    want = [(1, one), (2, two), (None, three), (4, four + " more"), (7, None), (7, None), (None, "  ")]
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


def test_columns_called_like_helpers(spark):
    """A stage returns such columns as they came."""
    draw = random.Random(3)
    rows = [
        (i, " ".join(f"w{draw.randrange(10**6)}" for _ in range(50)), "en", f"s{i % 3}", 0, i, str(i), -i, [i])
        for i in range(12)
    ]
    schema = (
        "doc_id long, text string, lang string, source string, n_chars long, _row long, "
        "key string, number long, takes array<long>"
    )
    docs = spark.createDataFrame(rows + rows[:1], schema)
    for stage in (corpus_pipeline.near_duplicates, corpus_pipeline.source_mix):
        got = stage(spark, docs, "")
        assert got.columns == docs.columns
        for r in got.collect():
            assert (r._row, r.key, r.number, r.takes) == (r.doc_id, str(r.doc_id), -r.doc_id, [r.doc_id])
    assert corpus_pipeline.near_duplicates(spark, docs, "").count() == 12
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), "").count() == 0
