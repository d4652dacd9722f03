"""Near-duplicates and repeated passages against brute force, with edge cases."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from querymill.llm import embedding_dedup, minhash, passages
from querymill.llm.components import components


def reachable(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_components(spark):
    draw = random.Random(3)
    links = [(draw.randrange(400), draw.randrange(400)) for _ in range(260)]
    links += [(i, i + 1) for i in range(1000, 1060)] + [(5, 5), (7, None)]
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    real = [(a, b) for a, b in links if b is not None and a != b]
    want = reachable({n for link in real for n in link}, real)
    assert {r.node: r.component for r in got} == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(text, width):
    words = (text or "").lower().split()
    n = max(1, len(words) - width + 1) if words else 0
    return {tuple(words[i : i + width]) for i in range(n)}


@pytest.mark.parametrize("small", [False, True])
def test_documents(spark, monkeypatch, small):
    if small:  # many blocks even here
        monkeypatch.setattr(minhash, "BLOCK", 8)
    draw = random.Random(1)
    texts = [None, "", "  ", "one", "ONE", "one two", "a b c", "a b c"]
    for group in range(6):
        base = [f"g{group}w{k}" for k in range(60)]
        for _ in range(25):
            copy = list(base)
            for _ in range(draw.randrange(5)):
                copy[draw.randrange(60)] = f"x{draw.random()}"
            texts.append(" ".join(copy))
    texts += [" ".join(f"r{draw.randrange(9999)}" for _ in range(30)) for _ in range(60)]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(8, texts[8], "again"), (None, "a b c", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = minhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    sets = [shingles(t, 3) for t in texts]
    links = [
        (i, j)
        for i in range(len(sets))
        for j in range(i)
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])
    ]
    want = reachable(range(len(sets)), links)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.n_shingles == len(sets[r.doc_id])
            assert r.component_id == want[r.doc_id] and r.kept == (r.component_id == r.doc_id)
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("block", [1024, 8])
def test_documents_large_group_linear(spark, monkeypatch, block):
    """A group of near copies compared all with all gives links in proportion to it, not
    to its pairs: fewer than its members at each key where it meets."""
    monkeypatch.setattr(minhash, "STAR_ROUNDS", 0)
    monkeypatch.setattr(minhash, "BLOCK", block)
    draw = random.Random(4)
    base = [f"w{k}" for k in range(200)]
    texts = []
    for _ in range(40):
        copy = list(base)
        for _ in range(draw.randrange(4)):
            copy[draw.randrange(200)] = f"x{draw.random()}"
        texts.append(" ".join(copy))
    texts += [" ".join(f"r{draw.randrange(9999)}" for _ in range(30)) for _ in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    counted = []
    close_pairs = minhash._close_pairs

    def counting(*args):
        pairs = minhash.materialize(close_pairs(*args), "counted")
        counted.append(pairs.count())
        return pairs

    monkeypatch.setattr(minhash, "_close_pairs", counting)
    got = minhash.near_duplicates(docs).collect()
    sets = [shingles(t, 3) for t in texts]
    links = [
        (i, j)
        for i in range(len(sets))
        for j in range(i)
        if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])
    ]
    assert counted and 2 * max(counted) < len(links)
    want = reachable(range(len(sets)), links)
    assert {r.doc_id: r.component_id for r in got} == want


@pytest.mark.parametrize("block", [1024, 16])
def test_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    draw = np.random.default_rng(2)
    base = draw.normal(size=(60, 32))
    x = np.concatenate([base, base[:30] + draw.normal(size=(30, 32)) * 0.2, base[:1] + draw.normal(size=(50, 32)) * 0.1, base[3:5], base[3:4] * 7])
    rows = [(i, [float(v) for v in row], "clash") for i, row in enumerate(x)]
    odd = [None, [], [0.0] * 32, [float("nan")] * 32, [float("inf")] + [1.0] * 31, [None] + [1.0] * 31, [1.0, 2.0], [1.0, 2.0]]
    rows += [(1000 + k, v, "odd") for k, v in enumerate(odd)] + [(None, rows[0][1], "")]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, kept string")
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(vectors).collect()}
    assert len(got) == len(rows)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    links = list(zip(*np.nonzero(near), strict=True))
    found = sum(got[i].n_links for i in range(len(x)))
    assert 0.95 * len(links) <= found <= len(links)
    want = reachable(range(len(x)), links)
    assert sum(got[i].component_id == want[i] for i in range(len(x))) >= 0.98 * len(x)
    for k in range(6):
        assert got[1000 + k].n_links == 0 and got[1000 + k].component_id == 1000 + k
    assert got[1006].n_links == 1 and got[1007].component_id == 1006
    assert got[None].component_id is None
    assert embedding_dedup.near_duplicates(vectors.limit(0)).count() == 0


def removed(texts, length):
    data = [(t or "").encode() for t in texts]
    seen: dict[bytes, int] = {}
    for b in data:
        for p in range(len(b) - length + 1):
            seen[b[p : p + length]] = seen.get(b[p : p + length], 0) + 1
    out = []
    for b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("group", [1024, 8])
def test_passages(spark, monkeypatch, group):
    monkeypatch.setattr(passages, "GROUP", group)
    draw = random.Random(5)

    def text(n):
        return "".join(draw.choice("abcdefgh é\n") for _ in range(n))

    common, short, edge = text(700), text(300), text(400)
    texts = [None, "", "x", edge, edge[:-1], "a" * 900, "ab" * 500]
    texts += [text(draw.randrange(500)) + common + text(draw.randrange(500)) for _ in range(40)]
    texts += [text(100) + short + text(200) for _ in range(40)]
    texts += [text(50) + edge + text(60), common * 2, texts[8], texts[8], text(5000)]
    rows = [(i, t, "clash") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_bytes string")
    got = {r.doc_id: tuple(r)[1:-1] for r in passages.repeated_passages(docs).collect()}
    assert got == dict(enumerate(removed(texts, 400)))
    assert passages.repeated_passages(docs).where("repeats <> (n_removed > 0)").count() == 0
    assert passages.repeated_passages(docs.limit(0)).count() == 0


def test_passages_in_pieces(spark, monkeypatch):
    """The row of bytes at the end of a piece is read once, also where its anchor occurs elsewhere."""
    draw = random.Random(7)
    text = "".join(draw.choice("abcdefgh") for _ in range(6000))
    one_piece = [a.tolist() for a in passages.anchors(text.encode())]
    monkeypatch.setattr(passages, "PIECE", 1000)
    hashes, places, first, last = passages.anchors(text.encode())
    rows = [r for a, b in zip(first.tolist(), last.tolist(), strict=True) for r in range(a, b + 1)]
    assert rows == list(range(6000 - 400 + 1))
    whole = zip(*one_piece[1:], strict=True)
    chosen = {r: p for p, a, b in whole for r in range(a, b + 1)}
    for p, a, b in zip(places.tolist(), first.tolist(), last.tolist(), strict=True):
        assert all(chosen[r] == p for r in range(a, b + 1))
    # Each anchor of the long text occurs in a short one, with other bytes about it.
    texts = [text] + [
        "".join(draw.choice("xyz") for _ in range(400)) + text[p : p + passages.ANCHOR] + "z" * 9 + str(k)
        for k, p in enumerate(sorted(set(places.tolist())))
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:-1] for r in passages.repeated_passages(docs).collect()}
    assert got == dict(enumerate(removed(texts, 400)))


def test_collisions_count_every_projection():
    """A group of 2048 with pairs at 0.9: none is left out for being apart in one projection."""
    draw = np.random.default_rng(12)
    base = draw.normal(size=(1024, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    aside = draw.normal(size=base.shape)
    aside -= (aside * base).sum(axis=1, keepdims=True) * base
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    x = np.concatenate([base, 0.9 * base + np.sqrt(1 - 0.81) * aside])
    places = x @ embedding_dedup._directions(64, embedding_dedup.SEED + 2, embedding_dedup.PROJECTIONS)
    window = embedding_dedup.DEVIATIONS * np.sqrt(2 - 2 * 0.9)
    places = places[np.argsort(places[:, 0], kind="stable")]
    i, j = embedding_dedup._collisions(places, window)
    got = set(zip(np.minimum(i, j).tolist(), np.maximum(i, j).tolist(), strict=True))
    assert len(got) == len(i)
    want = set()
    for a in range(len(places) - 1):
        hits = (np.abs(places[a + 1 :] - places[a]) <= window).sum(axis=1) >= embedding_dedup.COLLISIONS
        want.update((a, a + 1 + int(b)) for b in np.flatnonzero(hits))
    assert got == want


def test_lower_cosines_take_more_tables(spark):
    assert embedding_dedup.tables_for(0.9) == embedding_dedup.tables_for(1.0) == 24
    draw = np.random.default_rng(13)
    base = draw.normal(size=(200, 32))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    aside = draw.normal(size=base.shape)
    aside -= (aside * base).sum(axis=1, keepdims=True) * base
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    x = np.concatenate([base, 0.81 * base + np.sqrt(1 - 0.81**2) * aside])
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(vectors, 0.8).collect()}
    assert sum(got[i].component_id == got[200 + i].component_id for i in range(200)) >= 180
