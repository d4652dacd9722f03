"""Ranked search, spelling variants and URL rules against brute force, with edge cases."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from querymill.llm import search, spelling, url_rules

# ---------------------------------------------------------------- search


def own_terms(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def ranked(docs, items, k):
    held = [(i, own_terms(t)) for i, t in docs]
    held = [(i, Counter(t), len(t)) for i, t in held if t]
    n, length = len(held), sum(m for *_, m in held)
    df = Counter(w for _, c, _ in held for w in c)
    out = []
    for item, text in items:
        asked = Counter(own_terms(text))
        scores = []
        for i, c, m in held:
            score = 0
            for w, times in asked.items():
                if c[w]:
                    weight = math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1)))
                    norm = 75 + 25 * m * n // length
                    score += times * weight * (10**9 * c[w] // (1000 * c[w] + 12 * norm))
            if score > 0:
                scores.append((-score, i is None, i or 0))
        scores.sort()
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(scores[:k], 1)]
    return sorted(out, key=repr)


def test_search_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(search, "FIRST_READ", 1)
    monkeypatch.setattr(search, "PART_POSTINGS", 40)
    draw = random.Random(1)
    words = ["the"] * 30 + [f"w{i}" for i in range(40)] + ["É", "é", "a1", "X", "x"]
    docs = [(i, " ".join(draw.choices(words, k=draw.randrange(1, 30)))) for i in range(150)]
    docs += [(i + 150, docs[3][1]) for i in range(40)]  # ties
    docs += [(3, docs[3][1]), (None, docs[3][1]), (None, "w1 w2"), (900, None), (901, ""), (902, " \t!?")]
    docs += [(903, "w3 " * 20_000), (904, "W4,w4;É_é")]
    items = [(i, " ".join(draw.choices(words, k=8))) for i in range(12)]
    items += [(50, docs[3][1]), (51, None), (52, "..."), (53, "nowhere"), (None, "w7 w8"), (54, "w5 w5 w5")]
    frames = (
        spark.createDataFrame([(*d, "clash") for d in docs], "doc_id long, text string, score string"),
        spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, rank int"),
    )
    for block in (search.QUERY_BYTES, 200):
        monkeypatch.setattr(search, "QUERY_BYTES", block)
        got = search.best_documents(*frames, k=10)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(map(tuple, got.collect()), key=repr) == ranked(docs, items, 10)
    assert search.best_documents(frames[0].limit(0), frames[1]).count() == 0
    assert search.best_documents(frames[0], frames[1].limit(0)).count() == 0


def test_best_positions_end_a_search_early():
    """A rare term's few documents are found without looking most documents up."""
    rng = np.random.default_rng(0)
    n, n_terms = 5000, 12
    counts = (rng.random((n, n_terms)) < 0.5) * rng.integers(1, 6, (n, n_terms))
    counts[:, 0] = 0
    counts[rng.choice(n, 40, replace=False), 0] = 5
    doc, term = np.nonzero(counts)
    sizes = counts.sum(axis=1) + 1
    weights = np.array([6000] + [300] * (n_terms - 1))
    lists = search.Lists(
        np.arange(n), np.zeros(n, bool), sizes, np.searchsorted(doc, np.arange(n + 1)),
        term, counts[doc, term], weights, n, int(sizes.sum()),
    )
    top = search.Top(20)
    met = lists.search(np.arange(n_terms), np.ones(n_terms, np.int64), top)
    assert met < n / 2
    total = np.zeros(n, np.int64)
    np.add.at(total, lists.doc, lists.impact)
    want = np.lexsort((np.arange(n), -total))[:20]
    assert top.doc_id.tolist() == want.tolist() and top.score.tolist() == total[want].tolist()


# ---------------------------------------------------------------- spelling


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


@pytest.mark.parametrize("symbols,crowd", [(None, 64), (4, 2), (1, 10_000), (2, 0)])
def test_near_pairs_are_all_pairs(spark, symbols, crowd):
    draw = random.Random(5)
    words = {"".join(draw.choices("abcé", k=draw.randrange(1, 7))) for _ in range(120)}
    words |= {"aaaaaa", "aaaaaaa", "aaaaaaaa", "abababab", "ÀÀÀ×÷ÿ", "ÀÀÀ×÷"}
    frame = spark.createDataFrame([(w, 1) for w in sorted(words)], "word string, form int")
    got = sorted(map(tuple, spelling.near_pairs(frame, symbols, crowd).collect()))
    assert got == sorted((a, b) for a in words for b in words if one_edit(a, b))


def own_variants(docs):
    count = Counter()
    for i, text in docs:
        for run in re.findall(r"[A-Za-z\u00C0-\u00FF]+", text or ""):
            low = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            if h % 199 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            if len(low) >= 6:
                count[low] += 1
    n = {w: c for w, c in count.items() if c >= 5}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out)


def test_variants_equal_brute_force(spark):
    draw = random.Random(2)
    base = ["".join(draw.choices("abcdefgéÀ", k=draw.randrange(6, 11))) for _ in range(25)]
    words = base * 8
    for w in base:
        at = draw.randrange(len(w))
        words += [w[:at] + "z" + w[at + 1 :]] * 2 + [w[:at] + w[at:].upper()] + [w + "z"]
    docs = [(i, " ".join(draw.choices(words, k=40)) + ".") for i in range(60)]
    docs += docs[:5] + [(None, docs[0][1]), (70, None), (71, ""), (72, "abcdef " * 3000), (73, "x" * 100_000)]
    docs += [(74, "abcdefg1abcdefg-abcdefg_abcdefg\nabcdefg")]
    frame = spark.createDataFrame([(*d, "c") for d in docs], "doc_id long, text string, word string")
    columns = ["word", "form", "root", "n", "n_near", "form_n"]
    found = spelling.variants(frame)
    assert sorted(map(tuple, found.select(columns).collect())) == own_variants(docs)
    assert any(r[1] for r in own_variants(docs))
    assert spelling.variants(frame.limit(0)).count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan


# ---------------------------------------------------------------- URL rules


def as_regex(glob):
    out = ""
    for token in re.findall(r"\*+|[^*]", glob):
        out += {"*": "[^/?]*"}.get(token, ".*") if token[0] == "*" else re.escape(token)
    return re.compile(out, re.DOTALL)


def test_automaton_equals_regular_expressions():
    draw = random.Random(7)
    letters = ["a", "b", "/", "?", ".", "é", "*", "**", "aa"]
    globs = ["".join(draw.choices(letters, k=draw.randrange(0, 9))) for _ in range(150)]
    texts = ["".join(draw.choices("aab/?.éx\n", k=draw.randrange(0, 14))) for _ in range(400)]
    texts += ["", "a" * 5000, "a/" * 300]
    automaton = url_rules.Automaton(globs)
    assert automaton.words > 5
    patterns = [as_regex(g) for g in globs]
    want = [next((i for i, p in enumerate(patterns) if p.fullmatch(t)), -1) for t in texts]
    assert automaton.first(texts).tolist() == want
    assert automaton.first([]).tolist() == []


def test_url_rules(spark, monkeypatch):
    monkeypatch.setattr(url_rules, "STATE_BYTES", 64)
    rules = [
        url_rules.Rule("allow", "com", "/"),
        url_rules.Rule("block", "example.com", "/en/"),
        url_rules.Rule("allow", "www.example.com", "/en/"),
        url_rules.Rule("block", "net", "/es/"),
    ]
    globs = [url_rules.Glob("block", "**?page=**"), url_rules.Glob("allow", "*.org/**?page=1")]
    cases = [
        ("http://a.com/x", "a.com", "/x", "com/", "allow"),
        ("http://a.com", "a.com", "", None, "allow"),  # no path: no rule's path begins it
        ("HTTP://WWW.Example.com/en/A?q#f", "www.example.com", "/en/A", "www.example.com/en/", "allow"),
        ("https://b.example.com/en/", "b.example.com", "/en/", "example.com/en/", "block"),
        ("https://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
        ("https://x.net/es", "x.net", "/es", None, "allow"),
        ("https://x.net/es/?page=2", "x.net", "/es/", "net/es/", "block"),
        ("https://x.org/l?page=2", "x.org", "/l", None, "block"),
        ("https://x.org/l?page=1", "x.org", "/l", None, "allow"),
        ("ftp://x.org?u=.com/y", "x.org", "", None, "allow"),
        ("a://b.com/://net/es/", "b.com", "/://net/es/", "com/", "allow"),
        ("x.com/y", "", "", None, "allow"),
        ("", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("http://a.com/" + "é" * 50_000, "a.com", "/" + "é" * 50_000, "com/", "allow"),
        ("http://ÀB.com/\n/", "Àb.com", "/\n/", "com/", "allow"),
    ]
    cases += cases[:3]
    frame = spark.createDataFrame(
        [(i, c[0], "old", "old") for i, c in enumerate(cases)], "page_id long, url string, host string, rule string"
    )
    got = url_rules.judge(frame, rules, globs, keep=["page_id", "host", "url"])
    assert got.columns == ["page_id", "url", *url_rules.RESULTS]
    found = {r.page_id: (r.url, r.host, r.path, r.rule, r.verdict) for r in got.collect()}
    assert found == dict(enumerate(cases))
    assert url_rules.judge(frame.limit(0), rules).count() == 0
    blocked = url_rules.judge(frame, [], default="block").collect()
    assert {r.verdict for r in blocked} == {"block"} and len(blocked) == len(cases)
    with pytest.raises(ValueError, match="verdict"):
        url_rules.judge(frame, rules, default="maybe")
