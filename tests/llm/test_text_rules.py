"""Quality rules, mixing, HTML text: brute force and edge cases."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from querymill.llm import html_text, mixing, quality

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, kept string"


def counts(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return [len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)]


TEXTS = [
    None,
    "",
    " \n\t ",
    "one",
    "a b c d e",
    "a b c d e a b c d e f",
    "x " * 40,
    "line one here\nline one here\n\n  \nother",
    "# $ % é😀 b c \x1cd",
    "<b> | & *",
    "word " * 4999 + "end",
    " ".join(f"w{i}" for i in range(3000)),
]


def test_counts_equal_brute_force(spark):
    rows = [(i, t, "en" if i % 2 else None, None, "clash") for i, t in enumerate(TEXTS)]
    got = quality.judge(spark.createDataFrame(rows, DOCS)).collect()
    assert {r.doc_id: [r[c] for c in quality.BASE] for r in got} == {
        i: counts(t) for i, t in enumerate(TEXTS)
    }
    for r in got:
        failed = r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words
        assert r.base_failed == failed and not (failed and r.kept)


def test_fences_reject_outliers_and_keep_the_rest(spark):
    clean = [(i, f"some plain text number {i} with more than ten words in it", "en", "s", "") for i in range(120)]
    odd = [(1000, "a& b& c& d& e& f& g& h& i& j& k& l& m&", "en", "s", "")]
    docs = spark.createDataFrame(clean + odd, DOCS)
    kept = {r.doc_id for r in quality.keep_good(docs).collect()}
    assert kept == set(range(120))
    assert quality.keep_good(docs).columns == docs.columns


def test_quality_of_nothing(spark):
    empty = spark.createDataFrame([], DOCS)
    assert quality.judge(empty).count() == 0 and quality.keep_good(empty).count() == 0


def shares(sizes):
    """Targets by repeated resharing."""
    total = sum(sizes.values())
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(names)}
    full = {}
    while True:
        rest = {s: w for s, w in weight.items() if s not in full}
        left = total - sum(full.values())
        level = left / sum(rest.values()) if rest else 0
        over = [s for s in rest if rest[s] * level >= 3 * sizes[s]]
        if not over:
            return full | {s: w * level for s, w in rest.items()}
        full |= {s: 3.0 * sizes[s] for s in over}


def test_mix_meets_its_targets(spark):
    names = ["a", "b", "c", "d", None]
    rows = [(i, names[min(4, i % 9)], 50 + i * 37 % 400) for i in range(900)]
    rows += [(5000, "a", 0), (5001, "tiny", 1), (5002, "a", None), (7, "b", 99), (7, "b", 99), (None, "b", 30)]
    sizes = spark.createDataFrame(rows, "doc_id long, source string, size long")
    got = mixing.mix(sizes).collect()
    assert len(got) == len(rows)
    totals = Counter()
    for _, s, n in rows:
        totals[s] += n or 0
    want, taken = shares(totals), Counter()
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == totals[r.source]
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s, n in want.items():
        assert abs(taken[s] - n) <= 4 * mixing.BLOCK_WORDS
    again = mixing.mix(sizes.repartition(3)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))


def test_mix_of_nothing(spark):
    schema = "doc_id long, source string, size long"
    assert mixing.mix(spark.createDataFrame([], schema)).count() == 0
    blank = spark.createDataFrame([(1, "a", 0), (2, None, None)], schema)
    assert [r.taken for r in mixing.mix(blank).collect()] == [0, 0]


def test_mixed_documents_are_their_own_words(spark):
    rows = [(i, " ".join(f"w{i}_{k}" for k in range(20 + i)), "ab"[i % 2], 1) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int")
    texts = {i: t for i, t, _, _ in rows}
    got = mixing.mixed_documents(docs).collect()
    taken = {r.doc_id: r.taken for r in mixing.mix(docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))).collect()}
    words = Counter()
    for r in got:
        assert texts[r.doc_id].startswith(r.text) and r.n_chars == len(r.text)
        words[r.doc_id] += len(r.text.split())
    assert words == {i: n for i, n in taken.items() if n}


PAGE = (
    "<html><head><title>T t t</title><style>p</style></head><body><nav><a href='/'>menu one two</a></nav>"
    '<div class="ad">buy this now</div><article><h1>Head</h1><p>One&amp;two <b>bo</b>ld<br>x{}</p>'
    "<script>var a='</p>';</script><aside>not this</aside></article>"
    "<footer>&copy; a b c d e f g h i j k l m n o p q r s t</footer>"
)


def test_article_alone_comes_out(spark):
    scores = html_text.fit([PAGE.format(f" word {i}" * (1 + i % 5)) for i in range(30)])
    assert html_text.main_text(PAGE.format(""), scores) == "Head One&two bold x"
    assert html_text.main_text(None, scores) == html_text.main_text("", scores) == ""
    bare = PAGE.format(" and more").replace("<article>", "<div>").replace("</article>", "</div>")
    assert html_text.main_text(bare, scores) == "Head One&two bold x and more"
    rows = [(1, None, "u"), (2, "", "u"), (3, "<p>broken <b", "u"), (4, "<" * 5000, "u"), (5, "just words", "u")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = {r.page_id: r.text for r in html_text.extract(pages, scores, ["page_id", "text"]).collect()}
    assert got[1] == got[2] == "" and got[5] == "just words" and got[3] == "broken"
    assert html_text.extract(pages.limit(0), html_text.train(pages), ["page_id"]).count() == 0


def whole_text(source):
    page = html_text.Page(source)
    return page.text(0, len(page.tags))


def test_formulas_are_text():
    source = "<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> hold</p>"
    assert whole_text(source) == "Let x=2 hold"
    words = "plain words of an article " * 8
    body = f"<article><p>{words}</p><p>so {source} and {words}</p></article>"
    page = f"<html><body><nav><a>Home</a></nav>{body}<footer>Imprint</footer></body></html>"
    text = html_text.main_text(page, html_text.fit([page]))
    assert "x=2" in text and text.count("article") == 16


def test_asides_without_an_end_tag():
    assert whole_text("<div><p>a<p class=ad>b<p>c</div>d") == "a c d"
    assert whole_text("<div><p>a<p class=ad>b <b>bold</b> </i> x</div>d") == "a d"
    assert whole_text("<p class=ad>b<div>c</div>d") == "c d"
    assert whole_text("<p class=ad>b</p>c<p class=ad>d<p class=ad>e<h2>f</h2>") == "c f"
    assert whole_text("<ul><li>a<li class=ad>b<ul><li>c</ul>d<li>e</ul>f") == "a e f"
    assert whole_text("<ul><li>a<li class=ad>b<p>c</ul>f") == "a f"
    assert whole_text("<div class=ad>a<div>b</div>c</div>d") == "d"


def test_best_stretch_equals_trying_all():
    draw = random.Random(21)
    for _ in range(2000):
        words = [draw.choice([0.0, 0.0, 0.5, 1.0, 4.0]) for _ in range(draw.randint(1, 9))]
        tags = [draw.choice([-0.5, -1.0, -3.0]) for _ in words[1:]]
        sums = {
            (a, b): sum(words[a : b + 1]) + sum(tags[a:b])
            for a in range(len(words))
            for b in range(a, len(words))
        }
        found = html_text.best_stretch(words, tags)
        if max(sums.values()) <= 0:
            assert found is None
        else:
            assert sums[found] == max(sums.values())


def test_attributes_are_whole_names_and_all_three_count():
    scores = html_text.fit([PAGE.format(f" word {i}" * (1 + i % 5)) for i in range(30)])
    many = " ".join(["one two three"] * 40)
    body = f"<p>{many}</p><{{}}>buy now</{{}}><p>{many}</p>"
    page = "<html><body><article>" + body + "</article></body></html>"
    whole = f"{many} buy now {many}"
    for opened, gone in {
        'div id="x1" class="advert"': True,
        "div class=box role=navigation": True,
        "div data-x='1' id=sidebar": True,
        'p data-id="ad"': False,
        'p my-class="advert" title="class=advert"': False,
        "p id=p1": False,
    }.items():
        name = opened.split()[0]
        text = html_text.main_text(page.format(opened, name), scores)
        assert text == (f"{many} {many}" if gone else whole), opened
