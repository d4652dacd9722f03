"""Toxicity, resampling, BPE and personal data."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from querymill.llm import bpe, pii, resampling, toxicity
from querymill.llm.queries import op2_toxicity, vocabulary

SF_DIR = "/root/testdata/sf0.1"


def test_toxic_documents_are_found_by_held_out_labels(spark):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").select("doc_id", "toxic")
    rows = op2_toxicity(spark, SF_DIR).where("held_out").join(labels, "doc_id").collect()
    hits = sum(r.predicted and r.toxic for r in rows)
    assert hits >= 0.85 * sum(r.toxic for r in rows)
    assert hits >= 0.75 * sum(r.predicted for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_rows(spark):
    got = spark.range(200).select("id", toxicity.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in got)


def test_spans_are_the_toxic_words(spark):
    plain = ["well you plain words are there again"] * 20
    model = toxicity.fit([f"well you {w} there" for w in ("scum", "moron") * 20], plain)
    rows = [(1, "oh you scum moron, yes"), (2, None), (3, ""), (4, "1 2 3"), (5, "fine")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.score(docs, model, ["doc_id"]).collect()}
    assert [(s.start, s.end) for s in got[1].spans] == [(7, 17)] and got[1].predicted == 1
    assert all(not got[k].predicted and got[k].spans == [] for k in (2, 3, 4, 5))
    nothing = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score(docs, nothing, []).count() == 5
    assert toxicity.score(docs.limit(0), model, ["doc_id"]).count() == 0


def test_forward_backward_equals_enumeration():
    from itertools import product

    import numpy as np

    draw = np.random.default_rng(0)
    odds, change = draw.normal(size=6) * 3, draw.normal(size=(2, 2))
    ahead, back = toxicity._messages(odds, np.array([True] + [False] * 5), change)
    weights = {
        s: np.exp(sum(o * x for o, x in zip(odds, s, strict=True)) + sum(change[a, b] for a, b in zip(s, s[1:], strict=False)))
        for s in product((0, 1), repeat=6)
    }
    total = sum(weights.values())
    for t in range(6):
        share = sum(w for s, w in weights.items() if s[t]) / total
        assert toxicity._sigmoid(ahead + back)[t] == pytest.approx(share, abs=1e-6)


def test_resampling_prefers_the_target(spark):
    rows = [(i, "good clean words of the usual kind " * 5) for i in range(90)]
    rows += [(100 + i, "###junk $$$noise " * 15) for i in range(10)] + [(200, None), (201, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(45)] + [(100 + i, 0) for i in range(5)], "doc_id long, quality int")
    got = {r.doc_id: r for r in resampling.resample(docs, labels).collect()}
    assert all(got[i].kept for i in range(90)) and not any(got[100 + i].kept for i in range(10))
    assert got[200].log_weight == got[201].log_weight == 0.0
    assert len(resampling.resample(docs, labels.limit(0)).where("kept").collect()) == 102
    assert resampling.resample(docs.limit(0), labels).count() == 0


def test_threshold_is_the_kth_largest(spark):
    draw = random.Random(4)
    values = [draw.gauss(0, 1) for _ in range(500)] + [0.5] * 20
    keys = spark.createDataFrame([(v,) for v in values], "key double")
    for k in (1, 100, 520):
        assert resampling.threshold(keys, k) == sorted(values)[-k]
    assert resampling.threshold(keys, 521) is None


def test_encodings_equal_the_library(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    draw = random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyz    ''\t\n.,!?01²½٣éüßñÉǺİΣ \x1c\x85 中文😀_-aeioſKⅣ"
    texts = [None, "", " ", "<|endoftext|>Hi<|startoftext|> I'M", "a" * 3000, "don't we'll"]
    texts += ["".join(draw.choice(letters) for _ in range(draw.randint(1, 60))) for _ in range(400)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    got = {r.doc_id: r for r in bpe.encode(docs, vocabulary(), ["doc_id"], digests=True).collect()}
    for i, t in enumerate(texts):
        ids = own.encode(t or "", add_special_tokens=False).ids
        packed = b"".join(n.to_bytes(4, "little") for n in ids)
        text = own.decode(ids, skip_special_tokens=False)
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(packed).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    encoded = bpe.encode(docs, vocabulary(), ["doc_id"])
    decoded = {r.doc_id: r.text for r in bpe.decode(encoded, vocabulary()).collect()}
    assert decoded[5] == own.decode(own.encode(texts[5]).ids, skip_special_tokens=False)
    assert bpe.encode(docs.limit(0), vocabulary(), ["doc_id"]).count() == 0


PATTERNS = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def plain_spans(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            fits = (
                True,
                kind == 1 and all(int(p) <= 255 for p in m.group().split(".")),
                12 <= len(digits) <= 19 and pii.luhn(digits),
                9 <= len(digits) <= 15,
            )[kind]
            if fits:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_spans_equal_the_patterns():
    draw = random.Random(2)
    pieces = ["a@b.c", "@", "x.y+z@d-e.fr", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111", "+1 (888) 555-6841", "+12", ".", " ", "é", "-", "7", "00", "\n", "%"]
    for _ in range(3000):
        text = "".join(draw.choice(pieces) for _ in range(draw.randint(0, 12)))
        assert pii.base_spans(text) == plain_spans(text)


def test_tagger_adds_other_spellings_and_leaves_the_rest(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    tagger = pii.train(docs)
    rows = [(1, "call (888) 555-6841 now"), (2, "id 0b96a8c8d79c4a5085c919698889f59b72ab7bb6 x"), (3, None), (4, ""), (5, "mail ab.12@mail1.example.com now")]
    some = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find(some, tagger, ["doc_id"]).collect()}
    assert got[1].spans == "phone:5:19" and got[1].n_phone == 0
    assert got[2].spans == got[3].spans == got[4].spans == ""
    assert got[5].spans == "email:5:28" and got[5].n_email == 1
    clean = {r.doc_id: r.text for r in pii.redact(some, tagger).collect()}
    assert clean[1] == "call <PHONE> now" and clean[5] == "mail <EMAIL> now" and clean[3] is None
    assert pii.train(some.where("doc_id = 4")) is None
    assert pii.find(some, None, ["doc_id"]).count() == 5
    assert pii.find(some.limit(0), tagger, ["doc_id"]).count() == 0


class _MarksAll:
    """Takes all it is shown for one address."""

    def emissions(self, codes):
        marked = np.where(np.asarray(codes) == pii._PAD, 0, 2)
        return np.eye(pii.TAGS)[marked], None, None

    def decode(self, stretches):
        return [s.argmax(axis=1) for s in stretches]


@pytest.mark.parametrize("local", [10, 40, 130])
@pytest.mark.parametrize("domain", [10, 30, 60])
def test_long_addresses_are_seen_whole(local, domain):
    text = f"{'a' * local} @ {'b' * domain}.example.org"
    assert pii.added_spans([text], [[]], _MarksAll()) == [[(0, 0, len(text))]]
    lines = f"no more\n{'c' * 30}\n" + "1" * 5000 + f" {text}"
    regions = list(pii._regions(lines))
    assert all(a < b for a, b in regions) and all(x[1] < y[0] for x, y in zip(regions, regions[1:]))
    assert regions[-1][1] == len(lines)


def test_every_good_document_is_in_the_target(spark, monkeypatch):
    monkeypatch.setattr(resampling, "TARGET_DOCUMENTS", 3, raising=False)
    docs = spark.createDataFrame([(i, f"word{i} word{i}") for i in range(40)], "doc_id long, text string")
    labels = [(i, 1) for i in range(20)] + [(5, 1), (99, 1), (None, 1)] + [(i, 0) for i in range(20, 30)]
    got = resampling.resample(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert len(got) == 40
    weight = {r.doc_id: r.log_weight for r in got}
    assert min(weight[i] for i in range(20)) > 0 > max(weight[i] for i in range(20, 40))


def test_log_weights_equal_counting_by_hand(spark):
    """Both models and every weight on a whole table, n-gram by n-gram in plain Python."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    good = {r.doc_id for r in labels.collect() if r.quality == 1}

    def ngrams(text):
        h = [zlib.crc32(w.encode()) for w in re.findall(r"[^\x20\x09-\x0D]+", text)]
        for x in h:
            yield x % resampling.BUCKETS
        for x, y in zip(h, h[1:]):
            z = (x * 2654435761 + y * 40503 + 1) % 2**64
            yield (z ^ z >> 29) % resampling.BUCKETS

    raw, target = [0] * resampling.BUCKETS, [0] * resampling.BUCKETS
    for i, text in texts.items():
        for g in ngrams(text):
            raw[g] += 1
            target[g] += i in good
    n, m = sum(raw) + resampling.BUCKETS, sum(target) + resampling.BUCKETS
    p = [(x + 1) / n for x in raw]
    ratio = [np.log((t + q * resampling.BUCKETS) / m / q) for t, q in zip(target, p)]
    got = {r.doc_id: r for r in resampling.resample(docs, labels).collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        assert abs(got[i].log_weight - sum(ratio[g] for g in ngrams(text))) < 1e-6 * (1 + len(text))
    k = round(len(texts) * sum(r.quality == 1 for r in labels.collect()) / labels.count())
    keys = sorted((r.key for r in got.values()), reverse=True)
    assert all(r.kept == (r.key >= keys[k - 1]) for r in got.values())


def test_gradient_and_best_tags_equal_enumeration(monkeypatch):
    monkeypatch.setattr(pii, "TAGS", 3)
    monkeypatch.setattr(pii, "HIDDEN", 3)
    tagger = pii.Tagger.fresh(4)
    draw = np.random.default_rng(5)
    tagger.weights["t"] = draw.normal(0, 1, (3, 3))
    codes, tags = draw.integers(0, 9, (5, 2)), draw.integers(0, 3, (5, 2))

    def total(scores, path):
        change = tagger.weights["t"]
        moves = sum(change[a, b] for a, b in zip(path, path[1:]))
        return sum(scores[t, x] for t, x in enumerate(path)) + moves

    def loss():
        scores = tagger.emissions(codes)[0]
        sums = [
            np.log(sum(np.exp(total(scores[:, k], p)) for p in paths)) - total(scores[:, k], tags[:, k])
            for k in range(2)
        ]
        return sum(sums) / 2

    paths = list(itertools.product(range(3), repeat=5))
    found, slope = tagger.gradient(codes, tags)
    assert abs(found - loss()) < 1e-9
    for name, w in tagger.weights.items():
        for at in [tuple(draw.integers(0, n) for n in w.shape) for _ in range(6)]:
            w[at] += 1e-5
            up = loss()
            w[at] -= 2e-5
            down = loss()
            w[at] += 1e-5
            assert abs((up - down) / 2e-5 - slope[name][at]) < 1e-6, name
    scores = tagger.emissions(codes)[0]
    best = tagger.decode([scores[:, 0], scores[:3, 1], scores[:, 1]])
    for found, (k, n) in zip(best, [(0, 5), (1, 3), (1, 5)], strict=True):
        ways = itertools.product(range(3), repeat=n)
        assert tuple(found) == max(ways, key=lambda p: total(scores[:n, k], p))


def planted_forms(draw):
    """Personal data in spellings that the patterns do not take, by form."""
    digits = "".join(draw.choice("0123456789") for _ in range(10))
    card = next(c for c in (f"4{digits}{draw.randrange(10**5):05d}" for _ in itertools.count()) if pii.luhn(c))
    name = "".join(draw.choice("abcdefghijkl") for _ in range(draw.randint(4, 9)))
    return {
        "email, blanks": (0, f"{name}.{digits[:2]} @ mail{digits[2]}.example.com"),
        "email, bracketed": (0, f"{name}(at)@mail{digits[2]}.example.com"),
        "card, dots": (2, f"{card[:4]}.{card[4:8]}.{card[8:12]}.{card[12:]}"),
        "phone, no plus": (3, f"({digits[:3]}) 555-{digits[3:7]}"),
        "phone, hyphens": (3, f"{digits[:3]}-{digits[3:6]}-{digits[6:]}"),
        "phone, dots (never taught)": (3, f"{digits[:3]}.{digits[3:6]}.{digits[6:]}"),
    }


def test_tagger_finds_planted_spellings_in_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("text IS NOT NULL")
    tagger = pii.train(docs.where("doc_id % 4 <> 2"))
    held = docs.where("doc_id % 4 = 2 AND length(text) > 200").orderBy("doc_id").limit(1200).collect()
    draw, texts, planted = random.Random(8), [], []
    for n, r in enumerate(held):
        words = r.text.split(" ")
        at = draw.randrange(len(words))
        lead = " ".join(words[:at] + [""]) if at else ""
        form, (kind, span) = sorted(planted_forms(draw).items())[n % 6]
        texts.append(f"{lead}{span} " + " ".join(words[at:]))
        planted.append((form, (len(lead), kind, len(lead) + len(span))))
    bases = [pii.base_spans(t) for t in texts]
    added = pii.added_spans(texts, bases, tagger)
    caught, asked, false = Counter(), Counter(), 0
    for (form, span), more in zip(planted, added, strict=True):
        asked[form] += 1
        caught[form] += any(s < span[2] and span[0] < e and k == span[1] for s, k, e in more)
        false += sum(not (s < span[2] and span[0] < e) for s, _, e in more)
    share = {form: caught[form] / asked[form] for form in asked}
    print(share, false, sum(map(len, added)))
    assert false <= 0.02 * sum(map(len, added))
    assert min(share[f] for f in share if "never" not in f) >= 0.8, share
