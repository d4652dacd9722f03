"""Toxic spans by a linear-chain conditional random field, and scores of documents.

Labels say which documents are toxic, so tokens are labelled first: in the sample's
toxic documents, those words and beginnings of words that clean documents lack. The
field has two states, toxic or not; a token's features are itself and its beginnings,
hashed. Forward and backward messages give each token's probability of being toxic;
a document's score comes from the largest and from their sum.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heapreplace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bounds of the training sample, drawn by hash of doc_id.
TOXIC_DOCUMENTS = 1500
CLEAN_DOCUMENTS = 2000
TRAINING_WORDS = 3000  # longer documents are not drawn
SEGMENT = 24  # tokens in a training sequence
SEGMENTS = 3000  # of either kind
STEPS = 40

HASHED = 1 << 18  # features
BEGINNINGS = (3, 4, 5, 6, 7, 8)
KNOWN_WORDS = 300_000  # whose weight a task remembers
BATCH_TEXTS = 256

_TOKEN = re.compile(r"[^\W\d_]+")


def _names(word: str) -> list[str]:
    return [f"={word}", *[word[:n] for n in BEGINNINGS if len(word) > n]]


def _features(word: str) -> list[int]:
    return [zlib.crc32(n.encode("utf-8", "surrogatepass")) % HASHED for n in _names(word)]


@dataclass
class Model:
    weights: np.ndarray  # of features, for toxic against not
    bias: float
    change: np.ndarray  # change[i, j]: from state i to state j
    calibration: np.ndarray


def _tokens(text: str) -> list[str]:
    return [w.lower() for w in _TOKEN.findall(text)]


def label_tokens(toxic: list[list[str]], clean: list[list[str]]) -> set[str]:
    """Names of features that mark a token of a toxic document as toxic.

    Taken greedily: each explains the most toxic documents that fewer than three others
    explain yet, and is twenty times as frequent in toxic documents as in clean ones.
    So copies of one document do not make their own words toxic.
    """
    holders: dict[str, list[int]] = defaultdict(list)
    for i, words in enumerate(toxic):
        for name in {n for w in set(words) for n in _names(w)}:
            holders[name].append(i)
    in_clean: Counter[str] = Counter()
    for words in clean:
        in_clean.update({n for w in set(words) for n in _names(w)} & holders.keys())
    ratio = (len(clean) + 1) / (len(toxic) + 1)
    marks = {
        name: docs
        for name, docs in holders.items()
        if len(docs) >= 3 and (len(docs) + 0.5) * ratio >= 20 * (in_clean[name] + 0.5)
    }
    explained = np.zeros(len(toxic), int)

    def worth(name: str) -> tuple[float, int, str]:
        # Of equals the longest: a whole word rather than its beginning.
        gain = int((explained[marks[name]] < 3).sum())
        return (gain / (1 + in_clean[name]) if gain >= 3 else 0.0, len(name), name)

    chosen: set[str] = set()
    # Worth only falls, so the first whose worth still stands is the best.
    queue = [_Down(worth(n)) for n in marks]
    heapify(queue)
    while queue:
        name = queue[0].worth[2]
        now = _Down(worth(name))
        if not now.worth[0]:
            heappop(queue)
        elif now.worth < queue[0].worth:
            heapreplace(queue, now)
        else:
            heappop(queue)
            chosen.add(name)
            explained[marks[name]] += 1
    return chosen


@dataclass
class _Down:
    """Sorts the greatest worth first."""

    worth: tuple[float, int, str]

    def __lt__(self, other: _Down) -> bool:
        return self.worth > other.worth


def _messages(
    odds: np.ndarray, first: np.ndarray, change: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward log-odds of the toxic state for sequences end to end.

    ``odds`` has each token's own log-odds, ``first`` marks where sequences begin. The
    forward message holds the token's own, the backward one does not; their sum is the
    posterior log-odds. A message depends on its neighbour's less than in full, so
    passing all of them at once, again and again, settles after a few times.
    """
    last = np.append(first[1:], True)

    def step(r: np.ndarray, m: np.ndarray) -> np.ndarray:
        x = np.exp(np.clip(r, -30, 30))
        return np.log((m[0, 1] + m[1, 1] * x) / (m[0, 0] + m[1, 0] * x))

    def settle(own: np.ndarray, alone: np.ndarray, m: np.ndarray) -> np.ndarray:
        """From left to right: own odds and what comes from the one before."""
        found = own.copy()
        for _ in range(len(own)):
            passed = np.zeros_like(own)
            passed[1:] = step(found[:-1], m)
            passed[alone] = 0
            passed += own
            moved = np.abs(passed - found).max(initial=0.0)
            found = passed
            if moved < 1e-9:
                break
        return found

    ahead = settle(odds, first, np.exp(change))
    back = settle(odds[::-1], last[::-1], np.exp(change.T))[::-1] - odds
    return ahead, back


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _fit_field(
    sequences: list[list[str]], marks: list[list[bool]]
) -> tuple[np.ndarray, float, np.ndarray]:
    """Weights, bias and changes of state that make the labelled sequences likely."""
    words = sorted({w for s in sequences for w in s})
    number = {w: i for i, w in enumerate(words)}
    word_of, feature_of = np.array([(i, f) for i, w in enumerate(words) for f in _features(w)]).T
    ids = np.array([number[w] for s in sequences for w in s])
    gold = np.array([m for row in marks for m in row], float)
    first = _first([len(s) for s in sequences])
    pairs = ~first[1:]
    seen = np.array(
        [[((gold[:-1] == i) & (gold[1:] == j) & pairs).sum() for j in (0, 1)] for i in (0, 1)]
    )
    weights, bias, change = np.zeros(HASHED), -2.0, np.zeros((2, 2))
    squares, squares_b, squares_c = np.full(HASHED, 1e-3), 1e-3, np.full((2, 2), 1e-3)
    for _ in range(STEPS):
        own = np.bincount(word_of, weights[feature_of], len(words)) + bias
        odds = own[ids]
        ahead, back = _messages(odds, first, change)
        slope = gold - _sigmoid(ahead + back)
        by_word = np.bincount(ids, slope, len(words))
        g = np.bincount(feature_of, by_word[word_of], HASHED) - 0.01 * weights
        # Expected changes of state.
        left, right = ahead[:-1][pairs], (back + odds)[1:][pairs]
        joint = np.stack([change[i, j] + i * left + j * right for i in (0, 1) for j in (0, 1)])
        joint = np.exp(joint - joint.max(axis=0))
        expected = (joint / joint.sum(axis=0)).sum(axis=1).reshape(2, 2)
        g_c = seen - expected - 0.01 * change
        g_b = slope.sum()
        squares += g * g
        squares_b += g_b * g_b
        squares_c += g_c * g_c
        weights += 0.7 * g / np.sqrt(squares)
        bias += 0.3 * g_b / np.sqrt(squares_b)
        change += 0.2 * g_c / np.sqrt(squares_c)
    return weights, float(bias), change


def _first(lengths: list[int]) -> np.ndarray:
    """Where sequences of these lengths (none of them 0) begin, end to end."""
    first = np.zeros(sum(lengths), bool)
    first[np.cumsum([0, *lengths[:-1]])] = True
    return first


def _summary(p: np.ndarray) -> tuple[float, float, float]:
    """What a document's score is made from."""
    if not len(p):
        return 1.0, 0.0, 0.0
    return 1.0, float(p.max()), float(np.log1p(p.sum()))


def _calibrate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a slightly penalised logistic regression."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = _sigmoid(x @ w)
        slope = x.T @ (y - p) - 0.1 * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w = w + step * min(1.0, 5.0 / (np.abs(step).max() + 1e-9))
    return w


class Scorer:
    """A fitted model with the weights of words that a task has met."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.known: dict[str, float] = {}

    def odds(self, words: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > KNOWN_WORDS:
            known.clear()
        for w in set(words) - known.keys():
            known[w] = float(self.model.weights[_features(w)].sum()) + self.model.bias
        return np.fromiter(map(known.__getitem__, words), float, len(words))

    def marginals(self, documents: list[list[str]]) -> list[np.ndarray]:
        """Each token's probability of being toxic."""
        lengths = [len(d) for d in documents if d]
        if not lengths:
            return [np.empty(0)] * len(documents)
        odds = self.odds([w for d in documents for w in d])
        ahead, back = _messages(odds, _first(lengths), self.model.change)
        return np.split(_sigmoid(ahead + back), np.cumsum([len(d) for d in documents])[:-1])

    def score(self, p: np.ndarray) -> float:
        return float(_sigmoid(np.array(_summary(p)) @ self.model.calibration))


def fit(toxic: list[str], clean: list[str], seed: int = 7) -> Model:
    """A model from the texts of labelled documents; any number of either, none included."""
    toxic_words = [_tokens(t) for t in toxic]
    clean_words = [_tokens(t) for t in clean]
    chosen = label_tokens(toxic_words, clean_words)
    if not chosen:
        rate = (len(toxic) + 0.5) / (len(toxic) + len(clean) + 10)
        base = np.array([np.log(rate / (1 - rate)), 0.0, 0.0])
        return Model(np.zeros(HASHED), -10.0, np.zeros((2, 2)), base)
    draw = np.random.default_rng(seed)
    hits, misses = [], []
    for words, is_toxic in [(w, True) for w in toxic_words] + [(w, False) for w in clean_words]:
        marks = [is_toxic and not chosen.isdisjoint(_names(w)) for w in words]
        for at in range(0, len(words), SEGMENT):
            piece = (words[at : at + SEGMENT], marks[at : at + SEGMENT])
            (hits if any(piece[1]) else misses).append(piece)
    picked = []
    for pieces in (hits, misses):
        order = draw.permutation(len(pieces))[:SEGMENTS]
        picked += [pieces[i] for i in order]
    weights, bias, change = _fit_field([s for s, _ in picked], [m for _, m in picked])
    model = Model(weights, bias, change, np.zeros(3))
    p = Scorer(model).marginals(toxic_words + clean_words)
    model.calibration = _calibrate(
        np.array([_summary(x) for x in p]),
        np.array([1.0] * len(toxic_words) + [0.0] * len(clean_words)),
    )
    return model


def held_out(doc_id: Column) -> Column:
    """Whether a document's label is for testing only."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``.

    A bounded sample, ``TOXIC_DOCUMENTS`` and ``CLEAN_DOCUMENTS`` documents of at most
    ``TRAINING_WORDS`` words drawn by hash of doc_id, comes to the driver. Held-out
    labels, NULL labels and documents without text are left out.
    """
    known = labels.where(
        F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))
    ).select("doc_id", (F.col("toxic") == 1).alias("toxic"))
    drawn: dict[bool, list[int]] = {}
    for kind, most in ((True, TOXIC_DOCUMENTS), (False, CLEAN_DOCUMENTS)):
        rows = known.where(F.col("toxic") == kind).distinct()
        rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).collect()
        drawn[kind] = [r["doc_id"] for r in rows]
    both = set(drawn[True]) & set(drawn[False])
    texts: dict[bool, list[str]] = {True: [], False: []}
    wanted = {i: k for k, ids in drawn.items() for i in ids if i not in both}
    if wanted:
        chosen = docs.sparkSession.createDataFrame([(i,) for i in wanted], "doc_id long")
        rows = (
            docs.select("doc_id", F.col("text").cast("string").alias("text"))
            .where(F.length("text") <= TRAINING_WORDS * 6)
            .join(F.broadcast(chosen), "doc_id", "left_semi")
            .collect()
        )
        for row in sorted(rows, key=lambda r: (r["doc_id"], r["text"])):
            texts[wanted[row["doc_id"]]].append(row["text"])
    return fit(texts[True], texts[False])


def score(docs: DataFrame, model: Model, keep: list[str], threshold: float = 0.3) -> DataFrame:
    """``score``, ``predicted`` and ``spans`` of every whole text, beside ``keep``.

    ``spans`` has ``start`` and ``end`` (code points, end exclusive) of each run of
    tokens that are toxic with a probability of a half or more. NULL, empty and blank
    texts have no tokens and get the score of a document without anything toxic. Only
    the text is looked at. Rows neither merge nor change places.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in keep if c not in ("score", "predicted", "spans")]
    rows = docs.select(
        *[F.col(f"`{c}`") for c in keep], F.col("text").cast("string").alias("_text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_TEXTS):
                batch = whole.slice(at, BATCH_TEXTS)
                texts = [t or "" for t in batch.column(len(keep)).to_pylist()]
                p = scorer.marginals([_tokens(t) for t in texts])
                scores = [scorer.score(x) for x in p]
                spans = [_spans(t, x) for t, x in zip(texts, p, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns[: len(keep)],
                        pa.array(scores, pa.float64()),
                        pa.array([int(s >= threshold) for s in scores], pa.int32()),
                        pa.array(spans, _SPANS),
                    ],
                    names=[*keep, "score", "predicted", "spans"],
                )

    old = "".join(
        f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[: len(keep)]
    )
    return rows.mapInArrow(
        run, f"{old}score double, predicted int, spans array<struct<start: int, end: int>>"
    )


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _spans(text: str, p: np.ndarray) -> list[dict[str, int]]:
    hot = np.flatnonzero(p >= 0.5)
    if not len(hot):
        return []
    places = [m.span() for m in _TOKEN.finditer(text)]
    found: list[dict[str, int]] = []
    last = -2
    for i in hot.tolist():
        if i == last + 1:
            found[-1]["end"] = places[i][1]
        else:
            found.append({"start": places[i][0], "end": places[i][1]})
        last = i
    return found
