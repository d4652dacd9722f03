"""Personal data: fixed patterns, and what a small neural tagger finds besides.

The tagger is a bidirectional LSTM over characters with CRF transitions between tags,
trained here in numpy. Its labelled spans are what the patterns find in a bounded
sample of documents, as they are and rewritten (a phone number without its plus sign, a
card number in groups, an address with blanks about the @). Every place of a text that
could belong to a span is covered by overlapping windows; each place takes its tag
scores from the window that holds it nearest to the middle, and one pass of Viterbi over
the whole stretch finds its best tags.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from querymill.llm.common import drawn

KINDS = ("email", "ip", "card", "phone")  # fixed values, in this order

# Bounds of the training sample, drawn by hash of doc_id.
TRAINING_DOCUMENTS = 600
TRAINING_STRETCHES = 8
TRAINING_WINDOWS = 3000
SPELLINGS = 4  # of each labelled span
EPOCHS = 8
BATCH = 128

WINDOW = 96  # characters decoded together
STRIDE = 48
MARGIN = 24  # at least, about each character that a span must hold
HIDDEN = 12
WINDOWS_AT_ONCE = 2048
BATCH_TEXTS = 512

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
# No match begins within a run of digits: where the run's first digit fails, so do all.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_TRIGGER = re.compile(r"[0-9@]")

Span = tuple[int, int, int]  # start, number of the kind, end


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses, each @ looked at once."""
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            yield start, match.end()
            free = match.end()
        at = text.find("@", max(at + 1, free))


def luhn(digits: str) -> bool:
    total = 0
    for n, d in enumerate(reversed(digits)):
        x = int(d) * (1 + n % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[Span]:
    """What the patterns find, by start, then kind."""
    found = [(s, 0, e) for s, e in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(map(_small, m.group().split("."))):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = _NOT_DIGIT.sub("", m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def spelled(spans: list[Span]) -> str:
    return ",".join([f"{KINDS[k]}:{s}:{e}" for s, k, e in spans])


# ---------------------------------------------------------------- the tagger

OUT = 0  # tags: 0, then begin and inside of each kind
TAGS = 1 + 2 * len(KINDS)


def _classes() -> np.ndarray:
    """Class of each code point below 256; the last one is for all others."""
    table = np.zeros(257, np.int64)
    names: dict[str, int] = {}
    for c in range(256):
        ch = chr(c)
        if ch.isdigit() and c < 128:
            kind = "digit"
        elif ch.isalpha():
            kind = "upper" if ch.isupper() else "lower"
        elif ch.isspace():
            kind = "space"
        elif c < 128 and ch.isprintable():
            kind = ch
        else:
            kind = "other"
        table[c] = names.setdefault(kind, len(names))
    table[256] = names.setdefault("beyond", len(names))
    return table


_CLASS = _classes()
N_CLASSES = int(_CLASS.max()) + 2
_PAD = N_CLASSES - 1


def _codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _CLASS[np.minimum(points, 256)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Tagger:
    """Weights by name: ``x`` and ``h`` (inputs, state) of either direction, ``o`` (tag
    scores), ``t`` (changes of tag)."""

    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, seed: int) -> Tagger:
        draw = np.random.default_rng(seed)
        w = {}
        for d in "fb":
            w[f"x{d}"] = draw.normal(0, 0.3, (N_CLASSES, 4 * HIDDEN))
            w[f"x{d}"][:, HIDDEN : 2 * HIDDEN] += 1.0  # forget gates begin open
            w[f"h{d}"] = draw.normal(0, 0.3, (HIDDEN, 4 * HIDDEN))
        w["o"] = draw.normal(0, 0.3, (2 * HIDDEN + 1, TAGS))
        w["t"] = np.zeros((TAGS, TAGS))
        return cls(w)

    def _run(self, codes: np.ndarray, d: str) -> tuple[np.ndarray, list]:
        """States of one direction, time first, and what the way back needs."""
        wx, wh, n = self.weights[f"x{d}"], self.weights[f"h{d}"], HIDDEN
        h = c = np.zeros((codes.shape[1], n))
        states, trace = np.empty((*codes.shape, n)), []
        for t in range(len(codes)) if d == "f" else range(len(codes) - 1, -1, -1):
            z = wx[codes[t]] + h @ wh
            gates = _sigmoid(z[:, : 3 * n])
            g = np.tanh(z[:, 3 * n :])
            i, f, o = gates[:, :n], gates[:, n : 2 * n], gates[:, 2 * n :]
            new = f * c + i * g
            tanh = np.tanh(new)
            trace.append((t, i, f, o, g, c, tanh, h))
            h, c = o * tanh, new
            states[t] = h
        return states, trace

    def _back(
        self, codes: np.ndarray, d: str, trace: list, slope: np.ndarray, out: dict
    ) -> None:
        wh, n = self.weights[f"h{d}"], HIDDEN
        gx, gh = np.zeros_like(self.weights[f"x{d}"]), np.zeros_like(wh)
        dh = dc = np.zeros((codes.shape[1], n))
        for t, i, f, o, g, c, tanh, h in reversed(trace):
            dh = dh + slope[t]
            dc = dc + dh * o * (1 - tanh**2)
            dz = np.concatenate(
                [
                    dc * g * i * (1 - i),
                    dc * c * f * (1 - f),
                    dh * tanh * o * (1 - o),
                    dc * i * (1 - g**2),
                ],
                axis=1,
            )
            np.add.at(gx, codes[t], dz)
            gh += h.T @ dz
            dh, dc = dz @ wh.T, dc * f
        out[f"x{d}"], out[f"h{d}"] = gx, gh

    def emissions(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple]:
        ahead, one = self._run(codes, "f")
        back, two = self._run(codes, "b")
        ones = np.ones((*codes.shape, 1))
        states = np.concatenate([ahead, back, ones], axis=2)
        return states @ self.weights["o"], states, (one, two)

    def gradient(self, codes: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
        """Mean loss of the right tags under the CRF, and its gradient."""
        scores, states, (one, two) = self.emissions(codes)
        change, (steps, n, _) = self.weights["t"], scores.shape
        alpha = np.empty_like(scores)
        alpha[0] = scores[0]
        for t in range(1, steps):
            alpha[t] = scores[t] + _logsum(alpha[t - 1][:, :, None] + change, 1)
        beta = np.zeros_like(scores)
        for t in range(steps - 2, -1, -1):
            beta[t] = _logsum(change + (scores[t + 1] + beta[t + 1])[:, None, :], 2)
        total = _logsum(alpha[-1], 1)
        share = np.exp(alpha + beta - total[:, None])
        gold = np.eye(TAGS)[tags]
        g_change = np.zeros_like(change)
        for t in range(1, steps):
            joint = alpha[t - 1][:, :, None] + change + (scores[t] + beta[t])[:, None, :]
            g_change += np.exp(joint - total[:, None, None]).sum(axis=0)
            g_change -= gold[t - 1].T @ gold[t]
        loss = total.sum() - (scores * gold).sum() - change[tags[:-1], tags[1:]].sum()
        slope = (share - gold) / n
        out = {"t": g_change / n, "o": np.tensordot(states, slope, ([0, 1], [0, 1]))}
        down = slope @ self.weights["o"].T
        self._back(codes, "f", one, down[:, :, :HIDDEN], out)
        self._back(codes, "b", two, down[:, :, HIDDEN : 2 * HIDDEN], out)
        return float(loss / n), out

    def decode(self, stretches: list[np.ndarray]) -> list[np.ndarray]:
        """Best tags of each stretch of tag scores (Viterbi)."""
        change, sizes = self.weights["t"], np.array([len(s) for s in stretches])
        scores = np.zeros((sizes.max(), len(sizes), change.shape[0]))
        for n, s in enumerate(stretches):
            scores[: len(s), n] = s
        best, came = scores[0], np.zeros(scores.shape, np.int8)
        came[:] = np.arange(change.shape[0])  # past a stretch's end nothing changes
        for t in range(1, len(scores)):
            on = np.flatnonzero(sizes > t)
            ways = best[on, :, None] + change
            came[t, on] = ways.argmax(axis=1)
            best[on] = ways.max(axis=1) + scores[t, on]
        tags = np.zeros(scores.shape[:2], np.int8)
        tags[-1] = best.argmax(axis=1)
        every = np.arange(len(sizes))
        for t in range(len(scores) - 1, 0, -1):
            tags[t - 1] = came[t][every, tags[t]]
        return [tags[:size, n] for n, size in enumerate(sizes)]


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def _rewritten(text: str, kind: int, draw: np.random.Generator) -> str:
    """A labelled span, as it is or in another spelling."""
    way = int(draw.integers(4))
    if kind == 0 and way == 0:
        return text.replace("@", " @ ")
    if kind == 0 and way == 1:
        return text.replace("@", "(at)@") if draw.integers(2) else text.upper()
    if kind == 2 and way <= 1:
        digits = _NOT_DIGIT.sub("", text)
        return "- ."[int(draw.integers(3))].join(re.findall(".{1,4}", digits))
    if kind == 3 and way == 0:
        return text.lstrip("+")
    if kind == 3 and way == 1:
        digits = _NOT_DIGIT.sub("", text)
        return f"{digits[:-10]}-{digits[-10:-7]}-{digits[-7:-4]}-{digits[-4:]}".lstrip("-")
    return text


def training_windows(texts: list[str], seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of characters with their tags, about labelled spans and other places."""
    draw = np.random.default_rng(seed)
    codes, tags = [], []

    def add(before: str, span: str, after: str, kind: int | None) -> None:
        lead = int(draw.integers(0, max(1, WINDOW - len(span))))
        before = before[max(0, len(before) - lead) :]
        row = np.full(WINDOW, _PAD)
        tag = np.zeros(WINDOW, np.int64)
        whole = _codes((before + span + after)[:WINDOW])
        row[: len(whole)] = whole
        if kind is not None:
            tag[len(before) : len(before) + len(span)] = 2 + 2 * kind
            if len(before) < WINDOW:
                tag[len(before)] = 1 + 2 * kind
        codes.append(row)
        tags.append(tag)

    for text in texts:
        spans = base_spans(text)
        for k, (start, kind, end) in enumerate(spans):
            # Neighbouring spans stay outside, so that no tag of theirs is missing.
            low = max([start - WINDOW, 0, *[e for _, _, e in spans[:k]]])
            high = min([end + WINDOW, len(text), *[s for s, _, _ in spans[k + 1 :]]])
            if low <= start and end <= high and end - start < WINDOW:
                for _ in range(SPELLINGS):
                    new = _rewritten(text[start:end], kind, draw)
                    if len(new) < WINDOW:
                        add(text[low:start], new, text[end:high], kind)
        taken = np.zeros(len(text), bool)
        for start, _, end in spans:
            taken[start:end] = True
        others = [m.start() for m in _TRIGGER.finditer(text) if not taken[m.start()]]
        if len(text):
            others = [others[i] for i in draw.permutation(len(others))[:2]]
            others.append(int(draw.integers(len(text))))
        for at in others:
            low, high = max(0, at - WINDOW // 2), at + WINDOW // 2
            if not taken[low:high].any():
                add("", text[low:high], "", None)
    order = draw.permutation(len(codes))[:TRAINING_WINDOWS]
    if not len(order):
        return np.empty((0, WINDOW), int), np.empty((0, WINDOW), int)
    return np.array(codes)[order], np.array(tags)[order]


def fit(texts: list[str], seed: int = 11) -> Tagger | None:
    """A tagger from whole texts; None if the patterns find nothing in them."""
    codes, tags = training_windows(texts, seed)
    if not tags.any():
        return None
    tagger = Tagger.fresh(seed)
    first = {k: np.zeros_like(v) for k, v in tagger.weights.items()}
    second = {k: np.zeros_like(v) for k, v in tagger.weights.items()}
    draw, step = np.random.default_rng(seed + 1), 0
    for epoch in range(EPOCHS):
        rate = 0.02 * (1 - epoch / EPOCHS)
        order = draw.permutation(len(codes))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            _, slope = tagger.gradient(codes[rows].T, tags[rows].T)
            step += 1
            size = np.sqrt(sum(float((g**2).sum()) for g in slope.values()))
            for k, g in slope.items():
                g = g * min(1.0, 5.0 / (size + 1e-9))
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                move = first[k] / (1 - 0.9**step)
                tagger.weights[k] -= rate * move / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return tagger


# ---------------------------------------------------------------- whole texts


def _regions(text: str) -> Iterator[tuple[int, int]]:
    """Stretches about digits and @, to the ends of the words that they would cut.

    A span without either is never accepted, so nothing else needs to be decoded.
    """
    start = end = -1
    for m in _TRIGGER.finditer(text):
        low, high = max(0, m.start() - MARGIN), min(len(text), m.end() + MARGIN)
        while low > max(end, 0) and not (text[low - 1].isspace() or text[low].isspace()):
            low -= 1
        if low > end:
            if end >= 0:
                yield start, end
            start = low
        if high > end:
            while high < len(text) and not (text[high - 1].isspace() or text[high].isspace()):
                high += 1
            end = high
    if end >= 0:
        yield start, end


def _acceptable(text: str, kind: int, start: int, end: int) -> bool:
    """Whether what the tagger marked can be of its kind, and is not part of a word."""
    span = text[start:end]
    if span != span.strip() or "\n" in span:
        return False
    if (start and text[start - 1].isalnum()) or (end < len(text) and text[end].isalnum()):
        return False
    digits = _NOT_DIGIT.sub("", span)
    letters = any(c.isalpha() for c in span)
    if kind == 0:
        left, _, right = span.partition("@")
        return bool(left.strip()) and _DOMAIN.fullmatch(right.strip()) is not None
    if kind == 1:
        parts = span.split(".")
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and _small(p) for p in parts)
    if kind == 2:
        return not letters and 12 <= len(digits) <= 19 and luhn(digits)
    return not letters and 9 <= len(digits) <= 15 and len(span) > len(digits)


def added_spans(texts: list[str], bases: list[list[Span]], tagger: Tagger) -> list[list[Span]]:
    """What the tagger finds in whole texts besides the base spans."""
    found: list[list[Span]] = [[] for _ in texts]
    pending: list[tuple[int, int, int]] = []  # text, region

    def decode() -> None:
        places, rows = [], []
        for n, (t, low, high) in enumerate(pending):
            codes = _codes(texts[t][low:high])
            for at in range(0, max(1, len(codes) - STRIDE), STRIDE):
                row = np.full(WINDOW, _PAD)
                piece = codes[at : at + WINDOW]
                row[: len(piece)] = piece
                rows.append(row)
                places.append((n, at, len(piece)))
        scores = [
            tagger.emissions(np.array(rows[i : i + WINDOWS_AT_ONCE]).T)[0].transpose(1, 0, 2)
            for i in range(0, len(rows), WINDOWS_AT_ONCE)
        ]
        whole = [np.zeros((high - low, scores[0].shape[2])) for _, low, high in pending]
        near = [np.full(high - low, -1) for _, low, high in pending]
        inner = np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1])
        for (n, at, size), row in zip(places, chain.from_iterable(scores), strict=True):
            depth = inner[:size].copy()
            if at == 0:
                depth[: WINDOW // 2] = WINDOW
            if at + size == len(whole[n]):
                depth[size // 2 :] = WINDOW
            better = depth > near[n][at : at + size]
            whole[n][at : at + size][better] = row[:size][better]
            near[n][at : at + size][better] = depth[better]
        for some in _of_similar_size([len(s) for s in whole]):
            for n, row in zip(some, tagger.decode([whole[n] for n in some]), strict=True):
                t, low, _ = pending[n]
                for start, kind, end in _runs(row):
                    span = (low + start, kind, low + end)
                    free = all(span[2] <= s or e <= span[0] for s, _, e in bases[t])
                    if free and _acceptable(texts[t], kind, span[0], span[2]):
                        found[t].append(span)
        pending.clear()

    size = 0
    for t, text in enumerate(texts):
        for low, high in _regions(text):
            pending.append((t, low, high))
            size += high - low
            if size > WINDOWS_AT_ONCE * WINDOW:
                decode()
                size = 0
    if pending:
        decode()
    return found


def _of_similar_size(sizes: list[int]) -> Iterator[list[int]]:
    """Places of ``sizes``, dealt out so that little room is left when all of a deal are
    filled up to the largest."""
    deal: list[int] = []
    for n in sorted(range(len(sizes)), key=sizes.__getitem__):
        if deal and (len(deal) + 1) * sizes[n] > max(WINDOWS_AT_ONCE * WINDOW, sizes[n]):
            yield deal
            deal = []
        deal.append(n)
    if deal:
        yield deal


def _runs(tags: np.ndarray) -> Iterator[Span]:
    """Spans of tags: a kind's tags in a row; a begin tag starts anew."""
    start, kind = -1, -1
    for at in [*np.flatnonzero(tags).tolist(), len(tags)]:
        tag = int(tags[at]) if at < len(tags) else 0
        new = (tag - 1) // 2 if tag else -1
        if start >= 0 and (at != end or new != kind or tag % 2 == 1):
            yield start, kind, end
            start = -1
        if tag and start < 0:
            start, kind = at, new
        end = at + 1


def train(docs: DataFrame) -> Tagger | None:
    """A tagger from ``docs(doc_id, text)``.

    At most ``TRAINING_DOCUMENTS`` texts that hold an @, or digits in number, are drawn by
    hash, equal ones once. Of each, at most ``TRAINING_STRETCHES`` stretches about digits
    and @ come to the driver, up to 100 characters before and 160 after, within a line:
    windows are of ``WINDOW`` characters, and a sample needs no more of them. That bounds
    the training only; ``find`` reads whole texts.
    """
    text = F.col("text").cast("string")
    about = F.regexp_extract_all(text, F.lit(r"[^\n]{0,100}[0-9@][^\n]{0,160}"), F.lit(0))
    holding = text.rlike(r"@|\+[0-9]|[0-9]{6}|[0-9]\.[0-9]+\.")
    h = F.xxhash64(text)
    rows = (
        drawn(docs, holding, h, TRAINING_DOCUMENTS)
        .select(h.alias("h"), F.slice(about, 1, TRAINING_STRETCHES).alias("about"))
        .groupBy("h")
        .agg(F.min("about").alias("about"))
        .orderBy("h")
        .limit(TRAINING_DOCUMENTS)
        .collect()
    )
    return fit([piece for row in rows for piece in row["about"]])


def _per_text(tagger: Tagger | None, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each text."""
    bases = [base_spans(t) for t in texts]
    more = added_spans(texts, bases, tagger) if tagger else [[] for _ in texts]
    return [(b, sorted(b + m)) for b, m in zip(bases, more, strict=True)]


def find(docs: DataFrame, tagger: Tagger | None, keep: list[str]) -> DataFrame:
    """Personal data in every whole text, beside the columns ``keep``.

    Adds n_email, n_ip, n_card, n_phone (what the patterns find), base_sha256 of their
    spans and ``spans``, those and the tagger's, each as ``kind:start:end`` in code
    points, by start. NULL and empty texts have none. Rows neither merge nor change
    places; a column of ``docs`` called like a result is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tagger)
    results = [*[f"n_{k}" for k in KINDS], "base_sha256", "spans"]
    keep = [c for c in keep if c not in results]
    rows = docs.select(
        *[F.col(f"`{c}`") for c in keep], F.col("text").cast("string").alias("_text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_TEXTS):
                batch = whole.slice(at, BATCH_TEXTS)
                texts = [t or "" for t in batch.column(len(keep)).to_pylist()]
                found = _per_text(shared.value, texts)
                counts = [
                    pa.array([sum(k == n for _, k, _ in base) for base, _ in found], pa.int64())
                    for n in range(len(KINDS))
                ]
                hashes = [hashlib.sha256(spelled(b).encode()).hexdigest() for b, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns[: len(keep)],
                        *counts,
                        pa.array(hashes, pa.string()),
                        pa.array([spelled(s) for _, s in found], pa.string()),
                    ],
                    names=[*keep, *results],
                )

    old = "".join(
        f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[: len(keep)]
    )
    new = ", ".join([*[f"n_{k} long" for k in KINDS], "base_sha256 string", "spans string"])
    return rows.mapInArrow(run, old + new)


def redact(docs: DataFrame, tagger: Tagger | None, lengths: str | None = None) -> DataFrame:
    """``docs`` with every span of personal data replaced by its kind in angle brackets.

    Overlapping spans are replaced as one, by the kind of the first. A NULL text stays
    NULL. ``lengths`` names a column that holds the text's length and is kept right.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tagger)
    names, where = docs.columns, docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_TEXTS):
                batch = whole.slice(at, BATCH_TEXTS)
                texts = batch.column(where).to_pylist()
                found = _per_text(shared.value, [t or "" for t in texts])
                new = [
                    None if t is None else _replaced(t, s)
                    for t, (_, s) in zip(texts, found, strict=True)
                ]
                columns = list(batch.columns)
                columns[where] = pa.array(new, pa.string())
                yield pa.RecordBatch.from_arrays(columns, names=names)

    out = docs.mapInArrow(run, docs.schema)
    if lengths is None:
        return out
    kind = docs.schema[lengths].dataType
    return out.withColumn(lengths, F.length("text").cast(kind))


def _replaced(text: str, spans: list[Span]) -> str:
    out, free = [], 0
    for start, kind, end in spans:
        if start >= free:
            out += [text[free:start], f"<{KINDS[kind].upper()}>"]
        free = max(free, end)
    return "".join([*out, text[free:]])
