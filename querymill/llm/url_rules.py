"""URL filters by one bit-parallel automaton for all wildcard rules.

A rule is a glob over a canonical URL, host then path then query. A glob of m characters
is m + 1 states, a bit each: bit i is set while the text read so far can be matched by
the first i characters. All rules' states lie side by side in 64-bit words. Reading a
character shifts the states on where the character fits (Shift-And, with a carry from word
to word), and leaves those in place where a wildcard loops on it. A task runs whole
batches of URLs in step, one column of characters at a time.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bytes of automaton states that a task holds at once.
STATE_BYTES = 16 << 20

# What a single * stops at, the ends of a host and of a path.
STOPS = "/?"

RESULTS = ("host", "path", "rule", "verdict", "pattern")


@dataclass(frozen=True)
class Rule:
    """``block`` or ``allow`` for a host, its subdomains and a beginning of the path."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def globs(self) -> tuple[str, str]:
        return f"{self.text}**", f"*.{self.text}**"


@dataclass(frozen=True)
class Glob:
    """``block`` or ``allow`` for canonical URLs that ``pattern`` matches as a whole.

    ``*`` stands for any run without ``/`` and ``?``, ``**`` for any run; other characters
    stand for themselves.
    """

    verdict: str
    pattern: str


def _tokens(glob: str) -> list[str]:
    """Characters and wildcards of a glob; neighbouring wildcards join."""
    found: list[str] = []
    at = 0
    while at < len(glob):
        if glob[at] != "*":
            found.append(glob[at])
            at += 1
            continue
        end = at
        while end < len(glob) and glob[end] == "*":
            end += 1
        found.append("*" if end - at == 1 else "**")
        at = end
    return found


class Automaton:
    """All globs at once. ``first(texts)`` gives each text's first matching glob, or -1."""

    def __init__(self, globs: Sequence[str]) -> None:
        tokens = [_tokens(glob) for glob in globs]
        letters = sorted({t for glob in tokens for t in glob if t[0] != "*"} | set(STOPS))
        self.letters = np.array([ord(c) for c in letters], np.uint32)
        number = {c: i + 1 for i, c in enumerate(letters)}  # 0: any other character
        bits = sum(1 + sum(t[0] != "*" for t in glob) for glob in tokens)
        self.words = words = max(1, -(-bits // 64))
        steps = np.zeros((len(letters) + 1, words), np.uint64)
        loops = np.zeros_like(steps)
        start, self.last = np.zeros(words, np.uint64), []
        stops = [number[c] for c in STOPS]
        at = 0
        for glob in tokens:
            start[at // 64] |= np.uint64(1 << at % 64)
            for token in glob:
                if token[0] != "*":
                    at += 1
                    steps[number[token], at // 64] |= np.uint64(1 << at % 64)
                    continue
                word, bit = at // 64, np.uint64(1 << at % 64)
                looping = np.ones(len(steps), bool)
                if token == "*":
                    looping[stops] = False
                loops[looping, word] |= bit
            self.last.append(at)
            at += 1
        self.start, self.steps, self.loops = start, steps, loops

    def _classes(self, texts: list[str]) -> np.ndarray:
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        place = np.minimum(np.searchsorted(self.letters, codes), len(self.letters) - 1)
        return np.where(self.letters[place] == codes, place + 1, 0).astype(np.int32)

    def states(self, texts: list[str]) -> np.ndarray:
        """States after each whole text, a row of words each."""
        lengths = np.array([len(t) for t in texts], np.int64)
        flat = self._classes(texts)
        begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        # Longest first, so that the texts still to be read are the leading ones.
        order = np.argsort(-lengths, kind="stable")
        begin, ends = begin[order], np.sort(lengths)
        state = np.tile(self.start, (len(texts), 1))
        for t in range(int(lengths.max(initial=0))):
            n = len(texts) - int(np.searchsorted(ends, t, side="right"))
            now = state[:n]
            letter = flat[begin[:n] + t]
            moved = now << np.uint64(1)
            if self.words > 1:
                moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            moved &= self.steps[letter]
            now &= self.loops[letter]
            now |= moved
            if not now.any():
                break
        out = np.empty_like(state)
        out[order] = state
        return out

    def first(self, texts: list[str]) -> np.ndarray:
        found = np.full(len(texts), -1, np.int64)
        step = max(1, STATE_BYTES // (8 * self.words))
        for at in range(0, len(texts), step):
            state = self.states(texts[at : at + step])
            part = found[at : at + step]
            for glob in range(len(self.last) - 1, -1, -1):
                word, bit = divmod(self.last[glob], 64)
                part[(state[:, word] >> np.uint64(bit)) & np.uint64(1) == 1] = glob
        return found


def parts(url: Column) -> tuple[Column, Column, Column]:
    """Host in lower case (A-Z only), path, and query with its question mark.

    The host begins after the first ``://``; without one, or for NULL, all are empty.
    The fragment belongs to none of them.
    """
    whole = F.coalesce(url.cast("string"), F.lit(""))
    split = r"(?s)\A.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"
    capitals = "".join(map(chr, range(65, 91)))
    host = F.translate(F.regexp_extract(whole, split, 1), capitals, capitals.lower())
    return host, F.regexp_extract(whole, split, 2), F.regexp_extract(whole, split, 3)


def judge(
    urls: DataFrame,
    rules: Sequence[Rule],
    globs: Sequence[Glob] = (),
    default: str = "allow",
    keep: Sequence[str] = (),
    url: str = "url",
) -> DataFrame:
    """Verdict on every row's URL, beside the columns ``keep``.

    Adds host, path, rule (text of the longest rule that fits, else NULL), verdict, and
    pattern (the glob that decided, where no rule fits). Of rules of one length a blocking
    one counts first. Where no rule fits, the glob with most characters besides its
    wildcards decides, blocking ones first among equals; where none does, ``default``.

    One narrow pass: repeated, NULL, empty and very long URLs are rows like any other, and
    no row is looked at beside another one except to read them in step. NULL and a text
    without ``://`` have an empty host and path, which no rule fits. A column of ``urls``
    called like a result is replaced. Work grows with the characters of the URLs times
    the words of states, one for each 64 characters of all rules.
    """
    for verdict in [*[one.verdict for one in [*rules, *globs]], default]:
        if verdict not in ("allow", "block"):
            raise ValueError(f"a verdict is allow or block, not {verdict!r}")
    ranked = sorted(set(rules), key=lambda r: (-len(r.text), r.verdict != "block", r.text))
    literal = {g: sum(t[0] != "*" for t in _tokens(g.pattern)) for g in globs}
    more = sorted(literal, key=lambda g: (-literal[g], g.verdict != "block", g.pattern))
    patterns = [glob for rule in ranked for glob in rule.globs] + [g.pattern for g in more]
    # What a pattern's number says; the last entry is that of number -1.
    texts = [r.text for r in ranked for _ in r.globs] + [None] * (len(more) + 1)
    shown = [None] * (2 * len(ranked)) + [g.pattern for g in more] + [None]
    verdicts = [r.verdict for r in ranked for _ in r.globs] + [g.verdict for g in more] + [default]
    automaton = Automaton(patterns)
    kept = [c for c in keep if c not in RESULTS]
    host, path, query = parts(F.col(f"`{url}`"))
    rows = urls.select(
        *[F.col(f"`{c}`") for c in kept], host.alias("host"), path.alias("path"), query.alias("_q")
    ).select(*[F.col(f"`{c}`") for c in kept], "host", "path", F.concat("host", "path", "_q"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = automaton.first(batch.column(batch.num_columns - 1).to_pylist())
            said = [
                pa.array(np.array(c, object)[number], pa.string()) for c in (texts, verdicts, shown)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *said], names=[*kept, *RESULTS])

    old = "".join(
        f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[: len(kept)]
    )
    return rows.mapInArrow(run, old + ", ".join(f"{name} string" for name in RESULTS))
