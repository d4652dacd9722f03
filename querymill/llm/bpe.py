"""BPE encoding and decoding of words that share their prefixes.

For every string of symbols BPE has one last token, and what precedes that token is
encoded as it is alone. So the encoding of a word is known from the last tokens of its
prefixes, and words with a common prefix share them. A task inserts the distinct words
it meets into a trie and walks it depth first: at each node the last token is the one
that ends there and that BPE leaves apart from the last token before it. Only the
states on the path from the root are held.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a worker remembers from task to task, and the texts it takes at once.
KNOWN_WORDS = 150_000  # twice
KNOWN_PAIRS = 300_000
KNOWN_BYTES = 16 << 20  # of words and their encodings, twice
BATCH_BYTES = 1 << 20

# White space as the vocabulary's normaliser knows it, and the pattern of
# its words for texts in lower case.
_SPACES = r"\x09-\x0D\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
_SPACE = regex.compile(f"[{_SPACES}]+")
_PIECES = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^" + _SPACES + r"\p{L}\p{N}]+"
)
_ASCII_PIECES = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\x09-\x0D\x20a-z0-9]+"
)
END = "</w>"


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in the vocabulary.

    Printable Latin-1 bytes stand for themselves, the others for letters from U+0100 on.
    """
    own = {b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)}
    others = iter(range(256, 512))
    return {b: chr(b) if b in own else chr(next(others)) for b in range(256)}


class Encoder:
    """Encodings of words under one vocabulary file."""

    def __init__(self, vocabulary: str) -> None:
        model = json.loads(vocabulary)
        self.ids: dict[str, int] = model["model"]["vocab"]
        self.tokens = {i: t for t, i in self.ids.items()}
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.tokens.update({i: t for t, i in self.special.items()})
        self.split_special = re.compile(
            "|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True)) or r"(?!)"
        )
        self.rank: dict[tuple[str, str], int] = {}
        for n, pair in enumerate(model["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.rank.setdefault((left, right), n)
        letters = byte_letters()
        self.letter = [letters[b] for b in range(256)]
        # Tokens that BPE makes of their own text; no other one occurs in an encoding.
        # Lengths of longer tokens by their last two letters, the longest first.
        lengths: dict[str, set[int]] = {}
        for token in self.ids:
            body = token.removesuffix(END)
            if len(body) > 1:
                lengths.setdefault(body[-2:] + token[len(body) :], set()).add(len(body))
        self.lengths = {ending: sorted(n, reverse=True) for ending, n in lengths.items()}
        self.stands: dict[str, bool] = {}
        self.apart: dict[tuple[str, str], bool] = {}

    def merged(self, symbols: list[str]) -> list[str]:
        """BPE as it is defined: the pair of lowest rank first, the leftmost of equals."""
        rank, symbols = self.rank, list(symbols)
        while len(symbols) > 1:
            best, at = min(
                (rank.get(pair, 1 << 60), i)
                for i, pair in enumerate(zip(symbols, symbols[1:], strict=False))
            )
            if best == 1 << 60:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    @staticmethod
    def _symbols(token: str) -> list[str]:
        if token.endswith(END) and len(token) > len(END):
            body = token.removesuffix(END)
            return [*body[:-1], body[-1] + END]
        return list(token)

    def _stands(self, token: str) -> bool:
        known = self.stands.get(token)
        if known is None:
            known = token in self.ids and self.merged(self._symbols(token)) == [token]
            if len(self.stands) > KNOWN_PAIRS:
                self.stands.clear()
            self.stands[token] = known
        return known

    def _apart(self, left: str, right: str) -> bool:
        """Whether BPE leaves two neighbouring tokens as they are."""
        known = self.apart.get((left, right))
        if known is None:
            symbols = self._symbols(left) + self._symbols(right)
            known = self.merged(symbols) == [left, right]
            if len(self.apart) > KNOWN_PAIRS:
                self.apart.clear()
            self.apart[left, right] = known
        return known

    def _last(self, word: str, n: int, end: str, before: list[str]) -> str:
        """Last token of the first ``n`` letters and ``end``; ``before[m]`` is that of the
        first m letters."""
        ids, stands, apart = self.ids, self.stands, self.apart
        lengths = self.lengths.get(word[n - 2 : n] + end, ()) if n > 1 else ()
        for length in lengths:
            if length > n:
                continue
            token = word[n - length : n] + end
            if token in ids and (stands.get(token) or self._stands(token)):
                if length == n:
                    return token
                left = before[n - length]
                free = apart.get((left, token))
                if self._apart(left, token) if free is None else free:
                    return token
        token = word[n - 1] + end
        if token in ids and (n == 1 or self._apart(before[n - 1], token)):
            return token
        raise ValueError(f"no token ends {word[:n]!r}")

    def encode_words(self, words: list[str]) -> dict[str, list[str]]:
        """Tokens of each distinct word, given in the vocabulary's letters.

        The trie lies in the sorted words: words below a node are neighbours, and a
        word's depth in common with the one before is where the walk turns.
        """
        encoded: dict[str, list[str]] = {}
        before = [""]  # last tokens of the prefixes on the path
        path = ""
        for word in sorted(words):
            common = 0
            for a, b in zip(path, word, strict=False):
                if a != b:
                    break
                common += 1
            del before[common + 1 :]
            for n in range(len(before), len(word)):
                before.append(self._last(word, n, "", before))
            path = word[: len(before) - 1]
            tokens = [self._last(word, len(word), END, before)]
            left = len(word) - len(tokens[0].removesuffix(END))
            while left:
                tokens.append(before[left])
                left -= len(before[left])
            encoded[word] = tokens[::-1]
        return encoded

    # ------------------------------------------------------------ whole texts

    def pieces(self, text: str) -> list[str]:
        """Words of a text without special tokens."""
        if text.isascii():
            return _ASCII_PIECES.findall(text.lower())
        text = _SPACE.sub(" ", unicodedata.normalize("NFC", text))
        # Letter by letter: a capital sigma becomes a plain one also at a word's end.
        return _PIECES.findall(text.replace("Σ", "σ").lower())

    def parts(self, text: str) -> Iterator[str | list[str]]:
        """Words between special tokens, and the special tokens."""
        at = 0
        for match in self.split_special.finditer(text):
            yield self.pieces(text[at : match.start()])
            yield match.group()
            at = match.end()
        yield self.pieces(text[at:])

    def spelled(self, word: str) -> str:
        """A word in the vocabulary's letters."""
        return word if word.isascii() and word.isprintable() and " " not in word else "".join(
            [self.letter[b] for b in word.encode("utf-8")]
        )


class _Known:
    """Encodings that a worker has met, as bytes of ids and as token texts.

    Two generations: once the newer one is full the older one goes, except for words that
    have been met again.
    """

    def __init__(self, encoder: Encoder) -> None:
        self.encoder = encoder
        self.ids: dict[str, bytes] = {}
        self.shown: dict[str, str] = {}
        self.older: tuple[dict[str, bytes], dict[str, str]] = ({}, {})
        self.bytes = 0

    def _remember(self, word: str, ids: bytes, shown: str) -> None:
        self.ids[word], self.shown[word] = ids, shown
        self.bytes += len(word) + len(ids) + len(shown)

    def learn(self, texts: list[list[str | list[str]]]) -> None:
        if len(self.ids) > KNOWN_WORDS or self.bytes > KNOWN_BYTES:
            self.older, self.ids, self.shown, self.bytes = (self.ids, self.shown), {}, {}, 0
        new: set[str] = set()
        for parts in texts:
            for part in parts:
                if isinstance(part, list):
                    new.update(part)
        old_ids, old_shown = self.older
        spelled: dict[str, str] = {}
        for word in new:
            if word in self.ids:
                continue
            if word in old_ids:
                self._remember(word, old_ids[word], old_shown[word])
            else:
                spelled[word] = self.encoder.spelled(word)
        encoded = self.encoder.encode_words(list(set(spelled.values())))
        ids = self.encoder.ids
        for word, letters in spelled.items():
            tokens = encoded[letters]
            self._remember(
                word, b"".join([ids[t].to_bytes(4, "little") for t in tokens]), " ".join(tokens)
            )

    def encode(self, parts: list[str | list[str]]) -> bytes:
        out = []
        for part in parts:
            if isinstance(part, list):
                out += map(self.ids.__getitem__, part)
            else:
                out.append(self.encoder.special[part].to_bytes(4, "little"))
        return b"".join(out)

    def decode(self, parts: list[str | list[str]]) -> str:
        """Text of a document's own ids: tokens with a blank between."""
        out = []
        for part in parts:
            if isinstance(part, list):
                out += map(self.shown.__getitem__, part)
            else:
                out.append(part)
        return " ".join(out)


@lru_cache(maxsize=2)
def _known(vocabulary: str) -> _Known:
    return _Known(Encoder(vocabulary))


@lru_cache(maxsize=2)
def _tokens(vocabulary: str) -> dict[int, str]:
    """Tokens by id, special ones included."""
    model = json.loads(vocabulary)
    tokens = {i: t for t, i in model["model"]["vocab"].items()}
    return tokens | {t["id"]: t["content"] for t in model["added_tokens"]}


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about ``BATCH_BYTES`` of the column's text, a row at least."""
    sizes = [len(v.as_buffer()) if v.is_valid else 0 for v in batch.column(column)]
    at = held = 0
    for n, size in enumerate(sizes):
        held += size
        if held >= BATCH_BYTES:
            yield batch.slice(at, n + 1 - at)
            at, held = n + 1, 0
    if at < batch.num_rows:
        yield batch.slice(at)


def encode(
    docs: DataFrame,
    vocabulary: str,
    keep: list[str],
    digests: bool = False,
    decoded: bool = False,
) -> DataFrame:
    """Token ids of every whole text, beside the columns ``keep`` of ``docs``.

    ``vocabulary`` is the content of a tokenizer file: BPE with word ends, lower case,
    white space dropped. Special tokens' texts within a text become their ids; none are
    added. Adds ``ids`` (array of int), with ``decoded`` also ``text``, what the ids decode
    to (see ``decode``), or with ``digests`` n_tokens, ids_sha256 (of the
    ids as little-endian unsigned 32-bit integers) and decoded_sha256 (of the decoded
    text in UTF-8). A NULL or blank text has no ids. Rows neither merge nor change
    places; a column of ``docs`` called like a result is replaced.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)
    results = ("ids", "text") if decoded else ("ids",)
    if digests:
        results = ("n_tokens", "ids_sha256", "decoded_sha256")
    keep = [c for c in keep if c not in results]
    rows = docs.select(
        *[F.col(f"`{c}`") for c in keep], F.col("text").cast("string").alias("_text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _known(shared.value)
        for whole in batches:
            for batch in _slices(whole, len(keep)):
                texts = batch.column(len(keep)).to_pylist()
                parts = [list(known.encoder.parts(text or "")) for text in texts]
                known.learn(parts)
                ids = [known.encode(p) for p in parts]
                shown = [known.decode(p) for p in parts] if digests or decoded else []
                if digests:
                    sums = [hashlib.sha256(d.encode("utf-8")).hexdigest() for d in shown]
                    new = [
                        pa.array([len(i) // 4 for i in ids], pa.int64()),
                        pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                        pa.array(sums, pa.string()),
                    ]
                elif decoded:
                    new = [_lists(ids), pa.array(shown, pa.string())]
                else:
                    new = [_lists(ids)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[: len(keep)], *new], names=[*keep, *results]
                )

    types = {"n_tokens": "long", "ids": "array<int>"}
    added = ", ".join(f"{name} {types.get(name, 'string')}" for name in results)
    old = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[: len(keep)]
    )
    return rows.mapInArrow(run, f"{old}, {added}" if old else added)


def _lists(ids: list[bytes]) -> pa.Array:
    ends = [0]
    for i in ids:
        ends.append(ends[-1] + len(i) // 4)
    values = pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(b"".join(ids))])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def decode(docs: DataFrame, vocabulary: str, ids: str = "ids") -> DataFrame:
    """``docs`` with ``text``: the tokens of ``ids``, special ones included, a blank between.

    A NULL array decodes to an empty text. An id that the vocabulary lacks stops the query.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    kept = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(shared.value)
        for batch in batches:
            lists = batch.column(kept.index(ids)).to_pylist()
            texts = [" ".join([tokens[i] for i in one or ()]) for one in lists]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], names=[*kept, "text"]
            )

    rows = docs.select([F.col(f"`{c}`") for c in kept])
    old = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{old}, text string")


def n_tokens(ids: Column) -> Column:
    return F.size(F.coalesce(ids, F.array().cast("array<int>"))).cast("long")
