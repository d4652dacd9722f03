"""Near-duplicate documents: signatures posted by coordinate, collisions counted.

A document's signature holds the least hash of its shingles under each of ``HASHES``
hash functions. Documents that share a coordinate's value collide there. Two documents
of the wanted similarity collide in at least some number of coordinates, the match
threshold, but for a chance of ``MISSED``, so of each document

* coordinates with a value that no other document has are skipped, and the document
  altogether if fewer than the threshold are left;
* only the rarest of the others are posted, so many that fewer than the threshold are
  not (prefix filter): two documents with enough collisions meet at one of those.

Documents that meet and collide often enough are linked if their full shingle sets
are similar enough. Documents with equal sets are one from the start. A group of near
copies meets at many values with all its members; there, members are first compared
with one of them only, twice, and afterwards just those pairs are that no chain of links
joins. That loses no component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import exp, lgamma, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from querymill.llm.common import WORDS, groups
from querymill.llm.components import components
from querymill.session import materialize

HASHES = 48
MISSED = 1e-6  # chance that two documents just similar enough collide too rarely
STAR_ROUNDS = 2
FINE_HASHES = 2048  # a bit each, of documents that are compared with many others
BLOCK = 1024  # documents of a key compared with as many others in one task

_U64 = np.uint64
_LOWER = str.maketrans({c: chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})


def _mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers that leaves no pattern."""
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


_STEPS = np.arange(1, HASHES + FINE_HASHES + 1, dtype=_U64) * _U64(0x9E3779B97F4A7C15)
_FACTORS = _mix(_STEPS) | _U64(1)


def matches_for(percent: float, hashes: int = HASHES) -> int:
    """Most collisions that similar documents have but for a chance of ``MISSED``."""
    p, below = percent / 100, 0.0
    if p >= 1:
        return hashes
    for n in range(hashes):
        ways = lgamma(hashes + 1) - lgamma(n + 1) - lgamma(hashes - n + 1)
        below += exp(ways + n * log(p) + (hashes - n) * log(1 - p))
        if below > MISSED:
            return max(n, 1)
    return hashes


class _Words:
    """64-bit hashes of words, remembered up to a bound."""

    def __init__(self, most: int = 500_000) -> None:
        self.known: dict[str, int] = {}
        self.most = most

    def hashes(self, words: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > self.most:
            known.clear()
        try:
            return np.fromiter(map(known.__getitem__, words), _U64, len(words))
        except KeyError:
            for w in words:
                if w not in known:
                    digest = hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8)
                    known[w] = int.from_bytes(digest.digest(), "little")
            return np.fromiter(map(known.__getitem__, words), _U64, len(words))


def shingle_set(text: str | None, width: int, words: _Words) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles; a text of fewer words than
    ``width`` is one shingle, one without words has none."""
    found = WORDS.findall((text or "").translate(_LOWER))
    if not found:
        return np.empty(0, _U64)
    h = words.hashes(found)
    n = max(1, len(h) - width + 1)
    out = np.zeros(n, _U64)
    for k in range(min(width, len(h))):
        out = _mix(out + h[k : k + n] + _U64(k + 1))
    return np.unique(out)


def _least_hashes(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Least product with each odd factor; shingles are hashes already."""
    least = np.full(len(factors), np.iinfo(_U64).max, _U64)
    # Tiles that stay in a core's cache.
    for k in range(0, len(factors), 64):
        some = factors[k : k + 64, None]
        for at in range(0, len(shingles), 512):
            x = shingles[None, at : at + 512] * some
            np.minimum(least[k : k + 64], x.min(axis=1), out=least[k : k + 64])
    return least


def _signature(shingles: np.ndarray) -> np.ndarray:
    """Least hash under each function, with the function's number in the low bits."""
    least = _least_hashes(shingles, _FACTORS[:HASHES])
    return (least & ~_U64(63)) | np.arange(HASHES, dtype=_U64)


def _fine_signature(shingles: np.ndarray) -> bytes:
    """A bit of the least hash under each of the further functions."""
    least = _least_hashes(shingles, _FACTORS[HASHES:])
    return np.packbits((least >> _U64(32)).astype(np.uint8) & 1).tobytes()


def _bits_apart(some: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Differing bits of each column of ``some`` and each of ``words``, 64 to a row."""
    apart = np.zeros((some.shape[1], words.shape[1]), np.uint16)
    both = np.empty(apart.shape, _U64)
    for one, row in zip(some, words, strict=True):
        np.bitwise_xor(one[:, None], row[None, :], out=both)
        apart += np.bitwise_count(both)
    return apart


def _signed(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, n_shingles, set_hash, set_check, signature``; no signature without shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in batches:
            counts, one, two, signatures = [], [], [], []
            for text in batch.column(1).to_pylist():
                s = shingle_set(text, width, words)
                counts.append(len(s))
                one.append(int(_mix(s).sum(dtype=_U64).astype(np.int64)))
                two.append(int(_mix(s ^ _U64(0x5851F42D4C957F2D)).sum(dtype=_U64).astype(np.int64)))
                signatures.append(_signature(s).view(np.int64) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(one, pa.int64()),
                    pa.array(two, pa.int64()),
                    pa.array(signatures, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "set_hash", "set_check", "signature"],
            )

    return docs.mapInArrow(
        run,
        "doc_id long, n_shingles long, set_hash long, set_check long, signature array<long>",
    )


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, shingles, fine``: the full shingle sets, and longer signatures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for at in range(0, len(texts), 256):
                sets = [shingle_set(text, width, words) for text in texts[at : at + 256]]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(at, 256),
                        pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                        pa.array([_fine_signature(s) for s in sets], pa.binary()),
                    ],
                    names=["doc_id", "shingles", "fine"],
                )

    return docs.mapInArrow(run, "doc_id long, shingles array<long>, fine binary")


def _named(df: DataFrame, end: str) -> DataFrame:
    """Columns of one end of a pair; its ``doc_id`` becomes ``end`` itself."""
    return df.select(
        F.col("doc_id").alias(end),
        *[F.col(c).alias(f"{c}_{end}") for c in df.columns if c != "doc_id"],
    )


def _colliding(pairs: DataFrame, posted: DataFrame, matches: int, percent: int) -> DataFrame:
    """Those of the pairs ``(a, b)`` whose signatures collide often enough."""
    shared = posted.select("doc_id", "n_shingles", "shared")
    sizes = ("n_shingles_a", "n_shingles_b")
    return (
        pairs.join(_named(shared, "b"), "b")
        .join(_named(shared, "a"), "a")
        .where(
            (F.least(*sizes) * 100 >= F.greatest(*sizes) * percent)
            & (F.size(F.array_intersect("shared_a", "shared_b")) >= matches)
        )
        .select("a", "b")
    )


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs ``(a, b)`` whose full shingle sets are similar enough."""
    sets = sets.select("doc_id", "shingles")
    full = pairs.join(_named(sets, "b"), "b").join(_named(sets, "a"), "a")
    both = F.size(F.array_intersect("shingles_a", "shingles_b"))
    either = F.size("shingles_a") + F.size("shingles_b") - both
    return full.where(both * 100 >= either * percent).select("a", "b")


def _labelled(postings: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Postings with the component of each document as far as it is known."""
    if labels is None:
        return postings.withColumn("component", F.col("doc_id"))
    known = labels.withColumnRenamed("node", "doc_id")
    return postings.join(known, "doc_id", "left").withColumn(
        "component", F.coalesce("component", "doc_id")
    )


_MEETING = ["key", "one", "two"]


def _close_pairs(
    mine: DataFrame, posted: DataFrame, sets: DataFrame, percent: int
) -> DataFrame:
    """Pairs of different components that meet at a key and collide often enough.

    ``mine`` has key, doc_id, component and the key's ``largest`` component; only the
    documents outside that one are compared with all. A key with many documents is cut into blocks;
    each pair of blocks is one group. The longer signatures are compared within the
    group, and a pair is taken at the first of the keys where it meets. Its full sets
    are compared there, and it comes out only if they are similar enough and its ends
    are still apart after the links that came out of the group before: a group gives
    fewer links than it has documents, and the components are the same.
    """
    # Bits of different hashes agree half of the time.
    most_apart = FINE_HASHES - matches_for((100 + percent) / 2, FINE_HASHES)
    sizes = mine.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    blocked = sizes.where("blocks > 1")
    own = F.pmod(F.xxhash64("doc_id"), F.coalesce("blocks", F.lit(1))).cast("int")
    meets = F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)
    dealt = (
        mine.join(blocked, "key", "left")
        .withColumn("outside", F.col("component") != F.col("largest"))
        .select(
            "key", "doc_id", "component", "outside", own.alias("block"), F.explode(meets).alias("other")
        )
        .withColumn("one", F.least("block", "other"))
        .withColumn("two", F.greatest("block", "other"))
        .join(posted.join(sets.select("doc_id", "fine", "shingles"), "doc_id"), "doc_id")
        .select(
            *_MEETING,
            "block",
            "doc_id",
            "component",
            "outside",
            "n_shingles",
            "shared",
            "fine",
            "shingles",
        )
        .repartition(*_MEETING)
        .sortWithinPartitions(*_MEETING)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches, _MEETING):
            n = rows.column("n_shingles").to_numpy()
            ids, component = rows.column("doc_id").to_numpy(), rows.column("component").to_numpy()
            block = rows.column("block").to_numpy()
            flat = np.frombuffer(b"".join(rows.column("fine").to_pylist()), _U64)
            signature = np.ascontiguousarray(flat.reshape(len(ids), FINE_HASHES // 64).T)
            crossing = rows.column("one")[0].as_py() != rows.column("two")[0].as_py()
            found_a, found_b = [], []
            outside = rows.column("outside").to_numpy()
            compared = np.flatnonzero(outside)
            for at in range(0, len(compared), 128):
                part = compared[at : at + 128]
                good = _bits_apart(signature[:, part], signature) <= most_apart
                good &= component[part, None] != component[None, :]
                # Two documents outside are compared from either side.
                good &= ~outside[None, :] | (ids[part, None] < ids[None, :])
                low, high = np.minimum(n[part, None], n), np.maximum(n[part, None], n)
                good &= low * 100 >= high * percent
                if crossing:
                    good &= block[part, None] != block[None, :]
                a, b = np.nonzero(good)
                found_a += part[a].tolist()
                found_b += b.tolist()
            if not found_a:
                continue
            key, shared = rows.column("key")[0].as_py(), rows.column("shared")
            lists = {k: shared[k].as_py() for k in {*found_a, *found_b}}
            sets = {k: frozenset(v) for k, v in lists.items()}
            firsts = [
                (a, b)
                for a, b in zip(found_a, found_b, strict=True)
                if next(k for k in lists[a] if k in sets[b]) == key
            ]
            pairs = _joining(firsts, component, rows.column("shingles"), percent)
            pairs = [(int(min(ids[a], ids[b])), int(max(ids[a], ids[b]))) for a, b in pairs]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"]
            )

    return dealt.mapInArrow(run, "a long, b long")


def _joining(
    pairs: list[tuple[int, int]], component: np.ndarray, shingles: pa.Array, percent: int
) -> list[tuple[int, int]]:
    """Those of the pairs of rows whose full sets are similar enough and that join two
    components still apart, those of earlier ones in the list joined."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        path = []
        while root.get(x, x) != x:
            path.append(x)
            x = root[x]
        for y in path:
            root[y] = x
        return x

    full: dict[int, np.ndarray] = {}

    def shingle_set(k: int) -> np.ndarray:
        if k not in full:
            full[k] = shingles[k].values.to_numpy()
        return full[k]

    out = []
    for a, b in pairs:
        x, y = find(int(component[a])), find(int(component[b]))
        if x == y:
            continue
        one, two = shingle_set(a), shingle_set(b)
        both = len(np.intersect1d(one, two, assume_unique=True))
        if both * 100 >= (len(one) + len(two) - both) * percent:
            root[max(x, y)] = min(x, y)
            out.append((a, b))
    return out


def _mixed(postings: DataFrame, labels: DataFrame | None) -> tuple[DataFrame, int]:
    """Postings at keys where different components meet, with the documents' component
    and the key's ``largest`` one; and the number of pairs that meet there."""
    mine = materialize(_labelled(postings, labels), "postings")
    sizes = mine.groupBy("key", "component").count()
    squares = F.sum(F.col("count") * F.col("count"))
    keys = materialize(
        sizes.groupBy("key")
        .agg(
            ((F.sum("count") * F.sum("count") - squares) / 2).cast("long").alias("pairs"),
            F.max(F.struct("count", "component"))["component"].alias("largest"),
        )
        .where("pairs > 0"),
        "keys",
    )
    n_pairs = keys.agg(F.sum("pairs")).first()[0] or 0
    return mine.join(keys.select("key", "largest"), "key"), n_pairs


def _component_links(
    postings: DataFrame, posted: DataFrame, sets: DataFrame, matches: int, percent: int
) -> DataFrame | None:
    """Component of each posted document, ``(node, component)``; None without any link."""
    links, labels = None, None
    for turn in range(STAR_ROUNDS + 1):
        mine, n_pairs = _mixed(postings, labels)
        if not n_pairs:
            break
        if turn < STAR_ROUNDS:
            # Against one member of the largest component: the first, then another one.
            order = F.struct(F.xxhash64("doc_id") if turn else F.lit(0), "doc_id")
            centres = (
                mine.where("component = largest")
                .groupBy("key")
                .agg(F.min(order)["doc_id"].alias("other"))
            )
            pairs = mine.where("component <> largest").join(centres, "key")
            pairs = pairs.select(
                F.least("doc_id", "other").alias("a"), F.greatest("doc_id", "other").alias("b")
            ).distinct()
            pairs = _colliding(pairs, posted, matches, percent)
        else:
            pairs = _close_pairs(mine, posted, sets, percent)
        found = materialize(_links(pairs, sets, percent), "links")
        links = found if links is None else links.unionByName(found)
        labels = components(links)
    return labels


def near_duplicates(docs: DataFrame, width: int = 3, percent: int = 85) -> DataFrame:
    """Groups of documents with similar shingle sets.

    ``docs`` needs ``doc_id`` (long) and ``text``; other columns are ignored. Texts are
    lower-cased (A-Z only) and cut into words; a set holds the distinct shingles of
    ``width`` words. Two documents are linked if their common shingles are at least
    ``percent`` per cent of all those of both.

    Returns doc_id, n_shingles, component_id (the smallest doc_id reachable by links,
    its own included) and kept (whether that is its own). A document without words,
    NULL text included, is linked with nothing. Rows with one doc_id are one document
    as regards links, each with a row of its own in the result; a NULL doc_id takes no
    part, has a NULL component and is kept. No rows give no rows.
    """
    matches = matches_for(percent)
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    signed = materialize(_signed(texts, width), "signatures")
    sets_key = ["set_hash", "set_check", "n_shingles"]
    classes = materialize(
        signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy(*sets_key)
        .agg(F.min("doc_id").alias("first_id")),
        "classes",
    )
    firsts = classes.select(F.col("first_id").alias("doc_id"), *sets_key)
    one_each = signed.join(firsts, ["doc_id", *sets_key], "left_semi")
    values = one_each.select("doc_id", "n_shingles", F.explode("signature").alias("key"))
    shared = values.groupBy("key").count().where("count > 1")
    often = (
        values.join(shared, "key")
        .groupBy("doc_id", "n_shingles")
        .agg(F.sort_array(F.collect_set(F.struct("count", "key")))["key"].alias("shared"))
        .where(F.size("shared") >= matches)
    )
    posted = materialize(often, "posted")
    postings = materialize(
        posted.select(
            "doc_id",
            F.explode(F.slice("shared", 1, F.size("shared") - matches + 1)).alias("key"),
        ),
        "postings",
    )
    sets = materialize(_sets(texts.join(posted.select("doc_id"), "doc_id", "left_semi"), width), "sets")
    labels = _component_links(postings, posted, sets, matches, percent)
    joined = signed.drop("signature").join(classes, sets_key, "left")
    if labels is None:
        component = F.col("first_id")
    else:
        joined = joined.join(labels.withColumnRenamed("node", "first_id"), "first_id", "left")
        component = F.coalesce("component", "first_id")
    joined = joined.withColumn(
        "component_id",
        F.when(F.col("doc_id").isNotNull(), F.coalesce(component, F.col("doc_id"))),
    )
    return joined.select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
