"""Spelling variants: words within one edit of each other, by words in a small alphabet.

Letters are hashed to a few symbols. Words one edit apart are at most one edit apart in
symbols, too, so all strings within one edit of each reduced word are generated, which
are few as symbols are few, and joined to the reduced words. What meets is confirmed on
the words as they are. Native: no Python sees a row.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from querymill.session import materialize

# The letters of a word.
CAPITALS = "".join(map(chr, range(0x41, 0x5B)))
SMALL = CAPITALS.lower()
LETTERS = SMALL + "".join(map(chr, range(0xC0, 0x100)))
RUN = r"[A-Za-zÀ-ÿ]"

LEAST_LENGTH = 6
LEAST_COUNT = 5
TYPO_ONE_IN = 199  # runs that lose a letter
FORM_RATIO = 5

# Words of one reduced form, beyond which they are compared by their own letters.
CROWD = 64


def occurrences(docs: DataFrame) -> DataFrame:
    """``word`` for every occurrence in the whole texts of ``docs(doc_id, text)``.

    Maximal runs of letters, A-Z in lower case. A run whose crc32 with its doc_id is
    divisible by ``TYPO_ONE_IN`` loses one letter. A NULL text has none, a NULL doc_id
    counts as an empty one. Runs that are too short to give a word are left out.
    """
    runs = F.regexp_extract_all(F.col("text").cast("string"), F.lit(RUN + f"{{{LEAST_LENGTH},}}"), 0)
    named = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(runs).alias("run"),
    )
    low = named.select("id", F.translate("run", CAPITALS, SMALL).alias("run"))
    hashed = low.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = F.pmod(F.col("h"), F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substr("run", at + 2))
    word = F.when(F.col("h") % TYPO_ONE_IN == 0, shorter).otherwise(F.col("run"))
    return hashed.select(word.alias("word")).where(F.length("word") >= LEAST_LENGTH)


def symbols_for(n_words: int) -> int:
    """Symbols that give the shortest words about as many reduced forms as there are words."""
    symbols = 4
    while symbols < len(LETTERS) and symbols**LEAST_LENGTH < n_words:
        symbols += 1
    return symbols


def reduced(word: Column, symbols: int) -> Column:
    """A word of ``LETTERS`` in the small alphabet, each letter hashed to its symbol."""
    to = "".join(LETTERS[zlib.crc32(c.encode()) % symbols] for c in LETTERS)
    return F.translate(word, LETTERS, to)


def within_one_edit(word: Column, alphabet: str) -> Column:
    """All strings at most one inserted, deleted or replaced letter away, each once."""
    letters = F.array(*[F.lit(c) for c in alphabet])
    size = F.length(word)
    deleted = F.transform(
        F.sequence(F.lit(1), size),
        lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substr(word, i + 1)),
    )
    replaced = F.transform(
        F.sequence(F.lit(1), size),
        lambda i: F.transform(
            letters, lambda c: F.concat(F.substring(word, F.lit(1), i - 1), c, F.substr(word, i + 1))
        ),
    )
    inserted = F.transform(
        F.sequence(F.lit(0), size),
        lambda i: F.transform(
            letters, lambda c: F.concat(F.substring(word, F.lit(1), i), c, F.substr(word, i + 1))
        ),
    )
    return F.array_distinct(F.concat(deleted, F.flatten(replaced), F.flatten(inserted)))


def near_pairs(words: DataFrame, symbols: int | None = None, crowd: int = CROWD) -> DataFrame:
    """``(word, near)`` in both directions for distinct words of ``words(word)`` one edit apart.

    Words are non-empty and made of ``LETTERS``. The number of symbols follows from the
    number of words, so that reduced forms stay about as many. Where more than ``crowd``
    words share one, no number of which bounds their pairs, each of these words is looked
    for by its own letters instead: all strings one edit away, joined to the words. Either
    way gives all pairs, so ``crowd`` changes the work and not the result.
    """
    words = words.select("word")
    if symbols is None:
        symbols = symbols_for(words.count())
    marked = materialize(words.withColumn("form", reduced(F.col("word"), symbols)), "reduced")
    sizes = marked.groupBy("form").count()
    sparse = materialize(sizes.where(F.col("count") <= crowd).select("form"), "forms")
    alphabet = LETTERS[:symbols]
    around = sparse.select(
        "form", F.explode(within_one_edit(F.col("form"), alphabet)).alias("other")
    )
    # The relation is symmetric: one direction is enough.
    meet = around.where("form <= other").join(sparse.select(F.col("form").alias("other")), "other")
    left = marked.select("form", F.col("word").alias("a"))
    right = marked.select(F.col("form").alias("other"), F.col("word").alias("b"))
    joined = meet.join(left, "form").join(
        right,
        (meet["other"] == right["other"])
        & ((F.col("form") < right["other"]) | (F.col("a") < F.col("b")))
        & (F.levenshtein("a", "b", 1) == 1),
    )
    pairs = joined.select("a", "b")
    both = F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y")),
                   F.struct(F.col("b").alias("x"), F.col("a").alias("y")))
    near = pairs.select(F.explode(both).alias("p")).select(
        F.col("p.x").alias("word"), F.col("p.y").alias("near")
    )
    crowded = materialize(
        marked.join(sparse, "form", "left_anti").select("word"), "crowded"
    )
    if crowded.isEmpty():
        return near
    asked = crowded.select(
        F.col("word").alias("a"), F.explode(within_one_edit(F.col("word"), LETTERS)).alias("b")
    )
    own = asked.where("a <> b").join(words.select(F.col("word").alias("b")), "b")
    exact = own.select(F.explode(both).alias("p")).select(
        F.col("p.x").alias("word"), F.col("p.y").alias("near")
    )
    return near.unionByName(exact.distinct())


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)``: forms followed to the last; each round doubles the steps.

    A form is ``FORM_RATIO`` times as frequent as its word, so chains are short.
    """
    hooks = materialize(
        forms.select("word", F.coalesce("form", "word").alias("root")), "roots"
    )
    while True:
        onward = hooks.select(F.col("word").alias("root"), F.col("root").alias("next"))
        followed = materialize(
            hooks.join(onward, "root").select(
                "word", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")
            ),
            "roots",
        )
        hooks = followed.select("word", "root")
        if followed.where("moved").isEmpty():
            return hooks


def variants(docs: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n and root for every frequent word of ``docs``.

    ``docs(doc_id, text)``: other columns are not looked at; repeated rows count as often
    as they occur. A word has at least ``LEAST_LENGTH`` letters and ``LEAST_COUNT``
    occurrences; n_near counts the words one edit away. The form is the most frequent of
    these (of equals the first in code-point order), if at least ``FORM_RATIO`` times as
    frequent as the word; root is where following forms ends. Without texts no rows.

    Occurrences shuffle as counts: however frequent a word is, a task sends it once.
    """
    counts = occurrences(docs).groupBy("word").agg(F.count("*").alias("n"))
    words = materialize(counts.where(F.col("n") >= LEAST_COUNT), "words")
    near = near_pairs(words)
    frequent = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = (
        near.join(frequent, "near")
        .groupBy("word")
        .agg(
            F.count("*").alias("n_near"),
            F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best"),
        )
    )
    form_n = -F.col("best.less")
    has_form = form_n >= FORM_RATIO * F.col("n")
    found = materialize(
        words.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(has_form, F.col("best.form")).alias("form"),
            F.when(has_form, form_n).alias("form_n"),
        ),
        "variants",
    )
    return found.join(_roots(found), "word")
