"""Quality rules with thresholds learned per language and source.

Only DataFrame functions run here. Four rates of each document go into quantile
sketches, one for each language and source: counts by logarithmic bucket, which
merge by addition, depend on no order of rows and miss a quantile by two per cent of
its value at most. A document whose rate lies beyond the fence that its group's
quartiles set is rejected.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from querymill.llm.common import WORD, let
from querymill.session import materialize

# Fixed values of the base counts.
WINDOW = 5  # words in a repeated window
SYMBOLS = r"[#*$%&|<>]"
SPACE = " \t\n\v\f\r"

PLACE_BITS = 24  # of a sorted window, for its place
GROWTH = 1.02  # ratio of neighbouring bucket bounds
MIN_DOCUMENTS = 50  # a smaller group takes the fences of its language, then of all
REACH = 3  # fences lie so many spreads beyond the quartiles

# Rate, the least spread its fences assume, and whether low values count as well.
RATES = (
    ("word_length", 50, True),  # characters in 100 words
    ("symbols", 50, False),  # in 1000 words
    ("dup_lines", 100, False),  # in 1000 lines
    ("repeat_words", 60, False),  # in 1000 words
)

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACE))
    words = F.split(trimmed, r"[\x20\x09-\x0D]+")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(words)


def _covered(starts: Column) -> Column:
    """Words in the windows that begin at the sorted ``starts``."""
    lengths = F.transform(
        starts,
        lambda at, k: F.least(
            F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - at, F.lit(WINDOW))
        ),
    )
    return F.aggregate(lengths, F.lit(0), lambda total, one: total + one.cast("int"))


def _repeated(found: Column, same: Callable[[Column, Column], Column]) -> Column:
    """Elements of a sorted array that are the ``same`` as a neighbour."""

    def alike(one: Column, k: Column) -> Column:
        before = F.when(k > 0, same(F.get(found, k - 1), one))
        after = same(F.get(found, k + 1), one)
        return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

    return F.filter(found, alike)


def _repeat_words(words: Column) -> Column:
    """Words in windows that the text has twice or more.

    A text with as many hashes as windows has none. Otherwise windows are sorted as
    numbers, the upper bits a hash and the lower ones the place.
    Where neighbours with one hash are not the same window, or places do not fit, the
    windows themselves are sorted.
    """
    starts = F.sequence(F.lit(0), F.size(words) - WINDOW)

    def window(i: Column) -> Column:
        return F.concat_ws(" ", *[F.get(words, i.cast("int") + k) for k in range(WINDOW)])

    def hashed(i: Column) -> Column:
        return F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])

    def packed(hashed: Column, i: Column) -> Column:
        return hashed.bitwiseAND(F.lit(-1 << PLACE_BITS)).bitwiseOR(i.cast("long"))

    def place(one: Column) -> Column:
        return one.bitwiseAND(F.lit((1 << PLACE_BITS) - 1))

    def one_hash(one: Column, two: Column) -> Column:
        return F.shiftright(one, PLACE_BITS) == F.shiftright(two, PLACE_BITS)

    def exact() -> Column:
        numbered = F.transform(starts, lambda i: F.struct(window(i).alias("words"), i.alias("at")))
        return let(
            F.array_sort(numbered),
            lambda found: let(
                F.array_sort(
                    F.transform(
                        _repeated(found, lambda x, y: x["words"] == y["words"]), lambda x: x["at"]
                    )
                ),
                _covered,
            ),
        )

    def of_repeated(found: Column) -> Column:
        def right(one: Column, k: Column) -> Column:
            before = F.get(found, k - 1)
            return (
                F.when(k == 0, True)
                .when(~one_hash(before, one), True)
                .otherwise(window(place(before)) == window(place(one)))
            )

        return (
            F.when(F.size(found) == 0, 0)
            .when(
                F.forall(F.transform(found, right), lambda x: x),
                let(F.array_sort(F.transform(found, place)), _covered),
            )
            .otherwise(exact())
        )

    def of_hashes(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(
            let(
                F.array_sort(F.transform(hashes, packed)),
                lambda found: let(_repeated(found, one_hash), of_repeated),
            )
        )

    quick = let(F.transform(starts, hashed), of_hashes)
    return (
        F.when(F.size(words) <= WINDOW, 0)
        .when(F.size(words) < 1 << PLACE_BITS, quick)
        .otherwise(exact())
    )


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base counts of its text in place of it, and ``n_lines``.

    A NULL text counts as an empty one.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(WORD))
    counts = let(
        _words(body),
        lambda w: F.struct(
            F.size(w).alias("n_words"),
            F.length(F.array_join(w, "")).alias("word_chars"),
            _repeat_words(w).alias("n_repeat_words"),
        ),
    )
    line_counts = let(
        lines,
        lambda x: F.struct(
            F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup")
        ),
    )
    kept = [c for c in docs.columns if c != text and c not in (*BASE, "n_lines")]
    return docs.select(
        *[F.col(f"`{c}`") for c in kept],
        counts.alias("_words"),
        line_counts.alias("_lines"),
        F.regexp_count(body, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
    ).select(
        *[F.col(f"`{c}`") for c in kept],
        "n_symbols",
        F.col("_words.word_chars").cast("long").alias("word_chars"),
        F.col("_words.n_words").cast("long").alias("n_words"),
        F.col("_words.n_repeat_words").cast("long").alias("n_repeat_words"),
        F.col("_lines.n_lines").cast("long").alias("n_lines"),
        F.col("_lines.n_dup").cast("long").alias("n_dup_lines"),
    )


def _rates() -> list[Column]:
    per_word = F.greatest(F.col("n_words"), F.lit(1))
    per_line = F.greatest(F.col("n_lines"), F.lit(1))
    values = {
        "word_length": F.floor(F.col("word_chars") * 100 / per_word),
        "symbols": F.floor(F.col("n_symbols") * 1000 / per_word),
        "dup_lines": F.floor(F.col("n_dup_lines") * 1000 / per_line),
        "repeat_words": F.floor(F.col("n_repeat_words") * 1000 / per_word),
    }
    return [values[name].alias(name) for name, _, _ in RATES]


def sketch(rates: DataFrame, keys: list[str]) -> DataFrame:
    """Quantile sketches of the rate columns: per key, rate and bucket the number of
    rows and their largest value."""
    names = [name for name, _, _ in RATES]
    pairs = F.array(
        *[F.struct(F.lit(n).alias("rate"), F.col(n).cast("long").alias("value")) for n in names]
    )
    bucket = F.when(F.col("p.value") <= 0, 0).otherwise(
        1 + F.floor(F.log(F.col("p.value").cast("double")) / F.log(F.lit(GROWTH)))
    )
    return (
        rates.select(*keys, F.explode(pairs).alias("p"))
        .select(*keys, "p.rate", "p.value", bucket.cast("int").alias("bucket"))
        .groupBy(*keys, "rate", "bucket")
        .agg(F.count("*").alias("n"), F.max("value").alias("value"))
    )


def merge(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of coarser groups, from those of finer ones."""
    return sketches.groupBy(*keys, "rate", "bucket").agg(
        F.sum("n").alias("n"), F.max("value").alias("value")
    )


def fences(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Bounds of each rate, one row per group: ``n`` and ``<rate>_low``, ``<rate>_high``.

    A group's sketch has some hundreds of buckets, whatever the number of documents.
    """
    group = Window.partitionBy(*keys, "rate")
    ranked = sketches.withColumn("total", F.sum("n").over(group)).withColumn(
        "upto", F.sum("n").over(group.orderBy("bucket"))
    )

    def quantile(quarter: int) -> Column:
        reached = F.col("upto") * 4 >= F.col("total") * quarter
        return F.min(F.when(reached, F.col("value")))

    quartiles = ranked.groupBy(*keys, "rate").agg(
        F.max("total").alias("n"), quantile(1).alias("q1"), quantile(3).alias("q3")
    )
    bounds = []
    for name, least, both in RATES:
        mine = F.col("rate") == name
        spread = F.greatest(F.col("q3") - F.col("q1"), F.lit(least)) * REACH
        low = F.col("q1") - spread if both else F.lit(0)
        bounds += [
            F.max(F.when(mine, low)).alias(f"{name}_low"),
            F.max(F.when(mine, F.col("q3") + spread)).alias(f"{name}_high"),
        ]
    return quartiles.groupBy(*keys).agg(F.max("n").alias("n"), *bounds)


def _base_failed() -> Column:
    return (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)


def learn(measured: DataFrame) -> list[DataFrame]:
    """Fences by language and source, by language, and of all documents.

    From the documents of ``measured`` that pass the base; NULL is a language or source
    of its own. Tables of one row per group, each in files of its own; the last one has
    one row, or none without any document that passed.
    """
    passed = measured.where(~_base_failed()).select("lang", "source", *_rates())
    fine = materialize(sketch(passed, ["lang", "source"]), "sketch")
    levels = []
    for depth, keys in enumerate((["lang", "source"], ["lang"], [])):
        bounds = fences(merge(fine, keys) if depth else fine, keys)
        levels.append(
            materialize(
                bounds.select(
                    *[F.col(k).alias(f"_{k}{depth}") for k in keys],
                    F.struct(*[c for c in bounds.columns if c not in keys]).alias(
                        f"_fences{depth}"
                    ),
                ),
                "fences",
            )
        )
    return levels


def verdict(measured: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """``measured`` with ``base_failed`` and ``kept``."""
    joined = measured.join(
        levels[0],
        F.col("lang").eqNullSafe(F.col("_lang0")) & F.col("source").eqNullSafe(F.col("_source0")),
        "left",
    ).join(levels[1], F.col("lang").eqNullSafe(F.col("_lang1")), "left")
    chosen = F.when(F.col("_fences0.n") >= MIN_DOCUMENTS, F.col("_fences0"))
    chosen = chosen.when(F.col("_fences1.n") >= MIN_DOCUMENTS, F.col("_fences1"))
    overall = levels[2].first()
    if overall is not None:
        fields = overall["_fences2"].asDict()
        chosen = chosen.otherwise(
            F.struct(*[F.lit(v).cast("long").alias(k) for k, v in fields.items()])
        )
    within = F.lit(True)
    for (name, _, _), rate in zip(RATES, _rates(), strict=True):
        within = within & rate.between(F.col(f"_chosen.{name}_low"), F.col(f"_chosen.{name}_high"))
    own = [c for c in measured.columns if c not in ("base_failed", "kept")]
    return joined.withColumn("_chosen", chosen).select(
        *[F.col(f"`{c}`") for c in own],
        _base_failed().alias("base_failed"),
        (~_base_failed() & F.coalesce(within, F.lit(True))).alias("kept"),
    )


def judge(docs: DataFrame, text: str = "text") -> DataFrame:
    """Base counts, ``base_failed`` and ``kept`` of every document, beside its columns.

    Needs the columns ``lang`` and ``source``; NULL is a group of its own in either.
    ``base_failed``: fewer than ten words, or over a fifth of them in repeated
    windows. Documents that passed the base make the sketches. A group of fewer than
    ``MIN_DOCUMENTS`` takes its language's fences, a small language those of all.
    ``kept``: base passed, and every rate within the fences. Empty, blank and NULL
    texts have no words and fail. Columns of ``docs`` named like a count are
    replaced; no rows give no rows. Rows are neither merged nor told apart.
    """
    measured = materialize(measure(docs, text), "measured")
    return verdict(measured, learn(measured))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns and no others.

    Texts are counted twice, for the fences and to decide, and so never shuffled.
    """
    columns = ["lang", "source", "text"]
    measured = materialize(measure(docs.select(columns)).select("lang", "source", *BASE, "n_lines"))
    levels = learn(measured)
    packed = docs.select(F.struct("*").alias("_row"), *columns)
    return verdict(measure(packed), levels).where("kept").select("_row.*")
