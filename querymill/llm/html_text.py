"""Main text of web pages: the stretch between tags that scores highest.

A page is a row of words and tags. Each word scores more than nothing, by the element
it stands in, each tag less than nothing, by its name and class. One scan finds the
stretch with the greatest sum; that is the article. The scores are learned from pages
that mark their article by a tag. A word scores the share of its element's words that
lie within marks. Wherever another stretch scores more than the marked one, the scores
of the tags that make the difference are moved. Words outside the mark count triple
and those inside a half meanwhile, so that the marked stretch wins by a margin later.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from querymill.llm.common import drawn

# Bounds of the training sample, drawn by hash of page_id.
TRAINING_PAGES = 300
TRAINING_CHARS = 20_000  # longer pages are not drawn
ROUNDS = 12
DEPTH = 200  # of open elements that are told apart
LEAST, MOST = -80.0, -0.02  # score of a tag
MARKS = ("article", "main")

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|svg|iframe|textarea|select)\b.*?(?:</\1\s*>|\Z)"
    r"|<[a-zA-Z/!?](?:[^>\"']|\"[^\"]*\"|'[^']*')*+>"
    r"|<[a-zA-Z/!?][^>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_NAME = re.compile(r"</?\s*([a-zA-Z][a-zA-Z0-9-]*)")
_ATTRIBUTE = re.compile(
    r"([^\s\"'<>/=]+)\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s\"'>]+))", re.IGNORECASE
)
_KIND = ("class", "id", "role")  # attributes that say what an element is for

_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt"
    " ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
# Within a formula: what stands in a row, and what stands in cells of its own.
_MATH_ROW = frozenset(
    "math maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom"
    " mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtext munder munderover"
    " none semantics".split()
)
_MATH = _MATH_ROW | frozenset("annotation annotation-xml mtable mtd mtr".split())
_INLINE |= _MATH_ROW
# Parts of an article that are none of its text.
_ASIDE = frozenset("nav aside footer form button dialog menu head title".split())
_ASIDE_CLASS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|consent|cookies?|footer|menu"
    r"|nav|navbar|navigation|newsletter|notice|pagination|popup|promo|related|share|sharing"
    r"|sidebar|social|sponsor\w*|subscribe|widget)(?:$|[\s_-])",
    re.IGNORECASE,
)
# Elements that may lack an end tag: what begins after them, and what shields it.
_BLOCKS = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption"
    " figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search"
    " section table ul".split()
)
_ENDED_BY = {
    "p": (_BLOCKS | frozenset({"li", "dt", "dd", "tr", "td", "th"}), frozenset()),
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu"})),
}
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


def _kind(attributes: str) -> str:
    """Values of class, id and role, in this order."""
    if "=" not in attributes:
        return ""
    given: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(attributes):
        given.setdefault(name.lower(), "".join(values))
    return " ".join([given[k] for k in _KIND if given.get(k)])


class Page:
    """Text pieces of a page and the tags between them."""

    def __init__(self, source: str) -> None:
        self.texts: list[str] = []  # decoded, piece k stands before tag k
        self.tags: list[tuple[str, str]] = []  # name, with / if it closes; class, id, role
        at, piece = 0, []
        for match in _TOKEN.finditer(source):
            piece.append(source[at : match.start()])
            at = match.end()
            token = match.group()
            if match.group(1) or token.startswith(("<!", "<?")):
                continue
            name = _NAME.match(token)
            if not name:
                continue
            self.texts.append(html.unescape("".join(piece)))
            piece = []
            self.tags.append(
                ("/" * token.startswith("</") + name.group(1).lower(), _kind(token[name.end() :]))
            )
        piece.append(source[at:])
        self.texts.append(html.unescape("".join(piece)))
        self.words = [len(t.split()) for t in self.texts]

    def keys(self) -> list[str]:
        """What tags are scored by."""
        return [f"{name}.{kind.split()[0]}" if kind.split() else name for name, kind in self.tags]

    def elements(self) -> list[str]:
        """Key of the innermost open element about each piece, but for inline ones."""
        open_tags: list[tuple[str, str]] = [("", "")]
        found = [""]
        for (name, _), key in zip(self.tags, self.keys(), strict=True):
            plain = name.lstrip("/")
            if plain not in _INLINE and plain not in _VOID:
                if name == plain:
                    open_tags.append((name, key))
                    del open_tags[1 : max(1, len(open_tags) - DEPTH)]
                elif any(n == plain for n, _ in open_tags):
                    while open_tags.pop()[0] != plain:
                        pass
            found.append(open_tags[-1][1])
        return found

    def marked(self) -> tuple[int, int] | None:
        """First and last piece within the one element that marks the article."""
        names = [name for name, _ in self.tags]
        for mark in MARKS:
            if names.count(mark) == 1:
                start = names.index(mark)
                ends = [k for k, n in enumerate(names) if n == f"/{mark}" and k > start]
                return start + 1, ends[0] if ends else len(names)
        return None

    def text(self, first: int, last: int) -> str:
        """Text of a stretch, without elements that are no text of an article."""
        out, closing, depth = [], "", 0
        inside: list[str] = []  # elements open within an aside that may lack its end tag
        about: Counter[str] = Counter()  # elements open outside of asides
        for name, _ in self.tags[:first]:
            _count_open(about, name)
        for k in range(first, last + 1):
            if k > first:
                name, kind = self.tags[k - 1]
                plain = name.lstrip("/")
                if closing in _ENDED_BY and _ended(closing, name, inside, about):
                    closing, inside = "", []
                if not closing:
                    _count_open(about, name)
                if closing in _ENDED_BY:
                    if name != plain and plain in inside:
                        while inside.pop() != plain:
                            pass
                    elif name == plain and name not in _VOID:
                        inside.append(name)
                        del inside[: len(inside) - DEPTH]
                elif closing:
                    if plain == closing:
                        depth += -1 if name.startswith("/") else 1
                        if not depth:
                            closing = ""
                            _count_open(about, name)
                elif name == plain and name not in _VOID:
                    if _aside(name, kind):
                        closing, depth = name, 1
                if plain not in _INLINE:
                    out.append(" ")
            if not closing:
                out.append(self.texts[k])
        return " ".join("".join(out).split())


def _count_open(counts: Counter[str], name: str) -> None:
    if name.startswith("/"):
        counts[name[1:]] = max(0, counts[name[1:]] - 1)
    elif name not in _VOID:
        counts[name] += 1


def _ended(closing: str, name: str, inside: list[str], about: Counter[str]) -> bool:
    """Whether a tag ends an aside: its own end tag, its parent's, or what begins after it."""
    plain = name.lstrip("/")
    if name != plain:
        return plain not in inside and (plain == closing or about[plain] > 0)
    ends, shields = _ENDED_BY[closing]
    return name in ends and not shields.intersection(inside)


def best_stretch(words: list[float], tags: list[float]) -> tuple[int, int] | None:
    """First and last piece of the stretch with the greatest sum; the first of equals.

    None if nothing scores above zero.
    """
    best, found = 0.0, None
    total, start = 0.0, 0
    for k, w in enumerate(words):
        if total <= 0:
            total, start = 0.0, k
        total += w
        if total > best:
            best, found = total, (start, k)
        if k < len(tags):
            total += tags[k]
    return found


class Scores:
    """Scores of tags and words: by name and class, else by name, else a default."""

    def __init__(self) -> None:
        self.by_key: dict[str, float] = {}
        self.word_in: dict[str, float] = {}

    def of(self, key: str) -> float:
        known = self.by_key.get(key)
        if known is None:
            name, _, kind = key.partition(".")
            known = self.by_key.get(name)
            if known is None:
                known = -0.2 if name.lstrip("/") in _INLINE else -1.0
                if name.lstrip("/") in _MATH:
                    known = MOST
            if _aside(name.lstrip("/"), kind):
                known = min(known, -20.0)
        return known

    def word(self, element: str) -> float:
        known = self.word_in.get(element)
        if known is None:
            name, _, kind = element.partition(".")
            known = 0.01 if _aside(name, kind) else self.word_in.get(name, 0.5)
        return known

    def words(self, page: Page) -> list[float]:
        return [
            n * self.word(e) if n else 0.0
            for n, e in zip(page.words, page.elements(), strict=True)
        ]

    def stretch(self, page: Page) -> tuple[int, int] | None:
        return best_stretch(self.words(page), [self.of(k) for k in page.keys()])


def _aside(name: str, kind: str) -> bool:
    return name in _ASIDE or bool(kind and _ASIDE_CLASS.search(kind))


def fit(pages: list[str]) -> Scores:
    """Scores from pages of which some mark their article; the others are passed over."""
    scores = Scores()
    known = []
    for source in pages:
        page = Page(source)
        mark = page.marked()
        # The marked stretch from its first piece with words to the last one.
        pieces = [k for k in range(mark[0], mark[1] + 1) if page.words[k]] if mark else []
        if pieces:
            known.append((page, pieces[0], pieces[-1], page.keys()))
    inside, everywhere = Counter(), Counter()
    for page, first, last, _ in known:
        for k, element in enumerate(page.elements()):
            everywhere[element] += page.words[k]
            if first <= k <= last:
                inside[element] += page.words[k]
    for element, n in everywhere.items():
        if n:
            scores.word_in[element] = (inside[element] + 0.1) / (n + 0.2)
    for turn in range(ROUNDS):
        wrong = 0
        for page, first, last, keys in known:
            hard = [
                w * (0.5 if first <= k <= last else 3.0)
                for k, w in enumerate(scores.words(page))
            ]
            found = best_stretch(hard, [scores.of(k) for k in keys])
            if found == (first, last) or found is None:
                continue
            wrong += 1
            more = Counter(keys[first:last])
            more.subtract(keys[found[0] : found[1]])
            moved = sum(abs(n) for n in more.values()) or 1
            rate = max(1.0, (found[1] - found[0]) / moved) * (4.0 if turn < ROUNDS // 2 else 1.0)
            for key, n in more.items():
                if n:
                    step = rate * max(-3, min(3, n))
                    scores.by_key[key] = min(MOST, max(LEAST, scores.of(key) + step))
        if not wrong:
            break
    return scores


def train(pages: DataFrame) -> Scores:
    """Scores from a bounded sample of ``pages(page_id, html)`` that mark their article.

    ``TRAINING_PAGES`` pages of at most ``TRAINING_CHARS`` characters, drawn by hash; no
    others come to the driver, but for as many again.
    """
    source = F.col("html").cast("string")
    h = F.xxhash64("page_id", source)
    marked = (F.length(source) <= TRAINING_CHARS) & source.rlike(r"(?i)<(article|main)[\s>]")
    rows = (
        drawn(pages, marked, h, TRAINING_PAGES)
        .select(h.alias("h"), source.alias("html"))
        .orderBy("h", "html")
        .limit(TRAINING_PAGES)
        .collect()
    )
    return fit([r["html"] for r in rows])


def main_text(source: str | None, scores: Scores) -> str:
    page = Page(source or "")
    found = scores.stretch(page)
    return page.text(*found) if found else ""


def extract(pages: DataFrame, scores: Scores, keep: list[str]) -> DataFrame:
    """``text`` and ``n_chars`` (code points) of every whole page, beside ``keep``.

    Character references are decoded, white space within and between blocks becomes
    one blank, the ends are trimmed; scripts, styles, comments and elements that are no
    article text (menus, forms, adverts) are left out, formulas are text. NULL and empty
    pages, and pages without words, have an empty text. Rows neither merge nor change
    places; a column of ``pages`` called like a result is replaced.
    """
    shared = pages.sparkSession.sparkContext.broadcast(scores)
    keep = [c for c in keep if c not in ("text", "n_chars")]
    rows = pages.select(
        *[F.col(f"`{c}`") for c in keep], F.col("html").cast("string").alias("_html")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                texts = [
                    main_text(s, shared.value) for s in batch.column(len(keep)).to_pylist()
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns[: len(keep)],
                        pa.array(texts, pa.string()),
                        pa.array([len(t) for t in texts], pa.int64()),
                    ],
                    names=[*keep, "text", "n_chars"],
                )

    old = "".join(
        f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[: len(keep)]
    )
    return rows.mapInArrow(run, f"{old}text string, n_chars long")
