"""Main text of web pages by the maximum-scoring subsequence.

A page is a sequence of words and tags. Words score positive and tags negative; the run of neighbouring tokens with
the highest sum is the content, found in one scan. The weights come from pages whose markup says what their
article is: a word or tag weighs by how often it stands inside an article there, by the element around it.

Elements that are no content by their name, role or class (menus, adverts, forms, scripts, comments) are never part
of the text, wherever they stand; neither are places in which labelled pages (nearly) never have content.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# The bound of the labelled pages that weights are learned from, and of the kinds of places that have their own.
LABELLED = 20_000
KINDS = 20_000

# Scores: a word where content is certain, a tag where it is impossible, and a tag where it is certain.
WORD, TAG, INNER_TAG = 1.0, -3.25, -0.1
# The share of content taken for what is unknown: in an article by the page's markup, elsewhere, and for tags that
# mark up running text. It counts like one token where something is known.
UNKNOWN_INSIDE, UNKNOWN, UNKNOWN_TEXT_TAG = 0.98, 0.5, 0.95
# Starts the name of a place inside an article.
INSIDE = "+"
# Below this share of content a place that labelled pages have often enough is left out.
NEVER, OFTEN = 0.02, 50

# HTML elements by their part.
RAW = frozenset("script style noscript template iframe svg math textarea title object".split())
STRUCTURE = frozenset(
    "html head body article main section div nav aside header footer form dialog details figure table ul ol dl"
    " menu select button fieldset blockquote".split()
)
BLOCKS = STRUCTURE | frozenset(
    "p h1 h2 h3 h4 h5 h6 li dt dd tr td th thead tbody tfoot caption figcaption summary pre address hr br"
    " hgroup legend center option".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements without content, by name, role and the words of class and id. An article or main element inside one of
# the second kind is content all the same: layouts name themselves after their parts.
NO_CONTENT = frozenset("head nav aside footer dialog menu select button".split())
NO_CONTENT_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split()
)
NO_CONTENT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promos promotion"
    " breadcrumb breadcrumbs pagination pager cookie cookies consent gdpr newsletter comment comments commentlist"
    " disqus respond reply replies related recommended recommendations outbrain taboola".split()
)
AROUND_CONTENT = frozenset(["form", "fieldset"])
AROUND_CONTENT_ROLES = frozenset(["form"])
AROUND_CONTENT_WORDS = frozenset(
    "banner nav navbar navigation menu menus sidebar sidebars aside widget widgets header footer masthead topbar"
    " toolbar notice notices notification alert popup modal overlay subscribe subscription signup login share sharing social"
    " skip".split()
)
TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 br blockquote pre".split())
LABELS = ("article", "main")

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
MARK = re.compile(r"([^\s=/\"'>]+)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
NAME = re.compile(r"[a-z]+")
RAW_END = {name: re.compile(rf"</{name}\b[^>]*>", re.I) for name in RAW}

Token = tuple[str, str, str, bool, bool]  # kind, name of the tag or text, place, no content, labelled


def hides(name: str, marks: dict[str, str], inside: bool) -> int:
    """2 for an element without content, 1 for one whose only content is an article or main element in it, else 0;
    ``inside``: it stands in an article."""
    role = marks.get("role")
    if name in NO_CONTENT or role in NO_CONTENT_ROLES or "hidden" in marks or marks.get("aria-hidden") == "true":
        return 2
    if name in ("html", "body"):
        return 0
    said = set(NAME.findall(f"{marks.get('class', '')} {marks.get('id', '')}"))
    if name == "article":
        said.discard("comments")  # says that it has some
    if not NO_CONTENT_WORDS.isdisjoint(said) and name != "main":
        return 2
    if name in LABELS or name == "header" and inside:  # the headline of an article stands in its header
        return 0
    if name == "header" or name in AROUND_CONTENT or role in AROUND_CONTENT_ROLES:
        return 1
    return 0 if AROUND_CONTENT_WORDS.isdisjoint(said) else 1


def next_block(page: str, at: int) -> int:
    for found in TOKEN.finditer(page, at):
        if (found.group(2) or found.group(5) or "").lower() in BLOCKS - {"br"}:
            return found.start()
    return len(page)


def tokens(page: str) -> Iterator[Token]:
    """The tags and texts of a page in order, each with the place it stands in, whether that is no content by its
    markup, and whether it is inside the article that the page marks."""
    outside = ("", "", 0, False)
    open_ = [outside]  # name, place, how it hides, labelled
    at, end = 0, len(page)
    while at < end:
        found = TOKEN.search(page, at)
        start = found.start() if found else end
        _, place, none, labelled = open_[-1]
        if start > at:
            yield "text", page[at:start], place, none > 0, labelled
        if not found:
            return
        at = found.end()
        closing, name, rest = found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
        if not name:
            continue
        name = name.lower()
        if closing:
            yield "tag", name, place, none > 0, labelled
            back = next((k for k in range(len(open_) - 1, 0, -1) if open_[k][0] == name), 0)
            if back:
                del open_[back:]
            continue
        if name in RAW:
            if not rest.endswith("/"):
                close = RAW_END[name].search(page, at)
                at = close.end() if close else end
            yield "tag", name, place, True, labelled
            continue
        if name in STRUCTURE or rest and name not in VOID and "=" in rest:
            marks = {k.lower(): v.strip("\"'").lower() for k, v in MARK.findall(rest)} if rest else {}
            own = hides(name, marks, labelled)
            if name in STRUCTURE or own and name != "p":
                none = 0 if name in LABELS and none < 2 and not own else max(none, own)
                named = marks.get("role") == "main" or marks.get("itemprop") == "articlebody"
                labelled = labelled or named or name in LABELS
                if name in STRUCTURE:
                    first = NAME.search(marks.get("class", "") or marks.get("id", ""))
                    place = f"{INSIDE * labelled}{name}{'.' * bool(first)}{first.group() if first else ''}"
                open_.append((name, place, none, labelled))
            elif own:  # a paragraph may have no end tag, and ends at any block
                at = next_block(page, at)
        yield "tag", name, place, none > 0, labelled


def kinds_of(pages: Iterable[str]) -> Counter:
    """How many words and tags stand in which places of labelled pages: (kind, inside) to a number."""
    counts: Counter = Counter()
    for page in pages:
        own: Counter = Counter()
        for kind, name, place, none, labelled in tokens(page):
            inside = labelled and not none
            if kind == "tag":
                own[f"{place} {name}", inside] += 1
                own[f"{place} *", inside] += 1
            elif n := len(name.split()):
                own[f"{place} word", inside] += n
        if any(inside for _, inside in own):
            counts.update(own)
    return counts


def learned(pages: DataFrame, bound: int = LABELLED) -> dict[str, tuple[int, int]]:
    """For each kind of token and place, its numbers outside and inside the articles of labelled pages.

    Of more than ``bound`` pages a share of about ``bound`` is read, chosen by a hash of the html. At most ``KINDS``
    of the most frequent kinds are kept; others weigh like unknown ones.
    """
    one_in = max(1, -(-pages.count() // bound))
    chosen = pages.filter(F.col("html").isNotNull() & (F.pmod(F.xxhash64("html"), F.lit(one_in)) == 0)).select("html")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = kinds_of(v.as_py() for v in batch.column("html"))
            keys = list(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in keys], pa.string()), pa.array([i for _, i in keys], pa.bool_()),
                 pa.array([counts[k] for k in keys], pa.int64())],
                names=["kind", "inside", "n"],
            )

    found = chosen.mapInArrow(counted, "kind string, inside boolean, n long").groupBy("kind").agg(
        F.sum(F.when(F.col("inside"), 0).otherwise(F.col("n"))).alias("out"),
        F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("inn"),
    )
    rows = found.orderBy(F.desc(F.col("out") + F.col("inn")), "kind").limit(KINDS).collect()
    return {r["kind"]: (r["out"], r["inn"]) for r in rows}


class Weights:
    """Scores of words and tags by place, and the places that are left out."""

    def __init__(self, counts: dict[str, tuple[int, int]]):
        self.counts = counts
        self.known: dict[str, float] = {}

    def share(self, kind: str, unknown: float) -> float:
        """The share of a kind that is content; ``unknown`` counts like one token of it."""
        if kind not in self.known:
            out, inn = self.counts.get(kind, (0, 0))
            self.known[kind] = (inn + unknown) / (out + inn + 1)
        return self.known[kind]

    def word(self, place: str) -> float:
        return WORD * self.share(f"{place} word", UNKNOWN_INSIDE if place.startswith(INSIDE) else UNKNOWN)

    def tag(self, place: str, name: str) -> float:
        text_tag = name in TEXT_TAGS or name not in BLOCKS
        unknown = UNKNOWN_INSIDE if place.startswith(INSIDE) else UNKNOWN_TEXT_TAG if text_tag else UNKNOWN
        if f"{place} *" in self.counts:
            unknown = self.share(f"{place} *", unknown)
        return min(INNER_TAG, TAG * (1 - self.share(f"{place} {name}", unknown)))

    def left_out(self, place: str) -> bool:
        out, inn = self.counts.get(f"{place} word", (0, 0))
        return out + inn >= OFTEN and inn < NEVER * (out + inn)


def best_run(scores: list[float]) -> tuple[int, int]:
    """Start and end of the run with the highest sum; of equal ones the first that starts and the last that ends."""
    best, span = 0.0, (0, 0)
    total, start = 0.0, 0
    for at, score in enumerate(scores):
        if total < 0:
            total, start = 0.0, at
        total += score
        if total > best or total == best and span[1] and span[0] == start:
            best, span = total, (start, at + 1)
    return span


def main_text(page: str, weights: Weights) -> str:
    """The text of a page's content: white space in a block is one space, blocks are joined by one."""
    stream = []
    for kind, name, place, none, _ in tokens(page):
        hidden = none or weights.left_out(place)
        if kind == "tag":
            stream.append((weights.tag(place, name), " " if name in BLOCKS else ""))
        elif hidden:
            continue
        else:
            text = html.unescape(name)
            stream.append((weights.word(place) * len(text.split()), text))
    start, end = best_run([score for score, _ in stream])
    return " ".join("".join([text for _, text in stream[start:end]]).split())


def extract(pages: DataFrame, bound: int = LABELLED) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages``; ``text`` is its whole main text.

    A null or empty page, or one without content, has the text ''. Rows are taken as they are: ids and urls may be
    null or repeated, further columns do not count. Broken markup is read as far as it goes: an element ends where
    one around it ends. Without labelled pages words and tags have the same scores everywhere. An empty table has
    no rows.
    """
    pages = pages.select("page_id", "url", "html")
    counts = learned(pages, bound)

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = Weights(counts)
        for batch in batches:
            texts = [main_text(v.as_py() or "", weights) for v in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    kind, url = (pages.schema[c].dataType.simpleString() for c in ("page_id", "url"))
    return pages.mapInArrow(extracted, f"page_id {kind}, url {url}, text string, n_chars long")
