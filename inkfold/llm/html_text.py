"""Main text of web pages by the maximum-scoring subsequence of words and tags.

A page is read into a sequence of words and tags. Words score between 0 and 1, the
share of such words that lie in the article on labelled pages; tags score below 0 by
the share of such tags that lie outside. A linear scan finds the contiguous region
of the highest sum, which is widened to whole blocks. What stands inside it but is
no article (menus, forms, adverts, comments, scripts) is left out.

Labelled pages are those that name their article themselves: an ``article`` or ``main``
element that holds most of the words of such elements. They are counted twice, once as
they are and once as if nothing had a name; so pages with an article element are told
by it, and others by what the labelled pages teach about kinds of blocks, links and
tags. All pages are counted. The number of kinds is fixed, so the counts are a table of some hundred
rows. The factor of the tags is the one of ``FACTORS`` that finds the article best
on a sample of ``JUDGED`` labelled pages, dealt by hash, when they name no article, and
when nothing has a name at all.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator, Mapping
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Elements by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
DROPPED = frozenset("head title script style noscript template nav footer aside form dialog menu button select option textarea "
                    "fieldset datalist iframe object svg canvas audio video map xmp noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var wbr input button select".split())
KINDS = {"p": "p", "h1": "h", "h2": "h", "h3": "h", "h4": "h", "h5": "h", "h6": "h", "li": "li", "dd": "li", "dt": "li",
         "td": "td", "th": "td", "blockquote": "q", "pre": "q", "figcaption": "q"}
TAG_KINDS = {"a": "link", "ul": "list", "ol": "list", "dl": "list", "table": "table", "tr": "table", "tbody": "table", "thead": "table"}
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
# Words of class names and ids that mark what is no article.
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment commentlist comments consent cookie "
    "cookies discussion disqus footer gdpr login masthead menu menus modal nav navbar navigation newsletter notice notices outbrain overlay "
    "pager pagination paywall popup promo promos promotion rail recommendations recommended related replies reply respond share sharing "
    "sidebar sidebars signup social sponsor sponsored sponsors subscribe subscription taboola teaser teasers toolbar topbar trending "
    "widget widgets".split())
# Share inside the article assumed before pages are counted, with the weight of so many words.
PRIOR = {"p": 0.9, "h": 0.7, "q": 0.8, "li": 0.4, "td": 0.4, "other": 0.5}
TAG_PRIOR = {"block": 0.6, "inline": 0.7, "link": 0.3, "list": 0.3, "table": 0.3, "box": 0.2}
PRIOR_WEIGHT = 20.0
NAMED, OUTSIDE, UNNAMED = "in", "out", "none"
# Counts the labelled pages themselves.
LABELLED = "pages"
PLACE_PRIOR = {NAMED: 0.99, OUTSIDE: 0.01}
FACTORS = (0.5, 1.0, 2.0, 4.0, 8.0)
# Labelled pages, about, that the factor is chosen on.
JUDGED = 20_000
# Least share of the words of article elements that the largest must hold to label a page.
CLEAR = 0.8

# Quotes count only behind "=", and one that never closes is an ordinary character.
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|))*+)>""")
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"']++)))?(?=[\s/]|$)""", re.I)
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_UNSHOWN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Piece(NamedTuple):
    """A tag, or the text between two."""

    tag: str  # its name, "/" before that of an end tag, "" for text
    text: str
    words: int
    kind: str
    link: bool
    box: int  # place of the innermost open element in the list of boxes


class Box(NamedTuple):
    name: str
    parent: int
    hinted: bool
    whole_hint: bool
    main: bool = False


def _hints(name: str, attributes: str) -> tuple[bool, bool, str]:
    """Whether an element's attributes hint at no article, by parts of names and by whole names, and its role."""
    by_part, by_name, role = False, False, ""
    for found in _ATTRIBUTE.finditer(attributes):
        key, value = found[1].lower(), found[2] or found[3] or found[4] or ""
        if key in ("class", "id"):
            by_name = by_name or any(n.lower() in HINTS for n in value.split())
            by_part = by_part or any(p.lower() in HINTS for p in _NAME_PART.findall(value))
        elif key == "role":
            role = value.lower()
        elif (key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and _UNSHOWN.search(value))):
            by_part = by_name = True
    return by_part or role in ROLES, by_name or role in ROLES, role


def read(page: str) -> tuple[list[Piece], list[Box]]:
    """Pieces of a page in order, and its elements (all but paragraphs, list items, cells and inline ones)."""
    pieces: list[Piece] = []
    boxes = [Box("", -1, False, False)]
    open_boxes, kind, link, at, start = [0], "other", False, 0, 0
    is_open: Counter[str] = Counter()

    def put(upto: int) -> None:
        if upto > start:
            text = html.unescape(page[start:upto])
            pieces.append(Piece("", text, len(text.split()), kind, link, open_boxes[-1]))
    while (at := page.find("<", at)) >= 0:
        head = page[at + 1:at + 2]
        if head in ("!", "?"):
            put(at)
            if page.startswith("<!--", at):
                end = page.find("-->", at + 4)
                end = end + 3 if end >= 0 else len(page)
            else:
                end = page.find(">", at) + 1 or len(page)
            at = start = end
            continue
        found = _TAG.match(page, at)
        if not found:
            if head.isascii() and head.isalpha() or head == "/":
                # A tag that never ends.
                put(at)
                start = len(page)
                break
            at += 1
            continue
        put(at)
        closing, name = bool(found[1]), found[2].lower()
        at = start = found.end()
        if name == "a":
            link = not closing
        if name in KINDS:
            kind = "other" if closing else KINDS[name]
        elif name not in INLINE:
            kind, link = "other", False
            # An end tag closes the innermost element of its name and all within; a stray one nothing.
            while closing and is_open[name]:
                shut = boxes[open_boxes.pop()].name
                is_open[shut] -= 1
                if shut == name:
                    break
        hint = False, False, ""
        if not closing and name not in ("html", "body") and found[3]:
            hint = _hints(name, found[3])
        # Inline elements become boxes only where they hide something.
        if not closing and name not in VOID and ((name not in INLINE and name not in KINDS) or hint[0] or name in DROPPED):
            if name in RAW:
                pieces.append(Piece(name, "", 0, kind, link, open_boxes[-1]))
                end = re.compile(f"</{name}", re.I).search(page, at)
                at = start = end.start() if end else len(page)
                continue
            boxes.append(Box(name, open_boxes[-1], hint[0], hint[1], hint[2] == "main"))
            open_boxes.append(len(boxes) - 1)
            is_open[name] += 1
        elif closing and (name in INLINE or name in KINDS) and boxes[open_boxes[-1]].name == name:
            open_boxes.pop()
            is_open[name] -= 1
        pieces.append(Piece("/" + name if closing else name, "", 0, kind, link, open_boxes[-1]))
    put(len(page))
    return pieces, boxes


def _named(box: Box) -> str:
    """Which of the two names of an article an element bears, if any."""
    return "main" if box.main else box.name if box.name in ("article", "main") else ""


class Parsed(NamedTuple):
    pieces: list[Piece]
    dropped: list[bool]  # by box
    inside: list[bool] | None  # by box; None if the page does not name its article


def parse(page: str) -> Parsed:
    pieces, boxes = read(page)
    words = [0] * len(boxes)
    for p in pieces:
        words[p.box] += p.words
    within, holds = list(words), [False] * len(boxes)
    for i in range(len(boxes) - 1, 0, -1):
        within[boxes[i].parent] += within[i]
        named = _named(boxes[i]) != "" and not boxes[i].whole_hint
        holds[boxes[i].parent] = holds[boxes[i].parent] or holds[i] or named
    always, in_named, dropped = ([False] * len(boxes) for _ in range(3))
    for i, box in enumerate(boxes[1:], 1):
        always[i] = always[box.parent] or box.name in DROPPED
    shown = sum(p.words for p in pieces if not always[p.box])
    for i, box in enumerate(boxes[1:], 1):
        named = _named(box) != ""
        in_named[i] = in_named[box.parent] or named
        hinted = box.whole_hint if named else box.hinted and not holds[i]
        # Part of a name alone does not hide most of a page, nor a whole name all of it.
        most = shown if box.whole_hint else shown / 2
        hinted = hinted and (in_named[i] or within[i] < max(most, 1) or within[i] == 0)
        page_head = box.name == "header" and not in_named[i]
        dropped[i] = dropped[box.parent] or box.name in DROPPED or hinted or page_head
    # Words that count, by element.
    clear = [0 if dropped[i] else words[i] for i in range(len(boxes))]
    for i in range(len(boxes) - 1, 0, -1):
        clear[boxes[i].parent] += clear[i]
    for name in ("article", "main"):
        under = [False] * len(boxes)
        for i, box in enumerate(boxes[1:], 1):
            under[i] = under[box.parent] or _named(boxes[box.parent]) == name
        tops = [i for i, b in enumerate(boxes) if _named(b) == name and not dropped[i] and not under[i]]
        if tops and clear[0]:
            best = max(tops, key=lambda i: clear[i])
            if clear[best] and clear[best] >= CLEAR * sum(clear[i] for i in tops):
                inside = [False] * len(boxes)
                for i in range(best, len(boxes)):
                    inside[i] = i == best or inside[boxes[i].parent]
                return Parsed(pieces, dropped, inside)
    return Parsed(pieces, dropped, None)


def _tag_kind(tag: str) -> str:
    name = tag.lstrip("/")
    return TAG_KINDS.get(name) or ("inline" if name in INLINE else "block" if name in KINDS or name == "hr" else "box")


def features(page: Parsed, named: bool, bare: bool = False) -> list[tuple[str, str, bool, bool]]:
    """Per piece what its weight depends on: place, kind, in a link, dropped (``bare``: as if no name told so)."""
    out = []
    for p in page.pieces:
        place = UNNAMED if page.inside is None or not named else NAMED if page.inside[p.box] else OUTSIDE
        out.append((place, "/" + _tag_kind(p.tag), False, False) if p.tag else (place, p.kind, p.link, page.dropped[p.box] and not bare))
    return out


def weight(feature: tuple[str, str, bool, bool], counts: Mapping[tuple, tuple[int, int]]) -> float:
    """Share inside the article: of words, or (negative) of tags outside of it."""
    place, kind, link, dropped = feature
    tag = kind.startswith("/")
    prior = PLACE_PRIOR.get(place) or (TAG_PRIOR[kind[1:]] if tag else PRIOR[kind])
    prior = 0.01 if dropped else prior * 0.3 if link and place != NAMED else prior
    inside, every = counts.get(feature, (0, 0))
    share = (inside + PRIOR_WEIGHT * prior) / (every + PRIOR_WEIGHT)
    return share - 1 if tag else share


def region(pieces: list[Piece], scores: list[float]) -> tuple[int, int]:
    """Start and stop of the pieces of the best contiguous region (the first on ties), widened to whole blocks; empty if none scores."""
    best, found, total, start = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, found = total, (start, i + 1)
    start, stop = found
    if stop:
        while start > 0 and not _splits(pieces[start - 1].tag):
            start -= 1
        while stop < len(pieces) and not _splits(pieces[stop].tag):
            stop += 1
    return start, stop


def _splits(tag: str) -> bool:
    return bool(tag) and tag.lstrip("/") not in INLINE


def blocks(page: Parsed, start: int, stop: int) -> str:
    """Text of a region without what is dropped: one line per block, white space as one space."""
    out, here = [], []
    for p in page.pieces[start:stop]:
        if not p.tag:
            if not page.dropped[p.box]:
                here.append(p.text)
        elif p.tag == "br":
            here.append(" ")
        elif _splits(p.tag):
            out.append("".join(here))
            here = []
    out.append("".join(here))
    return "\n".join(filter(None, (" ".join(b.split()) for b in out)))


class Weights(NamedTuple):
    counts: dict[tuple, tuple[int, int]]
    factor: float


def _scores(page: Parsed, weights: Weights, named: bool, known: dict[tuple, float], bare: bool = False) -> list[float]:
    out = []
    for p, f in zip(page.pieces, features(page, named, bare)):
        w = known.get(f)
        if w is None:
            w = known[f] = weight(f, weights.counts)
        out.append(w * weights.factor if p.tag else w * p.words)
    return out


def extract(page: str, weights: Weights, known: dict[tuple, float]) -> str:
    parsed = parse(page)
    return blocks(parsed, *region(parsed.pieces, _scores(parsed, weights, True, known)))


def fit(pages: DataFrame, text: str = "html") -> Weights:
    """Weights from all pages that name their article; without any, the assumed shares and a factor of 1.

    All pages are counted by kind; about ``JUDGED`` labelled ones (all, if fewer) judge the factors.
    """
    rows = pages.where(F.col(text).isNotNull()).select(text)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside: Counter[tuple] = Counter()
        every: Counter[tuple] = Counter({(LABELLED, "", False, False): 0})
        for batch in batches:
            for value in batch.column(0):
                page = parse(value.as_py())
                if page.inside is None:
                    continue
                every[LABELLED, "", False, False] += 1
                for named in (True, False):
                    for p, f in zip(page.pieces, features(page, named, bare=not named)):
                        n = 1 if p.tag else p.words
                        every[f] += n
                        if page.inside[p.box] and not page.dropped[p.box]:
                            inside[f] += n
        if len(every) > 1:
            cols = [pa.array(c) for c in zip(*every)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array([inside[f] for f in every], pa.int64()), pa.array(every.values(), pa.int64())],
                                             names=["place", "kind", "link", "dropped", "inside", "every"])
    counted = rows.mapInArrow(count, "place string, kind string, link boolean, dropped boolean, inside bigint, every bigint")
    # Three places, six kinds of blocks in four ways and six kinds of tags, and one more: at most 91 rows.
    sums = counted.groupBy("place", "kind", "link", "dropped").agg(F.sum("inside"), F.sum("every")).collect()
    counts = {tuple(r)[:4]: tuple(r)[4:] for r in sums if r["place"] != LABELLED}
    one_in = -(-sum(r["sum(every)"] for r in sums if r["place"] == LABELLED) // JUDGED)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries = [(Weights(counts, f), {}) for f in FACTORS]
        right, found, wanted = Counter(), Counter(), Counter()
        for batch in batches:
            for value in batch.column(0):
                page = parse(value.as_py())
                if page.inside is None:
                    continue
                own = [p.words for p in page.pieces]
                kept = [0 if page.dropped[p.box] else p.words for p in page.pieces]
                hits = [n if page.inside[p.box] else 0 for p, n in zip(page.pieces, kept)]
                for weights, known in tries:
                    for bare, words in ((False, kept), (True, own)):
                        start, stop = region(page.pieces, _scores(page, weights, False, known, bare))
                        right[weights.factor] += sum(hits[start:stop])
                        found[weights.factor] += sum(words[start:stop])
                        wanted[weights.factor] += sum(hits)
        yield pa.RecordBatch.from_arrays([pa.array(FACTORS), *(pa.array([c[f] for f in FACTORS], pa.int64()) for c in (right, found, wanted))],
                                         names=["factor", "good", "found", "wanted"])
    if not counts:
        return Weights(counts, 1.0)
    sample = rows.where(F.pmod(F.xxhash64(text), F.lit(one_in)) == 0)
    judged = sample.mapInArrow(judge, "factor double, good bigint, found bigint, wanted bigint").groupBy("factor").agg(
        (2 * F.sum("good") / (F.sum("found") + F.sum("wanted"))).alias("f1")).collect()
    return Weights(counts, max(judged, key=lambda r: (r["f1"] or 0.0, -r["factor"]))["factor"])


def main_text(pages: DataFrame, weights: Weights | None = None, html_column: str = "html", text: str = "text") -> DataFrame:
    """All columns of ``pages`` but the html, and ``text``; row by row, without a shuffle.

    A null or empty page, or one without a word, has an empty text. Pages are read whole at any
    length; markup that never ends is dropped, a stray "<" is text. Repeated rows are
    read each. An empty table gives an empty result; a column called like ``text`` is replaced.
    """
    weights = weights or fit(pages, html_column)
    rest = [c for c in pages.columns if c not in (html_column, text)]
    rows = pages.select(*rest, F.coalesce(F.col(html_column), F.lit("")).alias(html_column))
    schema = T.StructType([*(rows.schema[c] for c in rest), T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, float] = {}
        for batch in batches:
            found = pa.array([extract(page.as_py(), weights, known) for page in batch.column(len(rest))], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], found], names=[*rest, text])
    return rows.mapInArrow(run, schema)
