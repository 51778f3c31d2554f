"""Main text of pages: written pages with known articles, the region against brute force, the query against a plain parser."""

import random
import re
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from inkfold.llm import html_text, queries

NOTHING = html_text.Weights({}, 1.0)


def text_of(page, weights=NOTHING):
    return html_text.extract(page, weights, {})


LONG = "These are the words of a paragraph that is long enough to be read as running text, word after word after word."
BOX = f"<h1>The title</h1><p>{LONG}</p><p>Second &amp; <b>bo</b>ld&nbsp;one. {LONG}</p>"
WANT = f"The title\n{LONG}\nSecond & bold one. {LONG}"
MENU = '<ul><li><a href="/a">News today</a></li><li><a href="/b">Sport and more</a></li><li><a href="/c">About us</a></li></ul>'
SMALL = "Words that do not belong to it at all."


@pytest.mark.parametrize("page,want", [
    (f"<html><body><nav>{MENU}</nav><article>{BOX}</article><footer>&copy; {SMALL}</footer></body></html>", WANT),
    (f"<body><header><p>{SMALL}</p></header><main>{BOX}<section id='comments'><p>{SMALL} {LONG}</p></section></main>", WANT),
    (f"<article><header class='entry-header'><h1>The title</h1></header>{BOX[18:]}<div class='ad'>{SMALL}</div></article>", WANT),
    (f"<article>{BOX}</article><section><article class='comment'><p>{SMALL}</p></article><article class='comment'><p>{LONG}{LONG}{LONG}</p></article></section>", WANT),
    (f"<article>{BOX[:-4]}<aside>{SMALL}</aside><form><label>Name</label><input name=x><button>Go on</button></form></article>", WANT),
    (f"<div class='cookie-notice'>{SMALL}</div><div class='page has-sidebar'><article>{BOX}</article><div class=sidebar>{SMALL}</div></div>", WANT),
    (f"<article>{BOX.replace('<p>', '<p>').replace('</p>', '')}<script>if (a < b) c('</p>')</script><style>p{{}}</style></article>", WANT),
    (f"<article>{BOX}<div hidden>{SMALL}</div><div style='display: none'>{SMALL}</div><!-- {SMALL} --></article>", WANT),
    (f"<div><div>{MENU}</div><div>{BOX}</div><div>{MENU}</div><div class='related'>{SMALL}</div></div>", WANT),
    (f"<table><tr><td>{MENU}</td><td>{BOX}</td></tr></table><div id='footer'><p>{SMALL}</p></div>", WANT),
    (f"<ARTICLE data-x='a>b' title=it's>{BOX}</ARTICLE >", WANT),
    ("<article><p>one<br>two\n\t three</p><ul><li>x &lt; y</li><li>&#x41;&#66;</li></ul>5 < 6</article>", "one two three\nx < y\nAB\n5 < 6"),
    ("", ""), ("<p></p>", ""), ("<article></article>", ""), ("<nav><a>Only a menu</a></nav>", ""), ("just words", "just words"),
    ("<article><p>cut off &am", "cut off &am"), ("<article><p>kept</p><p class='x", "kept"), ("a <b", "a"), ("<", "<"), ("<!-- never ends", ""),
])
def test_written_pages(page, want):
    assert text_of(page) == want


def test_region_is_the_best():
    rng = random.Random(5)
    for _ in range(300):
        scores = [rng.choice([-2.0, -1.0, -0.5, 0.0, 0.5, 1.0, 3.0]) for _ in range(rng.randint(0, 12))]
        # Every piece stands between tags that split blocks, so nothing is widened.
        pieces = [html_text.Piece("p", "", 0, "p", False, 0)] * len(scores)
        start, stop = html_text.region(pieces, scores)
        every = [sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)]
        assert sum(scores[start:stop]) == max([0.0, *every])


class Plain(HTMLParser):
    """The article of the test pages: headings and paragraphs of the article element."""

    def __init__(self):
        super().__init__()
        self.on, self.blocks = False, [""]

    def handle_starttag(self, tag, attrs):
        self.on = self.on or tag == "article"
        if tag not in ("b", "br"):
            self.blocks.append("")
        elif tag == "br":
            self.blocks[-1] += " "

    def handle_endtag(self, tag):
        self.on = self.on and tag != "article"
        if tag != "b":
            self.blocks.append("")

    def handle_data(self, data):
        if self.on:
            self.blocks[-1] += data


def plain_text(page):
    parser = Plain()
    parser.feed(page or "")
    parser.close()
    return "\n".join(filter(None, (" ".join(b.split()) for b in parser.blocks)))


def test_query_on_whole_table(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()
    found = queries.REGISTRY["op12_html_extraction"](spark, SF_DIR)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    want = [(r.page_id, r.url, plain_text(r.html), len(plain_text(r.html))) for r in pages]
    assert sorted(map(tuple, found.collect())) == sorted(want)


def test_weights_learned_find_articles_without_a_name(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    weights = html_text.fit(pages)
    assert weights.factor in html_text.FACTORS and weights.counts
    rows = pages.collect()
    unnamed = [r.html.replace("<article>", "<div>").replace("</article>", "</div>") for r in rows]
    # No name at all: neither of the article nor of what is around it.
    bare = [re.sub("<(/?)(nav|footer)>", r"<\1div>", u).replace('class="ad"', 'class="x9"') for u in unnamed]
    for given in (unnamed, bare):
        right = sum(text_of(b, weights) == plain_text(r.html) for b, r in zip(given, rows))
        assert right >= 0.99 * len(rows)


def test_odd_rows(spark):
    rows = [(1, "u", None, "mine"), (1, "u", None, "mine"), (None, None, "", None), (2, "v", "<p>" + "a b " * 200_000, "x"), (3, "w", "<b>" * 50_000 + "deep", "y"),
            (4, "w", "<div>" * 20_000 + "deep", "y")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, words string").withColumn("place", F.lit(1))
    found = html_text.main_text(pages)
    assert found.columns == ["page_id", "url", "words", "place", "text"]
    got = sorted(((r.page_id, r.words, r.text) for r in found.collect()), key=str)
    assert got == sorted([(1, "mine", ""), (1, "mine", ""), (None, None, ""), (2, "x", ("a b " * 200_000).strip()), (3, "y", "deep"), (4, "y", "deep")], key=str)
    assert html_text.main_text(pages.limit(0)).count() == 0
    assert html_text.fit(pages) == NOTHING
