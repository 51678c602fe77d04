"""Main text of pages: blocks, minimum cut by brute force, pages of other layouts, awkward input."""

import itertools
import random
import re
from html import unescape

import numpy as np
import pytest
from pyspark.sql import functions as F

from crmflow.llm import content
from crmflow.llm.page_blocks import CONTENT, FIRM, UNKNOWN, page_blocks
from crmflow.llm.queries_web import op11_html_extraction
from tests.llm.frames import CLASHES

PAGES = "page_id bigint, url string, html string"


@pytest.fixture(scope="module")
def scores(spark, small):
    return content.train_scores(spark.read.parquet(f"{small}/pages.parquet"))


def text_of(html, scores):
    return "\n".join(content.main_blocks(html, scores)[0])


def cost(labels, gains, edges):
    total = sum(max(-g, 0) if kept else max(g, 0) for kept, g in zip(labels, gains))
    return total + sum(c for a, b, c in edges if labels[a] != labels[b])


def test_minimum_cut_by_brute_force():
    rng = random.Random(8)
    for _ in range(300):
        count = rng.randrange(1, 9)
        gains = [rng.randrange(-12, 13) for _ in range(count)]
        pairs = [(a, b) for a in range(count) for b in range(a + 1, count)]
        edges = [(a, b, rng.randrange(0, 9)) for a, b in rng.sample(pairs, min(len(pairs), rng.randrange(0, 12)))]
        found = content.minimum_cut(gains, edges)
        least = min(cost(x, gains, edges) for x in itertools.product([False, True], repeat=count))
        assert cost(found, gains, edges) == least


def test_minimum_cut_of_many_open_blocks():
    """Half-decided blocks in long runs: the flow agrees with dynamic programming along the chain."""
    rng = random.Random(9)
    count = 3000
    gains = [rng.randrange(-6, 7) for _ in range(count)]
    edges = [(i, i + 1, rng.randrange(0, 8)) for i in range(count - 1)]
    best = [max(gains[0], 0), max(-gains[0], 0)]
    for i in range(1, count):
        step = edges[i - 1][2]
        best = [
            max(gains[i], 0) + min(best[0], best[1] + step),
            max(-gains[i], 0) + min(best[1], best[0] + step),
        ]
    assert cost(content.minimum_cut(gains, edges), gains, edges) == min(best)


def test_ties_are_content():
    assert content.minimum_cut([0, 5, -5], [(0, 1, 5), (1, 2, 5)])[0]
    assert content.minimum_cut([0], []) == [True]


def test_blocks():
    html = (
        '<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">'
        "<div id=nav><a href=/x>Home</a></div><p title=it's>don't &amp;amp; <b>st<i>op</i></b><br>now&nbsp;!"
        "<p>next<ul><li>one<li><a href='a>b'>two</a> x</ul><!-- <p>no --><script>'</p><p>'</script>tail &copy</body>"
    )
    blocks, around = page_blocks(html)
    assert [b.text for b in blocks] == ["Home", "don't &amp; stop now !", "next", "one", "two x", "tail ©"]
    assert [b.kind for b in blocks] == ["text", "text", "text", "item", "item", "text"]
    assert [b.verdict for b in blocks] == [FIRM] + [UNKNOWN] * 5
    assert blocks[0].link_share == 1 and 0.5 < blocks[4].link_share < 0.7
    assert all(outer < inner for inner, outer in enumerate(around))


@pytest.mark.parametrize(
    "html,texts",
    [
        ("", []),
        ("<", ["<"]),
        ("a < b > c", ["a < b > c"]),
        ("<p>a<!-- open", ["a"]),
        ("<p>a<script>open", ["a"]),
        ('<p>a<a href="open', ["a"]),
        ("</p></div>a</td>b", ["a", "b"]),
        ("<table><tr><td>a<td>b<tr><td><table><tr><td>c</table>d", ["a", "b", "c", "d"]),
        ("x<p>&#x41;&#66;&lt;i&gt; &bogus; &am", ["x", "AB<i> &bogus; &am"]),
        ("<p>\x0b　 \n</p>", []),
    ],
)
def test_broken_markup(html, texts):
    assert [b.text for b in page_blocks(html)[0]] == texts


@pytest.mark.parametrize("part", ["<div>", "<p>word ", "<a href='", '<a "', "<!--", "<li>x", "</p>", "<script>", "&amp"])
def test_long_pages_stay_linear(scores, part):
    content.main_blocks(part * 100_000, scores)


def test_the_given_pages(spark, small, scores):
    """On pages with an article element, the text is that of the article."""
    rows = spark.read.parquet(f"{small}/pages.parquet").collect()
    found = {r.page_id: r for r in op11_html_extraction(spark, small).collect()}
    assert len(found) == len(rows)
    for row in rows:
        article = re.search("<article>(.*)</article>", row.html, re.DOTALL)[1]
        parts = [re.sub("<br>", " ", p) for p in re.split("</?(?:p|h1)>", article)]
        parts = [" ".join(unescape(re.sub("<[^>]*>", "", p)).split()) for p in parts]
        want = "\n".join(p for p in parts if p)
        assert (found[row.page_id].text, found[row.page_id].n_chars) == (want, len(want))
        assert found[row.page_id].url == row.url


PROSE = [
    "The harbour was quiet that morning, and only two boats had left before the fog came in from the sea.",
    "Nobody had expected the old bridge to hold for so long; it had been built in a hurry, after the great flood of that year.",
    "In the end, the council voted for the plan, although three of its members had spoken against it at length.",
    "A short one.",
]


def layouts():
    """Pages of forms that training has not seen: (html, wanted blocks)."""
    body = "".join(f"<p>{p}</p>" for p in PROSE)
    divs = "".join(f"<div>{p}</div>" for p in PROSE)
    menu = "".join(f'<a href="/{w}">{w}</a> ' for w in ("Home", "News", "Sport", "Contact"))
    comments = '<section id="comments"><article class="comment"><p>I was there, and it was not at all like that, believe me, it was far worse.</p></article></section>'
    yield f'<div class="navbar">{menu}</div><div class="post-content">{body}</div><div id="sidebar"><p>{PROSE[0]}</p></div>', PROSE
    yield f'<div role="navigation">{menu}</div><div role="main"><h2>Title here</h2>{body}</div>{comments}', ["Title here", *PROSE]
    yield f"<header><h1>The Site</h1><div>{menu}</div></header><main><header><h1>Title</h1></header>{divs}<aside><p>{PROSE[1]}</p></aside></main>", ["Title", *PROSE]
    yield f'<form id="aspnet"><ul><li><a href=a>Home</a><li><a href=b>All</a></ul><article>{body}<div class="share-buttons">Share this story with friends</div></article><label>Name</label></form>', PROSE
    yield f'<ul><li><a href=a>Home</a></li><li><a href=b>About us</a></li></ul>{body}<ul><li><a href=c>Terms of use</a></li></ul>', PROSE
    yield f'<div class="cookie-notice"><p>We use cookies, as all others do, so that this page may work as it should for you.</p><button>Accept</button></div><article>{body}</article>', PROSE
    yield f'<div id="page-wrapper"><div class="story-body"><p>{PROSE[0]}</p><div class="ad-slot"><p>{PROSE[2]}</p></div><p>{PROSE[1]}</p></div><div class="newsletter"><form>Your mail: <input></form></div></div>', [PROSE[0], PROSE[1]]
    yield f'<article>{body}<p style="display:none">{PROSE[0]}</p><div hidden>{PROSE[1]}</div></article><footer><p>{PROSE[2]}</p></footer>', PROSE


def test_pages_of_other_layouts(scores):
    right = wrong = missed = 0
    for html, want in layouts():
        found = content.main_blocks(html, scores)[0]
        right += sum(w in found for w in want)
        missed += sum(w not in found for w in want)
        wrong += sum(f not in want for f in found)
    assert right / (right + missed) >= 0.95
    assert right / (right + wrong) >= 0.95


def test_awkward_pages(spark, tmp_path):
    big = "<article>" + "".join(f"<p>word{i}, of a long page." for i in range(50_000))
    rows = [
        (1, None, None), (2, "u", ""), (2, "u", ""), (None, None, "<p>a<p>b"), (None, "v", big),
        (3, "w", "\x00<p>\x00"), (4, "x", "plain text with no markup at all, but some length and an end."),
    ]
    table = spark.createDataFrame(rows, PAGES).select("*", *[F.lit(c).alias(c) for c in (*CLASHES, "text", "n_kept")])
    table.write.parquet(f"{tmp_path}/pages.parquet")
    found = op11_html_extraction(spark, str(tmp_path))
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    texts = sorted((r.page_id or 0, r.url or "", r.n_chars) for r in found.collect())
    whole = sum(len(f"word{i}, of a long page.") + 1 for i in range(50_000)) - 1
    assert texts == [(0, "", 3), (0, "v", whole), (1, "", 0), (2, "u", 0), (2, "u", 0), (3, "w", 3), (4, "x", 61)]


def test_no_pages(spark, tmp_path):
    spark.createDataFrame([], PAGES).write.parquet(f"{tmp_path}/pages.parquet")
    assert op11_html_extraction(spark, str(tmp_path)).collect() == []


def test_without_examples_scores_are_zero():
    assert not content.fit_scores(np.zeros((content.CODES, 2))).any()
    counts = np.zeros((content.CODES, 2))
    counts[:, 1] = 5
    assert not content.fit_scores(counts).any()


def test_markup_words():
    html = '<div class="article-header"><p>a</p></div><div class="header"><p>b</p></div><div class="no-sidebar"><p>c</p></div>'
    assert [b.verdict for b in page_blocks(html)[0]] == [CONTENT, FIRM, UNKNOWN]
