import html
import itertools
import random
import re
import time

import pytest

from surveyloom.llm import html_extract
from surveyloom.llm.html_extract import Flow, main_text

PROSE = "Some words about a long matter that goes on and on, without a link and with a full stop at the end of it. " * 3

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site</h1></header><div class="cookie-notice">We use cookies</div><nav><ul><li><a href=x>Home</a><li><a href=y>News</a></ul></nav>
<div id="content"><article><header><h1>Real &amp; title</h1></header><p>First <b>para</b> with <a href=1>link</a>
text &eacute;&#33; ok.<p>Un<i>split</i> word<br>line <aside>Side</aside><form><label>Mail</label><input></form><ul><li>One<li>Two</ul>
<div class=ad>Buy</div><p>Short.</p><!-- <p>no</p> --><section class="comments"><article><p>A reader writes a long remark here, and more of it.</p></article></section></article></div>
<div class="sidebar"><p>More</p></div><footer>&copy; x</footer>"""


def test_article_without_the_rest():
    wanted = ["Real & title", "First para with link text é! ok.", "Unsplit word line", "One", "Two", "Short."]
    assert main_text(PAGE) == "\n".join(wanted)


def test_pages_of_the_table(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    rows = {r.page_id: r for r in html_extract.extract(pages).collect()}
    for page in pages.collect():
        article = re.sub(r"</?b>", "", re.search(r"<article>(.*?)</article>", page.html, re.S)[1])
        parts = (" ".join(html.unescape(re.sub("<[^>]*>", " ", p)).split()) for p in re.split(r"</?(?:h1|p)>", article))
        wanted = "\n".join(p for p in parts if p)
        assert (rows[page.page_id].text, rows[page.page_id].n_chars, rows[page.page_id].url) == (wanted, len(wanted), page.url)


def test_pages_without_an_article():
    prose = "Some words about a long matter that goes on and on. " * 4
    page = f"<body><ul class=menu><li><a href=1>A</a><li><a href=2>B</a></ul><div><p>{prose}</p><p>Short end.</p><p>{prose}</p></div><p><a href=3>Next page</a></p></body>"
    assert main_text(page).split("\n") == [prose.strip(), "Short end.", prose.strip()]


@pytest.mark.parametrize("source", ["", None, "<", "<p", "<a href='", "</p></div>", "<!--", "<script>x", "<p>" * 3000, "<div>" * 3000 + "x", "&#xD800; &bogus;"])
def test_broken_markup(source):
    main_text(source)


def test_minimum_cut_matches_all_labellings():
    rng = random.Random(7)
    for _ in range(60):
        n = rng.randrange(1, 8)
        ends = [(rng.randrange(0, 9), rng.randrange(0, 9)) for _ in range(n)]
        ties = [(rng.randrange(n), rng.randrange(n), rng.randrange(0, 6)) for _ in range(2 * n)]
        ties = [t for t in ties if t[0] != t[1]]
        flow = Flow(n + 2)
        for i, (source, sink) in enumerate(ends):
            flow.connect(0, i + 2, source, 0)
            flow.connect(i + 2, 1, sink, 0)
        for a, b, c in ties:
            flow.connect(a + 2, b + 2, c, c)

        def cost(side):
            return sum(e[1] if s else e[0] for e, s in zip(ends, side)) + sum(c for a, b, c in ties if side[a] != side[b])

        assert cost(flow.source_side()[2:]) == min(cost(s) for s in itertools.product([True, False], repeat=n))


def test_odd_pages(spark):
    pages = spark.createDataFrame([(1, None, None), (None, "u", "<article>x</article>"), (2, "u", ""), (2, "u", "")], "page_id long, url string, html string")
    rows = html_extract.extract(pages.selectExpr("*", "'y' AS text", "1 AS n_chars"))
    assert sorted(map(tuple, rows.collect()), key=str) == sorted([(1, None, "", 0), (None, "u", "x", 1), (2, "u", "", 0), (2, "u", "", 0)], key=str)
    assert html_extract.extract(pages.limit(0)).count() == 0




def _lines(body):
    page = html_extract.read_page(f"<body>{body}</body>")
    outside, around = html_extract.outside_weight(page), html_extract.wrappers(page)
    alone = [b.text for b in page.blocks if html_extract.evidence(b, outside, around) > 0]
    return main_text(f"<body>{body}</body>").split("\n"), alone


def test_an_article_does_not_decide_alone():
    prose, tail = PROSE.strip(), "Words that follow the article in an element beside it, for long enough. " * 4
    links = "".join(f"<li><a href={i}>Another page number {i}</a>" for i in range(5))
    lines, _ = _lines(f"<main><h1><a href=x>Title of it</a></h1><p>{prose}</p><ul>{links}</ul><p><a href=y>Read on here</a></p><p>End.</p></main><div><p>{tail}</p><p>{tail}</p></div>")
    assert lines == ["Title of it", prose, "End.", tail.strip(), tail.strip()]


LISTED = ("advert", "comment", "cookie-notice", "newsletter", "notice", "related", "social share", "sidebar", "promoBox")


@pytest.mark.parametrize("name", LISTED)
def test_listed_names_go_wherever_they_are(name):
    """However long they are and whatever stands around them, by class, id, tag or role, in paragraphs, sections and lists."""
    prose, other = PROSE.strip(), "Long words of another kind that nobody asked for and that stand amid the article. " * 5
    for inner in (f"<p class='{name}'>{other}</p>", f"<div id='{name}'><p>{other}</p><p>{other}</p></div>", f"<aside><p>{other}</p></aside>", f"<ul class='x {name}'><li>{other}<li>{other}</ul>"):
        assert _lines(f"<article><p>{prose}</p>{inner}<p>{prose}</p></article>")[0] == [prose, prose]
        # Without a main the most of the text has to be the article's, or else the listed element could be its wrapper.
        assert _lines(f"<div><p>{prose}</p><p>{prose}</p>{inner}<p>{prose}</p></div>")[0] == [prose] * 3


def test_the_cut_changes_labels_of_an_article():
    prose = PROSE.strip()
    short = "A few words."
    lines, alone = _lines(f"<div><p>{prose}</p><p>{short}</p><p>{prose}</p></div>")
    assert lines == [prose, short, prose] and alone == [prose, prose]
    # The same words away from the paragraphs go.
    assert _lines(f"<div><p>{prose}</p><p>{prose}</p></div><div><div>{short}</div></div>")[0] == [prose, prose]


def test_text_beside_a_main_that_holds_most_of_the_page_goes():
    prose, beside = PROSE.strip(), "Words in an unlisted element beside the article, for long enough to be read as text of its own. " * 2
    assert _lines(f"<main><h1>Title</h1><p>{prose}</p><p>{prose}</p></main><div><p>{beside}</p></div>")[0] == ["Title", prose, prose]


@pytest.mark.parametrize("source", [
    "<div class=ad>" * 20_000 + "x", "<div>" * 20_000 + "x", "<p>word</p>" * 20_000, "<b>x" * 20_000, "<ul><li>x" * 10_000,
    "<p><table><tr><td>" * 5_000 + "x", "<a href=x>y" * 20_000, "<div class=ad>y<p>x</p>" * 10_000, "<main>" + f"<p>{PROSE}</p><p>x</p>" * 4_000,
])
def test_deep_and_long_pages_take_linear_time(source):
    start = time.perf_counter()
    main_text(source)
    assert time.perf_counter() - start < 10


def test_a_listed_wrapper_keeps_its_article():
    prose = PROSE.strip()
    for inner in (f"<article><h1>Title</h1><p>{prose}</p><p>Short.</p><p>{prose}</p></article>", f"<div><h1>Title</h1><p>{prose}</p><p>{prose}</p></div>"):
        lines, _ = _lines(f"<div class='layout with-sidebar'>{inner}<div class=sidebar><p>Other things</p></div></div><footer>{prose[:80]}</footer>")
        assert lines.count(prose) == 2 and "Other things" not in lines and len(lines) == inner.count("<p>") + ("article" in inner)
    remark = f"<section class=comments><article><p>{prose}</p></article></section>"
    assert _lines(f"<article><p>Short one.</p>{remark}</article>")[0] == ["Short one."]
