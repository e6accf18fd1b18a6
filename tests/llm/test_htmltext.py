import html
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from portrait.llm import htmltext as H

LONG = "This is the text of the article that we want to have in the output, and it is long enough for the rules to see that it is text. "
BOILER = "Buy the best of the things in the world that you want to have now, and be one of the first to get it for less than it was."

PAGES = [
    (None, ""), ("", ""), ("   ", ""), ("plain words", "plain words"), ("<p>short</p>", "short"),
    (f"<nav><a href=/>Home</a> the menu</nav><article><h1>Title &amp; more</h1><p>{LONG}</p><p>Short one.</p></article><footer>&copy; of the company</footer>", f"Title & more\n{LONG.strip()}\nShort one."),
    (f"<div class='article-body'><p>{LONG}</p></div><div class=sidebar><p>{BOILER}</p></div>", LONG.strip()),
    (f"<article><p>{LONG}</p><div id='comments'><p>{BOILER}</p></div><p>The end.</p></article>", f"{LONG.strip()}\nThe end."),
    (f"<article><p>{LONG}</p><section class='reader-comments'><article class=comment><p>{BOILER}</p></article></section></article>", LONG.strip()),
    (f"<main><p>{LONG}</p><div role=complementary>{BOILER}</div><div class=cookieNotice>{BOILER}</div><p hidden>{BOILER}</p><div style='display: none'>{BOILER}</div></main>", LONG.strip()),
    (f"<main><p>{LONG}</p><form>{BOILER}<input><textarea>{BOILER}</textarea></form></main><p>{BOILER}</p>", LONG.strip()),
    (f"<article><p>{LONG}<b>bold</b>er&nbsp;&#233;&lt;b&gt;\n\t x<br>y</p>", f"{LONG}bolder é<b> x y"),
    (f"<article><p>{LONG}<br><br>next line", f"{LONG.strip()}\nnext line"),
    (f"<script>var t = '</p><p>{BOILER}';</script><style>p{{}}</style><!-- <p>{BOILER}</p> --><article><p>{LONG}</p></article>", LONG.strip()),
    (f"<article><p>{LONG}</p><!-- never closed <p>{BOILER}</p>", LONG.strip()),
    (f"<article><p>{LONG}</p><script>never closed <p>{BOILER}</p>", LONG.strip()),
    (f"<nav>never closed<article><p>{LONG}</p></article>", LONG.strip()),
    (f"<ARTICLE><P>{LONG}</P></ARTICLE><FOOTER>{BOILER}</FOOTER>", LONG.strip()),
    (f'<article><p title="a>b" data-x=\'p>\'>{LONG}</p></article>', LONG.strip()),
    (f"<article><p>{LONG}</p><p><a href=1>{BOILER}</a> <a href=2>{BOILER}</a></p></article>", LONG.strip()),
    (f"<article><p>{LONG}</p><p>x <b <i>y</i></p></article>", f"{LONG.strip()}\nx y"),
    (f"<article><p>1 < 2 and 3 > 2. {LONG}</p></article>", f"1 < 2 and 3 > 2. {LONG.strip()}"),
    ("<article><h1>Only</h1><p>Short.</p></article>", "Only\nShort."),
    ("<nav><p>menu of the page</p></nav>", ""),
]


@pytest.mark.parametrize("page, want", PAGES)
def test_main_text(page, want):
    assert H.main_text(page) == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div class=ad>", "</div>", "<article>", "</article>", "<a href='x'>", "</a>", "<!--", "-->", "<script>", "</script>", "<br>", "<b", ">", "<", "&", "&amp;", "text ", LONG, "\n", '"', "é", "</", "<!", "<nav>", "</nav>"]), max_size=25))
def test_any_markup_gives_trimmed_lines(parts):
    for line in H.main_text("".join(parts)).split("\n"):
        assert line == " ".join(line.split())


def test_time_grows_in_proportion():
    import time

    for unit in ("<", "<a ", "<p class='", "<!-", "&", "<b><i>", "</p", '<a x="', "<a>", "<!", "<a '>", "<div>", "<div></p></b>", "<div>x", "<article><nav>", "</div>", "<p>x", "<script>"):
        start = time.perf_counter()
        H.main_text(unit * 20_000)
        assert time.perf_counter() - start < 5, unit


def test_query_returns_the_articles_of_the_pages(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = H.op5_htmltext(spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>|<br><p>", article)]
        assert r.text == "\n".join(x for x in parts if x)
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_rows(spark):
    rows = [(1, "u", p, "x", 5) for p, _ in PAGES[:6]] + [(1, "u", PAGES[5][0], "x", 5), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, row string, text int")
    got = H.extract(df, ["page_id", "row", "text"]).collect()
    assert sorted(r.text for r in got) == sorted([w for _, w in PAGES[:6]] + [PAGES[5][1], ""])
    assert H.extract(df.limit(0), ["page_id"]).count() == 0


def test_containers_of_any_depth_tell_blocks_apart():
    """An open short block takes the label of its own container, however deep."""
    for depth in (3, 70, 5000):
        deep = "<div>" * depth
        text = "<p>" + "the and of to in a word with the and of to in the same " * 4 + "</p>"
        far = "<p>" + "xq zv kw " * 60 + "</p>"  # long, without stop words: boilerplate
        page = f"<body>{deep}<div>{far}</div><div><p>short one</p>{text}</div>{'</div>' * depth}</body>"
        got = H.main_text(page).split("\n")
        assert got[0] == "short one" and len(got) == 2, depth
        page = f"<body>{deep}<div>{text}</div><div><p>short one</p>{far}</div>{'</div>' * depth}</body>"
        assert "short one" not in H.main_text(page), depth
