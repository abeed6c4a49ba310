import html
import re

import pytest

from tallystar.llm import html_text as ht
from tallystar.llm import queries

TREE = ht.grow(ht.LABELLED)
SF = "/root/testdata/sf0.001"


def text(page):
    return ht.main_text(page, TREE)


def test_tree_fits_its_table():
    assert all(ht.judge(TREE, row[:-1]) == row[-1] for row in ht.LABELLED)
    assert ht.grow([(0, 1), (1, 0)]) == (0, 0.5, 1, 0) and ht.grow([(5, 1)]) == 1


ARTICLE = """<html><head><title>T</title><style>p{}</style></head><body>
<header><h1>Site name</h1></header><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav>
<div class="cookie-notice">We use cookies, and we would like you to accept all of them now.</div>
<article><h1>Head &amp; line</h1><p>First   paragraph with <b>bold</b> and a <a href=x>link</a> in it.
<p>Second one<br>goes on &lt;here&gt; &eacute;.</p><!-- <p>no</p> --><script>if (a < b) "</p>";</script>
<form><input value=x><label>Your mail address please</label></form><p>Ok.</p>
<aside><p>Related: a long sentence about something else that nobody asked for here.</p></aside>
<div class="comments"><p>A reader writes many words about this article, all of them in vain.</p></div>
</article><div id="sidebar"><p>Buy one of these wonderful things today, while they are still cheap.</p></div>
<footer>&copy; Site, all rights reserved and so on and so forth, since nobody reads this.</footer></body></html>"""


def test_article():
    assert text(ARTICLE) == ("Head & line\n\nFirst paragraph with bold and a link in it.\n\n"
                             "Second one goes on <here> é.\n\nOk.")


def test_page_without_article():
    words = "several plain words that make up a sentence of some length " * 6
    page = (f"<body><ul class=menu><li><a href=a>A</a></li></ul><div><p>{words}</p><p>{words}</p></div>"
            "<div class=ad><p>Cheap things for sale here</p></div></body>")
    assert text(page) == "\n\n".join([words.strip()] * 2)


@pytest.mark.parametrize("page,want", [
    (None, ""), ("", ""), ("<article><p>a < b and 3<4 &am", "a < b and 3<4 &am"),
    ("<article><p>cut off <a hre", "cut off"), ("<article><p title='a>b'>quoted</p>", "quoted"),
    ("<article><p title=\"never closed>text</p>", "text"), ("<article><p>x<!-- open", "x"),
    ("<ARTICLE><P>upper</P></ARTICLE>", "upper"), ("<article><p>&#233;&#x41;&nbsp;z</p>", "éA z")])
def test_odd_pages(page, want):
    assert text(page) == want


def test_long_and_deep_pages():
    assert len(text("<article><p>" + "word " * 200_000)) == 999_999
    assert text("<article>" + "<div>" * 5000 + "<p>deep words</p>") == "deep words"
    assert text("<article><p a=" + "'" * 20_001 + ">x")


def own_reading(page):
    """The article's paragraphs of the given pages, by their known frame."""
    body = re.search(r"<article>(.*?)(</article>|<footer>|$)", page, re.S)[1]
    body = re.sub(r"<[^<>]*$", "", body.replace("<br>", " "))
    parts = [" ".join(html.unescape(re.sub(r"</?b>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", body)]
    return "\n\n".join(filter(None, parts))


def test_given_pages(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = queries.op9_main_text(spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.text == own_reading(pages[r.page_id]) and r.n_chars == len(r.text)


def test_edges(spark):
    rows = [(1, "u", ARTICLE), (1, "u", ARTICLE), (None, None, None), (2, "v", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "url AS text", "url AS id")
    got = ht.extract(pages)
    assert got.columns == ["page_id", "url", "text"]
    assert sorted(len(r.text) for r in got.collect()) == [0, 0, *[len(text(ARTICLE))] * 2]
    assert ht.extract(pages.limit(0)).count() == 0


BODY = " ".join(["several plain words that make up a sentence"] * 4)
LONG_BODY = " ".join(["several plain words that make up a sentence"] * 20)


@pytest.mark.parametrize("name", [
    "content has-sidebar", "with-sidebar", "no-sidebar", "menu-open site", "sidebar", "ad-free",
    "content-sidebar-wrap", "newsletter", "layout--with-sidebar", "site-search"])
def test_wrapped_articles_are_kept(name):
    want = f"The head line\n\n{BODY}\n\nOk."
    inner = f"<h1>The head line</h1><p>{BODY}</p><p>Ok.</p>"
    for tag in ("article", "main"):
        assert text(f"<body><div class='{name}'><{tag}>{inner}</{tag}></div></body>") == want
    assert text(f"<form id=f><div id='{name}'><article>{inner}</article></div></form>") == want


@pytest.mark.parametrize("name", ["content has-sidebar", "no-sidebar", "menu-open site", "sidebar-layout"])
def test_layout_names_mark_nothing(name):
    assert text(f"<div class='{name}'><p>{BODY}</p><p>{BODY}</p></div>") == f"{BODY}\n\n{BODY}"


def test_titles_in_an_entry_header_are_kept():
    page = f"<article><div class='entry-header'><h1>The head line</h1></div><p>{BODY}</p></article>"
    assert text(page) == f"The head line\n\n{BODY}"


def test_long_texts_in_what_may_be_boilerplate():
    assert text(f"<div class='widget'><p>{LONG_BODY}</p></div>") == LONG_BODY
    linked = f"<div class='widget'><p><a href=x>{LONG_BODY}</a></p></div>"
    assert text(linked) == text(f"<div class='comments'><p>{LONG_BODY}</p></div>") == ""


@pytest.mark.parametrize("wrapper", ["div class='comments'", "div id=related-posts", "aside", "footer", "nav",
                                     "div class='site-footer'", "div class='cookie-notice'"])
def test_boilerplate_is_still_dropped(wrapper):
    tag = wrapper.split()[0]
    page = f"<body><article><p>{BODY}</p></article><{wrapper}><p>{BODY}</p></{tag}></body>"
    assert text(page) == BODY
    if "footer" not in wrapper and "cookie" not in wrapper:
        assert text(page.replace(f"<{wrapper}><p>", f"<{wrapper}><article><p>")) == BODY


def test_short_pages_without_article_are_kept_by_their_neighbours():
    assert text("<body><p>Hello world. Short page text.</p></body>") == "Hello world. Short page text."
    assert text("<body><h2>Small head</h2><p>One line here.<p>And one more.</body>") == (
        "Small head\n\nOne line here.\n\nAnd one more.")
    between = "<div><a href=a>One</a></div><div>8 May</div><div><a href=b>Two links</a></div>"
    assert text(f"<body>{between}</body>") == ""
    features = set()

    def used(tree):
        if not isinstance(tree, int):
            features.add(tree[0])
            used(tree[2]), used(tree[3])
    used(TREE)
    assert {0, 1, 3, 5, 6, 7} <= features      # words, densities of all three, article, mark


def test_marked_texts_are_judged_by_the_tree_at_any_length():
    for n in (20, 150, 800, 5000):
        body = " ".join(["plain"] * n)
        assert text(f"<div class='comments'><p>{body}</p></div>") == ""
        assert text(f"<article><p><a href=x>{body}</a></p></article>") == ""
        assert text(f"<article><p>{body}</p></article>") == body
        assert text(f"<div class='sidebar'><p>{body}</p></div>") == (body if n > 100 else "")


def test_unmatched_end_tags_take_linear_time():
    import time
    begun = time.perf_counter()
    found = ht.blocks("<div>" * 8000 + "</p>x" * 8000)
    assert time.perf_counter() - begun < 2 and len(found) == 8000     # about 0.1 s alone
    page = ht._Page()
    for name in ("div", "p", "li", "p", "h2", "h1"):
        page.begin(name, "")
    page.end("section"), page.end("li"), page.end("li")
    assert [n for n, *_ in page._open] == ["div"] and +page._count == {"div": 1}
