"""HTML extraction: the tree, odd markup, and the given pages against a parser of their one layout."""

import html
import re

import numpy as np
import pytest

from riskloom.llm import html_text

TREE = html_text.trained()


def text_of(page):
    return html_text.main_text(page, TREE)


def test_tree_fits_its_labels():
    x, y = html_text.labelled_blocks()
    assert (TREE.predict(x) == (y == 1)).mean() > 0.98
    assert sum(map(len, html_text.PAGES)) < 200


def features_asked(tree):
    if tree.left is None:
        return set()
    return {html_text.FEATURES[tree.feature]} | features_asked(tree.left) | features_asked(tree.right)


def test_words_and_links_decide():
    assert {"words", "links", "words_before", "links_before", "words_after", "links_after"} <= features_asked(TREE)
    assert TREE.feature < html_text.HINTS


def words(n):
    return " ".join(["word"] * n)


MENU = "<div><a href=a>One</a></div><div><a href=b>Two three</a></div><div><a href=c>Four</a></div>"
BODY = f"<div>A heading of words</div><div>{words(40)}</div><div>{words(70)}</div><div>{words(12)}</div><div>{words(55)}</div>"
FOOT = "<div><a href=x>About</a></div><div><a href=y>Contact us</a></div>"


@pytest.mark.parametrize("wrap", ["{}", "<form>{}</form>", "<div class='layout sidebar-left'>{}</div>", "<html><body class=nav>{}</body></html>"])
def test_neutral_tags(wrap):
    """Only div elements, alone or within one whose name hints at something else: the page is read by words and links."""
    page = wrap.format(MENU + BODY + FOOT)
    assert text_of(page) == "\n\n".join(["A heading of words", words(40), words(70), words(12), words(55)])


def test_a_form_around_an_article():
    page = f"<form><article><h1>Title here</h1><p>{words(30)}</p><p>{words(50)}</p></article></form>"
    assert text_of(page) == f"Title here\n\n{words(30)}\n\n{words(50)}"


@pytest.mark.parametrize(
    ("page", "wanted"),
    [
        ("", ""),
        ("<p>", ""),
        ("<article><h1>Title</h1><p>One &amp; two&nbsp; <b>three</b><br>four<p>Five.</article>", "Title\n\nOne & two three four\n\nFive."),
        ("<nav><a href=x>Home</a></nav><article><p>Text</p></article><footer>&copy; Us</footer>", "Text"),
        ("<article><p>Text</p><aside>Side words</aside><p>More</p><div class='reader-comments'><p>I disagree entirely.</p></div></article>", "Text\n\nMore"),
        ("<article><header><p>By us</p></header><p>Body</p><form><p>Name</p><button>Go</button></form></article>", "Body"),
        ("<article><script>var a = '</p><p>no';</script><style>p{}</style><p>Yes</p><!-- <p>no</p> --></article>", "Yes"),
        ("<article><p>a < b and <i>c</i>d</p><p>5 &lt; 6 &#x41;&#66; &bogus; &am</p></article>", "a < b and cd\n\n5 < 6 AB &bogus; &am"),
        ("<div class=ad>Buy now</div><main><p>Kept</p><div id=\"cookieNotice\">We use cookies</div></main>", "Kept"),
        ("<article><p>Cut off in the mid", "Cut off in the mid"),
        ("<article><p><b>Bold.<br><p>Next.</p><p><b>Bold again.<br><p>Last.</p></article><footer>No</footer>", "Bold.\n\nNext.\n\nBold again.\n\nLast."),
        ("<article><p title=it's>don't stop</p><p data-x='a>b' class=\"x\">Go</p></article>", "don't stop\n\nGo"),
        ("<ARTICLE><P HIDDEN>no</P><P>yes</P><SCRIPT>x</SCRIPT></ARTICLE><script>never closed <p>no", "yes"),
        ("<div><a href=a>One</a></div><div><a href=b>Two</a></div><p>" + "word " * 40 + "</p><div><a href=c>Three</a></div>", ("word " * 40).strip()),
    ],
)
def test_pages(page, wanted):
    assert text_of(page) == wanted


def plain_reading(page):
    """The article element of the given pages, cut at its headings and paragraphs."""
    body = re.search(r"<article>(.*?)</article>", page, re.DOTALL)[1]
    blocks = re.split(r"</?(?:h1|p)>", body)
    texts = [" ".join(html.unescape(re.sub(r"</?(?:b|br)>", " ", b)).split()) for b in blocks]
    return "\n\n".join(t for t in texts if t)


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r for r in html_text.op2(spark, "/root/testdata/sf0.01").collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        assert got[r["page_id"]]["text"] == plain_reading(r["html"])
        assert got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"]) and got[r["page_id"]]["url"] == r["url"]


def test_given_pages_without_hints(spark):
    """With the hints of tags and names taken away nearly all blocks are still told apart."""
    right = total = 0
    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect():
        blocks = html_text.blocks_of(r["html"])
        x = html_text.features_of(blocks)
        label = np.array([b.inside and not b.apart for b in blocks])
        right += (TREE.predict(html_text.neutral(x)) == label).sum()
        total += len(label)
    assert right / total > 0.95


def test_odd_rows(spark):
    long = "<article>" + "<p>some words here</p>" * 20_000 + "</article>"
    rows = [(1, None, None), (2, "u", ""), (2, "u", ""), (None, "v", "<article><p>x</p></article>"), (5, "w", long), (6, "w", "<" * 3000), (7, "z", "<p " * 2000)]
    got = html_text.extract(spark.createDataFrame([(*r, 9) for r in rows], "page_id long, url string, html string, text int"), TREE).collect()
    assert [r["text"] for r in got[:4]] == ["", "", "", "x"] and got[4]["n_chars"] == 20_000 * 15 + 2 * 19_999
    assert len(got) == 7
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_text.extract(empty, TREE).count() == 0
