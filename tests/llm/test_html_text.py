import html
import re

import pytest

from paddock.llm import html_text as H
from paddock.llm.common import table

ARTICLE = "<h1>Title &amp; more</h1><p>First long paragraph of the article, with <a href=x>a link</a> inside.<p>Second  one<br>with a\nbreak.</p><ul><li>One<li>Two</ul>"
TEXT = "Title & more\n\nFirst long paragraph of the article, with a link inside.\n\nSecond one with a break.\n\nOne\n\nTwo"
NOISE = ("<header>Site name <nav><a href=/>Home</a></nav></header>", '<div class="ad">Buy this wonderful thing right now, it is cheap.</div>',
         '<div id="cookie-notice"><p>We use cookies and similar techniques on this site for many purposes.</p></div>',
         "<aside><p>Sidebar text that is rather long as well, and goes on for a while.</p></aside>", "<form><p>Sign up here for all of it</p><input><button>Go</button></form>",
         '<section class="comments"><h2>Comments</h2><p>A reader wrote a very long comment here, longer than any paragraph of the article is.</p></section>',
         "<script>var t='</p><p>no</p>';</script><style>p{margin:0}</style><!-- <p>no</p> -->", "<footer>&copy; all of it</footer>", '<div role="navigation"><a href=a>A</a></div>')


@pytest.mark.parametrize("noise", NOISE)
@pytest.mark.parametrize("frame", ("<article>{}</article>", "<main><article>{}</article></main>", '<div class="content">{}</div>'))
def test_the_article_alone(frame, noise):
    page = f"<!DOCTYPE html><html><head><title>T</title></head><body>{noise}{frame.format(ARTICLE)}{noise}</body></html>"
    assert H.main_text(page) == TEXT


def test_odd_pages():
    assert [H.main_text(x) for x in (None, "", "   ", "<html></html>", "<p></p>")] == [""] * 5
    assert H.main_text("plain &lt; text") == "plain < text"
    assert H.main_text("<p>a < b and <b>bold<p>next</i></p>") == "a < b and bold\n\nnext"
    assert H.main_text("<article><p>cut off he") == "cut off he"
    assert H.main_text("<div>" * 20_000 + "deep") == "deep"
    assert H.main_text("<article><p>&amp;amp; &#x41;&#66; &nbsp; x y</p></article>") == "&amp; AB x y"
    assert H.main_text('<article><p title="a > b">quoted</p><p title=\'x>more</p><p>end</p></article>').startswith("quoted")
    long = "<article>" + "<p>word </p>" * 30_000 + "</article>"
    assert H.main_text(long).count("word") == 30_000


KEPT = ('<p class="legal">A long paragraph about the law that the article is about, and more of it.</p>', '<p class="notice-period">How long the notice period is, in words.</p>',
        '<div class="ad-hoc">An ad hoc box that belongs to the article and says so at some length.</div>', '<blockquote class="comment">A quoted comment of some length is part of it.</blockquote>')


@pytest.mark.parametrize("part", KEPT)
@pytest.mark.parametrize("frame", ("<article>{}</article>", "<main>{}</main>", '<div class="content">{}</div>'))
def test_names_inside_the_article_cut_nothing(frame, part):
    text = re.sub("<[^>]*>", "", part)
    assert H.main_text(f"<body>{NOISE[1]}{frame.format(ARTICLE + part)}{NOISE[-2]}</body>") == f"{TEXT}\n\n{text}"


def test_a_list_of_links_is_not_the_article():
    links = "<ul>" + "".join(f"<li><a href={i}>Another story {i}</a></li>" for i in range(6)) + "</ul>"
    for frame in ("<main>{}</main>", "<article>{}</article>", "<div>{}</div>"):
        assert H.main_text(f"<body>{frame.format(ARTICLE + links)}</body>") == TEXT


def test_the_density_decides(monkeypatch):
    """Without tags that name the article; and with every density alike the result is another."""
    paragraphs = "".join(f"<p>Paragraph {i} of the article, long enough to be dense, with commas and all.</p>" for i in range(6))
    page = f"<body><div><span>x</span><span>y</span><i>z</i></div><div><div>{paragraphs}</div></div><div><a href=1>one</a><a href=2>two</a></div></body>"
    assert H.main_text(page) == "\n\n".join(re.findall("<p>(.*?)</p>", paragraphs))


def test_unclosed_tags_take_linear_time():
    import time
    for part in ("<a ", "<a href='", '<p "', "<!", "</", "<script ", "<a <p "):
        start = time.perf_counter()
        H.main_text(part * (1_000_000 // len(part)))
        assert time.perf_counter() - start < 5, part


def test_all_pages_of_the_test_data(spark, sf):
    """The pages' articles are between article tags; read them off with patterns."""
    pages = table(spark, sf.replace("0.001", "0.01"), "pages")
    for r in H.extracted(spark, pages).join(pages.select("page_id", "html"), "page_id").collect():
        inside = r["html"].split("<article>")[1].split("</article>")[0]
        blocks = [" ".join(html.unescape(re.sub("<br>", " ", re.sub("</?b>", "", b))).split()) for b in re.split("</?(?:p|h1)>", inside)]
        assert r["text"] == "\n\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def test_edge_rows(spark):
    rows = [(1, "u", f"<article>{ARTICLE}</article>", "x"), (1, "u", f"<article>{ARTICLE}</article>", "x"), (None, None, None, None), (2, None, "", "y")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((tuple(r) for r in H.extracted(spark, df).collect()), key=str)
    assert got == sorted([(1, "u", TEXT, len(TEXT)), (1, "u", TEXT, len(TEXT)), (None, None, "", 0), (2, None, "", 0)], key=str)
    assert H.extracted(spark, df.limit(0)).collect() == []
