from __future__ import annotations

import html
import re

import numpy as np
import pytest

from hazardgrid.llm.html_extraction import extract_main_text, main_text, page_lines, smoothed, threshold

from .helpers import clashing, rows


@pytest.mark.parametrize(("page", "text"), [
    ("", ""),
    ("plain  words", "plain words"),
    ("<p>a<p>b &amp; c<br>d", "a\nb & c d"),
    ("<article><h1>T</h1><p>a\n\t b</p><p> </p><ul><li>x<li>y</ul></article>", "T\na b\nx\ny"),
    ("<nav><ul><li>m</ul></nav><article><p>text</article><footer>f</footer>", "text"),
    ("<nav><p>left open<article><p>text</p></article>", "text"),
    ("<article><p>a</p><aside>s</aside><div class='comments'><p>c</p></div><form><input>q</form><p>b</p></article>", "a\nb"),
    ("<article><p>a<script>if (1<2) '</p>'</script><style>p{}</style>b</p></article>", "ab"),
    ("<article><p><b>bold and <i>more</b> rest</p><p>next</article>", "bold and more rest\nnext"),
    ("<article><p>&#65;&#x42;&lt;i&gt;&nbsp;&copy &unknown; &am</article>", "AB<i> © &unknown; &am"),
    ("<div class=\"cookie-notice\">We use cookies</div><div><p>The text itself.</p></div>", "The text itself."),
    ("<main><header><h1>Title</h1></header><p>x</p></main>", "Title\nx"),
    ("<header>site</header><p>body text</p>", "body text"),
    ("<p>a<!-- no --><span hidden>h</span> b</p>", "a b"),
    ("<table><tr><td>one<td>two<tr><td>three</table>", "one\ntwo\nthree"),
])
def test_pages(page, text):
    assert main_text(page) == text


def test_regions_without_articles():
    words = "Some longer sentence of the text, with words. " * 6
    links = "".join(f"<a href=/{i}>l{i}</a> " for i in range(12))
    page = f"<body><div><p>{links}</p></div><div><p>{words}</p><p>Short.</p><p>{words}</p></div><div><p>{links}</p></div></body>"
    assert main_text(page) == f"{words.strip()}\nShort.\n{words.strip()}"


STORY = "A long sentence of the story, with words and more words. " * 8
LINKS = "<ul>" + "".join(f"<li><a href=/{i}>Another page {i}</a></li>" for i in range(9)) + "</ul>"


@pytest.mark.parametrize(("page", "text"), [
    # Stories outside article and main, beside cards and teasers.
    (f"<div><p>{STORY}</p><p>Short.</p><p>{STORY}</p></div><article><h2><a href=/a>Card</a></h2></article><article><h2><a href=/b>Card</a></h2></article>", [STORY, "Short.", STORY]),
    (f"<main><p>A teaser of the page.</p></main>{LINKS}<div><p>{STORY}</p><p>{STORY}</p></div>", ["A teaser of the page.", STORY, STORY]),
    # Class words and marked elements around stories.
    (f"<div class='social-history'><p>{STORY}</p><p>Short.</p><p>{STORY}</p></div><div class=ad>Buy this</div>", [STORY, "Short.", STORY]),
    (f"<article><p>{STORY}</p><div id='notice'><p>{STORY}</p></div><div class='share'>{LINKS}</div></article>", [STORY]),
    (f"<form id=aspnet><nav>{LINKS}</nav><div><p>{STORY}</p><p>Short.</p></div><div class=ad>Buy this</div></form>", [STORY, "Short."]),
    (f"<aside><p>{STORY}</p><p>{STORY}</p></aside><footer>The site, since 1999.</footer>", []),
    (f"<p>One <span class=popup>{STORY}</span> two <span class=share>Share this</span></p>", ["One two"]),
    (f"<span class=widget><div><p>{STORY}</p><p>Short.</p></div></span>", [STORY, "Short."]),
    # Low ratios and links inside an article without a word that marks them, and hidden text.
    (f"<article><p>{STORY}</p><p>End.</p><div>{LINKS}</div></article>", [STORY, "End."]),
    (f"<article><p>{STORY}</p></article><div hidden><p>{STORY}</p></div>", [STORY]),
    (f"<article><p>{STORY}</p></article><div class=menu><p><a href=/x>{STORY}</a></p></div>", [STORY]),
])
def test_ratio_decides(page, text):
    assert main_text(page) == "\n".join(t.strip() for t in text)


TALE, NOTE = "The article tells a tale. " * 14, "What a reader, a firm or a lawyer has to say. " * 9


@pytest.mark.parametrize("beside", [
    f"<section class='comments'><p>{NOTE}</p><p>{NOTE}</p></section>", f"<footer><p>{NOTE}</p></footer>", f"<aside class=advert><p>{NOTE}</p></aside>",
    f"<form><p>{NOTE}</p></form>", f"<div class='cookie-notice'><p>{NOTE}</p></div>", f"<div id=sidebar><p>{NOTE}</p></div>",
])
def test_marked_text_stays_out_at_any_length(beside):
    for body in (f"<article><p>{TALE}</p><p>{TALE}</p><p>{TALE}</p></article>{beside}", f"<article><p>{TALE}</p>{beside}<p>{TALE}</p><p>{TALE}</p></article>",
                 f"{beside}<div><p>{TALE}</p><p>{TALE}</p><p>{TALE}</p></div>"):
        assert main_text(f"<html><body>{body}</body></html>") == "\n".join([TALE.strip()] * 3)


@pytest.mark.parametrize("wrapper", ["div class='page no-sidebar'", "div class='layout without-ads'", "div class='has-sidebar'", "div class='related-free notice'", "div class='widget'", "form id=page"])
def test_short_text_in_a_wrapper_stays(wrapper):
    words = "A short article of some seventy characters, no more, no less, and that is it."
    end = wrapper.split()[0]
    for open_, close in (("<body>", "</body>"), ("<main>", "</main>")):
        assert main_text(f"{open_}<{wrapper}><h1>Title</h1><p>{words}</p><footer>Since 1999</footer></{end}>{close}") == f"Title\n{words}"


def test_nothing_but_comments_is_no_text():
    assert main_text(f"<div class=comments><p>{NOTE}</p></div><footer>Since 1999</footer>") == ""


def test_many_open_elements():
    page = "<div class=widget>" * 2000 + f"<p>{STORY}</p>" + "<span class=ad><div>x" * 300
    assert STORY.strip() in main_text(page)


def test_broken_markup_ends():
    for page in ("<" * 3000, "<a " * 1500, "<!--" + "x" * 1000, "<p>" * 4000 + "x", "<b>" * 3000 + "x", "</div>" * 3000 + "y", "<![CDATA[ x", "<?php x", "&" * 2000):
        assert isinstance(main_text(page), str)


def test_pieces_change_nothing():
    page = "<article><h1>A&amp;B</h1>" + "<p>one &lt; two <i>three</i></p>" * 50 + "</article>"
    assert page_lines(page, 7) == page_lines(page)


def test_smoothing_and_threshold():
    flat = np.full(9, 4.0)
    assert smoothed(flat, 1.0) == pytest.approx(flat)
    assert 2 < threshold(np.array([1.0, 2, 1, 40, 45, 50])) < 40
    assert threshold(np.array([3.0])) == 3
    assert smoothed(np.array([5.0]), 2.0) == pytest.approx([5.0])


def test_whole_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = {r["page_id"]: r["text"] for r in extract_main_text(pages).collect()}
    for r in pages.collect():
        article = r["html"][r["html"].index("<article>") + 9 : r["html"].rindex("</article>")]
        blocks = re.split(r"</?(?:p|h1)>", re.sub(r"<br>", " ", re.sub(r"</?b>", "", article)))
        blocks = [re.sub(r"[\x20\x09-\x0d]+", " ", html.unescape(b)).strip(" ") for b in blocks]
        assert found[r["page_id"]] == "\n".join(b for b in blocks if b)


def test_cases(spark):
    pages = [(1, "u", None), (1, "u", None), (None, None, ""), (3, "u", "<article>" + "<p>word</p>" * 20000)]
    df = clashing(spark.createDataFrame(pages, "page_id long, url string, html string"))
    got = sorted((r["page_id"] or 0, r["text"]) for r in extract_main_text(df).collect())
    assert got == [(0, ""), (1, ""), (1, ""), (3, "\n".join(["word"] * 20000))]
    assert rows(extract_main_text(df.limit(0))) == []
