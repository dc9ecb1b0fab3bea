import html
import math
import re
import time

import pytest

from marquee.llm import html_text

PARA = "This is a long enough paragraph of plain article text to be taken for content by its density."


def test_article_of_every_page(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    raw = {r.page_id: r for r in pages.collect()}
    for r in html_text.extract_pages(pages).collect():
        body = re.search(r"(?s)<article>(.*?)(</article>|$)", raw[r.page_id].html)[1]
        body = re.sub(r"<[^>]*$", "", body).replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        assert r.text == "\n\n".join(b for b in blocks if b)
        assert (r.url, r.n_chars) == (raw[r.page_id].url, len(r.text))


@pytest.mark.parametrize("noise", [
    "<nav><ul><li><a href=/>Home</a><li><a href=/>More</a></ul></nav>", f"<header><p>{PARA}</p></header>",
    f"<footer><p>{PARA}</p></footer>", f"<aside><p>{PARA}</p></aside>", f"<form><p>{PARA}</p><input></form>",
    f"<script>var a = '<p>{PARA}</p>';</script>", "<style>p { color: red }</style>", f"<!-- <p>{PARA}</p> -->",
    f"<div class='cookie-notice'><p>{PARA}</p></div>", f"<div id=sidebar><p>{PARA}</p></div>",
    f"<section class='user-comments'><p>{PARA}</p><p>{PARA}</p></section>", f"<div class=adBanner><p>{PARA}</p></div>",
    f"<div role=navigation><p>{PARA}</p></div>", f"<p hidden>{PARA}</p>", f"<div style='display: none'>{PARA}</div>"])
@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_what_is_not_the_article_is_left_out(noise, tag):
    page = f"<body>{noise}<{tag}><h1>Title</h1><p>{PARA}</p><p>Short.</p><p>{PARA} 2</p></{tag}>{noise}</body>"
    assert html_text.main_text(page) == f"Title\n\n{PARA}\n\nShort.\n\n{PARA} 2"


@pytest.mark.parametrize("wrap", [
    "<div class='content has-sidebar'>{}</div>", "<div class='no-sidebar'>{}</div>", "<div class=comments-open>{}</div>",
    "<div class='sharing-enabled'>{}</div>", "<div id=social-page>{}</div>", "<form id=aspnet>{}</form>",
    "<form><div class='widget content'><div>{}</div></div></form>"])
@pytest.mark.parametrize("inside", ["{}", "<div>{}</div>"])
def test_blocks_that_hold_the_article_are_kept_whatever_their_class(wrap, inside):
    noise = f"<div class=sidebar><p>{PARA}</p></div><form><p>{PARA}</p></form>"
    body = f"<h1>Title</h1><p>{PARA}</p><p>Short.</p><p>{PARA} 2</p><p>{PARA} <b>3</b></p>"
    want = f"Title\n\n{PARA}\n\nShort.\n\n{PARA} 2\n\n{PARA} 3"
    assert html_text.main_text(f"<body>{wrap.format(inside.format(body))}{noise}</body>") == want
    if "form" not in wrap:
        assert html_text.main_text(f"<body>{wrap.format(inside.format(noise + body))}</body>") == want


def test_long_comments_beside_an_article_stay_out():
    page = f"<body><article><p>{PARA}</p></article><div class=comments>{f'<p>{PARA} 2</p>' * 9}</div></body>"
    assert html_text.main_text(page) == PARA


def brute_densities(node, ratio):
    """Every node's density from its own text, tags and links, counted anew for each."""
    chars = tags = link_chars = link_tags = 0
    stack = [(c, node.tag == "a") for c in node.children]
    if node.tag == "a":
        link_tags = 1
    while stack:
        at, linked = stack.pop()
        if isinstance(at, str):
            n = len("".join(at.split()))
            chars, link_chars = chars + n, link_chars + n * linked
        elif not at.noise:
            linked = linked or at.tag == "a"
            tags, link_tags = tags + 1, link_tags + linked
            stack += [(c, linked) for c in at.children]
    if ratio is None:
        return link_chars / chars if chars else 0.0
    if not chars:
        return 0.0
    base = math.log(chars / max(1, chars - link_chars) * max(1, link_chars) + ratio * chars + math.e)
    inner = chars / max(1, link_chars) * max(1, tags) / max(1, link_tags)
    return max(0.0, chars / max(1, tags) * math.log(max(inner, 1.0000001)) / math.log(max(base, 1.0000001)))


def test_densities_against_counting_each_node_anew(spark):
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").limit(12).collect()]
    for page in [*pages, f"<div>{PARA}<a href=x>link <b>bold</b></a><p>{PARA}</div><p>x"]:
        nodes = html_text.parsed(page)
        html_text.densities(nodes)
        ratio = brute_densities(nodes[0], None)
        for node in (n for n in nodes if not n.noise):
            assert abs(node.density - brute_densities(node, ratio)) < 1e-9
            assert abs(node.total - sum(brute_densities(c, ratio) for c in node.children
                                        if not isinstance(c, str) and not c.noise)) < 1e-6


@pytest.mark.parametrize("page", [
    "<div>" * 100_000 + "deep", "</b>" * 100_000 + "deep", "<div>" * 50_000 + "</i>" * 50_000 + "deep",
    "<p><button>" + "<div>" * 100_000 + "deep", "<ul>" + "<li><ul>" * 50_000 + "deep", "<p>" * 100_000 + "deep",
    "<table>" + "<tr><td><b>" * 33_000 + "deep", "<a><" * 100_000 + "<b>deep"])
def test_deep_and_stray_tags_take_time_in_proportion(page):
    start = time.perf_counter()
    html_text.main_text(page)
    assert time.perf_counter() - start < 6  # some 100,000 tags; a walk to the root for each would take minutes


def test_a_name_that_speaks_for_the_article_and_comments_without_class_words():
    page = f"<body><div class='post share-wrapper'><p>{PARA}</p><p>{PARA} 2</p></div><div class=related><p>{PARA} 3</p></div></body>"
    assert html_text.main_text(page) == f"{PARA}\n\n{PARA} 2"
    body = f"<h1>Title</h1><p>{PARA}</p><p>{PARA} 2</p><p>{PARA} 3</p>"
    want = f"Title\n\n{PARA}\n\n{PARA} 2\n\n{PARA} 3"
    for comments in (f"<section id=discussion><p>{PARA}</p></section>", f"<section><h3>12 comments</h3><p>{PARA}</p></section>",
                     f"<div><h2>Comments (3)</h2><ul><li>{PARA}</ul></div>", f"<h3>2 Replies</h3><div>{PARA}</div><p>Me too.</p>"):
        assert html_text.main_text(f"<article>{body}{comments}</article>") == want
    assert "Comments on style" in html_text.main_text(f"<article>{body}<h2>Comments on style</h2><p>{PARA}</p></article>")


def test_blocks_references_and_white_space():
    page = (f"<article><p>A&amp;B &#233;&nbsp;x<br>line  two\n three <b>bold</b>er</p><ul><li>one<li>two</ul>"
            f"<blockquote>quoted</blockquote><table><tr><td>1<td>2</table><p>{PARA}<p>end</article>")
    assert html_text.main_text(page) == (
        f"A&B é x line two three bolder\n\none\n\ntwo\n\nquoted\n\n1 2\n\n{PARA}\n\nend")


def test_broken_pages():
    assert html_text.main_text("") == html_text.main_text("<p>") == html_text.main_text("<!-- open") == ""
    assert html_text.main_text("plain <b>text</b> only") == "plain text only"
    assert html_text.main_text(f"<article><p>{PARA}</p><p>cut of<") == f"{PARA}\n\ncut of"
    assert html_text.main_text("<div>" * 5_000 + "deep" + "</div>" * 5_000) == "deep"
    assert html_text.main_text("</p></div>a</b>") == "a"


def test_awkward_rows(awkward, nothing):
    found = html_text.extract_pages(awkward, "doc_id", "source", "text").collect()
    assert len(found) == awkward.count()
    assert {r.text for r in found if r.doc_id in (3, 4, 5)} == {""}
    assert html_text.extract_pages(nothing, "doc_id", "source", "text").count() == 0
