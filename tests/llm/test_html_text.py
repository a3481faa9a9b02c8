"""Main text of pages."""

import html
import re

import pytest

from tidemart.llm import html_text, queries
from tidemart.llm.text import table

FOLDER = "/root/testdata/sf0.001"
LONG = "This paragraph is long enough to be taken for the text of an article by any measure one may think of."


def test_test_pages(spark):
    pages = {r.page_id: r.html for r in table(spark, FOLDER, "pages").collect()}
    got = queries.text_of_pages(spark, FOLDER).collect()
    assert len(got) == len(pages)
    for row in got:
        article = re.search(r"<article>(.*)</article>", pages[row.page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>|<br>", article)]
        assert row.text == "\n\n".join(b for b in blocks if b)
        assert row.n_chars == len(row.text)


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("   ", ""), ("<p></p>", ""), ("<html><head><title>t</title></head><body></body></html>", ""),
    ("plain &amp; simple", "plain & simple"),
    (f"<p>a  <b>b</b>c\n d</p><p>{LONG}</p>", f"a bc d\n\n{LONG}"),
    (f"<nav><a>menu</a></nav><main><h1>T</h1><p>{LONG}<p>x<br>y</main><footer>f</footer>", f"T\n\n{LONG}\n\nx y"),
    (f"<body class='has-sidebar'><header><h1>Site</h1><p>slogan</p></header><article><header><h2>T</h2><p>by me</p></header>"
     f"<p>{LONG}</p><aside>box</aside><div class='ad-slot'>buy</div></article>", f"T\n\n{LONG}"),
    (f"<div id=wrap><div class=story><h1>T</h1><p>{LONG}</p><p>short</p><ul><li>one<li>two</ul></div>"
     f"<div class='reader-comments'><p>{LONG}</p></div><form><p>{LONG}</p></form></div>", f"T\n\n{LONG}\n\nshort\n\none\n\ntwo"),
    (f"<div role=navigation>m</div><div hidden>h</div><p style='display: none'>n</p><div><p>{LONG}</p></div>", LONG),
    (f"<ul><li><a href=1>first</a><li><a href=2>second</a></ul><p>{LONG}</p><p>{LONG}</p>", f"{LONG}\n\n{LONG}"),
    (f"<article><p>{LONG}</p><script>if (a < b) '<p>no</p>'</script><style>p{{}}</style><!-- no --><p>1 &lt; 2 &copy;&#x41;</article>",
     f"{LONG}\n\n1 < 2 ©A"),
    (f"<table><tr><td>{LONG}<td>cell</table></div></p></b>", f"{LONG}\n\ncell"),
])
def test_pages(page, text):
    assert html_text.main_text(page) == text


def test_every_page_has_a_row(spark, rows):
    df = spark.createDataFrame([(1, None, None, 5), (1, None, None, 5), (None, "u", "<p>x", 6)], "page_id long, url string, html string, text long")
    assert rows(html_text.extract(df)) == [(None, "u", "x", 1), (1, None, "", 0), (1, None, "", 0)]
    assert html_text.extract(df.limit(0)).count() == 0


def test_very_long_and_deep_pages():
    assert len(html_text.main_text("<p>word</p>" * 20_000)) == 6 * 20_000 - 2
    assert html_text.main_text("<div>" * 5000 + LONG) == LONG


@pytest.mark.parametrize("wrap", [
    "<article class='post comments-open'>{}</article>", "<main class='sidebar-right'>{}</main>", "<div class='content has-sidebar'>{}</div>",
    "<div class='legal-news'>{}</div>", "<form id='aspnetForm'>{}</form>", "<div class='page with-header'>{}</div>",
    "<div class='content has-sidebar'><article>{}</article></div><div><p>" + LONG + "</p></div>",
])
def test_names_do_not_lose_the_article(wrap):
    body = f"<h1>T</h1><p>{LONG}</p><p>{LONG}</p><div class='sidebar'>box</div><div id='comments'>nice</div><p>{LONG}</p>"
    got = html_text.main_text(wrap.format(body))
    assert got.startswith(f"T\n\n{LONG}\n\n{LONG}\n\n{LONG}")
    assert "box" not in got and "nice" not in got


def test_names_on_every_block_do_not_lose_the_article():
    page = "".join(f"<div class='builder-widget'><p>{LONG}</p></div>" for _ in range(5)) + "<div class='ad'>buy</div>"
    assert html_text.main_text(page) == "\n\n".join([LONG] * 5)


def test_menus_by_name_stay_aside():
    assert html_text.main_text(f"<div id=menu>{f'<p><a href=1>{LONG}</a></p>' * 9}</div><p>{LONG}</p>") == LONG
    assert html_text.main_text(f"<article><p>few words</p></article><div id=comments><p>{LONG}</p></div>") == "few words"


def many(count, mark="P"):
    return "".join(f"<p>{mark}{k} {LONG}</p>" for k in range(count))


@pytest.mark.parametrize("page", [
    f"<div class=post><h1>Title</h1><p>lead</p><div class=entry>{many(6)}</div></div>",
    f"<div class=post><h2>Title</h2><div class=entry>{many(6)}</div></div>",
    f"<div><div>{many(17)}</div><div>{many(3, 'Q')}</div></div>",
    f"<div>{many(1)}<div>{many(5, 'Q')}<div>{many(30, 'R')}</div></div></div>",
    f"<main><article>{many(6)}</article><section>{many(4, 'Q')}</section></main>",
    f"<article>{many(6)}</article><article>{many(4, 'Q')}</article>",
    f"<article>{many(6)}</article><div>{many(4, 'Q')}</div>",
    f"<main><h1>Title</h1><div role=main><article>{many(6)}</article></div><p>end</p></main>",
])
def test_regions_lose_nothing(page):
    blocks = re.findall(r"<(?:p|h1|h2)>(.*?)</", page)
    menu = "<div><a href=1>one</a></div><div><a href=2>two</a></div>"
    assert html_text.main_text(page) == html_text.main_text(f"<nav>{menu}</nav>{page}<footer>f</footer>") == "\n\n".join(blocks)


def test_unnamed_menus_beside_the_region_go():
    menu = "".join(f"<li><a href={k}>item</a></li>" for k in range(9))
    assert html_text.main_text(f"<ul>{menu}</ul><div><h1>T</h1>{many(5)}</div><ul>{menu}</ul>") == html_text.main_text(f"<div><h1>T</h1>{many(5)}</div>")


STORY = f"<h1>Title</h1>{many(6)}"
BODY = html_text.main_text(f"<article>{STORY}</article>")


def notes(count, holder="<div>{}</div>"):
    return "".join(holder.format(f"<p>N{k} {LONG} {LONG}</p>") for k in range(count))


@pytest.mark.parametrize("page", [
    # comments as articles, beside the story, without and with a telling holder
    f"<main><article>{STORY}</article></main><section>{notes(5, '<article class=comment>{}</article>')}</section>",
    f"<main>{STORY}</main><section>{notes(1, '<article class=comment>{}</article>')}</section>",
    f"<main>{STORY}</main><section class=comments>{notes(12, '<article>{}</article>')}</section>",
    # ... and inside it
    f"<main><article>{STORY}<section>{notes(5, '<article>{}</article>')}</section></article></main>",
    f"<article>{STORY}<section><h2>12 Comments</h2>{notes(12)}</section></article>",
    f"<article>{STORY}<ol class=commentlist>{notes(12, '<li id=comment-7>{}</li>')}</ol></article>",
    f"<article>{STORY}<div id=comments><h3>Leave a comment</h3>{notes(9)}</div></article>",
    # pages without an article element
    f"<div class=post>{STORY}</div><div class='post-comments'>{notes(12)}</div>",
    f"<div class=post>{STORY}<div class='c comments__list'>{notes(12)}</div></div>",
    f"<div class=post>{STORY}</div><div class=below><h3>Comments (3)</h3>{notes(7)}</div>",
    f"<form id=aspnetForm><div>{STORY}</div><div id=comments>{notes(7)}</div></form>",
    f"<div id=wrap><div class=notice><p>{LONG}</p></div><div>{STORY}</div><ul class=comment-list>{notes(9, '<li>{}</li>')}</ul></div>",
    # discussions
    f"<article>{STORY}</article><div class=discussion>{notes(1)}</div>",
    f"<article>{STORY}</article><div class=discussion>{notes(2)}</div>",
    f"<main>{STORY}</main><div id=thread-4>{notes(9)}</div>",
    # teasers
    f"<main><article>{STORY}</article>{notes(1, '<article class=teaser><h3>Other</h3><p>Short</p></article>')}</main>",
    f"<article>{STORY}</article>" + 4 * f"<article><h3><a href=x>Other story</a></h3><p>{LONG}</p></article>",
    f"<main><article>{STORY}</article>" + 3 * f"<article><h3>Other story</h3><p>{LONG}</p></article>" + "</main>",
    f"<main><div>{STORY}</div>" + 3 * f"<article><h3>Other story</h3><p>{LONG}</p></article>" + "</main>",
    f"<article>{STORY}<article class=card><a href=x>Read also</a><p>{LONG}</p></article></article>",
    # nothing to set aside
    f"<article><article>{STORY}</article></article>",
    f"<article class='post comments-open'>{STORY}</article>",
    f"<div class=comments-enabled>{STORY}</div>",
    f"<div class=commentary>{STORY}</div>",
    f"<div class=comments>{STORY}</div>",
    f"<article><div itemprop=articleBody>{STORY}</div></article>",
])
def test_comments_discussions_and_teasers(page):
    menu = "<ul><li><a href=1>one</a><li><a href=2>two</a></ul>"
    assert html_text.main_text(f"<header>{menu}</header>{page}<footer>f</footer>") == BODY


@pytest.mark.parametrize("page", [
    f"<article><h1>T</h1>{many(3)}<section id=discussion><h2>Discussion</h2>{many(4, 'Q')}</section></article>",
    f"<div><h1>T</h1>{many(3)}<section id=discussion><h2>Discussion</h2>{many(4, 'Q')}</section></div>",
    f"<main><article>{many(3)}</article><article>{many(2, 'Q')}</article><article>{many(2, 'R')}</article></main>",
    f"<article>{many(9)}</article><article><p>{LONG}</p></article>",
    f"<article><h1>T</h1><article>{many(3)}</article><article>{many(4, 'Q')}</article></article>",
    f"<div id=comments><h1>T</h1>{notes(3)}</div>",
])
def test_chapters_and_parts_stay(page):
    blocks = re.findall(r"<(?:p|h1|h2)>(.*?)</", page)
    assert html_text.main_text(page) == "\n\n".join(blocks)
