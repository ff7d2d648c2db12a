import html
import re

import pytest

from dealreports.llm import pages

LONG = "The committee met on Tuesday to talk about the bridge, which has been closed since the storm of last winter. "


def text(body, head=""):
    return pages.main_text(f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>")


MENU = "<nav><ul><li><a href='/a'>Home</a><li><a href='/b'>News</a></ul></nav>"


def test_article_among_menus_adverts_and_footers():
    body = (
        f"<header><h2>Site</h2></header>{MENU}<div class='ad'>Buy now</div>"
        f"<article><h1>Bridge</h1><p>{LONG}</p><p>{LONG}</p></article>"
        "<aside>Popular</aside><form><label>Mail</label><input></form><footer>&copy; us</footer>"
    )
    assert text(body, "<title>T</title><style>p{}</style><script>var a='</p>'</script>") == f"Bridge {LONG}{LONG}".strip()


def test_content_in_plain_divisions():
    side = "".join(f"<li><a href='/{i}'>Link number {i}</a></li>" for i in range(15))
    body = (
        f"<div id='wrapper'><div class='top-menu'>{MENU}</div><div id='content'><h1>Bridge</h1>"
        + f"<p>{LONG * 3}</p>" * 6
        + f"</div><div class='sidebar'><ul>{side}</ul></div><div class='footer'>Imprint</div></div>"
    )
    assert text(body) == "Bridge " + " ".join([(LONG * 3).strip()] * 6)


@pytest.mark.parametrize(
    "part",
    [
        "<div class='comments'><p>Great read, thanks a lot for it</p></div>", "<div id='cookie-notice'>We use cookies</div>",
        "<section role='navigation'>Go on</section>", "<div hidden>Not seen</div>", "<div style='display: none'>Not seen</div>",
        "<p aria-hidden='true'>x</p>", "<div class='related posts'>More</div>", "<noscript>Switch it on</noscript>",
        "<!-- a note --><script>document.write('<p>x</p>')</script>", "<template><p>x</p></template>", "<aside>Aside</aside>",
        "<section id='comments'><article class='comment'><p>I was there too</p></article></section>",
        "<article class='related'><p>Read on</p></article>", "<div class='article-footer'>Printed by us</div>",
    ],
)
def test_parts_that_are_not_text(part):
    assert text(f"<article><p>{LONG}</p>{part}<p>{LONG}</p></article>") == f"{LONG}{LONG}".strip()


def test_an_article_has_its_heading():
    body = f"<div class='page-header'>Site</div><header>Top</header><article><header><h1>Bridge</h1></header><div class='entry-header'>By A. B.</div><p>{LONG}</p></article>"
    assert text(body) == f"Bridge By A. B. {LONG}".strip()


def test_formatting_breaks_and_references():
    body = f"<article><p>A <b>bold</b>&nbsp;word&amp;more &lt;tag&gt; &#8364;&#x20AC; caf&eacute;<br>next  line\n{LONG}</p><ul><li>one<li>two</ul></article>"
    assert text(body) == f"A bold word&more <tag> €€ café next line {LONG}one two"


def test_inline_elements_do_not_part_words():
    assert text(f"<article><p>un<i>believ</i>able <span>{LONG}</span></p></article>") == f"unbelievable {LONG}".strip()


@pytest.mark.parametrize(
    "source",
    [
        "<", "<p", "</p>", "<!--", "<!-- x", "<p>a</b></i></p>", "<script>", "<a href='x", "&", "&#;", "&#x110000;", "<p <p <p>x",
        "<![CDATA[x", "<table><tr><td>a<td>b<tr><td>c", "<" * 3000, "<div>" * 5000 + "x", "<a b='" * 2000, "\x00<p>\ud7ff</p>", "<?php x ?>y",
        "<textarea><p>x", "<title>", "<p/>a<br/>b<div/>c",
    ],
)
def test_any_source_gives_a_text(source):
    assert isinstance(pages.main_text(source), str)


def test_open_elements_are_closed():
    tree = pages.parse("<ul><li>a<ul><li>b</ul><li>c</ul><p>x<p>y<div>z</div><table><tr><td>1<td>2<tr><td>3</table>")
    names = lambda n: [c if isinstance(c, str) else (c.name, names(c)) for c in n.children]
    assert names(tree) == [
        ("ul", [("li", ["a", ("ul", [("li", ["b"])])]), ("li", ["c"])]),
        ("p", ["x"]), ("p", ["y"]), ("div", ["z"]),
        ("table", [("tr", [("td", ["1"]), ("td", ["2"])]), ("tr", [("td", ["3"])])]),
    ]


def test_density_sums():
    order = pages.nodes(pages.parse(f"<body><div><p>{LONG}</p><p>{LONG}</p></div><div><a href='x'>go</a></div></body>"))
    body = next(n for n in order if n.name == "body")
    pages._measure(order)
    pages._score(order, body)
    first, second = body.children
    assert (first.chars, first.tags, second.link_chars, second.link_tags) == (2 * len(LONG.replace(" ", "")), 2, 2, 1)
    assert first.total == sum(c.density for c in first.children) > second.total
    assert first.density > second.density


def expected(source):
    """The article of a page of the test tables, cut out by its own tags."""
    inside = re.search(r"<article>(.*?)(</article>|<footer>|\Z)", source, re.DOTALL)[1]
    parts = (html.unescape(re.sub(r"<[^>]*>?", "", b)).split() for b in re.split(r"</?(?:p|h\d|br)>", inside))
    return " ".join(" ".join(p) for p in parts if p)


def test_pages_of_the_tables(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/pages.parquet")
    sources = {r["page_id"]: r for r in table.collect()}
    found = pages.with_main_text(table).collect()
    assert len(found) == len(sources)
    assert all((r["url"], r["text"]) == (sources[r["page_id"]]["url"], expected(sources[r["page_id"]]["html"])) for r in found)
    assert all(r["n_chars"] == len(r["text"]) for r in found)


def test_odd_rows(spark, clashing):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>x</p>"), (3, "u", "<p>" + "word " * 100_000), (3, "u", "<p>a")]
    out = pages.with_main_text(clashing(spark.createDataFrame(rows, "page_id long, url string, html string")))
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    found = sorted(((r["page_id"] or 0, r["n_chars"], r["text"][:5]) for r in out.collect()))
    assert found == [(0, 1, "x"), (1, 0, ""), (2, 0, ""), (3, 1, "a"), (3, 499_999, "word ")]
    assert pages.with_main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


PARAGRAPH = f"<p>{LONG * 4}</p>"


def words(body):
    return text(body).split()


def inside(part):
    return html.unescape(re.sub(r"<[^>]*>", " ", part)).split()


@pytest.mark.parametrize(
    "article",
    [
        f"<section>{PARAGRAPH * 12}</section><section>{PARAGRAPH * 10}</section>",
        f"<section>{PARAGRAPH * 5}</section><section>{PARAGRAPH * 4}</section>",
        f"<h1>Bridge</h1><div>{PARAGRAPH * 5}</div>",
        f"<h1>Bridge</h1>{PARAGRAPH * 2}<ul>{'<li>one of the many points of the talk</li>' * 30}</ul>",
        f"<h1>Bridge</h1>{PARAGRAPH * 2}<table>{'<tr><td>May</td><td>12</td></tr>' * 30}</table><p>End</p>",
    ],
)
def test_the_whole_of_an_article(article):
    outside = f"<div><a href='/a'>Home</a> <a href='/b'>News</a></div>{MENU}", "<div>Imprint</div>"
    for tag in ("article", "main"):
        assert words(f"{outside[0]}<div id='wrapper'><{tag}>{article}</{tag}>{outside[1]}</div>") == inside(article)
    assert words(f"{MENU}<div id='content'>{article}</div>") == inside(article)
    assert words(article) == inside(article)


def test_articles_beside_each_other_and_text_of_the_body():
    first, second = f"<article><h2>One</h2>{PARAGRAPH * 9}</article>", f"<article><h2>Two</h2>{PARAGRAPH * 4}</article>"
    assert words(f"<div><h1>Both</h1>{first}{second}</div>") == ["Both", *inside(first + second)]
    plain = f"{LONG * 5}<br><br>{LONG * 4}"
    assert words(f"{plain}<div class='x'><p>A short note</p></div>") == [*inside(plain), "A", "short", "note"]


LINKED = [
    "<h2><a href='/x'>A linked heading</a></h2>", "<p><a href='/x'>Read the whole report</a></p>",
    "<ol><li><a href='/1'>First source</a></li><li><a href='/2'>Second source</a></li></ol>",
    "<table><tr><td><a href='/1'>One</a></td><td><a href='/2'>Two</a></td></tr></table>",
]


@pytest.mark.parametrize("part", LINKED)
def test_link_blocks_of_an_article_stay(part):
    article = f"{PARAGRAPH * 3}{part}{PARAGRAPH * 2}{part}"
    for tag in ("article", "main"):
        assert words(f"{MENU}<div><{tag}>{article}</{tag}></div>") == inside(article)
        assert words(f"<{tag}><section><div>{article}</div></section></{tag}>") == inside(article)


def test_link_blocks_of_plain_divisions():
    menu = "".join(f"<li><a href='/{i}'>Link number {i}</a></li>" for i in range(15))
    article = f"{LINKED[0]}{PARAGRAPH * 3}{LINKED[1]}{PARAGRAPH}{LINKED[3]}"
    assert words(f"<div id='wrapper'><ul>{menu}</ul><div><div><ul>{menu}</ul></div></div><div id='content'>{article}</div></div>") == inside(article)


@pytest.mark.parametrize("names", ["id='content' class='content has-sidebar'", "class='layout with-nav'", "class='page sidebar'", "id='sidebar-left'"])
def test_names_of_what_holds_the_article(names):
    article = f"<h1>Bridge</h1>{PARAGRAPH * 4}"
    side = f"<div class='sidebar'><p>{LONG}</p></div>"
    assert words(f"{MENU}<div {names}><article>{article}</article>{side}</div>{side}") == inside(article)
    assert words(f"{MENU}<div {names}><main>{article}</main></div>") == inside(article)
    assert words(f"{MENU}<div {names}>{article}</div>{side}") == inside(article)
    assert words(f"<form id='page'><div {names}><article>{article}</article>{side}</div></form>") == inside(article)


@pytest.mark.parametrize("name", ["social-history", "share-price", "cookie-recipes", "with-banner"])
def test_names_that_mean_something_else(name):
    article = f"{PARAGRAPH * 3}<section class='{name}'><h2>More</h2>{PARAGRAPH * 2}</section>{PARAGRAPH}"
    assert words(f"{MENU}<article>{article}</article>") == inside(article)


@pytest.mark.parametrize(
    "part",
    [
        f"<div class='comments'><article>{PARAGRAPH * 9}</article></div>", f"<div id='comment-list'>{PARAGRAPH * 9}</div>",
        f"<section class='related-posts'><article class='card'>{PARAGRAPH}</article></section>",
        f"<div class='sidebar-inner'>{PARAGRAPH}</div>", "<div class='share-this'><a href='/s'>Share</a> it</div>",
        f"<div class='cookie-bar'>{PARAGRAPH}</div>", f"<form>{PARAGRAPH}</form>",
    ],
)
def test_named_parts_that_go(part):
    article = f"<article>{PARAGRAPH * 4}</article>"
    assert words(f"{MENU}<div>{article}{part}</div>") == inside(article)
    assert words(f"{MENU}<div class='has-sidebar'>{part}{article}</div>") == inside(article)


def test_a_doubtful_name_of_a_page_that_is_mostly_links():
    article, links = f"<article>{PARAGRAPH}</article>", "<ul><li><a href='/x'>One of the many links of this page</a></li></ul>" * 60
    assert words(f"<div class='nav-open'>{links}{article}</div>") == inside(article)


SAME_PROSE = [
    "class='latest'", "class='disclaimer'", "class='alert alert-info'", "class='adsbygoogle'", "class='adbox'",
    "id='gdpr-overlay'", "id='userComments'", "class='commentlist'", "class='siteFooter'", "class='adSlot'",
]


@pytest.mark.parametrize("name", [*SAME_PROSE, "class='x'", ""])
def test_prose_beside_an_article_goes_whatever_its_name(name):
    article = f"<h1>Bridge</h1>{PARAGRAPH * 2}"
    for part in (f"<div {name}>{PARAGRAPH}</div>", f"<ol {name}><li>{LONG * 4}</li></ol>", f"<section {name}>{PARAGRAPH * 2}</section>"):
        assert words(f"{MENU}<article>{article}</article>{part}") == inside(article)
        assert words(f"{part}<div><h2>Title</h2><main>{article * 3}</main></div>{part}") == ["Title", *inside(article * 3)]


@pytest.mark.parametrize("name", SAME_PROSE)
def test_named_prose_goes_without_an_article_too(name):
    content = f"<h1>Bridge</h1>{PARAGRAPH * 5}"
    for part in (f"<div {name}>{PARAGRAPH}</div>", f"<ol {name}><li>{LONG * 4}</li></ol>"):
        assert words(f"{MENU}<div id='content'>{content}</div>{part}") == inside(content)
        assert words(f"{MENU}{content}{part}") == inside(content)


@pytest.mark.parametrize("name", ["commentlist", "adbox", "userComments", "comment-list", "adsbygoogle"])
def test_comments_and_adverts_within_an_article_go(name):
    assert words(f"<article>{PARAGRAPH * 3}<ol class='{name}'><li>{LONG * 4}</li></ol></article>") == inside(PARAGRAPH * 3)


@pytest.mark.parametrize("name", ["market-share", "marketshare", "oilAlert", "thread", "download", "latest-war", "bread"])
def test_compounds_that_mean_something_else(name):
    article = f"{PARAGRAPH * 3}<section class='{name}'><h2>More</h2>{PARAGRAPH * 2}</section>{PARAGRAPH}"
    assert words(f"{MENU}<article>{article}</article>") == inside(article)
    assert words(f"{MENU}<div id='content'>{article}</div>") == inside(article)


def test_words_of_names():
    cases = {"userComments": "user comments", "commentlist": "comment list", "adbox": "ad box", "HTMLNav": "html nav", "thread": "thread", "pagefooter": "page footer", "x-1": "x", "1": ""}
    assert {k: " ".join(pages._words(k)) for k in cases} == cases
