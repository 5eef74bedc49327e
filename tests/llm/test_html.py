import random
import time

import pytest

from barloom.llm.html import extract, main_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head>
<body><header><h1>Site</h1></header><nav><ul><li><a href="/a">A, b, c, d</a></li></ul></nav>
<div class="ad">Buy, buy, buy, buy, buy, now.</div><div id="cookie-notice">We use cookies, many, many.</div>
<div class="page"><article><h1>Head &amp; line</h1><p>First <b>para</b>graph, long enough, with commas &lt;x&gt;.</p>
<p>Short.</p><ul><li>one<li>two</ul><form><p>Your name, please, now</p><input></form>
<section class="comments"><p>A comment, by a reader, at length, at length, at length.</p></section></article></div>
<aside>Side, bar, text.</aside><footer>&copy; 2020, all, rights</footer></body></html>"""


def test_article():
    assert main_text(PAGE) == "Head & line\nFirst paragraph, long enough, with commas <x>.\nShort.\none\ntwo"


@pytest.mark.parametrize(
    "html, text",
    [
        ("", ""),
        ("plain  text", "plain text"),
        ("<p>a<p>b", "a\nb"),
        ("<div>a<br>b</div>", "a b"),
        ("<div>a&nbsp;&#65;&eacute;&amp;lt;</div>", "a Aé&lt;"),
        ("<!-- x <p>no</p>", ""),
        ("<p>a<!-- <p>no</p> -->b</p>", "ab"),
        ("<script>x</p><p>no", ""),
        ("<div hidden>no</div><div>yes</div>", "yes"),
        ("<div role=navigation>no</div><div style='display: none'>no</div><p>yes</p>", "yes"),
        ("a < b and c > d", "a < b and c > d"),
        ("<div><p>x</p></div></span></b></div><p>y", "x\ny"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
        ('<p title="a > b">x</p>', "x"),
        ("<body><div class=comments><p>long, long, long, with, commas, and, more</p></div><div><p>Short.</p></div>", "Short."),
    ],
)
def test_cases(html, text):
    assert main_text(html) == text


BODY = "<h1>Title</h1><p>The first paragraph, of some length, with commas.</p><p>The second one, which is as long, or longer.</p>"
TEXT = "Title\nThe first paragraph, of some length, with commas.\nThe second one, which is as long, or longer."
REST = '<div class=sidebar><p>Side text, short.</p></div><div class="comment-list"><p>A comment, of a reader, here.</p></div>'


@pytest.mark.parametrize(
    "wrapper",
    [
        "<div class='site has-sidebar'>", "<div class=no-sidebar>", "<div class=hasSidebar>", "<div class='post comments-open'>",
        "<div class='hidden-xs'>", "<div class='social-post'>", "<form action=x>", "<form><div class=layout-with-nav>", "<div class=overlay>",
    ],
)
def test_wrappers_do_not_cut_the_article(wrapper):
    end = "</form>" if wrapper.startswith("<form") else "</div>"
    assert main_text(f"<body>{wrapper}<article>{BODY}</article>{REST}{end}</body>") == TEXT
    assert main_text(f"<body>{wrapper}<div>{BODY}</div>{REST}{end}</body>") == TEXT


def test_an_article_in_a_named_wrapper_outweighs_what_is_left_outside():
    assert main_text(f"<body><div class=comments><article>{BODY}</article></div><p>Left over.</p></body>") == TEXT
    # comments that are articles themselves stay cut
    comments = "<div id=comments>" + "<article class=comment-body><p>A comment, by a reader, at length, here.</p></article>" * 9 + "</div>"
    assert main_text(f"<body><div>{BODY}</div>{comments}</body>") == TEXT
    assert main_text(f"<body><article>{BODY}</article>{comments.replace(' class=comment-body', '')}</body>") == TEXT


LONG = "<p>" + "A sentence, of some words, that goes on, and on. " * 8 + "</p>"
SECTIONS = [
    ("<div class=post><h1>Head</h1><div class=entry>{0}{0}</div></div>", "Head {0} {0}"),
    ("<div class=page><h1>Head</h1><div class=post><h2>Sub</h2><div class=entry>{0}</div></div></div>", "Head Sub {0}"),
    ("<div><h1>Head</h1><div>{0}{0}{0}</div><h2>Two</h2><div><p>Short.</p><p>And short.</p></div><ul><li>one</li></ul><div>{0}</div></div>",
     "Head {0} {0} {0} Two Short. And short. one {0}"),
    ("<div><div class=s><h2>One</h2><div>{0}{0}{0}</div></div><div class=s><h2>Two</h2><p>Short, one.</p><p>Short two</p></div></div>",
     "One {0} {0} {0} Two Short, one. Short two"),
    ("<div>Lead text here.<div>{0}</div></div>", "Lead text here. {0}"),
    ("<div><div>{0}{0}</div><div><p>An end, in short.</p></div></div>", "{0} {0} An end, in short."),
]


@pytest.mark.parametrize("html, text", SECTIONS)
def test_pages_of_divs_keep_their_headings_lists_and_sections(html, text):
    menu = "<div><ul><li><a href=a>Home</a></li><li><a href=b>News, here</a></li></ul></div>"
    got = main_text(f"<body>{menu}{html.format(LONG)}{menu}<div class=footer>All rights.</div></body>")
    assert " ".join(got.split()) == " ".join(text.format(LONG[3:-4]).split())


@pytest.mark.parametrize(
    "part, kept",
    [
        ('<p class="ad">Buy now</p>', ""),
        ('<p class="cookie-notice">We use cookies</p>', ""),
        ('<p class="user-comment">First!</p>', ""),
        ('<p class="share-price">Up.</p>', "Up."),
        ('<div class="share-price">Share price rose.</div>', "Share price rose."),
        ('<div class="alert-level">High.</div>', "High."),
        ('<blockquote class="comment-quote">No comment.</blockquote>', "No comment."),
        ('<div id="nav-history-section"><p>Of ships.</p></div>', "Of ships."),
        ('<div class="share-price"><a href="/">a</a> <a href="/b">b</a></div>', ""),
        ('<div class="ad-slot">Buy now</div>', ""),
        ('<div class="article-share">Tell a friend</div>', ""),
        ('<div class="reader-comments"><p>First!</p></div>', ""),
    ],
)
def test_names_inside_the_article(part, kept):
    page = f"<body><article><p>One long line, with commas.</p>{part}<p>Another, as long as that.</p></article></body>"
    assert main_text(page).split("\n") == ["One long line, with commas.", *filter(None, [kept]), "Another, as long as that."]
    # outside the run of text, a name that only holds a cut word cuts
    if part.startswith("<div") and "nav-" in part:
        page = f"<body><article><p>One long line, with commas.</p>{part}</article></body>"
        assert main_text(page) == "One long line, with commas."


def built_page(rng):
    """(html, text) of a page made from a tree whose article blocks are known as they are written."""
    lines = []

    def words(least, most):
        return " ".join(rng.choice(["alpha", "beta,", "gamma", "delta.", "été", "R&D", "x<y", "so,"]) for _ in range(rng.randint(least, most)))

    def written(text):
        text = text.replace("&", "&amp;").replace("<", rng.choice(["&lt;", "&#60;"]))
        return text.replace(" ", rng.choice([" ", "\n  "])).replace("é", rng.choice(["é", "&eacute;"]))

    def block(tag, least, most):
        text = words(least, most)
        lines.append(text)
        inner = written(text)
        if rng.random() < 0.3:
            inner = f"<b>{inner}</b>"
        return f"<{tag}>{inner}</{tag}>" if tag != "p" or rng.random() < 0.7 else f"<p>{inner}"

    def noise():
        text = written(words(3, 30))
        return rng.choice([
            f"<nav><ul><li><a href=/>{text}</a></ul></nav>", f"<div class='ad'>{text}</div>", f"<p class=advert>{text}</p>",
            f"<aside>{text}</aside>", f"<form><p>{text}</p></form>", f"<script>{text}</script>", f"<div id=cookie-notice><p>{text}</p></div>",
            f"<section class='comments'><p>{text}</p></section>", f"<footer>{text}</footer>", f"<!-- {text} -->", f"<div hidden>{text}</div>",
        ])

    def part(depth):
        kind = rng.randrange(7 if depth else 5)
        if kind < 2:
            return block("p", 5, 60)
        if kind == 2:
            return block(rng.choice(["h2", "blockquote"]), 2, 12)
        if kind == 3:
            return "<ul>" + "".join(block("li", 1, 8) for _ in range(rng.randint(1, 4))) + "</ul>"
        if kind == 4:
            return noise()
        inner = "".join(part(depth - 1) for _ in range(rng.randint(1, 4)))
        return rng.choice(["<div>{}</div>", "<section>{}</section>", "<div class=share-price-table>{}</div>"]).format(inner)

    inner = block("h1", 2, 8) + block("p", 20, 60) + "".join(part(3) for _ in range(rng.randint(1, 8))) + block("p", 20, 60)
    outside = [noise() for _ in range(4)]
    html = f"<html><head><title>t</title></head><body>{outside[0]}<div class=page>{outside[1]}<article>{inner}</article>{outside[2]}</div>{outside[3]}"
    return html, "\n".join(lines)


def test_built_pages():
    rng = random.Random(6)
    for _ in range(400):
        html, text = built_page(rng)
        assert main_text(html) == text, html


def test_link_lists_lose_against_text():
    links = "".join(f"<p><a href=x>link number {i}, with, commas, and, words</a></p>" for i in range(20))
    assert main_text(f"<body><div>{links}</div><div><p>This is the text, of the page, as it is.</p><p>More of it, here.</p></div>") == (
        "This is the text, of the page, as it is.\nMore of it, here."
    )


def test_bad_pages_take_no_long_time():
    start = time.process_time()
    for html in ("<div>" * 50000 + "x", "<p>" * 50000, "<" * 100000, '<a "' * 20000, "<a b='" * 20000, "<!" * 50000, "<li>" * 30000, "&" * 100000):
        main_text(html)
    assert time.process_time() - start < 20


def test_rows(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", ""), (3, "w", "<p>é")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as text", "1 as n_chars")
    got = sorted((tuple(r) for r in extract(df).collect()), key=str)
    body = main_text(PAGE)
    assert got == sorted([(1, "u", body, len(body))] * 2 + [(2, None, "", 0), (None, "v", "", 0), (3, "w", "é", 1)], key=str)
    assert extract(df.limit(0)).count() == 0
