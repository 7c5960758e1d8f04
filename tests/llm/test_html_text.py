import html
import random

import pytest

from changeflow.llm import html_text
from llm_helpers import prose

LONG = prose("en", 60).replace("\n", " ")


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>No</title>{head}</head><body>{body}</body></html>"


def test_article_without_what_is_around():
    body = (
        "<header><h1>Site</h1></header><nav><ul><li><a href='/a'>Home</a></li></ul></nav><div class='cookie-notice'>We use cookies.</div>"
        f"<article><header><h1>Title</h1></header><p>{LONG}<p>Short.<div class='share'>Tweet</div><p>{LONG}</p>"
        f"<aside>Related: {LONG}</aside><p>End.</p><section id=comments><p>{LONG}</p></section></article>"
        f"<form><p>{LONG}</p></form><div class='sidebar'><p>{LONG}</p></div><footer>&copy; {LONG}</footer>"
    )
    assert html_text.main_text(page(body)) == "\n".join(["Title", LONG, "Short.", LONG, "End."])


def test_ambiguous_blocks_take_the_label_of_the_nearest():
    links = "".join(f"<a href='/{i}'>a link {i}</a> " for i in range(9))
    body = f"<div>Near menu</div><div>{links}</div><div>Still menu</div><div>Lead</div><p>{LONG}</p><p>Tail</p>"
    assert html_text.main_text(page(body)) == "\n".join(["Lead", LONG, "Tail"])


def test_markup_references_and_white_space():
    body = (
        "<article><p>a &lt;b&gt; &amp;amp; &#233;&#x20AC; &am</p><!-- <p>no</p> --><script>var t='</p>';</script><p>one<br>two\n\t three<b>four</b>"
        "<style>p{}</style><p>&nbsp;</p><p title='a > b'>five"
    )
    assert html_text.main_text(page(body)) == "\n".join(["a <b> &amp; é€ &am", "one two threefour", "five"])


def test_pages_that_never_end():
    assert html_text.main_text("<article><p>text<script>never") == "text"
    assert html_text.main_text("<article><p>text<!-- never <p>x") == "text"
    assert html_text.main_text("<article><p>text</p><p class='x") == "text"
    assert html_text.main_text("just words") == "just words"
    assert html_text.main_text("</div></p>" * 50 + "<article>" + "<div>" * 3000 + "deep") == "deep"


def test_rows(spark):
    data = [(1, "u", page(f"<article><p>{LONG}</p></article>"), 5), (2, None, None, 5), (None, "u", "", 5), (1, "u", "<script>", 5), (4, "u", "<p>" + "é " * 50_000, 5)]
    pages = spark.createDataFrame(data, "page_id bigint, url string, html string, n_chars int")
    out = html_text.extract(pages).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in out) == [(0, 0), (1, 0), (1, len(LONG)), (2, 0), (4, 99_999)]
    assert all(r.n_chars == len(r.text) for r in out)
    assert html_text.extract(pages.limit(0)).count() == 0


def test_names_of_a_wrapper_are_no_names_of_a_part():
    for wrapper in ('class="page has-sidebar"', 'class="no-sidebar"', 'class="layout-with-nav"', 'class="content ad-free"', 'id="news-widget-page"', "class=content-sidebar-wrap"):
        assert html_text.main_text(page(f"<div {wrapper}><p>{LONG}</p><div class='ad'>{LONG}</div></div>")) == LONG, wrapper
    for part in ("sidebar", "main-nav", "x ad-container-2", "cookie_notice", "related-posts", "comment-list"):
        assert html_text.main_text(page(f"<p>{LONG}</p><div class='{part}'><p>{LONG} no</p></div>")) == LONG, part


def test_articles_lift_names_but_not_tags_and_roles():
    article = f"<article><p>{LONG}</p><div class='sidebar'>{LONG}</div><p>End.</p></article>"
    assert html_text.main_text(page(f"<div class='widget'><p>{LONG}</p>{article}<p>{LONG}</p></div>")) == LONG + "\nEnd."
    assert html_text.main_text(page(f"<div class='widget'><main><p>{LONG}</p></main></div>")) == LONG
    for name in ("nav", "aside", "footer", "div role=dialog"):
        assert html_text.main_text(page(f"<{name}>{article}</{name.split()[0]}>")) == "", name
    comments = f"<section id='comments'><article><p>{LONG} no</p></article></section>"
    assert html_text.main_text(page(f"<article><p>{LONG}</p>{comments}</article>")) == LONG
    comments = f"<section id='comments'><article id='comment-12'><p>{LONG} no</p></article></section>"
    assert html_text.main_text(page(f"<main><p>{LONG}</p>{comments}</main>")) == LONG


def test_inline_elements_named_as_adverts_leave_their_paragraph():
    ad = "<span class='ad'>Buy <b>now</b> <a href='/x'>here</a></span>"
    assert html_text.main_text(page(f"<article><p>Short {ad}text.</p><p>{ad}{LONG}</p><p>{LONG} <span class='ad'>never closed</p><p>End.</article>")) == "\n".join(
        ["Short text.", LONG, LONG, "End."]
    )
    assert html_text.main_text(page(f"<p>{LONG} <i class='promo'>Buy</i>more.</p>")) == LONG + " more."


def test_a_letter_in_brackets_is_no_copyright():
    items = [f"({x}) {LONG}" for x in "abcd"]
    assert html_text.main_text(page("".join(f"<p>{x}</p>" for x in items))) == "\n".join(items)
    assert html_text.main_text(page(f"<p>{LONG}</p><p>(c) third</p>")) == f"{LONG}\n(c) third"
    for line in ("© Example", "Copyright (c) 2020 Example", "&copy; 1999-2004 " + LONG, "Copyright © Example", LONG + " © 2021"):
        assert html_text.main_text(page(f"<p>{LONG}</p><p>{line}</p>")) == LONG, line


@pytest.mark.parametrize("attribute", ["data=it's", 'title=5"', "a'b", "x=\"it's\" y='\"'", "title = 'a>b' id=x"])
def test_stray_quotes_in_tags_swallow_nothing(attribute):
    body = f'<p {attribute}>{LONG}</p><p>He said "no". It\'s {LONG}</p><p>Third {LONG}'
    assert html_text.main_text(page(body)) == "\n".join([LONG, f'He said "no". It\'s {LONG}', f"Third {LONG}"])


RUSSIAN = "Вот статья о погоде в городе, где каждый день идёт дождь, и люди ходят с зонтами по мокрым улицам до самого вечера."


@pytest.mark.parametrize("text", [RUSSIAN, "今日は天気がいいので、私たちは公園へ行って、長い間歩きながら話をしました。" * 3])
def test_prose_without_known_stop_words(text):
    around = "<p>Copyright © 2020</p>", "<ul><li><a href=/a>Menu one</a></li><li><a href=/b>Menu two</a></li></ul>"
    for other in around:
        assert html_text.main_text(page(f"<p>{text}</p>{other}<p>{text}</p>")) == f"{text}\n{text}"
        assert html_text.main_text(page(f"<p>Кратко.</p>{other}")) == "Кратко."
    # Where a known language is spoken, long blocks without its stop words stay undecided.
    assert html_text.main_text(page(f"<p>{LONG}</p><div>{'<a href=/x>linked link</a> ' * 9}</div><p>{text}</p>")) == LONG


def test_doubtful_names_need_a_second_sign():
    for part in ("class='market-share'", "id='related'", "class=social", "id=skip class='x promo'"):
        assert html_text.main_text(page(f"<article><p>{LONG}</p><section {part}><h2>More</h2><p>{LONG}</p></section></article>")) == f"{LONG}\nMore\n{LONG}", part
        for inside in ("Tweet this", f"<a href=/x>{LONG}</a>", "<ul><li>One</li><li>Two</li></ul>"):
            assert html_text.main_text(page(f"<article><p>{LONG}</p><div {part}>{inside}</div></article>")) == LONG, (part, inside)
    for part in ("share-buttons", "related-posts", "social_links"):
        assert html_text.main_text(page(f"<article><p>{LONG}</p><div class='{part}'><p>{LONG}</p></div></article>")) == LONG, part
    assert html_text.main_text(page(f"<p>{LONG} <span class='market-share'>45 %</span> of it.</p>")) == f"{LONG} 45 % of it."


def test_a_stroke_at_the_end_closes_nothing():
    assert html_text.main_text(page(f"<p>{LONG}</p><p><a href=/x/>{LONG}</a></p>")) == LONG
    assert html_text.main_text(page(f"<div/><p>{LONG}<br/>more</p><hr/><p>End.</p>")) == f"{LONG} more\nEnd."
    assert html_text.main_text(page(f"<nav/><p>{LONG}</p></nav><p>{LONG} b</p>")) == LONG + " b"


def plain_page(rng):
    """A page put together from parts whose kind is known, and the lines of its article: the plain version knows them beforehand."""
    lines, out = [], []

    def paragraph():
        words = prose(rng.choice(["en", "fr"]), rng.randrange(30, 60), rng.randrange(10**6)).replace("\n", " ")
        return rng.choice(["", "« ", "5 < 7 & "]) + words

    def written(text):
        text = html.escape(text, quote=False)
        at = text.find(" ", len(text) // 2)
        return rng.choice([text, f"{text[:at]} <b>{text[at + 1 :]}</b>", f"{text[:at]}\n<i>  {text[at + 1 :]}</i>", text + "<!-- <p>no</p> -->"])

    def noise():
        link = f"<a href='/{rng.randrange(99)}' title=\"a > b\">{rng.choice(['Home', 'More about us', 'Next page'])}</a>"
        return rng.choice([
            f"<nav><ul><li>{link}</li><li>{link}</li></ul></nav>", f"<aside><p>{paragraph()}</p></aside>", f"<div class='x sidebar'><p>{paragraph()}</p></div>",
            f"<form><label>{paragraph()}</label><input value='x'></form>", f"<div id=cookie-notice>{paragraph()}</div>", f"<script>var p = '<p>{paragraph()}';</script>",
            f"<style>p {{ x: '{paragraph()}' }}</style>", f"<div class='ad'><p>{paragraph()}</p></div>", f"<section id='comments'><div class=comment><p>{paragraph()}</p></div></section>",
            f"<div class='share-buttons'>{link}</div>", f"<footer><p>&copy; 2020 {paragraph()}</p></footer>", f"<div role='dialog'><p>{paragraph()}</p></div>",
        ])

    for _ in range(rng.randrange(1, 12)):
        kind = rng.random()
        if kind < 0.45:
            lines.append(paragraph())
            out.append(f"<p>{written(lines[-1])}{rng.choice(['</p>', ''])}" if rng.random() < 0.8 else f"<blockquote>{written(lines[-1])}</blockquote>")
        elif kind < 0.6:
            lines.append(rng.choice(["In short", "What next?", "Kapitel 2"]))
            out.append(f"<h2 class=head>{lines[-1]}</h2>")
        else:
            out.append(noise())
    body = "".join(out)
    return page(f"{noise()}<{rng.choice(['article', 'main'])}><div>{body}</div></main></article>{noise()}"), lines


def test_generated_pages():
    rng = random.Random(8)
    for _ in range(400):
        text, lines = plain_page(rng)
        assert html_text.main_text(text) == "\n".join(" ".join(x.split()) for x in lines), text
