"""Main text extraction on hand-made pages, and on the given ones against a plain reader that knows their template."""

import time
from html.parser import HTMLParser

import pytest

from staypath.llm import queries
from staypath.llm.main_text import Page, main_text, main_texts
from tests.conftest import SF_DIR

PROSE = ("The river had risen in the night, and by morning the lower fields were gone. Nobody spoke of it; they carried what "
         "they could to the barn, counted the animals, and waited. ")
MENU = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in "Home News Sport Weather Travel Contact".split())


class Article(HTMLParser):
    """Blocks of the article element, for pages with h1, p, b and br in it."""

    def __init__(self):
        super().__init__()
        self.inside, self.blocks = False, [[]]

    def handle_starttag(self, tag, attrs):
        self.inside |= tag == "article"
        if tag in ("p", "h1", "article"):
            self.blocks.append([])
        if tag == "br":
            self.handle_data(" ")

    def handle_endtag(self, tag):
        self.inside &= tag != "article"
        if tag in ("p", "h1"):
            self.blocks.append([])

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1].append(data)


def by_template(source):
    reader = Article()
    reader.feed(source)
    reader.close()
    return "\n".join(t for t in (" ".join("".join(b).split()) for b in reader.blocks) if t)


def test_given_pages(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    got = queries.op11_main_text(spark, SF_DIR).collect()
    assert len(got) == len(pages)
    for r in got:
        assert (r.url, r.text) == (pages[r.page_id].url, by_template(pages[r.page_id].html))
        assert r.n_chars == len(r.text)


def test_page_without_any_telling_name():
    body = "".join(f"<p>{PROSE * (1 + i % 3)}</p>" for i in range(5))
    page = (f"<html><body><div><ul>{MENU}</ul></div><div><h1>The flood</h1>{body}<p>Short end.</p></div>"
            f"<div><a href=x>More of this</a> <a href=y>Even more of that</a></div></body></html>")
    assert main_text(page).split("\n") == ["The flood", *[(PROSE * (1 + i % 3)).strip() for i in range(5)], "Short end."]


@pytest.mark.parametrize("other", [
    f"<nav>{PROSE}</nav>", f"<header><p>{PROSE}</p></header>", f"<footer>{PROSE}</footer>", f"<aside><p>{PROSE}</p></aside>",
    f"<div class='cookie-notice'><p>{PROSE}</p></div>", f"<div id=sideBar><p>{PROSE}</p></div>", f"<form><p>{PROSE}</p><textarea>{PROSE}</textarea></form>",
    f"<section class='post comments'><h2>Comments</h2><div><p>{PROSE}</p><p>{PROSE}</p></div></section>", f"<div class='ad box'>{PROSE}</div>",
    f"<script>var a = '<p>{PROSE}</p>';</script>", f"<style>p {{}} {PROSE}</style>", f"<!-- <p>{PROSE}</p> -->", f"<div hidden>{PROSE}</div>",
    f"<div role=complementary>{PROSE}</div>", f"<ul>{MENU}</ul>", f"<template><p>{PROSE}</p></template>", f"<select><option>{PROSE}</select>",
    f"<span class=advert>{PROSE}</span>", f"<iframe src=x><p>{PROSE}</p></iframe>", f"<svg><text>{PROSE}</text></svg>",
])
@pytest.mark.parametrize("article", ["<article>%s</article>", "<main>%s</main>", "<div class='content has-sidebar'>%s</div>"])
@pytest.mark.parametrize("inside", [False, True])
def test_what_is_not_the_article_goes(other, article, inside):
    if inside and other.startswith("<header") and "div" not in article:
        other = ""  # the header of an article belongs to it
    text = f"<h1>Title</h1><p>{PROSE * 2}</p><p>Yes.</p><p>{PROSE}<b>bold</b> end</p>"
    page = f"<!DOCTYPE html><html><head><title>{PROSE}</title></head><body class='with-footer'>"
    page += article % (text + other) if inside else (article % text) + other
    assert main_text(page + "</body></html>").split("\n") == ["Title", (PROSE * 2).strip(), "Yes.", f"{PROSE}bold end"]


@pytest.mark.parametrize("source, text", [
    (None, ""), ("", ""), ("   ", ""), ("<html></html>", ""), ("plain words", "plain words"), ("a < b & c &lt;d&gt; &eacute;&nbsp;&#x263A;", "a < b & c <d> é ☺"),
    ("<p>one<br>two\n\t three<p>four", "one two three\nfour"), ("<p><b>one<br><p>two</b> three</p>", "one\ntwo three"),
    ("<div>un<i>bro</i>ken</div><div>x</div>", "unbroken\nx"), ("<p>open <a href='", "open"), ("<!-- never closed", ""), ("<script>never closed", ""),
    ("<p title=\"a > b\">quoted</p>", "quoted"), ("<p title='it>once</p>", "once"), ("</p></div>stray<td>cell", "stray\ncell"), ("<ul><li>a<li>b</ul>", "a\nb"),
    ("<p>a&amp;b &copy 2020 &unknown; x</p>", "a&b © 2020 &unknown; x"), ("<P>UP</P><DIV>down</DIV>", "UP\ndown"), ("<nav>only a menu</nav>", ""),
    ("<div class=comment>only this</div>", "only this"),
])
def test_odd_markup(source, text):
    assert main_text(source) == text


@pytest.mark.parametrize("source", ["<div>" * 50_000 + "x", "<p a=\"" * 5_000, "<" * 100_000, "<p>x" * 50_000, "&amp;" * 100_000, "<!--" * 20_000, "<a b='c" * 5_000])
def test_long_odd_pages_end(source):
    start = time.time()
    main_text(source)
    assert time.time() - start < 10


def test_paths_tell_classes_apart():
    page = Page("<div class='b a1'><p>one<div class=c>two</div></div><p>three")
    assert page.texts == ["one", "two", "three"]
    assert len({e.path for e in page.owners}) == 3


def test_odd_rows(spark):
    rows = [(1, "u", f"<article><p>{PROSE}"), (1, "u", f"<article><p>{PROSE}"), (None, None, "x"), (2, "", None), (3, "v", "")]
    pages = spark.createDataFrame([(*r, "t", 5, 0.5) for r in rows], "page_id bigint, url string, html string, text string, n_chars int, `a.b` double")
    got = sorted((tuple(r) for r in main_texts(pages).collect()), key=str)
    text = PROSE.strip()
    assert got == sorted([(1, "u", text, len(text))] * 2 + [(None, None, "x", 1), (2, "", "", 0), (3, "v", "", 0)], key=str)
    assert main_texts(pages.limit(0)).count() == 0
