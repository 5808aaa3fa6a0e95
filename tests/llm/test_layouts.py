"""Main text of pages written by hand, in layouts that the generator of the training set does not make."""

from __future__ import annotations

from collections import Counter

import pytest

from fiscora.llm import html_main

A = "The council met on Tuesday to discuss the new budget, which had been delayed twice since the spring."
B = "Members agreed that spending on roads should rise, while the library would keep its present funding."
C = "A final vote is expected next month, once the auditors have finished their review of last year."
T = "Council agrees on budget"
BODY = f"<p>{A}</p><p>{B}</p><p>{C}</p>"
TEXT = f"{A} {B} {C}"

#: (name, page, main text)
PAGES = [
    ("plain article", f"<body><nav><a href=/>Home</a> <a href=/n>News</a></nav><article><h1>{T}</h1>{BODY}</article><footer>© 2024 The Paper. All rights reserved.</footer></body>", f"{T} {TEXT}"),
    ("header in article", f"<article><header><p>By Ann Lee, staff writer</p><p>Published on 3 May</p></header>{BODY}</article>", TEXT),
    ("aside in article", f"<article><h1>{T}</h1><p>{A}</p><aside class='related'><h3>Read also this other thing now</h3><ul><li><a href=/1>Roads to be closed</a></li></ul></aside><p>{B}</p><p>{C}</p></article>", f"{T} {TEXT}"),
    ("footer in article", f"<article>{BODY}<footer><p>Share this</p><a href=#>Mail</a> <a href=#>Print</a></footer></article>", TEXT),
    ("form in article", f"<article><p>{A}</p><form><label>Your mail</label><input><button>Sign up</button><p>We never share your address with anyone.</p></form><p>{B}</p><p>{C}</p></article>", TEXT),
    ("advert in article", f"<article><p>{A}</p><div class='ad-slot'><p>Buy two and get the third one free, this week only.</p></div><p>{B}</p><p>{C}</p></article>", TEXT),
    ("nav in article", f"<article><nav class=toc><ul><li><a href=#a>Roads</a></li><li><a href=#b>Library</a></li></ul></nav>{BODY}</article>", TEXT),
    ("comments in article", f"<article>{BODY}<section id='comments'><h2>2 comments</h2><p>I think that this is wrong, and I told them so.</p><p>Well said by the mayor, as always.</p></section></article>", TEXT),
    ("layout table", f"<table width=100%><tr><td colspan=3><a href=/>Home</a> | <a href=/n>News</a> | <a href=/s>Sport</a></td></tr><tr><td class=menu><a href=/a>Local</a><br><a href=/b>World</a><br><a href=/c>Arts</a></td><td><h1>{T}</h1>{BODY}</td><td class=right-rail><a href=/x>Most read today</a></td></tr></table>", f"{T} {TEXT}"),
    ("bare layout table", f"<body><table><tr><td><a href=/a>Local</a></td><td><a href=/b>World</a></td></tr></table><table><tr><td>{BODY}</td></tr></table></body>", TEXT),
    ("divs with classes", f"<div id=top><div class=logo><a href=/>The Paper</a></div></div><div id=content><h1>{T}</h1>{BODY}</div><div id=sidebar><h3>Related</h3><ul><li><a href=/1>Roads to be closed</a></li><li><a href=/2>Library hours</a></li></ul></div><div id=bottom>Copyright 2024 by The Paper.</div>", f"{T} {TEXT}"),
    ("related by its class", f"<main>{BODY}<div class='relatedPosts'><h4>You may like</h4><a href=/1>Roads to be closed</a><a href=/2>Library hours are cut</a></div></main>", TEXT),
    ("cookie notice", f"<div class='cookie-banner'><p>We use cookies to make this site better for you, and to count visits.</p><button>Accept</button></div><article>{BODY}</article>", TEXT),
    ("modal after", f"<article>{BODY}</article><div class='modal newsletter-modal'><h2>Stay informed</h2><p>Get our letter every morning, with the news that you need.</p></div>", TEXT),
    ("role attributes", f"<div role=navigation><a href=/>Home</a><a href=/n>News</a></div><div role=main><h1>{T}</h1>{BODY}</div><div role=contentinfo>All rights reserved, The Paper.</div>", f"{T} {TEXT}"),
    ("section wrapper", f"<section class='post-body'><h2>{T}</h2>{BODY}</section><section class='discussion'><p>Nobody asked us about this, did they?</p></section>", f"{T} {TEXT}"),
    ("list and quote", f"<article><p>{A}</p><ul><li>Roads</li><li>The library</li></ul><blockquote>We did what we could.</blockquote><p>{C}</p></article>", f"{A} Roads The library We did what we could. {C}"),
    ("data table in article", f"<article><p>{A}</p><table><tr><th>Item</th><th>Cost</th></tr><tr><td>Roads</td><td>12</td></tr></table><p>{B}</p></article>", f"{A} Item Cost Roads 12 {B}"),
    ("figure", f"<article><p>{A}</p><figure><img src=a.png alt='no'><figcaption>The town hall in spring.</figcaption></figure><p>{B}</p></article>", f"{A} The town hall in spring. {B}"),
    ("unclosed paragraphs", f"<article><h1>{T}<p>{A}<p>{B}<p>{C}</article><footer>Legal notice", f"{T} {TEXT}"),
    ("attribute without its quote", f"<article><p>{A}</p><p class=\"x>Hello</p><p title=\"y\">{B}</p></article>", f"{A} {B}"),
    ("quote inside an unquoted value", f"<article><p class=it's>{A}</p><p data-x=a\"b>{B}</p></article>", f"{A} {B}"),
    ("more than one part", f"<header><h2>The Paper</h2></header><div class=wrapper><div class=entry-content>{BODY}<div class=sharing><a href=#>Share</a></div></div><div class=widget><h3>Archive</h3><a href=/1>May</a><a href=/2>June</a></div></div>", TEXT),
    ("upper case markup", f"<BODY><DIV ID='NAV'><A HREF=/>HOME</A></DIV><ARTICLE><P>{A}</P><P>{B}</P></ARTICLE><FOOTER>IMPRINT</FOOTER></BODY>", f"{A} {B}"),
    ("sponsored in article", f"<article><p>{A}</p><section class='sponsored'><h3>From our partners</h3><p>The best cars of the year, all of them tested for you.</p></section><p>{B}</p></article>", f"{A} {B}"),
]


@pytest.fixture(scope="module")
def field():
    return html_main.train(html_main.labelled_pages())


def test_layouts(field):
    both = said = wanted = 0
    wrong = {}
    for name, page, text in PAGES:
        got, want = Counter(html_main.main_text(page, field).split()), Counter(text.split())
        both, said, wanted = both + (got & want).total(), said + got.total(), wanted + want.total()
        if got != want:
            wrong[name] = (got - want, want - got)
    assert len(PAGES) >= 20 and 2 * both / (said + wanted) >= 0.95, wrong
    assert not any(name in wrong for name in ("header in article", "aside in article", "footer in article", "form in article", "advert in article", "attribute without its quote")), wrong


def test_markup_is_never_text(field):
    for page in ('<p class="x>Hello', "<p class='x>Hello</p><p>b", '<a b="c', "</p", "<p a=b\"c>x</p>", "<p =x>y", "</ x>z", "<p a= >z", "<p/class=x/>q", "<p a='1'b=\"2\">r", "<!doctype html", "a < b", "a <3 b"):
        for block in html_main.leaf_blocks(page):
            assert "class" not in block.text and ">" not in block.text and '"' not in block.text, (page, block.text)
    assert [b.text for b in html_main.leaf_blocks('<p class="x>Hello</p><p id="y">z</p>')] == ["z"]
    assert [b.text for b in html_main.leaf_blocks("a < b <3 c")] == ["a < b <3 c"]


def test_a_very_long_page(field):
    page = "<article>" + f"<p>{A}</p>" * 20_000 + "</article><footer>the end</footer>"
    assert html_main.main_text(page, field) == " ".join([A] * 20_000)
    assert html_main.leaf_blocks("<p " + 'a="b' * 50_000) == [] and html_main.leaf_blocks("<p " + "= " * 100_000 + ">x")[0].text == "x"
    deep = html_main.leaf_blocks("<div class=x>" * 2000 + "word" + "</div>" * 2000)
    assert [b.text for b in deep] == ["word"]
