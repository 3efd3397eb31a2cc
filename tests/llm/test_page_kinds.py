"""Kinds of pages that the block rules must tell apart, and the two passes against a plain version."""

import random

import pytest

from tablesync.llm import html_text
from tablesync.llm.html_text import Block, labels, main_text

MENU = "<nav><ul><li><a href=/>Home</a></li><li><a href=/n>News of the day and all that is in it for you</a></li></ul></nav>"
LINKS = "<div class=links><a href=/a>One</a> <a href=/b>Two</a></div>"
P1 = "The council said on Monday that the bridge would be closed for at least two weeks while it is repaired."
P2 = "It was built in the sixties and has been in need of work for years, as the engineers of the city had warned."
COMMENT = "I think that this is the best thing that the council has done in years, and it was about time that they did it."
ITALIAN = [
    "Il ministro ha dichiarato ieri sera durante una conferenza stampa quanto segue riguardo ai nuovi provvedimenti economici.",
    "Secondo gli esperti intervistati dalla nostra redazione, questi cambiamenti porteranno benefici alle famiglie italiane.",
]
POLISH = [
    "Minister powiedział wczoraj wieczorem podczas konferencji prasowej, że nowe przepisy wejdą wkrótce w życie.",
    "Zdaniem ekspertów zmiany przyniosą korzyści wszystkim rodzinom, choć niektórzy obawiają się kosztów.",
]
CHINESE = ["市议会周一表示，这座桥将关闭至少两周进行维修，期间车辆需要绕行其他道路，居民对此表示理解。", "该桥建于上世纪六十年代，多年来一直需要维修，城市的工程师们曾多次发出警告，希望尽快开工。"]
RUSSIAN = ["Министр заявил вчера вечером на пресс-конференции, что новые правила вступят в силу уже в следующем месяце."]


def page(body):
    return f"<html><head><title>x</title></head><body>{MENU}{body}</body></html>"


def paragraphs(*texts):
    return "".join(f"<p>{t}</p>" for t in texts)


@pytest.mark.parametrize("name", ["social-news", "widget-body", "site-banner", "comments-enabled", "has-sidebar", "ad-free", "promoWrap", "header"])
def test_a_word_does_not_put_out_the_whole_text(name):
    assert main_text(page(f"<div class='{name}'>{paragraphs(P1, P2)}</div>")) == f"{P1} {P2}"
    assert main_text(page(f"<div id={name}><div class=row>{paragraphs(P1)}</div><h2>Why</h2>{paragraphs(P2)}{LINKS}</div>")) == f"{P1} Why {P2}"


@pytest.mark.parametrize("name", ["sidebar", "cookie-notice", "related", "newsletter"])
def test_a_word_puts_out_what_weighs_less(name):
    other = f"<div class='{name}'><p>{COMMENT}</p></div>"
    assert main_text(page(f"<div class=body>{paragraphs(P1, P2)}</div>{other}")) == f"{P1} {P2}"
    assert main_text(page(f"<div class=has-sidebar><div class=body>{paragraphs(P1, P2)}</div>{other}</div>")) == f"{P1} {P2}"
    assert main_text(page(f"<div class=widget-body>{other}{paragraphs(P1, P2)}</div>")) == f"{P1} {P2}"


def test_reader_comments_go_however_long():
    comments = paragraphs(*[COMMENT] * 9)
    for around in ("<section class=comments>{}</section>", "<div id=disqus_thread>{}</div>", "<article class=comment>{}</article>", "<ol class='comment-list'><li>{}</li></ol>"):
        assert main_text(page(f"<div class=body>{paragraphs(P1)}</div>" + around.format(comments).replace("article", "div"))) == P1
        assert main_text(page(f"<main><article class=post>{paragraphs(P1, P2)}</article>{around.format(comments)}</main>")) == f"{P1} {P2}"
        assert main_text(page(f"<article class=post>{paragraphs(P1, P2)}{around.format(comments)}</article>")) == f"{P1} {P2}"
        assert main_text(page(f"<article class=post>{paragraphs(P1, P2)}</article>{around.format(comments)}")) == f"{P1} {P2}"


@pytest.mark.parametrize("texts", [ITALIAN, POLISH, CHINESE, RUSSIAN, CHINESE[:1], [*CHINESE, P1]])
def test_languages_without_stop_words(texts):
    wanted = " ".join(texts)
    assert main_text(page(paragraphs(*texts))) == wanted
    assert main_text(page(f"<div><a href=/m>菜单</a></div>{paragraphs(*texts)}<footer>© 2020</footer>")) == wanted
    assert main_text(page(f"<article>{paragraphs(*texts)}</article>")) == wanted


def test_an_articles_header_keeps_its_headings():
    body = f"<article><header><h1>Bridge <b>closed</b></h1><p>By A. Writer, {P2}</p><div><h2>For weeks</h2></div></header>{paragraphs(P1)}</article>"
    assert main_text(page(body)) == f"Bridge closed For weeks {P1}"
    assert main_text(page(f"<header><h1>The Daily</h1></header><article>{paragraphs(P1)}</article>")) == P1
    assert main_text(page(f"<nav><header><h1>No</h1></header></nav><article>{paragraphs(P1)}<footer><header><h2>No</h2></header></footer></article>")) == P1


def test_long_pages_are_read_whole():
    text = [f"{P1} It is number {i} of the list." for i in range(6000)]
    assert main_text(page(f"<div class=widget>{paragraphs(*text)}</div>" + "<div class=ad><p>buy it now</p></div>" * 3000)) == " ".join(text)
    deep = "<div class=widget>" * 3000 + f"<p>{P1}</p>" + "</div>" * 3000
    assert main_text(page(deep)) == P1


def plain_labels(found):
    """The two passes, every block looked at anew for each ambiguous one."""
    marked = any(b.article and not b.out for b in found)
    first = [html_text._decided(b, marked) for b in found]
    if not any(x is True for x in first):
        first = [True if x is None and len(b.text) >= html_text.SHORT else x for x, b in zip(first, found)]
    out = []
    for i, block in enumerate(found):
        if first[i] is not None:
            out.append(first[i])
            continue
        decided = [j for j in range(len(found)) if first[j] is not None]
        own = [j for j in decided if found[j].article == block.article and not found[j].out]
        if not own and block.article:
            out.append(True)
            continue
        near = own or decided
        before, after = [j for j in near if j < i][-1:], [j for j in near if j > i][:1]
        # The nearer side; of two as near, in if either is.
        best = min((abs(i - j), not first[j]) for j in before + after) if near else (0, False)
        out.append(not best[1])
    return out


def test_two_passes_are_the_plain_ones():
    rng = random.Random(7)
    texts = [P1, P2, ITALIAN[0], CHINESE[0], "short", "© 2020", "Why", "one two three four five six seven eight nine ten eleven", "#" * 70]
    ties = 0
    for _ in range(4000):
        found = []
        for _ in range(rng.randrange(0, 14)):
            text = rng.choice(texts)
            found.append(Block(text, rng.choice((0, 0, 0, len(text) // 2, len(text))), rng.random() < 0.2, rng.choice((0, 0, 0, 1, 2)) if rng.random() < 0.5 else 0))
        assert labels(found) == plain_labels(found)
        ties += len(found) > 2
    assert ties
