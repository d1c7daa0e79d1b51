"""Labelled pages from which the extraction model is trained.

Elements with data-main="1" are content with all below them, up to elements with
data-main="0".  The pages are made by rule: layouts that sites use, drawn with a
fixed seed, with filler words for sentences.  Lengths are drawn alike for content
and for what surrounds it where sites do so too, so that the model learns to go by
structure where it can.
"""

from __future__ import annotations

import random
import re

PAGES = 400
SEED = 11
BARE = 4
_WORDS = ("the river had risen in the night and by morning the lower fields lay under water while people "
          "carried what they could to the church hall where tea was made for everyone who came").split()
_M, _N = ' data-main="1"', ' data-main="0"'


class _Maker:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def one(self, *choices: str) -> str:
        return self.r.choice(choices)

    def words(self, low: int, high: int, stop: str = ".") -> str:
        n = min(high, max(low, int(self.r.lognormvariate(2.4, 1.1))))
        text = " ".join(self.r.choice(_WORDS) for _ in range(n))
        return text.capitalize() + stop

    def maybe(self, p: float, part) -> str:
        return part() if self.r.random() < p else ""

    def links(self, low: int = 2, high: int = 9) -> str:
        items = "".join(f'<li><a href="/x">{self.words(1, 4, "")}</a></li>' for _ in range(self.r.randint(low, high)))
        return f"<ul>{items}</ul>"

    def box(self, tag: str, names: tuple[str, ...], inner: str, mark: str = "") -> str:
        """An element with a class, an id, or neither."""
        name = self.r.choice(names) if names else ""
        how = f' {self.one("class", "class", "id")}="{name}"' if name else ""
        return f"<{tag}{how}{mark}>{inner}</{tag}>"

    # what surrounds the content
    def menu(self) -> str:
        if self.r.random() < 0.6:
            return self.box("nav", ("", "main-nav", "navbar"), self.links())
        return self.box("div", ("nav", "menu", "navigation", "main-menu"), self.links())

    def header(self) -> str:
        inner = self.one(f"<h1>{self.words(1, 5, '')}</h1>", f"<p>{self.words(1, 9)}</p>", self.words(1, 12), f'<div class="logo">{self.words(1, 3, "")}</div>')
        return self.box(*self.r.choice([("header", ("", "site-header")), ("div", ("header", "masthead", "top-bar"))]), inner + self.maybe(0.5, self.menu))

    def advert(self) -> str:
        inner = self.words(1, 40)
        return self.box(self.one("div", "div", "section"), ("ad", "advert", "ads", "sponsored", "promo", "advertisement", "ad-banner"), self.one(inner, f"<p>{inner}</p>"))

    def notice(self) -> str:
        inner = self.words(3, 40)
        return self.box(self.one("div", "div", "section", "p"), ("cookie-notice", "cookie-banner", "consent", "notice", "alert", "gdpr", "popup", "newsletter", "subscribe"),
                        self.one(inner, f"<p>{inner}</p><div>{self.words(1, 2, '')}</div>"))

    def side(self) -> str:
        inner = self.maybe(0.6, lambda: f"<h3>{self.words(1, 4, '')}</h3>") + "".join(self.one(f"<p>{self.words(2, 50)}</p>", self.links(), f"<div>{self.words(1, 20)}</div>") for _ in range(self.r.randint(1, 4)))
        return self.box(*self.r.choice([("aside", ("", "sidebar")), ("div", ("sidebar", "side", "widget"))]), inner)

    def related(self) -> str:
        return self.box(self.one("div", "section"), ("related", "recommended", "share", "social", "tags", "popular"), self.maybe(0.6, lambda: f"<h4>{self.words(1, 4, '')}</h4>") + self.one(self.links(), f"<p>{self.words(2, 20)}</p>"))

    def form(self) -> str:
        return self.box("form", ("", "", "search", "login"), f"{self.one('', self.words(1, 5, ''))}<p>{self.words(1, 25)}</p><label>{self.words(1, 3, '')}</label><input name=q>" + self.maybe(0.5, lambda: f"<div>{self.words(1, 3, '')}</div>"))

    def comments(self) -> str:
        def remark() -> str:
            inner = self.maybe(0.5, lambda: f"<h4>{self.words(1, 3, '')}</h4>") + "".join(f"<p>{self.words(1, 60)}</p>" for _ in range(self.r.randint(1, 3)))
            return self.box(self.one("div", "div", "li", "article"), ("comment", "comment", "reply", "comment-body"), inner)

        inner = self.maybe(0.7, lambda: f"<h3>{self.words(1, 3, '')}</h3>") + "".join(remark() for _ in range(self.r.randint(1, 5))) + self.maybe(0.4, self.form)
        return self.box(self.one("div", "section"), ("comments", "comments", "comment-list", "discussion", "responses", "reader-comments"), inner)

    def footer(self) -> str:
        inner = self.one(self.words(2, 40), f"<p>{self.words(2, 40)}</p>", f"&copy; x.org &middot; {self.words(2, 30)}", self.links() + f"<p>{self.words(1, 20)}</p>")
        return self.box(*self.r.choice([("footer", ("", "", "site-footer")), ("div", ("footer", "copyright", "bottom"))]), inner)

    # the content
    def passage(self) -> str:
        kind = self.r.random()
        if kind < 0.72:
            return f"<p>{self.words(1, 90)}</p>"
        if kind < 0.76:
            return f"<p><b>{self.words(1, 12)}<br>"
        if kind < 0.82:
            return f"<h2>{self.words(1, 8, '')}</h2>"
        if kind < 0.86:
            items = "".join(f"<li>{self.words(1, 25)}</li>" for _ in range(self.r.randint(2, 5)))
            return self.one(f"<ul>{items}</ul>", f"<ol>{items}</ol>")
        if kind < 0.89:
            return f"<blockquote><p>{self.words(3, 40)}</p></blockquote>"
        if kind < 0.91:
            return f"<figure><img src=x><figcaption>{self.words(2, 20)}</figcaption></figure>"
        if kind < 0.93:
            return f"<table><tr><th>{self.words(1, 3, '')}</th><td>{self.words(1, 8, '')}</td></tr></table>"
        if kind < 0.95:
            return f"<pre>{self.words(3, 20)}</pre>"
        return f"<div>{self.words(4, 60)}</div>"

    def content(self) -> str:
        parts = [self.passage() for _ in range(self.r.choice((1, 2, 3, 5, 8, 12, 20)))]
        for inset in (self.advert, self.notice, self.side, self.form, self.related, self.menu, self.comments, self.footer):
            if self.r.random() < 0.08:
                at = len(parts) if inset in (self.comments, self.footer) else self.r.randint(0, len(parts))
                parts.insert(at, re.sub(r"^<\w+", lambda m: m[0] + _N, inset()))
        head = f"<h1>{self.words(1, 14, '')}</h1>"
        return self.one(head, head, head, f"<header>{head}<p>{self.words(3, 20)}</p></header>") + "".join(parts)

    def body(self) -> str:
        c, kind = self.content(), self.r.random()
        if kind < 0.40:
            return f"<article{_M}>{c}</article>"
        if kind < 0.55:
            return f"<main{_M}>{self.one(c, f'<article>{c}</article>', f'<section>{c}</section>')}</main>"
        if kind < 0.80:
            names = ("content", "main", "main-content", "article", "post", "entry-content", "article-body", "story", "post-content", "text")
            return self.box(self.one("div", "div", "section"), names, self.one(c, f"<div>{c}</div>"), _M)
        if kind < 0.86:
            return f'<div role="main"{_M}>{c}</div>'
        if kind < 0.94:
            return f"<div{_M}>{c}</div>"
        return ""  # no element of its own

    def loose(self) -> str:
        """Content without an element that says so: text in the body, in plain blocks, between line breaks."""
        sentences = lambda n: [self.words(3, 60) for _ in range(self.r.randint(1, n))]
        broken = lambda: self.one("<br>", "<br><br>", " ", "<br/>\n").join(sentences(8))
        text = lambda t: f"<span{_M}>{t}</span>"
        head = self.maybe(0.4, lambda: f"<h1{_M}>{self.words(1, 9, '')}</h1>")
        kind = self.r.random()
        if kind < 0.3:
            return head + text(broken())
        if kind < 0.55:
            return head + "".join(f"<div{_M}>{x}</div>" for x in sentences(6))
        if kind < 0.65:
            return head + f"<section{_M}>{broken()}</section>"
        if kind < 0.72:
            return head + f"<center{_M}>{broken()}</center>"
        if kind < 0.79:
            return head + f"<pre{_M}>{self.words(3, 60)}\n{self.words(3, 60)}</pre>"
        if kind < 0.86:
            return head + f"<div{_M}>{broken()}</div>"
        return head + text(self.words(1, 30)) + "".join(f"<p{_M}>{x}</p>" for x in sentences(5)) + self.maybe(0.4, lambda: text(self.words(1, 30)))

    def bare_page(self) -> str:
        """A page that leaves out what may be left out."""
        parts = [self.loose()]
        if self.r.random() < 0.5:
            parts = [self.maybe(0.3, self.notice), self.maybe(0.4, self.header), self.maybe(0.5, self.menu), *parts, self.maybe(0.2, self.advert),
                     self.maybe(0.2, self.comments), self.maybe(0.2, self.related), self.maybe(0.6, self.footer)]
        if self.r.random() < 0.1:
            parts.insert(0, f'<a href="#x">{self.words(1, 3, "")}</a> | <a href="/">{self.words(1, 2, "")}</a>')
        start = self.one("", "<html><head><title>x</title></head><body>", "<html><head><title>x</title>", "<head><meta charset=utf-8><title>x</title>", "<body>", "<!DOCTYPE html><title>x</title><body>")
        return start + "".join(parts) + self.one("", "</body></html>")

    def page(self) -> str:
        before = [self.maybe(p, part) for p, part in ((0.3, self.notice), (0.55, self.header), (0.75, self.menu), (0.3, self.advert), (0.1, self.form))]
        after = [self.maybe(p, part) for p, part in ((0.25, self.related), (0.4, self.comments), (0.4, self.side), (0.25, self.advert), (0.2, self.form), (0.1, self.notice), (0.8, self.footer))]
        wrap = self.one("{}", "{}", "<div>{}</div>", '<div class="wrapper">{}</div>', '<div id="page"><div>{}</div></div>')
        body = self.body()
        if not body:  # the content stands in the body itself
            wrap = "{}"
            body = f"<h1{_M}>{self.words(1, 9, '')}</h1>" + "".join(f"<p{_M}>{self.words(1, 70)}</p>" for _ in range(self.r.randint(1, 9)))
        return "<!DOCTYPE html><html><head><title>x</title></head><body>" + wrap.format("".join([*before, body, *after])) + "</body></html>"


def labelled_pages(n: int = PAGES, seed: int = SEED) -> list[str]:
    """``n`` pages drawn by rule, and one without the usual elements for every ``BARE``; the same
    for the same seed."""
    maker, bare = _Maker(seed), _Maker(seed + 1000)
    return [maker.page() for _ in range(n)] + [bare.bare_page() for _ in range(n // BARE)]


LABELLED = labelled_pages()
