"""Main text of web pages by a tree-structured graphical model.

A page's block elements are the nodes of a tree; each is content, or holds content
among other things, or neither.  The model has a potential for every parent and
child (what is a child of this kind of tag, given its parent?) and one for what is
seen at a node: what its class, id and role say, how much text it has of its own,
how much of that is linked, how it ends.  Sum-product messages, once up and once
down the tree, give every node's exact marginal; the text of nodes that are content
more likely than not is kept.

The potentials are counted on labelled pages (``html_pages.LABELLED`` or a list of
the caller's own): conditional frequencies with one added to every count.

A page is one row: the work is a narrow pass, each task holds a batch of bounded
bytes, and messages take time in proportion to the page's elements.

Text that stands in a page, its body or a section beside other blocks is a block of
its own.

Defined results: null and empty pages have the empty text; pages without markup
are one block; very long pages are read whole, in time that grows with their length; a
node that is content exactly as likely as not is left out; repeated rows are extracted
one by one; other columns are not read, so their names cannot clash; an empty table
gives no rows.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql.functions import pandas_udf

#: Element names of the HTML standard by how they lay out.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style noscript template svg math iframe object audio video canvas select button textarea title head datalist map".split())
RAW = frozenset("script style textarea title noscript iframe".split())
BLOCK = frozenset("""html body main article section nav header footer aside div p h1 h2 h3 h4 h5 h6 hgroup ul ol li dl dt dd table
    caption thead tbody tfoot tr td th form fieldset legend blockquote pre figure figcaption address details summary dialog
    search center menu""".split())
ENDS_P = BLOCK - {"html", "body", "caption", "thead", "tbody", "tfoot", "tr", "td", "th"} | {"hr"}
#: Elements that may stand in a head; any other one ends it, and so does text.
IN_HEAD = frozenset("title meta link base script style noscript template".split())
#: Blocks in which text beside other blocks is a block of its own.
LOOSE = frozenset("html body main article section".split())
TEXT = "text"
#: An element that starts ends the open one of these names, if none of the others is nearer.
ENDS = ((("li",), ("ul", "ol", "menu")), (("dt", "dd"), ("dl",)), (("tr",), ("table",)), (("td", "th"), ("tr", "table")),
        (("thead", "tbody"), ("table",)))
ENDS_OF = {"li": 0, "dt": 1, "dd": 1, "tr": 2, "td": 3, "th": 3, "tbody": 4, "tfoot": 4}
#: Elements that may be written as closed at once.
CLOSED_AT_ONCE = frozenset(("svg", "math"))
KIND = {t: k for k, tags in {
    "heading": "h1 h2 h3 h4 h5 h6 hgroup", "item": "li dt dd", "list": "ul ol dl menu", "table": "table thead tbody tfoot tr",
    "cell": "td th caption", "form": "form fieldset legend search", "quote": "blockquote pre", "figure": "figure figcaption",
    "plain": "div center section", "folded": "details summary dialog address"}.items() for t in tags.split()}
#: Words of class, id and role values, by what they say.
HINTS = {h: k for k, hints in {
    "content": "article content post entry main story text body prose markdown",
    "around": """nav navbar navigation menu sidebar side footer header masthead banner breadcrumb breadcrumbs toolbar top bottom
        contentinfo complementary pagination pager toc logo site""",
    "sold": "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner-ad adsense teaser",
    "notice": "cookie cookies consent notice alert gdpr popup modal overlay subscribe newsletter signup login search disclaimer copyright legal",
    "talk": "comment comments reply replies respond discussion disqus reader feedback review reviews",
    "more": "related recommended recommend share sharing social widget tags tag meta byline popular trending more links"}.items()
    for h in hints.split()}
MARK = "data-main"
#: What a node can be: no content, content, or a holder of content and other things.
AROUND, CONTENT, HOLDER = STATES = (0, 1, 2)
#: Added to the counts of a parent's and child's labels: small, as a paragraph
#: hardly ever differs from what it stands in.
EDGE_PRIOR = 0.1
#: Powers of what is seen of a node's text: the paragraphs of a page are alike, so
#: each tells less than it would by itself.
TRUST = {"length": 0.3, "stop": 0.1, "linked": 1.0}

_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_QUOTED = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|style|" + MARK + r")\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?", re.I)
_RAW_END = {t: re.compile(rf"</{t}\b", re.I) for t in RAW}
_NOT_SHOWN = re.compile(r"display\s*:\s*none")


class Page:
    """The block elements of a page, parents before children, and its runs of
    text: (block, text) in page order."""

    def __init__(self, source: str):
        self.parent, self.tag, self.hint, self.mark, self.hidden = [-1], ["html"], [frozenset()], [None], [False]
        self.runs: list[tuple[int, str]] = []
        self.own_words, self.linked_words, self.last = [0], [0], [""]
        self._text: list[str] = []
        self._linked: list[int] = []
        self._said_mark: bool | None = None
        self._parse(source)

    def _close_run(self, block: int) -> None:
        if self._text:
            text = " ".join("".join(self._text).split())
            if text:
                if self.tag[block] in LOOSE:
                    block = self._new_block(block, TEXT, "")
                    if self._said_mark is not None:
                        self.mark[block] = self._said_mark
                self.runs.append((block, text))
                self.own_words[block] += text.count(" ") + 1
                self.linked_words[block] += sum(self._linked)
                self.last[block] = text[-1]
            self._text, self._linked = [], []

    def _parse(self, source: str) -> None:
        """Time in proportion to the page: an end tag without a start is answered by a
        count of open tags, the element that a start ends by what each block notes of
        those around it, and a quotation that never closes is looked for once."""
        block, links, unseen, in_head, quotes = 0, 0, 0, 0, True
        # open elements: name, the block around, whether it hides, the mark of text before
        stack: list[tuple[str, int, bool, bool | None]] = []
        opened: dict[str, int] = defaultdict(int)
        # open blocks: place on the stack, and by entry of ENDS the nearest of its names (place, to be ended?)
        blocks: list[tuple[int, str, tuple]] = [(-1, "html", (None,) * len(ENDS))]

        def said(text: str) -> None:
            nonlocal in_head
            if in_head and text and not text.isspace() and stack[-1][0] == "head":
                pop_to(len(stack) - 1)
            if text and not unseen:
                if "&" in text:
                    text = entities.unescape(text)
                self._text.append(text)
                if links:
                    self._linked.append(len(text.split()))

        def pop_to(n: int) -> None:
            nonlocal block, links, unseen, in_head
            while len(stack) > n:
                tag, outer, hides, marked = stack.pop()
                opened[tag] -= 1
                if tag in BLOCK:
                    self._close_run(block)
                    block = outer
                    blocks.pop()
                elif tag == "a":
                    links -= 1
                elif tag == "head":
                    in_head -= 1
                if marked is not self._said_mark:
                    self._close_run(block)
                    self._said_mark = marked
                if hides:
                    unseen -= 1

        at, size, last_end = 0, len(source), source.rfind(">")
        while at < size:
            start = source.find("<", at)
            if start < 0 or start > last_end:  # no tag ends any more
                if start >= 0 and source.startswith("<!--", start):
                    said(source[at:start])
                else:
                    said(source[at:])
                break
            said(source[at:start])
            m = _NAME.match(source, start)
            if m is None:
                if source.startswith("<!--", start):
                    end = source.find("-->", start + 4)
                    at = end + 3 if end >= 0 else size
                elif source[start + 1] in "!?/":
                    at = source.find(">", start) + 1
                else:
                    said("<")
                    at = start + 1
                continue
            whole = _QUOTED.match(source, m.end()) if quotes else None
            if whole is None:
                quotes = False
                at = source.find(">", m.end()) + 1
            else:
                at = whole.end()
            tag, attributes = m[2].lower(), source[m.end():at - 1]
            if m[1]:
                if opened[tag]:
                    n = len(stack) - 1
                    while stack[n][0] != tag:
                        n -= 1
                    pop_to(n)
                continue
            if in_head and tag not in IN_HEAD and stack[-1][0] == "head":
                pop_to(len(stack) - 1)
            if tag in VOID:
                if tag == "hr":
                    self._close_run(block)
                elif tag == "br":
                    said(" ")
                continue
            if blocks[-1][1] == "p" and tag in ENDS_P:
                pop_to(blocks[-1][0])
            if tag in ENDS_OF:
                near = blocks[-1][2][ENDS_OF[tag]]
                if near is not None and near[1]:
                    pop_to(near[0])
            if tag in RAW:
                end = _RAW_END[tag].search(source, at)
                end = source.find(">", end.end()) if end else -1
                at = end + 1 if end >= 0 else size
                continue
            if tag in CLOSED_AT_ONCE and attributes.endswith("/"):
                continue
            hides, marked = tag in UNSEEN, self._said_mark
            if tag in BLOCK:
                stack.append((tag, block, hides, marked))
                self._close_run(block)
                around = blocks[-1][2]
                notes = tuple((len(stack) - 1, tag in ends) if tag in ends or tag in bounds else old for (ends, bounds), old in zip(ENDS, around))
                blocks.append((len(stack) - 1, tag, notes))
                block = self._new_block(block, tag, attributes)
            else:
                if attributes:
                    for name, *values in _ATTRIBUTE.findall(attributes):
                        if name.lower() == MARK:
                            self._close_run(block)
                            self._said_mark = "".join(values) != "0"
                        elif name.lower() == "hidden" or name.lower() == "style" and _NOT_SHOWN.search("".join(values).lower()):
                            hides = True
                stack.append((tag, block, hides, marked))
                if tag == "a":
                    links += 1
                elif tag == "head":
                    in_head += 1
            opened[tag] += 1
            if hides:
                unseen += 1
        pop_to(0)
        self._close_run(block)

    def _new_block(self, parent: int, tag: str, attributes: str) -> int:
        hints, mark, hidden = set(), self.mark[parent], self.hidden[parent]
        if attributes:
            for name, *values in _ATTRIBUTE.findall(attributes):
                name, value = name.lower(), "".join(values).lower()
                if name == MARK:
                    mark = value != "0"
                elif name == "hidden" or name == "style" and _NOT_SHOWN.search(value):
                    hidden = True
                elif name != "style":
                    for word in re.split(r"[\s_]+", value):
                        hints.update(HINTS[x] for x in (word, *word.split("-")) if x in HINTS)
        self.parent.append(parent)
        self.tag.append(tag)
        # a name like comment-body or main-nav says content only of what it names besides
        self.hint.append(frozenset(hints - {"content"} or hints))
        self.mark.append(mark)
        self.hidden.append(hidden)
        self.own_words.append(0)
        self.linked_words.append(0)
        self.last.append("")
        return len(self.parent) - 1

    def kind(self, i: int) -> str:
        kind = KIND.get(self.tag[i], self.tag[i])
        return "named" if kind == "plain" and self.hint[i] else kind

    def states(self) -> list[int]:
        """The labels of a labelled page's nodes."""
        y = [CONTENT if m else AROUND for m in self.mark]
        for i in range(len(y) - 1, 0, -1):
            if y[i] != AROUND and y[self.parent[i]] == AROUND and self.mark[self.parent[i]] is None:
                y[self.parent[i]] = HOLDER
        return y

    def seen(self, i: int) -> tuple:
        """What is seen at a node: the model's observations."""
        n = self.own_words[i]
        linked = self.linked_words[i] / n if n else 0
        length = 0 if not n else 1 if n < 4 else 2 if n < 10 else 3 if n < 25 else 4
        return (("length", length), *(() if not n else (("linked", 0 if linked < 0.1 else 1 if linked < 0.6 else 2), ("stop", length > 1 and self.last[i] in ".!?…:;\"”»)"))),
                *((("hint", h) for h in sorted(self.hint[i])) if self.hint[i] else (("hint", "none"),)))


class Model:
    """Log potentials of the tree and the observations."""

    def __init__(self, labelled: Iterable[str]):
        down, seen, kinds, tags = defaultdict(int), defaultdict(int), defaultdict(set), {"other"}
        for source in labelled:
            page = Page(source)
            y = page.states()
            for i in range(len(y)):
                if i:
                    tags.add(page.kind(i))
                    down[y[page.parent[i]], y[i], page.kind(i)] += 1
                    down[y[page.parent[i]], y[i], "other"] += 1
                for name, value in page.seen(i):
                    kinds[name].add(value)
                    seen[name, value, y[i]] += 1
        # a kind of tag not seen below such a parent goes by all kinds below it
        common = lambda p, c: (down[p, c, "other"] + EDGE_PRIOR) / sum(down[p, x, "other"] + EDGE_PRIOR for x in STATES)
        edge = lambda p, c, k: (down[p, c, k] + common(p, c)) / (sum(down[p, x, k] for x in STATES) + 1)
        self.down = {k: [[math.log(edge(p, c, k)) for c in STATES] for p in STATES] for k in tags}
        totals = {(name, y): sum(seen[name, v, y] + 1 for v in kinds[name]) for name in kinds for y in STATES}
        self.seen = {(name, v): [TRUST.get(name, 1.0) * math.log((seen[name, v, y] + 1) / totals[name, y]) for y in STATES]
                     for name in kinds for v in kinds[name]}

    def marginals(self, page: Page) -> list[float]:
        """The probability of every node to be content, by messages up and down."""
        n, parent = len(page.parent), page.parent
        edge = [self.down.get(page.kind(i)) or self.down["other"] for i in range(n)]
        local = []
        for i in range(n):
            x = y = z = 0.0
            for s in page.seen(i):
                found = self.seen.get(s)
                if found:
                    x, y, z = x + found[0], y + found[1], z + found[2]
            local.append([x, y, z])
        up = [None] * n                       # message of a node to its parent
        for i in range(n - 1, 0, -1):         # children come after parents; all of i's have reported
            x, y, z = local[i]
            up[i] = message = [_log_sum(a + x, b + y, c + z) for a, b, c in edge[i]]
            q = local[parent[i]]
            q[0], q[1], q[2] = q[0] + message[0], q[1] + message[1], q[2] + message[2]
        belief, out = [None] * n, [0.0] * n
        local[0][CONTENT] -= 1e3              # the root holds content
        local[0][AROUND] -= 1e3
        belief[0] = local[0]
        for i in range(1, n):
            (p, q, r), (u, v, w) = belief[parent[i]], up[i]
            p, q, r = p - u, q - v, r - w     # the parent's belief without this child
            (a, b, c), (d, e, f), (g, h, k) = edge[i]
            x, y, z = local[i]
            x, y, z = x + _log_sum(p + a, q + d, r + g), y + _log_sum(p + b, q + e, r + h), z + _log_sum(p + c, q + f, r + k)
            total = _log_sum(x, y, z)
            belief[i] = (x - total, y - total, z - total)
            out[i] = math.exp(y - total)
        return out

    def extract(self, source: str | None) -> str:
        """The main text of a page."""
        if not source:
            return ""
        page = Page(source)
        if all(tag == TEXT for tag in page.tag[1:]):  # no block markup: one block
            return " ".join(text for _, text in page.runs)
        content = self.marginals(page)
        return " ".join(text for block, text in page.runs if content[block] > 0.5 and not page.hidden[block])


def _log_sum(a: float, b: float, c: float) -> float:
    top = a if a > b else b
    top = c if c > top else top
    return top + math.log(math.exp(a - top) + math.exp(b - top) + math.exp(c - top))


def main_text(page: Column, labelled: list[str] | None = None) -> Column:
    """The main text of a column of HTML; null pages give the empty text."""
    from shelfwise.llm.html_pages import LABELLED

    model = Model(labelled or LABELLED)

    @pandas_udf("string")
    def made(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([model.extract(p) for p in pages], dtype=object)
    return made(page)
