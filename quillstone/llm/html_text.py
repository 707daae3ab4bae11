"""HTML main text by a tree-structured graphical model.

A page's elements and runs of text are the nodes of a tree. Each is content or not. A node's own potential comes from
its features: its tag, words in its class, id and role, link density, length, sentences, where it stands to the page's
long texts, whether its text comes again or is the page's title, and words that notices use. A potential between parent
and child ties labels together, by the child's kind of tag. Sum-product messages pass upward and then downward, and give
each node's exact marginal. Runs of text whose marginal says content are joined into blocks. Both potentials are trained
here, once in a driver, on pages that a seeded writer makes with labels, in many layouts: with and without telling class
names, with misleading ones, and without any.

Block tags and list items begin a new block; inline tags and line breaks don't. Scripts, styles, templates, comments
and form controls never carry text; what stands in noscript does. Character references are decoded, white space inside a
block becomes one space.

A null or empty page has the empty text. Unclosed, stray and deeply nested tags are taken as they come; the work grows
with the page's length, as open tags are found by their names, and no page is cut. Repeated rows give repeated results,
no rows none. Nothing is shuffled, so no key can be hot. Extra columns pass through; one named like an added column is
replaced.
"""

from __future__ import annotations

import html
import math
import random
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import slices, with_columns

TRAIN_PAGES = 1200
TRAIN_SEED = 7

# Fixed sets of tag names.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style template svg iframe object textarea select button title".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SCOPES = set("article aside body div section main table td th li blockquote header footer nav form figure ul ol dl html".split())
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("thead", "tr", "td", "th")}
SAME_STOP = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",), "thead": ("table",), "tbody": ("table",)}

# Fixed words of class, id and role values that tell what an element is for.
AWAY = "nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead banner footer foot sidebar aside rail widget ad ads advert adverts advertisement sponsor sponsored promo promoted cookie cookies consent notice notices alert gdpr popup modal overlay newsletter subscribe signup login search share sharing social related recommended comment comments reply replies respond response responses discussion feedback disqus form copyright legal disclaimer pagination pager tags complementary contentinfo skip toolbar outbrain taboola".split()
TOWARD = "article articlebody content contents main post entry story body text page single prose".split()

#: Elements that are seldom an article's.
MARGINS = set("nav header footer aside form dialog menu".split())
#: Words that an article's paragraphs may well be marked with, too.
WEAK = "related notice form share legal tags".split()
# Fixed words of short texts that are notices, menus or calls.
NOTICE = re.compile(r"\u00a9|\b(?:copyright|all rights reserved|cookies?|privacy|subscribe|newsletter|sign (?:up|in)|log ?in|advertisement|sponsored|menu|home|share|reply|terms|contact us|read more|skip to)\b", re.IGNORECASE)
TITLE = re.compile(r"<title[^>]*>([^<]*)", re.IGNORECASE)
ENDS = re.compile(r"[.!?]")

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>|<(/?)([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)", re.DOTALL)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+)", re.IGNORECASE)
WORDS = re.compile(r"[A-Za-z]+")


class Node:
    __slots__ = ("tag", "cues", "parent", "text", "link", "words", "ends", "place", "says", "again", "titled", "inside")

    def __init__(self, tag: str, cues: tuple[str, ...], parent: int) -> None:
        self.tag, self.cues, self.parent = tag, cues, parent
        self.text = self.link = self.words = self.ends = 0
        self.place, self.says, self.again, self.titled, self.inside = 3, False, False, False, 0


class _Open:
    """The stack of open nodes, with the depths of each tag."""

    def __init__(self, nodes: list[Node]) -> None:
        self.nodes, self.stack, self.depths, self.scopes = nodes, [0], {}, [0]

    def push(self, i: int) -> None:
        tag = self.nodes[i].tag
        self.depths.setdefault(tag, []).append(len(self.stack))
        if tag in SCOPES:
            self.scopes.append(len(self.stack))
        self.stack.append(i)

    def last(self, tag: str) -> int:
        """The depth of the innermost open one, or 0."""
        own = self.depths.get(tag)
        return own[-1] if own else 0

    def first_above(self, tag: str, depth: int) -> int:
        """The depth of the outermost open one further in than depth, or 0."""
        own = self.depths.get(tag, [])
        at = bisect_right(own, depth)
        return own[at] if at < len(own) else 0

    def pop_to(self, depth: int) -> bool:
        """Closes all from a depth on; whether that is the border of a block."""
        block = False
        while len(self.stack) > depth:
            tag = self.nodes[self.stack.pop()].tag
            self.depths[tag].pop()
            if tag in SCOPES:
                self.scopes.pop()
            block |= tag not in INLINE
        return block


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """The nodes in page order (parents first), and the events: (node, text) for text, (-1, "") for a block's border."""
    nodes = [Node("#root", (), -1)]
    open_ = _Open(nodes)
    events: list[tuple[int, str]] = []
    endless: set[str] = set()  # tags that nothing further on closes
    run = -1  # the text node that goes on
    at, size = 0, len(page)

    def pop_to(depth: int) -> None:
        nonlocal run
        if open_.pop_to(depth):
            events.append((-1, ""))
        run = -1

    def add_text(raw: str) -> None:
        nonlocal run
        if not raw:
            return
        if run < 0:
            if raw.isspace():
                events.append((0, raw))
                return
            nodes.append(Node("#text", (), open_.stack[-1]))
            run = len(nodes) - 1
        events.append((run, raw))

    while at < size:
        m = TOKEN.search(page, at)
        if not m:
            add_text(html.unescape(page[at:]))
            break
        if m.start() > at:
            add_text(html.unescape(page[at : m.start()]))
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        tag, closing = name.lower(), (m[1] or m[4]) == "/"
        if closing:
            depth = open_.last(tag) if tag not in VOID else 0
            if depth and not (tag in INLINE and open_.scopes[-1] > depth):
                pop_to(depth)
            continue
        if tag in RAW:
            attributes = m[3] or ""
            if not attributes.endswith("/") or tag != "svg":
                end = None if tag in endless else re.compile(f"</{re.escape(tag)}[^>]*>", re.IGNORECASE).search(page, at)
                if not end:
                    endless.add(tag)
                # an unclosed one of these hides the rest of the page only where a browser reads it as raw text
                at = end.end() if end else (size if tag in ("script", "style", "textarea", "title", "template", "iframe") else at)
            continue
        if tag in VOID:
            if tag == "br":
                add_text(" ") if run >= 0 else events.append((0, " "))
            elif tag == "hr":
                events.append((-1, ""))
                run = -1
            continue
        if tag in CLOSES_P and open_.last("p") > open_.scopes[-1]:
            pop_to(open_.last("p"))
        if tag in SAME:
            stop = max(map(open_.last, SAME_STOP[tag]))
            low = min((d for d in (open_.first_above(t, stop) for t in SAME[tag]) if d), default=0)
            if low:
                pop_to(low)
        if tag not in INLINE:
            events.append((-1, ""))
        cues: tuple[str, ...] = ()
        if m[3]:
            cues = tuple(w for _, v in ATTRIBUTE.findall(m[3]) for w in WORDS.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", v).lower()))
        nodes.append(Node(tag, cues, open_.stack[-1]))
        if not ((m[3] or "").endswith("/") and tag in INLINE):
            open_.push(len(nodes) - 1)
        run = -1
    return nodes, events


#: A text of so many words, with a sentence's end, is a long one.
LONG_WORDS = 12


def measure(nodes: list[Node], events: list[tuple[int, str]], title: str = "") -> None:
    """Sums up what the features of each node need: characters, those in links, words, sentences, place and repetition."""
    said: dict[int, list[str]] = {}
    for i, text in events:
        if i > 0:
            said.setdefault(i, []).append(text)
    texts = {i: " ".join("".join(parts).split()) for i, parts in said.items()}
    times = Counter(texts.values())
    title = " ".join(html.unescape(title).split())
    for i, text in texts.items():
        node = nodes[i]
        node.text, node.words, node.ends = len(text), text.count(" ") + 1, len(ENDS.findall(text))
        node.again = times[text] > 1
        node.titled = bool(title) and node.words > 1 and (text == title or title.startswith(text) or text.startswith(title))
        node.says = node.words <= 40 and bool(NOTICE.search(text))
    linked = [False] * len(nodes)
    for i in range(1, len(nodes)):
        node, up = nodes[i], nodes[i].parent
        linked[i] = node.tag == "a" or linked[up]
        node.inside = 1 if node.tag in ("article", "main") else 2 if node.tag in MARGINS else nodes[up].inside
    long_ = [i for i in texts if nodes[i].words >= LONG_WORDS and nodes[i].ends and not linked[i]]
    first, last = (long_[0], long_[-1]) if long_ else (0, 0)
    from_, to = list(range(len(nodes))), list(range(len(nodes)))  # the nodes that each one spans
    for i in range(len(nodes) - 1, 0, -1):
        node = nodes[i]
        if node.tag == "a":
            node.link = node.text
        up = nodes[node.parent]
        up.text += node.text
        up.link += node.link
        up.words += node.words
        up.ends += node.ends
        up.says |= node.says and up.words <= 80
        to[node.parent] = max(to[node.parent], to[i])
        if long_:
            node.place = 0 if to[i] < first else 2 if from_[i] > last else 1


_TAGS = sorted(VOID | INLINE | CLOSES_P | SCOPES | set(SAME) | {"#text", "#root", "html", "body", "head", "noscript"})
_AWAY, _TOWARD, _WEAK = set(AWAY), set(TOWARD), set(WEAK)
_NAMES = [*(f"tag {t}" for t in _TAGS), "tag other", *(f"text in {t}" for t in _TAGS), "text in other", *(f"cue {w}" for w in AWAY + TOWARD), "any away", "any toward", "no cue", *(f"link {i}" for i in range(4)), *(f"size {i}" for i in range(6))]
_NAMES += [f"{what} {i}" for what in ("text", "node") for i in range(24)] + [f"{what} {i}" for what in ("says", "again", "titled", "long cue", "text inside", "node inside") for i in range(4)]
FEATURES = {name: i for i, name in enumerate(_NAMES)}


def features(nodes: list[Node], i: int) -> list[int]:
    """The places of a node's features."""
    f, node = FEATURES, nodes[i]
    out = [f.get(f"tag {node.tag}", f["tag other"])]
    away = False
    for w in set(node.cues):
        if w in _AWAY or w in _TOWARD:
            out.append(f[f"cue {w}"])
            away |= w in _AWAY
    if away:
        out.append(f["any away"])
        if node.words >= LONG_WORDS and node.ends and not node.link:  # a paragraph, whatever it is called
            out.append(f[f"long cue {2 * (node.tag == 'p') + all(w in _WEAK for w in node.cues if w in _AWAY)}"])
    elif any(w in _TOWARD for w in node.cues):
        out.append(f["any toward"])
    else:
        out.append(f["no cue"])
    share = node.link / node.text if node.text else 0.0
    out.append(f[f"link {min(3, math.ceil(share * 3))}"])
    out.append(f[f"size {min(5, len(str(node.text)) - 1 if node.text else 0)}"])
    long_ = 0 if node.words < 4 else 1 if node.words < LONG_WORDS else 2
    text = node.tag == "#text"
    out.append(f[f"{'text' if text else 'node'} {node.place * 6 + long_ * 2 + (node.ends > 0)}"])
    out.append(f[f"{'text' if text else 'node'} inside {node.inside}"])
    for what in ("says", "again", "titled"):
        if getattr(node, what):
            out.append(f[f"{what} {node.place}"])
    if text:
        out.append(f.get(f"text in {nodes[node.parent].tag}", f["text in other"]))
    return out


def kind(tag: str) -> int:
    """The kind of tag that a pair potential belongs to."""
    return 0 if tag == "#text" else 1 if tag in INLINE else 2 if tag in ("p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "td", "th", "tr", "blockquote", "pre", "dd", "dt", "ul", "ol") else 3


class TreeModel:
    """Unary weights and pair potentials: (child's kind, parent label, child label), in logs."""

    def __init__(self, weights: np.ndarray, pairs: np.ndarray) -> None:
        self.weights, self.pairs = weights.tolist(), pairs.tolist()

    def marginals(self, nodes: list[Node]) -> list[float]:
        """The probability that each node is content."""
        n, weights, pairs = len(nodes), self.weights, self.pairs
        # odds in logs: up[i] is what a node's own features and all below it say
        up = [sum([weights[f] for f in features(nodes, i)]) for i in range(n)]
        message = [0.0] * n
        for i in range(n - 1, 0, -1):
            message[i] = _pass(pairs[kind(nodes[i].tag)], up[i], False)
            up[nodes[i].parent] += message[i]
        belief = up
        for i in range(1, n):
            # what the parent believes without this child, sent down
            above = belief[nodes[i].parent] - message[i]
            belief[i] += _pass(pairs[kind(nodes[i].tag)], above, True)
        return [1 / (1 + math.exp(-max(-60.0, min(60.0, b)))) for b in belief]


def _soft(a: float, b: float) -> float:
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


def _pass(pair: list[list[float]], odds: float, down: bool) -> float:
    """The log odds that a message carries over a pair potential (parent label, child label)."""
    if down:
        return _soft(pair[1][1] + odds, pair[0][1]) - _soft(pair[1][0] + odds, pair[0][0])
    return _soft(pair[1][1] + odds, pair[1][0]) - _soft(pair[0][1] + odds, pair[0][0])


#: Beginnings of words that a page's invented words are made of; another list makes another language.
SYLLABLES = "ba be bi da do fe ga ho ju ka la le li ma me mi na no pa po ra re ri sa so ta te ti to va".split()
NOTICES = ["We use cookies", "All rights reserved", "Subscribe to our newsletter", "Advertisement", "Sponsored", "Privacy", "Log in", "Share", "Home", "Menu", "Terms", "Read more"]


def labelled_page(rng: random.Random, syllables: list[str] = SYLLABLES) -> str:
    """A page of a random layout; what is content lies in elements with the attribute data-y="1", the rest in "0".

    A third of the pages have telling class names, a third others and misleading ones, and a third none at all.
    """
    naming, title = rng.choice(["telling", "other", "none"]), ""

    def words(a: int, b: int) -> str:
        return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(a, b))).capitalize()

    def sentences(a: int, b: int) -> str:
        left, out = rng.randint(a, b), []
        while left > 0:
            n = min(left, rng.randint(4, 18))
            out.append(words(n, n) + rng.choice([".", ".", ".", "!", "?"]))
            left -= n
        return " ".join(out)

    def named(cue: str) -> str:
        if naming == "none" or not cue:
            return ""
        if naming == "other":
            cue = rng.choice([words(1, 1).lower(), words(1, 1).lower(), cue])
        return f' {rng.choice(["class", "id", "class"])}="{cue}{rng.choice(["", "", "-wrap", "_block", " clearfix", "-1"])}"'

    def box(tag: str, cue: str, inner: str, y: int) -> str:
        return f'<{tag} data-y="{y}"{named(cue)}>{inner}</{tag}>'

    brief = rng.random() < 0.25  # a page of short texts only

    def para() -> str:
        t = sentences(*rng.choice([(1, 1), (1, 4), (1, 9)] if brief else [(1, 4), (3, 80), (10, 80), (10, 80), (80, 300)]))
        if rng.random() < 0.25:
            t += f" <{(w := rng.choice(['b', 'em', 'strong', 'i', 'span', 'code']))}>{words(1, 6)}</{w}> " + rng.choice([".", sentences(1, 20)])
        if rng.random() < 0.25:
            t += f' <a href="/x">{words(1, 5)}</a> ' + sentences(2, 20)
        if rng.random() < 0.06:  # articles speak of such things, too
            t += f" {words(1, 3)} {rng.choice(NOTICES).lower()} {words(0, 3)}."
        return rng.choice(NOTICES) + "." if rng.random() < 0.02 else t

    def links(tag: str = "ul") -> str:
        item = "li" if tag == "ul" else rng.choice(["div", "span", "p"])
        ends = rng.choice([("",), ("",), ("", ".", ",", "?")])
        return f"<{tag}>" + "".join(f"<{item}><a href='/{i}'>{words(1, 3)}{rng.choice(ends)}</a></{item}>" for i in range(rng.randint(2, 9))) + f"</{tag}>"

    def lines() -> str:
        """A menu without links."""
        item = rng.choice(["div", "span", "li", "p"])
        return "".join(f"<{item}>{rng.choice([words(1, 2), words(1, 2), rng.choice(NOTICES)])}</{item}>" for _ in range(rng.randint(1, 6)))

    def notice() -> str:
        return rng.choice([f"{rng.choice(NOTICES)} {words(1, 12)}.", f"&copy; {words(1, 6)} 20{rng.randint(10, 30)}", f"Copyright {words(1, 6)}", rng.choice(NOTICES), f"<p>{rng.choice(NOTICES)}. {sentences(2, 16)}</p>"])

    def talk() -> str:
        """What readers write."""
        return "".join(f"<div><b>{words(1, 2)}</b><p>{sentences(3, 40)}</p>{rng.choice(['', '<span>Reply</span>'])}</div>" for _ in range(rng.randint(1, 6)))

    def away(after: bool = False) -> str:
        tag = rng.choice(["div", "div", "section", "aside"]) if naming != "none" else "div"
        cue = rng.choice(AWAY)
        if rng.random() < 0.06:  # crumbs and adverts that repeat the title
            return box(tag, cue, rng.choice([title, f'<a href="/">{words(1, 1)}</a> &gt; {title}', f"<p>{title}</p>", f'<ul><li><a href="/t">{title}</a></li></ul>']), 0)
        if naming == "telling":
            if rng.random() < 0.15:
                return box(rng.choice(["p", "span"]), cue, rng.choice([words(1, 8), sentences(2, 10)]), 0)
            inner = rng.choice([lambda: sentences(2, 30), links, lambda: f"<p>{sentences(3, 40)}</p>", lambda: f"<h3>{words(1, 4)}</h3>" + links(), lines, notice] + [talk] * 2)()
            return box(tag, rng.choice(["comments", "responses", "reader responses", "discussion", cue]) if after and rng.random() < 0.3 else cue, inner, 0)
        return box(tag, cue, rng.choice([links, lambda: links("div"), lines, notice, notice, lambda: f"<h3>{words(1, 4)}</h3>" + links()])(), 0)

    def plain_away() -> str:
        if naming == "none" and rng.random() < 0.7:
            return away()
        tag = rng.choice(["nav", "footer", "header", "aside", "form", "nav", "footer", "dialog", "menu"])
        inner = {"nav": links, "form": lambda: f"<label>{words(1, 3)}</label><input><p>{sentences(1, 9)}</p>", "menu": links}.get(tag, lambda: rng.choice([sentences(2, 30), f"<p>{sentences(2, 30)}</p>", links(), lines(), f"<h2>{words(1, 4)}</h2>{links()}", notice()]))()
        return box(tag, rng.choice(["", "", rng.choice(AWAY)]), inner, 0)

    def content(title: str) -> str:
        head = rng.choice(["h1", "h1", "h1", "h2", "div"])
        parts = [f"<{head}>{title}</{head}>"] if rng.random() < 0.8 else []
        for _ in range(rng.choice([1, 1, 2, 4, 8, 16])):
            misleading = f' class="{rng.choice(WEAK)}"' if rng.random() < 0.06 else ""
            some = [lambda m=misleading: f"<p{m}>{sentences(20, 90) if m else para()}</p>"] * 6
            some += [lambda: f"<h2>{words(1, 6)}</h2>", lambda: "<ul>" + "".join(f"<li>{rng.choice([para(), words(1, 4)])}</li>" for _ in range(rng.randint(2, 5))) + "</ul>", lambda: f"<blockquote><p>{para()}</p></blockquote>", lambda: f"<table><tr><td>{words(1, 4)}</td><td>{words(1, 9)}</td></tr></table>", lambda: f"<div><p>{para()}</p></div>", lambda: f"<div>{para()}</div>", lambda: f"<pre>{words(2, 30)}</pre>"]
            some += [lambda: f"<section><h3>{words(1, 4)}</h3><p>{para()}</p></section>", lambda: f"<figure><figcaption>{words(2, 12)}</figcaption></figure>", lambda: f"<p><b>{para()}<br>", lambda: f"<noscript><p>{para()}</p></noscript>", lambda: f"<noscript>{para()}</noscript>"]
            parts.append(rng.choice(some)())
            if rng.random() < 0.12:
                parts.append(rng.choice([away, plain_away])())
        return "".join(parts)

    title = words(2, 10)
    if rng.random() < 0.12:  # nothing but an article, maybe deep in plain frames
        brief, n = rng.random() < 0.7, rng.randint(0, 12)
        only = box(rng.choice(["article", "article", "main"]), "", rng.choice([f"<p>{para()}</p>", f"<p>{words(1, 2)}</p>", content(title)]), 1)
        return "<html><head></head><body>" + '<div data-y="2">' * n + only + "</div>" * n + "</body></html>"
    tag = rng.choice(["article", "article", "article", "main", "div", "div", "section"]) if naming != "none" else rng.choice(["article", "div", "div", "main"])
    cue = rng.choice(["", rng.choice(TOWARD)]) if tag in ("article", "main") else rng.choice(TOWARD)
    main = box(tag, cue, content(title), 1)
    for _ in range(rng.choice([0, 0, 1, 2])):
        main = box(rng.choice(["div", "main", "section"]), rng.choice(["", "", "container", "wrapper", "main", "content", "page"]), rng.choice(["", away()]) + main + rng.choice(["", away(True), plain_away()]), 2)
    before = "".join(rng.choice([away, plain_away])() for _ in range(rng.randint(0, 3)))
    after = "".join(rng.choice([lambda: away(True), plain_away])() for _ in range(rng.randint(0, 4)))
    stray = rng.choice(["", "", "", words(2, 6), f"<noscript>{words(3, 9)}</noscript>" if rng.random() < 0.5 else ""])
    return f"<!DOCTYPE html><html><head><title>{rng.choice([title, title, words(1, 4), title + ' | ' + words(1, 2)])}</title></head><body>{stray}{before}{main}{after}</body></html>"


def title_of(page: str) -> str:
    m = TITLE.search(page)
    return m[1] if m else ""


def _labels(page: str) -> tuple[list[Node], list[int]]:
    """The nodes of a labelled page with their labels, 1 or 0.

    A frame around content (2) counts as content, but what it holds without a mark of its own doesn't.
    """
    marks = [m[1] for m in re.finditer(r"<[a-z0-9]+(?: data-y=\"([012])\")?", page.split("<body>", 1)[1])]
    nodes, events = parse(page)
    measure(nodes, events, title_of(page))
    label: list[int] = []
    for i, node in enumerate(nodes):
        up = label[node.parent] if i else 2
        if node.tag in ("#root", "html", "body"):
            label.append(2)
            continue
        mark = marks.pop(0) if node.tag not in ("#text", "head") else None
        label.append(int(mark) if mark and up else up % 2)
    return nodes, [int(x > 0) for x in label]


@lru_cache(maxsize=4)
def train(pages: int = TRAIN_PAGES, seed: int = TRAIN_SEED) -> TreeModel:
    """Trains on so many labelled pages; the same model for the same arguments."""
    rng = random.Random(seed)
    n = len(FEATURES)
    rows: list[int] = []
    cols: list[int] = []
    labels: list[int] = []
    parents: list[int] = []
    depths: list[int] = []
    kinds: list[int] = []
    for _ in range(pages):
        page = re.sub(r"<label>.*?</label>|<(?:br|input)>", "", labelled_page(rng))  # what makes no nodes
        nodes, label = _labels(page)
        base = len(labels)
        for i, node in enumerate(nodes):
            own = features(nodes, i)
            rows += [base + i] * len(own)
            cols += own
            labels.append(label[i])
            parents.append(base + node.parent if i else -1)
            depths.append(depths[base + node.parent] + 1 if i else 0)
            kinds.append(kind(node.tag))
    y, at, to = np.array(labels, float), np.array(rows), np.array(cols)
    up, k, depth = np.array(parents), np.array(kinds), np.array(depths)
    levels = [np.flatnonzero(depth == d) for d in range(1, depth.max() + 1)]
    child = np.flatnonzero(up >= 0)
    w, step = np.zeros(n + 8), np.zeros(n + 8)
    seen = np.zeros(n + 8)
    seen[:n] = np.bincount(to, y[at], n)
    seen[n : n + 4] = np.bincount(k[child], y[child] * y[up[child]], 4)
    seen[n + 4 :] = np.bincount(k[child], y[up[child]], 4)
    for _ in range(250):  # exact gradients of the trees' likelihood, from the marginals of nodes and edges
        belief = np.bincount(at, w[to], len(y))
        u, v, message = w[n + k], w[n + 4 + k], np.zeros(len(y))
        for own in reversed(levels):
            c = belief[own]
            message[own] = v[own] + np.logaddexp(0, c + u[own]) - np.logaddexp(0, c)
            np.add.at(belief, up[own], message[own])
        below = belief.copy()
        above = np.zeros(len(y))
        for own in levels:
            above[own] = belief[up[own]] - message[own] + v[own]
            belief[own] += np.logaddexp(0, above[own] + u[own]) - np.logaddexp(0, above[own])
        p = 1 / (1 + np.exp(-np.clip(belief, -60, 60)))
        a, c = above[child], below[child]
        both = np.exp(a + c + u[child] - np.logaddexp(np.logaddexp(0, c), np.logaddexp(a, a + c + u[child])))
        want = np.concatenate([np.bincount(to, p[at], n), np.bincount(k[child], both, 4), np.bincount(k[child], p[up[child]], 4)])
        slope = seen - want - 0.2 * w
        step += slope * slope
        w += 4.0 * slope / np.sqrt(step + 1e-9)
    pairs = np.zeros((4, 2, 2))
    pairs[:, 1, :] = w[n + 4 :, None]
    pairs[:, 1, 1] += w[n : n + 4]
    return TreeModel(w[:n], pairs)


def extract_page(page: str | None, model: TreeModel) -> str:
    """The main text of one page, a line a block."""
    if not page:
        return ""
    nodes, events = parse(page)
    measure(nodes, events, title_of(page))
    content = [p > 0.5 for p in model.marginals(nodes)]
    blocks, parts = [], []
    for i, text in [*events, (-1, "")]:
        if i < 0:
            if block := " ".join("".join(parts).split()):
                blocks.append(block)
            parts = []
        elif i == 0:
            parts.append(text)
        elif content[i]:
            parts.append(text)
    return "\n".join(blocks)


def extract(df: DataFrame, page: str = "html", out: str = "text", pages: int = TRAIN_PAGES) -> DataFrame:
    """Adds the main text of each page, and its code points as n_chars."""
    model = df.sparkSession.sparkContext.broadcast(train(pages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, page):
            texts = [extract_page(x, model.value) for x in batch.column(page).to_pylist()]
            yield with_columns(batch, [out, "n_chars"], [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())])

    return df.mapInArrow(run, T.StructType([f for f in df.schema.fields if f.name.lower() not in (out.lower(), "n_chars")] + [T.StructField(out, T.StringType()), T.StructField("n_chars", T.LongType())]))
