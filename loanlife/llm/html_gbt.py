"""Main-text extraction: gradient-boosted trees over DOM nodes, decoded down the tree.

A page is parsed into block elements.  Inline and unknown elements belong to the block they
stand in, but those that are hidden or whose attributes tell of adverts or notices are
nodes of their own within its line.  Boosted trees estimate from each block's features (tag, attribute
tokens of itself and its ancestors, text and link density of its subtree, depth,
siblings) whether it holds main text.  Decoding picks the most likely choice in
which a block is kept only if its parent is, so that an ancestor and a
descendant never contradict each other.

The trees are trained on a labelled table of pages drawn by rule
(``labelled_pages``: layouts, wrappers and boilerplate in many variants); its
size is a parameter.  The given pages are not needed for training.

Defined results
* null and empty html give an empty text; markup without an end, without a body or cut
  off inside a tag is read as far as it goes;
* character references are decoded, white space in a block becomes one space, blocks are
  joined by a line break in page order; ``br`` is white space; nothing else is dropped or capped;
* scripts, styles, templates, comments, frames and the head never give text; formulas, drawings and
  the fallback text of objects, media and ``noscript`` are text like any other;
* a self-closed element within ``svg`` or ``math``, or one of these two, ends where it stands;
* a page is processed whole in time linear in its length, however deep it nests;
* rows stay one to one, repeated rows included; extra columns pass through, an output
  column whose name is taken gets a leading underscore; empty tables give empty results.
"""

from __future__ import annotations

import html as html_escapes
import math
import random
import re
from collections import defaultdict
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from loanlife.llm.common import free_name

# Element kinds of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("head title script style template iframe".split())
FOREIGN = ("svg", "math")
BLOCKS = frozenset(
    "html body address article aside blockquote button center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr label legend li main menu nav ol option p pre section select "
    "summary table tbody td textarea tfoot th thead tr ul".split()) | SILENT
NO_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
CLOSES = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
          "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
          "option": (("option",), ("select",))}
GROUPS = (("nav", "menu"), ("header",), ("footer",), ("aside",), ("form", "fieldset", "legend"), ("article",), ("main",),
          ("section",), ("div", "center", "details", "summary", "dialog"), ("p",), ("h1",), ("h2", "h3", "h4", "h5", "h6", "hgroup"),
          ("ul", "ol", "dl"), ("li", "dt", "dd"), ("table", "tbody", "thead", "tfoot", "tr"), ("td", "th"),
          ("button", "select", "option", "label", "textarea"), ("blockquote", "pre", "address"),
          ("figure", "figcaption"), ("html", "body"))
GROUP_OF = {tag: i for i, tags in enumerate(GROUPS) for tag in tags}
# Attribute tokens that make a node of an element inside a block (a span, a custom element).
INLINE_TELLING = frozenset("ad ads advert advertisement adbox adslot adsbygoogle banner sponsor sponsored promo promotion "
                           "cookie consent newsletter subscribe share sharing".split())
LANDMARKS = ("nav", "header", "footer", "aside", "form", "article", "main")

TREES, DEPTH, RATE, BINS = 60, 5, 0.2, 32
TRAINING_PAGES = 900

_token = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_space = re.compile(r"\s+")


class Dom(HTMLParser):
    """Blocks in page order as parallel lists, and the page's text events."""

    def __init__(self, source: str):
        super().__init__(convert_charrefs=True)
        self.tags, self.parents, self.tokens, self.labels = ["html"], [-1], [[]], [None]
        self.events: list[tuple[int, str | None]] = []       # (block, text); None ends a run of text
        self.links: list[int] = []                           # characters in links, by event
        self.stack: list[tuple[str, int]] = [("html", 0)]    # open elements with their block
        self.open_at: dict[str, list[int]] = defaultdict(list)
        self.open_blocks = [0]
        self.silent = 0
        self.feed(source)
        self.close()

    def _pop_to(self, index: int) -> None:
        while len(self.stack) > index:
            tag, block = self.stack.pop()
            self.open_at[tag].pop()
            if tag in BLOCKS:
                self.open_blocks.pop()
                if tag not in SILENT:
                    self.events.append((block, None))
                self.silent -= tag in SILENT

    def _last(self, tags) -> int:
        return max((self.open_at[t][-1] for t in tags if self.open_at[t]), default=-1)

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body") and tag in self.tags[:3] and (tag == "html" or self.open_at["body"]):
            return
        if tag == "body":
            self._pop_to(1)
        if tag in NO_PARAGRAPH and self.open_at["p"]:
            self._pop_to(self._last(("p",)))
        if tag in CLOSES:
            same, scope = CLOSES[tag]
            at = self._last(same)
            if at > self._last(scope):
                self._pop_to(at)
        block = self.stack[-1][1]
        if tag in BLOCKS and tag not in SILENT:
            self.events.append((block, None))
        elif tag == "br":
            self.events.append((block, " "))
        told = dict(attrs)
        words = " ".join(told.get(a) or "" for a in ("class", "id", "role", "aria-label", "itemprop"))
        hidden = "hidden" in told or "display:none" in (told.get("style") or "").replace(" ", "").lower()
        tokens = [t.lower() for t in _token.findall(words)] + ["hidden"] * hidden
        if tag in BLOCKS or tag not in VOID and (hidden or not INLINE_TELLING.isdisjoint(tokens)):
            self.tokens.append(tokens)
            self.labels.append(told.get("data-main"))
            self.tags.append(tag)
            self.parents.append(block)
            block = len(self.tags) - 1
        if tag in VOID:
            return
        self.open_at[tag].append(len(self.stack))
        self.stack.append((tag, block))
        if tag in BLOCKS:
            self.open_blocks.append(len(self.stack) - 1)
            self.silent += tag in SILENT

    def handle_startendtag(self, tag, attrs):
        ends_here = tag not in VOID and (tag in FOREIGN or any(self.open_at[t] for t in FOREIGN))
        self.handle_starttag(tag, attrs)
        if ends_here and len(self.stack) > 1 and self.stack[-1][0] == tag:
            self._pop_to(len(self.stack) - 1)

    def handle_endtag(self, tag):
        at = self.open_at[tag][-1] if self.open_at[tag] else -1
        if at > 0 and (tag in BLOCKS or self.open_blocks[-1] < at):
            self._pop_to(at)

    def handle_data(self, data):
        if not self.silent and data:
            self.links += [0] * (len(self.events) - len(self.links))
            self.events.append((self.stack[-1][1], data))
            self.links.append(len(data) if self.open_at["a"] else 0)


# ------------------------------------------------------------- features

def features(dom: Dom, token_scores: dict[str, float]) -> np.ndarray:
    """A row of numbers for each block."""
    n = len(dom.tags)
    own, link, stops, pieces = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    links = dom.links + [0] * (len(dom.events) - len(dom.links))
    at, position = 0, [-1] * n
    for (block, text), in_link in zip(dom.events, links, strict=True):
        if text is None:
            continue
        size = len(text) if not text.isspace() else 0
        if position[block] < 0:
            position[block] = at
        own[block] += size
        link[block] += in_link
        stops[block] += text.count(". ") + text.count(",") + text.endswith((".", "!", "?"))
        pieces[block] += 1
        at += size
    parents = np.array(dom.parents)
    count, kids, paragraphs = np.ones(n), np.zeros(n), np.array([t == "p" for t in dom.tags], dtype=float)
    text, in_links, marks = own.copy(), link.copy(), stops.copy()
    depth, order, group = np.zeros(n), np.zeros(n), np.array([GROUP_OF.get(t, -1) for t in dom.tags], dtype=float)
    same = defaultdict(int)
    for i in range(n - 1, 0, -1):
        p = parents[i]
        text[p] += text[i]
        in_links[p] += in_links[i]
        marks[p] += marks[i]
        count[p] += count[i]
        paragraphs[p] += paragraphs[i]
        kids[p] += 1
        if position[i] >= 0 and (position[p] < 0 or position[i] < position[p]):
            position[p] = position[i]
    score = np.array([min((token_score(t, token_scores) for t in ts), default=0.0) for ts in dom.tokens])
    top = np.array([max((token_score(t, token_scores) for t in ts), default=0.0) for ts in dom.tokens])
    above_low, above_high = np.zeros(n), np.zeros(n)
    landmark = np.full(n, -1.0)
    number = defaultdict(int)
    for i in range(1, n):
        p = parents[i]
        depth[i] = min(depth[p] + 1, 12)
        order[i] = number[p]
        number[p] += 1
        same[(p, dom.tags[i])] += 1
        above_low[i] = min(above_low[p], score[p])
        above_high[i] = max(above_high[p], top[p])
        tag = dom.tags[p]
        landmark[i] = LANDMARKS.index(tag) if tag in LANDMARKS else landmark[p]
    alike = np.array([same[(p, t)] for p, t in zip(dom.parents, dom.tags, strict=True)], dtype=float)
    whole = max(text[0], 1.0)
    up = np.maximum(parents, 0)
    previous, following = np.zeros(n), np.zeros(n)
    last: dict[int, int] = {}
    for i in range(1, n):
        p = parents[i]
        if p in last:
            previous[i], following[last[p]] = text[last[p]], text[i]
        last[p] = i
    per = np.maximum(text, 1.0)
    return np.stack([
        group, group[up], landmark, score, top, above_low, above_high, depth, order, kids[up], alike,
        np.log1p(own), np.log1p(text), text / whole, in_links / per, in_links[up] / per[up], np.log1p(text / count),
        np.log1p(count), paragraphs, marks / np.maximum(text / 50, 1), np.log1p(previous), np.log1p(following),
        np.array(position) / max(at, 1), text / per[up], np.full(n, np.log1p(whole))], axis=1)


def token_score(token: str, scores: dict[str, float]) -> float:
    """Score of a token, of its singular, or of the longest known token that it begins with."""
    if token in scores:
        return scores[token]
    if token.endswith("s") and token[:-1] in scores:
        return scores[token[:-1]]
    for end in range(len(token) - 1, 4, -1):
        if token[:end] in scores:
            return scores[token[:end]]
    return 0.0


# ---------------------------------------------------------------- trees

class Boosted:
    """Complete binary trees as arrays: feature and border of each inner node, value of each leaf."""

    def __init__(self, feature: np.ndarray, border: np.ndarray, value: np.ndarray, base: float):
        self.feature, self.border, self.value, self.base = feature, border, value, base

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, border, value in zip(self.feature, self.border, self.value, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > border[node])
            out += value[node - (2 ** DEPTH - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, trees: int = TREES) -> Boosted:
    """Logistic loss, second-order gains over feature histograms, levels grown together."""
    borders = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(b, c, side="left") for b, c in zip(borders, x.T, strict=True)], axis=1)
    width, inner = BINS, 2 ** DEPTH - 1
    base = math.log(y.mean() / (1 - y.mean()))
    odds = np.full(len(y), base)
    all_feature, all_border, all_value = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-odds))
        grad, hess = y - p, p * (1 - p)
        feature, border = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        node = np.zeros(len(y), dtype=np.int64)
        for level in range(DEPTH):
            first, nodes = 2 ** level - 1, 2 ** level
            best = np.full(nodes, 1e-6)
            for f in range(x.shape[1]):
                key = (node - first) * width + binned[:, f]
                g = np.bincount(key, grad, nodes * width).reshape(nodes, width).cumsum(axis=1)
                h = np.bincount(key, hess, nodes * width).reshape(nodes, width).cumsum(axis=1)
                all_g, all_h = g[:, -1:], h[:, -1:]
                gain = g ** 2 / (h + 1) + (all_g - g) ** 2 / (all_h - h + 1) - all_g ** 2 / (all_h + 1)
                gain[(h < 2) | (all_h - h < 2)] = 0
                cut = gain[:, :len(borders[f])].argmax(axis=1) if len(borders[f]) else np.zeros(nodes, dtype=int)
                value = gain[np.arange(nodes), cut]
                for k in np.flatnonzero(value > best):
                    best[k], feature[first + k], border[first + k] = value[k], f, borders[f][cut[k]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > border[node])
        leaf = node - inner
        value = RATE * np.bincount(leaf, grad, inner + 1) / (np.bincount(leaf, hess, inner + 1) + 1)
        odds += value[leaf]
        all_feature.append(feature)
        all_border.append(border)
        all_value.append(value)
    return Boosted(np.array(all_feature), np.array(all_border), np.array(all_value), base)


def decode(parents: list[int], odds: np.ndarray) -> list[bool]:
    """Most likely choice in which every kept block's parent is kept; the root is kept."""
    odds = np.clip(odds, -30, 30)
    keep, drop = -np.logaddexp(0, -odds), -np.logaddexp(0, odds)
    keep, drop = keep.tolist(), drop.tolist()
    for i in range(len(parents) - 1, 0, -1):
        keep[parents[i]] += max(keep[i], drop[i])
        drop[parents[i]] += drop[i]
    out = [True] * len(parents)
    for i in range(1, len(parents)):
        out[i] = out[parents[i]] and keep[i] >= drop[i]
    return out


def kept_text(dom: Dom, keep: list[bool]) -> str:
    out, run = [], []
    for block, text in dom.events:
        if text is not None:
            if keep[block]:
                run.append(text)
        elif run:
            line = _space.sub(" ", "".join(run)).strip()
            if line:
                out.append(line)
            run = []
    line = _space.sub(" ", "".join(run)).strip()
    return "\n".join(out + [line] if line else out)


# -------------------------------------------------------- labelled table

# Words that pages use for parts of them.
ASIDE_WORDS = ("ad ads advert advertisement adbox banner sponsor sponsored promo promotion cookie consent gdpr notice "
               "alert popup modal overlay newsletter subscribe signup login search share sharing social follow related "
               "recommended more trending popular sidebar widget rail menu navbar navigation nav breadcrumb pagination "
               "pager toolbar topbar masthead header footer copyright legal disclaimer comment comments reply replies "
               "discussion respond thread tags meta feedback contact form toc skip complementary contentinfo "
               "rating survey donate").split()
MAIN_WORDS = ("content article post entry story body text main maincontent hentry prose page single blog news "
              "articlebody postbody paragraph lead document").split()
NEUTRAL_WORDS = "container wrapper row col grid inner outer box wrap layout site section block item clearfix left right".split()


def drawn_page(rng: random.Random) -> str:
    """A page whose blocks carry their label in ``data-main``."""
    def word():
        return "".join(rng.choice("abcdefghijklmnoprstuvwzéöñ") for _ in range(rng.randint(1, 10)))

    def words(a, b):
        return " ".join(word() for _ in range(rng.randint(a, b)))

    def sentence(a=1, b=18):
        s = words(a, b).capitalize()
        if rng.random() < 0.2:
            s = s.replace(" ", ", ", 1)
        return s + rng.choice((".", ".", ".", "!", "?", ""))

    def prose():
        return html_escapes.escape(" ".join(sentence() for _ in range(rng.choice((1, 1, 1, 2, 4, 8, 15)))))

    def attrs(vocabulary, chance=0.8):
        out = ""
        if rng.random() < chance:
            names = rng.sample(vocabulary, 1) + rng.sample(NEUTRAL_WORDS, rng.choice((0, 0, 1)))
            names[0] += rng.choice(("", "", "", "s", "-box", "-" + rng.choice(NEUTRAL_WORDS), "_" + word()))
            rng.shuffle(names)
            out = f' {rng.choice(("class", "class", "class", "id"))}="{" ".join(names)}"'
        elif rng.random() < 0.4:
            out = f' class="{rng.choice(NEUTRAL_WORDS)}"'
        return out

    def el(tag, label, inner, attr=""):
        return f'<{tag} data-main="{label}"{attr}>{inner}</{tag}>'

    def link(a=1, b=4):
        return f'<a href="/{word()}">{words(a, b)}</a>'

    def menu(label=0):
        tag = rng.choice(("ul", "ul", "ol", "div"))
        item = "li" if tag != "div" else rng.choice(("div", "span"))
        items = "".join(el(item, label, link()) if item != "span" else f"<span>{link()}</span>"
                        for _ in range(rng.randint(2, 9)))
        return el(tag, label, items)

    def small():
        return el(rng.choice(("p", "div", "p")), 0, rng.choice((prose(), link(), words(1, 6), prose() + link())))

    def comments():
        one = lambda: el(rng.choice(("div", "li", "article")), 0,
                         el(rng.choice(("p", "div")), 0, rng.choice((words(1, 2), link())))
                         + "".join(el("p", 0, prose()) for _ in range(rng.randint(1, 3))),
                         rng.choice(("", f' class="{rng.choice(("comment", "reply", "user-comment"))}"')))
        title = el(rng.choice(("h2", "h3")), 0, words(1, 3)) if rng.random() < 0.7 else ""
        named = rng.choice(("comments", "comment-list", "replies", "discussion", "respond", "reader-comments"))
        return el(rng.choice(("div", "section", "aside")), 0, title + "".join(one() for _ in range(rng.randint(1, 6))),
                  f' {rng.choice(("class", "id"))}="{named}"')

    def form():
        return el("form", 0, el("label", 0, words(1, 3)) + '<input type="text">' + el("button", 0, words(1, 2))
                  + (el("p", 0, prose()) if rng.random() < 0.4 else ""), attrs(["search", "login", "newsletter", "contact"]))

    def boiler():
        kind = rng.randrange(10)
        if kind == 0:
            return el("nav", 0, menu(), attrs(ASIDE_WORDS, 0.4))
        if kind == 1:
            return el("div", 0, rng.choice((prose(), small(), small() + small())),
                      attrs(["ad", "ads", "advert", "banner", "sponsored", "promo", "ad-slot", "adsbygoogle"], 1))
        if kind == 2:
            return el("aside", 0, "".join(rng.choice((small, menu))() for _ in range(rng.randint(1, 3))), attrs(ASIDE_WORDS, 0.5))
        if kind == 3:
            return form()
        if kind == 4:
            return comments()
        if kind == 5:
            return el(rng.choice(("div", "section")), 0, "".join(rng.choice((small, small, menu, form))()
                      for _ in range(rng.randint(1, 3))), attrs(ASIDE_WORDS, 1))
        if kind == 6:
            return el("div", 0, prose() + rng.choice(("", el("button", 0, words(1, 2)))),
                      attrs(["cookie", "notice", "consent", "alert", "popup", "gdpr", "disclaimer"], 1))
        if kind == 7:
            return el("div", 0, menu(), attrs(["menu", "navigation", "related", "share", "social", "tags", "breadcrumb"], 1))
        if kind == 8:
            return el(rng.choice(("div", "p", "section")), 0, prose(), rng.choice((' style="display:none"', " hidden")))
        return f"<script>var x = '{word()}';</script>"

    def block():
        kind = rng.randrange(16)
        if kind < 8:
            inner = prose()
            if rng.random() < 0.25:
                inner += " " + link() + " " + prose()
            if rng.random() < 0.1:
                tag = rng.choice(("span", "span", "ins", "ad-unit", "em"))
                inner += el(tag, 0, rng.choice((words(1, 6), prose(), link())), rng.choice((" hidden", f' class="{rng.choice(inline)}"')))
                inner += " " + prose()
            return el("p", 1, inner, attrs(MAIN_WORDS, 0.1))
        if kind < 11:
            return f'<p data-main="1"><b>{prose()}<br>'
        if kind == 11:
            return el(rng.choice(("h2", "h3", "h4")), 1, words(1, 8))
        if kind == 12:
            return el(rng.choice(("ul", "ol")), 1, "".join(el("li", 1, prose()) for _ in range(rng.randint(1, 6))))
        if kind == 13:
            return el("blockquote", 1, rng.choice((prose(), el("p", 1, prose()))))
        if kind == 14:
            return el(rng.choice(("pre", "div")), 1, prose(), attrs(MAIN_WORDS, 0.3))
        rows = "".join(el("tr", 1, "".join(el("td", 1, words(1, 5)) for _ in range(3))) for _ in range(rng.randint(1, 4)))
        return rng.choice((el("table", 1, rows), el("figure", 1, "<img src='x.png'>" + el("figcaption", 1, prose()))))

    inline = sorted(INLINE_TELLING)
    title = rng.choice(("", *[el("h1", 1, prose() if rng.random() < 0.7 else words(1, 12))] * 5))
    if title and rng.random() < 0.15:
        title = el("header", 1, title)
    parts = [block() for _ in range(rng.choice((0, 1, 2, 3, 5, 8, 12, 20)))]
    for _ in range(rng.choice((0, 0, 0, 1, 2))):
        parts.insert(rng.randint(0, len(parts)), boiler())
    inner = title + "".join(parts)
    if rng.random() < 0.2:
        inner += comments()
    has_main = int('data-main="1"' in inner)
    wrapper = rng.randrange(8)
    if wrapper < 3:
        inner = el("article", has_main, inner, attrs(MAIN_WORDS, 0.4))
    elif wrapper < 5:
        inner = el("div", has_main, inner, attrs(MAIN_WORDS, 0.9))
    elif wrapper == 5:
        inner = el("section", has_main, inner, attrs(MAIN_WORDS, 0.7))
    elif wrapper == 6:
        inner = el("table", has_main, el("tr", has_main, el("td", 0, menu()) + el("td", has_main, inner)))
    if rng.random() < 0.3:
        inner = el("main", has_main, inner, attrs(MAIN_WORDS, 0.3))
    before = "".join(boiler() for _ in range(rng.choice((0, 1, 2, 3))))
    after = "".join(boiler() for _ in range(rng.choice((0, 0, 1, 2))))
    if rng.random() < 0.5:
        before = el("header", 0, rng.choice((el("h1", 0, words(1, 3)), el("p", 0, words(1, 6)), link()))
                    + (el("nav", 0, menu()) if rng.random() < 0.6 else ""), attrs(ASIDE_WORDS, 0.3)) + before
    if rng.random() < 0.75:
        after += el("footer", 0, rng.choice((f"&copy; {word()}.example &middot; {prose()}", el("p", 0, prose()), menu(),
                                            el("div", 0, small() + menu()))), attrs(ASIDE_WORDS, 0.3))
    body = before + inner + after
    if rng.random() < 0.4:
        body = el("div", has_main, body, attrs(NEUTRAL_WORDS, 0.8))
    return f'<!DOCTYPE html><html><head><title>{words(2, 8)}</title></head><body data-main="1">{body}</body></html>'


def labelled_pages(spark: SparkSession, pages: int = TRAINING_PAGES, seed: int = 11) -> DataFrame:
    rng = random.Random(seed)
    return spark.createDataFrame([(i, drawn_page(rng)) for i in range(pages)], "page int, html string")


class Model:
    def __init__(self, token_scores: dict[str, float], trees: Boosted):
        self.token_scores, self.trees = token_scores, trees

    def extract(self, pages: list[str | None]) -> list[str]:
        doms = [Dom(p or "") for p in pages]
        if not doms:
            return []
        odds = self.trees.log_odds(np.concatenate([features(d, self.token_scores) for d in doms]))
        out, at = [], 0
        for d in doms:
            out.append(kept_text(d, decode(d.parents, odds[at:at + len(d.tags)])))
            at += len(d.tags)
        return out


def train(pages: list[str]) -> Model:
    doms = [Dom(p) for p in pages]
    seen = defaultdict(lambda: [0, 0])
    for d in doms:
        for tokens, label in zip(d.tokens, d.labels, strict=True):
            for t in set(tokens):
                if label is not None:
                    seen[t][int(label)] += 1
    scores = {t: math.log((good + 1) / (bad + 1)) for t, (bad, good) in seen.items() if bad + good >= 5}
    x = np.concatenate([features(d, scores) for d in doms])
    y = np.array([label for d in doms for label in d.labels], dtype=object)
    known = np.array([label is not None for label in y])
    return Model(scores, boost(x[known], y[known].astype(float)))


def fit(table: DataFrame) -> Model:
    """Train on the labelled table, which is small by construction and read by the driver."""
    return train([r["html"] for r in table.orderBy("page").collect()])


def extract(df: DataFrame, model: Model, html_col: str = "html") -> DataFrame:
    """``df`` with ``text``."""
    shared = df.sparkSession.sparkContext.broadcast(
        (model.token_scores, model.trees.feature, model.trees.border, model.trees.value, model.trees.base))
    at, name = df.columns.index(html_col), free_name(df.columns, "text")
    schema = T.StructType(df.schema.fields + [T.StructField(name, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores, *trees = shared.value
        own = Model(scores, Boosted(*trees))
        for batch in batches:
            for i in range(0, len(batch), 256):
                part = batch.slice(i, 256)
                texts = pa.array(own.extract(part.column(at).to_pylist()), pa.string())
                yield pa.RecordBatch.from_arrays(part.columns + [texts], names=part.schema.names + [name])

    return df.mapInArrow(run, schema)
