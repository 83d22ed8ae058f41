"""A lenient page tree for html_extract: blocks, runs of text and their features.

Block elements are nodes; each run of text between block borders is a leaf. Runs
are what an extraction keeps or drops. Inline tags only count as markup.
"""

from __future__ import annotations

import re
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np

INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is never text of the page.
SKIPPED = frozenset("script style template noscript svg math iframe object canvas audio video head title form button select option textarea datalist".split())
#: Start tags that end an open paragraph, and end tags that lists and tables imply.
ENDS_P = frozenset("address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
          "tbody": {"thead", "tbody", "tr", "td", "th"}, "body": {"head"}}
#: Elements that an implied end tag does not reach beyond.
SCOPES = frozenset("ul ol dl menu table td th article section div body html main aside nav header footer".split())

CATEGORIES = {c: k for k, names in enumerate((
    "#run", "p", "h1 h2 h3 h4 h5 h6", "div", "section", "article main", "ul ol dl menu", "li dt dd", "table tbody thead tr td th", "nav", "header", "footer",
    "aside", "blockquote pre figure figcaption", "body html #root")) for c in names.split()}
OTHER = len(set(CATEGORIES.values()))
#: Attribute tokens by what they say about an element.
GROUPS = ("article content main post entry story body text prose blog news read",
          "nav menu navigation breadcrumb breadcrumbs pagination pager tabs toc links skip",
          "header masthead top branding logo site topbar hero", "footer foot bottom copyright colophon legal imprint credits",
          "sidebar side aside rail widget widgets panel complementary", "ad ads advert advertisement advertising sponsor sponsored promo promotion banner adsbygoogle outbrain taboola",
          "cookie cookies consent notice alert gdpr popup modal overlay paywall warning disclaimer announcement privacy message",
          "comment comments commentlist reply replies respond responses disqus discussion discuss feedback reader thread",
          "form search login signup subscribe subscription newsletter register contact email", "share sharing social related recommended recommendations more popular trending tags author byline meta")
TOKEN_GROUP = {t: k for k, names in enumerate(GROUPS) for t in names.split()}
LONG_TOKENS = sorted((t for t in TOKEN_GROUP if len(t) >= 5), key=len, reverse=True)
FURNITURE_TAGS = frozenset(("nav", "footer", "aside"))
INHERITED_TAGS = ("article", "main", "nav", "header", "footer", "aside", "ul", "table")
N_GROUPS, N_TAGS = len(GROUPS), OTHER + 1
N_FEATURES = N_TAGS + 3 * N_GROUPS + len(INHERITED_TAGS) + 18
FORM, LAYOUT = re.compile(r"<form\b", re.I), re.compile(r"<(?:main|article|nav)\b", re.I)
STOPS = re.compile(r"[.,;:!?]")


@lru_cache(maxsize=10_000)
def groups_of(attributes: str) -> tuple[int, ...]:
    """Groups that the words of class, id and role values belong to."""
    out = set()
    for t in re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", attributes).lower()):
        k = TOKEN_GROUP.get(t)
        if k is None:
            k = next((TOKEN_GROUP[x] for x in LONG_TOKENS if x in t), None)
        if k is not None:
            out.add(k)
    return tuple(sorted(out))


def wide_forms(html: str) -> set[tuple[int, int]]:
    """Line and column of forms that hold parts of the page's layout (some servers
    wrap whole pages in one), which are blocks like others."""
    out = set()
    for m in FORM.finditer(html):
        end = html.find("</form", m.end()) if "</form" in html else -1
        if LAYOUT.search(html, m.end(), len(html) if end < 0 else end):
            before = html[:m.start()]
            out.add((before.count("\n") + 1, m.start() - before.rfind("\n") - 1))
    return out


class Page(HTMLParser):
    """Nodes in page order: tag, parent, groups; of runs also text and the
    number of characters inside links."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.tags, self.parents, self.groups = ["#root"], [-1], [()]
        self.texts: list[str] = [""]
        self.linked: list[int] = [0]
        self.stack: list[tuple[str, int, int]] = [("#root", 0, 0)]  # tag, node, link depth outside
        self.open: dict[str, int] = {}
        self.skipping = self.links = self.run_links = 0
        self.run: list[str] = []
        self.wide = wide_forms(html)
        self.feed(html)
        self.close()
        self.flush()

    def flush(self) -> None:
        if self.run:
            text = " ".join("".join(self.run).split())
            if text:
                self._node("#run", (), text, self.run_links)
            self.run, self.run_links = [], 0

    def _node(self, tag: str, groups: tuple[int, ...], text: str = "", linked: int = 0) -> int:
        self.tags.append(tag)
        self.parents.append(self.stack[-1][1])
        self.groups.append(groups)
        self.texts.append(text)
        self.linked.append(linked)
        return len(self.tags) - 1

    def _pop(self) -> str:
        tag, _, self.links = self.stack.pop()
        self.open[tag] -= 1
        self.skipping -= tag in SKIPPED
        return tag

    def _imply(self, closed: set[str] | frozenset[str], scopes: frozenset[str]) -> None:
        """Ends the innermost open element of these tags, if no scope is in between."""
        if not any(self.open.get(t) for t in closed):
            return
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k][0] in closed:
                while len(self.stack) > k:
                    self._pop()
                return
            if self.stack[k][0] in scopes:
                return

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in INLINE:
            self.links += tag == "a"
            return
        if tag in VOID:
            if not self.skipping:
                self.flush()
            return
        if not self.skipping:
            self.flush()
        if tag == "form" and self.wide and self.getpos() in self.wide:
            tag = "div"
        if tag in ENDS_P:
            self._imply({"p"}, SCOPES)
        if tag in CLOSES:
            self._imply(CLOSES[tag], SCOPES - {"td", "th"} if tag in ("tr", "tbody") else SCOPES)
        if tag in ("html", "body") and self.open.get(tag):
            return
        node = self.stack[-1][1]
        if not self.skipping and tag not in SKIPPED:
            node = self._node(tag, groups_of(" ".join(v for k, v in attrs if v and k in ("class", "id", "role"))))
        self.stack.append((tag, node, self.links))
        self.open[tag] = self.open.get(tag, 0) + 1
        self.skipping += tag in SKIPPED

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in INLINE and tag in ("svg", "math"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in INLINE:
            self.links -= tag == "a" and self.links > 0
            return
        if not self.skipping:
            self.flush()
        if self.open.get(tag) and tag not in ("html", "body"):
            while self._pop() != tag:
                pass

    def handle_data(self, data: str) -> None:
        if not self.skipping:
            self.run.append(data)
            if self.links:
                self.run_links += len(data)


def features(page: Page) -> np.ndarray:
    """A row of N_FEATURES for each node."""
    n = len(page.tags)
    parents = page.parents
    chars = np.zeros(n)
    sums = np.zeros((n, 5))  # linked characters, words, stops, runs, paragraphs
    for k, t in enumerate(page.texts):
        if t:
            chars[k] = len(t)
            sums[k, :4] = (page.linked[k], t.count(" ") + 1, len(STOPS.findall(t)), 1)
        elif page.tags[k] == "p":
            sums[k, 4] = 1
    first = np.concatenate(([0], np.cumsum(chars)[:-1]))  # characters before a node in the page
    size, nodes = chars.copy(), np.ones(n)
    children: list[int] = [0] * n
    place, same, seen = [0] * n, [0] * n, {}
    depth = np.zeros(n)
    own = np.zeros((n, N_GROUPS), bool)
    above = np.zeros((n, 2 * N_GROUPS + len(INHERITED_TAGS)), bool)  # any ancestor's, the nearest one's, tags
    signs = np.zeros((n, 2))  # furniture and main text by name, of a node and its ancestors
    for k in range(1, n):
        up = parents[k]
        depth[k] = depth[up] + 1
        place[k] = children[up]
        children[up] += 1
        seen[up, page.tags[k]] = seen.get((up, page.tags[k]), 0) + 1
        if page.groups[k]:
            own[k, page.groups[k]] = True
        above[k] = above[up]
        if page.groups[up]:
            above[k, :N_GROUPS] |= own[up]
            above[k, N_GROUPS:2 * N_GROUPS] = own[up]
        if page.tags[up] in INHERITED_TAGS:
            above[k, 2 * N_GROUPS + INHERITED_TAGS.index(page.tags[up])] = True
        signs[k, 0] = signs[up, 0] + (page.tags[k] in FURNITURE_TAGS or bool(own[k, 1:].any()))
        signs[k, 1] = signs[up, 1] + (page.tags[k] in ("article", "main") or bool(own[k, 0]))
    for k in range(n - 1, 0, -1):
        up = parents[k]
        size[up] += size[k]
        sums[up] += sums[k]
        nodes[up] += nodes[k]
    up = np.maximum(np.array(parents), 0)
    for k in range(1, n):
        same[k] = seen[parents[k], page.tags[k]]
    siblings = np.array(children)[up]
    total = max(size[0], 1.0)
    out = np.zeros((n, N_FEATURES), np.float32)
    out[np.arange(n), [CATEGORIES.get(t, OTHER) for t in page.tags]] = 1
    at = N_TAGS
    out[:, at:at + N_GROUPS] = own
    at += N_GROUPS
    out[:, at:at + above.shape[1]] = above
    at += above.shape[1]
    words = np.maximum(sums[:, 1], 1)
    out[:, at:] = np.stack([
        depth, np.log1p(size), size / total, sums[:, 0] / np.maximum(size, 1), 100 * nodes / np.maximum(size, 1), sums[:, 2] / words, sums[:, 4], sums[:, 3],
        words / np.maximum(sums[:, 3], 1), np.array(place), siblings, np.array(same) / np.maximum(siblings, 1), first / total, size / np.maximum(size[up], 1),
        (size / np.maximum(size[up], 1))[up], np.log1p(size[up]), signs[:, 0], signs[:, 1]], axis=1)
    return out
