"""Training pages for html_extract: layouts drawn at random, with known main text.

Each page has an article, in one of many kinds of containers, and furniture
(menus, headers, footers, sidebars, notices, adverts, comments, links to share)
around, before and inside it, under tags and attribute names that vary. Runs of
main text begin with MARK. The text is made up; only its shape matters here.
"""

from __future__ import annotations

import numpy as np

MARK = ""
SYLLABLES = "an ba ce do en fi ga hu in ka lo mi no or pe ra se ti un ve wi ör éa ña".split()
WRAPPERS = ("container", "wrapper", "page", "row", "layout", "col", "inner", "grid", "box", "", "", "")
FURNITURE = {
    "nav": (("nav", ""), ("nav", "main-nav"), ("div", "menu"), ("div", "navbar"), ("div", "breadcrumbs"), ("ul", "nav"), ("div", "pagination"), ("div", "topnav")),
    "header": (("header", ""), ("header", "site-header"), ("div", "header"), ("div", "masthead"), ("div", "top-bar"), ("div", "branding")),
    "footer": (("footer", ""), ("footer", "site-footer"), ("div", "footer"), ("div", "bottom"), ("div", "copyright"), ("section", "footer-legal")),
    "side": (("aside", ""), ("aside", "sidebar"), ("div", "sidebar"), ("div", "widget"), ("div", "right-rail"), ("section", "related"), ("div", "related-posts")),
    "notice": (("div", "cookie-banner"), ("div", "consent"), ("div", "notice"), ("div", "alert"), ("section", "gdpr"), ("div", "popup"), ("p", "notice"), ("div", "cookie")),
    "ad": (("div", "ad"), ("div", "ads"), ("div", "advert"), ("div", "sponsored"), ("aside", "promo"), ("div", "ad-slot"), ("section", "advertisement"), ("p", "ad"), ("div", "banner")),
    "comments": (("section", "comments"), ("div", "comments"), ("div", "comment-list"), ("section", "responses"), ("div", "discussion"), ("ol", "commentlist"), ("div", "reader-comments")),
    "share": (("div", "share"), ("div", "social"), ("ul", "social-links"), ("div", "tags"), ("div", "subscribe"), ("div", "newsletter")),
}
ARTICLES = (("article", ""), ("article", "post"), ("main", ""), ("div", "content"), ("div", "post"), ("div", "entry-content"), ("div", "article-body"), ("section", "story"), ("div", "main"), ("div", ""), ("section", ""))


class Samples:
    def __init__(self, seed: int):
        self.rng = np.random.default_rng(seed)

    def pick(self, options):
        return options[int(self.rng.integers(len(options)))]

    def chance(self, p: float) -> bool:
        return bool(self.rng.random() < p)

    def words(self, low: int, high: int) -> str:
        out = []
        for _ in range(int(self.rng.integers(low, high + 1))):
            w = "".join(self.pick(SYLLABLES) for _ in range(int(self.rng.integers(1, 5))))
            out.append(w + ("," if self.chance(0.06) else "." if self.chance(0.09) else ""))
        text = " ".join(out).capitalize()
        return text.upper() if self.chance(0.04) else text

    def sentence(self, low: int = 3, high: int = 25) -> str:
        return self.words(low, high) + self.pick((".", ".", ".", "!", "?", ""))

    def element(self, tag: str, name: str, inside: str) -> str:
        kind = self.pick(("class", "class", "id"))
        name = f' {kind}="{name}"' if name else ""
        return f"<{tag}{name}>{inside}</{tag}>"

    def link_list(self) -> str:
        items = "".join(f'<li><a href="#">{self.words(1, 4)}</a></li>' for _ in range(int(self.rng.integers(2, 9))))
        return self.pick((f"<ul>{items}</ul>", items, " | ".join(f'<a href="#">{self.words(1, 3)}</a>' for _ in range(5))))

    def furniture(self, kind: str) -> str:
        tag, name = self.pick(FURNITURE[kind])
        if kind == "nav" or kind == "share":
            inside = self.link_list()
        elif kind == "header":
            inside = self.pick((f"<h1>{self.words(1, 4)}</h1>", f"<a href='/'>{self.words(1, 3)}</a>", f"<div>{self.words(1, 3)}</div>", "")) + self.pick((f"<p>{self.sentence(2, 9)}</p>", self.link_list(), self.sentence(2, 8)))
        elif kind == "footer":
            inside = self.pick(("&copy; ", "© 2024 ", "")) + self.pick((self.sentence(), f"<p>{self.sentence()}</p><p>{self.sentence()}</p>", self.link_list() + self.sentence(2, 8)))
        elif kind == "side":
            inside = self.pick(("", f"<h3>{self.words(1, 4)}</h3>")) + self.pick((self.link_list(), f"<p>{self.sentence(5, 40)}</p>", f"<div>{self.sentence(4, 20)}</div>" * 3, self.sentence(4, 40)))
        elif kind == "comments":
            one = self.pick(("<li>{}</li>", "<div class='comment'><p>{}</p></div>", "<div class='comment'><b>{}</b><p>{}</p></div>", "<p>{}</p>", "<article><p>{}</p></article>"))
            inside = self.pick(("", f"<h2>{self.words(1, 3)}</h2>", f"<h3>{self.words(1, 3)}</h3>")) + "".join(
                one.format(*[self.sentence(2, 40) for _ in range(one.count("{}"))]) for _ in range(int(self.rng.integers(1, 6))))
        else:
            inside = self.pick((self.sentence(3, 40), f"<p>{self.sentence(3, 40)}</p>", f"<p>{self.sentence()}</p><p>{self.sentence()}</p>", self.sentence(2, 9) + f'<a href="#">{self.words(1, 2)}</a>'))
        if tag in ("ul", "ol") and "<li" not in inside:
            inside = f"<li>{inside}</li>"
        return self.element("div" if tag == "p" and "<" in inside else tag, name, inside)

    def inline(self, text: str) -> str:
        if self.chance(0.25):
            cut = len(text) // 2
            tag = self.pick(("b", "i", "em", "strong", "a href='#'", "span", "code"))
            text = f"{text[:cut]}<{tag}>{text[cut:]}</{tag.split()[0]}>"
        return text

    def paragraph(self) -> str:
        text = MARK + self.inline(self.sentence(1, 90))
        mark = MARK + self.sentence(1, 25)
        kind = self.rng.random()
        if kind < 0.66:
            return self.pick((f"<p>{text}</p>",) * 8 + (f"<p><b>{text}<br>", f"<p>{text}", f"<p>{text}<br>{mark}</p>"))
        if kind < 0.74:
            return f"<{(h := self.pick(('h2', 'h3', 'h4')))}>{MARK}{self.words(1, 8)}</{h}>"
        if kind < 0.82:
            items = "".join(f"<li>{MARK}{self.sentence(1, 20)}</li>" for _ in range(int(self.rng.integers(1, 6))))
            return self.pick((f"<ul>{items}</ul>", f"<ol>{items}</ol>"))
        if kind < 0.87:
            return self.pick((f"<blockquote>{text}</blockquote>", f"<blockquote><p>{text}</p></blockquote>", f"<pre>{mark}</pre>", f"<figure><img src='x'><figcaption>{mark}</figcaption></figure>"))
        if kind < 0.91:
            rows = "".join(f"<tr><td>{MARK}{self.words(1, 3)}</td><td>{MARK}{self.words(1, 3)}</td></tr>" for _ in range(int(self.rng.integers(1, 5))))
            return f"<table>{rows}</table>"
        return self.pick((f"<div>{text}</div>", f"<div><p>{text}</p></div>", f"<section><h2>{MARK}{self.words(1, 5)}</h2><p>{text}</p></section>"))

    def article(self) -> str:
        parts = [self.paragraph() for _ in range(self.pick((1, 1, 2, 3, 5, 8, 12, 25)))]
        for kind, p in (("ad", 0.35), ("share", 0.15), ("notice", 0.1), ("side", 0.12)):
            if self.chance(p):
                parts.insert(int(self.rng.integers(len(parts) + 1)), self.furniture(kind))
        head = f"<h1>{MARK}{self.words(1, 10)}</h1>"
        if self.chance(0.7):
            parts.insert(0, self.pick((head, head, head, f"<header>{head}</header>")))
        if self.chance(0.15):
            parts.append(self.furniture("comments"))
        tag, name = self.pick(ARTICLES)
        return self.element(tag, name, "".join(parts))

    def page(self) -> str:
        before = [self.furniture(k) for k, p in (("nav", 0.7), ("header", 0.45), ("notice", 0.35), ("ad", 0.45), ("side", 0.2), ("nav", 0.15)) if self.chance(p)]
        after = [self.furniture(k) for k, p in (("ad", 0.3), ("share", 0.25), ("comments", 0.4), ("side", 0.4), ("notice", 0.2), ("footer", 0.75)) if self.chance(p)]
        if self.chance(0.4):
            self.rng.shuffle(before)
        middle = self.article()
        for _ in range(int(self.rng.integers(0, 4))):
            if self.chance(0.3):
                near = self.furniture(self.pick(("side", "ad", "share", "comments")))
                middle = self.pick((middle + near, near + middle))
            middle = self.element("div", self.pick(WRAPPERS), middle)
        end = self.pick(("</body></html>", "</body></html>", ""))
        return f"<!DOCTYPE html><html><head><title>{self.words(1, 8)}</title></head><body>{''.join(before)}{middle}{''.join(after)}{end}"
