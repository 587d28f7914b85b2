"""Labelled pages made by rule, for training and testing the HTML extraction.

A page has an article and what stands around and in it.  Some pages are
only an article, or a paragraph of one.  Words of the article begin with ``MARK``, others don't; the extraction never looks at words, so the mark tells it nothing.  Layouts:

* ``article``: the article is an article or main element, and boilerplate is named or has its own elements;
* ``named``: only div elements, whose classes tell boilerplate;
* ``plain``: only div elements without names: words and links are all there is.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

MARK = "zq"
LAYOUTS = ("article", "named", "plain")


class _Page:
    def __init__(self, r: random.Random, layout: str) -> None:
        self.r, self.layout = r, layout

    def words(self, n: int, main: bool) -> list[str]:
        return [(MARK if main else "") + "".join(self.r.choice("abcdefghij") for _ in range(self.r.randrange(2, 8))) for _ in range(n)]

    def text(self, n: int, main: bool, linked: float = 0.0) -> str:
        """n words, a share of them in links; the first is no link unless all are."""
        words = self.words(n, main)
        k = round(n * linked)
        if k >= n:
            return f"<a href='/x'>{' '.join(words)}</a>"
        return " ".join(words) if not k else f"{' '.join(words[: n - k])} <a href='/x'>{' '.join(words[n - k :])}</a>"

    def box(self, element: str, names: tuple[str, ...], content: str) -> str:
        """Boilerplate in its own element, in a named div, or in a div like any other."""
        how = self.layout if self.layout != "article" else self.r.choice(("article", "named"))
        if how == "article" and element:
            return f"<{element}>{content}</{element}>"
        attribute = "" if how == "plain" else f" {self.r.choice(('class', 'id'))}=\"{self.r.choice(names)}{self.r.choice(('', '', '-box', '-wrapper'))}\""
        return f"<div{attribute}>{content}</div>"

    def links(self, low: int, high: int) -> str:
        items = [self.text(self.r.randrange(1, 4), False, 1.0) for _ in range(self.r.randrange(low, high))]
        return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>" if self.r.random() < 0.8 else "<div>" + " | ".join(items) + "</div>"

    def paragraph(self) -> str:
        n = self.r.choice((self.r.randrange(1, 8), self.r.randrange(8, 40), self.r.randrange(30, 160)))
        if self.layout == "plain":
            n += 8  # a word or two in a div without a name may be anything
        return f"<p>{self.text(n, True, self.r.choice((0, 0, 0, 0.1, 0.25)))}</p>"

    def part(self) -> str:
        """A part of the article."""
        r, x = self.r, self.r.random()
        if x < 0.68:
            return self.paragraph()
        if x < 0.8:
            return f"<h{r.randrange(2, 4)}>{self.text(r.randrange(1, 9), True)}</h2>" + self.paragraph()
        low = 1 if self.layout != "plain" else 10
        if x < 0.88:
            return "<ul>" + "".join(f"<li>{self.text(r.randrange(low, 25), True)}</li>" for _ in range(r.randrange(2, 6))) + "</ul>"
        if x < 0.93:
            return f"<blockquote>{self.text(r.randrange(12, 50), True)}</blockquote>"
        if self.layout == "article" and x < 0.95:
            return f"<p>{self.text(r.randrange(1, 12), True, 1.0)}</p>"
        if self.layout != "plain":
            name = r.choice(("share-price", "post-banner", "social-history", "widget-theory", "legal-text", "menu-planning", "search-results-text", "promo"))
            return f"<div class='{name}'>{self.text(r.randrange(14, 120), True, r.choice((0, 0.1)))}</div>"
        return self.paragraph()

    def within(self) -> str:
        """Boilerplate in the article."""
        r = self.r
        if self.layout == "plain":
            return f"<div>{self.text(r.randrange(2, 12), False, 1.0)}</div>"
        x = r.random()
        if x < 0.35:
            return f"<div class='{r.choice(('ad', 'ads', 'advert', 'advertisement', 'sponsored', 'ad-box'))}'>{self.text(r.randrange(1, 30), False)}</div>"
        if x < 0.7:
            named = r.choice(("share", "social-share", "related", "widget", "more-links", "promo"))
            return f"<div class='{named}'>" + "".join(f"<a href=x>{self.text(r.randrange(1, 4), False)}</a> " for _ in range(r.randrange(1, 5))) + "</div>"
        if x < 0.85:
            return f"<div class='{r.choice(('share', 'banner', 'promo', 'widget'))}'>{self.text(r.randrange(1, 7), False)}</div>"
        return f"<aside>{self.text(r.randrange(3, 40), False, r.choice((0, 0.5, 1)))}</aside>"

    def remarks(self) -> str:
        return "".join(f"<p>{self.text(self.r.randrange(3, 90), False)}</p>" for _ in range(self.r.randrange(1, 5)))

    def html(self) -> str:
        r = self.r
        plain = self.layout == "plain"
        parts = [f"<h1>{self.text(r.randrange(2, 14), True)}</h1>" if r.random() < 0.7 else self.paragraph()]
        for _ in range(r.choice((0, 1, r.randrange(1, 12), r.randrange(1, 12)))):
            parts.append(self.part())
            if r.random() < (0.05 if plain else 0.15):
                parts.append(self.within())
        if plain:
            parts.append(f"<p>{self.text(r.randrange(20, 120), True)}</p>")
        element = r.choice(("article", "main", "article")) if self.layout == "article" else "div"
        if self.layout == "article" and r.random() < 0.3:
            parts[0] = f"<header>{parts[0]}</header>"
        if self.layout != "plain" and r.random() < 0.25:
            parts.append(f"<section id='{r.choice(('comments', 'respond', 'disqus'))}'>{self.remarks()}</section>")
        article = f"<{element}>{''.join(parts)}</{element}>"
        name = f"<div>{self.text(r.randrange(1, 5), False, 1.0 if plain else r.choice((0, 1.0)))}</div>"
        top = self.box("header", ("header", "masthead"), name) + self.box("nav", ("nav", "menu", "navbar"), self.links(3, 9))
        if r.random() < 0.3:
            top = ""
        elif r.random() < 0.3:
            top += self.box("", ("breadcrumbs", "breadcrumb"), self.links(2, 5))
        if r.random() < 0.5 and not plain:
            top += f"<div class='{r.choice(('ad', 'advert', 'banner-ad', 'sponsor'))}'>{self.text(r.randrange(2, 40), False)}</div>"
        end = []
        if r.random() < 0.6:
            teasers = "".join(f"<p>{self.text(r.randrange(4, 30), False, r.choice((0.6, 0.8, 1.0)))}</p>" for _ in range(r.randrange(1, 5)))
            end.append(self.box("aside", ("sidebar", "related-comments", "recommended"), self.links(2, 8) + teasers))
        if not plain:
            if r.random() < 0.5:
                end.append(f"<div class='{r.choice(('cookie-notice', 'cookies', 'consent', 'gdpr', 'newsletter'))}'>{self.text(r.randrange(5, 50), False)}</div>")
            if r.random() < 0.4:
                end.append(self.box("", ("comments", "replies", "comment-list"), self.remarks()))
            if r.random() < 0.4:
                end.append(f"<form><label>{self.text(r.randrange(1, 6), False)}</label><p>{self.text(r.randrange(1, 20), False)}</p></form>")
            r.shuffle(end)
        foot = f"<p>&copy; {self.text(r.randrange(2, 12), False, r.choice((0.4, 0.6, 1.0)))}</p>" + (self.links(2, 7) if r.random() < 0.7 else "")
        if not plain and r.random() < 0.4:
            foot = f"<p>&copy; {self.text(r.randrange(2, 30), False)}</p>"
        end.append(self.box("footer", ("footer", "site-footer", "copyright"), foot))
        if r.random() < 0.2:
            end = []
        return f"<!DOCTYPE html><html><head><title>{self.text(4, False)}</title></head><body>{top}{article}{''.join(end)}</body></html>"


def pages(n: int, seed: int, layout: str | None = None) -> Iterator[str]:
    """n pages of a layout, or of all in turn."""
    for k in range(n):
        yield _Page(random.Random(f"{seed}:{k}"), layout or LAYOUTS[k % len(LAYOUTS)]).html()
