"""Labelled training pages, drawn from layouts: each block element carries whether it is content.

A page is written as HTML with a ``data-y`` attribute (1: content) on block elements; the trainer
reads it as the label and never as a feature. Layouts vary in element names, class names, nesting,
the place of the article and of the parts around it, and in the length of texts: an article element, nested wrappers, sections, cells of a
layout table, or paragraphs and plain text straight in the body or in a page without one.
"""

from __future__ import annotations

import random

#: Fixed vocabularies the layouts draw from: class names by the kind of the part.
CLASSES = {
    "menu": ["nav", "menu", "navbar", "main-menu", "breadcrumb", "breadcrumbs", "site-nav", "topnav", "pagination", "toc"],
    "header": ["header", "site-header", "masthead", "banner", "top-bar", "branding", "logo"],
    "footer": ["footer", "site-footer", "bottom", "colophon", "copyright", "legal"],
    "sidebar": ["sidebar", "aside", "widget", "related", "related-posts", "rail", "popular", "tags", "archive"],
    "notice": ["cookie", "cookie-notice", "consent", "gdpr", "alert", "notice", "popup", "modal", "newsletter", "subscribe", "share", "social", "promo"],
    "advert": ["ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "adslot", "banner-ad", "ad-box"],
    "comments": ["comments", "comment", "comment-list", "reply", "discussion", "respond", "disqus", "reader-comments"],
    "form": ["search", "search-form", "login", "signup", "contact-form"],
    "content": ["content", "article", "post", "entry", "main", "story", "article-body", "post-content", "entry-content", "text", "main-content"],
    "plain": ["row", "col", "wrap", "container", "inner", "page", "box", "layout", "grid"],
}
TAGS = {
    "menu": ["nav", "div", "ul", "section"], "header": ["header", "div"], "footer": ["footer", "div"], "sidebar": ["aside", "div", "section"],
    "notice": ["div", "aside", "section"], "advert": ["div", "aside", "ins"], "comments": ["section", "div", "ol"], "form": ["form"], "content": ["article", "main", "div", "section"],
}
SYLLABLES = "an be co da el fi go ha in jo ka lo me no or pa qui re sa ti un ve wo xi ya zo ér ün ña".split()


def _words(r: random.Random, low: int, high: int) -> str:
    return " ".join("".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 4))) for _ in range(r.randint(low, high)))


def _attributes(r: random.Random, kind: str, y: int, named: float) -> str:
    out = f' data-y="{y}"'
    if r.random() < named:
        out += f' {r.choice(["class", "class", "id"])}="{r.choice(CLASSES[kind])}{r.choice(["", "", " " + r.choice(CLASSES["plain"])])}"'
    return out


def _links(r: random.Random, n: int) -> str:
    return "".join(f'<li data-y="0"><a href="#">{_words(r, 1, 3)}</a></li>' for _ in range(n))


def _part(r: random.Random, kind: str) -> str:
    tag = r.choice(TAGS[kind])
    named = 0.4 if tag in ("nav", "header", "footer", "form") else 0.75 if tag == "aside" else 1.0
    head = f"<{tag}{_attributes(r, kind, 0, named)}>"
    if kind == "menu":
        body = _links(r, r.randint(3, 9)) if tag == "ul" else f'<ul data-y="0">{_links(r, r.randint(3, 9))}</ul>'
    elif kind == "header":
        body = f'<{(h := r.choice(["h1", "h2", "div", "p"]))} data-y="0"><a href="/">{_words(r, 1, 4)}</a></{h}>' + (f'<p data-y="0">{_words(r, 2, 7)}</p>' if r.random() < 0.4 else "")
    elif kind == "footer":
        body = f"{r.choice(['&copy; ', '', '(c) '])}{_words(r, 2, 12)}" if r.random() < 0.6 else f'<p data-y="0">&copy; {_words(r, 2, 12)}</p><ul data-y="0">{_links(r, 3)}</ul>'
    elif kind == "sidebar":
        body = f'<h3 data-y="0">{_words(r, 1, 3)}</h3>' + (f'<ul data-y="0">{_links(r, r.randint(2, 6))}</ul>' if r.random() < 0.6 else f'<p data-y="0">{_words(r, 5, 40)}</p>')
    elif kind == "comments":
        body = f'<h3 data-y="0">{_words(r, 1, 3)}</h3>' * r.randint(0, 1) + "".join(f'<{(t := r.choice(["div", "p", "li"]))}{_attributes(r, "comments", 0, 0.5)}>{_words(r, 4, 45)}</{t}>' for _ in range(r.randint(1, 5)))
    elif kind == "form":
        body = f'<label>{_words(r, 1, 4)}</label><input type="text"><button>{_words(r, 1, 2)}</button>' + (f'<p data-y="0">{_words(r, 3, 20)}</p>' if r.random() < 0.4 else "")
    elif r.random() < 0.5:
        body = _words(r, 3, 30) + r.choice(["", '<a href="#">' + _words(r, 1, 2) + "</a>"])
    else:
        body = f'<p data-y="0">{_words(r, 3, 30)}</p>'
    return f"{head}{body}</{tag}>"


def _inline(r: random.Random, text: str) -> str:
    kind = r.random()
    if kind < 0.2:
        return f'{text} <a href="#">{_words(r, 1, 4)}</a> {_words(r, 3, 20)}'
    if kind < 0.35:
        tag = r.choice(["em", "strong", "code", "i", "span", "font"])
        return f"{_words(r, 1, 9)} <{tag}>{_words(r, 1, 5)}</{tag}> {text}"
    if kind < 0.4:
        return f"<strong>{_words(r, 1, 5)}</strong> {text}<br>{_words(r, 1, 20)}"
    return text


def _paragraph(r: random.Random) -> str:
    text = _inline(r, _words(r, *r.choice([(1, 6), (8, 40), (30, 120)])))
    forms = ['<p data-y="1">{}</p>'] * 8 + [
        '<p data-y="1">{}', '<div data-y="1">{}</div>', '<blockquote data-y="1">{}</blockquote>', '<blockquote data-y="1"><p data-y="1">{}</p></blockquote>', '<ul data-y="1"><li data-y="1">{}</li><li data-y="1">two</li></ul>', '<ol data-y="1"><li data-y="1">{}<li data-y="1">next</ol>',
        '<h2 data-y="1">{}</h2>', '<h3 data-y="1">{}</h3>', '<pre data-y="1">{}</pre>', '<table data-y="1"><tr data-y="1"><td data-y="1">{}</td><td data-y="1">1</td></tr></table>', '<section data-y="1"><h2 data-y="1">part</h2><p data-y="1">{}</p></section>',
        '<dl data-y="1"><dt data-y="1">term</dt><dd data-y="1">{}</dd></dl>', '<figure data-y="1"><img src="x"><figcaption data-y="1">{}</figcaption></figure>',
    ]
    return r.choice(forms).format(text)


def _article(r: random.Random) -> tuple[str, int]:
    """The article, and the label of the body around it."""
    inside = [_paragraph(r) for _ in range(r.randint(1, 12))]
    for kind in ("notice", "advert", "comments", "menu"):
        if r.random() < 0.12:
            inside.insert(r.randint(1, len(inside)), _part(r, kind))
    title = f'<h1 data-y="1">{_words(r, 2, 9)}</h1>' if r.random() < 0.8 else ""
    layout = r.random()
    if layout < 0.17:  # straight in the body
        return title + "".join(inside) if r.random() < 0.5 else "".join(_paragraph(r) for _ in range(r.randint(1, 2))), 1
    if layout < 0.25:  # text and line breaks in the body, without any block
        return "<br><br>".join(_inline(r, _words(r, *r.choice([(2, 9), (10, 90)]))) for _ in range(r.randint(1, 6))), 1
    tag = r.choice(["article", "article", "main", "div", "section", "td"])
    body = f"<{tag}{_attributes(r, 'content', 1, 0.4 if tag in ('article', 'main', 'td') else 0.9)}>{title}{''.join(inside)}</{tag}>"
    if tag == "td":
        side = f'<td data-y="0"><ul data-y="0">{_links(r, r.randint(3, 8))}</ul></td>'
        cells = [side, body] if r.random() < 0.7 else [body, side] if r.random() < 0.5 else [body]
        return f'<table data-y="0"><tr data-y="0">{"".join(cells)}</tr></table>', 0
    return body, 0


def page(r: random.Random) -> str:
    article, y = _article(r)
    before = [_part(r, k) for k in ("notice", "header", "menu", "advert", "form", "sidebar") if r.random() < 0.4]
    after = [_part(r, k) for k in ("comments", "sidebar", "advert", "form", "notice", "footer") if r.random() < 0.4]
    r.shuffle(before)
    if y and r.random() < 0.5:  # nothing but the article
        before = after = []
    for _ in range(r.choice([0, 0, 0, 1, 1, 2]) if not y else 0):
        article = f'<{(t := r.choice(["main", "div", "div", "section", "center"]))} data-y="0"{r.choice(["", " class=" + chr(34) + r.choice(CLASSES["plain"]) + chr(34)])}>{article}{after.pop(0) if after and r.random() < 0.4 else ""}</{t}>'
    if y and r.random() < 0.5:  # a fragment, without head and body
        return f'<html data-y="1">{"".join(before)}{article}{"".join(after)}</html>'
    head = r.choice(["", f"<title>{_words(r, 2, 8)}</title>", f'<meta name="viewport" content="width=device-width"><title>{_words(r, 2, 8)}</title><link rel="stylesheet" href="x.css">'])
    return f'{r.choice(["<!DOCTYPE html>", "<!doctype html>", ""])}<html data-y="0"><head>{head}</head><body data-y="{y}">{"".join(before)}{article}{"".join(after)}</body></html>'


def labelled_pages(n: int = 800, seed: int = 11) -> list[str]:
    r = random.Random(seed)
    return [page(r) for _ in range(n)]
