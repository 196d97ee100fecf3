"""Labelled pages for training the extraction model: layouts composed from parts whose label is known.

A part is written with a ``data-y`` attribute (1: content, 0: not); descendants take the nearest ancestor's label and
unmarked wrappers around everything are 0. The attribute is removed before features are read.
"""

from __future__ import annotations

import random
import re

_Y = re.compile(r'\s*data-y="([01])"')


def _labels(nodes) -> list[int]:
    out: list[int] = []
    for x in nodes:
        m = _Y.search(x.attrs)
        out.append(int(m.group(1)) if m else out[x.parent] if x.parent >= 0 else 0)
        x.attrs = _Y.sub("", x.attrs)
    return out


def _say(r: random.Random, n: int) -> str:
    return " ".join("".join(r.choice(("ka", "lo", "mi", "ter", "on", "sal", "ver", "e", "ing")) for _ in range(r.randint(1, 4))) for _ in range(n)).capitalize() + "."


def _links(r: random.Random, n: int) -> str:
    return "".join(f'<li><a href="/{k}">{_say(r, r.randint(1, 3))[:-1]}</a></li>' for k in range(n))


def _linked(r: random.Random) -> str:
    """A list inside an article whose items are links, or hold one."""
    way, tag = r.random(), r.choice(("ul", "ul", "ol"))
    items = []
    for k in range(r.randint(1, 7)):
        link = f'<a href="/doc/{k}">{_say(r, r.randint(1, 8))[:-1]}</a>'
        items.append(f"<li>{link}</li>" if way < 0.6 else f"<li>{link} {_say(r, r.randint(1, 9))}</li>" if way < 0.8 else f"<li><p>{link}</p></li>")
    return f"<{tag}>{''.join(items)}</{tag}>"


def _paragraph(r: random.Random) -> str:
    t = _say(r, r.choice((2, 6, 12, 25, 50, 90)))
    k = r.random()
    if k < 0.15:
        t += f" <a href='/x'>{_say(r, 2)}</a> " + _say(r, 8)
    elif k < 0.3:
        t = f"<b>{_say(r, 3)}</b><br>" + t
    elif k < 0.4:
        t += f" <em>{_say(r, 2)}</em> <span>{_say(r, 2)}</span> <strong>{_say(r, 1)}</strong> <code>x</code> <i>y</i>"
    elif k < 0.5:
        return f"<p><b>{t}<br><p>{_say(r, 20)}</p>"
    return f"<p>{t}</p>"


def _content(r: random.Random) -> str:
    parts = [f"<h{r.choice((1, 1, 2))}>{_say(r, r.randint(2, 9))}</h1>"] if r.random() < 0.75 else []
    if r.random() < 0.16:  # a page of a few words
        return (parts[0] if parts and r.random() < 0.5 else "") + f"<p>{_say(r, r.randint(1, 5))}</p>" + (f"<noscript><p>{_say(r, 3)}</p></noscript>" if r.random() < 0.3 else "")
    if r.random() < 0.09:  # an index: links, with a heading perhaps
        return (parts[0] if parts and r.random() < 0.7 else "") + (f"<p>{_say(r, 8)}</p>" if r.random() < 0.4 else "") + "".join(_linked(r) for _ in range(r.choice((1, 1, 2))))
    for _ in range(r.choice((1, 1, 2, 3, 4, 5, 6, 7, 8, 9))):
        k = r.random()
        if k < 0.7:
            parts.append(_paragraph(r))
        elif k < 0.75:
            parts.append(f"<h{r.randint(2, 4)}>{_say(r, 4)}</h2>")
        elif k < 0.79:
            parts.append(_linked(r))
        elif k < 0.84:
            parts.append("<ul>" + "".join(f"<li>{_say(r, r.randint(3, 15))}</li>" for _ in range(3)) + "</ul>")
        elif k < 0.88:
            parts.append(f"<blockquote><p>{_say(r, 20)}</p></blockquote>")
        elif k < 0.92:
            parts.append("<table><tr>" + "".join(f"<td>{_say(r, 3)}</td>" for _ in range(3)) + f"</tr><tr><th>{_say(r, 2)}</th><td>{_say(r, 2)}</td></tr></table>")
        elif k < 0.95:
            parts.append(f"<pre>{_say(r, 10)}</pre>")
        else:
            held = r.choice(("figure><img src='a.png'><figcaption|</figcaption></figure", "canvas|</canvas", "noscript><p|</p></noscript"))
            parts.append(held.split("|")[0].join(("<", ">")) + _say(r, 6) + held.split("|")[1] + ">")
        if r.random() < 0.08:
            parts.append(_aside(r, inner=True))
    return "".join(parts)


def _aside(r: random.Random, inner: bool = False) -> str:
    name = r.choice
    text, more = _say(r, r.choice((3, 8, 20))), _say(r, r.choice((5, 30)))
    forms = [
        f'<nav data-y="0"><ul>{_links(r, r.randint(2, 7))}</ul></nav>',
        f'<div data-y="0" class="{name(("menu", "navbar", "breadcrumbs", "nav-main", "pagination"))}"><ul>{_links(r, 4)}</ul></div>',
        f'<ul data-y="0" class="{name(("menu", "nav", "links", "tags"))}">{_links(r, 5)}</ul>',
        f'<header data-y="0"><div class="logo"><a href="/">{_say(r, 2)}</a></div><p>{text}</p></header>',
        f'<div data-y="0" id="{name(("header", "masthead", "top-banner"))}"><span>{text}</span></div>',
        f'<footer data-y="0">&copy; {text} &middot; {more}</footer>',
        f'<footer data-y="0"><p>{more}</p><a href="/t">{_say(r, 1)}</a></footer>',
        f'<div data-y="0" class="{name(("footer", "site-footer", "copyright", "legal"))}"><p>{more}</p></div>',
        f'<aside data-y="0"><h3>{_say(r, 2)}</h3><p>{more}</p></aside>',
        f'<aside data-y="0" class="{name(("sidebar", "related", "promo"))}"><h3>{_say(r, 2)}</h3><ul>{_links(r, 4)}</ul></aside>',
        f'<div data-y="0" class="{name(("sidebar", "side-column", "widget", "right-rail"))}"><h3>{_say(r, 3)}</h3><p>{more}</p></div>',
        f'<div data-y="0" class="{name(("ad", "ads", "advert", "ad-slot", "sponsored", "promo-box", "advertisement"))}">{more}</div>',
        f'<div data-y="0" class="{name(("ad", "sponsor", "banner-ad"))}"><p>{more}</p><a href="/b">{_say(r, 2)}</a></div>',
        f'<div data-y="0" class="{name(("cookie-notice", "consent", "cookie-banner", "newsletter-signup", "notice", "popup", "gdpr-bar", "alert"))}"><p>{more}</p><button>{_say(r, 1)}</button></div>',
        f'<div data-y="0" id="{name(("cookies", "newsletter", "subscribe", "modal"))}">{more} <button>{_say(r, 1)}</button></div>',
        f'<section data-y="0" class="{name(("comments", "comment-list", "discussion", "responses"))}"><h2>{_say(r, 2)}</h2>' + "".join(f'<div class="comment"><b>{_say(r, 1)}</b><p>{_say(r, 15)}</p></div>' for _ in range(2)) + "</section>",
        f'<div data-y="0" id="{name(("comments", "disqus", "respond"))}"><ol>' + "".join(f"<li><p>{_say(r, 20)}</p></li>" for _ in range(2)) + "</ol></div>",
        f'<article data-y="0" class="comment"><p>{more}</p></article>',
        f'<form data-y="0" action="/s"><label>{_say(r, 2)}</label><input name="q"><button>{_say(r, 1)}</button></form>',
        f'<form data-y="0" class="{name(("search", "login", "contact"))}"><fieldset><p>{text}</p><label>{_say(r, 1)}</label></fieldset></form>',
        f'<div data-y="0" class="{name(("share", "social", "share-buttons"))}"><a href="/f">{_say(r, 1)}</a> <a href="/g">{_say(r, 1)}</a></div>',
        f'<div data-y="0" class="{name(("related", "recommended", "popular-posts", "more-stories"))}"><h3>{_say(r, 2)}</h3><p>{text}</p><ul>{_links(r, 3)}</ul></div>',
        f'<div data-y="0" role="{name(("navigation", "banner", "contentinfo", "complementary", "search"))}"><p>{more}</p></div>',
        f'<div data-y="0" style="display:none"><p>{more}</p></div>',
        f'<form data-y="0" action="/go"><label>{_say(r, 1)}</label><select name="s">' + "".join(f"<option>{_say(r, 2)[:-1]}</option>" for _ in range(4)) + "</select></form>",
        f'<{(bar := name(("div", "td", "p")))} data-y="0">' + name((" ", " | ")).join(f'<a href="/{k}">{_say(r, r.randint(1, 2))[:-1]}</a>' for k in range(r.randint(2, 6))) + f"</{bar}>",
        f'<noscript data-y="0">{_say(r, r.choice((3, 8)))}</noscript>',
    ]
    if inner:
        forms = [f for f in forms if not f.startswith(("<footer", "<header", "<td"))]
    return r.choice(forms)


def _blocks(r: random.Random) -> list[str]:
    """Content as a list of marked blocks: a heading perhaps, and paragraphs in the ways that pages write them."""
    out = [f"<h{r.randint(1, 2)} data-y=\"1\">{_say(r, r.randint(2, 8))}</h1>"] if r.random() < 0.6 else []
    way = r.random()
    for _ in range(r.choice((1, 2, 3, 4, 5, 6, 7))):
        t = _say(r, r.choice((2, 5, 12, 30, 60, 100)))
        if r.random() < 0.15:
            t += f" <a data-y='1' href='/y'>{_say(r, 2)}</a> {_say(r, 5)}"
        if way < 0.48:
            out.append(f'<p data-y="1">{t}</p>')
        elif way < 0.88:
            out.append(f'<div data-y="1">{t}</div>')
        else:
            out.append(f"{t}<br><br>")
    return out


def _bare(r: random.Random) -> str:
    """A page whose content has no wrapper of its own: blocks in the body, in a nameless div, in a fragment, or text alone."""
    k = r.random()
    if r.random() < 0.2:  # a few words in a nameless wrapper and nothing else
        inner = f'<div data-y="1">{_say(r, r.choice((1, 2, 2, 3, 5)))}</div>'
        return r.choice((inner, f"<html><body data-y='0'>{inner}</body></html>".replace("'", '"'), f"<body>{inner}</body>"))
    blocks = _blocks(r)
    before = "".join(_aside(r) for _ in range(r.choice((0, 0, 1, 2))))
    after = "".join(_aside(r) for _ in range(r.choice((0, 0, 1, 2))))
    if k < 0.3:
        return f'<html><head><title>{_say(r, 2)}</title></head><body data-y="1">{before}{"".join(blocks)}{after}</body></html>'
    if k < 0.65:
        inner = f'<div data-y="1">{"".join(blocks)}</div>'
        for _ in range(r.choice((0, 0, 1, 2))):
            inner = f"<div>{inner}</div>"
        return f'<html><body data-y="0">{before}{inner}{after}</body></html>'
    if k < 0.85:
        return f'<html data-y="1">{before}{"".join(blocks)}{after}'
    return '<html data-y="1">' + "\n".join(_say(r, r.choice((3, 10, 40))) for _ in range(r.randint(1, 5)))


def _page(r: random.Random) -> str:
    if r.random() < 0.36:
        return _bare(r)
    body = _content(r)
    name = r.choice(("content", "post", "entry-content", "article-body", "story", "main-text", "post-body"))
    k = r.random()
    if k < 0.4:
        body = f'<article data-y="1">{body}</article>'
    elif k < 0.5:
        body = f'<article data-y="1" class="{name}">{body}</article>'
    elif k < 0.65:
        body = f'<div data-y="1" class="{name}">{body}</div>'
    elif k < 0.72:
        body = f'<div data-y="1" id="{name}">{body}</div>'
    elif k < 0.82:
        body = f'<main data-y="1">{body}</main>'
    elif k < 0.9:
        body = f'<main><div class="wrap"><article data-y="1"><div class="{name}">{body}</div></article></div></main>'
    else:
        body = f'<section data-y="1">{body}</section>'
    before = "".join(_aside(r) for _ in range(r.randint(0, 4)))
    after = "".join(_aside(r) for _ in range(r.randint(0, 4)))
    if r.random() < 0.2:  # nothing but the article
        before = after = ""
    elif r.random() < 0.4:
        before = f'<nav data-y="0"><ul>{_links(r, 5)}</ul></nav>' + before
    if r.random() < 0.3:
        before, after = '<div class="container">' + before, after + "</div>"
    return f'<html lang="en"><head><title>{_say(r, 3)}</title></head><body data-y="0">{before}{body}{after}</body></html>'


def labelled_pages(count: int = 640, seed: int = 5):
    """(html, label function) pairs; the same for a given seed."""
    r = random.Random(seed)
    return [(_page(r), _labels) for _ in range(count)]
