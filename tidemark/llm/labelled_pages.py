"""Labelled pages to train the extractor on: made from a rule, since no table labels pages.

Each page is a list of parts that are either article (1) or not (0), in markup that varies as sites do:
containers by element or by class, menus, headers, footers, sidebars, notices, adverts, forms, reader
comments, also inside the article, and unclosed tags. The words are invented, so that nothing but
markup, length, links and punctuation can be learnt.
"""

from __future__ import annotations

import random

# Words by which sites name their parts.
ARTICLE = "article content post entry story main body text articleBody post-content entry-content story-body".split()
OTHER = {
    "nav": "nav menu navbar navigation breadcrumb breadcrumbs topnav pagination pager tabs toc links skip".split(),
    "header": "header masthead site-header topbar branding logo title-bar head top".split(),
    "footer": "footer site-footer bottom copyright legal colophon foot credits".split(),
    "aside": "sidebar aside widget related recommended popular trending side rail more teaser tags author bio".split(),
    "notice": "notice alert cookie cookies consent banner warning message info popup modal overlay gdpr privacy toast disclaimer".split(),
    "ad": "ad ads advert advertisement sponsor sponsored promo promotion adsense banner-ad commercial affiliate".split(),
    "form": "form search login signup subscribe newsletter contact register poll".split(),
    "comments": "comments comment comment-list discussion replies reply responses respond disqus thread reader-comments".split(),
    "share": "share social sharing follow buttons meta byline".split(),
}


def _words(r: random.Random, n: int) -> str:
    made = []
    for _ in range(n):
        word = "".join(r.choice("aeiou") + r.choice("bcdfghlmnprst") for _ in range(r.randint(1, 4)))
        made.append(word + r.choice(["", "", "", "", "", "", ","]))
    text = " ".join(made).strip(",")
    return text[:1].upper() + text[1:]


def _sentences(r: random.Random, n: int) -> str:
    return " ".join(_words(r, r.randint(3, 18)) + "." for _ in range(n))


def _other(r: random.Random, kind: str) -> list[tuple[str, int | None]]:
    """Pieces of markup; with text labelled 0, without text None."""
    name = r.choice(OTHER[kind])
    plain = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form"}
    if kind in plain and r.random() < 0.5:
        tag, attribute = plain[kind], r.choice(["", f' class="{name}"'])
    else:
        tag = r.choice(["div", "div", "section", "ul" if kind == "nav" else "div"])
        attribute = f' {r.choice(["class", "class", "id"])}="{name}"'
        if kind == "notice" and r.random() < 0.2:
            attribute = f' role="{r.choice(["alert", "dialog", "status"])}"'
    out: list[tuple[str, int | None]] = [(f"<{tag}{attribute}>", None)]
    if kind == "nav" or (kind in ("aside", "footer", "share") and r.random() < 0.4):
        inner = tag == "ul"
        out += [] if inner else [("<ul>", None)]
        for _ in range(r.randint(2, 8)):
            out += [("<li>", None), (f'<a href="/{r.random()}">{_words(r, r.randint(1, 3))}</a>', 0)]
            out += [("</li>", None)] if r.random() < 0.8 else []
        out += [] if inner else [("</ul>", None)]
    elif kind == "form":
        out.append((f"<label>{_words(r, 2)}</label> <input name='q'>", 0))
        out.append((f"<button>{_words(r, 1)}</button>", 0))
        if r.random() < 0.5:
            out.append((f"<p>{_sentences(r, 1)}</p>", 0))
    elif kind == "header":
        if r.random() < 0.5:
            out.append((f"<{r.choice(['p', 'div', 'h2', 'h1'])}>{_words(r, r.randint(1, 4))}", 0))
        else:
            out.append((f"<a href='/'>{_words(r, r.randint(1, 3))}</a> {_words(r, r.randint(1, 5))}", 0))
    elif kind == "footer":
        lead = r.choice(["&copy; ", "Copyright ", "", "&copy; 2020 "])
        out.append((f"{lead}{_words(r, 2).lower()}.example &middot; {_sentences(r, r.randint(1, 3))}", 0))
    elif kind == "comments":
        out += [(f"<h3>{_words(r, 2)}</h3>", 0)] if r.random() < 0.5 else []
        for _ in range(r.randint(1, 5)):
            out += [("<div class='comment'>" if r.random() < 0.5 else "<div>", None)]
            out += [(f"<b>{_words(r, 1)}</b>", 0)] if r.random() < 0.3 else []
            out += [(f"<p>{_sentences(r, r.randint(1, 4))}</p>", 0), ("</div>", None)]
    else:
        for _ in range(r.randint(1, 2)):
            text = _sentences(r, r.randint(1, 4))
            text = f"<a href='/x'>{text}</a>" if r.random() < 0.2 else text
            out.append((f"<p>{text}</p>" if r.random() < 0.4 else text, 0))
            out += [("<br>", None)] if r.random() < 0.1 else []
    out.append((f"</{tag}>", None))
    return out


def _article(r: random.Random) -> list[tuple[str, int | None]]:
    style = r.random()
    if style < 0.45:
        tag, attribute = "article", r.choice(["", "", f' class="{r.choice(ARTICLE)}"'])
    elif style < 0.6:
        tag, attribute = "main", r.choice(["", f' id="{r.choice(ARTICLE)}"'])
    elif style < 0.93:
        tag, attribute = r.choice(["div", "div", "section", "td"]), f' {r.choice(["class", "id"])}="{r.choice(ARTICLE)}"'
    else:
        tag, attribute = "div", ""
    out: list[tuple[str, int | None]] = [(f"<{tag}{attribute}>", None)]
    if r.random() < 0.8:
        title = (f"<h1>{_words(r, r.randint(1, 10))}{r.choice(['', '.'])}</h1>", 1)
        out += [("<header>", None), title, ("</header>", None)] if r.random() < 0.15 else [title]
    for i in range(r.choice([1, 1, 2, 3, 4, 6, 9, 14])):
        kind = r.random()
        text = _sentences(r, r.choice([1, 1, 2, 3, 5, 8])) if r.random() < 0.85 else _words(r, r.randint(1, 4)) + r.choice([".", ".", ""])
        if r.random() < 0.1:
            text = " | ".join(text.split())
        if r.random() < 0.08:
            text = text.upper().replace(" ", "!! ")
        if r.random() < 0.15:
            text = f"{text} <a href='/y'>{_words(r, 2)}</a> {_words(r, 4)}."
        if kind < 0.7:
            out.append((f"<p>{text}{r.choice(['</p>', '</p>', ''])}", 1))
        elif kind < 0.78:
            out.append((f"<p><b>{text}<br>", 1))
        elif kind < 0.84:
            out.append((f"<{r.choice(['h2', 'h3'])}>{_words(r, r.randint(1, 6))}</h2></h3>", 1))
        elif kind < 0.9:
            out += [("<ul>", None), *((f"<li>{_sentences(r, 1)}</li>", 1) for _ in range(r.randint(2, 5))), ("</ul>", None)]
        elif kind < 0.94:
            out.append((f"<blockquote>{text}</blockquote>", 1))
        elif kind < 0.97:
            out.append((f"<pre>{_words(r, 6)}</pre>", 1))
        else:
            out.append((f"<table><tr><td>{_words(r, 2)}</table>", 1))
        if i and r.random() < 0.12:
            out += _other(r, r.choice(["ad", "aside", "notice", "form", "share"]))
    if r.random() < 0.12:
        out += _other(r, "comments")
    out.append((f"</{tag}>", None))
    return out


def labelled_page(seed: int) -> tuple[str, list[int]]:
    """A page, and the label of each of its leaf blocks that have text."""
    r = random.Random(seed)
    parts: list[tuple[str, int | None]] = []
    for kind in ("notice", "header", "nav", "ad"):
        parts += _other(r, kind) if r.random() < 0.55 else []
    outer = r.random() < 0.3
    parts += [(f'<div class="{r.choice(["wrapper", "container", "page", "row", "site"])}">', None)] if outer else []
    parts += _other(r, "aside") if r.random() < 0.2 else []
    parts += _article(r)
    for kind in ("ad", "share", "comments", "aside", "form"):
        parts += _other(r, kind) if r.random() < 0.35 else []
    parts += [("</div>", None)] if outer else []
    for kind in ("notice", "nav", "footer"):
        parts += _other(r, kind) if r.random() < (0.8 if kind == "footer" else 0.2) else []
    # every part with text ends a leaf block, so that labels and blocks go together
    page = "<!DOCTYPE html><html><head><title>x</title></head><body>"
    labels: list[int] = []
    for markup, label in parts:
        page += markup
        if label is not None:
            labels.append(label)
            page += "<hr>"
    return page, labels
