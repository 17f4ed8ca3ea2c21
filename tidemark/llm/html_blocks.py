"""Leaf blocks of HTML pages: runs of text between the boundaries of block elements.

As in HTML, a comment that is never closed, and a script, style, iframe, textarea or the like that is never
closed, reach to the end of the page. The work grows with the length of the page, however deep its elements are;
only the names that a block has from its ancestors grow with their number.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import defaultdict
from dataclasses import dataclass

# Names of elements by what they do, from the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(
    "script style title textarea template noscript iframe noembed noframes xmp svg head".split()
)
NESTING = frozenset(("svg", "template"))  # raw only if they are closed; otherwise like any other element
BLOCK = frozenset(
    """address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol
    optgroup option p pre search section select summary table tbody td tfoot th thead tr ul""".split()
)
PARTS = frozenset("article aside dialog footer form header main menu nav search section".split())
CLOSES_P = BLOCK - frozenset("body button caption html legend optgroup option select td th tr tbody thead tfoot".split())
#: An element that begins closes these, up to the nearest of those.
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select",)),
    "optgroup": (("option", "optgroup"), ("select",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tbody": (("tr", "td", "th", "tbody", "thead", "tfoot"), ("table",)),
    "tfoot": (("tr", "td", "th", "tbody", "thead", "tfoot"), ("table",)),
    "a": (("a",), ("table", "td", "div", "li", "p")),
}

# quotes count only where a value begins
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:"[^"]*"|'[^']*')?+)*+)>""")
_COMMENT_END = re.compile(r"--!?>")
_LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>?")
_RAW_END = {name: re.compile(f"</{name}", re.I | re.A) for name in RAW}
_NAMES = re.compile(
    r"""(?:^|[\s"'])(class|id|role|hidden|style|aria-hidden|itemprop)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I
)
_TOKEN = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+")


@dataclass(frozen=True)
class Path:
    """An open block element and what names it and its ancestors."""

    tag: str
    names: frozenset[str]
    nearest: frozenset[str]  # names of the nearest ancestor that tells its part of the page


@dataclass
class Block:
    text: str
    path: Path
    linked: int  # characters inside links


def name_tokens(attributes: str) -> list[str]:
    """Words of the class, id and role, lowered; ``hidden`` for elements that are not shown."""
    tokens = []
    for name, value in _NAMES.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id", "role", "itemprop"):
            tokens += [t.lower() for t in _TOKEN.findall(value)]
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            tokens.append("hidden")
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            tokens.append("hidden")
    return tokens


ROOT = Path("root", frozenset(), frozenset())


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page that have text, in page order."""
    found: list[Block] = []
    stack: list[tuple[str, Path]] = []  # open elements, each with the path of the block it is in
    places: dict[str, list[int]] = defaultdict(list)  # where each tag's elements are in the stack
    parts: list[str] = []
    owner, linked = ROOT, 0
    cache: dict[tuple[Path, str, str], Path] = {}

    def path() -> Path:
        return stack[-1][1] if stack else ROOT

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                found.append(Block(text, owner, linked))
            parts.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal owner, linked
        if not raw:
            return
        if not parts:
            owner = path()
        parts.append(raw)
        if any(tag == "a" for tag, _ in stack[-6:]):
            linked += len(raw.strip())

    def cut_at(cut: int) -> None:
        """Close the elements from this place of the stack on."""
        if any(tag in BLOCK for tag, _ in stack[cut:]):
            flush()
        for tag, _ in stack[cut:]:
            places[tag].pop()
        del stack[cut:]

    def close(names: tuple[str, ...], limits: tuple[str, ...]) -> None:
        """Close the outermost open element of these names that is inside the nearest limit."""
        held = [own for n in names if (own := places.get(n))]
        if not held:
            return
        limit = max((places[n][-1] for n in limits if places.get(n)), default=-1)
        inside = [own[at] for own in held if (at := bisect_right(own, limit)) < len(own)]
        if inside:
            cut_at(min(inside))

    at, end = 0, len(page)
    unclosed: set[str] = set()
    while at < end:
        mark = page.find("<", at)
        if mark < 0:
            add(page[at:])
            break
        add(page[at:mark])
        following = page[mark + 1 : mark + 2]
        if following == "!" or following == "?":
            if page.startswith("<!--", mark):
                if page.startswith((">", "->"), mark + 4):  # these end at once
                    at = page.index(">", mark) + 1
                else:
                    stop = _COMMENT_END.search(page, mark + 4)
                    at = end if stop is None else stop.end()
            else:
                stop = page.find(">", mark)
                at = end if stop < 0 else stop + 1
            continue
        tag = _TAG.match(page, mark) or _LOOSE_TAG.match(page, mark)
        if tag is None:
            if following == "/":
                stop = page.find(">", mark)
                at = end if stop < 0 else stop + 1
            else:
                add("<")
                at = mark + 1
            continue
        at = tag.end()
        name = tag.group(2).lower()
        if tag.group(1):
            if name == "br" or not places.get(name):
                if name in ("p", "br"):
                    flush() if name == "p" else add(" ")
                continue
            cut_at(places[name][-1])
            continue
        if name in RAW and name not in unclosed and not tag.group(3).endswith("/"):
            if name == "head":
                # what a head may hold is skipped by itself
                continue
            closing = _RAW_END[name].search(page, at)
            if closing is not None:
                stop = page.find(">", closing.start())
                at = end if stop < 0 else stop + 1
                continue
            if name not in NESTING:
                break
            unclosed.add(name)
        if name in IMPLIED:
            close(*IMPLIED[name])
        if name in CLOSES_P:
            close(("p",), ("button", "table", "td", "th"))
        if name in BLOCK:
            flush()
        elif name in ("br", "wbr", "img", "input"):
            add(" " if name != "wbr" else "")
        if name in VOID:
            continue
        outer = path()
        tokens = name_tokens(tag.group(3)) if tag.group(3) else []
        if name in BLOCK or tokens:
            key = (outer, name, " ".join(tokens))
            if key not in cache:
                own = {f"t={name}"} | {f"c={t}" for t in tokens} if name in BLOCK else {f"c={t}" for t in tokens}
                names = outer.names if own <= outer.names else outer.names | own
                tells = bool(tokens) or name in PARTS
                cache[key] = Path(
                    name if name in BLOCK else outer.tag, names, frozenset(own) if tells else outer.nearest
                )
            inner = cache[key]
        else:
            inner = outer
        places[name].append(len(stack))
        stack.append((name, inner))
    flush()
    return found
