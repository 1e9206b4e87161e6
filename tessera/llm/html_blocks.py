"""HTML to blocks: leaf sequences with their tag path, for the recurrent labeller.

A block is the text between two block-level tags; inline tags do not end it, ``<br>``
is white space in it. Character references are decoded, white space becomes one space.
Scripts, styles and other elements without text of the page yield nothing.
"""

from __future__ import annotations

import re
from html import unescape
from typing import NamedTuple

# Element names of the HTML standard.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed frame hr img input keygen link meta param source track wbr".split())
SILENT = frozenset("script style noscript template svg math iframe object canvas select textarea noframes audio video".split())
# An opening tag on the left closes an open element on the right.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+|[^>]*)(?:>|\Z)""", re.S)
_HINT = re.compile(r"""\b(class|id|role|data-y)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_NAME = re.compile(r"[a-z]+|\d+")


class Block(NamedTuple):
    path: tuple[str, ...]  # distinct names on the path: tags, and words of class, id and role
    text: str
    linked: float  # share of the characters inside links
    label: str  # of the nearest data-y attribute (training pages); empty without one


def blocks(html: str | None) -> list[Block]:
    """The blocks of a page in order. Null and empty pages have none."""
    html = html or ""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...], str]] = []  # tag, names, label
    active: dict[str, int] = {}
    parts: list[str] = []
    in_link, link_chars, chars = 0, 0, 0

    def flush() -> None:
        nonlocal link_chars, chars
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(tuple(active), text, link_chars / max(chars, 1), stack[-1][2] if stack else ""))
            parts.clear()
        link_chars = chars = 0

    def pop() -> None:
        nonlocal in_link
        tag, names, _ = stack.pop()
        in_link -= tag == "a"
        for n in names:
            if active[n] == 1:
                del active[n]
            else:
                active[n] -= 1

    def text(piece: str) -> None:
        nonlocal link_chars, chars
        if piece:
            parts.append(unescape(piece) if "&" in piece else piece)
            n = len(piece)
            chars += n
            link_chars += n * (in_link > 0)

    at = 0
    while m := _TAG.search(html, at):
        text(html[at:m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if tag == "br":
            parts.append(" ")
            continue
        if tag in SILENT and not closing and not m[3].endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(html, at)
            at = end.end() if end else len(html)
            if tag not in INLINE:
                flush()
            continue
        if tag not in INLINE:
            flush()
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    while len(stack) > k:
                        pop()
                    break
            continue
        if tag in VOID:
            continue
        if tag not in INLINE:
            shut = CLOSES.get(tag, ()) if tag in CLOSES else ()
            k = len(stack) - 1
            while k >= 0 and (stack[k][0] in INLINE or stack[k][0] in shut):
                k -= 1
            if any(s[0] in shut for s in stack[k + 1:]):
                while len(stack) > k + 1:
                    pop()
            k = len(stack) - 1
            while k >= 0 and stack[k][0] in INLINE:
                k -= 1
            if k >= 0 and stack[k][0] == "p":  # a paragraph ends where another block begins
                while len(stack) > k:
                    pop()
        names, label = [tag], stack[-1][2] if stack else ""
        for key, *values in _HINT.findall(m[3]):
            value = "".join(values)
            if key.lower() == "data-y":
                label = value
            else:
                names += [f"{key[0].lower()}.{w}" for w in _NAME.findall(value.lower())]
        names = tuple(names)
        stack.append((tag, names, label))
        in_link += tag == "a"
        for n in names:
            active[n] = active.get(n, 0) + 1
    text(html[at:])
    flush()
    return out
