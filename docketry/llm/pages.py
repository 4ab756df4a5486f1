"""Leaf sequences of records: runs of text between the tags of a page, or the lines of a text taken from one."""

from __future__ import annotations

import re
from html import unescape

_TAG = re.compile(r"<!--.*?-->|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*)*)>", re.S)
_CLASS = re.compile(r"class\s*=\s*[\"']?([\w-]+)")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is no part of what a reader sees.
HIDDEN = frozenset(("title", "script", "style", "noscript"))


def page_leaves(html: str | None) -> tuple[list[tuple[str, tuple[str, ...], tuple[int, ...]]], str]:
    """([(text, tag path, ids of the enclosing elements)], text of noscript) of a page.

    A leaf is a run of text between two tags or comments that is not blank, in document order; text within title,
    script, style and noscript is no leaf. Closing tags that close nothing are skipped, and what is never closed ends
    with the page.
    """
    leaves, hidden = [], []
    if not html:
        return leaves, ""
    stack: list[tuple[str, tuple[str, ...], tuple[int, ...]]] = []
    path: tuple[str, ...] = ()
    around: tuple[int, ...] = ()
    n, at, end = 0, 0, len(html)

    def leaf(text: str) -> None:
        if text and not text.isspace():
            text = " ".join((unescape(text) if "&" in text else text).split())
            if text:
                leaves.append((text, path, around))

    for m in _TAG.finditer(html):
        begin = m.start()
        if begin < at:
            continue
        if begin > at:
            leaf(html[at:begin])
        at = m.end()
        closing, tag, rest = m.groups()
        if tag is None:
            continue
        tag = tag.lower()
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    _, path, around = stack[k]
                    del stack[k:]
                    break
        elif tag in HIDDEN:
            close = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            if tag == "noscript":
                hidden.append(html[at : close.start() if close else end])
            at = close.end() if close else end
        elif tag not in _VOID and not rest.endswith("/"):
            n += 1
            c = _CLASS.search(rest) if "class" in rest else None
            stack.append((tag, path, around))
            path, around = (*path, f"{tag}.{c.group(1)}" if c else tag), (*around, n)
    leaf(html[at:])
    return leaves, " ".join(unescape(re.sub(r"<[^>]*>", " ", " ".join(hidden))).split())


def text_leaves(text: str | None) -> list[tuple[int, str]]:
    """(line number from 1, line) of the lines that are not blank; blank lines are counted."""
    return [(i, " ".join(x.split())) for i, x in enumerate((text or "").split("\n"), 1) if x.strip()]
