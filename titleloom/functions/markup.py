"""Titles and links of a page in one pass over its markup, as a machine of a few states.

Text, tags, raw text (scripts and styles), comments, instructions ``<?...>``, declarations ``<!...>`` and marked
sections ``<![CDATA[...]]>`` each have the place where they end; only tags and text have a meaning for the page.
What is not closed runs to the end. A "<" that opens nothing is text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

TEXT, OPEN, CLOSE = "text", "open", "close"

# Fixed value: elements that never have a close tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset({"script", "style"})

#: What follows "<" decides on the state. The order matters: the first that fits.
_OPENS = re.compile(
    r"""<(?:
      (?P<comment>!--)
    | !\[\s*(?P<section>cdata|temp|ignore|include|rcdata)(?=[\s\[])
    | (?P<other>[!?]|/\s*(?![\sa-z]))
    | /\s*(?P<close>[a-z][^\s/>]*)
    | (?P<open>[a-z][^\s/>]*)
    )""",
    re.IGNORECASE | re.VERBOSE,
)
_COMMENT_END, _SECTION_END = re.compile(r"--\s*>"), re.compile(r"\]\s*\]\s*>")
_SECTION_BEGIN = re.compile(r"\s*\[")
#: The rest of an opening tag; a quoted value may hold ">".
_OPEN_REST = re.compile(r"""[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+>""")
_RAW_END = {name: re.compile(rf"</\s*{name}\s*>", re.IGNORECASE) for name in RAW}
#: An attribute starts after white space or a slash, or right behind a quoted value.
_ATTRIBUTE = re.compile(
    r"""(?:[\s/]+|(?<=["']))([^\s=>/][^\s=>/]*)(?:\s*=+\s*("[^"]*"|'[^']*'|(?!["'])[^\s>]*))?"""
)


def _end(pattern: re.Pattern, html: str, at: int) -> tuple[int, int]:
    """Where the found end begins and ends; the end of the page without one."""
    found = pattern.search(html, at)
    return found.span() if found else (len(html), len(html))


def tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """``(kind, name, rest)`` of tags, with names in lower case, and ``(TEXT, "", text)``, entities encoded."""
    at = begin = 0  # text from ``begin`` on is not yet told
    while found := _OPENS.search(html, at):
        kind, name = found.lastgroup, (found["open"] or found["close"] or "").lower()
        at = found.end()
        if kind == "open":
            rest = _OPEN_REST.match(html, at)
            if not rest:
                at = found.start() + 1
                continue
            end = rest.end()
        elif kind == "comment":
            end = _end(_COMMENT_END, html, at)[1]
        elif kind == "section":
            inner, end = _end(_SECTION_END, html, at)
        else:
            end = html.find(">", at) + 1 or len(html)
        if begin < found.start():
            yield TEXT, "", html[begin:found.start()]
        if kind == "open":
            yield OPEN, name, html[at:end - 1]
            if name in RAW and html[end - 2] != "/":  # one that closes itself holds nothing
                end = _end(_RAW_END[name], html, end)[0]
        elif kind == "close":
            yield CLOSE, name, ""
        elif kind == "section" and found["section"].lower() == "cdata":
            opened = _SECTION_BEGIN.match(html, at)
            yield TEXT, "", html[opened.end() if opened else at:inner].replace("&", "&amp;")
        at = begin = end
    if begin < len(html):
        yield TEXT, "", html[begin:]


def href_of(rest: str) -> str | None:
    """The last ``href`` among the attributes of a tag; empty without a value."""
    value = None
    for name, found in _ATTRIBUTE.findall(rest):
        if name.lower() == "href":
            value = found[1:-1] if found[:1] in ("'", '"') else found
    return value


def read_page(html: str) -> tuple[str | None, list[str]]:
    """Text of the first H1 and the targets of all links, entities encoded.

    An H1 ends with its own close tag or with that of an element around it, and one that closes itself is empty.
    The title is None without an H1.
    """
    stack: list[str] = []  # open elements; the H1 is at ``depth`` while it is open
    depth, title, done, links = 0, [], None, []
    for kind, name, rest in tokens(html):
        if kind == TEXT:
            if depth:
                title.append(rest)
        elif kind == OPEN:
            if name == "a" and (href := href_of(rest)) is not None:
                links.append(href)
            first = name == "h1" and not depth and done is None
            if rest.endswith("/"):
                done = "" if first else done
            elif name not in VOID:
                stack.append(name)
                depth = len(stack) if first else depth
        elif name in stack:
            del stack[len(stack) - 1 - stack[::-1].index(name):]
            if depth > len(stack):
                depth, done = 0, "".join(title)
    return "".join(title) if depth else done, links
