"""The parts of a page, found in one scan over its tags."""

from __future__ import annotations

import re
from itertools import accumulate

# Elements whose content is never part of an article.
DROPPED = frozenset("script style noscript template nav header footer aside form iframe svg".split())
BLOCKS = frozenset(
    "address article blockquote br dd div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hr li main ol p pre section table td th tr ul".split()
)
#: The element that holds the article, in order of preference.
HOLDERS = ("article", "main", "body")
# Their content is text up to their own end, whatever it looks like.
_RAW = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "noscript", "iframe", "template")}

_NAME = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9:-]*)")
_TITLE, _TITLE_END = re.compile(r"<title\b", re.I), re.compile(r"</title>", re.I)
_META = re.compile(r"<meta\s", re.I)
_ATTRIBUTE = re.compile(r"\s*/?\s*([^\s=>/\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
_TIME, _DATETIME = re.compile(r"<time\b", re.I), re.compile(r"\sdatetime=[\"']([^\"']*)[\"']", re.I)
_STAMPS = ("article:published_time", "datepublished", "date")
_AUTHORS = ("author", "article:author")


def tokens(html: str) -> list[tuple[str, str]]:
    """A page as text pieces ("", text) and tags ("name" or "/name", ""), without comments and declarations."""
    found: list[tuple[str, str]] = []
    at, unclosed = 0, set()
    while at < len(html):
        tag = html.find("<", at)
        if tag < 0:
            break
        if tag > at:
            found.append(("", html[at:tag]))
        at = tag
        if html.startswith("<!--", tag) and "!" not in unclosed:
            end = html.find("-->", tag + 4)
            if end >= 0:
                at = end + 3
                continue
            unclosed.add("!")  # nor is any later one closed
        end = html.find(">", tag)
        if end < 0:
            break
        name = _NAME.match(html, tag)
        if not name and html[tag + 1] not in "!/?":
            found.append(("", "<"))
            at = tag + 1
            continue
        at = end + 1
        if not name:
            continue
        kind = name[1] + name[2].lower()
        if kind in _RAW and kind not in unclosed and html[end - 1] != "/":
            closing = _RAW[kind].search(html, at)
            if closing:
                at = closing.end()
                continue
            unclosed.add(kind)
        found.append((kind, ""))
    if at < len(html):
        found.append(("", html[at:]))
    return found


def article_text(html: str) -> str:
    """Text of the article block with a line feed at each block element; character references stay.

    Every element that is closed has its place on a stack of its name; those
    that are dropped count only if they are closed. The block runs from the
    first holder to the end of the last one.
    """
    found = tokens(html)
    opened: dict[str, list[int]] = {}
    change = [0] * (len(found) + 1)
    for i, (kind, _) in enumerate(found):
        if kind in DROPPED:
            opened.setdefault(kind, []).append(i)
        elif kind[:1] == "/" and opened.get(kind[1:]):
            change[opened[kind[1:]].pop()] += 1
            change[i + 1] -= 1
    seen = [t for t, depth in zip(found, accumulate(change)) if not depth]
    first: dict[str, int] = {}
    last: dict[str, int] = {}
    for i, (kind, _) in enumerate(seen):
        if kind in HOLDERS:
            first.setdefault(kind, i)
        elif kind[1:] in HOLDERS:
            last[kind[1:]] = i
    for holder in HOLDERS:
        if last.get(holder, -1) > first.get(holder, len(seen)) + 1:
            seen = seen[first[holder] + 1 : last[holder]]
            break
    return "".join(text if not kind else "\n" if kind.lstrip("/") in BLOCKS else "" for kind, text in seen)


def metas(html: str) -> dict[str, str]:
    """Contents of meta tags by lower-case name, property or itemprop; the first of a name counts."""
    found: dict[str, str] = {}
    at = 0
    while tag := _META.search(html, at):
        attributes: dict[str, str] = {}
        at = tag.end()
        while m := _ATTRIBUTE.match(html, at):
            attributes.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
            at = m.end()
        for key in ("name", "property", "itemprop"):
            if key in attributes and "content" in attributes:
                found.setdefault(attributes[key].lower(), attributes["content"])
    return found


def _title(html: str) -> str | None:
    opening = _TITLE.search(html)
    end = html.find(">", opening.end()) if opening else -1
    closing = _TITLE_END.search(html, end) if end >= 0 else None
    return html[end + 1 : closing.start()] if closing else None


def _time(html: str) -> str | None:
    """The first time tag's own time."""
    at = 0
    while tag := _TIME.search(html, at):
        at = html.find(">", tag.end())
        if at < 0:
            return None
        if marked := _DATETIME.search(html, tag.end() - 1, at):
            return marked[1]
    return None


def page_parts(html: str) -> tuple[str | None, str | None, str | None, str]:
    """Title, author, the page's own time stamp, and the article's text, all with character references."""
    named = metas(html)
    stamp = next((named[n] for n in _STAMPS if named.get(n)), None)
    author = next((named[n] for n in _AUTHORS if named.get(n)), None)
    return _title(html), author, _time(html) if stamp is None else stamp, article_text(html)
