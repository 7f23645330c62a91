"""What a page shows and names, by one scan of its markup that never goes back."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

#: A tag up to its end; a quoted value may hold its end sign. Nothing is tried twice, and a quote that never closes is a sign like others.
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)>""")
_ATTRIBUTE = re.compile(r"""([^\s/=>]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++)))?+""")
_LANGUAGE = re.compile(r"[A-Za-z0-9-]+")
# Elements that are not shown, those that start a line, and those that may stand in a head.
_RAW = frozenset("script style noscript template".split())
_BREAKS = frozenset(
    "address article aside blockquote body br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li"
    " main nav ol p pre section table tbody td tfoot th thead tr ul".split()
)
_IN_HEAD = frozenset("base basefont bgsound link meta html head title noframes".split()) | _RAW
_ENDS_HEAD = frozenset("head body html br".split())
_CLOSING = {name: re.compile(rf"</{name}\s*+>", re.IGNORECASE) for name in (*_RAW, "title", "noframes")}


@dataclass
class Page:
    """Text as shown, a block element a line; the first title; the language of the page; the links in order, each once."""

    text: str = ""
    title: str | None = None
    language: str | None = None
    links: list[str] = field(default_factory=list)


def _attribute(said: str, name: str) -> str | None:
    """The first value that a tag gives to an attribute."""
    for found in _ATTRIBUTE.finditer(said):
        if found[1].lower() == name:
            return "".join(found.groups("")[1:])
    return None


def read_page(page: str) -> Page:
    """Read a page in time that is proportional to its length.

    Comments, scripts, styles, templates, titles and the head are not shown; they end with the page where their end is
    missing, but a title without end is a tag. A head ends at its closing tag, or at the first tag or
    text that cannot stand in one. What begins like a tag and does not end is text, as is all that
    follows, for nothing after it can end either. Entities are replaced; lines are stripped, and empty ones left out.
    """
    found, parts = Page(), []
    at, size, in_head, titles = 0, len(page), False, True
    links: dict[str, None] = {}
    while at < size:
        start = page.find("<", at)
        if start < 0:
            start = size
        if start > at:
            shown = page[at:start]
            if not in_head or not shown.isspace():
                in_head = False
                parts.append(shown)
        if start == size:
            break
        follows = page[start + 1 : start + 2]
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = end + 3 if end >= 0 else size
            parts.append(" ")
            continue
        if follows in ("!", "?"):
            end = page.find(">", start)
            if end < 0:
                parts.append(page[start:])
                break
            at = end + 1
            continue
        if not (follows.isascii() and follows.isalpha()) and not (follows == "/" and page[start + 2 : start + 3].isascii() and page[start + 2 : start + 3].isalpha()):
            in_head = False
            parts.append("<")
            at = start + 1
            continue
        tag = _TAG.match(page, start)
        if tag is None:
            parts.append(page[start:])
            break
        at, closing, name = tag.end(), tag[1] == "/", tag[2].lower()
        if in_head and (name in _ENDS_HEAD if closing else name not in _IN_HEAD):
            in_head = False
            if closing and name == "head":
                parts.append(" ")
                continue
        if not closing:
            if name == "head":
                in_head = True
                continue
            if name == "a":
                link = _attribute(tag[3], "href")
                if link is not None:
                    links[link] = None
            if name == "html" and found.language is None:
                language = _LANGUAGE.match(_attribute(tag[3], "lang") or "")
                found.language = language and language[0]
            if name in _RAW or name == "noframes" and in_head or name == "title" and titles:
                end = _CLOSING[name].search(page, at)
                if name == "title":
                    titles = end is not None  # no later one can end either
                    if titles and found.title is None:
                        found.title = page[at : end.start()]
                if end is not None or name != "title":
                    at = end.end() if end is not None else size
                    parts.append(" ")
                    continue
        if not in_head and name in _BREAKS:
            parts.append("\n")
    text = "".join(parts)
    if "&" in text:
        text = html.unescape(text)
    lines = (" ".join(line.split()) for line in text.splitlines())
    found.text = "\n".join(line for line in lines if line)
    found.links = list(links)
    return found
