"""Tags and comments of an HTML page, in time linear in its length whatever the page holds.

A tag is `<`, an optional `/`, a name and everything up to the first `>` outside quotes; a `<` whose tag
never ends is text.  Whether one ends is known without reading on to the end of the page for each
of them: after the first that does not, `_Ends` holds for every quote and `>` of the page where a tag that is
outside quotes there would end.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

_NAME = re.compile(r"""<(/?)([a-zA-Z][^\s/<>"']*+)""")
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/<>"']*+)((?:"[^"]*"|'[^']*'|[^'">])*+)>""")
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]++)(?:\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
_SPECIAL = re.compile("[\"'>]")


class Token(NamedTuple):
    start: int
    end: int  # of a raw element: after its closing tag
    tag: str  # lower case; empty for comments, declarations and processing instructions
    closing: bool
    attributes: str
    skipped: bool  # a comment or a raw element with all it holds


class _Ends:
    """Where a tag ends (the place of its `>`, or -1) that is outside quotes at a given place."""

    def __init__(self, page: str) -> None:
        self.places = array("q", (m.start() for m in _SPECIAL.finditer(page)))
        self.ends = array("q", bytes(8 * len(self.places)))
        following = {'"': -1, "'": -1}
        for k in range(len(self.places) - 1, -1, -1):
            c = page[self.places[k]]
            if c == ">":
                self.ends[k] = self.places[k]
            else:
                closed = following[c]  # the next quote of this kind
                self.ends[k] = self.ends[closed + 1] if 0 <= closed < len(self.places) - 1 else -1
                following[c] = k

    def of(self, place: int) -> int:
        k = bisect_left(self.places, place)
        return self.ends[k] if k < len(self.places) else -1


def tokens(page: str, raw: frozenset[str]) -> Iterator[Token]:
    """Tags, comments and the like in order; elements of `raw` are one token up to their closing tag or the end of the page."""
    ends: _Ends | None = None
    last = page.rfind(">")
    closes = {name: re.compile(rf"</{name}\s*+>", re.I) for name in raw}
    at = page.find("<")
    while at >= 0:
        following = page[at + 1 : at + 2]
        found = None
        if following in ("!", "?"):
            if page.startswith("<!--", at):
                end = page.find("-->", at + 4)
                found = Token(at, end + 3 if end >= 0 else len(page), "", False, "", True)
            elif at < last:
                found = Token(at, page.index(">", at) + 1, "", False, "", False)
        elif at < last and (whole := _TAG.match(page, at) if ends is None else _NAME.match(page, at)):
            end = whole.end() if ends is None else ends.of(whole.end()) + 1
            if end:
                closing, tag = whole[1] == "/", whole[2].lower()
                inner = page[whole.end(2) : end - 1]
                if tag in raw and not closing:
                    close = closes[tag].search(page, end)
                    found = Token(at, close.end() if close else len(page), tag, False, inner, True)
                else:
                    found = Token(at, end, tag, closing, inner, False)
        elif at < last and ends is None and _NAME.match(page, at):
            ends = _Ends(page)
        if found:
            yield found
        at = page.find("<", found.end if found else at + 1)


def attributes(text: str) -> Iterator[tuple[str, str]]:
    """(lower-case name, value) of a tag's attributes; without a value: the empty string."""
    for m in _ATTRIBUTE.finditer(text):
        yield m[1].lower(), "".join(m.groups("")[1:])
