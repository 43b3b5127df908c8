"""A tree-building HTML parser in plain Python, the check for ``clean_html``."""

from __future__ import annotations

import re
from collections import Counter
from html.entities import html5
from html.parser import HTMLParser

from panelflow.functions.html import DROPPED_TAGS, HIDDEN_TAGS, VOID_TAGS

_HIDING = frozenset([*DROPPED_TAGS, *HIDDEN_TAGS])
_VERBATIM = frozenset(("pre", "textarea"))
_REFERENCE = re.compile(r"&(?:#([0-9]+|[xX][0-9a-fA-F]+)|([a-zA-Z][-.a-zA-Z0-9]*));?")


def _named(name: str) -> str:
    return html5.get(name + ";", "&" + name)


def _numbered(number: str) -> str:
    try:
        code = int(number[1:], 16) if number[0] in "xX" else int(number)
        return bytes([code]).decode("cp1252", "replace") if code < 256 else chr(code)
    except (ValueError, OverflowError):
        return "\ufffd"


class _TextNodes(HTMLParser):
    """Collects visible text nodes, tracking the open elements as a tree builder would.

    Open elements are also counted by name, so deep nesting does not slow it down.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=False)
        self.path: list[str] = []
        self.open: Counter[str] = Counter()
        self.hiding = 0
        self.verbatim = 0
        self.nodes: list[str] = []
        self.pending: list[str] = []

    def flush(self) -> None:
        text = "".join(self.pending)
        self.pending.clear()
        if not text or self.hiding:
            return
        if not self.verbatim and not text.strip(" \n\t\f\r"):
            text = "\n" if "\n" in text else " "
        self.nodes.append(text)

    def _count(self, tag: str, step: int) -> None:
        self.open[tag] += step
        self.hiding += step * (tag in _HIDING)
        self.verbatim += step * (tag in _VERBATIM)

    def handle_starttag(self, tag, attrs):
        self.flush()
        if tag not in VOID_TAGS:
            self.path.append(tag)
            self._count(tag, 1)

    def handle_startendtag(self, tag, attrs):
        self.flush()

    def handle_endtag(self, tag):
        self.flush()
        closed = None
        while self.open[tag] and closed != tag:
            closed = self.path.pop()
            self._count(closed, -1)

    def handle_data(self, data):
        self.pending.append(data)

    def handle_entityref(self, name):
        self.pending.append(_named(name))

    def handle_charref(self, name):
        self.pending.append(_numbered(name))

    def handle_comment(self, data):
        self.flush()

    handle_decl = handle_pi = handle_comment

    def parse_marked_section(self, i, report=1):
        """A malformed section is a comment up to the next ``>``, not an error."""
        if self.rawdata.startswith("<![CDATA[", i) and self.rawdata.find("]]>", i) >= 0:
            return super().parse_marked_section(i, report)
        return self.parse_bogus_comment(i)

    def unknown_decl(self, data):
        self.flush()
        if data.upper().startswith("CDATA["):
            self.pending.append(data[len("CDATA["):])
            self.flush()


def parse_visible_text(html: str) -> str:
    """Visible text of one page, in time linear in its length.

    Behind the last ``-->`` a comment cannot end and behind the last ``>`` no tag can, so
    what starts there is text; the parser would search the rest of the page at each one.
    """
    last_comment = html.rfind("-->") + 1
    html = html[:last_comment] + html[last_comment:].replace("<!--", "&lt;!--")
    last_tag = html.rfind(">") + 1
    parser = _TextNodes()
    parser.feed(html[:last_tag])
    parser.close()
    parser.handle_data(
        _REFERENCE.sub(lambda m: _numbered(m[1]) if m[1] else _named(m[2]), html[last_tag:])
    )
    parser.flush()
    lines = " ".join(parser.nodes).splitlines()
    chunks = (c.strip() for line in lines for c in line.split("  "))
    return " ".join(c for c in chunks if c)
