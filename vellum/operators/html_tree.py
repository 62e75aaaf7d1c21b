"""Pages of HTML as elements with their strings: one pass of the standard parser, or one pattern for plain markup."""

from __future__ import annotations

import re
from html import unescape
from html.parser import HTMLParser

# Elements without content, and the open elements that a start tag closes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDS_PARAGRAPH = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"td", "th", "tr"},
    "tbody": {"td", "th", "tr", "thead", "tbody"}, "tfoot": {"td", "th", "tr", "thead", "tbody"}, "thead": {"td", "th", "tr"},
}
STOPS = frozenset(["table", "ul", "ol", "dl", "select"])
MULTIPLE = frozenset(["class", "rel"])


class _Tree(HTMLParser):
    """Elements of a page with their strings."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[dict] = []
        self.open: list[int] = []
        self.strings: list[tuple[int, str]] = []  # position among elements, string

    def _close_to(self, k: int) -> None:
        last, end = len(self.rows) - 1, len(self.strings)
        for i in self.open[k:]:
            row = self.rows[i]
            row["last"], row["end"] = last, end
        del self.open[k:]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ENDS_PARAGRAPH:
            for k in range(len(self.open) - 1, -1, -1):
                name = self.rows[self.open[k]]["tag"]
                if name == "p":
                    self._close_to(k)
                    break
                if name in ENDS_PARAGRAPH or name in ("td", "th", "li", "body"):
                    break
        closes = CLOSES.get(tag)
        if closes:
            lowest = None
            for k in range(len(self.open) - 1, -1, -1):
                name = self.rows[self.open[k]]["tag"]
                if name in STOPS:
                    break
                if name in closes:
                    lowest = k
            if lowest is not None:
                self._close_to(lowest)
        known = {}
        for name, value in attrs:
            known.setdefault(name, value or "")
        number, at = len(self.rows), len(self.strings)
        self.rows.append({"tag": tag, "parent": self.open[-1] if self.open else None, "depth": len(self.open), "attrs": known, "last": number, "start": at, "end": at, "own": []})
        if tag not in VOID:
            self.open.append(number)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self.open) - 1, -1, -1):
            if self.rows[self.open[k]]["tag"] == tag:
                self._close_to(k)
                break

    def handle_data(self, data: str) -> None:
        self.strings.append((len(self.rows), data))
        if self.open:
            self.rows[self.open[-1]]["own"].append(data)


#: A tag whose attributes, if any, are quoted and hold no character reference, or a run of text.
PLAIN = re.compile(r"""<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:\s+[a-zA-Z][-a-zA-Z0-9_]*(?:=(?:"[^"<>&]*"|'[^'<>&]*'))?)*)\s*>|([^<]+)""")
ATTRIBUTE = re.compile(r"""([a-zA-Z][-a-zA-Z0-9_]*)(?:=(?:"([^"]*)"|'([^']*)'))?""")
#: Elements whose content is no markup.
RAW = frozenset("iframe noembed noframes noscript plaintext script style textarea title xmp".split())


def tree_of(html: str) -> _Tree:
    """The elements of a page. Plain markup is cut by one pattern; a page with anything else is read by the full parser, with equal results."""
    tree, at = _Tree(), 0
    start, end, data = tree.handle_starttag, tree.handle_endtag, tree.handle_data
    for m in PLAIN.finditer(html):
        first, stop = m.span()
        if first != at:
            break
        closing, name, attrs, text = m.groups()
        if text is None:
            name = name.lower()
            if name in RAW or (closing and attrs):
                break
            if closing:
                end(name)
            else:
                start(name, [(k.lower(), a if a or not b else b) for k, a, b in ATTRIBUTE.findall(attrs)] if attrs else [])
        elif "&" not in text:
            data(text)
        elif stop < len(html):
            data(unescape(text))
        else:  # a reference that the page's end may cut short
            break
        at = stop
    if at < len(html):
        tree = _Tree()
        tree.feed(html)
        tree.close()
    tree._close_to(0)
    return tree
