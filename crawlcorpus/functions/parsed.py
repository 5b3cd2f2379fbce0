"""A tolerant HTML reader for pages that defeat patterns.

Same result as ``html.blocks_to_text``, from the standard event parser, in Arrow
batches. Slower by the trip through Python: use it on the pages that need it. Of a batch, which
Spark ends at 64 MB, no more than ``SLICE_PAGES`` pages are Python strings at once.
"""

from html.entities import html5
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, functions as F

from ..schema import INLINE_ELEMENTS
from .html import LEGACY_LATIN
from .text import normalize_space

_INLINE = frozenset(INLINE_ELEMENTS)
_DROPPED = frozenset(["script", "style", "noscript"])
SLICE_PAGES = 64


class _Blocks(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.parts, self.dropping = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in _DROPPED:
            self.dropping += 1
        elif tag not in _INLINE:
            self.parts.append("\n")

    def handle_startendtag(self, tag, attrs):
        if tag not in _INLINE:
            self.parts.append("\n")

    def handle_endtag(self, tag):
        if tag in _DROPPED:
            self.dropping = max(0, self.dropping - 1)
        elif tag not in _INLINE:
            self.parts.append("\n")

    def handle_data(self, data):
        if not self.dropping:
            self.parts.append(data)

    def handle_entityref(self, name):
        self.handle_data(html5.get(f"{name};", f"&{name}"))

    def handle_charref(self, name):
        code = int(name[1:], 16) if name[0] in "xX" else int(name)
        if 128 <= code <= 159:
            self.handle_data(LEGACY_LATIN[code - 128])
        elif code > 0x10FFFF:
            self.handle_data("\ufffd")
        elif code:
            self.handle_data(chr(code))

    def handle_comment(self, data):
        self.parts.append("\n")


def _blocks(page: str) -> str:
    parser = _Blocks()
    parser.feed(page)
    parser.close()
    # lone surrogates cannot go back over Arrow
    return "".join(parser.parts).encode("utf-8", "replace").decode("utf-8")


def _blocks_of(pages: pa.Array) -> pa.Array:
    done = [pa.array([None if page is None else _blocks(page) for page in
                      pages.slice(at, SLICE_PAGES).to_pylist()], pa.string())
            for at in range(0, len(pages), SLICE_PAGES)]
    return pa.concat_arrays(done) if done else pa.array([], pa.string())


def parsed_to_text(html: Column) -> Column:
    return normalize_space(F.arrow_udf(_blocks_of, "string")(html))
