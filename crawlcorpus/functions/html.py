"""HTML to text with regular expressions that Spark compiles into the scan's stage.

The passes run in the order that a tree builder would force: whole dropped elements
first (their bodies may hold anything that looks like markup), then comments, then
tags, and character references last, so that an escaped ``<`` never becomes a tag.
"""

from html.entities import html5

from pyspark.sql import Column, functions as F

from ..schema import INLINE_ELEMENTS
from .text import LEGACY_LATIN, normalize_space

#: Attributes may hold ``>`` inside quotes. The repeat is possessive, which the JVM's matcher
#: runs as a loop, so a tag may have any number of quotes; one with a quote that is never
#: closed ends at its first ``>``.
_REST_OF_TAG = r"""(?:(?:[^>"']++|"[^"]*"|'[^']*')*+>|[^>]*>)"""
ANY_TAG = rf"</?[a-zA-Z]{_REST_OF_TAG}"
COMMENT = r"(?s)<!--.*?(?:-->|\z)|<![a-zA-Z\[][^>]*>|<\?[^>]*>"
INLINE_TAG = (rf"(?i)</?(?:{'|'.join(INLINE_ELEMENTS)})"
              rf"(?:/?>|[\s/]{_REST_OF_TAG})")


def elements(*names: str) -> str:
    """Pattern for elements with their bodies; an unclosed one runs to the end."""
    bodies = [rf"{name}(?:\s[^>]*)?>.*?(?:</{name}\s*>|\z)" for name in names]
    return rf"(?is)<(?:{'|'.join(bodies)})"


def replace_all(text: Column, patterns, by: str) -> Column:
    for pattern in patterns:
        text = F.regexp_replace(text, pattern, by)
    return text


#: A reference; the semicolon may be missing.
REFERENCE = "&(?:[a-zA-Z][-.a-zA-Z0-9]*|#[0-9]+|#[xX][0-9a-fA-F]+);?"


def _character(code: Column) -> Column:
    """The character of a code point; U+FFFD where there is none, nothing for NUL."""
    legacy = F.substring(F.lit(LEGACY_LATIN), (code - 127).cast("int"), F.lit(1))
    return (F.when(code.isNull() | (code > 0x10FFFF), "\ufffd").when(code == 0, "")
            .when(code.between(0xD800, 0xDFFF), "?").when(code.between(128, 159), legacy)
            .otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")))


def _named(name: Column) -> Column:
    """By the standard table, as one literal; an unknown name stays, less its semicolon."""
    table = "\x1e".join(f"{key[:-1]}\x1f{value}" for key, value in sorted(html5.items())
                        if key.endswith(";"))
    names = F.str_to_map(F.lit(table), F.lit("\x1e"), F.lit("\x1f"))
    return (F.when(name == "amp", "&").when(name == "nbsp", "\xa0").when(name == "quot", '"')
            .when(name == "lt", "<").when(name == "gt", ">")
            .otherwise(F.coalesce(F.try_element_at(names, name), F.concat(F.lit("&"), name))))


def _decoded(reference: Column) -> Column:
    """One character reference such as ``&copy;``, ``&#169;`` or ``&#xa9;``."""
    body = F.regexp_replace(reference, "^&#?|;$", "")
    code = F.when(body.rlike("^[xX]"), F.conv(F.substr(body, F.lit(2)), 16, 10)
                  ).otherwise(body).try_cast("bigint")
    return F.when(reference.startswith("&#"), bound(code, _character)
                  ).otherwise(_named(body))


def unescape(text: Column) -> Column:
    """Decode character references, each once.

    The text is cut at its references and joined again with what they stand for.
    """
    def rejoined(t):
        found = F.regexp_extract_all(t, F.lit(REFERENCE), F.lit(0))
        decoded = F.concat(F.transform(found, _decoded), F.array(F.lit("")))
        between = F.split(t, REFERENCE, -1)
        return F.array_join(F.zip_with(between, decoded, lambda a, b: F.concat(a, b)), "")
    return bound(text, lambda t: F.when(t.contains("&"), rejoined(t)).otherwise(t))


def bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def tags_to_text(html: Column) -> Column:
    """Every tag breaks the line; script and style go, noscript stays."""
    marked = replace_all(html, [elements("script", "style"), COMMENT, ANY_TAG], "\n")
    return normalize_space(unescape(marked))


def blocks_to_text(html: Column) -> Column:
    """Only block tags and ``<br>`` break the line; script, style and noscript go."""
    kept = F.regexp_replace(html, elements("script", "style", "noscript"), "")
    joined = F.regexp_replace(F.regexp_replace(kept, COMMENT, "\n"), INLINE_TAG, "")
    return normalize_space(unescape(F.regexp_replace(joined, ANY_TAG, "\n")))


def clean_html(html: Column) -> Column:
    """The markup itself, without script and style."""
    return F.regexp_replace(html, elements("script", "style"), "")
