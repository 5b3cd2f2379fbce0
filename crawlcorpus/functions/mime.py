"""MIME predicates. NULL in gives NULL out; the outcome chain calls that an error."""

from functools import reduce
from operator import or_

from pyspark.sql import Column

from ..schema import HTML_LIKE_TYPES, PLAIN_TYPES, UNSUPPORTED_MAIN_TYPES, UNSUPPORTED_TYPES


def _starts_with_any(mime: Column, prefixes) -> Column:
    return reduce(or_, [mime.startswith(p) for p in prefixes])


def is_plain(mime: Column) -> Column:
    return mime.isin(PLAIN_TYPES)


def is_html_like(mime: Column) -> Column:
    """By prefix, so parameters such as a charset may follow."""
    return _starts_with_any(mime, HTML_LIKE_TYPES)


def is_unsupported(mime: Column) -> Column:
    """A listed type, or one of a rejected main type that is not itself supported."""
    supported = PLAIN_TYPES + HTML_LIKE_TYPES
    accepted = mime.isin(supported) | _starts_with_any(mime, [f"{t};" for t in supported])
    rejected_main = _starts_with_any(mime, [f"{t}/" for t in UNSUPPORTED_MAIN_TYPES])
    return mime.isin(UNSUPPORTED_TYPES) | (~accepted & rejected_main)
