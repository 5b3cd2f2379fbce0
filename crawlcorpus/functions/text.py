"""Text normalisation, word counting and digests."""

from pyspark.sql import Column, functions as F

from ..schema import LETTER, SPACE_IN_LINE, SPACES, WORD

#: Two or more letters that are not part of a longer word: r"\b[^\W\d_]{2,}\b".
DEFAULT_WORD_PATTERN = rf"(?<![{WORD}])[{LETTER}]{{2,}}(?![{WORD}])"


def utf8_text(content: Column) -> Column:
    """Bytes as text; NULL when they are not valid UTF-8."""
    text = content.cast("string")
    return F.when(F.is_valid_utf8(text), text)


# Code points 128 to 159 as old pages mean them.
LEGACY_LATIN = "€\x81‚ƒ„…†‡ˆ‰Š‹Œ\x8dŽ\x8f\x90‘’“”•–—˜™š›œ\x9džŸ"
_CONTROLS = "".join(map(chr, range(128, 160)))


def html_source(content: Column) -> Column:
    """Bytes as markup: UTF-8 if valid, else windows-1252, in which every byte is a character."""
    latin = F.translate(F.decode(content, "ISO-8859-1"), _CONTROLS, LEGACY_LATIN)
    return F.coalesce(utf8_text(content), latin)


def encodable(text: Column) -> Column:
    return F.make_valid_utf8(text)


def without_nul(text: Column) -> Column:
    return F.regexp_replace(text, r"\x00", "")


def normalize_space(text: Column) -> Column:
    """Single spaces, no blank lines, no space at either end of a line.

    Two passes over the whole string: splitting into lines and joining them again
    would cost an array per row and leave generated code.
    """
    spaced = F.regexp_replace(text, rf"[{SPACE_IN_LINE}]+", " ")
    lined = F.regexp_replace(spaced, " ?\n[ \n]*", "\n")
    return F.btrim(lined, F.lit(" \n"))


def letters_only(text: Column) -> Column:
    """Runs of letters joined by one space."""
    return F.trim(F.regexp_replace(text, rf"[^{LETTER}]+", " "))


def strip_space(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def count_words(text: Column, pattern: str = DEFAULT_WORD_PATTERN) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("bigint")


def raw_digest(text: Column) -> Column:
    """128 bits of a text, as bytes."""
    return F.unhex(F.md5(text))


def digest(text: Column, normalize: bool = False) -> Column:
    """128 bits of a text, in 24 base64 characters."""
    return F.base64(raw_digest(letters_only(text) if normalize else text))
