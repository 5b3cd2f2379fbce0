"""Quality rules, line first: bad lines go, then documents that lost too much.

A line with a word fails if

* punctuation: it does not end in a terminal mark (a closing quote or bracket may follow), or
  marks doubled for emphasis (``!!``, ``??``) follow more than a quarter of its words;
* navigation: it has three or more separators of menus, or more symbols than half its words;
* boilerplate: it holds a phrase of site furniture, such as a licence or cookie notice.

Lines without a word stay as they are. A document fails if the lines it loses hold more
than ``MAX_LOST_PERCENT`` of its word characters.

The base rules are plain counts over the whole text (``base_counts``) and are not touched by
line removal. Defined cases: a null text has no words, so it fails the base rule; an empty
text likewise; its cleaned text is empty. Ids are only carried; repeated rows give repeated
results; extra columns stay in ``clean`` and are left out of ``judged``. Map-only, built-in
functions only.
"""

from pyspark.sql import Column, DataFrame, functions as F

from ..plans.physical import computed_once

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
MAX_LOST_PERCENT = 30

# White space between words, symbols, marks, and phrases of site furniture.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
SEPARATORS = "|»›•"
TERMINAL = [".", "!", "?", "…", "。", "！", "？"]
CLOSING = "\"'»”’)]"
PHRASES = [
    "all rights reserved", "accept cookies", "cookie policy", "cookie settings",
    "creative commons", "general public license", "lorem ipsum", "licensed under",
    "privacy policy", "released under the", "sign in to", "subscribe to our",
    "terms of service", "terms of use", "this site uses cookies", "use of cookies",
    "enable javascript",
]

_SPACE = r"[\x20\x09-\x0D]"


def words(text: Column) -> Column:
    return F.filter(F.split(text, _SPACE + "+"), lambda w: w != "")


def _count_of(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, f"[{characters}]", ""))


def word_chars(text: Column) -> Column:
    return F.length(F.regexp_replace(text, _SPACE + "+", ""))


def has_word(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def _any(text: Column, parts: list[str]) -> Column:
    found = F.lit(False)
    for part in parts:
        found = found | F.contains(text, F.lit(part))
    return found


def suspicions(text: Column) -> Column:
    """Which rules could fail any line of a text at all, so that most lines skip most rules."""
    return F.struct(
        _any(text, ["!!", "??", "!?", "?!"]).alias("doubled"),
        text.rlike(f"[{SYMBOLS}{SEPARATORS}]").alias("symbols"),
        _any(F.lower(text), PHRASES).alias("phrases"))


def line_passes(line: Column, possible: Column | None = None) -> Column:
    """Whether a line with a word may stay; ``possible`` are the text's ``suspicions``."""
    possible = suspicions(line) if possible is None else possible
    n_words = F.size(words(line))
    doubled = F.size(F.regexp_extract_all(line, F.lit("[!?]{2,}"), F.lit(0)))
    ended = F.right(F.rtrim(line, F.lit(SPACES + CLOSING)), F.lit(1)).isin(TERMINAL)
    return (ended & (~possible["doubled"] | (doubled * 4 <= n_words))
            & (~possible["symbols"] | ((_count_of(line, SEPARATORS) < 3)
                                       & (_count_of(line, SYMBOLS) * 2 <= n_words)))
            & (~possible["phrases"] | ~_any(F.lower(line), PHRASES)))


def _repeat_words(docs: DataFrame) -> DataFrame:
    """Add ``n_repeat_words`` to rows that hold ``_words``.

    Each window of three words becomes one long: the high bits of its hash above its place,
    with as many low bits as the places need. Sorted, equal windows are neighbours; the
    places of those that have an equal neighbour, sorted again, tell how many words they
    cover. Sorting longs keeps this at n log n for any text. Neighbours of equal hash are
    compared as words; a text where these differ anywhere sorts its windows as words instead.
    """
    docs = docs.withColumn("_bits", F.length(F.bin(F.size("_words").cast("long"))))
    places = "if(size(_words) >= 3, sequence(0, size(_words) - 3), cast(array() as array<int>))"
    docs = computed_once(docs, _sorted=F.expr(
        f"sort_array(transform({places}, i -> shiftleft(xxhash64(get(_words, i),"
        " get(_words, i + 1), get(_words, i + 2)), _bits) | cast(i as bigint)))"))
    docs = computed_once(docs, _equal=F.expr(
        "filter(_sorted, (x, i) ->"
        " (x >> _bits) = coalesce(get(_sorted, i - 1) >> _bits, ~(x >> _bits)) or"
        " (x >> _bits) = coalesce(get(_sorted, i + 1) >> _bits, ~(x >> _bits)))"))
    here, there = (f"cast({x} & (shiftleft(1L, _bits) - 1) as int)" for x in ("x", "get(_equal, i - 1)"))
    differ = " or ".join(f"get(_words, {here} + {k}) <> get(_words, {there} + {k})" for k in range(3))
    docs = computed_once(docs, _exact=F.expr(
        "if(exists(transform(_equal, (x, i) -> i > 0 and"
        f" (x >> _bits) = (get(_equal, i - 1) >> _bits) and ({differ})), d -> d),"
        f" sort_array(transform({places}, i -> struct(struct(get(_words, i) as a,"
        " get(_words, i + 1) as b, get(_words, i + 2) as c) as w, i as i))), null)"))
    docs = computed_once(docs, _places=F.expr(
        "sort_array(if(_exact is null, transform(_equal, x -> x & (shiftleft(1L, _bits) - 1)),"
        " transform(filter(_exact, (x, i) -> coalesce(x.w = get(_exact, i - 1).w, false)"
        " or coalesce(x.w = get(_exact, i + 1).w, false)), x -> cast(x.i as bigint))))"))
    return docs.withColumn("n_repeat_words", F.expr(
        "aggregate(transform(_places, (p, i) -> least(3L, coalesce(get(_places, i + 1) - p, 3L))),"
        " 0L, (s, x) -> s + x)")).drop("_bits", "_sorted", "_equal", "_exact", "_places")


def base_counts(docs: DataFrame) -> DataFrame:
    """Add ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed``."""
    text = F.coalesce("text", F.lit(""))
    docs = computed_once(docs, _words=words(text),
                         _lines=F.filter(F.split(text, "\n"), has_word))
    docs = _repeat_words(docs)
    docs = docs.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.concat_ws("", "_words")).cast("long"),
        "n_symbols": _count_of(text, SYMBOLS).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long")})
    return docs.drop("_words", "_lines").withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")))


def clean(docs: DataFrame, max_lost_percent: int = MAX_LOST_PERCENT) -> DataFrame:
    """Add ``cleaned`` (the text without failing lines), ``lost_chars`` and ``lost_too_much``."""
    text = F.coalesce("text", F.lit(""))
    docs = computed_once(docs, _possible=suspicions(text))
    docs = computed_once(docs, cleaned=F.concat_ws("\n", F.filter(
        F.split(text, "\n"), lambda x: ~has_word(x) | line_passes(x, F.col("_possible")))))
    lost = F.when(F.length("cleaned") == F.length(text), 0).otherwise(
        word_chars(text) - word_chars(F.col("cleaned")))
    docs = computed_once(docs.drop("_possible"), lost_chars=lost.cast("long"))
    return docs.withColumn("lost_too_much", F.when(F.col("lost_chars") == 0, False).otherwise(
        F.col("lost_chars") * 100 > word_chars(text) * max_lost_percent))


def judged(docs: DataFrame) -> DataFrame:
    """The counts, the base verdict, and ``kept``: base rules and line rules together."""
    rows = base_counts(clean(docs.select("doc_id", "text")))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", (~F.col("base_failed") & ~F.col("lost_too_much")).alias("kept"),
        "lost_chars")


def filtered(docs: DataFrame) -> DataFrame:
    """Documents that pass, with their cleaned text; ``n_chars`` follows it where it is there."""
    columns = docs.columns
    kept = base_counts(clean(docs)).where("not base_failed and not lost_too_much")
    if "n_chars" in columns:
        kept = kept.withColumn("n_chars", F.length("cleaned").cast("long"))
    return kept.withColumn("text", F.col("cleaned")).select(*columns)
