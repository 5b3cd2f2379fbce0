"""Main text of a page: paragraphs, their features, and classes by context.

The method is that of Pomikalek (2011): judge each paragraph by length, links and
function words, then settle the short and doubtful ones by the nearest settled
neighbours. A page is one row with an array of its paragraphs, from markup to main text, so
nothing is shuffled, sorted or exploded. Classes are letters of a string; the nearest
neighbours of all places are found at once, by stretching each settled letter over the run of
unsettled ones beside it. That is linear in the number of paragraphs.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import html as HT
from ..functions.text import letters_only, normalize_space

# Thresholds of the published method.
LENGTH_LOW = 70
LENGTH_HIGH = 200
STOPWORDS_LOW = 0.30
STOPWORDS_HIGH = 0.32
MAX_LINK_DENSITY = 0.2
MAX_HEADING_DISTANCE = 200

# Marks that stand for tags once tags are gone: end of link, link, heading, form choice,
# end of a link's address.
_UNLINK, _LINK, _HEADING, _CHOICE, _ADDRESS = "\x0e", "\x0f", "\x10", "\x11", "\x12"
_REST = HT._REST_OF_TAG
_VALUE = r"""(?:"[^"]*"|'[^']*'|[^\s"'>]*+)"""
#: The first attribute that is named ``href``, whatever comes before it; a quoted address
#: is taken whole. Loops are possessive, so the JVM's matcher does not recurse.
LINK_WITH_ADDRESS = (
    r"""(?i)<a(?:[\s/]++(?!href[\s=])[^\s=>/"']++(?:\s*+=\s*+""" + _VALUE
    + r"""|))*+[\s/]++href\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s"'>]*+))""" + _REST)
#: References that would decode to one of the marks.
_MARK_REFERENCE = r"(?i)&#(?:0*1[4-8]|x0*(?:e|f|1[0-2]))(?:;|(?![0-9a-f]))"
OTHER_LINK = rf"(?i)<a(?:/?>|[\s/]{_REST})"
LINK_END = r"(?i)</a\s*>"
HEADING = rf"(?i)<h[1-6](?:/?>|[\s/]{_REST})"
CHOICE = rf"(?i)<(?:select|option)(?:/?>|[\s/]{_REST})"
MARKS = r"\x0f[^\x12\n]*\x12|[\x0e-\x12]"
LINKED = r"\x0f[^\x12\n]*\x12([^\x0e\x0f]*)"
ADDRESS = r"\x0f([^\x12\n]*)\x12"


def marked_lines(html: Column) -> Column:
    """One line per block of text, with marks for links, headings and form choices."""
    text = F.regexp_replace(F.regexp_replace(html, r"[\x0e-\x12]", " "), _MARK_REFERENCE, " ")
    text = F.regexp_replace(text, HT.elements("script", "style", "noscript"), "")
    text = F.regexp_replace(text, HT.COMMENT, "\n")
    text = F.regexp_replace(text, LINK_WITH_ADDRESS, f"{_LINK}$1$2$3{_ADDRESS}")
    text = F.regexp_replace(text, OTHER_LINK, f"{_LINK}{_ADDRESS}")
    text = F.regexp_replace(text, LINK_END, _UNLINK)
    text = F.regexp_replace(text, HEADING, f"\n{_HEADING}")
    text = F.regexp_replace(text, CHOICE, f"\n{_CHOICE}")
    text = F.regexp_replace(text, HT.INLINE_TAG, "")
    return normalize_space(HT.unescape(F.regexp_replace(text, HT.ANY_TAG, "\n")))


def unmarked(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(line, MARKS, ""), " +", " "))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def paragraph_array(html: Column) -> Column:
    """An array of ``pos, tag, text, n_chars, link_chars, hrefs`` of a page's paragraphs."""
    def read(line: Column, pos: Column) -> Column:
        linked = F.array_join(F.regexp_extract_all(line, F.lit(LINKED), F.lit(1)), "")
        tag = (F.when(line.contains(_CHOICE), "select").when(line.contains(_HEADING), "head")
               .otherwise("p"))
        return let(unmarked(line), lambda text: F.struct(
            pos.cast("bigint").alias("pos"), tag.alias("tag"), text.alias("text"),
            F.length(text).cast("bigint").alias("n_chars"),
            F.length(unmarked(linked)).cast("bigint").alias("link_chars"),
            F.regexp_extract_all(line, F.lit(ADDRESS), F.lit(1)).alias("hrefs")))
    return F.filter(F.transform(F.split(marked_lines(html), "\n"), read), lambda p: p["text"] != "")


def paragraphs(pages: DataFrame, *keys: str) -> DataFrame:
    """``keys`` and the fields of ``paragraph_array``, a row for each, from ``keys, html``."""
    return pages.select(*keys, F.inline(paragraph_array(F.col("html"))))


def stop_words(labelled: DataFrame, n: int) -> DataFrame:
    """``lang, word``: the ``n`` commonest words of each language, ties by spelling.

    Counting merges words before the shuffle; ranking discards all but ``n`` per
    language and task before its own.
    """
    words = labelled.select("lang", F.explode(
        F.split(letters_only(F.lower("text")), " ")).alias("word")).where("word <> ''")
    counts = words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    order = W.partitionBy("lang").orderBy(F.desc("n"), "word")
    return counts.withColumn("_rank", F.row_number().over(order)).where(
        F.col("_rank") <= n).select("lang", "word")


def with_features(paragraphs: Column, stoplist: list[str]) -> Column:
    """Add ``n_words`` and ``n_stops`` to each paragraph of an array. The list is a parameter of the
    method, some hundreds of words, and is compiled into a hash set."""
    def counted(p: Column) -> Column:
        return let(F.split(F.lower(p["text"]), " "), lambda words: p.withField(
            "n_words", F.size(words).cast("bigint")).withField(
            "n_stops", F.size(F.filter(words, lambda w: w.isin(*stoplist))).cast("bigint")))
    return F.transform(paragraphs, counted)


# Letters of the classes.
_NAMES = {"g": "good", "b": "bad", "n": "neargood", "s": "short"}


def _context_free(p: Column) -> Column:
    """The letter of a paragraph by itself."""
    stops, links = p["n_stops"] / p["n_words"], p["link_chars"] / p["n_chars"]
    copyright_ = p["text"].contains("©") | p["text"].contains("&copy")
    return (F.when(links > MAX_LINK_DENSITY, "b").when(copyright_, "b")
            .when(p["tag"] == "select", "b")
            .when(p["n_chars"] < LENGTH_LOW, F.when(p["link_chars"] > 0, "b").otherwise("s"))
            .when(stops >= STOPWORDS_HIGH, F.when(p["n_chars"] > LENGTH_HIGH, "g").otherwise("n"))
            .when(stops >= STOPWORDS_LOW, "n").otherwise("b"))


def _nearest_before(letters: Column, kinds: str) -> Column:
    """For each place the nearest letter of these kinds before it, bad if there is none."""
    runs = F.regexp_extract_all(F.concat(F.lit("b"), F.array_join(letters, "")),
                                F.lit(f"[{kinds}][^{kinds}]*"), F.lit(0))
    return F.split(F.array_join(F.transform(runs, lambda r: F.repeat(F.left(r, F.lit(1)), F.length(r))), ""), "")


def _nearest_after(letters: Column, kinds: str) -> Column:
    """As ``_nearest_before``, in the other direction; place ``i`` has its answer at ``i + 1``."""
    runs = F.regexp_extract_all(F.concat(F.array_join(letters, ""), F.lit("b")),
                                F.lit(f"[^{kinds}]*[{kinds}]"), F.lit(0))
    return F.split(F.array_join(F.transform(runs, lambda r: F.repeat(F.right(r, F.lit(1)), F.length(r))), ""), "")


def _good_below(paragraphs: Column, letters: Column, i: Column) -> Column:
    """Whether good text begins at most ``MAX_HEADING_DISTANCE`` characters below a paragraph. Each
    paragraph between has a character at least, so only so many need be looked at."""
    below = F.slice(F.transform(paragraphs, lambda p, k: F.struct(
        p["n_chars"].alias("n"), F.get(letters, k).alias("letter"))), i + 2, MAX_HEADING_DISTANCE + 1)

    def step(state: Column, p: Column) -> Column:
        def to(gap, hit, open_):
            return F.struct(gap.alias("gap"), hit.alias("hit"), open_.alias("open"))
        return F.when(~state["open"], state).when(
            p["letter"] == "g", to(state["gap"], state["gap"] <= MAX_HEADING_DISTANCE, F.lit(False))
        ).otherwise(to(state["gap"] + p["n"], F.lit(False), F.lit(True)))
    start = F.struct(F.lit(0).cast("bigint").alias("gap"), F.lit(False).alias("hit"), F.lit(True).alias("open"))
    return F.aggregate(below, start, step, lambda state: state["hit"])


def classified(paragraphs: Column) -> Column:
    """Add ``cf_class`` and ``class`` (``good`` or ``bad``) to each paragraph with features."""
    def heading(p, i):
        return F.get(p, i)["tag"] == "head"

    def settle(p: Column, own: Column) -> Column:
        # a short heading close above good text may belong to it
        raised = F.transform(own, lambda c, i: F.when(
            heading(p, i) & (c == "s") & _good_below(p, own, i), "n").otherwise(c))
        return let(raised, lambda c1: let(shorts(c1), lambda c2: let(doubtful(c2), lambda c3: let(
            rescued(p, own, c3), lambda c4: named(p, own, c4)))))

    def shorts(c1: Column) -> Column:
        # by both neighbours; between good and bad, by a doubtful one on the bad side
        sides = F.struct(
            _nearest_before(c1, "gb").alias("prev"), _nearest_after(c1, "gb").alias("next"),
            _nearest_before(c1, "gbn").alias("prev_any"), _nearest_after(c1, "gbn").alias("next_any"))

        def resolved(s: Column, c: Column, i: Column) -> Column:
            prev, next_ = F.get(s["prev"], i), F.get(s["next"], i + 1)
            backed = (((prev == "b") & (F.get(s["prev_any"], i) == "n"))
                      | ((next_ == "b") & (F.get(s["next_any"], i + 1) == "n")))
            return F.when(c != "s", c).when(prev == next_, prev).when(backed, "g").otherwise("b")
        return let(sides, lambda s: F.transform(c1, lambda c, i: resolved(s, c, i)))

    def doubtful(c2: Column) -> Column:
        # bad only between bad ones
        sides = F.struct(_nearest_before(c2, "gb").alias("prev"), _nearest_after(c2, "gb").alias("next"))
        return let(sides, lambda s: F.transform(c2, lambda c, i: F.when(c != "n", c).when(
            (F.get(s["prev"], i) == "b") & (F.get(s["next"], i + 1) == "b"), "b").otherwise("g")))

    def rescued(p: Column, own: Column, c3: Column) -> Column:
        # a heading that context made bad comes back close above good text
        return F.transform(c3, lambda c, i: F.when(
            heading(p, i) & (c == "b") & (F.get(own, i) != "b") & _good_below(p, c3, i), "g").otherwise(c))

    def named(p: Column, own: Column, c4: Column) -> Column:
        def name(letter: Column) -> Column:
            chain = F
            for short, long in _NAMES.items():
                chain = chain.when(letter == short, long)
            return chain
        return F.transform(p, lambda x, i: x.withField("cf_class", name(F.get(own, i))).withField(
            "class", name(F.get(c4, i))))

    return let(paragraphs, lambda p: let(F.transform(p, _context_free), lambda own: settle(p, own)))


def good_text(classified: Column) -> Column:
    """The good paragraphs, parted by a blank line; empty if there is none."""
    return F.array_join(F.transform(F.filter(classified, lambda p: p["class"] == "good"),
                                    lambda p: p["text"]), "\n\n")


def main_text(html: Column, stoplist: list[str]) -> Column:
    """Markup to its main text, like any other extractor."""
    return good_text(classified(with_features(paragraph_array(html), stoplist)))


def structured(html: Column) -> Column:
    """An array of tag, text and link targets of a page's paragraphs."""
    return F.transform(paragraph_array(html), lambda p: F.struct(
        p["tag"].alias("_tag"), p["text"].alias("text"), p["hrefs"].alias("href")))
