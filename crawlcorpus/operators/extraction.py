"""Record to text, with an outcome for every record.

``outcome`` names the first test a record failed, or ``ok``. Nothing is dropped here:
the counts of all outcomes add up to the number of records.
"""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import charsets as CS, headers as H, html, mime as M, parsed, text as X
from ..plans.physical import computed_once
from .boilerplate import main_text
from .sampling import choice, drawn

#: Extractors by name; each maps markup to text without a shuffle. ``parser`` alone
#: leaves the JVM. Register more by adding to this table. ``main`` takes a list of stop words.
EXTRACTORS = {
    "blocks": html.blocks_to_text,
    "tags": html.tags_to_text,
    "html": html.clean_html,
    "parser": parsed.parsed_to_text,
}
RANDOM_EXTRACTORS = ["blocks", "tags"]


def first_failing(*tests: tuple[str, Column]) -> Column:
    """The name of the first test that holds, NULL if none does."""
    chain = F
    for name, failed in tests:
        chain = chain.when(failed, F.lit(name))
    return chain


def random_extractors(stoplist: list[str] = ()) -> list[str]:
    """What ``random`` draws from: main text as well, given the words that it needs."""
    return RANDOM_EXTRACTORS + ["main"] * bool(stoplist)


def _extracted(source: Column, extractor: str, key: Column, stoplist: list[str]) -> Column:
    if extractor == "main":
        return main_text(source, list(stoplist))
    if extractor != "random":
        return EXTRACTORS[extractor](source)
    options, chain = random_extractors(stoplist), F
    for name in options:
        chain = chain.when(choice(key, options) == name, _extracted(source, name, key, stoplist))
    return chain


def text_of(content: Column, mime: Column, extractor: str, key: Column, stoplist: list[str] = (),
            content_type: Column | None = None) -> Column:
    """Plain text is decoded; everything else that is supported is read as markup.

    NULL when plain text is not valid UTF-8, and for NULL content. Markup is decoded by the set
    that it or ``content_type`` declares; resolve the column inside ``charsets.all_charsets``.
    """
    content_type = F.lit(None).cast("string") if content_type is None else content_type
    source = F.when(~M.is_plain(mime), CS.declared_source(content, content_type))
    return F.when(M.is_plain(mime), X.utf8_text(content)).otherwise(
        _extracted(source, extractor, key, stoplist))


def extract(records: DataFrame, *tests: tuple[str, Column], extractor: str = "blocks",
            normalize: bool = False, stoplist: list[str] = ()) -> DataFrame:
    """Add ``text`` and ``outcome``.

    Only records that pass every test reach the extractor, whatever the order in which
    Catalyst evaluates the columns.
    """
    candidate = F.when(F.col("outcome").isNull(), F.col("content"))
    text = X.without_nul(text_of(candidate, H.mime_type(), extractor, H.record_id(), stoplist,
                                 H.http_content_type()))
    text = X.letters_only(text) if normalize else text
    unreadable = ("unreadable", F.col("error").isNotNull())
    gated = records.withColumn("outcome", first_failing(unreadable, *tests))
    with CS.all_charsets(records.sparkSession):
        done = computed_once(gated, text=text)
    return done.withColumn("outcome", F.coalesce(
        "outcome",
        F.when(F.col("text").isNull(), "error").when(F.col("text") == "", "empty"),
        F.lit("ok")))


def _empty() -> tuple[str, Column]:
    return "empty", F.length("content") == 0


def _broken_id(id_: Column) -> tuple[str, Column]:
    return "error", id_.isNull()


def _types(*types: str) -> tuple[str, Column]:
    return "other", ~F.coalesce(F.col("rec_type").isin(*types), F.lit(False))


def _unsupported() -> tuple[str, Column]:
    return "unsupported", M.is_unsupported(H.mime_type())


def _no_type() -> tuple[str, Column]:
    return "error", H.mime_type().isNull()


def conversion_outcomes(records: DataFrame, *, refers_to: bool = False, extractor="blocks",
                        sample: float | None = None, seed=None, stoplist: list[str] = ()) -> DataFrame:
    """Tests of the JSONL conversion: draw, type, id, content, support, text."""
    tests = []
    if sample is not None:
        tests.append(("skipped", ~drawn(H.record_id(), sample, seed)))
    tests += [_types("response", "conversion"), _broken_id(H.bare_id(H.chosen_id(refers_to))),
              _empty(), _no_type(), _unsupported()]
    return extract(records, *tests, extractor=extractor, stoplist=stoplist)


def hash_outcomes(records: DataFrame, *, refers_to: bool = False,
                  normalize: bool = True) -> DataFrame:
    """Tests of the text hashes: as conversion, every tag a line break, letters only."""
    return extract(records, _types("response", "conversion"),
                   _broken_id(H.uuid_of(H.chosen_id(refers_to))), _empty(), _no_type(),
                   _unsupported(), extractor="tags", normalize=normalize)


def language_outcomes(records: DataFrame) -> DataFrame:
    return extract(records, _types("response", "conversion"),
                   _broken_id(H.bare_id(H.record_id())), _empty(), _no_type(), _unsupported())


def response_outcomes(records: DataFrame, *, substrings: list[str] | None = None,
                      markup_only: bool = False, extractor="blocks") -> DataFrame:
    """Tests of response text: type, wanted id, content, support, text."""
    tests = [_types("response")]
    if substrings is not None:
        tests.append(("skipped", ~id_contains(H.record_id(), substrings)))
    tests += [_empty(), _no_type(), _unsupported()]
    if markup_only:
        tests.append(("unsupported", ~M.is_html_like(H.mime_type())))
    return extract(records, *tests, extractor=extractor)


def duplicate_outcomes(records: DataFrame) -> DataFrame:
    """Tests before duplicate search: type, support, content, text."""
    return extract(records, _types("response"), _no_type(), _unsupported(), _empty())


def id_contains(id_: Column, substrings: list[str]) -> Column:
    """Whether an id holds any of a short list of strings; a missing id holds none."""
    hit = F.lit(False)
    for s in substrings:
        hit = hit | id_.contains(s)
    return F.coalesce(hit, F.lit(False))


# --- counters ---------------------------------------------------------------------

def _counters() -> list[Column]:
    considered = F.col("outcome") != "skipped"
    return [
        F.count_if(F.col("outcome") != "unreadable").alias("total"),
        F.count_if(~considered).alias("skipped"),
        F.count_if(considered & (F.col("rec_type") == "response")).alias("responses"),
        F.count_if(considered & (F.col("rec_type") == "conversion")).alias("conversions"),
        F.count_if(F.col("outcome") == "empty").alias("empties"),
        F.count_if(F.col("outcome") == "unsupported").alias("unsupported"),
        F.count_if(F.col("outcome") == "error").alias("errors"),
        F.count_if(F.col("outcome") == "unreadable").alias("unreadable"),
        F.count_if(F.col("outcome") == "ok").alias("output"),
    ]


def outcome_counts(outcomes: DataFrame, *by: str) -> DataFrame:
    """Run counters, or one row of them per group such as ``file``."""
    return outcomes.groupBy(*by).agg(*_counters())


def observed(outcomes: DataFrame, observation) -> DataFrame:
    """Collect the same counters while the output is written, without a second pass."""
    return outcomes.observe(observation, *_counters())


def verified(records: DataFrame) -> DataFrame:
    """``file, status, n_records, message``: whether each archive reads to its end."""
    broken = F.max("error")
    return records.groupBy("file").agg(
        F.when(broken.isNull(), "OK").otherwise("ERROR").alias("status"),
        F.count_if(F.col("error").isNull()).alias("n_records"),
        F.translate(broken, "\n", " ").alias("message"))
