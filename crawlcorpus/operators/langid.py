"""Language of lines and documents with a character-trigram model.

A model has two tables with one integer column per language, log-probabilities in
thousandths: ``grams``, and ``words``, the same sums for the common training words.
Integers make sums exact, so results do not depend on the order in which rows meet, nor
on which words are tabulated: a word outside ``words`` is scored by its grams.

Scoring joins words first, for most words of any text are common ones; only the rest is
multiplied into grams. The gram table depends on the writing systems and not on the
corpus, the word table is bounded in training; both are broadcast after a check.
"""

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property, reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import text as X
from ..plans.physical import broadcast_if_small, materialize, shuffle_partitions

# Parameters of the language selection.
TARGET = "fi"
KEEP_WORDS = 10
KEEP_RATIO = 0.25
MIN_RATIO = 0.01
MAX_LABELS = 10
MIN_PRED_WORDS = 1
THRESHOLD = 0.999
DOCUMENT_PROB = 0.1

#: A model row is a short string and one long per language; so many bytes may be broadcast.
MAX_BROADCAST_BYTES = 256 << 20
MAX_MODEL_WORDS = 200_000
SCALE = 1000
SALTS = 64


def words_of(line: Column) -> Column:
    """Lower-case runs of letters."""
    return F.split(X.letters_only(F.lower(line)), " ")


def grams_of(word: Column) -> Column:
    """Overlapping trigrams of a word with a space at either end.

    The look-ahead yields them in one pass; cutting by position would walk the string
    from its start each time.
    """
    padded = F.concat(F.lit(" "), word, F.lit(" "))
    return F.regexp_extract_all(padded, F.lit("(?=(...))"), F.lit(1))


def lines_of(texts: DataFrame, *keys: str) -> DataFrame:
    """``keys, pos, line``: non-blank lines, stripped. ``pos`` counts all lines."""
    split = texts.select(*keys, F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return split.withColumns({"pos": F.col("pos").cast("bigint"),
                              "line": X.strip_space(F.col("line"))}).where("line <> ''")


def count_line_words(texts: DataFrame, *keys: str, pattern=X.DEFAULT_WORD_PATTERN) -> DataFrame:
    """``keys, pos, words``."""
    return lines_of(texts, *keys).select(
        *keys, "pos", X.count_words(F.col("line"), pattern).alias("words"))


# --- model ---------------------------------------------------------------------------

def labels_of(labelled: DataFrame) -> list[str]:
    """The languages present. Their number is small by nature; a thousand is an error."""
    found = labelled.select("lang").where("lang is not null").distinct().limit(1001).collect()
    if len(found) > 1000:
        raise ValueError("more than 1000 languages: is this column a label?")
    return sorted(row.lang for row in found)


@dataclass(frozen=True)
class LanguageModel:
    """``words`` are only made when something asks for them, as scoring does."""

    grams: DataFrame
    make_words: Callable[[], DataFrame]
    languages: list[str]

    @cached_property
    def words(self) -> DataFrame:
        return self.make_words()

    def save(self, path: str) -> None:
        self.grams.write.parquet(f"{path}/grams")
        self.words.write.parquet(f"{path}/words")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "LanguageModel":
        grams, words = (spark.read.parquet(f"{path}/{part}") for part in ("grams", "words"))
        return LanguageModel(grams, lambda: words, sorted(set(grams.columns) - {"gram"}))


def word_counts(labelled: DataFrame, languages: list[str]) -> DataFrame:
    """``word`` and its count in each language, from ``lang, text``.

    Words merge before the shuffle: a task sends each of its distinct words once.
    """
    rows = lines_of(labelled, "lang").select(
        "lang", F.explode(words_of(F.col("line"))).alias("word")).where("word <> ''")
    return rows.groupBy("word").agg(*[F.count_if(F.col("lang") == l).alias(l)
                                      for l in languages])


def gram_counts(words: DataFrame, languages: list[str]) -> DataFrame:
    """``gram`` and its count in each language, each distinct word cut once."""
    rows = words.select(F.explode(grams_of(F.col("word"))).alias("gram"), *languages)
    return rows.groupBy("gram").agg(*[F.sum(l).alias(l) for l in languages])


def gram_scores(counts: DataFrame, languages: list[str]) -> DataFrame:
    """Add-one smoothed log-probabilities, from ``gram_counts``.

    The totals are a scalar over the same counts, whose one shuffle serves both.
    """
    totals = counts.agg(F.struct(F.count(F.lit(1)).alias("_size"),
                                 *[F.sum(l).alias(l) for l in languages])).scalar()

    def score(l):
        probability = (F.col(l) + 1) / (totals[l] + totals["_size"])
        return F.round(F.log(probability) * SCALE).cast("bigint").alias(l)
    return counts.select("gram", *[score(l) for l in languages])


def _common(words: DataFrame, languages: list[str], limit: int) -> DataFrame:
    """Words of a table of counts that are frequent enough for at most ``limit`` to be.

    The cut is a power of two, read off a histogram of at most 64 rows.
    """
    total = reduce(add, [F.col(l) for l in languages])
    sizes = words.groupBy(F.floor(F.log2(total)).alias("power")).count().collect()
    kept, cut = 0, 64
    for power, n in sorted(((r["power"], r["count"]) for r in sizes), reverse=True):
        kept += n
        if kept > limit:
            break
        cut = power
    return words.where(F.floor(F.log2(total)) >= cut).select("word")


def train(labelled: DataFrame, max_words: int = MAX_MODEL_WORDS) -> LanguageModel:
    """A model from ``lang, text``, with its tables stored in the shared folder."""
    languages = labels_of(labelled)
    words = materialize(word_counts(labelled, languages), "word-counts")
    grams = materialize(gram_scores(gram_counts(words, languages), languages), "grams")

    def make_words():
        cut = _common(words, languages, max_words).select(
            "word", F.explode(grams_of(F.col("word"))).alias("gram"))
        return materialize(cut.join(grams, "gram").groupBy("word").agg(
            *[F.sum(l).alias(l) for l in languages]), "words")
    return LanguageModel(grams, make_words, languages)


# --- scoring -------------------------------------------------------------------------

def _placed(texts: DataFrame, *keys: str) -> DataFrame:
    """Texts hashed on their keys, before their lines are multiplied into words.

    This is the one shuffle of scoring: every later aggregate, by line or by text,
    finds its rows in place, and uneven inputs are evened out.
    """
    narrow = texts.select(*keys, "text")
    return narrow.repartition(shuffle_partitions(narrow), *keys)


def _score(rows: DataFrame, model: LanguageModel, *by: str,
           max_broadcast: int | None = None) -> DataFrame:
    """Sum of scores by ``by`` over rows with an array ``words``; NULL if none is known."""
    languages = model.languages
    if max_broadcast is None:
        max_broadcast = MAX_BROADCAST_BYTES // (64 + 8 * len(languages))
    rows = rows.select(*by, F.explode_outer("words").alias("word"))
    common, small = broadcast_if_small(
        model.words.select("word", *[F.col(l).alias(f"w_{l}") for l in languages]),
        max_broadcast)
    if small:
        rows = rows.join(common, "word", "left")
    else:
        rows = rows.select("*", *[F.lit(None).cast("bigint").alias(f"w_{l}")
                                  for l in languages])
    rare = F.when(F.col(f"w_{languages[0]}").isNull(), grams_of(F.col("word")))
    rows = rows.withColumn("gram", F.explode_outer(rare)).drop("word")
    grams, small = broadcast_if_small(model.grams.select("gram", *languages), max_broadcast)
    if small:
        rows = rows.join(grams, "gram", "left")
    else:
        rows = _salted_left_join(rows, grams, languages, *by)
    return rows.groupBy(*by).agg(*[F.sum(F.coalesce(f"w_{l}", l)).alias(l)
                                   for l in languages])


def _salted_left_join(rows: DataFrame, grams: DataFrame, languages: list[str],
                      *by: str) -> DataFrame:
    """The join with a gram table beyond broadcast.

    Rows of a line with the same gram, or with none, are merged first; that needs no
    shuffle. Common grams are on most lines all the same, so each is spread over
    ``SALTS`` places, and so are the rows without a gram, which match nothing.
    """
    merged = rows.groupBy(*by, F.coalesce("gram", F.lit("")).alias("gram")).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(f"w_{l}").alias(f"w_{l}") for l in languages])
    salted = grams.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    salt = F.pmod(F.xxhash64(*by), F.lit(SALTS)).cast("int")
    joined = merged.withColumn("_salt", salt).join(salted, ["gram", "_salt"], "left")
    return joined.withColumns({l: F.col(l) * F.col("_n") for l in languages})


def ranked(languages: list[str], k: int) -> Column:
    """The ``k`` best ``struct(score, lang)``, best first, ties by name; none if no score."""
    scored = F.array(*[F.struct((-F.col(l)).alias("cost"), F.lit(l).alias("lang"))
                       for l in sorted(languages)])
    return F.when(F.col(languages[0]).isNull(), F.array().cast(
        "array<struct<cost:bigint,lang:string>>")).otherwise(F.slice(F.array_sort(scored), 1, k))


def posterior(languages: list[str], target: str) -> Column:
    """Probability of the target among the model's languages, in [0, 1]."""
    if target not in languages:
        return F.lit(0.0)
    odds = reduce(add, [F.exp((F.col(l) - F.col(target)) / float(SCALE))
                        for l in sorted(languages)])
    return F.coalesce(F.least(F.greatest(1.0 / odds, F.lit(0.0)), F.lit(1.0)), F.lit(0.0))


def target_probability(languages: list[str], target: str, k: int = MAX_LABELS) -> Column:
    """``posterior``, or zero when the target is not among the ``k`` best labels."""
    if k >= len(languages) or target not in languages:
        return posterior(languages, target)
    better = reduce(add, [
        ((F.col(l) > F.col(target)) | ((F.col(l) == F.col(target)) & F.lit(l < target)))
        .cast("int") for l in languages if l != target])
    return F.when(better < k, posterior(languages, target)).otherwise(F.lit(0.0))


def score_lines(texts: DataFrame, model: LanguageModel, *keys: str,
                pattern: str = X.DEFAULT_WORD_PATTERN, min_words: int = MIN_PRED_WORDS,
                max_broadcast: int | None = None) -> DataFrame:
    """``keys, pos, n_words`` and the score of each language, for every non-blank line.

    ``keys`` must identify a text. Lines with fewer than ``min_words`` are kept with NULL
    scores; none of their words is looked up.
    """
    lines = lines_of(_placed(texts, *keys), *keys).withColumn(
        "n_words", X.count_words(F.col("line"), pattern))
    judged = F.when(F.col("n_words") >= min_words, words_of(F.col("line")))
    return _score(lines.withColumn("words", judged), model, *keys, "pos", "n_words",
                  max_broadcast=max_broadcast)


def top_labels(scores: DataFrame, languages: list[str], *keys: str, k: int = MAX_LABELS
               ) -> DataFrame:
    """``keys, pos, rank, lang, score``: the best labels of each scored line."""
    ranks = F.posexplode(ranked(languages, k)).alias("_rank", "_label")
    return scores.select(*keys, "pos", ranks).select(
        *keys, "pos", (F.col("_rank") + 1).cast("bigint").alias("rank"), F.col("_label.lang").alias("lang"),
        (-F.col("_label.cost")).alias("score"))


def keep(target_words: Column, total_words: Column, *, keep_words=KEEP_WORDS,
         keep_ratio=KEEP_RATIO, min_ratio=MIN_RATIO) -> Column:
    """Whether a text has enough words on lines of the target language."""
    ratio = target_words / total_words
    return (F.when(total_words == 0, False).when(ratio < min_ratio, False)
            .when(target_words >= keep_words, True).otherwise(ratio >= keep_ratio))


def keep_decisions(texts: DataFrame, model: LanguageModel, *keys: str, target: str = TARGET,
                   threshold: float = THRESHOLD, max_labels: int = MAX_LABELS,
                   pattern: str = X.DEFAULT_WORD_PATTERN, min_words: int = MIN_PRED_WORDS,
                   max_broadcast: int | None = None, **limits) -> DataFrame:
    """``keys, target_words, total_words, keep`` for every text that has a line."""
    scores = score_lines(texts, model, *keys, pattern=pattern, min_words=min_words,
                         max_broadcast=max_broadcast)
    probability = target_probability(model.languages, target, max_labels)
    hit = (probability >= threshold) & (F.col("n_words") >= min_words)
    sums = scores.groupBy(*keys).agg(
        F.sum(F.when(hit, F.col("n_words")).otherwise(0)).alias("target_words"),
        F.sum("n_words").alias("total_words"))
    return sums.withColumn("keep", keep(F.col("target_words"), F.col("total_words"), **limits))


def score_documents(texts: DataFrame, model: LanguageModel, *keys: str,
                    max_broadcast: int | None = None) -> DataFrame:
    """``keys`` and the score of each language over the whole text."""
    rows = lines_of(_placed(texts, *keys), *keys).select(
        *keys, words_of(F.col("line")).alias("words"))
    return _score(rows, model, *keys, max_broadcast=max_broadcast)


def in_language(languages: list[str], target: str,
                min_probability: float = DOCUMENT_PROB) -> Column:
    return posterior(languages, target) >= min_probability
