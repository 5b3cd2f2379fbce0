"""Audit of how sources of a language differ in their words.

A group is a language and a source. A group, and a language as a whole, gives each kept term of
the language a price ``1 + floor(SCALE * (count + PRIOR) / (N + PRIOR * V))``, where ``V`` is the number of kept
terms and ``N`` that of their occurrences in the group. Two groups diverge by the sum of the differences of
their prices over all kept terms. All arithmetic is on integers.

1. Tasks count terms of whole texts, by group, with the documents that hold them, and
   hand on one row for each term and group they saw; Spark adds these up.
2. Terms of enough documents of a language are kept and numbered over all languages, in ranges.
3. A group becomes sorted arrays of (term number, count), one for each block of ``BLOCK`` term
   numbers, so a row is bounded however many terms a group has. For each unordered pair of a
   language's groups and each block the two arrays meet in a co-group. A galloping
   intersection finds terms of both; these, and those of one side only, are priced one by one.
   Terms that neither has differ by the same amount, priced once for all blocks in the end.
4. Each pair's sum is read both ways.

The pairs are the report itself: as many rows as it has. No other pair is formed.

Defined cases: null texts, languages and sources are read as empty. A group without terms is there
with all counts 0; a language without kept terms has pairs of value 0. Repeated rows count as
often as they come. An empty table gives an empty report. Extra columns are left out.
"""

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..plans.physical import shuffle_partitions
from .storage import numbered, stored

MIN_DOCUMENTS = 30
PRIOR = 5
SCALE = 1_000_000_000
TOP_TERMS = 50
#: Term numbers to an array.
BLOCK = 1 << 16
#: Entries a task counts before it hands them on.
TASK_TERMS = 400_000

#: ASCII letters, in lower case, and all bytes of other characters make terms.
_FOLD = bytes(b | 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def _counted(batches):
    """Count terms by group; entries are handed on when there are many."""
    groups: dict[tuple, dict] = {}

    def rows():
        for (lang, source), terms in groups.items():
            entries = list(terms.values())
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()),
                pa.array(list(terms), pa.binary()).cast(pa.string()),
                pa.array([e[0] for e in entries], pa.int64()), pa.array([e[1] for e in entries], pa.int64())],
                names=["lang", "source", "term", "n", "docs"])

    size = 0
    for batch in batches:
        for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
            terms = groups.setdefault((lang or "", source or ""), {})
            size -= len(terms)
            for term, n in Counter((text or "").encode().translate(_FOLD).split()).items():
                entry = terms.get(term)
                if entry is None:
                    terms[term] = [n, 1]
                else:
                    entry[0] += n
                    entry[1] += 1
            size += len(terms)
            if size >= TASK_TERMS:
                yield from rows()
                groups, size = {}, 0
    yield from rows()


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences and documents of each term in each group."""
    parts = docs.select("lang", "source", "text").mapInArrow(
        _counted, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def price(n: Column, total: Column, kept: Column) -> Column:
    """The price of a term that occurs ``n`` times among ``total`` occurrences of ``kept`` terms."""
    wide = (n + PRIOR).cast("decimal(20, 0)") * F.lit(SCALE).cast("decimal(10, 0)")
    return F.call_function("div", wide, (total + PRIOR * kept).cast("decimal(20, 0)")) + 1


def prices(n: np.ndarray, total: int, kept: int) -> np.ndarray:
    """As ``price``, over an array. Nine steps of long division stay within 64 bits."""
    below = total + PRIOR * kept
    out, rest = np.divmod(n + PRIOR, below)
    for _ in range(9):  # a digit of ``SCALE`` at a time
        digit, rest = np.divmod(rest * 10, below)
        out = out * 10 + digit
    return out + 1


def gallop(a: np.ndarray, b: np.ndarray, step: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Places in both of the values that two ascending arrays share. The shorter one is taken
    ``step`` values at a time; the end of the longer one's part that can hold them is found by
    doubling from where the last part ended, and only that part is searched."""
    if len(a) > len(b):
        there, here = gallop(b, a, step)
        return here, there
    places, at = [], 0
    for lo in range(0, len(a), step):
        part = a[lo:lo + step]
        reach = step
        while at + reach < len(b) and b[at + reach] < part[-1]:
            reach *= 2
        near = b[at:at + reach + 1]
        found = at + np.searchsorted(near, part)
        places.append(found)
        at = int(found[-1])
    found = np.concatenate(places) if places else np.zeros(0, np.int64)
    same = (found < len(b)) & (b[np.minimum(found, len(b) - 1)] == a) if len(b) else np.zeros(len(a), bool)
    return np.flatnonzero(same), found[same]


def difference(a: tuple, b: tuple) -> tuple[int, int]:
    """Terms that occur in either of two groups' blocks: the sum of their price differences, and how many
    they are. A side is its term numbers, counts, total and kept terms."""
    (ids_a, n_a, total_a, kept), (ids_b, n_b, total_b, _) = a, b
    in_a, in_b = gallop(ids_a, ids_b)
    p, q = prices(n_a, total_a, kept), prices(n_b, total_b, kept)
    none = np.zeros(1, np.int64)
    p_none, q_none = prices(none, total_a, kept)[0], prices(none, total_b, kept)[0]
    only_a, only_b = np.ones(len(p), bool), np.ones(len(q), bool)
    only_a[in_a] = only_b[in_b] = False
    value = (np.abs(p[in_a] - q[in_b]).sum() + np.abs(p[only_a] - q_none).sum()
             + np.abs(q[only_b] - p_none).sum())
    return int(value), len(p) + len(q) - len(in_a)


def _meet(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    def side(table, own, other):
        if table.num_rows:
            row = table.column("ids").combine_chunks(), table.column("ns").combine_chunks()
            return (*(x.flatten().to_numpy() for x in row), table.column("own")[0].as_py(), table.column("kept")[0].as_py())
        empty = np.zeros(0, np.int64)
        return empty, empty, other.column("their")[0].as_py(), other.column("kept")[0].as_py()

    value, either = difference(side(left, "own", right), side(right, "own", left))
    return pa.table({"lang": [key[0].as_py()], "a": [key[1].as_py()], "b": [key[2].as_py()],
                     "value": pa.array([value], pa.int64()), "either": pa.array([either], pa.int64())})


def pair_values(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for each source and each other one of its language.

    ``counts`` holds ``lang, source, id, n`` of kept terms, ``groups`` has ``lang, source, total, kept``
    for every group; both are stored tables.
    """
    blocks = counts.groupBy("lang", "source", F.floor(F.col("id") / BLOCK).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("id", "n"))).alias("terms")).select(
        "lang", "source", "block", F.col("terms.id").alias("ids"), F.col("terms.n").alias("ns"))
    left = groups.select("lang", F.col("source").alias("a"), F.col("total").alias("total_a"), "kept")
    right = groups.select("lang", F.col("source").alias("b"), F.col("total").alias("total_b"))
    pairs = left.join(right, "lang").where("a < b")
    sides, key = {}, ["lang", "a", "b", "block"]
    for own, other in (("a", "b"), ("b", "a")):
        mine = blocks.withColumnRenamed("source", own)
        sides[own] = pairs.join(mine, ["lang", own]).select(
            "lang", "a", "b", "block", "ids", "ns", f"total_{own}", f"total_{other}", "kept").toDF(
            *key, "ids", "ns", "own", "their", "kept")  # names of its own for each side
    met = sides["a"].groupBy(*key).cogroup(sides["b"].groupBy(*key)).applyInArrow(
        _meet, "lang string, a string, b string, value long, either long")
    summed = met.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("either").alias("either"))
    absent = F.abs(price(F.lit(0), F.col("total_a"), F.col("kept")) - price(F.lit(0), F.col("total_b"), F.col("kept")))
    valued = pairs.join(summed, ["lang", "a", "b"], "left").select("lang", "a", "b", F.when(
        F.col("kept") > 0, F.coalesce("value", F.lit(0)) + (F.col("kept") - F.coalesce("either", F.lit(0))) * absent)
        .otherwise(0).cast("long").alias("value"))
    return valued.select("lang", "value", F.inline(F.array(
        F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
        F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))).select("lang", "source", "item", "value")


def audit(docs: DataFrame) -> DataFrame:
    """``lang, source, part, item, value, rank``: how far each source is from each other one of its
    language (``pair``), and the terms it prices above its language (``term``)."""
    found, _ = stored(term_counts(docs), "term-counts")
    all_groups = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source")).distinct()
    by_term = found.groupBy("lang", "term").agg(F.sum("n").alias("in_lang"), F.sum("docs").alias("docs"))
    kept, _ = numbered(by_term.where(F.col("docs") >= MIN_DOCUMENTS).drop("docs"), F.col("lang"), F.col("term"), name="terms")
    kept = kept.withColumnRenamed("position", "id")
    counts, _ = stored(found.drop("docs").join(kept, ["lang", "term"]), "kept-counts")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("in_lang").alias("lang_total"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    groups, _ = stored(all_groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("total", "kept", "lang_total")]), "groups")

    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = counts.join(groups, ["lang", "source"]).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        (price(F.col("n"), F.col("total"), F.col("kept"))
         - price(F.col("in_lang"), F.col("lang_total"), F.col("kept"))).alias("value")).where("value > 0")
    pairs = pair_values(counts, groups).withColumn("part", F.lit("pair")).select(terms.columns)
    return pairs.withColumn("rank", F.row_number().over(best)).unionByName(
        terms.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= TOP_TERMS))
