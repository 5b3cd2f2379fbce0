"""Mixing sources to target weights.

1. Words are counted for each document, and added up for each source.
2. Sources in order of their name, null last, get the ``weights`` in turn and share the words of
   all by weight. A source takes ``MOST`` times its words at most; what is over is shared again by
   weight among the others, until none is above. That is one level for all others: the words left
   for them by their weights. The sources that stop at their limit are those with the
   least limits for their weight, a beginning of that order, found by running sums.
3. A source's rate is its target by its words. Each document comes ``floor(rate)`` times, and once more
   if a number drawn by a hash of its id, below 1, is less than the rate's fraction.
4. Draws are made for ``SEEDS`` seeds at once, and each source keeps the seed whose words come
   nearest to its target, the first of equals. So small sources with a few long
   documents are near their target too.

Built-in functions only; sources are ranked and summed in ranges, never in one task. Documents meet
the rates of their sources by broadcast if these are few (counted), else by a join over salted keys, so that a
source that holds a third of all rows is split.

Defined cases: a null text has no words and costs nothing; a source without words has target 0 and
none of its documents are taken. Null is a source of its own. A document without an id is drawn by its
text. Rows that repeat id and text are drawn alike. An empty table gives an empty mix.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..plans.physical import broadcast_if_small
from .storage import ordered, stored

WEIGHTS = (1, 2, 3)
MOST = 3
SEEDS = 16
BROADCAST_SOURCES = 100_000
SALTS = 32


def size_of(text: Column) -> Column:
    """Words, as runs of characters other than 0x20 and 0x09 to 0x0D."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def draws(key: Column) -> list[Column]:
    """``SEEDS`` numbers of 32 bits: four from each digest of a seed and the key."""
    digests = [F.md5(F.concat(F.lit(f"{k}:"), key)) for k in range(SEEDS // 4)]
    return [F.conv(F.substring(d, at, 8), 16, 10).cast("long") for d in digests for at in (1, 9, 17, 25)]


def key_of(doc_id: Column, text: Column) -> Column:
    """What a document is drawn by."""
    return F.coalesce(doc_id.cast("string"), F.concat(F.lit("-"), F.md5(F.coalesce(text, F.lit("")))))


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, key``, stored."""
    return stored(docs.select(
        "doc_id", "source", size_of(F.col("text")).alias("size"),
        key_of(F.col("doc_id"), F.col("text")).alias("key")), "sizes")[0]


def _running(df: DataFrame, *order: Column, name: str, **sums: Column) -> DataFrame:
    """Sums over all rows up to each, in an order over the whole table: within ranges, moved by the
    totals of the ranges before, of which there is one row for each range."""
    parts, _ = ordered(df, *order, name=name)
    within = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = parts.groupBy("part").agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()]).select(
        "part", *[F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}") for n in sums])
    return parts.withColumns({n: F.sum(c).over(within) for n, c in sums.items()}).join(
        F.broadcast(totals), "part").select(
        *df.columns, *[(F.col(n) + F.col(f"_{n}")).alias(n) for n in sums])


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``source, source_size, share, parts``: a source's target is ``share / parts``, both whole numbers."""
    sources, _ = stored(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    ranked = _running(sources, F.asc_nulls_last("source"), name="ranked", place=F.lit(1).cast("long"))
    turn = F.array(*[F.lit(w).cast("long") for w in weights])
    weighed = ranked.withColumn("weight", F.get(turn, ((F.col("place") - 1) % len(weights)).cast("int"))).drop("place")
    # limits by weight are compared as whole numbers: by the limit times what makes weights equal
    common = 1
    for w in set(weights):
        common *= w
    limit = MOST * F.col("source_size")
    weighed = weighed.withColumn("height", limit * (F.lit(common) / F.col("weight")).cast("long"))
    rising = _running(weighed, F.asc("height"), F.asc_nulls_last("source"), name="rising",
                      limits=limit, weights=F.col("weight"))
    rising, _ = stored(rising, "rising")
    total, all_weights = (x or 0 for x in rising.agg(F.sum("source_size"), F.sum("weight")).first())
    # a source stops if the level that its own limit stands for takes less than there is
    wide = "decimal(38, 0)"
    stops = ((F.lit(total) - (F.col("limits") - limit)).cast(wide) * F.col("weight")
             > limit.cast(wide) * (F.lit(all_weights) - (F.col("weights") - F.col("weight"))))
    marked = rising.withColumn("stops", stops)
    stopped, heavy = (x or 0 for x in marked.where("stops").agg(F.sum(limit), F.sum("weight")).first())
    return marked.select(
        "source", "source_size", F.when(F.col("stops"), limit).otherwise(F.lit(total - stopped) * F.col("weight")).alias("share"),
        F.when(F.col("stops"), F.lit(1)).otherwise(F.lit(all_weights - heavy)).cast("long").alias("parts"))


def _met(docs: DataFrame, rates: DataFrame) -> DataFrame:
    """Documents with the columns of their source's row; sources may be null."""
    rates = rates.withColumnRenamed("source", "_source")
    few, small = broadcast_if_small(rates, BROADCAST_SOURCES)
    if small:
        return docs.join(few, docs["source"].eqNullSafe(few["_source"])).drop("_source")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
    docs = docs.withColumn("_own", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int"))
    rates = rates.select("*", salts)
    return docs.join(rates, docs["source"].eqNullSafe(rates["_source"]) & (docs["_own"] == rates["_salt"])).drop(
        "_source", "_own", "_salt")


#: Copies and the chance of one more, from a source's columns. A source without words has neither.
_BOTTOM = "nullif(cast(parts as decimal(18, 0)) * cast(source_size as decimal(19, 0)), 0)"
_WHOLE = f"coalesce(cast(share as decimal(20, 0)) div {_BOTTOM}, 0)"
_CHANCE = f"coalesce(cast(cast(share as decimal(20, 0)) % {_BOTTOM} as double) / cast({_BOTTOM} as double), 0D)"
_SPAN = float(1 << 32)


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> tuple[DataFrame, DataFrame]:
    """The sizes of documents, and a row for each source: ``source_size``, ``target``, ``copies`` for all
    of its documents, the ``chance`` of one more, and the ``seed`` to draw by."""
    sizes = sized(docs)
    rates, _ = stored(targets(sizes, weights).select(
        "source", "source_size", (F.col("share").cast("double") / F.col("parts").cast("double")).alias("target"),
        F.expr(_WHOLE).alias("copies"), F.expr(_CHANCE).alias("chance")), "rates")
    drawn = _met(sizes.select("source", "size", "key"), rates.select("source", "chance"))
    extra = drawn.groupBy("source").agg(*[
        F.sum(F.when(u < F.col("chance") * _SPAN, F.col("size")).otherwise(0)).alias(f"x{k}")
        for k, u in enumerate(draws(F.col("key")))])
    extra = extra.withColumnRenamed("source", "_source")
    met = rates.join(extra, rates["source"].eqNullSafe(extra["_source"]))
    off = [F.struct(F.abs(F.col("copies") * F.col("source_size") + F.col(f"x{k}") - F.col("target")).alias("off"),
                    F.lit(k).alias("seed")) for k in range(SEEDS)]
    seeded, _ = stored(met.select(*rates.columns, F.array_min(F.array(*off))["seed"].alias("seed")), "seeded")
    return sizes, seeded


def with_copies(sizes: DataFrame, rates: DataFrame) -> DataFrame:
    """Rows of ``sized`` with how often each document comes, and its source's columns."""
    met = _met(sizes, rates)
    drawn = F.get(F.array(*draws(F.col("key"))), F.col("seed"))
    return met.withColumn("copies", F.col("copies") + (drawn < F.col("chance") * _SPAN).cast("long"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The mix itself: the documents, all columns, each as often as it comes."""
    _, rates = plan(docs, weights)
    rows = docs.select("source", F.struct("*").alias("_row"), key_of(F.col("doc_id"), F.col("text")).alias("key"))
    return with_copies(rows, rates).select(
        "_row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("_row.*")


def taken(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``doc_id, size, source_size, target, taken``: the words each document gives to the mix."""
    sizes, rates = plan(docs, weights)
    return with_copies(sizes, rates).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
