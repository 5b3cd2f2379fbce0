"""Exact duplicates of texts by digest.

Input is a *table* of ``digest``, ``id`` and the columns that give the archive order.
``plans.physical.materialize`` makes one: it is read more than once, and the extraction
it came from should run only once.
"""

from pyspark.sql import Column, DataFrame, functions as F

ORDER = ["file_seq", "rec_seq"]

#: A digest on more than one in this many rows is matched by broadcast. There can be no
#: more than this many such digests, whatever the data, so neither can the broadcast.
HOT_SHARE = 20_000


def first_seen(digests: DataFrame, order=ORDER) -> DataFrame:
    """``digest, first_id, n``: the earliest record of each digest and its row count.

    A plain aggregate: copies are merged before the shuffle, so a text that makes up a
    third of the crawl sends one row per task.
    """
    return digests.groupBy("digest").agg(
        F.min(F.struct(*order, "id"))["id"].alias("first_id"),
        F.count(F.lit(1)).alias("n"))


def with_first(digests: DataFrame, firsts: DataFrame, share: int = HOT_SHARE) -> DataFrame:
    """Join ``first_id`` to each row whose digest is in ``firsts (digest, first_id, n)``.

    Hot digests meet a broadcast of at most ``share`` rows and never move. The rest are
    joined by shuffle, where no digest has more than 1/``share`` of the rows. The two
    branches scan the (narrow) digest table twice and share one broadcast.
    """
    total = digests.agg(F.count(F.lit(1))).scalar()
    is_hot = F.col("n") * F.lit(share) > total
    hot = firsts.where(is_hot).select("digest", "first_id")
    cold = firsts.where(~is_hot).select("digest", "first_id")
    probed = digests.join(F.broadcast(hot), "digest", "left")
    return probed.where("first_id is not null").unionByName(
        probed.where("first_id is null").drop("first_id").join(cold, "digest"))


def _later() -> Column:
    """A later row under another id; the same id again is the same record."""
    return F.col("id") != F.col("first_id")


def find_duplicates(digests: DataFrame, order=ORDER) -> DataFrame:
    """``id, first_id`` for each later record with the text of an earlier one."""
    repeated = first_seen(digests, order).where("n > 1")
    return with_first(digests, repeated).where(_later()).select("id", "first_id")


def drop_duplicates(digests: DataFrame, order=ORDER) -> DataFrame:
    """The rows that ``find_duplicates`` does not report."""
    return with_first(digests, first_seen(digests, order)).where(~_later()).drop("first_id")


def distinct_texts(digests: DataFrame, order=ORDER) -> DataFrame:
    """``id, digest, n_copies, n_chars``: one row per distinct text, by its first id."""
    return digests.groupBy("digest").agg(
        F.min(F.struct(*order, "id"))["id"].alias("id"),
        F.count(F.lit(1)).alias("n_copies"), F.min("n_chars").alias("n_chars"))


def against_index(digests: DataFrame, index: DataFrame, order=ORDER) -> DataFrame:
    """``digest, first_id, n, is_new`` of every digest, given those of earlier runs.

    ``index (digest, first_id)`` has one row per digest, and its ids win over any here.
    Copies are merged before the index is consulted, so both sides of the join have one
    row per digest. Rows with ``is_new`` are what the index lacks.
    """
    known = index.select("digest", F.col("first_id").alias("known_id"))
    return first_seen(digests, order).join(known, "digest", "left").select(
        "digest", F.coalesce("known_id", "first_id").alias("first_id"), "n",
        F.col("known_id").isNull().alias("is_new"))


def duplicates_given(digests: DataFrame, settled: DataFrame) -> DataFrame:
    """``id, first_id`` of these rows, given a table that ``against_index`` computed."""
    wanted = settled.where("n > 1 or not is_new")
    return with_first(digests, wanted).where(_later()).select("id", "first_id")
