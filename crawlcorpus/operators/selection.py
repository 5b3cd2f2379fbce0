"""Selecting records by id lists."""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.headers import normalize_id
from ..plans.physical import broadcast_if_small

#: Ids are about 50 bytes, so a list of this length is at most some 100 MB in memory.
MAX_BROADCAST_IDS = 1_000_000


def by_id_list(records: DataFrame, ids: DataFrame, id_: Column,
               max_broadcast: int = MAX_BROADCAST_IDS) -> DataFrame:
    """Records whose id is listed, in any spelling; a missing id never is.

    ``ids`` has one column ``id``. A short list is broadcast, so no payload moves. A
    long one is joined by sort-merge, left as it is: a semi join needs no distinct list,
    and adaptive execution can split a hot id only if no aggregate stands in between.
    """
    listed, _ = broadcast_if_small(ids.select(normalize_id(F.col("id")).alias("_listed")), max_broadcast)
    return records.withColumn("_id", normalize_id(id_)).join(
        listed, F.col("_id") == F.col("_listed"), "left_semi").drop("_id")


def repeated_ids(ids: DataFrame) -> DataFrame:
    """Ids that a list holds more than once, with the number of times."""
    return ids.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def distinct_ids(ids: DataFrame) -> DataFrame:
    return ids.select("id").distinct()
