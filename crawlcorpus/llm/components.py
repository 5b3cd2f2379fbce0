"""Connected components by alternating large-star and small-star joins.

Every round is two star operations (Kiveris et al., "Connected Components in MapReduce and
Beyond", 2014), each an aggregate and a join on the node. The least neighbour of a node is
found by a partial aggregate, and the join with one row per node lets Spark split a node of
many edges, so no star is gathered in one task. Each round's edges are stored, which cuts
lineage, and the round before is removed.
"""

from pyspark.sql import DataFrame, functions as F

from .storage import discard, stored

EDGES_PER_FILE = 500_000


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def large_star(edges: DataFrame) -> DataFrame:
    """Each neighbour above a node is linked to the least of the node and its neighbours."""
    both = _both_ways(edges)
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def small_star(edges: DataFrame) -> DataFrame:
    """A node and its neighbours below it are linked to the least of them. Edges point down."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    linked = F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                     F.struct(F.col("u").alias("u"), F.col("m").alias("v")))
    return edges.join(least, "u").select(F.inline(linked)).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``u, v`` (any direction, loops and repeats allowed, no nulls) to ``node, component``.

    The component is its least node. Nodes without an edge to another are not returned.
    """
    spark = edges.sparkSession
    now, path = stored(edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "stars")
    # a round never has more edges than the first, so files need not be more than these take
    files = 1 + now.count() // EDGES_PER_FILE
    mark = None
    while True:
        large, large_at = stored(large_star(now).coalesce(files), "stars")
        then, old = stored(small_star(large).coalesce(files), "stars")
        # a forest of stars is a fixed point: the same edges, each from a node to its root
        state = then.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")),
                         F.sum(F.xxhash64("v", "u") % 1_000_003)).first()
        discard(spark, path, large_at)
        now, path = then, old
        if state == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        mark = state
