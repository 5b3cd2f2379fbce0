"""Tables between jobs, row order over a whole table, and removal of what is no longer read."""

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..plans.physical import fresh_path, shared_dir, shuffle_partitions


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write a table to the shared folder and read it back; also its path."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Remove stored tables of this session's folder that nothing will read again."""
    root = shared_dir(spark)
    for path in paths:
        if not path.startswith(f"{root}/crawlcorpus/"):
            raise ValueError(f"not a stored table: {path}")
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def ordered(df: DataFrame, *order: Column, name: str = "ordered") -> tuple[DataFrame, str]:
    """The rows with ``part`` (a range of the order) stored, ready for ``lead`` or numbering.

    Spark's range partitioning samples the keys, so parts are even whatever the ids; one
    part is one range, and only ranges, never the table, are sorted in a task.
    """
    n = shuffle_partitions(df)
    ranged = df.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id())
    return stored(ranged, name)


def numbered(df: DataFrame, *order: Column, name: str = "ordered") -> tuple[DataFrame, str]:
    """Add ``position``, from 0, in the given order over all rows.

    Ranges are numbered each for itself and moved by the counts of the ranges before; that
    table of counts has one row per range.
    """
    parts, path = ordered(df, *order, name=name)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.groupBy("part").agg(F.count(F.lit(1)).alias("_n")).select(
        "part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    within = F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    return parts.withColumn("_within", within).join(F.broadcast(bases), "part").withColumn(
        "position", F.col("_base") + F.col("_within")).drop("_base", "_within", "part"), path
