"""The few physical choices that Catalyst is not left to make."""

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session, which has a single machine, gets a temporary folder instead.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path is None:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        path = current.get() if current.isDefined() else None
    if path is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        path = tempfile.mkdtemp(prefix="crawlcorpus-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/crawlcorpus/{name}-{uuid.uuid4().hex}"


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any file system that Spark knows; none if it is not there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in system.listStatus(where)) if system.exists(where) else []


def remove(spark: SparkSession, path: str) -> None:
    """Remove a table that nothing will read again."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table that several later jobs read, and read it back.

    Cuts lineage: losing an executor later costs a re-read, not a re-extraction.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows that one task may sort and number, after a count.
SMALL_ROWS = 100_000


def with_place(df: DataFrame, order: str, place: str, small: int = SMALL_ROWS) -> DataFrame:
    """Number the rows from 0 by a column; many of them without bringing them to one task.

    Ranges of the column, as Spark samples them, are stored and numbered each for itself;
    the counts of the ranges before are added, one row per range. Up to ``small`` rows, counted
    first, are numbered as they are.
    """
    if df.limit(small + 1).count() <= small:
        return df.withColumn(place, F.row_number().over(Window.orderBy(order)).cast("bigint") - 1)
    ranged = materialize(df.repartitionByRange(shuffle_partitions(df), order).withColumn(
        "_part", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(order)) - 1
    return ranged.withColumn("_within", within).join(F.broadcast(bases), "_part").withColumn(
        place, F.col("_base") + F.col("_within")).drop("_part", "_base", "_within")


def broadcast_if_small(df: DataFrame, max_rows: int) -> tuple[DataFrame, bool]:
    """Mark a side for broadcast once its row count is known to be within bounds.

    The count is a plain one: each task adds up its own rows, and none move.
    """
    small = df.count() <= max_rows
    return (F.broadcast(df) if small else df), small


def spread(df: DataFrame, *key: str) -> DataFrame:
    """Give every core work before a costly map-side step.

    A crawl of many archives has far more splits than cores and is left alone; only a
    few large splits, as from one file with a single row group, are redistributed.
    Hashing on a key keeps retried tasks deterministic without sorting whole rows.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism  # ``df`` must be a plain scan
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *key)


def shuffle_partitions(df: DataFrame, target_bytes: int = 128 << 20) -> int:
    """Partitions for an explicit shuffle: as configured, more if the data need more.

    Uses the optimizer's size estimate, which comes from file sizes and runs nothing. A
    source without statistics reports an absurd size, which is not believed.
    """
    configured = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if estimate > 1 << 55:
        return configured
    return max(configured, -(-estimate // target_bytes))


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns that later filters must not compute a second time.

    Catalyst moves a filter below the projection that it tests and would repeat the
    expression there; it does not move one below a generator.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(row)))
