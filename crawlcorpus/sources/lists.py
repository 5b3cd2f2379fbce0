"""Id lists, path lists and folder listings as DataFrames."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import strip_space
from ..plans.physical import with_place


def id_list(spark: SparkSession, path: str) -> DataFrame:
    """``id``: one per line, plain or gzipped, stripped."""
    return spark.read.text(path).select(strip_space(F.col("value")).alias("id"))


def inline_ids(spark: SparkSession, ids: str) -> DataFrame:
    """``id`` of each member of a comma-separated list."""
    return spark.range(1).select(F.explode(F.split(F.lit(ids), ",")).alias("id"))


def lines(spark: SparkSession, *paths: str) -> DataFrame:
    """``value``: lines as they are."""
    return spark.read.text(list(paths))


def path_list(spark: SparkSession, path: str) -> DataFrame:
    """``path``: one per line, plain or gzipped; also for lists of addresses."""
    return spark.read.text(path).select(F.col("value").alias("path"))


def archive_paths(spark: SparkSession, folder: str, pattern: str = "*.warc.gz") -> DataFrame:
    """``path, length`` of the archives below a folder; contents are not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", pattern).load(folder)
            .select(F.regexp_replace("path", "^file:(?=/)", "").alias("path"), "length"))


def finished_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """``out_path`` of what a folder holds or ``mark_finished`` recorded for it.

    The records matter for inputs of which nothing was kept, so that no file exists.
    """
    found = spark.createDataFrame([], "out_path string")
    for part in (lambda: archive_paths(spark, folder).select(F.col("path").alias("out_path")),
                 lambda: spark.read.schema("out_path string").parquet(f"{folder}/_finished")):
        try:
            found = found.unionByName(part())
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    return found


def mark_finished(outputs: DataFrame, folder: str) -> None:
    outputs.select("out_path").write.mode("append").parquet(f"{folder}/_finished")


def numbered(paths: DataFrame) -> DataFrame:
    """Add ``file_seq``, the place in path order."""
    return with_place(paths, "path", "file_seq").withColumn(
        "file_seq", F.col("file_seq").cast("int"))
