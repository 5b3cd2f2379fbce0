"""Process each archive once, across runs.

The stream carries paths only; which of them were done is kept in its checkpoint, so a
run that stops half-way goes on where it stopped.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schema import RECORD  # noqa: F401  (documents what ``job`` receives)
from ..sources.lists import numbered
from ..sources.warc import read_listed


def new_archives(spark: SparkSession, folder: str, pattern: str = "*.warc.gz",
                 per_batch: int = 1000) -> DataFrame:
    """A stream of the ``path`` of archives as they appear below a folder.

    Only the path column is read, so Spark never opens the files.
    """
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    files = (spark.readStream.format("binaryFile").schema(schema)
             .option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
             .option("maxFilesPerTrigger", per_batch).load(folder))
    return files.select(F.regexp_replace("path", "^file:(?=/)", "").alias("path"))


def process_new(spark: SparkSession, folder: str, progress: str,
                job: Callable[[DataFrame, int], None], pattern: str = "*.warc.gz",
                per_batch: int = 1000, **options) -> None:
    """Run ``job(records, batch_number)`` over archives not yet done, then stop.

    A batch may run again after a failure: ``job`` should write to a place named by the
    batch number and replace what is there.
    """
    def run(batch: DataFrame, number: int) -> None:
        job(read_listed(numbered(batch), **options), number)

    query = (new_archives(spark, folder, pattern, per_batch).writeStream.foreachBatch(run)
             .option("checkpointLocation", progress).trigger(availableNow=True).start())
    query.awaitTermination()
