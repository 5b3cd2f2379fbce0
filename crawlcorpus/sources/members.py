"""An index of the records of archives, and reading of chosen records by their place.

The index is a narrow table, made by one scan that decodes no payload and keeps none:

    file, file_seq, rec_seq, offset, length, rec_type, id, refers_to

A record that is a gzip member of its own, or stands in a plain file, can be read by itself. So a
selection is a join of narrow rows, after which only chosen records are read, each once and by the
task that needs it, and one large archive is read by many tasks. Records of other archives have
no ``offset``; those archives are read front to back by one task each, and rows picked from them.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.headers import normalize_id
from ..schema import RECORD
from .warc import ArchiveScan, batched, read_archives

#: Bytes of chosen records for a task.
TASK_BYTES = 64 << 20
#: Taken for the length of a record whose length is not known.
USUAL_BYTES = 1 << 15


def member_index(spark: SparkSession, *paths: str, **options) -> DataFrame:
    """Rows of ``schema.MEMBER`` for all records of files and folders, by one scan."""
    return read_archives(spark, *paths, index="true", **options)


def chosen(index: DataFrame, ids: DataFrame, id_: Column | None = None) -> DataFrame:
    """Rows of an index whose id (or other column) is in a list of ``id``, in any spelling."""
    listed = ids.select(normalize_id(F.col("id")).alias("_listed"))
    own = normalize_id(F.col("id") if id_ is None else id_)
    return index.withColumn("_own", own).join(listed, F.col("_own") == F.col("_listed"), "left_semi").drop("_own")


def read_members(rows: DataFrame, together: bool = False, **options) -> DataFrame:
    """Records of chosen rows of an index, in ``schema.RECORD``.

    Rows are dealt in ranges of their place, so a task reads on in one archive, and by their bytes;
    ``together`` leaves the records of an archive in one task, in order.
    """
    scan, spark = ArchiveScan(options), rows.sparkSession
    places = rows.select("file", "file_seq", "rec_seq", "offset", "length")
    total = places.agg(F.sum(F.coalesce("length", F.lit(USUAL_BYTES)))).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    # an archive without places is one range, whatever its records
    order = ["file", *([] if together else [F.when(F.col("offset").isNotNull(), F.col("rec_seq"))])]
    dealt = places.repartitionByRange(tasks, *order).sortWithinPartitions("file", "rec_seq")

    def read(batches):
        def found():
            whole, wanted = None, set()  # an archive without places, and its records to pick
            for batch in batches:
                for r in batch.to_pylist():
                    if whole and whole != (r["file"], r["file_seq"]):
                        yield from picked(whole, wanted)
                        whole, wanted = None, set()
                    if r["offset"] is None:
                        whole = r["file"], r["file_seq"]
                        wanted.add(r["rec_seq"])
                    else:
                        yield scan.member(r["file"], r["file_seq"], r["rec_seq"], r["offset"])
            if whole:
                yield from picked(whole, wanted)

        def picked(archive, wanted):
            return (row for row in scan.rows(*archive) if row[2] in wanted and row[8] is None)
        yield from batched(found())

    return dealt.mapInArrow(read, RECORD)
