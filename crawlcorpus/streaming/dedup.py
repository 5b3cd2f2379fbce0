"""Duplicate search over a stream, with an index that survives between runs.

Every micro-batch is settled against the index with the batch operators, so a text that
floods a batch is merged before any shuffle and no group is ever held by one task. The
index has each digest once: a batch adds a folder ``batch=N`` of those it was the first to have, and
when there are more than ``MERGE_PARTS`` folders they become one, ``upto=N``. Tables that only a batch itself
needs are removed when it is done. A batch that is retried after a failure replaces its own
folders and ignores them while reading, so each is counted once; folders that a merge has taken up are
ignored from the moment it is complete.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..operators import dedup as D
from ..plans.physical import folders, remove

#: Folders of the index that a batch reads at most.
MERGE_PARTS = 8


class DuplicateStream:
    """``base`` is a folder all executors share; ``schema`` is that of the digest rows.

    First means first to arrive: within a batch by ``order``, across batches by batch.
    """

    def __init__(self, spark: SparkSession, base: str, schema: StructType, order=D.ORDER):
        self.spark, self.order = spark, list(order)
        self.index, self.pairs = f"{base}/index", f"{base}/pairs"
        self.progress, self.work = f"{base}/progress", f"{base}/work"
        self.digest_type = schema["digest"].dataType.simpleString()
        self.id_type = schema["id"].dataType.simpleString()
        self.known = f"digest {self.digest_type}, first_id {self.id_type}"

    def duplicates(self) -> DataFrame:
        """``batch, id, first_id`` found so far; none before the first batch."""
        kinds = f"id {self.id_type}, first_id {self.id_type}, batch bigint"
        found = (self.spark.read.schema(kinds).parquet(self.pairs) if folders(self.spark, self.pairs)
                 else self.spark.createDataFrame([], kinds))
        return found.select("batch", "id", "first_id")

    def _parts(self, before: int) -> list[tuple[int, str]]:
        """Folders that together hold the digests of all batches before a number: the last complete
        merge, and the batches since."""
        found = []
        for name in folders(self.spark, self.index):
            kind, _, number = name.partition("=")
            if kind in ("upto", "batch") and int(number) < before:
                path = f"{self.index}/{name}"
                if kind == "batch" or "_SUCCESS" in folders(self.spark, path):
                    found.append((int(number), kind, path))
        base = max((x for x in found if x[1] == "upto"), default=(-1, "", ""))
        return [(n, path) for n, kind, path in sorted(found) if n > base[0] or path == base[2]]

    def _earlier(self, number: int) -> DataFrame:
        """``digest, first_id`` of all batches before this one."""
        parts = [path for _, path in self._parts(number)]
        if not parts:
            return self.spark.createDataFrame([], self.known)
        return self.spark.read.schema(self.known).parquet(*parts)

    def _merge(self, number: int) -> None:
        """One folder of all that batches before this one have left, if there are many."""
        if len(self._parts(number)) <= MERGE_PARTS:
            return
        self._earlier(number).write.mode("overwrite").parquet(f"{self.index}/upto={number - 1}")
        for name in folders(self.spark, self.index):
            if name != f"upto={number - 1}" and int(name.partition("=")[2]) < number:
                remove(self.spark, f"{self.index}/{name}")

    def _settle(self, batch: DataFrame, number: int) -> None:
        self._merge(number)
        work = f"{self.work}/batch={number}"
        batch.write.mode("overwrite").parquet(f"{work}/rows")
        rows = self.spark.read.schema(batch.schema).parquet(f"{work}/rows")
        settled = D.against_index(rows, self._earlier(number), self.order)
        settled.write.mode("overwrite").parquet(f"{work}/settled")
        settled = self.spark.read.schema(settled.schema).parquet(f"{work}/settled")
        settled.where("is_new").select("digest", "first_id").write.mode("overwrite").parquet(
            f"{self.index}/batch={number}")
        D.duplicates_given(rows, settled).write.mode("overwrite").parquet(f"{self.pairs}/batch={number}")
        remove(self.spark, work)

    def add(self, rows: DataFrame) -> int:
        """Process a batch table as the next batch; returns its number.

        For runs without a stream. One index is fed either by ``run`` or by ``add``.
        """
        done = [name for name in folders(self.spark, self.pairs) if name.startswith("batch=")
                and "_SUCCESS" in folders(self.spark, f"{self.pairs}/{name}")]  # what failed runs again
        number = max((int(name.partition("=")[2]) for name in done), default=-1) + 1
        self._settle(rows, number)
        return number

    def run(self, rows: DataFrame) -> None:
        """Process everything that has arrived since the last run, then stop."""
        query = (rows.writeStream.foreachBatch(self._settle)
                 .option("checkpointLocation", self.progress)
                 .trigger(availableNow=True).start())
        query.awaitTermination()
