"""The ``warc`` data source: archives as record rows, and record rows as archives.

    register(spark)
    spark.read.format("warc").load("dir-or-file")
    records.write.format("warc").mode("append").save("dir")

Reading: one task per archive, or per run of small archives up to
``maxPartitionBytes`` that still leaves ``minPartitions`` tasks. A compressed stream is read front to back with one batch of
records in memory. Writing: one archive per task, or with ``inputRoot`` one per input
file at the same relative path; a file appears under its final name only when the job
commits.
"""

import fnmatch
import gzip
import json
import os
import re
import uuid
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader,
                                    InputPartition, WriterCommitMessage)
from pyspark.sql.pandas.types import to_arrow_schema

from ..schema import MEMBER, RECORD
from .files import absolute, located
from .records import (FORMAT_ERRORS, Position, next_record, open_archive, read_records,
                      write_record)

MOVES_AT_ONCE = 16
BATCH_ROWS = 256
BATCH_BYTES = 8 << 20
OPEN_COST = 4 << 20
_HIDDEN = re.compile(r"(?:^|/)[_.]")


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)


def list_archives(path: str, pattern: str) -> list[tuple[str, int]]:
    """``(path, size)`` in path order: the file itself, or matches below the folder.

    As for Spark's own sources, names that begin with ``_`` or ``.`` are not data: they
    hold the unfinished output of running or failed jobs.
    """
    filesystem, local = located(path)
    info = filesystem.get_file_info(local)
    path = path.rstrip("/")
    prefix = path[:len(path) - len(local)] if path.endswith(local) else ""
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == fs.FileType.File:
        return [(path, info.size)]
    found = filesystem.get_file_info(fs.FileSelector(local, recursive=True))
    return sorted((prefix + f.path, f.size) for f in found
                  if f.type == fs.FileType.File and fnmatch.fnmatch(f.base_name, pattern)
                  and not _HIDDEN.search(f.path[len(local):]))


def _lowered(options) -> dict:
    return {name.lower(): str(value) for name, value in dict(options).items()}


def _indexing(options: dict) -> bool:
    return options.get("index", "false").lower() == "true"


class ArchiveScan:
    """Rows of archives under one set of options; runs inside tasks."""

    def __init__(self, options):
        options = _lowered(options)
        self.mode = options.get("mode", "PERMISSIVE").upper()
        self.keep_raw = options.get("keepraw", "false").lower() == "true"
        self.keep_content = options.get("content", "true").lower() == "true"
        self.http_headers = options.get("httpheaders", "true").lower() == "true"
        types = options.get("recordtypes", "")
        self.types = {t.strip() for t in types.split(",") if t.strip()}

    def wanted(self, headers: dict) -> bool:
        return not self.types or headers.get("warc-type") in self.types

    def read(self, stream, position=None):
        return read_records(stream, wanted=self.wanted, content=self.keep_content, raw=self.keep_raw,
                            http_headers=self.http_headers, position=position)

    def rows(self, path: str, seq: int, name: str | None = None):
        """Records of an archive; ``name`` stands in ``file`` instead of its path.

        Where an archive is damaged the scan goes on at the next record that can be found; what
        was lost in between is one row with an ``error``, which counts as a record.
        """
        count, name, offset = 0, name or path, 0
        while offset is not None:
            position, stream = Position(), None
            try:
                with open_archive(path, offset) as stream:
                    for count, record in enumerate(self.read(stream, position), count + 1):
                        if record is not None:
                            headers, http, content, raw = record
                            yield (name, seq, count, headers.get("warc-type"), headers, http, content, raw, None)
                if not count:
                    raise ValueError("no records")
                return
            except (*FORMAT_ERRORS, FileNotFoundError) as e:
                if self.mode == "FAILFAST" or isinstance(e, pa.ArrowException):
                    raise
                count += 1
                if self.mode == "PERMISSIVE":
                    yield (name, seq, count, None, None, None, None, None, f"{type(e).__name__}: {e}")
                if stream is None or path.endswith(".zst"):
                    return
                offset = next_record(path, stream.raw.start_of(position.at)[1])

    def index(self, path: str, seq: int):
        """``file, file_seq, rec_seq, offset, length, rec_type, id, refers_to`` of records that begin a
        member of their own or stand in a plain file; of others ``offset`` is null. ``length`` is
        null for the last one of a stretch, which reaches as far as it reaches."""
        count, offset = 0, 0
        while offset is not None:
            position, stream, last = Position(), None, None
            try:
                with open_archive(path, offset) as stream:
                    for count, record in enumerate(read_records(
                            stream, wanted=self.wanted, content=False, raw=False, http_headers=False, position=position), count + 1):
                        if record is None:
                            continue
                        headers = record[0]
                        start, place = (None, None) if path.endswith(".zst") else stream.raw.start_of(position.at)
                        place = place if start == position.at else None
                        if last:
                            yield (*last[:4], place - last[3] if None not in (place, last[3]) else None, *last[4:])
                        last = (path, seq, count, place, headers.get("warc-type"),
                                headers.get("warc-record-id"), headers.get("warc-refers-to"))
                offset = None
            except FORMAT_ERRORS as e:
                if self.mode == "FAILFAST" or isinstance(e, pa.ArrowException):
                    raise
                count += 1
                again = stream is not None and not path.endswith(".zst")
                offset = next_record(path, stream.raw.start_of(position.at)[1]) if again else None
            if last:
                yield (*last[:4], None, *last[4:])

    def member(self, path: str, seq: int, count: int, offset: int):
        """The row of one record that an index names."""
        with open_archive(path, offset) as stream:
            headers, http, content, raw = next(read_records(
                stream, content=self.keep_content, raw=self.keep_raw, http_headers=self.http_headers))
        return (path, seq, count, headers.get("warc-type"), headers, http, content, raw, None)

    def batches(self, archives):
        return batched(row for archive in archives for row in self.rows(*archive))


def batched(found, kind=RECORD):
    """Rows of a schema in batches of bounded size."""
    schema, rows, size = to_arrow_schema(kind), [], 0
    for row in found:
        rows.append(row)
        size += sum(len(x) for x in row if isinstance(x, bytes))
        if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
            yield _batch(rows, schema)
            rows, size = [], 0
    if rows:
        yield _batch(rows, schema)


def _batch(rows, schema) -> pa.RecordBatch:
    def array(column, field):
        if pa.types.is_map(field.type):
            column = [None if m is None else list(m.items()) for m in column]
        return pa.array(column, field.type)
    return pa.RecordBatch.from_arrays(
        [array(column, field) for column, field in zip(zip(*rows), schema)], schema=schema)


class _Archives(InputPartition):
    def __init__(self, archives):
        self.archives = archives


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.options = _lowered(options)

    def partitions(self):
        paths = json.loads(self.options["paths"]) if "paths" in self.options else [
            self.options["path"]]
        pattern = self.options.get("pathglobfilter", "*.warc.gz")
        found = [f for path in paths for f in list_archives(path, pattern)]
        # as for Spark's own files: few enough bytes for all cores to have work, but not
        # a task for every tiny archive
        share = sum(size for _, size in found) // int(self.options.get("minpartitions", 64))
        limit = min(int(self.options.get("maxpartitionbytes", 128 << 20)),
                    max(OPEN_COST, share))
        groups, room = [], 0
        for seq, (path, size) in enumerate(found):
            if not groups or size > room:
                groups.append([])
                room = limit
            groups[-1].append((path, seq))
            room -= size
        return [_Archives(g) for g in groups] or [_Archives([])]

    def read(self, partition):
        scan = ArchiveScan(self.options)
        if _indexing(self.options):
            yield from batched((row for a in partition.archives for row in scan.index(*a)), MEMBER)
        else:
            yield from scan.batches(partition.archives)


class _Written(WriterCommitMessage):
    def __init__(self, files, unread):
        self.files, self.unread = files, unread


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options):
        options = _lowered(options)
        self.path = options["path"].rstrip("/")
        self.root = options.get("inputroot")
        self.unread = options.get("unreadpath")
        self.job = uuid.uuid4().hex
        self.pending = f"{self.path}/_temporary/{self.job}"

    def _final(self, row_file: str, task: int) -> str:
        if self.root is None:
            return f"{self.path}/part-{task:05d}-{self.job}.warc.gz"
        relative = row_file.removeprefix(self.root.rstrip("/") + "/").lstrip("/")
        return f"{self.path}/{relative}"

    def write(self, iterator):
        context = TaskContext.get()
        folder = f"{self.pending}/{context.taskAttemptId()}"
        filesystem, local = located(folder)
        filesystem.create_dir(local, recursive=True)
        written, unread, current, stream = {}, [], None, None
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if row.get("error") is not None:  # no record, but what a reader met
                        unread.append((row["file"], row["error"]))
                        continue
                    final = self._final(row["file"], context.partitionId())
                    if final != current:
                        if final in written:
                            raise ValueError("records of one input are not together: sort "
                                             "them by file, or leave inputRoot out")
                        if stream is not None:
                            stream.close()
                        written[final] = f"{local}/{len(written)}.warc.gz"
                        stream = filesystem.open_output_stream(written[final], compression=None)
                        current = final
                    raw = row.get("raw")
                    if raw is None and row["content"] is None:
                        raise ValueError("rows without payload: read them with content, or "
                                         "with keepRaw")
                    raw = raw or write_record(
                        dict(row["headers"]), dict(row["http_headers"] or []), row["content"])
                    stream.write(gzip.compress(raw, 6))
        finally:
            if stream is not None:
                stream.close()
        return _Written([(temporary, final) for final, temporary in written.items()], unread)

    def commit(self, messages):
        files = [f for m in messages if m for f in m.files]
        unread = [x for m in messages if m for x in m.unread]
        if self.unread is not None:  # inputs that are to be read again leave no output
            partial = {self._final(file, 0) for file, _ in unread}
            files = [f for f in files if f[1] not in partial]
        finals = [final for _, final in files]
        if len(set(finals)) < len(finals):
            raise ValueError("records of one input came from several tasks: write them "
                             "before any shuffle, or leave inputRoot out")
        filesystem, local = located(self.path)
        filesystem.create_dir(local, recursive=True)

        def move(file):
            target = located(file[1])[1]
            filesystem.create_dir(os.path.dirname(target), recursive=True)
            filesystem.move(file[0], target)
        with ThreadPoolExecutor(MOVES_AT_ONCE) as pool:
            list(pool.map(move, files))
        if self.unread is not None:
            self._note(unread)
        self._discard_pending()
        with filesystem.open_output_stream(f"{local}/_SUCCESS"):
            pass

    def _note(self, unread):
        """What could not be read, as JSON lines of ``file, error``."""
        filesystem, folder = located(self.unread)
        filesystem.create_dir(folder, recursive=True)
        with filesystem.open_output_stream(f"{folder}/{self.job}.json") as out:
            for file, error in unread:
                out.write(json.dumps({"file": file, "error": error}).encode() + b"\n")

    def abort(self, messages):
        self._discard_pending()

    def _discard_pending(self):
        """What this job's failed or repeated attempts left behind."""
        filesystem, local = located(self.pending)
        if filesystem.get_file_info(local).type == fs.FileType.Directory:
            filesystem.delete_dir(local)


class WarcSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return MEMBER if _indexing(_lowered(self.options)) else RECORD

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("archives are only added: write to a new folder")
        return WarcWriter(self.options)


def read_archives(spark: SparkSession, *paths: str, **options) -> DataFrame:
    """Records of files and folders, in the order given. What the scan may pass over is given as
    options: Spark 4.1 keeps filters that it hands down to a Python source with the relation, so
    that two branches of one query would read by the filters of the last."""
    register(spark)
    cores = spark.sparkContext.defaultParallelism
    return (spark.read.format("warc").option("paths", json.dumps([absolute(p) for p in paths]))
            .option("minPartitions", 2 * cores).options(**options).load())


def read_listed(manifest: DataFrame, **options) -> DataFrame:
    """Records of the archives in a table of ``path, file_seq``, and optionally ``name``,
    which then stands in ``file``.

    The paths stay in the table: they are spread over tasks and read where they land,
    so a plan of any length never passes through the driver.
    """
    columns = ["path", "file_seq", *({"name"} & set(manifest.columns))]
    scan = ArchiveScan(options)

    def read(batches):
        for batch in batches:
            yield from scan.batches(zip(*batch.to_pydict().values()))

    tasks = int(options.get("tasks", manifest.sparkSession.sparkContext.defaultParallelism))
    placed = manifest.select(*columns).repartition(tasks, "path")
    return placed.mapInArrow(read, RECORD)
