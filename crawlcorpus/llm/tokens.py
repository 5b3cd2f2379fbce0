"""Token ids by a public tokenizer file, and token files that can be memory-mapped.

A set of token files in one folder:

* ``part-*.bin``: the ids of a range of documents, one after the other, as little-endian
  unsigned integers of 2 bytes if every id fits, else 4;
* ``part-*.off``: where each document begins in its file, as little-endian unsigned 64-bit
  integers counted in ids, and at last the file's length;
* ``part-*.doc``: the document ids as little-endian signed 64-bit integers, the least one for
  a document without an id;
* ``manifest``: a Parquet table with a row per part: its number, name, counts, integer width
  and ``base``, the ids in all parts before it.

Parts follow each other in ascending order of document id. Spark's range partitioning deals
documents to parts, each task writes its part under a name of its own, and the names of
those tasks that counted are committed with their counts; what a lost or repeated task left
behind is in no manifest. Bases are prefix sums over the parts' counts, so no task needs to
know another's length beforehand, and no id passes through the driver.

Defined cases: a null text is empty; an empty document is its end id. A document without an
id comes first. Rows that repeat an id are documents of their own, in the order of a hash of
their texts. An empty table gives parts without documents. Extra columns are left out.
"""

import json
import os
import re
import uuid
from itertools import compress
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..plans.physical import fresh_path, shuffle_partitions
from . import words as W
from .storage import stored
from .units import UnitEncoder, flat, gathered

NO_ID = -(1 << 63)
READ_IDS = 1 << 20
#: Text that is encoded at once: a unit is looked up once for all the times it occurs there.
SLICE_BYTES = 4 << 20
#: Letters in every version of Unicode.
_LATIN = re.compile("[A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f]+")
_ENCODERS: dict[str, UnitEncoder] = {}


class _ByteLevel:
    """Many units by few calls of a byte-level tokenizer.

    A unit of letters alone is a single match of the pattern, so the tokenizer's model takes it as
    it is, with its bytes by the names they have in the vocabulary. Other units of printable
    characters are put together to long strings, which the tokenizer cuts again just there: a
    unit with a space in front begins with the only token in it that has one, and units without
    are put on lines of their own, whose breaks are tokens of their own.
    """

    TOGETHER = 4000

    def __init__(self, tokenizer):
        from tokenizers.models import BPE
        from tokenizers.pre_tokenizers import ByteLevel
        self.tokenizer = tokenizer
        vocabulary = tokenizer.get_vocab()
        self.begins = np.zeros(max(vocabulary.values()) + 1, bool)
        self.begins[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True
        self.line_break = vocabulary["\u010a"]
        split, names = tokenizer.pre_tokenizer, ByteLevel(add_prefix_space=False, use_regex=False)
        self.plain_model = (
            isinstance(tokenizer.model, BPE) and not tokenizer.model.dropout and tokenizer.normalizer is None
            and isinstance(split, ByteLevel) and split.use_regex and not split.add_prefix_space)
        self.names = {i: names.pre_tokenize_str(chr(i))[0][0] for i in range(128, 0x250) if _LATIN.match(chr(i))}

    def each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return flat([e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])

    def _each(self, units: list[str], before: str, together, alone) -> tuple[np.ndarray, np.ndarray]:
        word = np.fromiter((self.plain_model and _LATIN.fullmatch(u) is not None for u in units), bool, len(units))
        model, begin, lengths = self.tokenizer.model, *np.zeros((2, len(units)), np.int64)
        words, lengths[word] = flat([
            [t.id for t in model.tokenize(before + (u if u.isascii() else u.translate(self.names)))]
            for u in compress(units, word)])
        others, lengths[~word] = self._many(list(compress(units, ~word)), together, alone)
        for kind in (word, ~word):
            begin[kind] = np.cumsum(lengths[kind]) - lengths[kind]
        begin[~word] += len(words)
        return gathered(np.concatenate([words, others]), begin, lengths), lengths

    def _many(self, units: list[str], together, alone) -> tuple[np.ndarray, np.ndarray]:
        found = []
        for at in range(0, len(units), self.TOGETHER):
            part = units[at:at + self.TOGETHER]
            ids, lengths = together(part) if "".join(part).isprintable() and "" not in part else (None, [])
            # a unit with other white space in it could be cut elsewhere: then one by one
            found.append((ids, lengths) if len(lengths) == len(part) else self.each(alone(part)))
        ids, lengths = zip(*found) if found else ([np.zeros(0, np.int32)], [np.zeros(0, np.int64)])
        return np.concatenate(ids), np.concatenate(lengths)

    def _one(self, text: str) -> np.ndarray:
        return self.each([text])[0]

    def spaced(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        def together(part):
            ids = self._one(" " + " ".join(part))
            return ids, np.diff(np.append(np.flatnonzero(self.begins[ids]), len(ids)))
        return self._each(units, "\u0120", together, lambda part: [" " + u for u in part])

    def plain(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        def together(part):
            ids = self._one("\n".join(part))
            breaks = np.flatnonzero(ids == self.line_break)
            return np.delete(ids, breaks), np.diff(np.concatenate([[-1], breaks, [len(ids)]])) - 1
        return self._each(units, "", together, lambda part: part)


def encoder(path: str) -> UnitEncoder:
    """This process's encoder for a byte-level file of the tokenizers library."""
    if path not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        if (json.loads(tokenizer.to_str()).get("pre_tokenizer") or {}).get("type") != "ByteLevel":
            raise ValueError("units are for byte-level tokenizers only")
        units = _ByteLevel(tokenizer)
        # the library finds these in a text before all else, also across spaces
        added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        _ENCODERS[path] = UnitEncoder(units.each, units.spaced, units.plain, whole=added)
    return _ENCODERS[path]


def forget() -> None:
    """Give the memory of this process's encoders back. They are made anew when needed."""
    _ENCODERS.clear()
    pa.default_memory_pool().release_unused()


def vocabulary_size(path: str) -> int:
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)


def encoded(batch: pa.RecordBatch, path: str, end_id: int | None, text: str = "text"):
    """Slices of a batch, each with the ids of its texts one after the other, and how many each has."""
    encode = encoder(path)
    for part in W.sliced(batch, text, SLICE_BYTES):
        ids, lengths = encode.together(pc.fill_null(part.column(text), ""))
        if end_id is not None:
            ids, lengths = np.insert(ids, np.cumsum(lengths), end_id), lengths + 1
        yield part, ids, lengths


def _opened(folder: str) -> tuple[pafs.FileSystem, str]:
    url = urlparse(folder)
    if url.scheme in ("", "file"):
        return pafs.LocalFileSystem(), url.path
    scheme = {"s3a": "s3", "s3n": "s3"}.get(url.scheme, url.scheme)
    return pafs.FileSystem.from_uri(url._replace(scheme=scheme).geturl())


def _write_part(folder: str, path: str, end_id: int, width: int):
    def run(batches):
        part = TaskContext.get().partitionId()
        fs, root = _opened(folder)
        name = f"part-{part:05d}-{uuid.uuid4().hex}"
        starts, docs, total = [np.zeros(1, np.int64)], [], 0
        fs.create_dir(root, recursive=True)
        with fs.open_output_stream(f"{root}/{name}.bin") as out:
            for batch in batches:
                for rows, ids, lengths in encoded(batch, path, end_id):
                    out.write(ids.astype(f"<u{width}").tobytes())
                    ends = total + np.cumsum(lengths)
                    total = int(ends[-1])
                    starts.append(ends)
                    docs.append(rows.column("doc_id").fill_null(NO_ID).to_numpy())
        offsets = np.concatenate(starts)
        for end, values in (("off", offsets.astype("<u8")),
                            ("doc", np.concatenate(docs).astype("<i8") if docs else offsets[:0])):
            with fs.open_output_stream(f"{root}/{name}.{end}") as out:
                out.write(values.tobytes())
        yield pa.RecordBatch.from_pydict({
            "part": [part], "name": [name], "width": pa.array([width], pa.int32()),
            "n_docs": [len(offsets) - 1], "n_tokens": [total]})
    return run


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write ``doc_id, text`` as a set of token files and return its manifest."""
    spark = docs.sparkSession
    width = 2 if max(vocabulary_size(tokenizer), end_id + 1) <= 1 << 16 else 4
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ranged = rows.repartitionByRange(shuffle_partitions(rows), "doc_id").sortWithinPartitions(
        "doc_id", F.xxhash64("text"))
    parts, _ = stored(ranged.mapInArrow(
        _write_part(folder, tokenizer, end_id, width),
        "part long, name string, width int, n_docs long, n_tokens long"), "token-parts")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).coalesce(1) \
        .write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def mapped(fs: pafs.FileSystem, path: str, dtype: str) -> np.ndarray:
    """A file as an array: memory-mapped if it is local, else read."""
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, dtype, "r") if os.path.getsize(path) else np.zeros(0, dtype)
    with fs.open_input_file(path) as file:
        return np.frombuffer(file.read(), dtype)


def as_bytes(ids: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Runs of ids as little-endian unsigned integers of 4 bytes. Spark copies bytes as they are,
    where it takes arrays apart."""
    data = pa.py_buffer(np.ascontiguousarray(ids.astype("<u4")))
    at = 4 * np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(at), data])


def as_lists(data: pa.Array) -> pa.ListArray:
    """The ids of such bytes."""
    at = np.frombuffer(data.buffers()[1], np.int32)[data.offset:data.offset + len(data) + 1]
    ids = np.frombuffer(data.buffers()[2] or b"", "<u4")[at[0] // 4:at[-1] // 4].astype(np.int32)
    return pa.ListArray.from_arrays((at - at[0]) // 4, ids)


def _read_parts(folder: str):
    def run(batches):
        fs, root = _opened(folder)
        for part in (row for batch in batches for row in batch.to_pylist()):
            where = f"{root}/{part['name']}"
            offsets, docs = mapped(fs, f"{where}.off", "<u8"), mapped(fs, f"{where}.doc", "<i8")
            ids = mapped(fs, f"{where}.bin", f"<u{part['width']}")
            at = 0
            while at < len(docs):  # as many documents as hold about READ_IDS ids
                to = int(np.searchsorted(offsets, offsets[at] + READ_IDS, "right")) - 1
                to = min(max(to, at + 1), len(docs))
                starts = offsets[at:to + 1].astype(np.int64)
                own, lengths = np.asarray(docs[at:to]), np.diff(starts)
                yield pa.RecordBatch.from_arrays([
                    pa.array(own, mask=own == NO_ID), pa.array(starts[:-1] + part["base"]), pa.array(lengths),
                    as_bytes(np.asarray(ids[starts[0]:starts[-1]]), lengths)],
                    names=["doc_id", "start", "n_tokens", "bytes"])
                at = to
    return run


def _listed(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], as_lists(batch.column("bytes"))], names=[*batch.schema.names[:-1], "ids"])


def read_token_files(spark: SparkSession, folder: str, raw: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of each document; ``start`` counts all ids before. With ``raw``
    the ids come as ``bytes``, little-endian unsigned integers of 4 bytes."""
    manifest = spark.read.parquet(f"{folder}/manifest").where("n_docs > 0")
    spread = manifest.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "part")
    kinds = "doc_id long, start long, n_tokens long"
    rows = spread.mapInArrow(_read_parts(folder), kinds + ", bytes binary")
    return rows if raw else rows.mapInArrow(_listed, kinds + ", ids array<int>")


def checksums(files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of what ``read_token_files`` gives as bytes."""
    return files.select("doc_id", "start", "n_tokens", F.crc32("bytes").alias("ids_crc32"))


def fresh_folder(spark: SparkSession) -> str:
    return fresh_path(spark, "token-files")
