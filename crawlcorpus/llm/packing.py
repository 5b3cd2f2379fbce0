"""Best-fit packing of documents into sequences of a fixed number of tokens.

1. Documents become token ids and an end id; those longer than a sequence are cut into whole
   ones, where the first piece takes what is over.
2. The plan is made over counts: how many pieces there are of each length, at most
   ``capacity`` numbers whatever the corpus. Lengths go from long to short, each to the open
   sequences with the least room that holds it (best fit, decreasing), all sequences of one
   kind at once. The plan is a list of slots ``(length, first rank, sequence, offset)``.
3. Pieces are numbered within their length and take the slot that has their number. Tasks number
   them as they make them, each for itself; pieces of one length in one task are counted, and
   moved by the counts of the tasks before. That needs a row for each task and length, which the pieces
   meet by broadcast if these are few (counted), so the ids stay where they are, else by a join.
   A length that a third of all rows share is spread over all tasks.

Defined cases: a null text is empty, and a piece of just the end id. Rows that repeat others
are packed as often as they come. Ids are only carried. An empty table gives an empty plan
and result. Extra columns are left out.
"""

from bisect import bisect_left, insort
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ..plans.physical import broadcast_if_small
from . import tokens as T
from .storage import stored

CAPACITY = 2048
PIECES = "doc_id long, piece int, start long, length long"
PLACED = PIECES + ", sequence_id long, offset long"
#: Rows of counts by task and length that are broadcast.
BROADCAST_COUNTS = 200_000


@dataclass(frozen=True)
class Slot:
    """``count`` pieces of one length from number ``rank`` on, ``each`` to a sequence from
    number ``sequence`` on, the first at ``offset``."""

    length: int
    rank: int
    count: int
    each: int
    sequence: int
    offset: int


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Slot]:
    """Best fit, decreasing, over the number of pieces of each length."""
    slots: list[Slot] = []
    rooms: list[int] = []                        # room left, ascending
    open_: dict[int, list[tuple[int, int]]] = {}  # room: (first sequence, sequences)
    sequences = 0

    def opened(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in open_:
                open_[room] = []
                insort(rooms, room)
            open_[room].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, n = open_[room].pop()
                if not open_[room]:
                    del open_[room], rooms[at]
            else:
                room, first = capacity, sequences
                n = -(-left // (capacity // length))
                sequences += n
            each = room // length
            full, over = min(n, left // each), 0
            if full:
                slots.append(Slot(length, rank, full * each, each, first, capacity - room))
                rank, left = rank + full * each, left - full * each
                opened(room - each * length, first, full)
            if full < n and left:  # fewer pieces are left than one more sequence takes
                over = left
                slots.append(Slot(length, rank, over, over, first + full, capacity - room))
                opened(room - over * length, first + full, 1)
                left = 0
            opened(room, first + full + bool(over), n - full - bool(over))
    return slots


def _pieces(path: str, end_id: int, capacity: int, keep_cache: bool):
    def run(batches):
        try:
            yield from cut(batches)
        finally:
            if not keep_cache:
                T.forget()

    def cut(batches):
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for rows, ids, lengths in T.encoded(batch, path, end_id):
                n = np.maximum(-(-lengths // capacity), 1)
                of = np.repeat(np.arange(len(n)), n)
                first = (lengths - capacity * (n - 1))[of]
                piece = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
                length = np.where(piece, capacity, first)
                yield pa.RecordBatch.from_arrays([
                    rows.column("doc_id").take(pa.array(of)), pa.array(piece, pa.int32()),
                    pa.array(np.where(piece, first + capacity * (piece - 1), 0)), pa.array(length),
                    pa.array(np.full(len(of), part, np.int64)), pa.array(_within(length, seen)),
                    T.as_bytes(ids, length)], names=["doc_id", "piece", "start", "length", "part", "within", "bytes"])
    return run


def _within(lengths: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Number the pieces of each length from ``seen[length]`` on, and count them there."""
    order = np.argsort(lengths, kind="stable")
    ordered = lengths[order]
    out = np.empty(len(lengths), np.int64)
    out[order] = seen[ordered] + np.arange(len(ordered)) - np.searchsorted(ordered, ordered)
    np.add.at(seen, lengths, 1)
    return out


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY,
           keep_cache: bool = True) -> DataFrame:
    """``doc_id, text`` to one row for each piece with the bytes of its ids, its task and its number among
    the pieces of its length there.

    Python workers keep their cache of encoded units for the next task, which is faster; a
    job with other stages to come may want the memory back instead.
    """
    return docs.select("doc_id", "text").mapInArrow(
        _pieces(tokenizer, end_id, capacity, keep_cache),
        PIECES + ", part long, within long, bytes binary")


def with_rank(rows: DataFrame) -> DataFrame:
    """Number the rows of each length from 0, as ``rank``. ``rows`` is a stored table."""
    counts = rows.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases, _ = stored(counts.select(
        "length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "bases")
    bases, _ = broadcast_if_small(bases, BROADCAST_COUNTS)
    return rows.join(bases, ["length", "part"]).withColumn("rank", F.col("base") + F.col("within")).drop(
        "part", "base", "within")


def placed(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY,
           keep_cache: bool = True) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``, every one with a place of its own, and with the
    ``bytes`` of their ids, as little-endian unsigned integers of 4 bytes."""
    spark = docs.sparkSession
    rows, _ = stored(pieces(docs, tokenizer, end_id, capacity, keep_cache), "pieces")
    counts = {r.length: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = spark.createDataFrame(
        [(s.length, s.rank, s.rank + s.count, s.each, s.sequence, s.offset)
         for s in plan(counts, capacity)],
        "length long, lo long, hi long, each long, sequence long, at long")
    # the plan has at most a few slots for each of ``capacity`` lengths
    found = with_rank(rows).join(F.broadcast(slots), "length").where("rank >= lo and rank < hi")
    nth = F.col("rank") - F.col("lo")
    return found.select(
        "doc_id", "piece", "start", "length", F.expr("sequence + (rank - lo) div each").alias("sequence_id"),
        (F.col("at") + nth % F.col("each") * F.col("length")).alias("offset"), "bytes")


def _read(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], T.as_lists(batch.column("bytes"))], names=[*batch.schema.names[:-1], "ids"])


def packed(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY,
           with_ids: bool = False, keep_cache: bool = True) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``, and their ``ids`` if asked for."""
    rows = placed(docs, tokenizer, end_id, capacity, keep_cache)
    if not with_ids:
        return rows.drop("bytes")
    return rows.mapInArrow(_read, PLACED + ", ids array<int>")


def checksums(placed: DataFrame) -> DataFrame:
    """What ``placed`` gives, with ``ids_crc32`` of the ids' bytes in their place."""
    return placed.withColumn("ids_crc32", F.crc32("bytes")).drop("bytes")
