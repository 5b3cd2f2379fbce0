"""Byte-level BPE from a rank file: encoding and decoding.

A text is split by a pattern, and each match that is not itself in the vocabulary merges on
its own. The merge keeps the match as a linked list of parts and a queue of its adjacent
pairs by rank: a bucket of list positions for each rank that occurs, and a bitmap over ranks
in two levels, where the lower has a word for 64 ranks and the upper a bit for each word that
is not zero. Find-first-set on both gives the least rank; the leftmost position of its bucket
merges. A merge changes the ranks of the two pairs beside it, whose old entries stay in their
buckets and are skipped when they come up. So a match of n bytes takes n log n steps, also
where it is a single run of a million letters.

Matches of up to ``SHORT`` bytes share one list and one queue, and each bucket merges the
leftmost position of every match in it at once. Equal units of text are encoded once for each
filling of a bounded cache (``units``).

Defined cases: a null text is empty and has no ids; decoding it gives no bytes. Ids of rows
are only carried, repeated rows give repeated results, an empty table an empty result. Extra
columns are left out.
"""

import base64
import hashlib
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import words as W
from .units import UnitEncoder, flat

#: Matches of up to so many bytes merge side by side, longer ones each for itself.
SHORT = 64
#: Bytes of text that are encoded at once: enough for many new matches to share a rank.
SLICE_BYTES = 8 << 20
_KNOWN: dict[tuple[str, str], "BytePairs"] = {}


class RankQueue:
    """Buckets by rank, and which ranks have one: a bit for each rank in words of 64, and a
    bit for each word that is not zero. Find-first-set on both gives the least rank."""

    def __init__(self, n_ranks: int):
        self.lower = [0] * (n_ranks // 64 + 1)
        self.upper = 0
        self.buckets: dict[int, list] = {}

    def bucket(self, rank: int) -> list:
        """The bucket of a rank, made if there is none."""
        found = self.buckets.get(rank)
        if found is None:
            found = self.buckets[rank] = []
            self.lower[rank >> 6] |= 1 << (rank & 63)
            self.upper |= 1 << (rank >> 6)
        return found

    def least(self) -> int | None:
        if not self.upper:
            return None
        word = (self.upper & -self.upper).bit_length() - 1
        bits = self.lower[word]
        return (word << 6) + (bits & -bits).bit_length() - 1

    def drop(self, rank: int) -> None:
        del self.buckets[rank]
        self.lower[rank >> 6] ^= 1 << (rank & 63)
        if not self.lower[rank >> 6]:
            self.upper ^= 1 << (rank >> 6)


class BytePairs:
    """A vocabulary of byte strings and their ranks, which are the ids."""

    def __init__(self, path: str, pattern: str):
        import regex
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.matches = regex.compile(pattern).findall
        self.n_ids = max(self.ranks.values()) + 1
        self.queue = RankQueue(self.n_ids)
        self.bytes = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        # what two ids merge to, as one sorted list of both ids in one number
        made = sorted((self._key(self.ranks[t[:i]], self.ranks[t[i:]]), rank)
                      for t, rank in self.ranks.items() for i in range(1, len(t))
                      if t[:i] in self.ranks and t[i:] in self.ranks)
        self.pair_keys, self.pair_ranks = (np.array(x, np.int64) for x in zip(*made))
        self.encode = UnitEncoder(self.encode_units)
        self._flat = None

    def _key(self, a, b):
        return a * (self.n_ids + 1) + b

    def _merge_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of two adjacent ids, -1 where they do not merge."""
        key = self._key(a, b)
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], -1)

    def merged(self, piece: bytes) -> list[int]:
        """The ids of one match, by a queue of its own positions."""
        ranks, queue = self.ranks, self.queue
        n, rank_of = len(piece), ranks.get
        end, before = list(range(1, n + 1)), list(range(-1, n))  # of the part that begins here
        pair = [-1] * n  # the rank of the part that begins here with the next, or -1

        def paired(i: int) -> None:
            rank = rank_of(piece[i:end[end[i]]]) if end[i] < n else None
            pair[i] = -1 if rank is None else rank
            if rank is not None:
                heappush(queue.bucket(rank), i)
        for i in range(n):
            paired(i)
        while (rank := queue.least()) is not None:
            bucket = queue.buckets[rank]
            i = heappop(bucket)
            if not bucket:
                queue.drop(rank)
            if pair[i] != rank:
                continue  # stale: this pair has changed or is gone
            j = end[i]
            end[i], pair[j] = end[j], -1
            if end[i] < n:
                before[end[i]] = i
            paired(i)
            if before[i] >= 0:
                paired(before[i])
        ids, i = [], 0
        while i < n:
            ids.append(ranks[piece[i:end[i]]])
            i = end[i]
        return ids

    def merged_together(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of many matches, and how many each has, by one queue for all positions.

        Of the least rank's bucket the leftmost position of each match merges; a match's own
        merges so come in the order they would come in alone. Positions are byte places in all
        matches together; the last place stands for an end.
        """
        data = np.frombuffer(b"".join(pieces), np.uint8)
        n, sizes = len(data), np.array([len(p) for p in pieces])
        of = np.repeat(np.arange(len(pieces)), sizes)
        ids = np.append(self.bytes[data], self.n_ids)
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        ends = np.cumsum(sizes)
        after[ends - 1], before[ends - sizes] = n, n
        pair, gone, queue = np.full(n + 1, -1), np.zeros(n + 1, bool), self.queue

        def paired(places: np.ndarray) -> None:
            rank = self._merge_rank(ids[places], ids[after[places]])
            pair[places] = rank
            places, rank = places[rank >= 0], rank[rank >= 0]
            if len(places):
                order = np.argsort(rank, kind="stable")
                places, rank = places[order], rank[order]
                cuts = [0, *(np.flatnonzero(rank[1:] != rank[:-1]) + 1).tolist(), len(rank)]
                for a, b in zip(cuts[:-1], cuts[1:]):
                    queue.bucket(int(rank[a])).append(places[a:b])
        paired(np.arange(n))
        while (rank := queue.least()) is not None:
            held = queue.buckets[rank]
            places = held[0] if len(held) == 1 else np.concatenate(held)
            queue.drop(rank)
            places = places[pair[places] == rank]  # others are stale
            if not len(places):
                continue
            if len(places) > 1:
                places = np.sort(places)
                leftmost = np.append(True, of[places[1:]] != of[places[:-1]])
                if not leftmost.all():
                    queue.bucket(rank).append(places[~leftmost])
                    places = places[leftmost]
            second = after[places]
            third = after[second]
            after[places], ids[places], gone[second], pair[second] = third, rank, True, -1
            before[third] = places
            left = before[places]
            paired(np.concatenate([places, left[left < n]]))
        kept = ~gone[:n]
        return ids[:n][kept].astype(np.int32), np.bincount(of[kept], minlength=len(pieces))

    def encode_matches(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct matches one after the other, and how many each has."""
        out: list = [None] * len(pieces)
        short = []
        for i, piece in enumerate(pieces):
            rank = self.ranks.get(piece)
            if rank is not None:
                out[i] = [rank]
            elif len(piece) <= SHORT:
                short.append(i)
            else:
                out[i] = self.merged(piece)
        if short:
            ids, lengths = self.merged_together([pieces[i] for i in short])
            ids, ends = ids.tolist(), np.cumsum(lengths).tolist()
            for i, a, b in zip(short, [0, *ends], ends):
                out[i] = ids[a:b]
        return flat(out)

    def encode_units(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        index: dict[str, int] = {}
        numbers, counts = [], []
        for text in texts:
            found = self.matches(text)
            counts.append(len(found))
            numbers += [index.setdefault(match, len(index)) for match in found]
        ids, lengths = self.encode_matches([match.encode() for match in index])
        numbers = np.array(numbers, np.int64)
        each = lengths[numbers]
        ends = np.cumsum(each)
        total = np.append(0, ends)[np.cumsum(counts, dtype=np.int64)] if counts else np.zeros(0, np.int64)
        shift = np.repeat((np.cumsum(lengths) - lengths)[numbers] - ends + each, each)
        return ids[shift + np.arange(len(shift))], np.diff(total, prepend=0)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes that ids stand for, as an array."""
        if self._flat is None:
            parts = [b""] * self.n_ids
            for part, rank in self.ranks.items():
                parts[rank] = part
            self._length = np.array([len(p) for p in parts], np.int64)
            self._begin = np.cumsum(self._length) - self._length
            self._flat = np.frombuffer(b"".join(parts), np.uint8)
        lengths = self._length[ids]
        ends = np.cumsum(lengths)
        shift = np.repeat(self._begin[ids] - ends + lengths, lengths)
        return self._flat[shift + np.arange(len(shift))]


def byte_pairs(path: str, pattern: str) -> BytePairs:
    """This process's vocabulary of a rank file."""
    if (path, pattern) not in _KNOWN:
        _KNOWN[path, pattern] = BytePairs(path, pattern)
    return _KNOWN[path, pattern]


def encode(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``doc_id, text`` to ``doc_id, ids``."""
    def run(batches):
        pairs = byte_pairs(ranks, pattern)
        for batch in batches:
            for part in W.sliced(batch, size=SLICE_BYTES):
                found = list(pairs.encode([t or "" for t in part.column("text").to_pylist()]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), _lists(found)], names=["doc_id", "ids"])
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays).astype(np.int32)))


def decode(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``doc_id, ids`` to ``doc_id, bytes``."""
    def run(batches):
        pairs = byte_pairs(ranks, pattern)
        for batch in batches:
            for ids, rows in _id_slices(batch):
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array([pairs.decode(x).tobytes() for x in ids], pa.binary())],
                    names=["doc_id", "bytes"])
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary")


def _id_slices(batch: pa.RecordBatch, rows: int = 256):
    for at in range(0, batch.num_rows, rows):
        part = batch.slice(at, rows)
        lists = part.column("ids")
        flat = lists.flatten().to_numpy()
        offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        yield [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:])], part


def digests(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``doc_id, ids`` to ``doc_id, n_tokens, ids_sha256, decoded_sha256``."""
    def run(batches):
        pairs = byte_pairs(ranks, pattern)
        name = [str(i) for i in range(pairs.n_ids)].__getitem__
        for batch in batches:
            n, own, back = [], [], []
            for ids, _ in _id_slices(batch):
                for x in ids:
                    n.append(len(x))
                    own.append(hashlib.sha256(" ".join(map(name, x.tolist())).encode()).hexdigest())
                    back.append(hashlib.sha256(pairs.decode(x)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(own, pa.string()),
                 pa.array(back, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return encoded.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
