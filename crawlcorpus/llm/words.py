"""Words of many texts at once, as numpy arrays, inside a task.

A word is a run of UTF-8 bytes other than 0x20 and 0x09 to 0x0D. Texts arrive as Arrow
arrays and are worked on in slices of about a megabyte, so memory follows the slice, or
the longest single text where that is longer.
"""

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

_SOLID = np.ones(256, bool)
_SOLID[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_BYTE_VALUE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE_VALUE_LOWER = _BYTE_VALUE.copy()
_BYTE_VALUE_LOWER[65:91] = _BYTE_VALUE[97:123]
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_GRAM_BASE = 0xD1342543DE82EF95
#: A second modulus for long runs: sums modulo 2**64 are equal for Thue-Morse words of any base.
_PRIME, _PRIME_BASE = 4_294_967_291, 2_718_281_829
#: Longer words are hashed one by one, for the same reason.
LONG_WORD = 64


class _Powers:
    """Powers of an odd number and of its inverse modulo 2**64, as many as were asked for."""

    def __init__(self, base: int):
        self.pair = (base, pow(base, -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 4096)
            factors = np.array(self.pair, np.uint64)[:, None].repeat(size, axis=1)
            factors[:, 0] = 1
            self.up, self.down = np.cumprod(factors, axis=1, dtype=np.uint64)
        return self.up[:n], self.down[:n]


class _PrimePowers:
    """Powers of ``_PRIME_BASE`` and of its inverse modulo ``_PRIME``, as many as were asked for."""

    def __init__(self):
        self.pair = (_PRIME_BASE, pow(_PRIME_BASE, -1, _PRIME))
        self.rows = np.ones((2, 1), np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while self.rows.shape[1] < n:
            size = self.rows.shape[1]
            step = np.array([[pow(base, size, _PRIME)] for base in self.pair], np.uint64)
            self.rows = np.concatenate([self.rows, self.rows * step % np.uint64(_PRIME)], axis=1)
        return self.rows[0, :n], self.rows[1, :n]


_BYTE_POWERS, _GRAM_POWERS, _PRIME_POWERS = _Powers(_BASE), _Powers(_GRAM_BASE), _PrimePowers()


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of the public splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of consecutive texts: byte spans, and where each text's words begin."""

    data: np.ndarray    # bytes of all texts
    offsets: np.ndarray  # of the texts in ``data``, one more than texts
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray   # index of each text's first word, one more than texts

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A 64-bit hash of each word; ``lower`` takes A-Z as a-z."""
        n = len(self.data)
        if not n or not len(self.starts):
            return np.zeros(0, np.uint64)
        up, down = _BYTE_POWERS(n)
        sums = np.zeros(n + 1, np.uint64)
        table = _BYTE_VALUE_LOWER if lower else _BYTE_VALUE
        np.cumsum(table[self.data] * up, out=sums[1:])
        found = mixed((sums[self.ends] - sums[self.starts]) * down[self.starts])
        for i in np.flatnonzero(self.ends - self.starts > LONG_WORD).tolist():
            word = self.data[self.starts[i]:self.ends[i]].tobytes()
            found[i] = int.from_bytes(hashlib.blake2b(word.lower() if lower else word, digest_size=8).digest())
        return found

    def joined(self, text: int, keep: np.ndarray | slice) -> bytes:
        """The kept words of one text (a mask or a range), joined by single spaces."""
        lo, hi = self.first[text], self.first[text + 1]
        data = self.data
        return b" ".join([data[s:e].tobytes() for s, e in
                          zip(self.starts[lo:hi][keep].tolist(), self.ends[lo:hi][keep].tolist())])


def of(texts: pa.Array) -> Words:
    """Words of an Arrow string array; a null is an empty text."""
    filled = pc.fill_null(texts.cast(pa.large_string()), "")
    _, raw_offsets, raw_data = filled.buffers()
    offsets = np.frombuffer(raw_offsets, np.int64)[filled.offset:filled.offset + len(filled) + 1]
    data = (np.frombuffer(raw_data, np.uint8)[offsets[0]:offsets[-1]] if raw_data is not None
            else np.zeros(0, np.uint8))
    offsets = offsets - offsets[0]
    solid = _SOLID[data]
    begins, finishes = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    finishes[:-1] &= ~solid[1:]
    edges = offsets[:-1][np.diff(offsets) > 0]  # a word never runs from one text into the next
    begins[edges] = solid[edges]
    finishes[edges[1:] - 1] = solid[edges[1:] - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each run of ``k`` hashes; those that run into the next text are the
    caller's to leave out."""
    n = len(hashes)
    if n < k:
        return np.zeros(0, np.uint64)
    up, down = _GRAM_POWERS(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * up[:n], out=sums[1:])
    return mixed((sums[k:] - sums[:n - k + 1]) * down[:n - k + 1])


def spans(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each given run of hashes, of any lengths, from sums by both moduli."""
    n, prime = len(hashes), np.uint64(_PRIME)
    up, down = _GRAM_POWERS(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * up[:n], out=sums[1:])
    found = (sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)
    up, down = _PRIME_POWERS(n + 1)
    np.cumsum(hashes % prime * up[:n] % prime, out=sums[1:])
    return mixed(found ^ mixed((sums[ends] - sums[starts]) % prime * down[starts] % prime))


def sliced(batch: pa.RecordBatch, text: str = "text",
           size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part has about ``size`` bytes of text, or one long text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // size
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        if hi > lo:
            yield batch.slice(lo, hi - lo)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
