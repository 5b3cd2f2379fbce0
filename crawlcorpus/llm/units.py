"""Token ids of whole texts through a cache of units, inside a task.

A byte-level vocabulary of this kind splits a text by a pattern before it merges, and a
single space or line break between two solid characters always begins a new match: white
space is only ever the first part of a match or a match of white space alone. So a text
may be cut there, each distinct unit encoded once by the tokenizer, and the ids put together
again. Where a space or line break touches more white space the whole text goes to the
tokenizer as it is.
"""

import string
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import chain, compress, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A cache with so many units keeps at most half of them, those met most often, so its memory is bounded.
CACHE_UNITS = 400_000

#: White space (in any reading of the term) beside a space or line break, or a NUL, which
#: marks a unit that has no space before it.
_SPACE = (r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}"
          r"\x{3000}]")
_UNSURE = rf"[ \n]{_SPACE}|{_SPACE}[ \n]|\x00"
_MARKS = string.punctuation


def unsure(texts: pa.Array) -> np.ndarray:
    """The texts that must stay whole, as a mask."""
    return pc.match_substring_regex(texts, _UNSURE).to_numpy(zero_copy_only=False)


def cut(texts: pa.Array) -> pa.Array:
    """Lists of the units of texts that may be cut, in order. A unit that begins with NUL
    stands as it is; any other has a space before it, which is left out here."""
    nul, nothing = pa.scalar("\0", texts.type), pa.scalar("", texts.type)
    marked = pc.binary_join_element_wise(nul, pc.replace_substring(texts, "\n", " \0\n \0"), nothing)
    return pc.split_pattern(marked, " ")


def _strings(units: pa.Array) -> list[str]:
    return units.to_numpy(zero_copy_only=False).tolist()


def flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Lists one after the other, and their lengths."""
    lengths = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(chain.from_iterable(ids), np.int32, int(lengths.sum())), lengths


def gathered(ids: np.ndarray, begin: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs of ids that begin at these places, one after the other."""
    ends = np.cumsum(lengths)
    at = np.repeat(begin - ends + lengths, lengths)
    return ids[at + np.arange(len(at))]


Encode = Callable[[list[str]], tuple[np.ndarray, np.ndarray]]


class UnitEncoder:
    """Ids of texts.

    ``encode`` takes strings and gives their ids one after the other, and the number of each.
    ``encode_spaced`` and ``encode_plain`` do so for units, the first of which are given
    without the space before them; by default they are encoded one by one. A text that holds
    one of the strings in ``whole`` is encoded as it is.
    """

    def __init__(self, encode: Encode, encode_spaced: Encode | None = None,
                 encode_plain: Encode | None = None, whole: list[str] = ()):
        self.encode, self.whole = encode, list(whole)
        self.encode_spaced = encode_spaced or (lambda units: encode([" " + u for u in units]))
        self.encode_plain = encode_plain or encode
        self._clear()

    def __getstate__(self):  # the cache stays in its process
        return self.encode, self.encode_spaced, self.encode_plain, self.whole

    def __setstate__(self, state) -> None:
        self.encode, self.encode_spaced, self.encode_plain, self.whole = state
        self._clear()

    def _clear(self) -> None:
        self._index_of([])
        self.begin, self.length, self.uses = (np.zeros(1024, np.int32) for _ in range(3))
        self.flat, self.used = np.zeros(4096, np.int32), 0

    def _index_of(self, units: list[bytes]) -> None:
        """Number the units, and those to come in order of arrival."""
        self.index = defaultdict(count(len(units)).__next__, zip(units, range(len(units))))

    def _shrink(self) -> None:
        """Leave the units met most often, none that was met but once, and count anew."""
        n = len(self.index)
        uses, most = self.uses[:n], min(CACHE_UNITS // 2, n - 1)
        keep = uses >= max(2, int(np.partition(uses, n - 1 - most)[n - 1 - most]) + 1)
        numbers = np.flatnonzero(keep)
        units, ids, lengths = list(compress(self.index, keep)), self._gathered(numbers), self.length[numbers]
        self._clear()
        if len(ids) <= 8 * CACHE_UNITS:
            self._index_of(units)
            self._room(len(units))
            self._stored(np.arange(len(units)), ids, lengths)

    @staticmethod
    def _grown(a: np.ndarray, n: int) -> np.ndarray:
        if len(a) >= n:
            return a
        return np.concatenate([a, np.zeros(max(n, 2 * len(a)) - len(a), a.dtype)])

    def _room(self, n: int) -> None:
        self.begin, self.length, self.uses = (self._grown(x, n) for x in (self.begin, self.length, self.uses))

    def _stored(self, numbers: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.flat = self._grown(self.flat, self.used + len(ids))
        self.length[numbers] = lengths
        self.begin[numbers] = self.used + np.cumsum(lengths) - lengths
        self.flat[self.used:self.used + len(ids)] = ids
        self.used += len(ids)

    def _numbers(self, units: pa.Array) -> np.ndarray:
        """The numbers of distinct units, of which new ones are encoded."""
        known, keys = len(self.index), units.cast(pa.large_binary()).to_numpy(zero_copy_only=False)
        numbers = np.fromiter(map(self.index.__getitem__, keys), np.int64, len(keys))
        if len(self.index) > known:
            self._learn(units.filter(pa.array(numbers >= known)))
        return numbers

    def _learn(self, new: pa.Array) -> None:
        """Encode the units that the index took up last.

        A mark of ASCII after a letter begins a new match, so a unit that ends in marks is the
        unit before them and the marks.
        """
        at = len(self.index) - len(new)
        bases = pc.utf8_rtrim(new, _MARKS)
        sizes = pc.binary_length(bases).to_numpy()
        last = pc.utf8_slice_codeunits(bases, -1).dictionary_encode()
        letter = np.array([c.isalpha() for c in last.dictionary.to_pylist()], bool)[last.indices.to_numpy()]
        two = letter & (sizes < pc.binary_length(new).to_numpy())
        plain = pc.starts_with(new, "\0").to_numpy(zero_copy_only=False) & ~two
        spaced = ~(plain | two)
        self._room(len(self.index))
        self._stored(at + np.flatnonzero(spaced), *self.encode_spaced(_strings(new.filter(pa.array(spaced)))))
        self._stored(at + np.flatnonzero(plain), *self.encode_plain(
            _strings(pc.utf8_slice_codeunits(new.filter(pa.array(plain)), 1))))
        if not two.any():
            return
        kept, whole = pa.array(two), new.cast(pa.large_binary())
        marks = [b"\0" + u[n:] for u, n in zip(whole.filter(kept).to_numpy(zero_copy_only=False), sizes[two].tolist())]
        parts = pa.concat_arrays([bases.filter(kept), pa.array(marks, pa.large_binary()).cast(new.type)])
        parts = parts.dictionary_encode()  # none of these ends in marks after a letter
        of = self._numbers(parts.dictionary)[parts.indices.to_numpy()].reshape(2, -1).T.ravel()
        self._stored(at + np.flatnonzero(two), self._gathered(of), self.length[of].reshape(-1, 2).sum(axis=1))

    def _gathered(self, numbers: np.ndarray) -> np.ndarray:
        return gathered(self.flat, self.begin[numbers], self.length[numbers])

    def together(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, as int32, and how many each has."""
        if len(self.index) > CACHE_UNITS or self.used > 16 * CACHE_UNITS:
            self._shrink()
        # 64-bit offsets, for line breaks grow when they are marked
        texts = (texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())).cast(pa.large_string())
        own = unsure(texts)
        for x in self.whole:
            own = own | pc.match_substring(texts, x).to_numpy(zero_copy_only=False)
        found = cut(texts.filter(pa.array(~own)))
        units = found.flatten().dictionary_encode()
        numbers, met = self._numbers(units.dictionary), units.indices.to_numpy()
        self.uses[numbers] += np.bincount(met, minlength=len(numbers)).astype(np.int32)
        numbers = numbers[met]
        ids = self._gathered(numbers)
        lengths = np.diff(np.concatenate([[0], np.cumsum(self.length[numbers])])[found.offsets.to_numpy()])
        if not own.any():
            return ids, lengths
        whole, counts = self.encode(_strings(texts.filter(pa.array(own))))
        parts = [iter(np.split(x, np.cumsum(n)[:-1])) for x, n in ((ids, lengths), (whole, counts))]
        each = [next(parts[x]) for x in own.tolist()]
        return np.concatenate(each), np.fromiter(map(len, each), np.int64, len(each))

    def __call__(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text, as int32 arrays, in order."""
        ids, lengths = self.together(texts)
        yield from np.split(ids, np.cumsum(lengths)[:-1]) if len(texts) else ()
