"""Language identification by cross-parsing entropy.

Per language a suffix automaton of labelled text is built. A text is cross-parsed by each: a
phrase is the longest string from here on that the labelled text holds anywhere, then the
next begins. Phrases normalised by ``log(reference size) / text size`` estimate the cross
entropy; the language that needs the fewest wins. The score is a softmax over the phrase
counts per byte, so it is near 1 where one language needs clearly fewer.

Text is lower-cased, and any run of bytes that are no letters becomes one space. Automata work
on UTF-8 bytes as tables of ``states x bytes in use``. Texts are parsed whole: all pieces of ``PIECE``
bytes step through an automaton side by side, and each goes on into the next pieces until a phrase of
its own begins where one of theirs does; from there on both parses are the same. So the phrases
counted are those of one parse from the text's first byte to its last.

The fit is on a bounded sample, whatever the corpus: for each language one document of each of
``SAMPLES`` hash buckets, ``SAMPLE_CHARS`` characters of it at a hashed place, and ``TABLE_BYTES`` for all
automata together (with many languages each gets less text). Labels are used for the sample
alone; a prediction reads nothing but the text.

Defined cases: a text that is null or has no letter is ``und`` with score 0, as is every text
if nothing was learned. Ties go to the language first in order of name. Rows without an id or a
language label are not learned from, but predicted. Repeated rows give repeated results, an
empty table an empty one. Extra columns are left out.
"""

import math

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

SAMPLES, SAMPLE_CHARS = 64, 512
TABLE_BYTES = 64 << 20
PIECE = 1024
SIDE_BY_SIDE = 8192
UNKNOWN = "und"

_NO_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")
_LETTER = regex.compile(r"\p{L}")


def normal(text: str | None) -> bytes:
    """Letters of a text, lower-cased, other runs as one space; empty if there are none."""
    if not text or not _LETTER.search(text):
        return b""
    return f" {_NO_LETTERS.sub(' ', text.lower()).strip()} ".encode()


def automaton(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The suffix automaton of a text: the column of each byte value (or -1), and the table
    ``next state by state and column`` with -1 where there is none. State 0 is the start."""
    size = 2 * len(text) + 2
    link, longest, moves = [-1] * size, [0] * size, [{} for _ in range(size)]
    last, n = 0, 1
    for byte in text:
        new, n = n, n + 1
        longest[new] = longest[last] + 1
        p = last
        while p >= 0 and byte not in moves[p]:
            moves[p][byte] = new
            p = link[p]
        if p < 0:
            link[new] = 0
        else:
            q = moves[p][byte]
            if longest[p] + 1 == longest[q]:
                link[new] = q
            else:
                clone, n = n, n + 1
                longest[clone], moves[clone], link[clone] = longest[p] + 1, dict(moves[q]), link[q]
                while p >= 0 and moves[p].get(byte) == q:
                    moves[p][byte] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    used = sorted(set(text))
    column = np.full(256, -1, np.int64)
    column[used] = np.arange(len(used))
    table = np.full((n, max(len(used), 1)), -1, np.int32)
    for state, m in enumerate(moves[:n]):
        for byte, to in m.items():
            table[state, column[byte]] = to
    return column, table


def _step(model, state, symbol):
    """The next state of each lane after a symbol, and whether a phrase begins with it. A byte the
    reference never has is a phrase of its own."""
    flat, root, width = model
    step = flat[state * width + symbol]
    broken = step < 0
    return np.where(broken, root[symbol], step), broken | (state == 0)


def phrases(model: tuple[np.ndarray, np.ndarray], data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many phrases each text takes. Text ``i`` is ``data[bounds[i]:bounds[i + 1]]``."""
    column, table = model
    width = table.shape[1] + 1  # the last column is for bytes that have none
    wide = np.pad(table, ((0, 0), (0, 1)), constant_values=-1).astype(np.int64)
    model = wide.ravel(), np.maximum(wide[0], 0), width
    symbols = np.where(column < 0, width - 1, column)[data]
    n_pieces = -(-np.diff(bounds) // PIECE)
    first = np.concatenate([[0], np.cumsum(n_pieces)])
    of = np.repeat(np.arange(len(n_pieces)), n_pieces)
    start = bounds[of] + (np.arange(len(of)) - first[of]) * PIECE
    length = np.minimum(PIECE, bounds[of + 1] - start)

    # every piece by itself, those that are longer first
    order = np.argsort(-length, kind="stable")
    live = np.searchsorted(-length[order], -np.arange(PIECE), "left")  # pieces that reach a place
    ordered, begun = np.zeros(len(of), np.int64), np.zeros((PIECE, len(of)), bool)
    at_start = start[order]
    for at in range(PIECE):
        n = live[at]
        if not n:
            break
        ordered[:n], begun[at, :n] = _step(model, ordered[:n], symbols[at_start[:n] + at])
    state, starts = np.empty_like(ordered), np.empty_like(begun)
    state[order], starts[:, order] = ordered, begun

    # and on, until it meets the parse of a later piece at a phrase's beginning
    extra, meets = np.zeros(len(of), np.int64), np.full(len(of), -1, np.int64)
    passed = np.zeros(len(of), np.int64)  # beginnings of the met piece's own before that place
    pos = start + length
    lanes = np.flatnonzero(pos < bounds[of + 1])
    while len(lanes):
        here = pos[lanes]
        piece, place = first[of[lanes]] + (here - bounds[of[lanes]]) // PIECE, (here - bounds[of[lanes]]) % PIECE
        state[lanes], begins = _step(model, state[lanes], symbols[here])
        theirs = starts[place, piece]
        met = begins & theirs
        passed[lanes] = np.where(place == 0, 0, passed[lanes])
        meets[lanes[met]] = piece[met]
        extra[lanes] += begins & ~met
        passed[lanes] += theirs & ~met
        pos[lanes] += 1
        lanes = lanes[~met]
        lanes = lanes[pos[lanes] < bounds[of[lanes] + 1]]

    # one parse per text: from piece to the piece it meets
    own = starts.sum(axis=0) + extra
    count = np.zeros(len(n_pieces), np.int64)
    single = n_pieces == 1
    count[single] = own[first[:-1][single]]
    for i in np.flatnonzero(n_pieces > 1).tolist():
        piece, sum_ = int(first[i]), 0
        while piece >= 0:
            sum_ += int(own[piece])
            after = int(meets[piece])
            sum_ -= int(passed[piece]) if after >= 0 else 0
            piece = after
        count[i] = sum_
    return count


def sample(docs: DataFrame, learn: Column) -> DataFrame:
    """``lang, text`` of the bounded sample: the least hash of each bucket, found by a partial
    aggregate, so a language of any share of the rows stays spread out."""
    rank = F.xxhash64(F.col("doc_id"), F.lit("language sample"))
    rows = docs.where(learn & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    place = F.pmod(F.xxhash64("doc_id", F.lit("language window")), F.length("text") - SAMPLE_CHARS + 1)
    window = F.when(F.length("text") <= SAMPLE_CHARS, F.col("text")).otherwise(
        F.substring("text", (place + 1).cast("int"), F.lit(SAMPLE_CHARS)))
    return rows.groupBy("lang", F.pmod(rank, F.lit(SAMPLES)).alias("bucket")).agg(
        F.min_by(window, F.struct(rank, F.xxhash64("text"))).alias("text"))


def fit(docs: DataFrame, learn: Column | None = None) -> dict[str, bytes]:
    """The reference text of each language. ``learn`` picks rows to learn from."""
    texts: dict[str, list] = {}
    learn = F.lit(True) if learn is None else learn
    for row in sample(docs, learn).orderBy("lang", "bucket").collect():
        texts.setdefault(row.lang, []).append(normal(row.text))
    if not texts:
        return {}
    most = max(256, TABLE_BYTES // (len(texts) * 2 * 4 * 64))  # two states a byte, about 64 columns
    return {lang: b"".join(found)[:most] for lang, found in sorted(texts.items())}


_BUILT: dict[int, tuple[dict, list]] = {}


def _models(references: dict[str, bytes]) -> list:
    """Built once in each process."""
    key = hash(tuple(references.items()))
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = references, [automaton(text) for text in references.values()]
    return _BUILT[key][1]


def _laid_out(texts: list[bytes]):
    """Groups of whole texts of about ``SIDE_BY_SIDE`` pieces, or one longer text: their places in
    the list, their bytes, and where each begins."""
    group, n = [], 0
    for i, text in enumerate(texts):
        if text:
            group.append(i)
            n += -(-len(text) // PIECE)
        if n >= SIDE_BY_SIDE:
            yield _group(texts, group)
            group, n = [], 0
    if group:
        yield _group(texts, group)


def _group(texts, group):
    bounds = np.cumsum([0, *(len(texts[i]) for i in group)])
    return np.array(group), np.frombuffer(b"".join(texts[i] for i in group), np.uint8), bounds


def scores(references: dict[str, bytes], texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The winner of each text (its place in ``references``, -1 for none) and its score."""
    normals = [normal(t) for t in texts]
    sizes = np.array([len(t) for t in normals])
    if not references:
        return np.full(len(texts), -1), np.zeros(len(texts))
    counts = np.zeros((len(references), len(texts)))
    models = _models(references)
    for places, data, bounds in _laid_out(normals):
        for row, model in zip(counts, models):
            row[places] = phrases(model, data, bounds)
    factor = np.array([math.log2(len(t) + 2) for t in references.values()])[:, None]
    bits = counts * factor / np.maximum(sizes, 1)
    best = bits.argmin(axis=0)
    share = 1 / np.exp2((bits.min(axis=0) - bits) * 4).sum(axis=0)
    return np.where(sizes > 0, best, -1), np.where(sizes > 0, share, 0.0)


def predict(docs: DataFrame, references: dict[str, bytes]) -> DataFrame:
    """``doc_id, text`` to ``doc_id, lang_pred, score``."""
    names = [*references, UNKNOWN]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                best, score = scores(references, part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([names[b] for b in best], pa.string()),
                     pa.array(score)], names=["doc_id", "lang_pred", "score"])
    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double")
