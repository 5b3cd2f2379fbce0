"""Periodic runs of whole texts: maximal stretches of words that repeat with a period.

A run is a stretch with smallest period q, as long as ``max(MIN_WORDS, MIN_REPEATS * q)`` words
at least, that no neighbouring word extends. All of them are found, exactly:

1. Words become numbers. A word that a run holds stands at least three times in it, and each
   group of ``GRAM`` words in it at least twice; so only stretches of such words and groups can hold
   runs, whole with their neighbourhood (``segments``). Most texts have none and end here.
2. Segments are laid one after the other with a separator of its own between each two, about
   ``TREE_WORDS`` words together. Ukkonen's algorithm builds the suffix tree of this sequence
   and of its reversal. Over the Euler tour of each, a table of block minima answers in constant time
   how long the common beginning (end) of two places is.
3. A run's smallest period is the length of a Lyndon root, and such a root is the longest Lyndon word
   from its first place, in the order of the words or in the inverse order. That word ends where the
   next smaller suffix begins; suffix ranks are the order of the tree's leaves. So there are two
   candidates for each place; each is extended to both sides, and what is long enough stays.

Map-only; memory follows the slice of a megabyte, or the longest single text where that is longer.

Defined cases: a null or empty text has no words and no run. Ids are only carried, repeated
rows give repeated results, an empty table an empty one. Extra columns are left out.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .words import sliced

MIN_WORDS = 24
MIN_REPEATS = 3
GRAM = 8
TREE_WORDS = 1 << 16
_BLOCK = 16


@dataclass
class Tree:
    """A suffix tree. Inner nodes come first, the root is 0; then the leaves, in order of the
    places their suffixes begin at. ``depth`` is the length of a node's string; edges lead
    from node times ``width`` plus symbol to a node."""

    depth: np.ndarray
    keys: np.ndarray
    child: np.ndarray
    width: int
    leaves: int


def suffix_tree(text: list[int], width: int) -> Tree:
    """Ukkonen's algorithm. Symbols are below ``width`` and the last one occurs only there.

    An edge's label is read off the text at ``begin``; a leaf's edge grows with the text. While
    the tree is built leaf ``k`` is ``~k``, so that leaves need no more than their beginning.
    """
    begin, end, link, depth, leaf_begin = [0], [0], [0], [0], []
    edges: dict[int, int] = {}
    find, leaf = edges.get, leaf_begin.append
    node = edge = length = pending = leaves = 0  # the active point, and suffixes not yet in the tree
    for i, symbol in enumerate(text):
        pending += 1
        fresh = 0  # an inner node of this phase that still needs its link
        while pending:
            if not length:
                edge = i
            key = node * width + text[edge]
            child = find(key)
            if child is None:
                edges[key] = ~leaves
                if fresh:
                    link[fresh] = node
                    fresh = 0
            else:
                if child < 0:
                    at = leaf_begin[~child] + length
                else:
                    at = begin[child] + length
                    if at >= end[child]:
                        size = end[child] - begin[child]
                        node, edge, length = child, edge + size, length - size
                        continue
                if text[at] == symbol:
                    length += 1
                    if fresh:
                        link[fresh] = node
                    break
                inner = edges[key] = len(depth)
                if child < 0:
                    begin.append(leaf_begin[~child])
                    leaf_begin[~child] = at
                else:
                    begin.append(begin[child])
                    begin[child] = at
                end.append(at)
                link.append(0)
                depth.append(pending - 1)
                edges[inner * width + text[at]] = child
                if fresh:
                    link[fresh] = inner
                fresh = inner
                edges[inner * width + symbol] = ~leaves
            leaf(i)
            leaves += 1
            pending -= 1
            if node:
                node = link[node]
            elif length:
                length, edge = length - 1, i - pending + 1
    keys = np.fromiter(edges.keys(), np.int64, len(edges))
    child = np.fromiter(edges.values(), np.int64, len(edges))
    child[child < 0] = len(depth) + ~child[child < 0]
    return Tree(np.concatenate([depth, np.arange(leaves, 0, -1)]), keys, child, width, leaves)


def _tour(tree: Tree, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes from left to right, each before its children; these in the ``rank`` of symbols.
    Also the parent of each node."""
    n, inner = len(tree.depth), len(tree.depth) - tree.leaves
    above, symbol = np.divmod(tree.keys, tree.width)
    # the last child is taken off first
    order = np.argsort(above * tree.width + (tree.width - 1 - rank[symbol]))
    parent = np.zeros(n, np.int64)
    parent[tree.child] = above
    at = np.searchsorted(above[order], np.arange(inner + 1)).tolist()
    kids = tree.child[order].tolist()
    seen, stack = [], [0]
    pop, see = stack.pop, seen.append
    while stack:
        v = pop()
        see(v)
        if v < inner:
            stack += kids[at[v]:at[v + 1]]
    return np.array(seen), parent


class Lcp:
    """Lengths of common beginnings of suffixes: minima of node depths between two leaves in an
    Euler tour, by prefix and suffix minima of blocks and a sparse table over whole blocks."""

    def __init__(self, tree: Tree, seen: np.ndarray, parent: np.ndarray):
        depth = tree.depth.astype(np.int32)
        tour = np.empty(2 * len(seen), np.int32)  # the tour's return to the parent, then the node
        tour[0::2], tour[1::2] = depth[parent[seen]], depth[seen]
        place = np.empty(len(seen), np.int64)
        place[seen] = 2 * np.arange(len(seen)) + 1
        self.place = place[len(seen) - tree.leaves:]
        padded = np.full(-(-len(tour) // _BLOCK) * _BLOCK, np.iinfo(np.int32).max, np.int32)
        padded[:len(tour)] = tour
        blocks = padded.reshape(-1, _BLOCK)
        self.tour = padded
        self.ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        self.behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        self.table = [blocks.min(axis=1)]
        while len(self.table[-1]) > 1 << (len(self.table) - 1):
            last, step = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(last, np.concatenate([last[step:], last[-step:]])[:len(last)]))
        self.levels = np.stack(self.table)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For pairs of different places."""
        x, y = self.place[a], self.place[b]
        lo, hi = np.minimum(x, y), np.maximum(x, y)
        first, last = lo // _BLOCK, hi // _BLOCK
        out = np.minimum(self.behind[lo], self.ahead[hi])
        inner = last - first - 1
        far = np.flatnonzero(inner > 0)
        if len(far):
            level = np.frexp(inner[far].astype(np.float64))[1] - 1
            left, right = first[far] + 1, last[far] - (1 << level)
            out[far] = np.minimum(out[far], np.minimum(self.levels[level, left], self.levels[level, right]))
        near = np.flatnonzero(inner < 0)  # both in one block: at most ``_BLOCK`` places
        if len(near):
            best, end = self.tour[lo[near]], hi[near]
            for step in range(1, _BLOCK):
                best = np.minimum(best, self.tour[np.minimum(lo[near] + step, end)])
            out[near] = best
        return out.astype(np.int64)


def _next_smaller(rank: list[int]) -> np.ndarray:
    """For each place the next one whose suffix is smaller; the number of places if none is."""
    n = len(rank)
    after = [n] * n
    rank = rank + [-1]
    for i in range(n - 1, -1, -1):
        j, own = i + 1, rank[i]
        while rank[j] > own:
            j = after[j]
        after[i] = j
    return np.array(after)


def segments(ids: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of a text's words that hold all its runs with the words beside them that could
    extend them: words that stand three times and more, in groups that stand twice and more."""
    n = len(ids)
    if n < MIN_WORDS:
        return []
    often = np.bincount(ids)[ids] >= MIN_REPEATS
    if not often.any():
        return []

    def stretches(good: np.ndarray, least: int) -> list[tuple[int, int]]:
        edges = np.flatnonzero(np.diff(np.concatenate([[0], good.view(np.int8), [0]])))
        return [(a, b) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()) if b - a >= least]

    found = stretches(often, MIN_WORDS)
    if not found:
        return []
    # groups of words as numbers; equal groups have equal numbers, whatever else has
    grams, wide = np.zeros(n - GRAM + 1, np.uint64), ids.astype(np.uint64) + np.uint64(1)
    for k in range(GRAM):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + wide[k:n - GRAM + 1 + k]
    starts = np.concatenate([np.arange(a, b - GRAM + 1) for a, b in found])
    order = starts[np.argsort(grams[starts], kind="stable")]
    equal = grams[order[1:]] == grams[order[:-1]]
    twice = np.zeros(n, bool)
    twice[order[1:][equal]] = twice[order[:-1][equal]] = True
    return [(a, b + GRAM - 1) for a, b in stretches(twice, MIN_WORDS - GRAM + 1)]


def runs_of(parts: list[np.ndarray]) -> list[np.ndarray]:
    """Of each part its runs, as rows of start, length and period by start and period."""
    n_parts = len(parts)
    owner = np.repeat(np.arange(n_parts), [len(p) + 1 for p in parts])
    text = np.concatenate([np.concatenate([[k], p + n_parts + 1]) for k, p in enumerate(parts)] + [[n_parts]])
    ends = np.cumsum([len(p) + 1 for p in parts])
    n, width = len(text), int(text.max()) + 1
    marks = np.arange(width) <= n_parts
    tree = suffix_tree(text.tolist(), width)
    upward = np.arange(width)
    seen, parent = _tour(tree, upward)
    ahead = Lcp(tree, seen, parent)
    inner = len(tree.depth) - n
    candidates = []
    for rank, tour in ((upward, seen), (np.where(marks, upward, width + n_parts - upward), None)):
        tour = _tour(tree, rank)[0] if tour is None else tour
        ranks = np.empty(n, np.int64)
        ranks[tour[tour >= inner] - inner] = np.arange(n)
        period = _next_smaller(ranks.tolist()) - np.arange(n)
        first = np.flatnonzero(~marks[text])
        first = first[period[first] * MIN_REPEATS <= ends[owner[first]] - first + period[first]]
        candidates.append(np.stack([first, period[first]]))
    del tree
    i, p = np.unique(np.concatenate(candidates, axis=1), axis=1)
    inside = i + p < ends[owner[i]] if len(i) else np.zeros(0, bool)
    i, p = i[inside], p[inside]
    end = i + p + ahead(i, i + p)
    del ahead
    # a mark that occurs once more, at the end, closes the reversal
    back = suffix_tree([*text[::-1].tolist(), width], width + 1)
    behind = Lcp(back, *_tour(back, np.arange(width + 1)))
    start = i - behind(n - i, n - i - p)
    keep = end - start >= np.maximum(MIN_WORDS, MIN_REPEATS * p)
    rows = np.unique(np.stack([start[keep], end[keep] - start[keep], p[keep]], axis=1), axis=0)
    whose = owner[rows[:, 0]]
    rows[:, 0] -= (ends - [len(p) for p in parts])[whose]
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0], whose))]
    return np.split(rows, np.cumsum(np.bincount(whose, minlength=n_parts))[:-1])


def runs_of_texts(texts: list[np.ndarray]) -> list[np.ndarray]:
    """Runs of each text, given as numbers of its words."""
    found: list[list[np.ndarray]] = [[] for _ in texts]
    waiting, size = [], 0

    def settle():
        for (text, at, _), rows in zip(waiting, runs_of([part for _, _, part in waiting])):
            found[text].append(rows + [at, 0, 0])

    for text, ids in enumerate(texts):
        for a, b in segments(ids):
            if size and size + b - a > TREE_WORDS:
                settle()
                waiting, size = [], 0
            waiting.append((text, a, np.unique(ids[a:b], return_inverse=True)[1]))
            size += b - a
    if waiting:
        settle()
    return [np.concatenate(rows) if rows else np.zeros((0, 3), np.int64) for rows in found]


def _collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that are left when each run keeps its first period, joined by a space."""
    if not len(runs):
        return b" ".join(words)
    steps = np.zeros(len(words) + 1, np.int64)
    np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
    np.add.at(steps, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0).tolist()])


class _Numbers(dict):
    """Words to numbers in order of arrival."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _found(batches):
    for batch in batches:
        for part in sliced(batch):
            # words end at 0x20 and 0x09 to 0x0D, which is what splitting bytes does
            words = [t.encode().split() if t else [] for t in part.column("text").to_pylist()]
            numbers = [np.fromiter(map(_Numbers().__getitem__, own), np.int64, len(own)) for own in words]
            runs = runs_of_texts(numbers)
            rows = np.concatenate(runs)
            structs = pa.StructArray.from_arrays(list(rows.T), fields=list(_RUNS.value_type))
            offsets = np.cumsum([0, *map(len, runs)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), pa.ListArray.from_arrays(offsets, structs).cast(_RUNS),
                pa.array(map(_collapsed, words, runs), pa.binary()).cast(pa.string())],
                names=["doc_id", "runs", "collapsed"])


def runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` to ``doc_id``, all ``runs`` by start and period, and the text
    ``collapsed`` to the first period of each, words joined by one space."""
    return docs.select("doc_id", "text").mapInArrow(
        _found, "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def digests(found: DataFrame) -> DataFrame:
    """The number of runs, the one with the most repeats, and digests of all and of the text."""
    best = F.expr(
        "reduce(runs, cast(null as struct<start: bigint, length: bigint, period: bigint>), (a, r) ->"
        " if(a is null or cast(r.length as decimal(19, 0)) * a.period > cast(a.length as decimal(19, 0)) * r.period, r, a))")
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(
        "", F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` where the ends of a tenth of the texts repeat: for a crc32 ``h`` of the id that ten
    divides, word ``i`` from ``a = (h / 10) mod n`` on becomes word ``a + (i - a) mod p``, where ``p`` is
    one and a whole part of ``(n - a) / (3 + (h / 10) mod 8)``."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = "filter(split(text, '[\\\\x20\\\\x09-\\\\x0D]+'), w -> w <> '')"
    chosen = F.coalesce((h % 10 == 0) & F.col("text").isNotNull(), F.lit(False))
    g = F.floor(h / 10)
    # built from one generator row, so that the words are split once
    rows = docs.select("doc_id", "text", g.alias("_g"), chosen.alias("_chosen")).select(
        "*", F.inline(F.array(F.struct(F.expr(f"if(_chosen, {words}, array())").alias("_w")))))
    rows = rows.withColumn("_n", F.size("_w")).withColumn(
        "_a", F.expr("if(_n > 0, cast(_g % _n as int), 0)")).withColumn(
        "_p", F.expr("cast(1 + (_n - _a) div (3 + _g % 8) as int)"))
    edited = F.expr("concat_ws(' ', slice(_w, 1, _a), transform(sequence(_a, _n - 1),"
                    " i -> get(_w, _a + (i - _a) % _p)))")
    return rows.select("doc_id", F.when(F.col("_n") > 0, edited).otherwise(F.col("text")).alias("text"))
