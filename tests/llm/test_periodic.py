"""Periodic runs against a search over all periods, and the query against its contract."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from conftest import SF_DIR
from crawlcorpus.llm import catalog, periodic


def brute(words):
    """Every maximal stretch of each period, smallest period first."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        at = 0
        while at + q < n:
            if words[at] != words[at + q]:
                at += 1
                continue
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            if end + q - at >= max(24, 3 * q):
                found.setdefault((at, end + q - at), q)
            at = end + 1
    # the same stretch with a multiple of its period was found before
    return sorted((s, length, q) for (s, length), q in found.items())


def found(*texts):
    return [list(map(tuple, rows.tolist())) for rows in periodic.runs_of_texts(
        [np.array(t, np.int64) for t in texts])]


def test_random_texts_equal_brute_force():
    draw, texts = random.Random(5), []
    for _ in range(400):
        text = []
        while len(text) < draw.choice([5, 40, 200]):
            unit = [draw.randrange(draw.choice([1, 2, 3, 9])) for _ in range(draw.randrange(1, 14))]
            if draw.random() < 0.3:
                unit[-1:] = [100 + draw.randrange(50)]
            text += unit * draw.choice([1, 1, 2, 3, 5, 9])
        texts.append(text[:draw.randrange(len(text) + 1)])
    assert found(*texts) == [brute(t) for t in texts]  # many to a tree
    for text in texts[:60]:
        assert found(text) == [brute(text)]


@settings(deadline=None, max_examples=150)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=12), st.integers(1, 12)), max_size=6))
def test_repeated_units_equal_brute_force(units):
    text = [x for unit, times in units for x in unit * times]
    assert found(text) == [brute(text)]


def test_nested_runs_and_fibonacci_words():
    a, b = [0], [0, 1]
    for _ in range(9):
        a, b = b, b + a
    nested = ([0] * 30 + [1]) * 4
    assert found(b, b * 3, nested, [7] * 1000) == [brute(b), brute(b * 3), brute(nested), [(0, 1000, 1)]]


def test_trees_give_common_beginnings():
    draw = random.Random(3)
    for _ in range(30):
        text = [draw.randrange(1, 4) for _ in range(draw.randrange(2, 90))] + [0]
        tree = periodic.suffix_tree(text, 4)
        lcp = periodic.Lcp(tree, *periodic._tour(tree, np.arange(4)))
        a, b = map(np.array, zip(*[(i, j) for i in range(len(text)) for j in range(len(text)) if i != j]))
        want = []
        for i, j in zip(a.tolist(), b.tolist()):
            k = 0
            while max(i, j) + k < len(text) and text[i + k] == text[j + k]:
                k += 1
            want.append(k)
        assert lcp(a, b).tolist() == want


def test_segments_smaller_than_a_tree_are_split_over_trees(monkeypatch):
    monkeypatch.setattr(periodic, "TREE_WORDS", 50)
    texts = [[1, 2] * 20, [3] * 30, [4, 5, 6] * 30]
    assert found(*texts) == [brute(t) for t in texts]


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            digest("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
            digest(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    short = {r.doc_id: r.text for r in rows if len(r.text or "") < 30_000}
    got = {r.doc_id: tuple(r) for r in catalog.op11_periodic_runs(spark, SF_DIR).collect()}
    assert len(got) == len(rows)
    want = [expected(*row) for row in short.items()]
    assert [got[i] for i in short] == want
    assert sum(row[1] > 0 for row in want) >= 10


def test_defined_cases(spark):
    docs = spark.createDataFrame(
        [(1, None, "x"), (2, "", "x"), (3, "a " * 30 + "end", "x"), (3, "a " * 30 + "end", "x"),
         (None, "b\tc\n" * 12, None), (30, "la la" + " la" * 40_000, "x")],
        "doc_id long, text string, runs string")
    got = sorted(map(tuple, periodic.digests(periodic.runs(docs)).collect()), key=repr)
    want = [expected(None, "b\tc\n" * 12)]
    for doc_id, text in ((1, ""), (2, ""), (3, "a " * 30 + "end"), (3, "a " * 30 + "end")):
        row = expected(None, text)
        want.append((doc_id, *row[1:]))
    assert [r for r in got if r[0] != 30] == sorted(want, key=repr)
    assert [r[1:6] for r in got if r[0] == 30] == [(1, 0, 40_002, 1, 40_002_000)]
    assert periodic.digests(periodic.runs(docs.limit(0))).collect() == []


@pytest.mark.parametrize("text", [None, "", "one", "x " * 100, " ".join(map(str, range(500)))])
def test_planted_runs(spark, text):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0] + [1]
    docs = spark.createDataFrame([(i, text) for i in ids], "doc_id long, text string")
    got = {tuple(r) for r in periodic.digests(periodic.runs(periodic.with_planted_runs(docs))).collect()}
    assert got == {expected(i, text) for i in ids}
