"""Sizes, slots and cut groups of shards."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from conftest import SF_DIR
from crawlcorpus.llm import sharding
from crawlcorpus.llm.catalog import QUERIES


def check(found, rows, shards=8):
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text_crc32, r["size"]) for r in found) == sorted(
        (i is None, i or 0, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1) for i, t in rows)
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert set(slots) <= set(range(shards))
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert all(r.law == "rows" and r.grown_shard is None for r in found)


def split_groups(found):
    """Groups of equal text that lie in more shards than their size needs."""
    held = defaultdict(Counter)
    for r in found:
        held[r.text_crc32, r["size"]][r.shard] += 1
    room = len(found) // 8
    return [c for c in held.values() if len(c) > -(-sum(c.values()) // max(room, 1)) + 1 or
            len(c) > 1 and sum(c.values()) < room / 8]


def test_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op8_sharding"](spark, SF_DIR).collect()
    check(found, rows)
    assert not split_groups(found)


def test_hot_group_and_odd_rows(spark):
    rows = [(i, "the same everywhere") for i in range(300)] + [(i, f"text {i % 200}é") for i in range(300, 900)]
    rows += [(None, None), (None, ""), (5000, None), (5001, "x"), (5001, "x")]
    frame = spark.createDataFrame([(i, t, 3, 4) for i, t in rows], "doc_id long, text string, shard int, slot int")
    found = sharding.sharded(frame.repartition(5)).collect()
    check(found, rows)
    assert len(split_groups(found)) <= 8


@pytest.mark.parametrize("n", [0, 1, 7, 8, 9])
def test_few_rows(spark, n):
    rows = [(i, "equal" if i % 2 else str(i)) for i in range(n)]
    check(sharding.sharded(spark.createDataFrame(rows, "doc_id long, text string")).collect(), rows)


def test_quotas():
    draw = np.random.default_rng(1)
    for _ in range(50):
        load = draw.integers(0, 100, 8)
        wanted = draw.integers(0, 40, (8, 8)) * (1 - np.eye(8, dtype=int))
        size = np.full(8, 90)
        flow = sharding.allowed(wanted, load, size) * wanted
        after = load + flow.sum(axis=0) - flow.sum(axis=1)
        assert (after <= np.maximum(size, load) + 1e-6).all() and (flow <= wanted + 1e-9).all()


def test_groups_that_fit_are_whole(spark):
    """Groups of up to a shard's size (500) are in one shard, a larger one in as few as hold it."""
    sizes = {"all of one": 500, "most of one": 450, "half": 250, "a third": 170, "few": 40, "more than two": 1100}
    texts = [t for t, n in sizes.items() for _ in range(n)] + [f"pair {i // 2}" for i in range(600)]
    rows = list(enumerate(texts + [f"single {i}" for i in range(4000 - len(texts))]))
    found = sharding.sharded(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    check(found, rows)
    held, names = defaultdict(Counter), dict(rows)
    for r in found:
        held[names[r.doc_id]][r.shard] += 1
    assert {t: len(held[t]) for t in sizes} == {t: -(-n // 500) for t, n in sizes.items()}


def test_plan():
    draw = np.random.default_rng(2)
    for _ in range(50):
        size = np.array([101, 101, 100, 100])
        groups = {f"g{i}": int(n) for i, n in enumerate(draw.integers(2, 130, 3))}
        parts, room = sharding.plan(groups, size)
        taken = np.zeros(4, int)
        for g, n in groups.items():
            own = sorted((lo, end, s) for x, lo, end, s in parts if x == g)
            assert [lo for lo, _, _ in own] == [0, *(end for _, end, _ in own[:-1])] and own[-1][1] == n
            assert len(own) <= -(-n // 100) + 1
            for lo, end, s in own:
                taken[s] += end - lo
        assert (taken + room == size).all() and (room >= 0).all()
