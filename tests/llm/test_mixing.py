"""The mix against targets shared by hand, and its copies."""

import random
from fractions import Fraction

import pytest

from crawlcorpus.llm import catalog, mixing

from conftest import SF_DIR


def shared(sizes, weights=(1, 2, 3)):
    """Targets by resharing, round after round."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, targets, open_ = Fraction(sum(sizes.values())), {}, set(order)
    while open_:
        left = total - sum(targets.values())
        over = {s for s in open_ if left * weight[s] / sum(weight[o] for o in open_) > 3 * sizes[s]}
        if not over:
            targets |= {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
            break
        targets |= {s: Fraction(3 * sizes[s]) for s in over}
        open_ -= over
    return targets


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, text string, size string, copies string")


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    draw = random.Random(seed)
    sizes = {s: draw.choice([0, 1, 5, 50, 5000]) for s in [None, "", "A", "a", "é", "z", "\U0001F600", "ﬁ", "b"][:2 + seed * 2]}
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: Fraction(r.share, r.parts) for r in mixing.targets(rows).collect()}
    assert got == shared(sizes)


def test_query(spark):
    rows = [r.asDict() for r in catalog.op13_source_mixing(spark, SF_DIR).collect()]
    again = {tuple(r) for r in catalog.op13_source_mixing(spark, SF_DIR).collect()}
    assert again == {tuple(r.values()) for r in rows}
    assert all(r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0) for r in rows)
    sources = {r.doc_id: r.source for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    of = {}
    for r in rows:
        of.setdefault(sources[r["doc_id"]], []).append(r)
    for found in of.values():
        assert sum(r["size"] for r in found) == found[0]["source_size"]
    want = shared({s: x[0]["source_size"] for s, x in of.items()})
    assert {s: x[0]["target"] for s, x in of.items()} == {s: float(t) for s, t in want.items()}
    for s, found in of.items():  # ten documents to a source here
        assert abs(sum(r["taken"] for r in found) - want[s]) <= max(0.1 * want[s], max(r["size"] for r in found) / 2)


def test_mix_is_what_the_report_says(spark):
    draw = random.Random(9)
    rows = [(i, draw.choice(["a", "b", None]), "w " * draw.randrange(30), "x", str(i)) for i in range(200)]
    rows += [(900, "a", None, None, None), (901, "c", "", None, None), (None, "a", "no id", "x", "y"), rows[0]]
    docs = frame(spark, rows)
    report = {}
    for r in mixing.taken(docs).collect():
        report[r.doc_id] = report.get(r.doc_id, 0) + r.taken
    mix = mixing.mixed(docs)
    assert mix.schema == docs.schema
    found = {}
    for r in mix.collect():
        found[r.doc_id] = found.get(r.doc_id, 0) + len((r.text or "").split())
    assert {i: n for i, n in found.items() if n} == {i: n for i, n in report.items() if n}


def test_many_sources_meet_by_salted_join(spark, monkeypatch):
    rows = [(i, None if i % 3 else f"s{i % 7}", "w " * (i % 11), "x", "y") for i in range(300)]
    docs = frame(spark, rows)
    want = sorted(map(tuple, mixing.taken(docs).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert sorted(map(tuple, mixing.taken(docs).collect())) == want


def test_defined_cases(spark):
    assert mixing.taken(frame(spark, [])).collect() == []
    assert mixing.mixed(frame(spark, [])).collect() == []
    none = mixing.taken(frame(spark, [(1, "a", None, None, None), (2, None, " \n", None, None)])).collect()
    assert sorted(map(tuple, none)) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
