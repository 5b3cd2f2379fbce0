"""The audit of sources against plain counting, and its parts."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from crawlcorpus.llm import divergence


def brute(rows, least):
    groups, holders = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", folded)
        groups[lang, source].update(terms)
        holders[lang].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in holders[lang].items() if n >= least]
        own = {s: {t: c[t] for t in kept} for (g, s), c in groups.items() if g == lang}
        own[None] = {t: sum(c[t] for c in own.values()) for t in kept}
        price = {s: {t: 1 + 10**9 * (n + 5) // (sum(c.values()) + 5 * len(kept)) for t, n in c.items()}
                 for s, c in own.items()}
        for s in own:
            if s is None:
                continue
            pairs = [(sum(abs(price[s][t] - price[o][t]) for t in kept), o) for o in own if o not in (s, None)]
            terms = [(price[s][t] - price[None][t], t) for t in kept if own[s][t] and price[s][t] > price[None][t]]
            for part, found in (("pair", pairs), ("term", terms)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, k + 1) for k, (v, item) in enumerate(ranked)
                        if part == "pair" or k < 50]
    return sorted(out)


def corpus(seed, n, terms):
    draw = random.Random(seed)
    vocabulary = [f"w{chr(97 + i % 26)}{'xyzé'[i % 4] * (i // 26 + 1)}" for i in range(terms)] + ["Zoë", "ZOË", "日本"]
    rows = []
    for _ in range(n):
        lang, source = draw.choice(["en", "fi", None, ""]), draw.choice(["a", "b", "c", "Ä", None])
        words = [draw.choice(vocabulary[:draw.choice([5, terms])]) for _ in range(draw.randrange(0, 40))]
        rows.append((lang, source, None if draw.random() < 0.05 else draw.choice([" ", "1", "\x00-\n"]).join(words)))
    return rows + [("de", "alone", "not kept"), ("sv", "a", None), ("sv", "b", "")] + rows[:5]


@pytest.mark.parametrize("block,entries", [(1 << 16, 400_000), (7, 40)])
def test_audit_equals_plain_counting(spark, monkeypatch, block, entries):
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "MIN_DOCUMENTS", 8)
    rows = corpus(1, 300, 150)
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "lang string, source string, text string, term string, n int")
    got = sorted(map(tuple, divergence.audit(docs.repartition(3)).collect()))
    want = brute(rows, 8)
    assert got == want
    assert {r[2] for r in want} == {"pair", "term"} and ("sv", "a", "pair", "b", 0, 1) in want


def test_empty_table(spark):
    docs = spark.createDataFrame([], "lang string, source string, text string")
    assert divergence.audit(docs).collect() == []


def test_task_hands_entries_on(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(divergence, "TASK_TERMS", 3)
    batch = pa.RecordBatch.from_pydict({
        "lang": ["x"] * 4, "source": ["s"] * 4, "text": ["a b", "b c", "b b d", "A"]})
    parts = list(divergence._counted([batch]))
    assert len(parts) > 1
    sums = defaultdict(lambda: [0, 0])
    for row in (r for p in parts for r in p.to_pylist()):
        sums[row["term"]][0] += row["n"]
        sums[row["term"]][1] += row["docs"]
    assert dict(sums) == {"a": [2, 2], "b": [4, 3], "c": [1, 1], "d": [1, 1]}


def test_gallop():
    draw = random.Random(2)
    for _ in range(300):
        a, b = (np.array(sorted(draw.sample(range(n * 3), draw.randrange(n))), np.int64)
                for n in (draw.choice([1, 9, 400]), draw.choice([1, 9, 4000])))
        x, y = divergence.gallop(a, b, step=draw.choice([1, 4, 64]))
        want = sorted(set(a.tolist()) & set(b.tolist()))
        assert a[x].tolist() == b[y].tolist() == want


def test_prices_are_exact():
    draw = random.Random(4)
    for _ in range(200):
        total, kept = draw.randrange(10 ** draw.randrange(1, 17)), draw.randrange(1, 10 ** 7)
        n = [draw.randrange(total + 1) for _ in range(5)]
        assert divergence.prices(np.array(n, np.int64), total, kept).tolist() == [
            1 + 10**9 * (x + 5) // (total + 5 * kept) for x in n]
