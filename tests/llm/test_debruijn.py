"""Removal of repeated passages against a brute-force version."""

import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from conftest import SF_DIR
from crawlcorpus.llm import debruijn, words
from crawlcorpus.llm.catalog import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, size=50):
    """(id, text) to (id, words, removed, digest of kept words)."""
    big = 1 << 70
    first = {}
    for i, text in rows:
        words, i = WORD.findall(text or ""), big if i is None else i
        for at in range(len(words) - size + 1):
            window = tuple(words[at:at + size])
            first[window] = min(i, first.get(window, big))
    for i, text in rows:
        words, rank = WORD.findall(text or ""), big if i is None else i
        gone = set()
        for at in range(len(words) - size + 1):
            if first[tuple(words[at:at + size])] < rank:
                gone.update(range(at, at + size))
        kept = " ".join(w for j, w in enumerate(words) if j not in gone)
        yield i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()


def in_order(rows):
    return sorted(rows, key=repr)


def test_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet")
            .select("doc_id", "text").collect()]
    found = QUERIES["op9_substring_dedup"](spark, SF_DIR).collect()
    assert in_order(map(tuple, found)) == in_order(brute(rows))


def passages():
    """Documents from a small stock of passages, so that they repeat, overlap and branch."""
    draw = random.Random(5)
    vocabulary = [f"w{i}é" for i in range(400)]
    stock = [" ".join(draw.choices(vocabulary, k=draw.choice([30, 49, 50, 51, 75, 120])))
             for _ in range(12)] + ["same " * 60, "a b " * 40]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(draw.randint(0, 5)):
            words = draw.choice(stock).split()
            lo = draw.choice([0, 0, 0, draw.randint(0, 20)])
            parts.append(" ".join(words[lo:]))
            if draw.random() < 0.5:
                parts.append(" ".join(draw.choices(vocabulary, k=draw.randint(1, 30))))
        rows.append((i * 3 % 61, draw.choice([" ", "\n", " \t"]).join(parts)))
    rows += [(7, None), (100, ""), (101, " \n"), (None, stock[5]), (None, stock[5]), (102, stock[5]),
             (102, stock[5]), (103, "x" * 100_000), (104, stock[3] + " " + stock[3]), (104, stock[3])]
    return rows


def test_small_stock(spark):
    rows = passages()
    frame = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows],
                                  "doc_id long, text string, id int, row int, spans string")
    found = debruijn.repeated_words(frame.repartition(5)).collect()
    assert in_order(map(tuple, found)) == in_order(brute(rows))


def test_paths(spark):
    """Chains of many lengths: every node learns its head and the windows before it."""
    draw, links, want = random.Random(8), [], set()
    for chain, length in enumerate((2, 3, 4, 5, 33, 200)):
        nodes = [1000 * chain + i for i in range(length)]
        draw.shuffle(nodes)
        at = 0
        for a, b in zip(nodes, nodes[1:]):
            links.append((a, b, draw.randint(1, 41)))
            at += links[-1][2]
            want.add((b, nodes[0], at))
    draw.shuffle(links)
    found, _ = debruijn.paths(spark.createDataFrame(links, "a long, b long, width long"))
    assert set(map(tuple, found.collect())) == want
    empty, _ = debruijn.paths(spark.createDataFrame([], "a long, b long, width long"))
    assert empty.count() == 0


def long_passages():
    """Whole and partial copies of long passages, each between words of its own."""
    draw = random.Random(6)
    passages = [[f"p{draw.randrange(5000)}" for _ in range(n)] for n in (70, 400, 900, 3000)]
    rows = []
    for i in range(24):
        own = [f"own{i}x{j}" for j in range(60)]
        passage = passages[i % 4]
        cut = passage[draw.randint(0, len(passage) // 2):] if i >= 16 else passage
        rows.append((50 - i, " ".join(own[:30] + cut + own[30:])))
    return rows + [(60, " ".join(passages[1] + passages[1])), (61, " ".join(passages[1] + ["z"] + passages[1]))]


def test_long_passages_are_few_paths(spark):
    """Each of the three long passages is one path, at four places each."""
    frame = spark.createDataFrame(long_passages()[:16], "doc_id long, text string")
    edges = debruijn._edges(debruijn._scanned(frame))
    # edges over a passage's end differ between documents, so the passage of 70 words has no other
    inner = edges.groupBy("anchor").agg(F.min("id").alias("first"), F.count("*").alias("n"), F.min("edge").alias("e0"),
                                        F.max("edge").alias("e1")).where("n = 4 and e0 = e1").drop("n", "e0", "e1")
    unbranched = edges.join(inner, "anchor")
    runs, _ = debruijn._runs(unbranched, debruijn._links(unbranched))
    found = runs.collect()
    assert len(found) == 12 and len({r.head for r in found}) == 3
    assert sum(r.hi - r.lo for r in found) == unbranched.selectExpr("sum(hi - lo)").first()[0]
    assert unbranched.count() > 10 * len(found)


def test_long_passages(spark):
    rows = long_passages()
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = debruijn.repeated_words(frame.repartition(4)).collect()
    assert in_order(map(tuple, found)) == in_order(brute(rows))


def test_places_that_fail_are_looked_at_window_by_window(spark, monkeypatch):
    rows = long_passages()
    real = debruijn._proofs

    def never_equal(batches):
        for batch in real(batches):
            at = batch.schema.get_field_index("proof")
            yield batch.set_column(at, "proof", batch.column("id"))
    monkeypatch.setattr(debruijn, "_proofs", never_equal)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert in_order(map(tuple, debruijn.repeated_words(frame).collect())) == in_order(brute(rows))


def test_many_equal_rows(spark):
    rows = passages()
    rows += [rows[5]] * 500 + [rows[20]] * 300
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = debruijn.repeated_words(frame.repartition(7)).collect()
    assert in_order(map(tuple, found)) == in_order(brute(rows))


def test_cut_texts_have_the_kept_words(spark):
    rows = [(i, t) for i, t in passages() if i is not None]
    frame = spark.createDataFrame([(i, t, "en", 0) for i, t in rows],
                                  "doc_id long, text string, lang string, n_chars long")
    found = debruijn.removed(frame).collect()
    digests = [(r.doc_id, hashlib.sha256(" ".join(WORD.findall(r.text or "")).encode()).hexdigest())
               for r in found]
    assert in_order(digests) == in_order((i, sha) for i, _, _, sha in brute(rows))
    assert all(r.n_chars == len(r.text) for r in found if r.text is not None)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert debruijn.repeated_words(empty).count() == 0
    assert debruijn.removed(empty).count() == 0


def thue_morse(a, b, n):
    """Two sequences of ``2 ** n`` that sums modulo a power of two cannot tell apart."""
    bits = [bin(i).count("1") % 2 for i in range(2 ** n)]
    return [(a, b)[x] for x in bits], [(b, a)[x] for x in bits]


def test_thue_morse_words(spark):
    x, y = ("".join(w) for w in thue_morse("a", "b", 11))
    others = [f"w{i}" for i in range(60)]
    u, v = thue_morse("left", "right", 11)
    rows = [(1, " ".join([x, *others[:49]])), (2, " ".join([y, *others[:49]])),
            (3, " ".join(others[50:] + u)), (4, " ".join(others[50:] + v))]
    found = debruijn.repeated_words(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert in_order(map(tuple, found)) == in_order(brute(rows))
    assert {r.doc_id: r.n_removed for r in found}[2] == 0


def test_runs_of_any_length_have_two_moduli():
    u, v = thue_morse(7, 11, 12)
    hashes = np.array(u + v, np.uint64)
    starts, ends = np.array([0, len(u), 0]), np.array([len(u), 2 * len(u), len(u)])
    found = words.spans(hashes, starts, ends).tolist()
    assert found[0] == found[2] != found[1]
    assert found[0] == words.spans(hashes[:len(u)], starts[:1], ends[:1])[0]
    assert words.spans(np.array(v + u, np.uint64), starts[1:2], ends[1:2])[0] == found[0]
