"""Base counts against a brute-force version, line rules, and odd inputs."""

import re
from collections import Counter

import pytest
from pyspark.sql import Row

from conftest import SF_DIR
from crawlcorpus.llm import quality
from crawlcorpus.llm.catalog import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    grams = list(zip(words, words[1:], words[2:]))
    counts, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if counts[g] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(covered), failed)


def test_counts_of_documents(spark):
    found = QUERIES["op4_quality_rules"](spark, SF_DIR).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert len(found) == len(texts)
    for r in found:
        assert tuple(r)[1:7] == brute(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_odd_rows(spark):
    texts = [None, "", " \n\t ", "a b c a b c a b c " * 30, "x\x1fy\xa0z \x0b\x0c w", "aa " * 7,
             "é à é à é à\nline\nline\n\nline", "é" * 5000, "w " * 20_000, "a b c d a b c"]
    rows = [Row(text=t, doc_id=i, n_words=7, _words="clash") for i, t in enumerate(texts)]
    rows += [Row(text="a b", doc_id=None, n_words=0, _words=None)] * 2
    found = quality.judged(spark.createDataFrame(rows)).collect()
    assert len(found) == len(rows)
    assert [tuple(r)[1:7] for r in sorted(found, key=lambda r: (r.doc_id is None, r.doc_id))] == [
        brute(r.text) for r in rows]


def clashing(spark):
    """Two triples of words with the same hash: the last word of the second follows from the
    seed that the words before it give, as each step of the hash can be undone."""
    full, p1, p2, p5 = 2**64, 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x27D4EB2F165667C5
    turned = lambda x, n: (x << n | x >> (64 - n)) % full
    seeds = [r[0] % full for r in spark.range(3000).selectExpr(
        "xxhash64(concat('a', id), 'b')").collect()]
    mixed = turned(int.from_bytes(b"lastword", "little") * p2 % full, 31) * p1 % full
    for i, seed in enumerate(seeds[1:], 1):
        key = mixed ^ (seeds[0] + p5 + 8) % full ^ (seed + p5 + 8) % full
        key = turned(key * pow(p1, -1, full) % full, 33) * pow(p2, -1, full) % full
        word = key.to_bytes(8, "little")
        if word.isascii() and len(WORD.findall(word.decode())) == 1 and WORD.fullmatch(word.decode()):
            return ["a0", "b", "lastword"], [f"a{i}", "b", word.decode()]


def test_windows_of_equal_hash(spark):
    one, two = clashing(spark)
    frame = spark.createDataFrame([one, two], "a string, b string, c string")
    assert frame.selectExpr("xxhash64(a, b, c)").distinct().count() == 1
    texts = [one + two, one + two + one, one + two + one + two, two + ["x"] + one + ["y", "a", "b", "a", "b", "a", "b"]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    found = quality.judged(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [tuple(r)[1:7] for r in sorted(found)] == [brute(t) for _, t in rows]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert quality.judged(empty).count() == 0
    assert quality.filtered(empty).count() == 0


@pytest.mark.parametrize("line,passes", [
    ("A whole sentence ends here.", True), ('He said "so it is."', True),
    ("No mark at the end", False), ("Home | News | About | Contact.", False),
    ("THE!! HE!! SHE!! IT!!", False), ("Cash$$$ now### free&&& win.***", False),
    ("All rights reserved.", False), ("Is it? Yes!! It is not many.", True)])
def test_lines(spark, line, passes):
    frame = spark.createDataFrame([(line,)], "line string")
    assert frame.select(quality.line_passes(frame["line"])).collect()[0][0] is passes


def test_filter_removes_lines_and_documents(spark):
    good = "\n".join(f"Line{i} {i}holds words{i} of{i} its{i} own{i} here{i}." for i in range(20))
    rows = [(1, good, "en", len(good)), (2, good + "\nHome | News | About", "en", 0),
            (3, good + "\n" + "\n".join(f"Home | {i} | x{i} | y {i}" for i in range(60)), "en", 0)]
    kept = quality.filtered(spark.createDataFrame(rows, "doc_id long, text string, lang string,"
                                                        " n_chars long")).collect()
    assert {r.doc_id: (r.text, r.n_chars) for r in kept} == {1: (good, len(good)),
                                                            2: (good, len(good))}
