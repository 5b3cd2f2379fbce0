"""Trees, edits and likenesses against a brute-force version."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from crawlcorpus.llm import fingerprints
from crawlcorpus.llm.catalog import QUERIES


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaves(line):
    return [sha(x) for x in re.findall(fingerprints.LEAF, line, re.ASCII)]


def tree(text):
    sections = []
    for node in (sha("".join(leaves(line))) for line in text.split("\n")):
        if sections and node[0] not in "01":
            sections[-1].append(node)
        else:
            sections.append([node])
    return [sha(" ".join(s)) for s in sections], sections


def branches(text):
    """Sections as tuples of paragraphs, these as tuples of leaves."""
    lines = [tuple(x[:16] for x in leaves(line)) for line in text.split("\n")]
    return [tuple(lines.pop(0) for _ in section) for section in tree(text)[1]]


def near(a, b):
    if a == b:
        return 1.0
    total = shared = 0
    x, y = branches(a), branches(b)
    for level in range(3):
        both = set(x) & set(y)
        n = sum(1 if level == 2 else len(s) if level == 1 else sum(map(len, s)) for s in both)
        shared += n
        if level == 2:
            total += len(set(x)) + len(set(y)) - 2 * n
        else:
            x, y = ([child for s in set(z) - both for child in s] for z in (x, y))
    total += 2 * shared
    return 2 * shared / total if total else 0.0


def root(text):
    return sha(" ".join(tree(text)[0]))


def edits(rows):
    """(id, text) in descending order to (id, edited text)."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        text, after = text or "", after or ""
        half = len(text) // 2
        yield i, text[:len(text) - half] + after[:half]


def check(found, rows):
    edited, texts = dict(edits(rows)), dict(rows)
    assert len(found) == len(rows)
    for r in found:
        text = texts[r.doc_id] or ""
        assert (r.n_chars, r.edited_sha256) == (len(text), sha(edited[r.doc_id]))
        for printed, own in ((r.fingerprint, text), (r.edited_fingerprint, edited[r.doc_id])):
            assert printed == root(own) + ";" + "|".join(
                ",".join("".join(line) for line in section) for section in branches(own))
        assert r.near_edited == pytest.approx(near(text, edited[r.doc_id]), abs=1e-12)
        assert r.near_next == pytest.approx(near(text, texts[r.next_id] or ""), abs=1e-12)


def test_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op1_document_fingerprints"](spark, SF_DIR).collect()
    check(found, rows)
    texts = dict(rows)  # a text of one leaf has nothing to grade
    assert all(r.near_edited > r.near_next for r in found if len(texts[r.doc_id].split()) >= 24)


def test_odd_rows(spark):
    rows = [(9, None), (3, ""), (4, "é" * 11), (-5, "one line. two\nthree"), (1 << 62, "x"), (-(1 << 63), "  \n\n "),
            (7, "word " * 50_000), (8, "word " * 50_000), (None, "last of all\nthe rest")]
    frame = spark.createDataFrame([(i, t, "k", 1, "h") for i, t in rows],
                                  "doc_id long, text string, key string, half int, head string")
    check(fingerprints.edit_report(frame.repartition(4)).collect(), rows)
    one = fingerprints.edit_report(frame.where("doc_id = -5")).collect()[0]
    assert one.near_next == 1 and one.edited_sha256 == sha("one line. two\nthree"[:10] + "one line. two\nthree"[:9])
    assert fingerprints.edit_report(frame.where("doc_id = 0")).count() == 0


def test_repeated_rows(spark):
    rows = [(1, "a b c"), (1, "a b c"), (1, "other text"), (2, "second")]
    found = fingerprints.edit_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == 4
    assert len({r.edited_sha256 for r in found}) == 3


def test_leaves_cover_the_text(spark):
    texts = ["", " ", "a", " a b\tc. d e f g h i j k l m", "x" * 1000, "A b. C!\n\n D? e " * 40]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    pieces = F.regexp_extract_all("text", F.lit(fingerprints.LEAF), F.lit(0))
    for r in frame.select("text", pieces.alias("pieces")).collect():
        assert "".join(r.pieces) == r.text
        assert all(len(p.split()) <= 8 for p in r.pieces)


def test_a_leaf_ends_with_its_paragraph(spark):
    frame = spark.createDataFrame([("a b\nc d e f g h i j",)], "text string")
    printed = frame.select(fingerprints.tree(F.col("text"))["fingerprint"]).first()[0]
    assert sorted(printed.split(";")[1].replace("|", ",").split(",")) == sorted(
        [sha("a b")[:16], sha("c d e f g h i j")[:16]])


def test_changes_locate_an_edit(spark):
    lines = [f"paragraph {i} of a long document." for i in range(80)]
    edited = list(lines)
    edited[41] = "a changed one."
    frame = spark.createDataFrame([("\n".join(lines), "\n".join(edited))], "a string, b string")
    both = frame.select(fingerprints.tree(F.col("a")).alias("a"), fingerprints.tree(F.col("b")).alias("b"))
    found = both.select(fingerprints.changes(F.col("a"), F.col("b")).alias("c"), "a").first()
    assert found.c.paragraphs == [sha("".join(leaves(lines[41])))]
    assert 1 <= len(found.c.sections) <= 2
    assert ([s.hash for s in found.a.sections], [s.paragraphs for s in found.a.sections]) == tree("\n".join(lines))
