"""Stages of the pipeline against brute force, and that one leads into the next."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_DIR
from test_debruijn import brute as repeated
from test_minhash import brute as near
from crawlcorpus.llm import packing, quality
from crawlcorpus.llm.catalog import TOKENIZER

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def stages(spark):
    """The documents before and after each stage, by its name."""
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs, _ = corpus_pipeline.stored(stage(spark, before, SF_DIR), "test-stage")
        out[name] = before, docs
    return out


def _texts(frame):
    return {r.doc_id: r.text for r in frame.collect()}


def test_columns(stages):
    for name, (before, after) in list(stages.items())[:-1]:
        assert after.dtypes == before.dtypes, name
        assert after.where("n_chars <> length(text)").count() == 0


def test_quality(spark, stages):
    before, after = stages["quality rules"]
    kept = {r.doc_id for r in quality.judged(before).where("kept").collect()}
    assert set(_texts(after)) == kept
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").where("quality = 0").select("doc_id")
    assert after.join(labels, "doc_id").count() == 0


def test_toxicity(spark, stages):
    before, after = map(_texts, stages["toxicity"])
    assert all(before[i] == t for i, t in after.items())
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    lost = [i for i in before if i not in after]
    assert all(toxic.get(i, 1) for i in lost)


def test_near_duplicates(stages):
    before, after = map(_texts, stages["near dedup"])
    groups = near(list(before.items()), 5, 80)
    assert set(after) == {i for i, (_, component) in groups.items() if i == component}
    assert all(before[i] == t for i, t in after.items())


def test_substrings(stages):
    before, after = map(_texts, stages["substring dedup"])
    want = {i: sha for i, _, _, sha in repeated(list(before.items()))}
    assert {i: hashlib.sha256(" ".join(WORD.findall(t)).encode()).hexdigest() for i, t in after.items()} == want


def test_packing(stages):
    before, after = stages["packing"]
    assert {r.doc_id for r in after.select("doc_id").distinct().collect()} == set(_texts(before))
    sums = after.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert sums.where("n <> end or n > 2048").count() == 0


def test_packed_ids_are_of_the_texts(stages):
    before, after = stages["packing"]
    tokenizer, found = Tokenizer.from_file(TOKENIZER), {}
    for r in sorted(after.collect(), key=lambda r: (r.doc_id, r.start)):
        assert len(r.ids) == r.length
        found.setdefault(r.doc_id, []).extend(r.ids)
    assert found == {i: tokenizer.encode(t, add_special_tokens=False).ids + [0] for i, t in _texts(before).items()}


def test_checksums_are_of_the_packed_ids(stages):
    before, after = stages["packing"]
    own = {(r.doc_id, r.piece): zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in after.collect()}
    found = packing.checksums(packing.placed(before, TOKENIZER)).collect()
    assert {(r.doc_id, r.piece): r.ids_crc32 for r in found} == own


def test_run(spark, stages):
    found = corpus_pipeline.run(spark, SF_DIR)
    assert found.drop("sequence_id", "offset").exceptAll(
        stages["packing"][1].drop("sequence_id", "offset")).count() == 0
    assert found.count() == stages["packing"][1].count()


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        assert docs.count() == 0
