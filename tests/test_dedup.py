"""Duplicate search against brute force, with texts that make up a third of all rows."""

import random
import shutil

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from crawlcorpus.operators import dedup as D
from crawlcorpus.plans.catalog import QUERIES
from crawlcorpus.plans.physical import materialize
from crawlcorpus.streaming import dedup as stream
from crawlcorpus.streaming.dedup import DuplicateStream

SCHEMA = "digest string, id string, file_seq int, rec_seq long"


def skewed(n=600, seed=1):
    """Rows in archive order; a third share one text, some ids repeat."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = "hot" if i % 3 == 0 else f"t{rng.randrange(n // 4)}"
        rows.append((text, f"id{rng.randrange(n // 2) if i % 10 == 0 else i + n}",
                     i // 50, i % 50))
    return rows


def brute(rows, first=None):
    first, pairs = {} if first is None else first, []
    for digest, id_, *_ in rows:
        if digest not in first:
            first[digest] = id_
        elif first[digest] != id_:
            pairs.append((id_, first[digest]))
    return sorted(pairs)


def pairs(df):
    return sorted((r.id, r.first_id) for r in df.collect())


@pytest.mark.parametrize("partitions", [1, 7])
def test_skewed_texts(spark, partitions):
    rows = skewed()
    shuffled = rows[:]
    random.Random(2).shuffle(shuffled)
    df = materialize(spark.createDataFrame(shuffled, SCHEMA).repartition(partitions), "t")
    assert pairs(D.find_duplicates(df)) == brute(rows)
    kept = sorted((r.digest, r.id, r.file_seq, r.rec_seq)
                  for r in D.drop_duplicates(df).collect())
    first = {}
    wanted = sorted(r for r in rows if first.setdefault(r[0], r[1]) == r[1])
    assert kept == wanted


@pytest.mark.parametrize("share", [1, 5, 50, 20_000])
def test_any_split_of_hot_and_cold_gives_the_same(spark, share):
    rows = skewed(300)
    df = materialize(spark.createDataFrame(rows, SCHEMA), "t")
    firsts = D.first_seen(df).where("n > 1")
    joined = D.with_first(df, firsts, share)
    assert pairs(joined.where("id <> first_id")) == brute(rows)


def test_hot_side_is_the_only_forced_broadcast(spark):
    """At most one row in ``share`` can be hot, so the broadcast is bounded by it."""
    rows = skewed(900)
    df = materialize(spark.createDataFrame(rows, SCHEMA), "t")
    share = 10
    hot = D.first_seen(df).where(F.col("n") * share > len(rows))
    assert [r.digest for r in hot.collect()] == ["hot"]
    plan = D.find_duplicates(df)._jdf.queryExecution().toString()
    assert "Window" not in plan and "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@settings(max_examples=6, deadline=None, derandomize=True,
          suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("abc"), st.sampled_from("xyz")), max_size=25),
       st.integers(1, 5))
def test_independent_of_partitioning(spark, items, partitions):
    rows = [(d, i, 0, n) for n, (d, i) in enumerate(items)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    assert pairs(D.find_duplicates(df)) == brute(rows)


def test_index(spark):
    rows = skewed(400)
    old, new = rows[:150], rows[150:]
    first = {}
    brute(old, first)
    index = spark.createDataFrame(list(first.items()), "digest string, first_id string")
    later = materialize(spark.createDataFrame(new, SCHEMA), "t")
    settled = materialize(D.against_index(later, index), "s")
    assert pairs(D.duplicates_given(later, settled)) == brute(new, first)
    fresh = {r.digest for r in settled.where("is_new").collect()}
    assert fresh == {r[0] for r in rows} - {r[0] for r in old}


def test_distinct_texts(spark):
    rows = [(*r, 7) for r in skewed(200)]
    df = spark.createDataFrame(rows, SCHEMA + ", n_chars int")
    found = {r.digest: (r.id, r.n_copies) for r in D.distinct_texts(df).collect()}
    wanted = {}
    for digest, id_, *_ in rows:
        first, n = wanted.get(digest, (id_, 0))
        wanted[digest] = (first, n + 1)
    assert found == wanted


def _stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def test_stream_over_runs_equals_one_batch(spark, tmp_path):
    rows, source, base = skewed(240), f"{tmp_path}/in", f"{tmp_path}/base"
    parts = [rows[:100], rows[100:150], rows[150:]]
    index = DuplicateStream(spark, base, spark.createDataFrame([], SCHEMA).schema)
    for n, part in enumerate(parts):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        if n != 1:  # the second run finds two files and makes two batches of them
            index.run(_stream(spark, source))
    assert pairs(index.duplicates()) == brute(rows)
    assert index.duplicates().select("batch").distinct().count() == 3
    index.run(_stream(spark, source))
    assert pairs(index.duplicates()) == brute(rows)


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    rows = skewed(120)
    index = DuplicateStream(spark, f"{tmp_path}/base", spark.createDataFrame([], SCHEMA).schema)
    first, second = (spark.createDataFrame(p, SCHEMA) for p in (rows[:60], rows[60:]))
    index._settle(first, 0)
    index._settle(second, 1)
    index._settle(second, 1)
    index._settle(first, 0)
    index._settle(second, 1)
    assert pairs(index.duplicates()) == brute(rows)


def test_the_index_holds_each_digest_once_and_is_merged(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stream, "MERGE_PARTS", 2)
    rows, base = skewed(160), tmp_path / "base"
    index = DuplicateStream(spark, str(base), spark.createDataFrame([], SCHEMA).schema)
    for n in range(8):
        assert index.add(spark.createDataFrame(rows[n * 20:n * 20 + 20], SCHEMA)) == n
        names = {p.name for p in (base / "index").iterdir()}
        assert len(names) <= 3 and f"batch={n}" in names
        assert not list((base / "work").iterdir())
        digests = [r.digest for r in index._earlier(n + 1).collect()]
        assert sorted(digests) == sorted({r[0] for r in rows[:n * 20 + 20]})
    assert pairs(index.duplicates()) == brute(rows)
    index._settle(spark.createDataFrame(rows[140:], SCHEMA), 7)  # the last one once more
    assert pairs(index.duplicates()) == brute(rows)


def test_a_merge_that_did_not_end_is_not_read(spark, tmp_path, monkeypatch):
    rows, base = skewed(60), tmp_path / "base"
    index = DuplicateStream(spark, str(base), spark.createDataFrame([], SCHEMA).schema)
    for n in range(3):
        index.add(spark.createDataFrame(rows[n * 20:n * 20 + 20], SCHEMA))
    (base / "index/upto=1/_temporary").mkdir(parents=True)
    assert {r.digest for r in index._earlier(3).collect()} == {r[0] for r in rows}
    (base / "index/upto=1/_temporary").rmdir()
    index._earlier(2).write.mode("overwrite").parquet(f"{base}/index/upto=1")  # ended, but nothing was removed yet
    digests = [r.digest for r in index._earlier(3).collect()]
    assert sorted(digests) == sorted({r[0] for r in rows})


def test_nothing_is_found_before_the_first_batch(spark, tmp_path):
    index = DuplicateStream(spark, f"{tmp_path}/base", spark.createDataFrame([], SCHEMA).schema)
    assert index.duplicates().columns == ["batch", "id", "first_id"]
    assert index.duplicates().count() == 0


@pytest.mark.parametrize("files", [0, 1, 5])
def test_a_table_is_streamed_as_one_file_or_as_a_folder_of_files(spark, tmp_path, files):
    rows = [(i, "hot" if i % 3 == 0 else None if i % 7 == 0 else f"t{i % 20}") for i in range(90)]
    docs, where = spark.createDataFrame(rows, "doc_id long, text string"), tmp_path / "documents.parquet"
    docs.repartition(files or 1, "doc_id").write.parquet(f"{tmp_path}/written" if not files else str(where))
    if not files:
        shutil.copy(next((tmp_path / "written").glob("part-*")), where)
    (tmp_path / "other.parquet").mkdir()  # not read, were it even a table
    found = pairs(QUERIES["duplicates_stream"](spark, str(tmp_path)))
    assert found == pairs(QUERIES["duplicates"](spark, str(tmp_path))) and len(found) > 30
