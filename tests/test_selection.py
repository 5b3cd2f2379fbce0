import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from crawlcorpus.functions import headers as H
from crawlcorpus.operators import boilerplate as B, extraction as E, manifest as MF
from crawlcorpus.operators import sampling as S, selection as SEL
from crawlcorpus.plans import physical
from crawlcorpus.plans.tables import labelled_ids, page_records
from crawlcorpus.sources import lists, sinks
from crawlcorpus.streaming.resume import process_new

from archives import ordinary, write


def test_id_lists(spark, tmp_path):
    (tmp_path / "ids").write_text(" a \nb\na\n")
    ids = lists.id_list(spark, f"{tmp_path}/ids")
    assert [(r.id, r.n) for r in SEL.repeated_ids(ids).collect()] == [("a", 2)]
    assert {r.id for r in SEL.distinct_ids(ids).collect()} == {"a", "b"}
    assert [r.id for r in lists.inline_ids(spark, "x,y").collect()] == ["x", "y"]


def test_long_list_joins_without_broadcast(spark):
    records, ids = page_records(spark, SF_DIR), labelled_ids(spark, SF_DIR)
    short = SEL.by_id_list(records, ids, H.record_id())
    long = SEL.by_id_list(records, ids, H.record_id(), max_broadcast=0)
    assert short.select("rec_seq").collect()
    assert sorted(short.select("rec_seq").collect()) == sorted(long.select("rec_seq").collect())


def test_short_list_moves_no_payload(spark):
    plan = SEL.by_id_list(page_records(spark, SF_DIR), labelled_ids(spark, SF_DIR),
                          H.record_id())._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_samples_do_not_depend_on_partitioning(spark):
    records = page_records(spark, SF_DIR)
    draws = [{r.rec_seq for r in S.bernoulli(records.repartition(n), H.record_id(), 0.4).collect()}
             for n in (1, 5)]
    assert draws[0] == draws[1] and draws[0]
    other = {r.rec_seq for r in S.bernoulli(records, H.record_id(), 0.4, 1).collect()}
    assert other != draws[0]


def test_sample_size(spark):
    n = spark.range(20000).where(S.drawn(F.col("id").cast("string"), 0.25)).count()
    assert abs(n / 20000 - 0.25) < 0.02


@pytest.mark.parametrize("outcomes", [
    E.conversion_outcomes, E.hash_outcomes, E.language_outcomes, E.response_outcomes,
    E.duplicate_outcomes,
    lambda r: E.conversion_outcomes(r, sample=0.5, seed=1),
    lambda r: E.response_outcomes(r, substrings=["a"], markup_only=True)])
def test_outcomes_add_up(spark, outcomes):
    records = page_records(spark, SF_DIR)
    counts = E.outcome_counts(outcomes(records), "file").collect()
    per_file = {r["file"]: r["count"] for r in records.groupBy("file").count().collect()}
    assert {r.file: r.total for r in counts} == per_file
    other = outcomes(records).groupBy("outcome").count().collect()
    assert sum(r["count"] for r in other) == records.count()


def test_text_is_extracted_once(spark):
    ok = E.conversion_outcomes(page_records(spark, SF_DIR)).where("outcome = 'ok'").select("text")
    plan = ok._jdf.queryExecution().executedPlan().toString()
    # inline tags are removed by one expression, and only in the generator
    assert plan.count("acronym") == 1


def test_counters_are_gathered_while_writing(spark, tmp_path):
    from pyspark.sql import Observation
    seen = Observation()
    outcomes = E.observed(E.conversion_outcomes(page_records(spark, SF_DIR)), seen)
    sinks.write_jsonl(sinks.documents(outcomes), f"{tmp_path}/out")
    assert seen.get["total"] == 50
    assert seen.get["output"] == spark.read.json(f"{tmp_path}/out").count()


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", None, "é\nx", True), ("b", "u", "t", False)],
                               "id string, uri string, text string, keep boolean")
    sinks.write_jsonl(df, f"{tmp_path}/j")
    lines = "".join(f.read_text() for f in (tmp_path / "j").glob("*.json"))
    assert '"uri":null' in lines and "é" in lines
    sinks.write_text(df.where("id = 'a'"), f"{tmp_path}/t")
    assert "".join(f.read_text() for f in (tmp_path / "t").glob("*.txt")) == "é\nx\n"
    sinks.write_tsv(df.select("id", "keep"), f"{tmp_path}/c", by=["keep"])
    rows = {(f.parent.name, f.read_text()) for f in (tmp_path / "c").rglob("*.csv")}
    assert rows == {("keep=True", "a\n"), ("keep=False", "b\n")}


def test_manifest(spark):
    paths = spark.createDataFrame([(f"p/{c}/warc/f{n}.warc.gz",) for c in "ab"
                                   for n in range(3)], "path string")
    done = spark.createDataFrame([("out/a/f0.warc.gz",)], "out_path string")
    plan = MF.crawl_plan(paths, done, "out", 4).orderBy("path").collect()
    assert [(r.out_path, r.seed) for r in plan] == [
        ("out/a/f1.warc.gz", 6472), ("out/a/f2.warc.gz", 6635),
        ("out/b/f0.warc.gz", 6798), ("out/b/f1.warc.gz", 6961)]
    assert {r.rel_dir for r in MF.output_dirs(paths, "p").collect()} == {"a/warc", "b/warc"}


def test_resume_reads_each_archive_once(spark, tmp_path):
    seen = []

    def job(records, number):
        seen.extend((number, r.file[-9:], r.n) for r in
                    records.groupBy("file").agg(F.count("*").alias("n")).collect())

    source, progress = f"{tmp_path}/in", f"{tmp_path}/progress"
    write(tmp_path / "in/x/1.warc.gz", ordinary())
    process_new(spark, source, progress, job)
    write(tmp_path / "in/y/2.warc.gz", ordinary())
    write(tmp_path / "in/y/skip.txt", [b"no"])
    process_new(spark, source, progress, job)
    process_new(spark, source, progress, job)
    assert seen == [(0, "1.warc.gz", 5), (1, "2.warc.gz", 5)]


def _brute_classes(cf, headings, lengths):
    """The published rule, one paragraph at a time."""
    n, c = len(cf), list(cf)

    def neighbour(i, step, near):
        i += step
        while 0 <= i < n:
            if c[i] in ("good", "bad") or (near and c[i] == "neargood"):
                return c[i]
            i += step
        return "bad"

    def good_below(i):
        distance = 0
        for j in range(i + 1, n):
            if distance > 200:
                return False
            if c[j] == "good":
                return True
            distance += lengths[j]
        return False

    for i in range(n):
        if headings[i] and c[i] == "short" and good_below(i):
            c[i] = "neargood"
    new = {}
    for i in range(n):
        if c[i] == "short":
            p, q = neighbour(i, -1, False), neighbour(i, 1, False)
            if p == q:
                new[i] = p
            elif (p == "bad" and neighbour(i, -1, True) == "neargood") or (
                    q == "bad" and neighbour(i, 1, True) == "neargood"):
                new[i] = "good"
            else:
                new[i] = "bad"
    for i, k in new.items():
        c[i] = k
    for i in range(n):
        if c[i] == "neargood":
            both = neighbour(i, -1, False), neighbour(i, 1, False)
            c[i] = "bad" if both == ("bad", "bad") else "good"
    for i in range(n):
        if headings[i] and c[i] == "bad" and cf[i] != "bad" and good_below(i):
            c[i] = "good"
    return c


def test_context_classes_against_brute_force(spark):
    import random
    rng = random.Random(3)
    shapes = {  # n_chars, stop words of ten, linked characters
        "good": (250, 9, 0), "neargood": (100, 9, 0), "short": (30, 0, 0), "bad": (100, 0, 0)}
    rows, pages = [], {}
    for page in range(120):
        cf = [rng.choice(list(shapes)) for _ in range(rng.randrange(1, 14))]
        tags = [rng.choice(["p", "p", "head"]) for _ in cf]
        pages[page] = cf, [t == "head" for t in tags], [shapes[k][0] for k in cf]
        for pos, (k, tag) in enumerate(zip(cf, tags)):
            n_chars, stops, linked = shapes[k]
            rows.append((page, pos, tag, "x", n_chars, linked, 10, stops))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "page int, pos long, tag string, text string, n_chars long, "
                                     "link_chars long, n_words long, n_stops long")
    found = {}
    arrays = df.groupBy("page").agg(F.array_sort(F.collect_list(F.struct(
        *[c for c in ("pos", "tag", "text", "n_chars", "link_chars", "n_words", "n_stops")]))).alias("p"))
    classes = arrays.select("page", F.inline(B.classified(F.col("p"))))
    for r in classes.orderBy("page", "pos").collect():
        found.setdefault(r.page, []).append((r.cf_class, r["class"]))
    for page, (cf, headings, lengths) in pages.items():
        assert [k for k, _ in found[page]] == cf
        assert [k for _, k in found[page]] == _brute_classes(cf, headings, lengths)


def test_paragraph_features(spark):
    page = ("<h2>Title</h2><p>see <a class=x href='/a?b=1&amp;c'>this link</a> here</p>"
            "<select><option>one<option>two</select><p>plain <a>bare</a></p><p></p>")
    df = spark.createDataFrame([(1, page)], "page int, html string")
    rows = B.paragraphs(df, "page").orderBy("pos").collect()
    assert [(r.tag, r.text, r.link_chars, r.hrefs) for r in rows] == [
        ("head", "Title", 0, []), ("p", "see this link here", 9, ["/a?b=1&c"]),
        ("select", "one", 0, []), ("select", "two", 0, []), ("p", "plain bare", 4, [""])]


def test_shared_folder_is_the_configured_one(spark):
    assert physical.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_partitions_follow_the_data(spark):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert physical.shuffle_partitions(df) == 4
    assert physical.shuffle_partitions(df, target_bytes=1 << 10) > 100
