import gzip
import json

import pytest
from pyspark.sql import Observation, functions as F

from archives import PAGE, ordinary, record, write
from crawlcorpus.functions import headers as H
from crawlcorpus.plans import jobs
from crawlcorpus.sources import lists, sinks
from crawlcorpus.sources.warc import read_archives, read_listed


@pytest.mark.parametrize("name", ["a.warc.gz", "a.warc", "a.warc.zst"])
def test_codecs(spark, tmp_path, name):
    path = write(tmp_path / name, ordinary())
    rows = read_archives(spark, path).orderBy("rec_seq").collect()
    assert [r.rec_type for r in rows] == ["warcinfo", "request", "response", "metadata",
                                          "conversion"]
    assert [r.rec_seq for r in rows] == [1, 2, 3, 4, 5]
    assert bytes(rows[2].content) == PAGE
    assert rows[2].http_headers["server"] == "test"
    assert rows[4].headers["warc-refers-to"] == "<urn:uuid:r>"
    assert "warc-refers-to" not in rows[0].headers


def test_folder_is_read_in_path_order(spark, tmp_path):
    write(tmp_path / "a/y.warc.gz", ordinary())
    write(tmp_path / "a/b/x.warc.gz", ordinary())
    write(tmp_path / "a/z.warc.zst", ordinary())
    df = read_archives(spark, str(tmp_path))
    files = df.select("file_seq", "file").distinct().orderBy("file_seq").collect()
    assert [r.file for r in files] == [f"{tmp_path}/a/b/x.warc.gz", f"{tmp_path}/a/y.warc.gz"]
    assert read_archives(spark, str(tmp_path), pathGlobFilter="*.warc.*").count() == 15
    assert read_archives(spark, str(tmp_path), recordTypes="response").count() == 2


def test_one_task_per_large_archive(spark, tmp_path):
    for n in range(3):
        write(tmp_path / f"{n}.warc.gz", ordinary())
    assert read_archives(spark, str(tmp_path)).rdd.getNumPartitions() == 1
    assert read_archives(spark, str(tmp_path), maxPartitionBytes=1).rdd.getNumPartitions() == 3


def test_error_modes(spark, tmp_path):
    path = write(tmp_path / "cut.warc.gz", ordinary(), cut=20)
    rows = read_archives(spark, path).orderBy("rec_seq").collect()
    assert [r.error is None for r in rows] == [True] * 4 + [False]
    assert read_archives(spark, path, mode="DROPMALFORMED").count() == 4
    with pytest.raises(Exception, match="EOFError"):
        read_archives(spark, path, mode="FAILFAST").count()


def test_check_reports_every_archive(spark, tmp_path):
    good = write(tmp_path / "good.warc.gz", ordinary())
    cut = write(tmp_path / "cut.warc.gz", ordinary(), cut=20)
    empty = write(tmp_path / "empty.warc.gz", [b""])
    other = write(tmp_path / "other.warc.gz", [b"not an archive\n"])
    found = {r.file: r for r in jobs.check(spark, [str(tmp_path)]).collect()}
    assert (found[good].status, found[good].n_records) == ("OK", 5)
    assert (found[cut].status, found[cut].n_records) == ("ERROR", 4)
    assert "no records" in found[empty].message
    assert "not a record" in found[other].message
    lines = {r.value for r in jobs.report(jobs.check(spark, [good])).collect()}
    assert lines == {f"{good}: OK: 5 records"}


def test_transfer_and_content_coding(spark, tmp_path):
    chunked = b"4\r\nwiki\r\n5\r\npedia\r\n0\r\n\r\n"
    block = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked
    zipped = b"HTTP/1.1 200 OK\r\nContent-Encoding: gzip\r\n\r\n" + gzip.compress(b"zipped")
    false = b"HTTP/1.1 200 OK\r\nContent-Encoding: gzip\r\n\r\nnot zipped"
    path = write(tmp_path / "h.warc.gz", [
        record("response", str(n), b, http=False, Content_Type="application/http")
        for n, b in enumerate([block, zipped, false])])
    rows = read_archives(spark, path).orderBy("rec_seq").collect()
    assert [bytes(r.content) for r in rows] == [b"wikipedia", b"zipped", b"not zipped"]


def test_write_copies_bytes_and_mirrors_the_tree(spark, tmp_path):
    write(tmp_path / "in/a/y.warc.gz", ordinary())
    write(tmp_path / "in/b/x.warc.gz", ordinary())
    root, out = f"{tmp_path}/in", f"{tmp_path}/out"
    sinks.write_archives(read_archives(spark, root, keepRaw="true"), out, root)
    assert gzip.open(f"{out}/a/y.warc.gz").read() == b"".join(ordinary())
    assert (tmp_path / "out/_SUCCESS").exists()
    assert not list((tmp_path / "out/_temporary").iterdir())
    write(tmp_path / "out/_temporary/job/1/0.warc.gz", ordinary())  # of a job that died
    assert read_archives(spark, out).count() == 10


def test_write_rebuilds_records_and_lengths(spark, tmp_path):
    path = write(tmp_path / "a.warc.gz", ordinary())
    changed = read_archives(spark, path).withColumn("content", F.lit(b"new"))
    sinks.write_archives(changed, f"{tmp_path}/out")
    rows = read_archives(spark, f"{tmp_path}/out").collect()
    assert {bytes(r.content) for r in rows} == {b"new"}
    assert {r.http_headers["server"] for r in rows if r.rec_type == "response"} == {"test"}


def test_mirroring_after_a_shuffle_is_refused(spark, tmp_path):
    write(tmp_path / "in/y.warc.gz", ordinary())
    root = f"{tmp_path}/in"
    scattered = read_archives(spark, root, keepRaw="true").repartition(3)
    with pytest.raises(Exception, match="several tasks"):
        sinks.write_archives(scattered, f"{tmp_path}/out", root)


def test_listed_archives(spark, tmp_path):
    for n in range(3):
        write(tmp_path / f"{n}.warc.gz", ordinary())
    plan = lists.numbered(lists.archive_paths(spark, str(tmp_path)))
    rows = read_listed(plan).groupBy("file", "file_seq").count().collect()
    assert {(r.file[-9:], r.file_seq, r["count"]) for r in rows} == {
        ("0.warc.gz", 0, 5), ("1.warc.gz", 1, 5), ("2.warc.gz", 2, 5)}


def test_headers_with_gaps(spark, tmp_path):
    path = write(tmp_path / "h.warc.gz", [
        record("response", "1", PAGE, WARC_Identified_Payload_Type=None),
        record("response", "2", PAGE, **{"WARC_Record_ID": "urn:uuid:2"}),
        record("response", "3", PAGE, WARC_Record_ID=None),
        record("response", "4", PAGE, WARC_Record_ID=None, **{"warc_RECORD_id": "<urn:uuid:4>"}),
        record("response", "5", PAGE, WARC_Identified_Payload_Type=None, Content_Type=None)])
    rows = read_archives(spark, path).select(
        H.record_id().alias("id"), H.bare_id(H.record_id()).alias("bare"),
        H.mime_type().alias("mime")).collect()
    assert [r.bare for r in rows] == ["urn:uuid:1", None, None, "urn:uuid:4", "urn:uuid:5"]
    assert rows[0].mime == "application/http; msgtype=response"
    assert rows[4].mime is None
    counts = jobs.convert(spark, [path], f"{tmp_path}/out")
    assert (counts["total"], counts["errors"], counts["output"]) == (5, 3, 2)


def test_convert_job(spark, tmp_path):
    write(tmp_path / "in/a.warc.gz", ordinary())
    counts = jobs.convert(spark, [f"{tmp_path}/in"], f"{tmp_path}/out")
    assert (counts["total"], counts["responses"], counts["conversions"], counts["output"]) == (
        5, 1, 1, 2)
    rows = [json.loads(line) for f in (tmp_path / "out").glob("*.json")
            for line in f.read_text().splitlines()]
    by_id = {r["id"]: r for r in rows}
    assert by_id["commoncrawl:urn:uuid:r"]["text"] == "Head\nSome bold text"
    assert by_id["commoncrawl:urn:uuid:c"]["meta"] == {
        "uri": "http://example.org/c", "source_type": "text/plain",
        "download_date": "2021-01-15T00:00:00Z", "source_length": 10}
    refers = jobs.convert(spark, [f"{tmp_path}/in"], f"{tmp_path}/wet", refers_to=True)
    assert (refers["output"], refers["errors"]) == (1, 1)


@pytest.mark.parametrize("options", [
    {"html": True}, {"text_only": True}, {"extractor": "parser"}, {"extractor": "tags"},
    {"extractor": "random"}, {"sample": 0.0}, {"sample": 1.0}])
def test_convert_options(spark, tmp_path, options):
    path = write(tmp_path / "a.warc.gz", ordinary())
    counts = jobs.convert(spark, [path], f"{tmp_path}/out", **options)
    assert counts["output"] == (0 if options.get("sample") == 0.0 else 2)


def test_convert_by_main_text(spark, tmp_path):
    words = "the quick brown fox and the lazy dog are in the garden of the house " * 5
    page = f"<nav><a href='/x'>Menu</a></nav><p>{words}</p><p>short</p><p>{words}</p>".encode()
    path = write(tmp_path / "a.warc.gz", [record("response", "1", page), ordinary()[4]])
    counts = jobs.convert(spark, [path], f"{tmp_path}/out", extractor="main",
                          stoplist=["the", "and", "are", "in", "of"])
    assert counts["output"] == 2
    texts = {json.loads(line)["text"] for f in (tmp_path / "out").glob("*.json")
             for line in f.read_text().splitlines()}
    assert texts == {"plain text", f"{words.strip()}\n\nshort\n\n{words.strip()}"}


@pytest.mark.parametrize("extractor", ["main", "random"])
def test_counts_are_of_what_is_written(spark, tmp_path, extractor):
    long = "the quick brown fox and the lazy dog are in the garden of the house " * 5
    pages = [f"<p>{long}{n}</p>" if n % 2 else f"<p>short {n}</p>" for n in range(24)]
    path = write(tmp_path / "a.warc.gz", [record("response", str(n), p.encode()) for n, p in enumerate(pages)])
    counts = jobs.convert(spark, [path], f"{tmp_path}/out", extractor=extractor, stoplist=["the", "and", "are", "in", "of"])
    written = spark.read.json(f"{tmp_path}/out").count()
    assert counts["total"] == 24 == counts["output"] + counts["empties"] and counts["output"] == written
    assert counts["empties"] == 12 if extractor == "main" else 0 < counts["empties"] < 12


def test_pages_without_paragraphs_are_written_as_xml(spark, tmp_path):
    path = write(tmp_path / "a.warc.gz", [record("response", "1", b"<hr>"), record("response", "2", b"<p>x</p>")])
    counts = jobs.extract_text(spark, [path], f"{tmp_path}/x", xml=True)
    xml = "".join(f.read_text() for f in (tmp_path / "x").glob("part*"))
    assert counts["output"] == 2 == xml.count("<doc ") and xml.count("<paragraph") == 1


def test_hash_and_extract_jobs(spark, tmp_path):
    path = write(tmp_path / "a.warc.gz", ordinary() + [
        record("response", "r2", PAGE), record("response", "r3", b"x", **{
            "WARC_Identified_Payload_Type": "image/png"})])
    counts = jobs.compute_hashes(spark, [path], f"{tmp_path}/h")
    assert (counts["output"], counts["unsupported"]) == (3, 1)
    rows = dict(line.split("\t") for f in (tmp_path / "h").glob("*.csv")
                for line in f.read_text().splitlines())
    assert rows["r"] == rows["r2"] != rows["c"] and len(rows["r"]) == 24
    counts = jobs.extract_text(spark, [path], f"{tmp_path}/e", ids="uuid:r,zzz")
    assert (counts["output"], counts["unsupported"]) == (2, 1)
    line = next(f for f in (tmp_path / "e").glob("*.json") if f.stat().st_size).read_text()
    assert list(json.loads(line.splitlines()[0])) == ["id", "meta", "text"]
    jobs.extract_text(spark, [path], f"{tmp_path}/x", xml=True)
    xml = "".join(f.read_text() for f in (tmp_path / "x").glob("part*"))
    assert '<paragraph tag="head">' in xml and "Some bold text" in xml


def test_filter_and_sample_jobs(spark, tmp_path):
    write(tmp_path / "in/a.warc.gz", ordinary())
    ids = tmp_path / "ids.gz"
    ids.write_bytes(gzip.compress(b" <urn:uuid:r> \n<urn:uuid:zz>\n<urn:uuid:r>\n"))
    jobs.filter_by_ids(spark, str(ids), [f"{tmp_path}/in"], f"{tmp_path}/f",
                       input_root=f"{tmp_path}/in")
    assert gzip.open(f"{tmp_path}/f/a.warc.gz").read() == ordinary()[2]
    jobs.filter_by_ids(spark, str(ids), [f"{tmp_path}/in"], f"{tmp_path}/w", refers_to=True)
    assert [r.rec_type for r in read_archives(spark, f"{tmp_path}/w").collect()] == ["conversion"]
    jobs.sample_responses(spark, 1.0, [f"{tmp_path}/in"], f"{tmp_path}/s")
    assert [r.rec_type for r in read_archives(spark, f"{tmp_path}/s").collect()] == ["response"]


def test_sample_crawl_resumes(spark, tmp_path):
    base = f"{tmp_path}/crawl/"
    paths = [f"data/C/segments/{n}/warc/f{n}.warc.gz" for n in range(5)]
    for p in paths:
        write(tmp_path / "crawl" / p, ordinary())
    (tmp_path / "paths").write_text("\n".join(paths) + "\n")
    manifest = lists.path_list(spark, f"{tmp_path}/paths")
    out = f"{tmp_path}/out"
    first = jobs.sample_crawl(spark, manifest, 1.0, out, base=base, limit=3).collect()
    assert [(r.path, r.seed) for r in first] == list(zip(paths, [6472, 6635, 6798]))
    assert (tmp_path / "out/0/f0.warc.gz").exists()
    second = jobs.sample_crawl(spark, manifest, 0.0, out, base=base, limit=3).collect()
    assert [(r.path, r.seed) for r in second] == [(paths[3], 6472), (paths[4], 6635)]
    # nothing was drawn, so there is no file, but the inputs count as done
    assert not (tmp_path / "out/3/f3.warc.gz").exists()
    assert jobs.sample_crawl(spark, manifest, 1.0, out, base=base).count() == 0


def test_duplicates_job_remembers(spark, tmp_path):
    one = write(tmp_path / "1.warc.gz", [
        record("response", "a", PAGE), record("response", "b", PAGE),
        record("response", "a", PAGE), record("response", "c", b"<p>other</p>")])
    two = write(tmp_path / "2.warc.gz", [
        record("response", "d", PAGE), record("response", "c", b"<p>other</p>"),
        record("response", "e", b"<p>new</p>"), record("response", "f", b"<p>new</p>")])
    ids = [f"<urn:uuid:{x}>" for x in "abcdef"]
    a, b, c, d, e, f = ids
    found = jobs.find_duplicates(spark, [one], f"{tmp_path}/db").collect()
    assert {tuple(r) for r in found} == {(b, a)}
    seen = Observation("seen")
    found = jobs.find_duplicates(spark, [two], f"{tmp_path}/db", seen=seen).collect()
    assert {tuple(r) for r in found} == {(d, a), (f, e)}
    assert (seen.get["total"], seen.get["output"], seen.get["unreadable"]) == (4, 4, 0)


def test_modes_of_jobs(spark, tmp_path):
    write(tmp_path / "in/a.warc.gz", ordinary())
    write(tmp_path / "in/cut.warc.gz", ordinary(), cut=20)
    root = [f"{tmp_path}/in"]
    counts = jobs.convert(spark, root, f"{tmp_path}/p")
    assert (counts["unreadable"], counts["output"]) == (1, 3)
    assert jobs.compute_hashes(spark, root, f"{tmp_path}/d", mode="DROPMALFORMED")["unreadable"] == 0
    for job in (jobs.convert, jobs.extract_text):
        with pytest.raises(Exception):
            job(spark, root, f"{tmp_path}/f", mode="FAILFAST")
