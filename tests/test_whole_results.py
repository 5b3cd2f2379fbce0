"""Nothing is lost without a word: long tags, long lists, unread archives, spellings, paths."""

import os

import pytest
from pyspark.sql import functions as F

from archives import ordinary, write
from crawlcorpus.functions import html as HT, text as X
from crawlcorpus.operators import boilerplate as B, manifest as MF, selection as SEL
from crawlcorpus.plans import jobs
from crawlcorpus.plans.physical import with_place
from crawlcorpus.sources import lists, sinks
from crawlcorpus.sources.files import located
from crawlcorpus.sources.warc import ArchiveScan, read_archives


@pytest.mark.parametrize("n", [150, 20_000])
def test_tags_may_have_any_number_of_quotes(spark, n):
    page = "<p " + " ".join(f'a{i}="x>y"' for i in range(n)) + ">text</p><b title='it''s'>more</b>"
    frame = spark.createDataFrame([(page,)], "html string")
    found = frame.select(HT.tags_to_text(F.col("html")), HT.blocks_to_text(F.col("html"))).first()
    assert [x.split() for x in found] == [["text", "more"], ["text", "more"]]


def test_a_quote_that_is_not_closed_ends_at_the_bracket(spark):
    frame = spark.createDataFrame([('<p title="open>text</p>',)], "html string")
    assert frame.select(HT.tags_to_text(F.col("html"))).first()[0].strip() == "text"


@pytest.mark.parametrize("tag,href", [
    ('<a data-href="/wrong" href="/right">', "/right"), ('<a title="a>b" href="/two">', "/two"),
    ('<a href="my page.html">', "my page.html"), ("<A class=x HREF=/bare>", "/bare"),
    ("<a\nid='q' href = '/single' rel=\"r\">", "/single"), ('<a name="only">', ""),
    ("<a " + " ".join(f'x{i}="v>w"' for i in range(5000)) + ' href="/far">', "/far")])
def test_addresses_of_links(spark, tag, href):
    frame = spark.createDataFrame([(1, f"<p>see {tag}this</a> now</p>")], "page_id int, html string")
    found = B.paragraphs(frame, "page_id").collect()
    assert [(r.text, [h for h in r.hrefs if h]) for r in found] == [("see this now", [href] if href else [])]


def test_references_are_no_marks(spark):
    frame = spark.createDataFrame([(1, "<p>one &#16;two &#x0F; three&#169;</p>")], "page_id int, html string")
    found = B.paragraphs(frame, "page_id").collect()
    assert [(r.tag, r.text) for r in found] == [("p", "one two three©")]


def test_a_plan_has_every_path(spark):
    paths = spark.range(20_001).select(F.concat(F.lit("p/x/f"), F.lpad(F.col("id").cast("string"), 6, "0"))
                                       .alias("path"))
    done = spark.createDataFrame([], "out_path string")
    plan = MF.crawl_plan(paths, done, "out")
    assert plan.count() == 20_001
    last = plan.orderBy(F.desc("path")).first()
    assert last.seed == 6472 + 163 * 20_000
    numbered = with_place(paths, "path", "n", small=100)  # in ranges
    assert numbered.where("n <> cast(substr(path, 6) as bigint)").count() == 0
    assert with_place(paths, "path", "n").where("n <> cast(substr(path, 6) as bigint)").count() == 0


def test_unread_archives_are_planned_again(spark, tmp_path):
    write(tmp_path / "in/good.warc.gz", ordinary())
    write(tmp_path / "in/cut.warc.gz", ordinary(), cut=20)
    names = ["good.warc.gz", "cut.warc.gz", "missing.warc.gz"]
    manifest = spark.createDataFrame([(f"in/{n}",) for n in names], "path string")
    out = f"{tmp_path}/out"
    first = jobs.sample_crawl(spark, manifest, 1.0, out, base=f"{tmp_path}/")
    assert first.count() == 3
    assert read_archives(spark, out).count() == 1
    again = jobs.sample_crawl(spark, manifest, 1.0, out, base=f"{tmp_path}/")
    assert {r.path for r in again.collect()} == {"in/cut.warc.gz", "in/missing.warc.gz"}


def test_other_failures_are_for_a_retry(tmp_path, monkeypatch):
    path = write(tmp_path / "a.warc.gz", ordinary())

    def broken(stream, **_):
        raise OSError("connection reset")
    monkeypatch.setattr("crawlcorpus.sources.warc.read_records", broken)
    with pytest.raises(OSError, match="reset"):
        list(ArchiveScan({}).rows(path, 0))


def test_jobs_count(spark, tmp_path):
    write(tmp_path / "in/a.warc.gz", ordinary())
    write(tmp_path / "in/cut.warc.gz", ordinary(), cut=20)
    root = f"{tmp_path}/in"
    counts = jobs.sample_responses(spark, 1.0, [root], f"{tmp_path}/s", input_root=root)
    assert counts["unreadable"] == 1 and counts["output"] == read_archives(spark, f"{tmp_path}/s").count()
    assert counts["total"] == sum(counts[x] for x in ("unreadable", "unsupported", "notsampled", "output"))
    ids = tmp_path / "ids.txt"
    ids.write_text("urn:uuid:2\n")
    read_id = read_archives(spark, root).where("rec_type = 'response'").first().headers["warc-record-id"]
    ids.write_text(read_id.strip("<>") + "\n")
    counts = jobs.filter_by_ids(spark, str(ids), [root], f"{tmp_path}/f")
    assert counts["unreadable"] == 1 and counts["output"] == read_archives(spark, f"{tmp_path}/f").count() > 0


def test_ids_match_in_any_spelling(spark):
    records = spark.createDataFrame([("<urn:uuid:1>",), ("urn:uuid:2",), ("3",), (None,)], "rid string")
    ids = spark.createDataFrame([("1",), ("<urn:uuid:2>",), ("urn:uuid:3",)], "id string")
    assert SEL.by_id_list(records, ids, F.col("rid")).count() == 3


def test_rows_without_payload_are_refused_and_errors_left_out(spark, tmp_path):
    write(tmp_path / "in/a.warc.gz", ordinary())
    with pytest.raises(Exception, match="without payload"):
        sinks.write_archives(read_archives(spark, f"{tmp_path}/in", content="false"), f"{tmp_path}/no")
    write(tmp_path / "in/cut.warc.gz", ordinary(), cut=20)
    sinks.write_archives(read_archives(spark, f"{tmp_path}/in", keepRaw="true"), f"{tmp_path}/yes")
    assert read_archives(spark, f"{tmp_path}/yes").count() == 9


def test_paths(spark, tmp_path, monkeypatch):
    write(tmp_path / "in/a.warc.gz", ordinary())
    monkeypatch.chdir(tmp_path)
    for path in ("in", "in/", f"{tmp_path}/in/", f"file://{tmp_path}/in", "in/a.warc.gz"):
        assert read_archives(spark, path).count() == 5
    sinks.write_archives(read_archives(spark, "in/", keepRaw="true"), "out/")
    assert read_archives(spark, f"{tmp_path}/out").count() == 5
    assert located("x/y/")[1] == os.path.join(str(tmp_path), "x/y")


def test_the_first_of_repeated_headers_counts(tmp_path):
    import io

    from crawlcorpus.sources.records import read_records
    block = b"WARC/1.0\r\nX-A: one\r\nX-A: two\r\n more\r\nContent-Length: 2\r\n\r\nok\r\n\r\n"
    (headers, _, content, raw), = read_records(io.BytesIO(block))
    assert headers["x-a"] == "one" and content == b"ok" and raw == block


def test_finished_outputs_of_a_new_folder(spark, tmp_path):
    assert lists.finished_outputs(spark, f"{tmp_path}/none").count() == 0


def test_bytes_that_are_not_utf8_are_windows_1252(spark):
    page = "<p>“Größe” – 5 €</p>".encode("cp1252")
    frame = spark.createDataFrame([(bytearray(page),)], "content binary")
    assert frame.select(X.html_source(F.col("content"))).first()[0] == "<p>“Größe” – 5 €</p>"
