"""What a scan leaves alone, an index of records, reading by place, and going on after damage."""

import gzip

import pytest
from pyspark.sql import functions as F

from archives import PAGE, ordinary, record, write
from crawlcorpus.plans import jobs
from crawlcorpus.sources import records as R, sinks
from crawlcorpus.sources.members import chosen, member_index, read_members
from crawlcorpus.sources.warc import ArchiveScan, read_archives

COMPARED = ["rec_seq", "rec_type", "headers", "http_headers", "content", "raw"]


def rows(frame):
    return sorted((r.asDict() for r in frame.select(*COMPARED).collect()), key=lambda r: r["rec_seq"])


def many(n):
    return [record("response", f"r{i}", b"<p>%d</p>" % i * (i % 50 + 1)) for i in range(n)]


# --- what a scan leaves alone -------------------------------------------------------------

@pytest.fixture
def decoded(monkeypatch):
    """Counts payloads that are decoded, in this process."""
    calls, body = [], R._http_body
    monkeypatch.setattr(R, "_http_body", lambda h, b: (calls.append(1), body(h, b))[1])
    return calls


def scanned(path, **options):
    return list(ArchiveScan(options).rows(path, 0))


def test_payloads_are_decoded_only_if_asked_for(tmp_path, decoded):
    path = write(tmp_path / "a.warc.gz", ordinary())
    assert len(scanned(path, content="false", httpHeaders="false")) == 5 and not decoded  # check
    assert len(scanned(path, content="false", httpHeaders="false", keepRaw="true")) == 5 and not decoded  # filter
    assert [r[3] for r in scanned(path, recordTypes="conversion")] == ["conversion"] and not decoded
    assert [r[3] for r in scanned(path, recordTypes="metadata")] == ["metadata"] and not decoded
    assert scanned(path, recordTypes="response")[0][6] == PAGE and len(decoded) == 1


def test_skipped_records_are_not_held(tmp_path):
    import io
    block = record("response", "1", b"x" * 5_000_000)
    stream, most = io.BytesIO(block * 3), []

    class Watched:
        readline = stream.readline

        def read(self, n):
            most.append(n)
            return stream.read(n)
    found = list(R.read_records(Watched(), content=False, raw=False, http_headers=False))
    assert [f[2:] for f in found] == [(None, None)] * 3 and max(most) <= 1 << 20


def test_branches_of_a_query_have_their_own_filters(spark, tmp_path):
    write(tmp_path / "a.warc.gz", ordinary())
    write(tmp_path / "b.warc.gz", ordinary())
    every = read_archives(spark, str(tmp_path))
    one, other = (every.where(F.col("rec_type") == kind) for kind in ("response", "request"))
    assert one.count() == 2 and every.count() == 10
    assert one.union(every).union(other).count() == 14


# --- an index of records ------------------------------------------------------------------------

@pytest.mark.parametrize("name", ["a.warc.gz", "a.warc", "a.warc.zst", "one-member.warc.gz"])
def test_records_by_place_are_those_of_a_scan(spark, tmp_path, name):
    path = tmp_path / name
    if name.startswith("one"):  # records that cannot be read by themselves
        path.write_bytes(gzip.compress(b"".join(ordinary())))
    else:
        write(path, ordinary())
    index = member_index(spark, str(path))
    assert index.where("offset is null").count() == {"a.warc.zst": 5, "one-member.warc.gz": 4}.get(name, 0)
    assert rows(read_members(index, keepRaw="true")) == rows(read_archives(spark, str(path), keepRaw="true"))
    some = index.where("rec_type = 'conversion' or rec_seq = 2")
    assert [r["rec_seq"] for r in rows(read_members(some))] == [2, 5]
    assert read_members(index.limit(0)).count() == 0


def test_places_are_exact(spark, tmp_path):
    path = write(tmp_path / "a.warc.gz", many(300))
    data = open(path, "rb").read()
    found = member_index(spark, path).orderBy("rec_seq").collect()
    assert [r.rec_seq for r in found] == list(range(1, 301)) and found[-1].length is None
    for r, raw in zip(found[:-1], many(300)):
        assert gzip.decompress(data[r.offset:r.offset + r.length]) == raw
    assert [r.id for r in found[:2]] == ["<urn:uuid:r0>", "<urn:uuid:r1>"]


def test_a_large_archive_is_read_by_several_tasks(spark, tmp_path, monkeypatch):
    path = write(tmp_path / "a.warc.gz", many(2000))
    index = member_index(spark, path)
    assert index.rdd.getNumPartitions() == 1
    found = read_members(index).withColumn("task", F.spark_partition_id())
    sizes = [r["count"] for r in found.groupBy("task").count().collect()]
    assert len(sizes) == spark.sparkContext.defaultParallelism and max(sizes) < 2000 / len(sizes) * 2


def test_filter_by_index(spark, tmp_path):
    for name in ("x/a", "x/b", "y/c"):
        write(tmp_path / f"in/{name}.warc.gz", [record("response", f"{name}-{i}", PAGE) for i in range(40)])
    root, ids = f"{tmp_path}/in", tmp_path / "ids.txt"
    listed = [f"x/a-{i}" for i in range(0, 40, 3)] + ["y/c-7", "nowhere"]
    ids.write_text("\n".join(f"<urn:uuid:{i}>" if i < "x/a-3" else i for i in listed))
    jobs.index(spark, [root], f"{tmp_path}/index")
    plain = jobs.filter_by_ids(spark, str(ids), [root], f"{tmp_path}/plain", input_root=root)
    found = jobs.filter_by_ids(spark, str(ids), [], f"{tmp_path}/found", input_root=root, index=f"{tmp_path}/index")
    assert found["output"] == plain["output"] == 15 and found["total"] == plain["total"] == 120
    for name in ("x/a", "y/c"):
        data = [gzip.open(f"{tmp_path}/{x}/{name}.warc.gz").read() for x in ("plain", "found")]
        assert data[0] == data[1]
    assert not (tmp_path / "found/x/b.warc.gz").exists()


def test_payloads_do_not_move(spark, tmp_path):
    path = write(tmp_path / "a.warc.gz", many(50))
    ids = spark.range(2_000_000).select(F.concat(F.lit("r"), "id").alias("id"))
    frame = read_members(chosen(member_index(spark, path), ids), keepRaw="true")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    above = plan[:plan.index("MapInArrow")]
    assert "Exchange" not in above and frame.count() == 50


# --- damage ------------------------------------------------------------------------------------------

@pytest.mark.parametrize("name", ["a.warc.gz", "a.warc"])
def test_a_damaged_middle_loses_one_record(spark, tmp_path, name):
    parts = many(30)
    packed = [gzip.compress(p) if name.endswith("gz") else p for p in parts]
    bad = bytearray(packed[11])
    if name.endswith("gz"):
        bad[len(bad) // 2] ^= 0xFF
        bad[len(bad) // 2 + 1] ^= 0xFF
    else:
        bad[:6] = b"BROKEN"
    path = tmp_path / name
    path.write_bytes(b"".join(packed[:11]) + bytes(bad) + b"".join(packed[12:]))
    found = read_archives(spark, str(path)).orderBy("rec_seq").collect()
    assert [r.rec_seq for r in found] == list(range(1, 31))
    assert [r.rec_seq for r in found if r.error is not None] == [12]
    assert [r.headers["warc-record-id"] for r in found if r.error is None] == [
        f"<urn:uuid:r{i}>" for i in range(30) if i != 11]
    index = member_index(spark, str(path))
    assert rows(read_members(index)) == rows(read_archives(spark, str(path)).where("error is null"))
    assert read_archives(spark, str(path), mode="DROPMALFORMED").count() == 29
    with pytest.raises(Exception):
        read_archives(spark, str(path), mode="FAILFAST").count()
    report = jobs.check(spark, [str(path)]).first()
    assert (report.status, report.n_records) == ("ERROR", 29)


def test_several_damages(spark, tmp_path):
    packed = [gzip.compress(p) for p in many(40)]
    packed[0] = packed[0][:30]
    packed[7] = b"garbage between members"
    packed[20] = gzip.compress(b"no record at all")
    packed[39] = packed[39][:len(packed[39]) // 2]
    path = tmp_path / "a.warc.gz"
    path.write_bytes(b"".join(packed))
    found = read_archives(spark, str(path)).collect()
    kept = {r.headers["warc-record-id"] for r in found if r.error is None}
    assert kept == {f"<urn:uuid:r{i}>" for i in range(40) if i not in (0, 7, 20, 39)}
    assert 3 <= sum(r.error is not None for r in found) <= 4


def test_codings_that_cannot_be_undone_are_errors(spark, tmp_path):
    def coded(number, body):
        block = b"HTTP/1.1 200 OK\r\nContent-Encoding: gzip\r\n\r\n" + body
        return record("response", number, block, http=False, Content_Type="application/http")
    path = write(tmp_path / "a.warc.gz", [
        coded("1", gzip.compress(b"<p>good</p>")), coded("2", gzip.compress(b"")[:10] + b"\xff" * 40),
        coded("3", b"<p>not coded</p>")])
    counts = jobs.convert(spark, [path], f"{tmp_path}/out")
    assert (counts["output"], counts["errors"]) == (2, 1)
    assert {r.text for r in spark.read.json(f"{tmp_path}/out").collect()} == {"good", "not coded"}


def test_copies_of_found_records_are_exact(spark, tmp_path):
    path = write(tmp_path / "a.warc.gz", ordinary())
    sinks.write_archives(read_members(member_index(spark, path), keepRaw="true"), f"{tmp_path}/out")
    assert read_archives(spark, f"{tmp_path}/out").count() == 5
