import os
import re
import tracemalloc

import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from crawlcorpus.functions import headers as H, html as HT, mime as M, paths as P, text as X
from crawlcorpus.functions import parsed
from crawlcorpus.functions.parsed import parsed_to_text
from crawlcorpus.operators import manifest as MF

# One Spark job per example is slow, so an example is a list of strings.
TEXTS = st.lists(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(
    " \t\n\r\x0b\x1c\x85\xa0 　_aé²Ⅷ1²")), max_size=30), min_size=1, max_size=60)
FEW = settings(max_examples=8, deadline=None, derandomize=True,
               suppress_health_check=list(HealthCheck))


def apply(spark, values, *columns):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [tuple(r)[1:] for r in df.select("i", *columns).orderBy("i").collect()]


V = "v"


def py_space(text):
    lines = [" ".join(line.split()) for line in text.strip().split("\n")]
    return "\n".join(line for line in lines if line)


@FEW
@given(TEXTS)
def test_normal_space(spark, values):
    once = X.normalize_space(F.col(V))
    rows = apply(spark, values, once, X.normalize_space(once))
    assert [r[0] for r in rows] == [py_space(v) for v in values]
    assert all(a == b for a, b in rows)


@FEW
@given(TEXTS)
def test_letters_and_words(spark, values):
    rows = apply(spark, values, X.letters_only(F.col(V)), X.count_words(F.col(V)),
                 X.count_words(F.col(V), "[a-z]+"), X.strip_space(F.col(V)))
    for value, (letters, words, custom, stripped) in zip(values, rows):
        assert letters == " ".join(re.findall(r"[^\W\d_]+", value))
        assert words == len(re.findall(r"\b[^\W\d_]{2,}\b", value))
        assert custom == len(re.findall("[a-z]+", value))
        assert stripped == value.strip()


@FEW
@given(st.lists(st.text("ab/é", max_size=8), max_size=6))
def test_common_prefix(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "value string")
    prefix = os.path.commonprefix(values)
    assert MF.common_prefix(df).first().prefix == prefix
    assert MF.common_directory(df).first().prefix == os.path.dirname(prefix)


def test_nul_and_bytes(spark):
    df = spark.createDataFrame([(bytearray(b"a\x00b"),), (bytearray(b"caf\xe9"),),
                                (bytearray("café".encode()),)], "b binary")
    rows = df.select(X.without_nul(X.utf8_text(F.col("b"))), X.html_source(F.col("b")),
                     X.encodable(F.col("b").cast("string"))).collect()
    assert [r[0] for r in rows] == ["ab", None, "café"]
    assert [r[1] for r in rows] == ["a\x00b", "café", "café"]
    assert rows[1][2] == "caf�"


def test_digests(spark):
    (a, b, c), = apply(spark, ["a1b"], X.digest(F.col(V)), X.digest(F.col(V), True),
                       F.length(X.raw_digest(F.col(V))))
    assert len(a) == 24 and a != b and c == 16


@pytest.mark.parametrize("mime, plain, html, unsupported", [
    ("text/plain", 1, 0, 0), ("text/html", 0, 1, 0), ("text/html; charset=x", 0, 1, 0),
    ("text/htmlx", 0, 1, 0), ("text/plain; charset=x", 0, 0, 0),
    ("application/http; msgtype=response", 0, 1, 0), ("application/xml-dtd", 0, 1, 1),
    ("application/xml", 0, 1, 0), ("application/json", 0, 0, 1),
    ("application/json; x", 0, 0, 1), ("text/calendar", 0, 0, 1),
    ("text/calendar; x", 0, 0, 0), ("text/css", 0, 0, 0), ("font/woff", 0, 0, 0),
    ("", 0, 0, 0), ("TEXT/HTML", 0, 0, 0), ("image/png", 0, 0, 1), ("video/x", 0, 0, 1),
    ("application/xhtml+xml;q", 0, 1, 0), (None, None, None, None)])
def test_mime(spark, mime, plain, html, unsupported):
    (row,) = apply(spark, [mime], M.is_plain(F.col(V)), M.is_html_like(F.col(V)),
                   M.is_unsupported(F.col(V)))
    assert row == tuple(None if x is None else bool(x) for x in (plain, html, unsupported))


def test_ids(spark):
    rows = apply(spark, ["<urn:uuid:x>", "urn:uuid:x", "x", "<x>"], H.bare_id(F.col(V)),
                 H.uuid_of(F.col(V)), H.normalize_id(F.col(V)))
    assert rows == [("urn:uuid:x", "x", "x"), (None, None, "x"), (None, None, "x"),
                    ("x", None, "x")]


@pytest.mark.parametrize("page, blocks, tags", [
    ("a<b>c</b>d<p>e", "acd\ne", "a\nc\nd\ne"),
    ("<script>x</p>y</script>a<style>p</style>b", "ab", "a\nb"),
    ("a<noscript>n</noscript>b", "ab", "a\nn\nb"),
    ("a<!-- <p>x</p> -->b", "a\nb", "a\nb"),
    ("<body><b>x</b>y<br>z<br/>w", "xy\nz\nw", "x\ny\nz\nw"),
    ("<a title='a>b' href=\"c>d\">t</a>", "t", "t"),
    ("1 < 2 &amp;&amp; 3 > 2", "1 < 2 && 3 > 2", "1 < 2 && 3 > 2"),
    ("&lt;b&gt; &amp;lt; &#169;&#xA9;&copy; &eacute; &#150; &#0;&nosuch;",
     "<b> &lt; ©©© é – &nosuch", None),
    ("&amp &copy. &copyright &amp;amp &ampere;x &lt", "& &copy. &copyright &amp &amperex <",
     None), ("&#xD800; &#99999999999999999999; &#x110000;", "? � �", None),
    ("&hellip;&NotEqualTilde;&x-y;", "…≂̸&x-y", None),
    ("x<script>never closed", "x", "x"), ("x<!-- never closed", "x", "x"),
    ("<SCRIPT type='a'>x</SCRIPT>A<BR>B", "A\nB", "A\nB"),
    ("<p title=\"never closed>t</p><p class='x'>u", "t\nu", "t\nu"),
    ("<!DOCTYPE html><?xml?>t", "t", "t"), ("&#128512;", "😀", "😀"), ("", "", "")])
def test_html(spark, page, blocks, tags):
    (row,) = apply(spark, [page], HT.blocks_to_text(F.col(V)), HT.tags_to_text(F.col(V)))
    assert row[0] == blocks
    assert tags is None or row[1] == tags


@pytest.mark.parametrize("page", [
    "a<b>c</b>d<p>e", "<script>x</p>y</script>a<style>p</style>b", "a<noscript>n</noscript>b",
    "a<!-- <p>x</p> -->b", "<body><b>x</b>y<br>z<br/>w", "&lt;b&gt; &copy; é", None])
def test_parser_agrees_with_patterns(spark, page):
    (row,) = apply(spark, [page], HT.blocks_to_text(F.col(V)), parsed_to_text(F.col(V)))
    assert row[0] == row[1]


def test_parser_holds_few_pages_of_a_batch_as_strings():
    page = "<p>" + "я" * 10_000 + "</p>"
    pages = pa.array([page, None] * 1_000)
    tracemalloc.start()
    texts = parsed._blocks_of(pages)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(texts) == 2_000 and texts[1998].as_py() == f"\n{page[3:-4]}\n" and texts.null_count == 1_000
    assert peak < 8 << 20  # all of them are 20 MB of strings, and as much again of texts
    assert parsed._blocks_of(pages[:0]).type == pa.string()


def test_very_long_tag_does_not_overflow(spark):
    page = "<p " + 'a="1" ' * 20000 + ">x</p>" + "<i>" * 5000 + "y"
    (row,) = apply(spark, [page], HT.blocks_to_text(F.col(V)))
    assert row[0] == "x\ny"


def test_clean_html(spark):
    (row,) = apply(spark, ["<p>a</p><script>b</script><style>c</style>"],
                   HT.clean_html(F.col(V)))
    assert row == ("<p>a</p>",)


def test_paths(spark):
    path = F.col(V)
    rows = apply(spark, ["a/b/warc/f.warc.gz", "f.warc.gz", "/f"], P.basename(path),
                 P.dirname(path), P.with_suffix(path, ".warc.gz", ".tsv"),
                 P.output_path(path, F.lit("a"), "out"), P.relative_dir(path, "a/"))
    assert rows == [("f.warc.gz", "a/b/warc", "a/b/warc/f.tsv", "out/b/f.warc.gz", "b/warc"),
                    ("f.warc.gz", "", "f.tsv", "out/f.warc.gz", "."),
                    ("f", "/", "/f", "out/f", ".")]
