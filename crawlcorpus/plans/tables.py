"""Archive records and path lists derived from plain tables of pages and labels.

They stand for a crawl where no archives are at hand: headers, types, ids and empty
payloads are computed from the page number, the payload is the page itself.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.charsets import all_charsets
from ..schema import RECORD

LATIN = "abcdefghijklmnopqrstuvwxyz"
#: By document number: where letters are moved to, the set, and where it is declared.
WRITTEN = [
    ("абвгдежзийклмнопрстуфхцчшщ", "windows-1251", "header"),
    ("абвгдежзийклмнопрстуфхцчшщ", "KOI8-R", "meta"),
    ("あいうえおかきくけこさしすせそたちつてとなにぬねのは", "Shift_JIS", "meta"),
    ("あいうえおかきくけこさしすせそたちつてとなにぬねのは", "ISO-2022-JP", "header"),
    ("天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往秋收冬藏闰余", "GBK", "meta"),
    ("αβγδεζηθικλμνξοπρστυφχψωάέ", "ISO-8859-7", "xml"),
    ("абвгдежзийклмнопрстуфхцчшщ", "UTF-16LE", "mark"),
    (LATIN, "UTF-8", "none"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same as a stream, of one file or of a folder of files: a path with a pattern is listed
    either way, where a plain one must be a folder."""
    return spark.readStream.schema(table(spark, sf_dir, name).schema).parquet(
        f"{sf_dir}/[{name[0]}]{name[1:]}.parquet")


def urn(number: Column) -> Column:
    """A record id for a number."""
    m = F.md5(F.concat(F.lit("p:"), number.cast("string")))
    part = [F.substring(m, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *part), F.lit(">"))


def _by_remainder(n: Column, divisor: int, values: dict, default) -> Column:
    chain = F
    for remainder, value in values.items():
        chain = chain.when(n % divisor == remainder, F.lit(value))
    return chain.otherwise(F.lit(default))


def page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` as archive records, all of them, in ``schema.RECORD``."""
    n = F.col("page_id")
    file_number = (n % 16).cast("string")
    is_text = n % 10 == 1
    payload = _by_remainder(n, 14, {
        0: "text/plain", 1: "application/pdf", 2: "application/xhtml+xml",
        3: "text/html; charset=utf-8", 4: None, 5: "image/png", 6: "text/css",
        7: "application/xml-dtd", 8: "text/plain; charset=utf-8",
        9: "application/json; charset=utf-8"}, "text/html")
    content = (F.when(n % 17 == 0, "").when(n % 13 == 0, F.concat("html", F.lit("\x01")))
               .otherwise(F.col("html")))
    rec_type = _by_remainder(n, 10, {0: "request", 1: "conversion"}, "response")
    headers = {
        "warc-type": rec_type, "warc-record-id": urn(n),
        "warc-refers-to": F.when(is_text, urn(n - 1)), "warc-target-uri": F.col("url"),
        "warc-date": F.concat(F.lit("2021-01-15T00:00:"),
                              F.lpad((n % 60).cast("string"), 2, "0"), F.lit("Z")),
        "warc-identified-payload-type": payload,
        "content-type": F.when(is_text, "text/plain").otherwise(
            "application/http; msgtype=response"),
        "content-length": F.octet_length(content).cast("string"),
    }
    entries = F.create_map(*[x for k, v in headers.items() for x in (F.lit(k), v)])
    return table(spark, sf_dir, "pages").select(
        F.concat(F.lit("crawl-data/C/segments/"), (n % 4).cast("string"), F.lit("/warc/f"),
                 file_number, F.lit(".warc.gz")).alias("file"),
        (n % 16).cast("int").alias("file_seq"), n.alias("rec_seq"),
        rec_type.alias("rec_type"),
        F.map_filter(entries, lambda k, v: v.isNotNull()).alias("headers"),
        F.lit(None).cast(RECORD["http_headers"].dataType).alias("http_headers"),
        content.cast("binary").alias("content"), F.lit(None).cast("binary").alias("raw"),
        F.lit(None).cast("string").alias("error"))


def page_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``path``: one archive per page."""
    n = F.col("page_id")
    return table(spark, sf_dir, "pages").select(F.concat(
        F.lit("crawl-data/C/segments/"), (n % 100).cast("string"), F.lit("/warc/f"),
        n.cast("string"), F.lit(".warc.gz")).alias("path"))


def labelled_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id``: the list of records that were labelled as good."""
    return table(spark, sf_dir, "labels").where("quality = 1").select(
        urn(F.col("doc_id")).alias("id"))


def document_pages(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """``documents`` as responses in ``schema.RECORD``, their ASCII moved to other writing systems
    and encoded in other character sets, which the page or its HTTP header declares."""
    plain = F.regexp_replace("text", r"[^\x01-\x7f]", "")
    content, http_type = F, F
    for i, (letters, charset, place) in enumerate(WRITTEN):
        start = {"meta": f'<meta http-equiv="Content-Type" content="text/html; charset={charset}">',
                 "xml": f'<?xml version="1.0" encoding="{charset}"?>', "mark": "\ufeff"}.get(place, "")
        moved = F.translate(plain, LATIN, letters)
        escaped = F.replace(F.replace(moved, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
        page = F.concat(F.lit(start + "<p>"), escaped, F.lit("</p>"))
        case = F.col("doc_id") % len(WRITTEN) == i
        content = content.when(case, F.call_function("encode", page, F.lit(charset)))
        http_type = http_type.when(case, f"text/html; charset={charset}" if place == "header" else "text/html")
    headers = F.create_map(
        F.lit("warc-type"), F.lit("response"), F.lit("warc-record-id"), urn(F.col("doc_id")),
        F.lit("warc-identified-payload-type"), F.lit("text/html"))
    with all_charsets(spark):
        return documents.select(
            F.lit("documents").alias("file"), F.lit(0).alias("file_seq"), F.col("doc_id").alias("rec_seq"),
            F.lit("response").alias("rec_type"), headers.alias("headers"),
            F.create_map(F.lit("content-type"), http_type).alias("http_headers"),
            content.alias("content"), F.lit(None).cast("binary").alias("raw"),
            F.lit(None).cast("string").alias("error"))
