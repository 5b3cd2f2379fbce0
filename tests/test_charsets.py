"""Declared character sets."""

import codecs

import pytest
from pyspark.sql import functions as F

from archives import record, write
from crawlcorpus.functions import charsets as CS
from crawlcorpus.plans import jobs


def _read(spark, content, content_type=None):
    frame = spark.createDataFrame([(content, content_type)], "content binary, type string")
    with CS.all_charsets(spark):
        read = frame.select(CS.declared_source(F.col("content"), F.col("type")))
    return read.first()[0]


@pytest.mark.parametrize("codec, name, text", [
    ("cp1251", "windows-1251", "Привет, мир"), ("koi8-r", "KOI8-R", "Привет, мир"),
    ("cp932", "Shift_JIS", "日本語テキスト①"), ("euc-jp", "x-euc-jp", "日本語テキスト"),
    ("iso2022-jp", "ISO-2022-JP", "日本語テキスト"), ("gbk", "gb2312", "简体中文镕"),
    ("gb18030", "gb18030", "简体中文𠀀"), ("big5", "Big5", "繁體中文"), ("cp949", "EUC-KR", "한국어 똠"),
    ("iso8859-7", "iso-8859-7", "Ελληνικά"), ("cp1255", "windows-1255", "עברית"),
    ("cp1256", "cp1256", "العربية"), ("cp874", "tis-620", "ภาษาไทย"), ("iso8859-2", "latin2", "Żółć"),
    ("cp1254", "iso-8859-9", "Türkçe ğış"), ("cp1252", "ISO-8859-1", "“Größe” – 5 €"),
    ("iso8859-15", "iso-8859-15", "5 €"), ("utf-8", "UTF-8", "Żółć 日本語"),
])
def test_declared(spark, codec, name, text):
    meta = f"<meta charset='{name}'>{text}"
    full = f'<html><head><META http-equiv=content-type content="text/html; charset={name}" />{text}'
    xml = f'<?xml version="1.0" encoding="{name}"?><p>{text}</p>'
    for page in (meta, full, xml):
        assert _read(spark, page.encode(codec)) == page
    assert _read(spark, text.encode(codec), f'text/html;Charset="{name}"') == text


def test_order_and_fallback(spark):
    utf8 = "<p>é</p>"
    # a mark wins over the header, the header over the page
    assert _read(spark, codecs.BOM_UTF16_LE + "да".encode("utf-16-le"), "text/html; charset=koi8-r") == "да"
    assert _read(spark, codecs.BOM_UTF16_BE + "да".encode("utf-16-be")) == "да"
    assert _read(spark, codecs.BOM_UTF8 + "да".encode(), "text/html; charset=koi8-r") == "да"
    page = "<meta charset=koi8-r>да".encode("cp1251")
    assert _read(spark, page, "text/html; charset=windows-1251").endswith("да")
    # unknown names, none, null types, UTF-8 that is not valid, UTF-16 in single bytes
    assert _read(spark, utf8.encode(), "text/html; charset=nobody-knows") == utf8
    assert _read(spark, utf8.encode("cp1252"), "text/html; charset=utf-8") == utf8
    assert _read(spark, utf8.encode(), None) == utf8 and _read(spark, None, None) is None
    assert _read(spark, b"", "text/html; charset=gbk") == ""
    assert _read(spark, ("<meta charset=utf-16>" + utf8).encode()).endswith(utf8)
    # bytes without a character
    assert _read(spark, b"a\x81", "text/html; charset=gbk") == "a�"
    # a declaration far into a long page is not one
    assert _read(spark, b" " * 5000 + b"<meta charset=koi8-r>\xc4") == " " * 5000 + "<meta charset=koi8-r>Ä"


def test_settings_are_restored(spark):
    name = "spark.sql.legacy.javaCharsets"
    with pytest.raises(ZeroDivisionError), CS.all_charsets(spark):
        assert spark.conf.get(name) == "true"
        1 / 0
    assert spark.conf.get(name) == "false"


def test_jobs_decode_pages(spark, tmp_path):
    cyrillic = "<html><head><meta charset=windows-1251></head><p>Привет</p></html>".encode("cp1251")
    write(tmp_path / "in" / "a.warc.gz", [record("response", "r", cyrillic)])
    assert jobs.convert(spark, [str(tmp_path / "in")], str(tmp_path / "out"))["output"] == 1
    assert spark.read.json(str(tmp_path / "out")).first().text == "Привет"
