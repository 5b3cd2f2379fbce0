"""Character sets that pages declare.

A page's bytes are decoded by the first of: a byte order mark, the ``charset`` of its HTTP content
type, what its own first bytes declare (``<meta>`` or an XML declaration). Without any, with a name
nobody knows, with UTF-8 or with windows-1252 (which stands on many pages that are UTF-8), they are
UTF-8 if valid and windows-1252 otherwise.
Bytes that a declared set has no character for become U+FFFD.

The decoding is Spark's own ``decode`` with the set's name as a column, so one branch serves all sets.
Spark allows it other sets than seven only by two settings, which an expression takes over when it is
resolved: build the DataFrame inside ``all_charsets``; the settings are then as they were.
"""

from contextlib import contextmanager

from pyspark.sql import Column, SparkSession, functions as F

from .text import html_source

#: So many bytes of a page are searched for a declaration.
DECLARATION_BYTES = 4096

# Names that pages use, by the set that is meant, as the JVM calls it. Pages that
# declare a smaller set mean the larger one which browsers read instead.
CHARSETS = {
    "UTF-8": "utf-8 utf8 unicode-1-1-utf-8",
    "UTF-16LE": "utf-16le utf-16 unicode ucs-2 iso-10646-ucs-2",
    "UTF-16BE": "utf-16be unicodefffe",
    "windows-1250": "windows-1250 cp1250 x-cp1250",
    "windows-1251": "windows-1251 cp1251 x-cp1251 win-1251",
    "windows-1252": "windows-1252 cp1252 x-cp1252 iso-8859-1 iso8859-1 iso88591 latin1 l1 us-ascii ascii",
    "windows-1253": "windows-1253 cp1253 x-cp1253",
    "windows-1254": "windows-1254 cp1254 x-cp1254 iso-8859-9 iso8859-9 latin5 l5",
    "windows-1255": "windows-1255 cp1255 x-cp1255",
    "windows-1256": "windows-1256 cp1256 x-cp1256",
    "windows-1257": "windows-1257 cp1257 x-cp1257",
    "windows-1258": "windows-1258 cp1258 x-cp1258",
    "x-windows-874": "windows-874 dos-874 iso-8859-11 iso8859-11 tis-620",
    "ISO-8859-2": "iso-8859-2 iso8859-2 latin2 l2",
    "ISO-8859-3": "iso-8859-3 iso8859-3 latin3 l3",
    "ISO-8859-4": "iso-8859-4 iso8859-4 latin4 l4",
    "ISO-8859-5": "iso-8859-5 iso8859-5 cyrillic",
    "ISO-8859-6": "iso-8859-6 iso8859-6 arabic asmo-708",
    "ISO-8859-7": "iso-8859-7 iso8859-7 greek greek8",
    "ISO-8859-8": "iso-8859-8 iso8859-8 iso-8859-8-i hebrew visual",
    "ISO-8859-13": "iso-8859-13 iso8859-13",
    "ISO-8859-15": "iso-8859-15 iso8859-15 latin9 l9",
    "ISO-8859-16": "iso-8859-16 iso8859-16",
    "IBM866": "ibm866 cp866 866 csibm866",
    "KOI8-R": "koi8-r koi8 koi koi8_r",
    "KOI8-U": "koi8-u koi8-ru",
    "x-MacRoman": "macintosh mac x-mac-roman",
    "x-MacCyrillic": "x-mac-cyrillic x-mac-ukrainian",
    "windows-31j": "shift_jis shift-jis sjis x-sjis ms_kanji windows-31j cp932",
    "EUC-JP": "euc-jp x-euc-jp",
    "ISO-2022-JP": "iso-2022-jp",
    "GBK": "gbk gb2312 gb_2312-80 x-gbk cp936 chinese",
    "GB18030": "gb18030",
    "Big5-HKSCS": "big5 big5-hkscs cn-big5 x-x-big5",
    "x-windows-949": "euc-kr ks_c_5601-1987 ks_c_5601-1989 ksc5601 korean windows-949 cp949",
}


#: Read as any page is that declares nothing: UTF-8 if valid, else windows-1252.
PLAIN_CHARSETS = ["UTF-8", "windows-1252"]

_DECLARATION = (r"""(?i)(?:<meta\s[^>]*?\bcharset|^\s*<\?xml\s[^>]*?\bencoding)"""
                r"""\s*=\s*["']?\s*([^\s"'/>;]+)""")


def _lookup(key: Column, table: dict) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for entry in table.items() for x in entry]), key)


def known_charset(name: Column, but: dict = {}) -> Column:
    """The JVM's name of a declared set, or what stands for that; NULL for a name that is not known."""
    return _lookup(F.lower(name), {n: but.get(jvm, jvm) for jvm, names in CHARSETS.items()
                                   for n in names.split()})


def header_charset(content_type: Column) -> Column:
    """The set that a content type such as ``text/html; charset="x"`` names."""
    return known_charset(F.regexp_extract(content_type, r"""(?i)\bcharset\s*=\s*["']?\s*([^\s"';,]+)""", 1))


def inner_charset(content: Column) -> Column:
    """The set that a page's first bytes name. A page whose declaration can be read byte by byte
    is not UTF-16, whatever it says."""
    start = F.decode(F.substring(content, 1, DECLARATION_BYTES), "ISO-8859-1")
    return known_charset(F.regexp_extract(start, _DECLARATION, 1), {"UTF-16LE": "UTF-8", "UTF-16BE": "UTF-8"})


def marked_charset(content: Column) -> Column:
    """The set of a byte order mark."""
    mark = F.hex(F.substring(content, 1, 3))
    return (F.when(mark == "EFBBBF", "UTF-8").when(mark.startswith("FFFE"), "UTF-16LE")
            .when(mark.startswith("FEFF"), "UTF-16BE"))


def charset_of(content: Column, content_type: Column) -> Column:
    return F.coalesce(marked_charset(content), header_charset(content_type), inner_charset(content))


def declared_source(content: Column, content_type: Column) -> Column:
    """Bytes as markup, by what is declared. Resolve it inside ``all_charsets``."""
    others = {jvm: jvm for jvm in CHARSETS if jvm not in PLAIN_CHARSETS}
    decoded = F.call_function("decode", content, _lookup(charset_of(content, content_type), others))
    return F.ltrim(F.coalesce(decoded, html_source(content)), F.lit("\ufeff"))


@contextmanager
def all_charsets(spark: SparkSession):
    """Within, ``encode`` and ``decode`` know every set of the JVM and replace what they cannot map."""
    names = ["spark.sql.legacy.javaCharsets", "spark.sql.legacy.codingErrorAction"]
    before = {name: spark.conf.get(name) for name in names}
    try:
        for name in names:
            spark.conf.set(name, "true")
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
