"""Record and output schemas, and the vocabularies every operator shares."""

from pyspark.sql import types as T

_STRINGS = T.MapType(T.StringType(), T.StringType())

#: One archive record. ``(file_seq, rec_seq)`` is unique and gives the archive order,
#: which Spark rows do not have on their own.
RECORD = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("file_seq", T.IntegerType()),
    T.StructField("rec_seq", T.LongType()),
    T.StructField("rec_type", T.StringType()),
    T.StructField("headers", _STRINGS),
    T.StructField("http_headers", _STRINGS),
    T.StructField("content", T.BinaryType()),
    T.StructField("raw", T.BinaryType()),
    T.StructField("error", T.StringType()),
])

#: Where a record stands in its archive, and what to choose it by.
MEMBER = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("file_seq", T.IntegerType()),
    T.StructField("rec_seq", T.LongType()),
    T.StructField("offset", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("rec_type", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("refers_to", T.StringType()),
])

#: Columns that identify a record wherever its id may be missing or repeated.
RECORD_KEY = ["file_seq", "rec_seq"]

# MIME types by treatment.
PLAIN_TYPES = ["text/plain"]
HTML_LIKE_TYPES = ["text/html", "application/xhtml+xml", "application/xml", "application/http"]
UNSUPPORTED_TYPES = [
    "application/pdf", "application/rtf", "application/rdf+xml", "application/atom+xml",
    "application/rss+xml", "application/json", "application/octet-stream",
    "application/zip", "text/calendar",
]
UNSUPPORTED_MAIN_TYPES = ["image", "audio", "video", "application"]

# HTML elements that do not break a line (<br> does).
INLINE_ELEMENTS = [
    "a", "abbr", "acronym", "audio", "b", "bdi", "bdo", "big", "button", "canvas", "cite",
    "code", "data", "datalist", "del", "dfn", "em", "embed", "i", "iframe", "img", "input",
    "ins", "kbd", "label", "map", "mark", "meter", "noscript", "object", "output", "picture",
    "progress", "q", "ruby", "s", "samp", "script", "select", "slot", "small", "span",
    "strong", "sub", "sup", "svg", "template", "textarea", "time", "u", "tt", "var", "video",
    "wbr",
]

# Character classes, written out so that every regex engine agrees.
# SPACE is what str.split() splits on; LETTER is [^\W\d_]; WORD is \w.
SPACE = (r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
         r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
# SPACE_IN_LINE is SPACE without the newline, with the separators as one category: most
# characters of a text are tested against it, and each range is a test of its own.
SPACE_IN_LINE = r"\p{Z}\x09\x0b-\x0d\x1c-\x1f\x{85}"
LETTER = r"\p{L}\p{Nl}\p{No}"
WORD = r"\p{L}\p{N}_"
SPACES = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
