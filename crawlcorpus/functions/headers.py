"""Header accessors, record ids and output ids."""

from pyspark.sql import Column, functions as F


def header(name: str, headers="headers") -> Column:
    """A record header, NULL when absent. The scan lower-cases header names."""
    return F.col(headers)[name.lower()]


def target_uri() -> Column:
    return header("WARC-Target-URI")


def record_id() -> Column:
    return header("WARC-Record-ID")


def refers_to() -> Column:
    return header("WARC-Refers-To")


def payload_type() -> Column:
    return header("WARC-Identified-Payload-Type")


def record_date() -> Column:
    return header("WARC-Date")


def content_length() -> Column:
    """The declared block length; NULL when it is not a number."""
    return F.expr("try_cast(headers['content-length'] as bigint)")


def mime_type() -> Column:
    """Identified payload type, else the record's own content type."""
    return F.coalesce(payload_type(), header("Content-Type"))


def http_content_type() -> Column:
    """The content type that the server gave; NULL for records that hold no HTTP headers."""
    return header("Content-Type", "http_headers")


def chosen_id(use_refers_to: bool = False) -> Column:
    """Extracted text (WET) names its source record in Refers-To."""
    return refers_to() if use_refers_to else record_id()


def _unwrapped(id_: Column, prefix: str) -> Column:
    pattern = rf"(?s)^<{prefix}(.*)>$"
    return F.when(id_.rlike(pattern), F.regexp_extract(id_, pattern, 1))


def bare_id(id_: Column) -> Column:
    """``<x>`` to ``x``; NULL when not in angle brackets."""
    return _unwrapped(id_, "")


def uuid_of(id_: Column) -> Column:
    """``<urn:uuid:x>`` to ``x``; NULL for anything else."""
    return _unwrapped(id_, "urn:uuid:")


def normalize_id(id_: Column) -> Column:
    """One spelling for ids written ``<urn:uuid:x>``, ``urn:uuid:x`` or ``x``."""
    return F.regexp_replace(F.trim(id_), r"^<?(?:urn:uuid:)?|>$", "")


def prefixed_id(id_: Column, prefix: str = "commoncrawl:") -> Column:
    return F.concat(F.lit(prefix), id_)


def document_meta() -> Column:
    return F.struct(
        target_uri().alias("uri"),
        mime_type().alias("source_type"),
        record_date().alias("download_date"),
        content_length().alias("source_length"),
    )
