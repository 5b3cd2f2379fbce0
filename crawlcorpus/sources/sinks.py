"""Output shapes and writers. Each writer is one map-only job with Spark's own commit."""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import headers as H, text as X
from .files import absolute


def documents(outcomes: DataFrame, *, refers_to: bool = False, prefix="commoncrawl:",
              carry: list[str] = ()) -> DataFrame:
    """``id, text, meta`` of converted records, after any columns to ``carry``."""
    id_ = H.prefixed_id(H.bare_id(H.chosen_id(refers_to)), prefix)
    return outcomes.where("outcome = 'ok'").select(
        *carry, id_.alias("id"), X.encodable(F.col("text")).alias("text"),
        H.document_meta().alias("meta"))


def responses(outcomes: DataFrame) -> DataFrame:
    """``id, meta, text`` of extracted responses, columns in sorted order."""
    return outcomes.where("outcome = 'ok'").select(
        H.record_id().alias("id"), F.struct(H.target_uri().alias("target_uri")).alias("meta"),
        X.encodable(F.col("text")).alias("text"))


def hashes(outcomes: DataFrame, *, refers_to: bool = False) -> DataFrame:
    """``id, digest`` of texts as they stand (already normalised or not)."""
    return outcomes.where("outcome = 'ok'").select(
        H.uuid_of(H.chosen_id(refers_to)).alias("id"), X.digest(F.col("text")).alias("digest"))


def write_jsonl(df: DataFrame, path: str, by: list[str] = ()) -> None:
    """JSON lines; NULL members are written, text is not escaped to ASCII."""
    df.write.partitionBy(*by).option("ignoreNullFields", "false").json(path)


def write_text(df: DataFrame, path: str, column: str = "text") -> None:
    df.select(column).write.text(path)


def write_tsv(df: DataFrame, path: str, by: list[str] = ()) -> None:
    """Tab-separated, no header, truth values as ``True`` and ``False``."""
    booleans = {name for name, kind in df.dtypes if kind == "boolean"}
    shown: list[Column] = [F.initcap(F.col(c).cast("string")).alias(c) if c in booleans
                           else F.col(c) for c in df.columns]
    df.select(*shown).write.partitionBy(*by).option("sep", "\t").option(
        "quote", "").csv(path)


def write_xml(df: DataFrame, path: str) -> None:
    """Structured texts: one ``doc`` per page with its paragraphs and links."""
    df.write.format("xml").option("rootTag", "corpus").option("rowTag", "doc").save(path)


def write_archives(records: DataFrame, path: str, input_root: str | None = None,
                   unread: str | None = None) -> None:
    """Archives again; with ``input_root``, in a tree that mirrors the inputs.

    Rows with an ``error`` are no records and are not written; a folder ``unread`` gets a
    list of them.
    """
    writer = records.write.format("warc").mode("append")
    for name, value in (("inputRoot", input_root), ("unreadPath", unread)):
        if value is not None:
            writer = writer.option(name, absolute(value))
    writer.save(absolute(path))
