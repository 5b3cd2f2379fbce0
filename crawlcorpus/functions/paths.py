"""Path expressions."""

from pyspark.sql import Column, functions as F


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def dirname(path: Column) -> Column:
    """Everything before the last slash, '' if there is none; a root stays a root."""
    head = F.regexp_extract(path, "(?s)^(.*/)[^/]*$", 1)
    return F.when(head.rlike("^/+$"), head).otherwise(F.regexp_replace(head, "/+$", ""))


def without_prefix(path: Column, prefix: Column) -> Column:
    rest = F.when(path.startswith(prefix), F.substring(path, F.length(prefix) + 1,
                                                       F.length(path))).otherwise(path)
    return F.regexp_replace(rest, "^/", "")


def relative_dir(path: Column, root: str) -> Column:
    below = dirname(without_prefix(path, F.lit(root.rstrip("/") + "/")))
    return F.when(below == "", ".").otherwise(below)


def with_suffix(path: Column, old: str, new: str) -> Column:
    return F.when(path.endswith(old), F.concat(
        F.substring(path, F.lit(1), F.length(path) - len(old)), F.lit(new))).otherwise(path)


def output_path(path: Column, prefix: Column, out_dir: str) -> Column:
    """Where a crawl path's output goes: no common prefix, no ``/warc`` directory."""
    below = F.regexp_replace(without_prefix(dirname(path), prefix), "/warc$", "")
    return F.concat_ws("/", F.lit(out_dir), F.nullif(below, F.lit("")), basename(path))
