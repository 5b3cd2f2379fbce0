"""Path lists: what to read, what is left to do, where output goes."""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import paths as P
from ..plans.physical import with_place
from .sampling import FIRST_SEED, SEED_STEP


def common_prefix(strings: DataFrame, column: str = "value") -> DataFrame:
    """``prefix``: the longest common prefix of all strings, '' if there are none.

    It is the common prefix of the least and the greatest, so one aggregate with one
    row per task decides it.
    """
    ends = strings.agg(F.min(column).alias("a"), F.max(column).alias("b"))
    # the number of leading characters that agree: the first position that does not
    positions = F.sequence(F.lit(1), F.greatest(F.length("a"), F.lit(1)))
    agree = F.filter(positions, lambda i: F.substring(F.col("a"), F.lit(1), i)
                     == F.substring(F.col("b"), F.lit(1), i))
    return ends.select(F.coalesce(
        F.substring(F.col("a"), F.lit(1), F.coalesce(F.array_max(agree), F.lit(0))),
        F.lit("")).alias("prefix"))


def common_directory(strings: DataFrame, column: str = "value") -> DataFrame:
    return common_prefix(strings, column).select(P.dirname(F.col("prefix")).alias("prefix"))


def pending(manifest: DataFrame, existing: DataFrame, column: str = "out_path") -> DataFrame:
    """Inputs whose output does not exist yet. Spark picks the join by measured size."""
    return manifest.join(existing.select(column), column, "left_anti")


def first_inputs(manifest: DataFrame, limit: int, column: str = "path") -> DataFrame:
    """At most ``limit`` inputs, in path order: a top-k, not a full sort."""
    return manifest.orderBy(column).limit(limit)


def with_seeds(chosen: DataFrame, column: str = "path", first: int = FIRST_SEED,
               step: int = SEED_STEP) -> DataFrame:
    """A seed per input by its place in path order."""
    seed = F.lit(first) + F.lit(step) * F.col("_place")
    return with_place(chosen, column, "_place").withColumn("seed", seed).drop("_place")


def crawl_plan(manifest: DataFrame, existing: DataFrame, out_dir: str,
               limit: int | None = None,
               prefix: str | Column | None = None) -> DataFrame:
    """``path, out_path, seed`` of the next run over a crawl's archives: all that are left,
    or the first ``limit`` of them.

    ``prefix`` is the common directory of all paths; computed here if not given.
    """
    if prefix is None:
        prefix = common_directory(manifest, "path").scalar()
    prefix = F.lit(prefix) if isinstance(prefix, str) else prefix
    planned = manifest.withColumn("out_path", P.output_path(F.col("path"), prefix, out_dir))
    todo = pending(planned, existing)
    chosen = todo if limit is None else first_inputs(todo, limit)
    return with_seeds(chosen).select("path", "out_path", "seed")


def output_dirs(manifest: DataFrame, root: str) -> DataFrame:
    """``rel_dir``: the directories below ``root`` that hold inputs."""
    return manifest.select(P.relative_dir(F.col("path"), root).alias("rel_dir")).distinct()
