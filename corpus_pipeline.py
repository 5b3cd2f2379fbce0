"""Documents through the stages of a training corpus: quality rules, toxicity, near
duplicates, repeated passages, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before kept. The
result of each is written to the shared folder and read again before the next begins. All
but the last return the columns of ``documents``.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from crawlcorpus.llm import debruijn, minhash, packing, quality, toxicity
from crawlcorpus.llm.catalog import TOKENIZER
from crawlcorpus.llm.storage import stored
from crawlcorpus.plans.tables import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go from the texts, rejected documents go whole."""
    return quality.filtered(docs)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go whose score is a half or more. All labels of these documents are learned
    from; the score itself reads only texts."""
    field = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    # scores and texts stay in one row, so no join is needed to filter
    return toxicity.filtered(docs, field)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: that of the smallest id."""
    gone = minhash.near_duplicates(docs, k=5, percent=80).where("not kept").select(
        F.col("doc_id").alias("_gone"))
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that an earlier document has go from the texts."""
    return debruijn.removed(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each piece of each document with its token ids and its place in a sequence. The workers
    of a session go on to other stages and runs, so they give their caches back."""
    return packing.packed(docs, TOKENIZER, with_ids=True, keep_cache=False)


STAGES = [("quality rules", quality_rules), ("toxicity", toxicity_filter),
          ("near dedup", near_dedup), ("substring dedup", substring_dedup),
          ("packing", packing_stage)]

#: Graphs, trained models and tokenizers are beyond SQL; tests use brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
