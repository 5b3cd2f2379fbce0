"""One query per operator, over the whole ``documents`` table, with production parameters."""

import public_tokenizers
from pyspark.sql import functions as F

from ..plans.tables import table
from . import (bytepairs, debruijn, divergence, fingerprints, language, minhash, mixing, packing, periodic,
               quality, sharding, tokens, toxicity)
from .oracles import ORACLES  # noqa: F401  of those that SQL can express

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def _documents(spark, sf):
    return table(spark, sf, "documents")


def op1_document_fingerprints(spark, sf):
    return fingerprints.edit_report(_documents(spark, sf))


def op2_toxicity(spark, sf):
    docs = _documents(spark, sf)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    field = toxicity.fit(docs, table(spark, sf, "labels"), learn=~held_out)
    return toxicity.score(docs, field).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted", "spans")


def op3_minhash_near_duplicates(spark, sf):
    return minhash.near_duplicates(_documents(spark, sf), k=3, percent=85)


def op4_quality_rules(spark, sf):
    return quality.judged(_documents(spark, sf))


def op5_best_fit_packing(spark, sf):
    return packing.checksums(packing.placed(_documents(spark, sf), TOKENIZER, keep_cache=False))


def op6_language_id(spark, sf):
    docs = _documents(spark, sf)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    found = language.predict(docs, language.fit(docs, learn=~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op7_byte_pair_encoding(spark, sf):
    vocabulary = {"ranks": RANKS, "pattern": public_tokenizers.PATTERN}
    return bytepairs.digests(bytepairs.encode(_documents(spark, sf), **vocabulary), **vocabulary)


def op8_sharding(spark, sf):
    return sharding.sharded(_documents(spark, sf))


def op9_substring_dedup(spark, sf):
    return debruijn.repeated_words(_documents(spark, sf))


def op10_token_files(spark, sf):
    folder = tokens.fresh_folder(spark)
    tokens.write_token_files(_documents(spark, sf), folder, TOKENIZER)
    return tokens.checksums(tokens.read_token_files(spark, folder, raw=True))


def op11_periodic_runs(spark, sf):
    return periodic.digests(periodic.runs(periodic.with_planted_runs(_documents(spark, sf))))


def op12_source_divergence(spark, sf):
    return divergence.audit(_documents(spark, sf))


def op13_source_mixing(spark, sf):
    return mixing.taken(_documents(spark, sf))


QUERIES = {name: f for name, f in list(globals().items()) if name.startswith("op")}
