"""The programs: archives in, corpus files out.

Each job reads its inputs once, writes with Spark's commit protocol, and returns the
counters that it gathered on the way. Inputs are files and folders, in the order given.
"""

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..functions import headers as H, mime as M, text as X
from ..operators import boilerplate as B, dedup as D, extraction as E, langid as L
from ..operators import manifest as MF, sampling as S, selection as SEL
from ..schema import MEMBER, RECORD_KEY
from ..sources import lists, sinks as K
from ..sources.files import absolute
from ..sources.members import chosen, member_index, read_members
from ..sources.warc import read_archives, read_listed, register
from ..streaming.dedup import DuplicateStream
from .physical import fresh_path, materialize


#: What archives at fault do to a job: a row that is counted as unreadable, nothing, or its end.
MODES = ["PERMISSIVE", "DROPMALFORMED", "FAILFAST"]


def check(spark: SparkSession, inputs: list[str], mode: str = MODES[0]) -> DataFrame:
    """``file, status, n_records, message`` of each archive. No payload is decoded or kept."""
    return E.verified(read_archives(spark, *inputs, content="false", httpHeaders="false", mode=mode))


def index(spark: SparkSession, inputs: list[str], output: str, mode: str = MODES[0]) -> None:
    """The place and ids of each record, as a table that ``filter_by_ids`` can read from."""
    member_index(spark, *inputs, mode=mode).write.parquet(output)


def report(checked: DataFrame) -> DataFrame:
    """``value``: one line per archive."""
    ok = F.concat_ws(" ", F.lit("OK:"), F.col("n_records").cast("string"), F.lit("records"))
    bad = F.concat_ws(" ", F.lit("ERROR:"), "message")
    line = F.concat_ws(": ", "file", F.when(F.col("status") == "OK", ok).otherwise(bad))
    return checked.select(line.alias("value"))


def convert(spark: SparkSession, inputs: list[str], output: str, *, extractor="blocks",
            html: bool = False, refers_to: bool = False, sample: float | None = None,
            seed: int = S.FIRST_SEED, text_only: bool = False, prefix: str = "commoncrawl:",
            stoplist: list[str] = (), mode: str = MODES[0]) -> dict:
    """Records to JSON lines (or bare text). ``extractor="main"`` needs ``stoplist``, and
    ``random`` draws from main text too if it is given."""
    seen = Observation("convert")
    records = read_archives(spark, *inputs, mode=mode)
    outcomes = E.observed(E.conversion_outcomes(
        records, refers_to=refers_to, sample=sample, seed=seed,
        extractor="html" if html else extractor, stoplist=stoplist), seen)
    documents = K.documents(outcomes, refers_to=refers_to, prefix=prefix)
    (K.write_text if text_only else K.write_jsonl)(documents, output)
    return seen.get


def compute_hashes(spark: SparkSession, inputs: list[str], output: str, *,
                   refers_to: bool = False, normalize: bool = True, mode: str = MODES[0]) -> dict:
    """``id, digest`` of each text, tab-separated."""
    seen = Observation("hashes")
    outcomes = E.observed(E.hash_outcomes(read_archives(spark, *inputs, mode=mode), refers_to=refers_to,
                                          normalize=normalize), seen)
    K.write_tsv(K.hashes(outcomes, refers_to=refers_to), output)
    return seen.get


def extract_text(spark: SparkSession, inputs: list[str], output: str, *,
                 ids: str | None = None, raw: bool = False, xml: bool = False,
                 mode: str = MODES[0]) -> dict:
    """Texts of responses as JSON lines, bare text, or XML with headings and links."""
    seen = Observation("extract")
    outcomes = E.observed(E.response_outcomes(
        read_archives(spark, *inputs, mode=mode), substrings=ids.split(",") if ids else None,
        markup_only=xml, extractor="html" if xml else "blocks"), seen)
    if xml:
        K.write_xml(outcomes.where("outcome = 'ok'").select(
            H.record_id().alias("_id"), B.structured(F.col("text")).alias("paragraph")), output)
    else:
        (K.write_text if raw else K.write_jsonl)(K.responses(outcomes), output)
    return seen.get


def sample_responses(spark: SparkSession, ratio: float, inputs: list[str], output: str, *,
                     seed: int | None = None, language: str | None = None,
                     lang_prob: float = L.DOCUMENT_PROB, model: L.LanguageModel | None = None,
                     input_root: str | None = None, mode: str = MODES[0]) -> dict:
    """A sample of supported responses, as archives; of one language if asked (``any`` is
    none in particular). Returns the counters.

    Without ``seed`` each input has its own, by its place in path order.
    """
    records = read_archives(spark, *inputs, keepRaw="true", recordTypes="response", mode=mode)
    return _write_sample(records, ratio, output, seed, language, lang_prob, model, input_root)


def _write_sample(records, ratio, output, seed, language, lang_prob, model, input_root,
                  unread=None) -> dict:
    register(records.sparkSession)
    seeds = F.lit(seed) if seed is not None else (
        F.lit(S.FIRST_SEED) + F.lit(S.SEED_STEP) * F.col("file_seq"))
    outcome = (F.when(F.col("error").isNotNull(), "unreadable")
               .when(F.coalesce(M.is_unsupported(H.mime_type()), F.lit(True)), "unsupported")
               .when(~F.coalesce(S.drawn(H.record_id(), ratio, seeds), F.lit(False)), "notsampled")
               .otherwise("output"))
    seen = Observation("sample")
    marked = records.where("error is not null or rec_type = 'response'").withColumn("_outcome", outcome)
    marked = marked.observe(seen, F.count(F.lit(1)).alias("total"), *[
        F.count_if(F.col("_outcome") == name).alias(name)
        for name in ("unreadable", "unsupported", "notsampled", "output")])
    # what could not be read goes on to the writer, which lists it
    drawn = marked.where("_outcome in ('unreadable', 'output')").drop("_outcome")
    counts = {}
    if language not in (None, "any"):
        # The sample is read twice, once for its text: do not draw it from the crawl again.
        drawn = materialize(drawn, "drawn")
        texts = E.response_outcomes(drawn).where("outcome = 'ok'").select(*RECORD_KEY, "text")
        scores = L.score_documents(texts, model, *RECORD_KEY)
        chosen = materialize(scores.where(L.in_language(model.languages, language, lang_prob))
                             .select(*RECORD_KEY), "chosen")
        counts["output"] = chosen.count()
        counts["notlang"] = drawn.where("error is null").count() - counts["output"]
        kept = drawn.where("error is null").join(chosen, RECORD_KEY, "left_semi")
        drawn = kept.unionByName(drawn.where("error is not null"))
        # rows of one input together again, so that the tree can be mirrored
        drawn = drawn.repartition("file").sortWithinPartitions("file", "rec_seq")
    K.write_archives(drawn, output, input_root, unread)
    return seen.get | counts


def filter_by_ids(spark: SparkSession, ids: str, inputs: list[str], output: str, *,
                  refers_to: bool = False, input_root: str | None = None,
                  index: str | None = None, mode: str = MODES[0]) -> dict:
    """Records whose id a file lists, as archives. Returns the counters.

    With an ``index`` of the inputs only listed records are read, and only ids are joined, whatever
    the length of the list; ``inputs`` are then not looked at.
    """
    if index is not None:
        places, kept = spark.read.schema(MEMBER).parquet(index), Observation("kept")
        found = materialize(chosen(places, lists.id_list(spark, ids), F.col("refers_to" if refers_to else "id")), "places")
        records = read_members(found, together=input_root is not None, keepRaw="true", content="false",
                               httpHeaders="false")
        K.write_archives(records.observe(kept, F.count(F.lit(1)).alias("output")), output, input_root)
        return {"total": places.count()} | kept.get
    read, kept = Observation("read"), Observation("kept")
    records = read_archives(spark, *inputs, keepRaw="true", content="false", httpHeaders="false",
                            mode=mode).observe(
        read, F.count_if(F.col("error").isNull()).alias("total"),
        F.count_if(F.col("error").isNotNull()).alias("unreadable"))
    listed = SEL.by_id_list(records.where("error is null"), lists.id_list(spark, ids),
                            H.chosen_id(refers_to))
    K.write_archives(listed.observe(kept, F.count(F.lit(1)).alias("output")), output, input_root)
    return read.get | kept.get


def find_duplicates(spark: SparkSession, inputs: list[str], base: str, mode: str = MODES[0],
                    seen: Observation | None = None) -> DataFrame:
    """``id, first_id`` of responses whose text was seen before, in this run or an earlier
    one with the same ``base`` folder. The text is hashed as it is. ``seen`` gets the counters."""
    outcomes = E.observed(E.duplicate_outcomes(read_archives(spark, *inputs, mode=mode)),
                          seen or Observation("duplicates"))
    texts = outcomes.where("outcome = 'ok'")
    digests = texts.select(*D.ORDER, H.record_id().alias("id"),
                           X.raw_digest(F.col("text")).alias("digest"))
    index = DuplicateStream(spark, base, digests.schema)
    number = index.add(digests)
    return index.duplicates().where(F.col("batch") == number).select("id", "first_id")


def select_language(spark: SparkSession, model: L.LanguageModel, inputs: list[str],
                    output: str, *, label: str = L.TARGET, mode: str = MODES[0], **options) -> dict:
    """``id, target_words, total_words, keep`` of each text, tab-separated."""
    seen = Observation("language")
    outcomes = E.observed(E.language_outcomes(read_archives(spark, *inputs, mode=mode)), seen)
    texts = outcomes.where("outcome = 'ok'").select(
        *RECORD_KEY, H.bare_id(H.record_id()).alias("id"), "text")
    kept = L.keep_decisions(texts, model, *RECORD_KEY, "id", target=label, **options)
    K.write_tsv(kept.select("id", "target_words", "total_words", "keep"), output)
    return seen.get


def sample_crawl(spark: SparkSession, manifest: DataFrame, ratio: float, out_dir: str, *,
                 base: str = "", language: str | None = None,
                 lang_prob: float = L.DOCUMENT_PROB, model: L.LanguageModel | None = None,
                 limit: int | None = None, counts: dict | None = None) -> DataFrame:
    """Sample the archives of a crawl's path list whose samples do not exist yet.

    ``base`` is put before each path to make an address. Returns the plan of this run:
    ``path, out_path, seed``, one row per archive. An archive that could not be read to its
    end is not marked as finished, so a later run plans it again. ``counts`` gets the counters.
    """
    out_dir = absolute(out_dir)
    existing = lists.finished_outputs(spark, out_dir)
    plan = materialize(MF.crawl_plan(manifest, existing, out_dir, limit), "plan")
    place = ((F.col("seed") - S.FIRST_SEED) / S.SEED_STEP).cast("int")
    todo = plan.select(F.concat(F.lit(base), "path").alias("path"), place.alias("file_seq"),
                       F.col("out_path").alias("name"))
    records = read_listed(todo, keepRaw="true", recordTypes="response")
    unread = fresh_path(spark, "unread")
    found = _write_sample(records, ratio, out_dir, None, language, lang_prob, model, out_dir, unread)
    if counts is not None:
        counts.update(found)
    failed = spark.read.schema("file string, error string").json(unread)
    done = plan.join(failed.select(F.col("file").alias("out_path")), "out_path", "left_anti")
    lists.mark_finished(done.select("out_path"), out_dir)
    return plan
