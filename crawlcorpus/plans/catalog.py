"""One query per operator, over whole tables. ``oracles`` has the SQL of each."""

from pyspark.sql import DataFrame, functions as F

from ..functions import headers as H, html as HT, mime as M, paths as P, text as X
from ..functions.parsed import parsed_to_text
from ..operators import boilerplate as B, dedup as D, extraction as E, langid as L
from ..operators import manifest as MF, sampling as S, selection as SEL
from ..sources import sinks as K
from ..sources.members import chosen, member_index, read_members
from ..sources.warc import read_archives, register
from .physical import computed_once, fresh_path, materialize, spread
from .tables import document_pages, labelled_ids, page_archives, page_records, table, table_stream, urn

SUBSTRINGS = ["a1f", "07c", "e55", "3d9"]
STOP_WORDS = 50
SAMPLE_RATIO = 0.3


def _spread_records(spark, sf):
    return spread(page_records(spark, sf), "rec_seq")


def _pages(spark, sf):
    return spread(table(spark, sf, "pages"), "page_id")


def _documents(spark, sf):
    return spread(table(spark, sf, "documents"), "doc_id")


# --- headers, types, outcomes ------------------------------------------------------

def record_headers(spark, sf):
    return page_records(spark, sf).select(
        H.record_id().alias("record_id"), H.bare_id(H.record_id()).alias("bare_id"),
        H.uuid_of(H.record_id()).alias("uuid"), H.refers_to().alias("refers_to"),
        H.chosen_id(True).alias("chosen_id"),
        H.normalize_id(H.bare_id(H.record_id())).alias("normal_id"),
        H.target_uri().alias("target_uri"), H.payload_type().alias("payload_type"),
        H.mime_type().alias("mime"), H.record_date().alias("record_date"),
        H.content_length().alias("source_length"))


def mime_profile(spark, sf):
    mime = H.mime_type()
    return page_records(spark, sf).groupBy(
        mime.alias("mime"), M.is_plain(mime).alias("plain"),
        M.is_html_like(mime).alias("html_like"), M.is_unsupported(mime).alias("unsupported"),
    ).agg(F.count(F.lit(1)).alias("n"))


def record_outcomes(spark, sf):
    outcomes = E.conversion_outcomes(_spread_records(spark, sf))
    return outcomes.groupBy("rec_type", "outcome").agg(F.count(F.lit(1)).alias("n"))


def outcomes_by_file(spark, sf):
    sampled = E.conversion_outcomes(_spread_records(spark, sf), sample=SAMPLE_RATIO,
                                    seed=S.FIRST_SEED)
    return E.outcome_counts(sampled, "file").drop("unreadable")


def hash_outcomes(spark, sf):
    return E.outcome_counts(E.hash_outcomes(_spread_records(spark, sf))).drop("unreadable")


def extract_outcomes(spark, sf):
    found = E.response_outcomes(_spread_records(spark, sf), substrings=SUBSTRINGS,
                                markup_only=True)
    return found.groupBy("rec_type", "outcome").agg(F.count(F.lit(1)).alias("n"))


# --- id lists, samples ---------------------------------------------------------------

def _named(records):
    return records.select("rec_seq", "rec_type", H.record_id().alias("record_id"),
                          F.md5("content").alias("content_md5"))


def filter_by_ids(spark, sf):
    return _named(SEL.by_id_list(page_records(spark, sf), labelled_ids(spark, sf),
                                 H.chosen_id()))


def filter_by_refers_to(spark, sf):
    return _named(SEL.by_id_list(page_records(spark, sf), labelled_ids(spark, sf),
                                 H.chosen_id(True)))


def filter_by_id_substring(spark, sf):
    return _named(page_records(spark, sf).where(
        (F.col("rec_type") == "response") & E.id_contains(H.record_id(), SUBSTRINGS)))


def id_list_duplicates(spark, sf):
    listed = table(spark, sf, "conversations").select(urn(F.col("conv_id")).alias("id"))
    return SEL.repeated_ids(listed)


def distinct_ids(spark, sf):
    listed = table(spark, sf, "conversations").select(urn(F.col("conv_id")).alias("id"))
    return SEL.distinct_ids(listed)


def sample_records(spark, sf):
    return _named(S.bernoulli(page_records(spark, sf), H.record_id(), SAMPLE_RATIO))


def sample_responses(spark, sf):
    responses = page_records(spark, sf).where(
        (F.col("rec_type") == "response") & ~M.is_unsupported(H.mime_type()))
    seed = F.lit(S.FIRST_SEED) + F.lit(S.SEED_STEP) * F.col("file_seq")
    return _named(S.bernoulli(responses, H.record_id(), SAMPLE_RATIO, seed))


def extractor_assignment(spark, sf):
    return page_records(spark, sf).select(
        "rec_seq", S.choice(H.record_id(), E.RANDOM_EXTRACTORS).alias("extractor"))


# --- path lists ----------------------------------------------------------------------

def _existing(spark, sf):
    """Outputs there already: those of pages that were labelled as toxic."""
    n = F.col("doc_id")
    return table(spark, sf, "labels").where("toxic = 1").select(F.concat(
        F.lit("sampled/"), (n % 100).cast("string"), F.lit("/f"), n.cast("string"),
        F.lit(".warc.gz")).alias("out_path"))


def crawl_manifest(spark, sf):
    return MF.crawl_plan(page_archives(spark, sf), _existing(spark, sf), "sampled")


def pending_outputs(spark, sf):
    planned = page_archives(spark, sf).withColumn("out_path", F.regexp_replace(
        P.output_path(F.col("path"), F.lit("crawl-data/C/segments"), "sampled"), "/+", "/"))
    return MF.pending(planned, _existing(spark, sf)).select("path", "out_path")


def output_dirs(spark, sf):
    return MF.output_dirs(page_archives(spark, sf), "crawl-data/C/segments/")


def output_names(spark, sf):
    path = F.col("path")
    return page_archives(spark, sf).select(
        "path", P.basename(path).alias("base"), P.dirname(path).alias("dir"),
        P.with_suffix(path, ".warc.gz", ".tsv").alias("tsv"))


def common_prefix(spark, sf):
    return MF.common_prefix(table(spark, sf, "pages"), "url")


def common_prefix_dir(spark, sf):
    return MF.common_directory(page_archives(spark, sf), "path")


# --- text ------------------------------------------------------------------------------

def _page_text(extract):
    return lambda spark, sf: _pages(spark, sf).select(
        "page_id", extract(F.col("html")).alias("text"))


def normalize_space(spark, sf):
    return _documents(spark, sf).select("doc_id", X.normalize_space(F.col("text")).alias("text"))


def normalize_alpha(spark, sf):
    return _documents(spark, sf).select("doc_id", X.letters_only(F.col("text")).alias("text"))


def text_digest(spark, sf):
    text = F.col("text")
    return _documents(spark, sf).select(
        "doc_id", X.digest(text).alias("digest"), X.digest(text, True).alias("norm_digest"),
        F.hex(X.raw_digest(text)).alias("hex_digest"))


def convert_documents(spark, sf):
    outcomes = E.conversion_outcomes(_spread_records(spark, sf))
    return K.documents(outcomes).select("id", "text", "meta.*")


def convert_random_extractor(spark, sf):
    outcomes = E.conversion_outcomes(_spread_records(spark, sf), extractor="random")
    return K.documents(outcomes).select("id", F.md5("text").alias("text_md5"))


def extract_documents(spark, sf):
    return K.responses(E.response_outcomes(_spread_records(spark, sf))).select(
        "id", "meta.target_uri", "text")


def declared_charsets(spark, sf):
    """Documents as pages in the writing system and character set of their number, read again."""
    outcomes = E.conversion_outcomes(document_pages(spark, _documents(spark, sf)))
    return outcomes.select(F.col("rec_seq").alias("doc_id"), "outcome", F.md5("text").alias("text_md5"))


def hash_records(spark, sf):
    return K.hashes(E.hash_outcomes(_spread_records(spark, sf)))


# --- duplicates ------------------------------------------------------------------------

def _digests(spark, sf) -> DataFrame:
    docs = _documents(spark, sf).select(
        F.col("doc_id").alias("id"), "doc_id", X.raw_digest(F.col("text")).alias("digest"))
    return materialize(docs, "digests")


def duplicates(spark, sf):
    return D.find_duplicates(_digests(spark, sf), ["doc_id"])


def drop_duplicates(spark, sf):
    return D.drop_duplicates(_digests(spark, sf), ["doc_id"]).select(
        "id", F.hex("digest").alias("digest"))


def duplicates_indexed(spark, sf):
    """Documents of the sources after the first in name, against an index of the first."""
    docs = _documents(spark, sf)
    rows = materialize(docs.select(
        F.col("doc_id").alias("id"), "doc_id", "source",
        X.raw_digest(F.col("text")).alias("digest")), "digests")
    first = rows.agg(F.min("source")).scalar()
    index = D.first_seen(rows.where(F.col("source") == first), ["doc_id"])  # one without a source is later
    later = rows.where(~F.col("source").eqNullSafe(first))
    settled = materialize(D.against_index(later, index, ["doc_id"]), "settled")
    return D.duplicates_given(later, settled)


def duplicates_stream(spark, sf):
    from ..streaming.dedup import DuplicateStream
    rows = table_stream(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), "doc_id", X.raw_digest(F.col("text")).alias("digest"))
    stream = DuplicateStream(spark, fresh_path(spark, "stream"), rows.schema, ["doc_id"])
    stream.run(rows)
    return stream.duplicates().drop("batch")


def distinct_pages(spark, sf):
    """Which pages survive conversion and deduplication: one row per distinct text."""
    outcomes = E.conversion_outcomes(_spread_records(spark, sf)).where("outcome = 'ok'")
    digests = outcomes.select(
        *D.ORDER, H.bare_id(H.record_id()).alias("id"),
        X.raw_digest(X.letters_only(F.col("text"))).alias("digest"),
        F.length("text").cast("bigint").alias("n_chars"))
    return D.distinct_texts(digests).select(
        "id", F.base64("digest").alias("digest"), "n_copies", "n_chars")


# --- language --------------------------------------------------------------------------

def _model(spark, sf, **options) -> L.LanguageModel:
    """Trained on all labelled documents."""
    return L.train(_documents(spark, sf).select("lang", "text"), **options)


def line_words(spark, sf):
    return L.count_line_words(_documents(spark, sf), "doc_id")


def line_words_custom(spark, sf):
    return L.count_line_words(_documents(spark, sf), "doc_id", pattern="[a-z]+")


def lang_model(spark, sf):
    return _model(spark, sf).grams


def lang_model_words(spark, sf):
    """Scores of every training word, however rare."""
    return _model(spark, sf, max_words=1 << 40).words


def lang_line_scores(spark, sf):
    model = _model(spark, sf)
    scores = L.score_lines(table(spark, sf, "documents"), model, "doc_id")
    return L.top_labels(scores, model.languages, "doc_id", k=2)


def lang_keep(spark, sf):
    model = _model(spark, sf)
    texts = E.language_outcomes(_spread_records(spark, sf)).where("outcome = 'ok'").select(
        *D.ORDER, H.bare_id(H.record_id()).alias("id"), "text")
    return L.keep_decisions(texts, model, *D.ORDER, "id", target="fr").select(
        "id", "target_words", "total_words", "keep")


def lang_keep_documents(spark, sf):
    return L.keep_decisions(table(spark, sf, "documents"), _model(spark, sf), "doc_id",
                            target="de")


def lang_sample(spark, sf):
    """Sampled responses that are likely enough in the target language."""
    model = _model(spark, sf)
    drawn = S.bernoulli(_spread_records(spark, sf).where("rec_type = 'response'"),
                        H.record_id(), SAMPLE_RATIO)
    texts = E.response_outcomes(drawn).where("outcome = 'ok'").select(
        "rec_seq", H.record_id().alias("record_id"), "text")
    scores = L.score_documents(texts, model, "rec_seq", "record_id")
    return scores.where(L.in_language(model.languages, "fr")).select("rec_seq", "record_id")


# --- main text ---------------------------------------------------------------------------

def _stoplist(spark, sf) -> list[str]:
    """``STOP_WORDS`` of each language, as a parameter of the method."""
    words = B.stop_words(_documents(spark, sf), STOP_WORDS)
    return sorted({row.word for row in words.select("word").collect()})


def _classified(spark, sf):
    """``page_id`` and the classified paragraphs of each page that has any."""
    found = B.with_features(B.paragraph_array(F.col("html")), _stoplist(spark, sf))
    return computed_once(_pages(spark, sf), paragraphs=B.classified(found)).where("size(paragraphs) > 0")


def stop_words(spark, sf):
    return B.stop_words(_documents(spark, sf), STOP_WORDS)


def boilerplate_paragraphs(spark, sf):
    return _classified(spark, sf).select("page_id", F.inline("paragraphs")).select(
        "page_id", "pos", "tag", "text", "n_chars", "link_chars", "n_words", "n_stops",
        "cf_class", "class")


def main_text(spark, sf):
    return _classified(spark, sf).select("page_id", B.good_text(F.col("paragraphs")).alias("text"))


def main_text_outcomes(spark, sf):
    """Every record's outcome when markup is reduced to its main text."""
    found = E.conversion_outcomes(_spread_records(spark, sf), extractor="main", stoplist=_stoplist(spark, sf))
    return found.groupBy("rec_type", "outcome").agg(F.count(F.lit(1)).alias("n"))


def page_links(spark, sf):
    rows = B.paragraphs(_pages(spark, sf), "page_id")
    return rows.select("page_id", "pos", F.explode("hrefs").alias("href"))


# --- archives ----------------------------------------------------------------------------

def _archived(spark, sf):
    """The pages written as archives and read again."""
    register(spark)
    folder = fresh_path(spark, "archives")
    K.write_archives(_spread_records(spark, sf), folder)
    return read_archives(spark, folder)


def archive_round_trip(spark, sf):
    return _archived(spark, sf).select(
        H.record_id().alias("record_id"), "rec_type", H.mime_type().alias("mime"),
        H.target_uri().alias("target_uri"), F.md5("content").alias("content_md5"))


def archive_check(spark, sf):
    checked = E.verified(_archived(spark, sf))
    return checked.groupBy("status").agg(F.sum("n_records").alias("n_records"))


def filter_by_member_index(spark, sf):
    """As ``filter_by_ids``, over archives: ids are joined to an index, listed records read by place."""
    register(spark)
    folder = fresh_path(spark, "archives")
    K.write_archives(_spread_records(spark, sf), folder)
    index = materialize(member_index(spark, folder), "members")
    found = read_members(materialize(chosen(index, labelled_ids(spark, sf)), "places"))
    return found.select(H.record_id().alias("record_id"), "rec_type", F.md5("content").alias("content_md5"))


def archive_members(spark, sf):
    """What an index knows of the records of archives, of which all have a place."""
    register(spark)
    folder = fresh_path(spark, "archives")
    K.write_archives(_spread_records(spark, sf), folder)
    return member_index(spark, folder).select(
        F.col("id").alias("record_id"), "rec_type", "refers_to", F.col("offset").isNotNull().alias("has_place"))


QUERIES = {
    f.__name__: f for f in [
        record_headers, mime_profile, record_outcomes, outcomes_by_file, hash_outcomes,
        extract_outcomes, filter_by_ids, filter_by_refers_to, filter_by_id_substring,
        id_list_duplicates, distinct_ids, sample_records, sample_responses,
        extractor_assignment, crawl_manifest, pending_outputs, output_dirs, output_names,
        common_prefix, common_prefix_dir, normalize_space, normalize_alpha, text_digest,
        convert_documents, convert_random_extractor, extract_documents, declared_charsets, hash_records,
        duplicates, drop_duplicates, duplicates_indexed, duplicates_stream, distinct_pages,
        line_words, line_words_custom, lang_model,
        lang_model_words, lang_line_scores, lang_keep,
        lang_keep_documents, lang_sample, stop_words, boilerplate_paragraphs, main_text, main_text_outcomes,
        page_links, archive_round_trip, archive_check, filter_by_member_index, archive_members,
    ]
} | {
    "html_text_tags": _page_text(HT.tags_to_text),
    "html_text_blocks": _page_text(HT.blocks_to_text),
    "html_text_parser": _page_text(parsed_to_text),
    "clean_html": _page_text(HT.clean_html),
}
