"""Toxicity and language: parts against brute force, wholes on held-out documents."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from crawlcorpus.llm import language, toxicity
from crawlcorpus.llm.catalog import QUERIES

LARGER = "/root/testdata/sf0.1"


# --- language ------------------------------------------------------------------------

def cross_parse(reference: bytes, text: bytes) -> int:
    count, at = 0, 0
    while at < len(text):
        to = at + 1
        while to < len(text) and text[at:to + 1] in reference:
            to += 1
        at, count = to, count + 1
    return count


def _counted(reference, texts):
    bounds = np.cumsum([0, *map(len, texts)])
    return language.phrases(language.automaton(reference), np.frombuffer(b"".join(texts), np.uint8), bounds).tolist()


def test_phrases_are_longest_matches(monkeypatch):
    rng = random.Random(5)
    for piece in (1, 2, 7, 64):  # most texts are longer than a piece, some than many
        monkeypatch.setattr(language, "PIECE", piece)
        for _ in range(40):
            reference = bytes(rng.choices(b"ab c", k=rng.randint(1, 60)))
            texts = [bytes(rng.choices(b"ab cd", k=rng.randint(1, 90))) for _ in range(12)]
            assert _counted(reference, texts) == [cross_parse(reference, t) for t in texts]
    # a text whose parse from its beginning meets no other for long, and one of a single phrase
    reference = b"ab" * 300
    texts = [b"ba" * 290, b"ab" * 5, b"x" * 200, b"ab" * 299 + b"xb" + b"ba" * 250]
    monkeypatch.setattr(language, "PIECE", 16)
    assert _counted(reference, texts) == [cross_parse(reference, t) for t in texts]


def test_language_equals_brute_force(spark):
    """The whole query's rule on whole texts, long ones among them."""
    references = {"aa": language.normal("the cat sat on the mat and then it ran " * 5),
                  "bb": language.normal("der hund lief durch den wald und dann " * 5)}
    rng = random.Random(3)
    words = "the cat der hund lief ran zwölf 12 wald mat x".split()
    texts = [" ".join(rng.choices(words, k=n)) for n in (1, 5, 40, 700, 3000)] + ["", None, "12 34", "é" * 5000]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in language.predict(frame, references).collect():
        text = language.normal(texts[row.doc_id])
        if not text:
            assert (row.lang_pred, row.score) == ("und", 0.0)
            continue
        bits = [cross_parse(r, text) * math.log2(len(r) + 2) / len(text) for r in references.values()]
        assert row.lang_pred == list(references)[bits.index(min(bits))]
        assert row.score == pytest.approx(1 / sum(2 ** (4 * (min(bits) - x)) for x in bits))


def test_language_learns_from_the_middle_of_texts(spark):
    rows = [(i, "aa", "prefix " * 200 + f"needle{'abcdefghij'[i % 10]} " * 2000) for i in range(200)]
    texts = language.sample(spark.createDataFrame(rows, "doc_id long, lang string, text string"), F.lit(True)).collect()
    assert len(texts) == len({r.bucket for r in texts}) > 32 and all(len(r.text) <= language.SAMPLE_CHARS for r in texts)
    assert sum("needle" in r.text for r in texts) > len(texts) * 0.7


def test_language_of_held_out_documents(spark):
    found = QUERIES["op6_language_id"](spark, LARGER).where("held_out").join(
        spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 0.995 * len(found)


def test_language_of_odd_rows(spark):
    references = {"aa": language.normal("the cat sat on the mat " * 9), "bb": language.normal("zwölf boxkämpfer jagen " * 9)}
    texts = [None, "", "12 345 -- !", "²½", "THE CAT", "Zwölf", "日本語", "the mat " * 20_000, "x" * 5000]
    frame = spark.createDataFrame([(i, t, "zz", 0.5) for i, t in enumerate(texts)],
                                  "doc_id long, text string, lang string, score double")
    found = {r.doc_id: r for r in language.predict(frame, references).collect()}
    assert [found[i].lang_pred for i in range(4)] == ["und"] * 4
    assert [found[i].lang_pred for i in (4, 5, 7)] == ["aa", "bb", "aa"]
    assert all(0 <= r.score <= 1 for r in found.values()) and len(found) == len(texts)
    assert [r.lang_pred for r in language.predict(frame, {}).collect()] == ["und"] * len(texts)
    empty = frame.limit(0)
    assert language.fit(empty) == {} and language.predict(empty, references).count() == 0


# --- toxicity ------------------------------------------------------------------------

@pytest.fixture(scope="module")
def field():
    draw = np.random.default_rng(8)
    return toxicity.Field(["bad", "awf*", "so"], draw.normal(0, 1, 4), 0.3, draw.normal(0, 1, (2, 2)),
                          np.array([-3.0, 2.0, 4.0, 0.5]))


def test_marginals_sum_over_all_taggings(field):
    chain = [0, 1, 0, 3, 2, 0]
    total, toxic = 0.0, np.zeros(len(chain))
    for tags in itertools.product((0, 1), repeat=len(chain)):
        energy = field.first * tags[0] + sum(field.emission[x] * t for x, t in zip(chain, tags))
        energy += sum(field.pairs[a, b] for a, b in zip(tags, tags[1:]))
        total += np.exp(energy)
        toxic += np.exp(energy) * np.array(tags)
    assert np.allclose(field.marginals(chain), toxic / total)


def test_plain_texts_need_only_their_length(field):
    for n in (0, 1, 5, 127, 128, 129, 400):
        total, top, each = field.summary(["other"] * n)
        marginals = field.marginals([0] * n)
        assert each is None and np.isclose(total, sum(marginals)) and np.isclose(top, max(marginals, default=0))


def test_training_recovers_the_slope():
    draw = np.random.default_rng(3)
    chains = [draw.integers(0, 3, draw.integers(1, 9)) for _ in range(40)]
    tags = [(draw.random(len(c)) < np.array([0.1, 0.8, 0.4])[c]).astype(int) for c in chains]
    found = toxicity.train_field(chains, tags, ["a", "b"], steps=600)

    def objective(vector):
        total = -0.5 * (vector ** 2).sum()
        emission, first, pairs = vector[:3], vector[3], vector[4:].reshape(2, 2)
        for chain, tag in zip(chains, tags):
            def energy(t):
                return (first * t[0] + sum(emission[x] * y for x, y in zip(chain, t))
                        + sum(pairs[a, b] for a, b in zip(t, t[1:])))
            total += energy(tag) - np.logaddexp.reduce([energy(t) for t in itertools.product((0, 1), repeat=len(chain))])
        return total
    best = np.concatenate([found.emission, [found.first], found.pairs.ravel()])
    for i in range(len(best)):
        for step in (-0.3, 0.3):
            assert objective(best) > objective(best + step * np.eye(len(best))[i])


def test_lexicon_leaves_out_companions():
    draw = random.Random(1)
    toxic = [{f"w{draw.randrange(500)}" for _ in range(20)} | {draw.choice(["bad", "vile"])} for _ in range(200)]
    for found in toxic[:40]:
        found |= {"companion", "bad"}
    clean = [{f"w{draw.randrange(500)}" for _ in range(20)} for _ in range(400)]
    assert set(toxicity.lexicon(toxic, clean)) == {"bad", "vile"}


def test_numbers_take_the_longest_stem(field):
    number = toxicity.Numbers(["bads", "bads*", "badsom*"])
    assert [number[w] for w in ("bads", "badsa", "badsome", "bad", "xbads")] == [1, 2, 3, 0, 0]


def test_held_out_documents(spark):
    labels = spark.read.parquet(f"{LARGER}/labels.parquet")
    found = QUERIES["op2_toxicity"](spark, LARGER).where("held_out").join(labels, "doc_id").collect()
    clean, toxic = ([r for r in found if r.toxic == t] for t in (0, 1))
    assert sum(r.predicted for r in clean) <= 0.01 * len(clean)
    assert sum(r.predicted for r in toxic) >= 0.85 * len(toxic)
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "lang").collect()}
    for lang in set(langs.values()):
        own = [r.predicted for r in toxic if langs[r.doc_id] == lang]
        assert sum(own) >= 0.8 * len(own) > 0


def test_toxicity_of_odd_rows(spark, field):
    texts = [None, "", "BAD", "so awful it is bad", "nice " * 50_000, "ISTANBUL İstanbul bad"]
    frame = spark.createDataFrame([(i, t, 9.0, [1]) for i, t in enumerate(texts)],
                                  "doc_id long, text string, score double, spans array<int>")
    found = {r.doc_id: r for r in toxicity.score(frame, field).collect()}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found.values())
    assert found[0].score == found[1].score and len(found) == len(texts)
    assert toxicity.filtered(frame, field).columns == frame.columns
    labels = spark.createDataFrame([(0, 1), (None, 1), (1, None)], "doc_id long, toxic int")
    for some, score in ((labels, 1.0), (labels.limit(0), 0.0)):
        scores = toxicity.score(frame, toxicity.fit(frame, some)).select("score").distinct().collect()
        assert [r.score for r in scores] == [score]


def test_spans_are_offsets(field):
    text = "It is so Bad, awfully bad. Fine"
    spans = toxicity.offending(text, [0.1, 0.1, 0.2, 0.9, 0.8, 0.9, 0.1])
    assert [text[s["start"]:s["end"]] for s in spans] == ["Bad, awfully bad"]
    text = "İ Bad İİ awful word"  # letters that grow when they are made lower case
    spans = toxicity.offending(text, [0.1, 0.9, 0.1, 0.9, 0.1])
    assert [text[s["start"]:s["end"]] for s in spans] == ["Bad", "awful"]
    assert toxicity.words(text) == ["İ", "Bad", "İİ", "awful", "word"]


def test_long_and_repeated_labelled_texts(spark):
    draw = random.Random(7)
    def prose(n):
        return [f"w{draw.randrange(900)}x".translate(str.maketrans("0123456789", "abcdefghij")) for _ in range(n)]
    rows = []
    for i in range(60):
        words = prose(1800)
        for at in range(0, 1800, 150):
            words[at] = "vileness"
        rows += [(i, " ".join(words), 1), (1000 + i, " ".join(prose(60)), 0), (2000 + i, None, 0)]
    rows += [rows[0]] * 40  # an id that is there many times
    docs = spark.createDataFrame([(i, t, 1) for i, t, _ in rows], "doc_id long, text string, toxic int")
    labels = spark.createDataFrame([(i, t) for i, _, t in rows] + [(9000 + i, 1) for i in range(5000)], "doc_id long, toxic int")
    assert all(len(t) > toxicity.SAMPLE_CHARS for _, t, toxic in rows if toxic)
    field = toxicity.fit(docs, labels)
    assert "vileness" in field.words
    assert toxicity.sample(docs, labels).groupBy("doc_id").count().where("count > 1").count() == 0
    assert {(r.doc_id, r.predicted) for r in toxicity.score(docs, field).collect()} == {(i, t) for i, _, t in rows}


def test_chains_within_a_text_have_no_first_weight():
    draw = np.random.default_rng(5)
    chains = [draw.integers(0, 2, 5) for _ in range(30)]
    tags = [(draw.random(5) < np.array([0.1, 0.8])[c]).astype(int) for c in chains]
    begins = [i % 3 == 0 for i in range(30)]
    found = toxicity.train_field(chains, tags, ["a"], steps=600, begins=begins)

    def objective(v):
        emission, first, pairs = v[:2], v[2], v[3:].reshape(2, 2)
        total = -0.5 * (v ** 2).sum()
        for chain, tag, begin in zip(chains, tags, begins):
            def energy(t):
                return (begin * first * t[0] + sum(emission[x] * y for x, y in zip(chain, t))
                        + sum(pairs[a, b] for a, b in zip(t, t[1:])))
            total += energy(tag) - np.logaddexp.reduce([energy(t) for t in itertools.product((0, 1), repeat=5)])
        return total
    best = np.concatenate([found.emission, [found.first], found.pairs.ravel()])
    for i in range(len(best)):
        for step in (-0.3, 0.3):
            assert objective(best) > objective(best + step * np.eye(len(best))[i])
