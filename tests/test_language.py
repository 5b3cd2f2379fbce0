import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from crawlcorpus.operators import langid as L

TRAIN = [("en", "the cat and the dog\nare in the house"), ("en", "this is the end of it"),
         ("fi", "kissa ja koira ovat talossa"), ("fi", "tämä on sen loppu ja alku"),
         ("de", "der hund und die katze sind im haus"), ("de", "das ist das ende davon")]
TEXTS = [("a", "the dog and the cat\n\n  koira ja kissa ovat  \n12 !"),
         ("b", "xqzw"), ("c", "!!!"), ("d", "koira on talossa tämä on loppu\nthe"),
         ("e", "der hund\nund die katze")]
LANGUAGES = ["de", "en", "fi"]


def grams(word):
    padded = f" {word} "
    return [padded[i:i + 3] for i in range(len(padded) - 2)]


def words(line):
    return re.findall(r"[^\W\d_]+", line.lower())


def brute_model():
    counts = {l: Counter() for l in LANGUAGES}
    for lang, text in TRAIN:
        for w in words(text):
            counts[lang].update(grams(w))
    vocabulary = set().union(*counts.values())
    total = {l: sum(c.values()) for l, c in counts.items()}
    return {g: {l: round(1000 * math.log((counts[l][g] + 1) / (total[l] + len(vocabulary))))
                for l in LANGUAGES} for g in vocabulary}


def brute_scores(model, line):
    known = [model[g] for w in words(line) for g in grams(w) if g in model]
    return {l: sum(k[l] for k in known) for l in LANGUAGES} if known else None


def brute_keep(model, text, target, threshold=0.999, **limits):
    total = hit = 0
    for line in text.split("\n"):
        n = len(re.findall(r"\b[^\W\d_]{2,}\b", line.strip()))
        total += n
        scores = brute_scores(model, line)
        if n >= 1 and scores:
            p = 1 / sum(math.exp((s - scores[target]) / 1000) for s in scores.values())
            hit += n if p >= threshold else 0
    if total == 0 or hit / total < 0.01:
        return hit, total, False
    return hit, total, hit >= 10 or hit / total >= 0.25


@pytest.fixture(scope="module")
def model(spark):
    return L.train(spark.createDataFrame(TRAIN, "lang string, text string"))


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(TEXTS, "id string, text string")


def test_training(model):
    found = {r.gram: {l: r[l] for l in LANGUAGES} for r in model.grams.collect()}
    assert model.languages == LANGUAGES
    assert found == brute_model()


@pytest.mark.parametrize("limit", [0, 3, 10, 1000])
def test_tabulated_words_do_not_change_scores(spark, texts, model, limit):
    small = L.train(spark.createDataFrame(TRAIN, "lang string, text string"), max_words=limit)
    assert small.words.count() <= limit
    a = L.score_lines(texts, model, "id").orderBy("id", "pos").collect()
    b = L.score_lines(texts, small, "id").orderBy("id", "pos").collect()
    assert a == b


@pytest.mark.parametrize("max_broadcast", [None, 0])
def test_line_scores(texts, model, max_broadcast):
    """Also without any broadcast: the salted join gives the same."""
    grams_, lines = brute_model(), {}
    for r in L.score_lines(texts, model, "id", max_broadcast=max_broadcast).collect():
        lines[r.id, r.pos] = None if r.en is None else {l: r[l] for l in LANGUAGES}
    assert lines == {(i, n): brute_scores(grams_, line) for i, t in TEXTS
                     for n, line in enumerate(t.split("\n")) if line.strip()}


@pytest.mark.parametrize("target, threshold", [("fi", 0.999), ("en", 0.5), ("de", 0.9)])
def test_keep(texts, model, target, threshold):
    found = {r.id: (r.target_words, r.total_words, r.keep) for r in L.keep_decisions(
        texts, model, "id", target=target, threshold=threshold).collect()}
    assert found == {i: brute_keep(brute_model(), t, target, threshold) for i, t in TEXTS}


def test_unknown_target_and_few_labels(texts, model):
    none = L.keep_decisions(texts, model, "id", target="zz").collect()
    assert {r.target_words for r in none} == {0}
    one = L.keep_decisions(texts, model, "id", target="fi", max_labels=1, threshold=1e-300)
    rows = {r.id: r.target_words for r in one.collect()}
    assert rows["a"] == 4  # the first line is English before it is Finnish


def test_short_lines_are_not_judged(texts, model):
    rows = {r.id: (r.target_words, r.total_words) for r in L.keep_decisions(
        texts, model, "id", target="fi", min_words=5).collect()}
    assert rows["a"] == (0, 9)


def test_top_labels(texts, model):
    scores = L.score_lines(texts, model, "id")
    rows = [r for r in L.top_labels(scores, LANGUAGES, "id", k=2).collect() if r.id == "d"]
    assert {(r.pos, r["rank"]) for r in rows} == {(0, 1), (0, 2), (1, 1), (1, 2)}
    assert next(r.lang for r in rows if (r.pos, r["rank"]) == (0, 1)) == "fi"


@pytest.mark.parametrize("target, total, kept", [
    (0, 0, False), (0, 5, False), (10, 2000, False), (10, 100, True), (9, 100, False),
    (1, 4, True), (9, 37, False)])
def test_keep_rule(spark, target, total, kept):
    row = spark.range(1).select(L.keep(F.lit(target), F.lit(total))).first()
    assert row[0] is kept


def test_save_and_load(spark, model, tmp_path):
    model.save(f"{tmp_path}/m")
    again = L.LanguageModel.load(spark, f"{tmp_path}/m")
    assert again.languages == LANGUAGES
    assert sorted(again.grams.collect()) == sorted(model.grams.collect())


def test_documents(texts, model):
    scores = {r.id: r for r in L.score_documents(texts, model, "id").collect()}
    grams_ = brute_model()
    for i, text in TEXTS:
        wanted = brute_scores(grams_, text)
        if wanted:
            assert {l: scores[i][l] for l in LANGUAGES} == wanted


def test_one_shuffle(texts, model):
    plan = L.keep_decisions(texts, model, "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
