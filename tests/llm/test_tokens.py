"""Units, BPE, packing and token files against the libraries themselves."""

import base64
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark import cloudpickle
from tokenizers import Tokenizer

from conftest import SF_DIR
from crawlcorpus.llm import bytepairs, packing, tokens, units
from crawlcorpus.llm.catalog import QUERIES, RANKS, TOKENIZER

ODD = ["", " ", "\n", "\n\n", " a", "a ", "a  b", "a \n b", "\na\n", "it's 'so' ' s", "don't \x00 stop",
       "é è x", "x\x85 y\x1c z", "a\r\nb \t c", "ab" * 300, "日本語 テキスト", "<|endoftext|> a <|endoftext|>",
       "aaaaaaa aaa", "alpha <|endoftext|> beta", "a<|endoftext|>", "<|endoftext|", "<|end oftext|>",
        "abcabcabc" * 40 + "!?" * 50, "1234567890 1 22", "\U0001f600\U0001f600 x", "a\n\x00b", "'ll 've\n're"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(TOKENIZER)


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


@pytest.fixture(scope="module")
def pairs():
    return bytepairs.BytePairs(RANKS, public_tokenizers.PATTERN)


TEXTS = st.text(st.sampled_from(list("abcthe'sr. \n\t\r1é 日\x00\x85ABS!")), max_size=60)


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_encoders_agree_with_libraries(tokenizer, reference, pairs, text):
    assert next(tokens.encoder(TOKENIZER)([text])).tolist() == tokenizer.encode(
        text, add_special_tokens=False).ids
    ids = next(pairs.encode([text]))
    assert ids.tolist() == reference.encode_ordinary(text)
    assert pairs.decode(ids).tobytes() == text.encode()


def test_odd_texts(tokenizer, reference, pairs):
    assert [x.tolist() for x in tokens.encoder(TOKENIZER)(ODD)] == [
        tokenizer.encode(t, add_special_tokens=False).ids for t in ODD]
    assert [x.tolist() for x in pairs.encode(ODD)] == [reference.encode_ordinary(t) for t in ODD]


def test_long_match(reference, pairs):
    text = "".join(random.Random(3).choices("abcdeth", k=100_000))
    assert next(pairs.encode([text])).tolist() == reference.encode_ordinary(text)


def test_cache_starts_anew(monkeypatch, tokenizer):
    monkeypatch.setattr(units, "CACHE_UNITS", 20)
    many = tokens._ByteLevel(tokenizer)
    encode = units.UnitEncoder(many.each, many.spaced, many.plain)
    for at in range(30):
        texts = [f"word{at} and {i * at} more" for i in range(9)]
        assert [x.tolist() for x in encode(texts)] == [
            tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_units_that_are_met_often_are_encoded_once_and_stay(monkeypatch, tokenizer):
    monkeypatch.setattr(units, "CACHE_UNITS", 40)
    many, asked = tokens._ByteLevel(tokenizer), []

    def spaced(new):
        asked.extend(new)
        return many.spaced(new)
    encode = units.UnitEncoder(many.each, spaced, many.plain)
    for at in range(40):
        texts = [f"x often, often### often!! rare{at}z{i}q. \n\n" if i == 3 else
                 f"x often, often### often!! rare{at}z{i}q." for i in range(9)]
        ids, lengths = encode.together(texts)
        wanted = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert ids.tolist() == sum(wanted, []) and lengths.tolist() == [len(x) for x in wanted]
        assert len(encode.index) <= 40 + 20
    assert asked.count("often") == 1 and len(asked) == len(set(asked)) == 1 + 8 * 40


def test_letters_need_the_model_alone(monkeypatch, tokenizer):
    asked, each = [], tokens._ByteLevel.each
    monkeypatch.setattr(tokens._ByteLevel, "each", lambda own, texts: asked.extend(texts) or each(own, texts))
    many = tokens._ByteLevel(tokenizer)
    encode = units.UnitEncoder(many.each, many.spaced, many.plain)
    texts = ["Größe señal, façade§ ŝanĝo x2 naïve's\nÉtat über!! 日本 plain", "plain\xa0words İstanbul ªº ɏ"]
    assert [x.tolist() for x in encode(texts)] == [
        tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    seen = " ".join(asked)
    assert "x2" in seen and "naïve's" in seen and "日本" in seen
    assert not any(w in seen for w in ("Größe", "señal", "ŝanĝo", "État", "über", "İstanbul", "ªº", "ɏ"))


def test_parts_of_columns(tokenizer):
    for kind in (pa.string(), pa.large_string()):
        ids, lengths = tokens.encoder(TOKENIZER).together(pa.array(ODD, kind).slice(5, 14))
        wanted = [tokenizer.encode(t, add_special_tokens=False).ids for t in ODD[5:19]]
        assert ids.tolist() == sum(wanted, []) and lengths.tolist() == [len(x) for x in wanted]


def test_the_cache_stays_in_its_process(tokenizer):
    encode, text = tokens.encoder(TOKENIZER), "some words, some more"
    wanted = tokenizer.encode(text, add_special_tokens=False).ids
    assert next(encode([text])).tolist() == wanted and len(encode.index)
    copy = cloudpickle.loads(cloudpickle.dumps(encode))
    assert not len(copy.index) and next(copy([text])).tolist() == wanted


def test_packing_gives_the_cache_back(spark, monkeypatch):
    given = []
    monkeypatch.setattr(packing, "placed", lambda *a, **options: given.append(options) or spark.range(1))
    monkeypatch.setattr(packing, "checksums", lambda rows: rows)
    QUERIES["op5_best_fit_packing"](spark, SF_DIR)
    assert given == [{"keep_cache": False}]


def _documents(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_op7(spark, reference):
    texts, found = _documents(spark), QUERIES["op7_byte_pair_encoding"](spark, SF_DIR).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = reference.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_op10(spark, tokenizer):
    texts = _documents(spark)
    found = sorted(QUERIES["op10_token_files"](spark, SF_DIR).collect())
    assert [r.doc_id for r in found] == sorted(texts)
    start = 0
    for r in found:
        ids = tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids + [0]
        assert tuple(r)[1:] == (start, len(ids), _crc(ids))
        start += len(ids)


def test_token_files_of_odd_rows(spark, tokenizer):
    rows = [(None, "no id"), (5, None), (3, ""), (3, "three"), (3, "three"), (-7, "minus " * 3000)] + [
        (100 + i, t) for i, t in enumerate(ODD)]
    frame = spark.createDataFrame([(i, t, 1, [2]) for i, t in rows],
                                  "doc_id long, text string, start int, ids array<int>")
    folder = tokens.fresh_folder(spark)
    tokens.write_token_files(frame, folder, TOKENIZER, end_id=60_000)
    found = sorted(tokens.read_token_files(spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i))
    assert sorted(map(tuple, (r.ids for r in found))) == sorted(
        tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [60_000]) for _, t in rows)
    assert [r.start for r in found] == np.cumsum([0, *(r.n_tokens for r in found)]).tolist()[:-1]


def _check_packing(rows, lengths, capacity):
    used = defaultdict(list)
    for r in rows:
        used[r.sequence_id].append((r.offset, r.length))
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(r.length for r in rows) == sorted(lengths)
    return len(used)


def test_op5(spark, tokenizer):
    texts, found = _documents(spark), QUERIES["op5_best_fit_packing"](spark, SF_DIR).collect()
    by = defaultdict(list)
    for r in found:
        by[r.doc_id].append(r)
    assert set(by) == set(texts)
    for i, text in texts.items():
        ids, at = tokenizer.encode(text, add_special_tokens=False).ids + [0], 0
        own = sorted(by[i], key=lambda r: r.piece)
        for j, r in enumerate(own):
            assert (r.piece, r.start, r.ids_crc32) == (j, at, _crc(ids[at:at + r.length]))
            at += r.length
        assert at == len(ids) and all(r.length == 2048 for r in own[1:])
    n = _check_packing(found, [r.length for r in found], 2048)
    assert n <= -(-sum(r.length for r in found) // 2048) + 1


def test_packing_of_odd_rows(spark):
    rows = [(None, None)] * 3 + [(1, ""), (1, ""), (2, "word " * 5000)] + [(3, "same text")] * 500
    frame = spark.createDataFrame([(i, t, 9) for i, t in rows], "doc_id long, text string, length int")
    found = packing.packed(frame.repartition(7), TOKENIZER, capacity=64, with_ids=True).collect()
    assert all(len(r.ids) == r.length for r in found)
    assert sum(r.doc_id == 3 for r in found) == 500
    _check_packing(found, [r.length for r in found], 64)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert packing.packed(empty, TOKENIZER).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=20))
def test_plan(counts):
    capacity, taken, used = 40, defaultdict(list), defaultdict(list)
    for s in packing.plan(counts, capacity):
        for j in range(s.count):
            taken[s.length].append(s.rank + j)
            used[s.sequence + j // s.each].append((s.offset + j % s.each * s.length, s.length))
    assert {k: sorted(v) for k, v in taken.items()} == {k: list(range(n)) for k, n in counts.items()}
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    rooms = []  # plain best fit, decreasing, one piece after another
    for length in sorted((k for k, n in counts.items() for _ in range(n)), reverse=True):
        fits = [r for r in rooms if r >= length]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - length)
        else:
            rooms.append(capacity - length)
    assert len(used) == len(rooms)


def test_merges_leave_the_queue_empty(pairs, reference):
    draw = random.Random(1)
    texts = ["".join(draw.choices("abcdehinorst", k=n)) for n in (1, 2, 3, 10, 64, 100, 3000)]
    texts += ["a" * n for n in range(1, 40)] + ["abab" * 9, "aab" * 12, "ba" * 20]
    for text in texts:
        assert pairs.merged(text.encode()) == reference.encode_ordinary(text)
    ids, lengths = pairs.merged_together([t.encode() for t in texts])
    parts = np.split(ids, np.cumsum(lengths)[:-1])
    assert [p.tolist() for p in parts] == [reference.encode_ordinary(t) for t in texts]
    assert not pairs.queue.buckets and not pairs.queue.upper and not any(pairs.queue.lower)


def test_queue_gives_the_least_rank():
    draw, queue = random.Random(1), bytepairs.RankQueue(50_000)
    for _ in range(3000):
        if queue.buckets and draw.random() < 0.45:
            assert queue.least() == min(queue.buckets)
            queue.drop(queue.least())
        else:
            queue.bucket(draw.randrange(50_000) // draw.choice([1, 500, 5000]))
    assert queue.least() == min(queue.buckets, default=None)


def test_empty_files(spark):
    empty, folder = spark.createDataFrame([], "doc_id long, text string"), tokens.fresh_folder(spark)
    tokens.write_token_files(empty, folder, TOKENIZER)
    assert tokens.read_token_files(spark, folder).count() == 0
    assert bytepairs.encode(empty, RANKS, public_tokenizers.PATTERN).count() == 0
