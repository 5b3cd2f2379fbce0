"""Toxic spans and documents by a linear-chain conditional random field.

A text is a chain of words, each tagged toxic or not. The field has a weight for each entry of
a learned lexicon, a word or the beginning of words (``stem*``), one for words without an
entry, and weights for the first tag and for each
pair of neighbouring tags. Forward-backward gives each word's marginal probability; the
document's score is a logistic function of their sum, their maximum and the odds of any, and
runs of words with a marginal of a half and more are its offending spans.

Fit, on a bounded sample whatever the corpus: for each label at most ``SAMPLES`` of the documents
that are there (the least hash of each bucket of ids, found by a partial aggregate over
narrow tables), one text for each id. Of a text of more than ``SAMPLE_CHARS`` characters a window of so
many at a hashed place is taken. The fit is one Spark task over that sample and hands back weights only.

1. Labelled tokens: the lexicon is chosen greedily, entry by entry, to explain the toxic
   documents that no chosen one explains yet, among words and beginnings that clean ones hardly
   have, or hardly have twice (``REPEATED``). So a word that only comes along with others, as in
   copies of one toxic text, is not taken. In toxic documents its occurrences are labelled
   toxic, all other tokens not.
2. The field's weights maximise the likelihood of these labels (quadratic penalty, gradient by
   forward-backward). Long texts are cut into chains of ``SEGMENT`` words for this; a chain that
   is not a text's beginning has no weight for its first tag.
3. The logistic function is fitted to the documents' labels, each class weighted to its share
   among all labels to learn from.

Inference is a map over whole texts. Words outside the lexicon share one weight, so a text
without a lexicon word needs only its length.

Defined cases: a null or empty text has no marginals and gets the score of that. Labels without
id or value are ignored; where an id has several, the largest counts. With no toxic label
to learn from every score is 0, with no clean one it is 1. Ids of rows are only carried, repeated
rows give repeated results, an empty table an empty one. Extra columns are left out.
"""

import json
import math
import re
from collections import Counter
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .storage import stored

SAMPLES, SAMPLE_CHARS = 1500, 8000
LEXICON_WORDS = 500
#: A word must be this many times likelier in toxic documents.
LEAST_ODDS = 8.0
#: And this share of its toxic holders must not be explained by words before it.
LEAST_GAIN = 0.004
#: A word that explains nothing new must stand with so many sets of those that do.
LEAST_KINDS = 5
#: Lengths of stems.
STEM = (4, 8)
KNOWN_WORDS = 300_000
SEGMENT = 128
_EDGE = 64  # places after which a chain of equal weights has forgotten its end
#: Marks an entry that a document holds twice and more.
REPEATED = "#"
_WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> list[str]:
    """The words as they stand, so that their places are those of the text."""
    return _WORD.findall(text or "")


def entries(found: list[str]) -> set[str]:
    """What a lexicon could hold of these words: themselves in lower case and their beginnings,
    and the same again marked as repeated where it is."""
    counts: Counter = Counter()
    for w, n in Counter(w.lower() for w in found).items():
        counts[w] += n
        for k in range(STEM[0], min(STEM[1], len(w)) + 1):
            counts[w[:k] + "*"] += n
    return {*counts, *(w + REPEATED for w, n in counts.items() if n > 1)}


class Numbers(dict):
    """Words, in any case, to lexicon numbers from 1, 0 for a word without an entry: its own,
    else that of its longest stem. Remembers a bounded number of words."""

    def __init__(self, chosen: list[str]):
        super().__init__()
        self.chosen = {w: i + 1 for i, w in enumerate(chosen)}

    def __missing__(self, word: str) -> int:
        low, get = word.lower(), self.chosen.get
        number = get(low, 0)
        for n in range(min(STEM[1], len(low)), STEM[0] - 1, -1):
            number = number or get(low[:n] + "*", 0)
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = number
        return number


def lexicon(toxic: list[set[str]], clean: list[set[str]], most: int = LEXICON_WORDS) -> list[str]:
    """Words that explain toxic documents, the one that explains most first.

    A word may enter if its holders' labels are unlikely to be chance, also among as many
    as there are (a likelihood ratio above the logarithm of their number), and if it
    explains some of its toxic holders first, or if these are of ``LEAST_KINDS`` kinds by the
    chosen words they hold, so that it does not just come along with one of them.
    """
    holders: dict[str, set[int]] = {}
    for i, found in enumerate(toxic):
        for w in found:
            holders.setdefault(w, set()).add(i)
    against = dict.fromkeys(holders, 0)
    for found in clean:
        for w in found & against.keys():
            against[w] += 1
    share = len(toxic) / (len(toxic) + len(clean))
    bound = math.log(len(holders) + 1) + 4

    def evidence(n: int, m: int) -> float:
        p = (n + 0.5) / (n + m + 1)
        return (n * math.log(p / share) + m * math.log((1 - p) / (1 - share))) * (p > share)
    fit = {w: x for w, x in holders.items() if evidence(len(x), against[w]) > bound
           and len(x) + 0.5 >= LEAST_ODDS * share / (1 - share) * (against[w] + 0.5)}
    chosen, left, likely = [], set(range(len(toxic))), dict(fit)
    while fit and len(chosen) < most:
        gains = {w: len(x & left) for w, x in fit.items()}
        fit = {w: x for w, x in fit.items() if gains[w] >= max(2, LEAST_GAIN * len(x))}
        if not fit:
            break
        best = max(fit, key=lambda w: (gains[w] - 4 * against[w], w[-1] not in "*#", len(w), w))
        chosen.append(best)
        left -= fit.pop(best)
    cover, known = list(chosen), {frozenset(holders[w]) for w in chosen}
    for w in sorted(likely.keys() - set(cover), key=lambda w: (-evidence(len(likely[w]), against[w]), w[-1] in "*#", -len(w), w)):
        kinds = {tuple(c for c in cover if i in holders[c]) for i in likely[w]} if len(chosen) < most else ()
        if len(kinds) >= LEAST_KINDS and frozenset(likely[w]) not in known:
            chosen.append(w)
            known.add(frozenset(likely[w]))
    return list(dict.fromkeys(w.removesuffix(REPEATED) for w in chosen))


@dataclass
class Field:
    """Weights of the toxic tag against the other: per word (0: any other), of the first tag,
    and of the pairs of tags."""

    words: list[str]
    emission: np.ndarray
    first: float
    pairs: np.ndarray
    logistic: np.ndarray = None
    constant: float | None = None

    @cached_property
    def number(self) -> Numbers:
        return Numbers(self.words)

    @cached_property
    def factors(self) -> tuple:
        """Plain numbers: emission factors, the first tag's, and the pairs'."""
        return (np.exp(self.emission).tolist(), float(np.exp(self.first)),
                *np.exp(self.pairs).ravel().tolist())

    def marginals(self, chain: list[int]) -> list[float]:
        """Forward-backward over word numbers; the probability of toxic at each place."""
        emit, first, a, b, c, d = self.factors
        forward, ratio = [], 0.0
        for at, x in enumerate(chain):  # the ratio of toxic to not, as only ratios matter
            ratio = emit[x] * (first if not at else (b + ratio * d) / (a + ratio * c))
            forward.append(ratio)
        out, back = [0.0] * len(chain), 1.0
        for at in range(len(chain) - 1, -1, -1):
            odds = forward[at] * back
            out[at] = odds / (1.0 + odds)
            step = emit[chain[at]] * back
            back = (c + d * step) / (a + b * step)
        return out

    @cached_property
    def plain(self) -> tuple[list[float], list[float], float]:
        """Sums and maxima of the marginals of chains without lexicon words by length, and
        the marginal in the middle of a long one."""
        chains = [self.marginals([0] * n) for n in range(2 * _EDGE + 1)]
        return list(map(sum, chains)), [max(c, default=0.0) for c in chains], chains[-1][_EDGE]

    def summary(self, found: list[str]) -> tuple[float, float, list[float] | None]:
        """Sum and maximum of the marginals, and all of them if a word is in the lexicon."""
        chain = list(map(self.number.__getitem__, found))
        if not any(chain):
            sums, tops, middle = self.plain
            n = min(len(found), 2 * _EDGE)
            return sums[n] + (len(found) - n) * middle, tops[n], None
        each = self.marginals(chain)
        return sum(each), max(each), each

    def score(self, total: float, top: float, each: list[float] | None) -> float:
        """Of what ``summary`` gives."""
        if self.constant is not None:
            return self.constant
        z = float(self.logistic @ features(total, top, each))
        return 1 / (1 + float(np.exp(-max(-500.0, min(500.0, z)))))


def features(total: float, top: float, each: list[float] | None) -> np.ndarray:
    """What a document is scored by: the sum and the maximum of its marginals, and the odds against
    no toxic word at all, as a logarithm (that is their sum, where all are small)."""
    none = total if each is None else -float(np.log1p(-np.minimum(each, 1 - 1e-9)).sum())
    return np.array([1.0, np.log1p(total), top, np.log1p(none)])


def train_field(chains: list[np.ndarray], tags: list[np.ndarray], chosen: list[str],
                steps: int = 120, penalty: float = 1.0, begins: list[bool] | None = None) -> Field:
    """Maximum likelihood of tagged chains, by forward-backward and adaptive gradient steps.
    ``begins`` tells which chains are the beginning of a text (all, if it is not given)."""
    order = np.argsort([-len(c) for c in chains], kind="stable")
    longest = max(len(c) for c in chains)
    x, y = (np.zeros((longest, len(chains)), np.int64) for _ in range(2))
    for column, i in enumerate(order):
        x[:len(chains[i]), column], y[:len(chains[i]), column] = chains[i], tags[i]
    opening = np.ones(len(chains)) if begins is None else np.array(begins, float)[order]
    lengths = np.array([len(chains[i]) for i in order])
    live = [int(np.searchsorted(-lengths, -at, "left")) for at in range(longest)]
    size = len(chosen) + 1
    seen = np.zeros(size + 1 + 4)
    for at, n in enumerate(live):
        np.add.at(seen, x[at, :n], y[at, :n])
        if at:
            np.add.at(seen, size + 1 + 2 * y[at - 1, :n] + y[at, :n], 1)
        else:
            seen[size] = (y[0, :n] * opening[:n]).sum()
    weights, mean, square = np.zeros_like(seen), np.zeros_like(seen), np.zeros_like(seen)
    weights[0] = -2.0
    for step in range(1, steps + 1):
        emit, first, pairs = np.exp(weights[:size]), np.exp(weights[size]), np.exp(weights[size + 1:]).reshape(2, 2)
        ahead = np.zeros((longest, 2, len(chains)))
        for at, n in enumerate(live):
            v = pairs.T @ ahead[at - 1, :, :n] if at else np.stack([np.ones(n), first ** opening[:n]])
            v[1] *= emit[x[at, :n]]
            ahead[at, :, :n] = v / v.sum(axis=0)
        expected, back = np.zeros_like(seen), np.ones((2, len(chains)))
        for at in range(longest - 1, -1, -1):
            n = live[at]
            p = ahead[at, :, :n] * back[:, :n]
            p /= p.sum(axis=0)
            expected[:size] += np.bincount(x[at, :n], p[1], size)
            out = back[:, :n].copy()
            out[1] *= emit[x[at, :n]]
            if at:
                joint = ahead[at - 1, :, None, :n] * pairs[:, :, None] * out[None]
                joint /= joint.sum(axis=(0, 1))
                expected[size + 1:] += joint.sum(axis=2).ravel()
                v = pairs @ out
                back[:, :n] = v / v.sum(axis=0)
            else:
                expected[size] += (p[1] * opening[:n]).sum()
        slope = seen - expected - penalty * weights
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope ** 2
        weights = weights + 0.2 * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
    return Field(chosen, weights[:size], float(weights[size]), weights[size + 1:].reshape(2, 2))


def _logistic(features: np.ndarray, toxic: np.ndarray, share: float) -> np.ndarray:
    """Newton's method with a small quadratic penalty, classes weighted to ``share``."""
    weight = np.where(toxic, share / toxic.mean(), (1 - share) / (1 - toxic.mean()))
    w = np.zeros(features.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(features @ w, -500, 500)))
        slope = features.T @ (weight * (toxic - p)) - 0.1 * w
        bend = (features * (weight * p * (1 - p))[:, None]).T @ features + 0.1 * np.eye(len(w))
        w = w + np.linalg.solve(bend, slope)
    return w


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``toxic, doc_id, text`` of the bounded sample. Only ids are aggregated; at most two times
    ``SAMPLES`` of them are broadcast to the texts."""
    rank = F.xxhash64("doc_id", F.lit("toxicity sample"))
    ids = labels.groupBy("toxic", F.pmod(rank, F.lit(SAMPLES)).alias("bucket")).agg(
        F.min_by("doc_id", rank).alias("doc_id")).select("doc_id", "toxic")
    over = F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0))
    at = F.pmod(F.xxhash64("text"), over + 1) + 1
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").groupBy("doc_id", "toxic").agg(
        F.min("text").alias("text")).select(
        "toxic", "doc_id", F.coalesce(F.substring("text", at, F.lit(SAMPLE_CHARS)), F.lit("")).alias("text"))


def fitted(rows: list[tuple[int, str]], share: float | None) -> Field:
    """The field of labelled texts, of which ``share`` of all labels are toxic."""
    texts = [(toxic == 1, words(text)) for toxic, text in rows]
    if len({toxic for toxic, _ in texts}) < 2:
        constant = float(bool(texts) and texts[0][0])
        return Field([], np.zeros(1), 0.0, np.zeros((2, 2)), constant=constant)
    # only what two toxic texts hold can be of use, and each string is kept once
    holders = Counter(e for toxic, own in texts if toxic for e in entries(own))
    kept = {e: e for e, n in holders.items() if n > 1}
    del holders
    sets = {t: [{kept[e] for e in entries(own) & kept.keys()} for toxic, own in texts if toxic == t]
            for t in (True, False)}
    chosen = lexicon(sets[True], sets[False])
    del kept, sets
    number = Numbers(chosen)
    chains, tags, begins = [], [], []
    for toxic, own in texts:
        chain = np.array([number[w] for w in own], np.int64)
        for at in range(0, len(chain), SEGMENT):
            part = chain[at:at + SEGMENT]
            chains.append(part)
            tags.append(((part > 0) & toxic).astype(np.int64))
            begins.append(at == 0)
    if not chains:  # no text has a word
        chains, tags, begins = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], [True]
    field = train_field(chains, tags, chosen, begins=begins)
    seen = np.stack([features(*field.summary(own)) for _, own in texts])
    field.logistic = _logistic(seen, np.array([toxic for toxic, _ in texts]), share)
    return field


def fit(docs: DataFrame, labels: DataFrame, learn: Column | None = None) -> Field:
    """Learn from ``labels (doc_id, toxic)`` where ``learn`` holds, of documents that are there."""
    learn = F.lit(True) if learn is None else learn
    labels = labels.where("doc_id is not null and toxic is not null").where(learn).join(
        docs.select("doc_id"), "doc_id", "left_semi").groupBy("doc_id").agg(
        F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    labels, _ = stored(labels, "toxic-labels")
    share = labels.agg(F.avg("toxic")).first()[0]
    if share is None:  # nothing to learn from
        return fitted([], None)

    def train(batches):
        rows = sorted(((r["toxic"], r["doc_id"], r["text"]) for b in batches for r in b.to_pylist()))
        field = fitted([(toxic, text) for toxic, _, text in rows], share)
        weights = {"words": field.words, "emission": field.emission.tolist(), "first": field.first,
                   "pairs": field.pairs.tolist(), "constant": field.constant,
                   "logistic": None if field.logistic is None else field.logistic.tolist()}
        yield pa.RecordBatch.from_pydict({"weights": [json.dumps(weights)]})

    # the sample is bounded, so one task holds it; of the model only the weights come back
    found = sample(docs, labels).repartition(1).mapInArrow(train, "weights string").first()
    weights = json.loads(found.weights)
    return Field(weights["words"], np.array(weights["emission"]), weights["first"], np.array(weights["pairs"]),
                 None if weights["logistic"] is None else np.array(weights["logistic"]), weights["constant"])


def offending(text: str, marginals: list[float], least: float = 0.5) -> list[dict]:
    """Runs of words with a marginal of ``least`` and more: offsets in code points of the text,
    and the highest marginal."""
    spans, open_ = [], False
    for match, p in zip(_WORD.finditer(text), marginals):
        if p >= least:
            if open_:
                spans[-1]["end"], spans[-1]["marginal"] = match.end(), max(p, spans[-1]["marginal"])
            else:
                spans.append({"start": match.start(), "end": match.end(), "marginal": p})
        open_ = p >= least
    return spans


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("marginal", pa.float64())]))


def score(docs: DataFrame, field: Field) -> DataFrame:
    """``doc_id, text`` to ``doc_id, score, predicted, spans``."""
    def run(batches):
        for batch in batches:
            scores, spans = [], []
            for text in batch.column("text"):
                text = text.as_py() or ""
                total, top, each = field.summary(words(text))
                scores.append(field.score(total, top, each))
                spans.append(offending(text, each) if each else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array(spans, _SPANS)],
                names=["doc_id", "score", "spans"])
    found = docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, score double, spans array<struct<start: int, end: int, marginal: double>>")
    return found.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")


def filtered(docs: DataFrame, field: Field, least: float = 0.5) -> DataFrame:
    """Documents, all columns, whose score is below ``least``."""
    def run(batches):
        for batch in batches:
            keep = [field.score(*field.summary(words(text.as_py()))) < least
                    for text in batch.column("text")]
            yield batch.filter(pa.array(keep, pa.bool_()))
    return docs.mapInArrow(run, docs.schema)
