"""Near duplicates: MinHash bands, verification on whole sets, connected components.

A document's set holds the distinct runs of ``k`` words (A-Z lower-cased), or its whole
word sequence where it has fewer. Documents are linked if ``100 * |A & B| >= percent *
|A | B|``; a component is what links reach, named by its smallest id.

1. One pass makes signatures: ``HASHES`` universal hash minima, cut into bands of ``ROWS``,
   and a digest of the whole set. Equal sets are one class from here on, represented by the
   smallest id, so a text that is a third of all rows costs one row.
2. Stars: in each bucket (equal band) every class is paired with the smallest id there, and of
   its pairs the one whose sketches agree most is verified on whole texts.
   Following links to the least neighbour three times labels classes that hang together.
3. Rest: only in buckets that still hold several labels, and only across labels. In buckets of up to ``SMALL`` classes these are paired, sieved and verified likewise. Classes of
   larger buckets are dealt into blocks of bounded numbers and sizes, by the largest bucket they
   are in; two blocks meet if a bucket reaches into both, and one task finds all exact
   intersections between them with a matrix product over their shingles. It returns one link for
   each two labels, so no pairs are emitted. Blocks of one large label do not meet.
4. Components of all links.

So a link is missed only if no band of its two sets agrees (at most 1e-7 for a link at the
threshold) or, in small buckets, its sketch errs by more than five standard deviations.

Step 2 makes one pair per class and band. Step 3 makes at most ``SMALL`` pairs per class and small
bucket; in large buckets its work is the number of classes outside the largest label times
the bucket's size, and what moves is that divided by a block's size. Joins with a hot bucket have
one row per bucket on the other side.

Defined cases: a null or empty text, or one without words, has an empty set and is linked
with nothing. Ids are nodes: rows that repeat an id share its component, with the links of each
of its texts, and rows that repeat a row give repeated results. A row without an id is linked with nothing and has no component
(``component_id`` null, ``kept`` true). Extra columns are left out.
"""

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import words as W
from .components import components
from .storage import discard, stored

HASHES, ROWS = 128, 4
_RANDOM = np.random.Generator(np.random.PCG64(7121))
#: h(x) = the high half of (a * x + b) mod 2**64 for a 32-bit x: a strongly universal family.
_A = _RANDOM.integers(0, 1 << 64, HASHES, dtype=np.uint64)
_B = _RANDOM.integers(0, 1 << 64, HASHES, dtype=np.uint64)
_AT_ONCE = 2048
#: Largest bucket whose members are paired as rows, and the aims for blocks of larger ones.
SMALL, BLOCK_CLASSES, BLOCK_SHINGLES = 32, 512, 400_000

SIGNATURES = ("id long, n_shingles long, digest binary, bands array<long>,"
              " s0 long, s1 long, s2 long, s3 long")


def shingles(found: W.Words, hashes: np.ndarray, text: int, grams: np.ndarray, k: int) -> np.ndarray:
    """The distinct shingle hashes of one text, sorted."""
    lo, hi = found.first[text], found.first[text + 1]
    if hi - lo >= k:
        return np.unique(grams[lo:hi - k + 1])
    return W.spans(hashes[lo:hi], np.array([0]), np.array([hi - lo])) if hi > lo else grams[:0]


def minima(shingle_set: np.ndarray) -> np.ndarray:
    """The least value of each hash function over a set, as 32-bit numbers."""
    x = shingle_set >> np.uint64(32)
    least = np.full(HASHES, (1 << 64) - 1, np.uint64)
    for at in range(0, len(x), _AT_ONCE):
        np.minimum(least, (x[at:at + _AT_ONCE, None] * _A + _B).min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def _sketch(least: np.ndarray) -> np.ndarray:
    """Two bits of each minimum, packed into four longs."""
    bits = np.concatenate([least & 1, (least >> 1) & 1]).astype(np.uint8)
    return np.packbits(bits).view(np.int64)


def _signatures(k: int):
    bands = HASHES // ROWS
    salt = np.arange(bands, dtype=np.uint64) + np.uint64(1)

    def run(batches):
        for batch in batches:
            ids, columns = [], {n: [] for n in ("n", "digest", "bands", "sketch")}
            for part in W.sliced(batch):
                found = W.of(part.column("text"))
                hashes = found.hashes(lower=True)
                grams = W.grams(hashes, k)
                ids.append(part.column("id"))
                for i in range(part.num_rows):
                    own = shingles(found, hashes, i, grams, k)
                    columns["n"].append(len(own))
                    if not len(own):
                        columns["digest"].append(None)
                        columns["bands"].append(None)
                        columns["sketch"].append(np.zeros(4, np.int64))
                        continue
                    least = minima(own)
                    rows = least.reshape(bands, ROWS).astype(np.uint64)
                    key = W.mixed(rows[:, 0] << np.uint64(32) | rows[:, 1])
                    key = W.mixed(key ^ (rows[:, 2] << np.uint64(32) | rows[:, 3])) ^ W.mixed(salt)
                    columns["digest"].append(hashlib.md5(own.tobytes()).digest())
                    columns["bands"].append(W.signed(key))
                    columns["sketch"].append(_sketch(least))
            if not ids:
                continue
            sketch = np.array(columns["sketch"])
            yield pa.RecordBatch.from_arrays([
                pa.concat_arrays(ids), pa.array(columns["n"], pa.int64()),
                pa.array(columns["digest"], pa.binary()),
                pa.array(columns["bands"], pa.list_(pa.int64())),
                *(pa.array(np.ascontiguousarray(sketch[:, j])) for j in range(4))],
                names=["id", "n_shingles", "digest", "bands", "s0", "s1", "s2", "s3"])
    return run


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """``id, text`` to one row of ``SIGNATURES`` each."""
    return docs.select("id", "text").mapInArrow(_signatures(k), SIGNATURES)


def _sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    found = W.of(texts)
    hashes = found.hashes(lower=True)
    grams = W.grams(hashes, k)
    return [shingles(found, hashes, i, grams, k) for i in range(len(texts))]


def _verified(k: int, percent: int):
    def run(batches):
        for batch in batches:
            kept = []
            for part in W.sliced(batch, "text_u"):
                for a, b in zip(_sets(part.column("text_u"), k), _sets(part.column("text_v"), k)):
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    kept.append(100 * both >= percent * (len(a) + len(b) - both) and both > 0)
            yield pa.RecordBatch.from_arrays(
                [c.filter(pa.array(kept, pa.bool_())) for c in (batch.column("u"), batch.column("v"))],
                names=["u", "v"])
    return run


def verified(pairs: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs ``u, v`` with texts whose whole sets are alike enough; any two texts of theirs link
    ids that stand with several."""
    texts = docs.select("id", "text")
    both = pairs.join(texts.select(F.col("id").alias("u"), F.col("text").alias("text_u")), "u").join(
        texts.select(F.col("id").alias("v"), F.col("text").alias("text_v")), "v")
    return both.mapInArrow(_verified(k, percent), "u long, v long")


def intersections(a: list[np.ndarray], b: list[np.ndarray], width: int = 8192) -> np.ndarray:
    """Sizes of the intersections of each set of ``a`` with each of ``b``."""
    def placed(sets, shared):
        rows = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        values = np.concatenate(sets)
        at = np.minimum(np.searchsorted(shared, values), len(shared) - 1)
        hit = shared[at] == values
        order = np.argsort(at[hit], kind="stable")
        return rows[hit][order], at[hit][order]

    out = np.zeros((len(a), len(b)), np.float32)
    shared = np.intersect1d(np.concatenate(a), np.concatenate(b))
    if not len(shared):
        return out
    sides = placed(a, shared), placed(b, shared)
    for lo in range(0, len(shared), width):
        blocks = []
        for (rows, at), n in zip(sides, out.shape):
            cut = slice(*np.searchsorted(at, [lo, lo + width]))
            block = np.zeros((n, min(width, len(shared) - lo)), np.float32)
            block[rows[cut], at[cut] - lo] = 1
            blocks.append(block)
        out += blocks[0] @ blocks[1].T
    return out


def _met(k: int, percent: int):
    """Links between two blocks of ``id, component, text``: one for each two components."""
    def run(batches):
        for batch in batches:
            links = {}
            for i in range(batch.num_rows):
                sides = [batch.column(c)[i].values for c in ("members_a", "members_b")]
                sets = [_sets(side.field("text"), k) for side in sides]
                (ids, own), (others, other) = ([side.field(f).to_numpy() for f in ("id", "component")]
                                               for side in sides)
                sizes = [np.array([len(x) for x in s]) for s in sets]
                both = intersections(*sets)
                joined = sizes[0][:, None] + sizes[1][None] - both
                linked = (100 * both >= percent * joined) & (both > 0) & (own[:, None] != other[None])
                for x, y in np.argwhere(linked).tolist():
                    links.setdefault(tuple(sorted((own[x], other[y]))), (ids[x], others[y]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([link[j] for link in links.values()], pa.int64()) for j in (0, 1)], names=["u", "v"])
    return run


def _across_blocks(open_: DataFrame, sizes: DataFrame, texts: DataFrame, k: int,
                   percent: int) -> tuple[DataFrame, list[str]]:
    """Links across components in large buckets ``bucket, id, component, n``; paths it reads.

    ``sizes`` has ``id, n_shingles``.
    """
    placed = open_.groupBy("id").agg(F.max(F.struct("n", "bucket"))["bucket"].alias("family"),
                                     F.min("component").alias("component")).join(sizes, "id")
    large = placed.groupBy("family", "component").agg(F.count(F.lit(1)).alias("m")).where(
        F.col("m") >= BLOCK_CLASSES).drop("m").withColumn("large", F.col("component"))
    placed = placed.join(large, ["family", "component"], "left")
    key = ["family", F.coalesce("large", F.lit(0)).alias("part"), F.col("large").isNotNull().alias("whole")]
    counts = placed.groupBy(*key).agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK_CLASSES), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).alias("blocks"))
    dealt, dealt_at = stored(placed.select("id", "component", "large", *key).join(
        counts, ["family", "part", "whole"]).select("id", "component", "large", F.xxhash64(
            "family", "part", "whole", F.pmod(F.xxhash64("id"), "blocks")).alias("block")), "dealt")
    reach = open_.select("bucket", "id").join(dealt, "id").select("bucket", "block", "large").distinct()
    a, b = (reach.select("bucket", F.col("block").alias(f"block_{x}"), F.col("large").alias(f"large_{x}"))
            for x in "ab")
    meet = a.join(b, "bucket").where("block_a <= block_b and not coalesce(large_a = large_b, false)")
    meet = meet.select("block_a", "block_b").distinct()
    blocks, blocks_at = stored(dealt.join(texts, "id").groupBy("block").agg(
        F.collect_list(F.struct("id", "component", "text")).alias("members")), "blocks")
    both = meet.join(blocks.toDF("block_a", "members_a"), "block_a").join(
        blocks.toDF("block_b", "members_b"), "block_b")
    # one meeting of two blocks at a time goes to Python
    return both.select("members_a", "members_b").mapInArrow(
        _met(k, percent), "u long, v long"), [dealt_at, blocks_at]


def _labels(links: DataFrame) -> DataFrame:
    """``id, component``: the least neighbour, twice on. Equal labels are linked, though links
    may also run between labels; it saves whole components for the end."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    step = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("v"))
    far = step.select(F.col("u").alias("v"), F.col("v").alias("w"))
    return step.join(far, "v").join(far.toDF("w", "x"), "w").select(
        F.col("u").alias("id"), F.col("x").alias("component"))


def least_agreement(percent: int) -> int:
    """Bits of two sketches that agree at the threshold, less five standard deviations.

    Two bits of a minimum agree always where the minima agree, else each by chance. So of
    2 * HASHES bits a share of (1 + J) / 2 agrees; a minimum's two bits vary together.
    """
    j = percent / 100
    spread = math.sqrt(HASHES * ((1 - j) * 0.5 + j * 4 + (1 - j) - (1 + j) ** 2))
    return int(HASHES * (1 + j) - 5 * spread)


def _agreement(a: str, b: str):
    """Bits on which two sketches agree."""
    return sum((F.bit_count(F.bitwise_not(F.col(f"{a}.s{i}").bitwiseXOR(F.col(f"{b}.s{i}"))))
                for i in range(4)), F.lit(0))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, text`` to ``doc_id, n_shingles, component_id, kept``, a row for each row."""
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").alias("id"), "text")
    rows, _ = stored(signatures(source, k), "signatures")

    named = rows.where("id is not null and digest is not null")
    firsts = named.groupBy("digest").agg(
        F.min("id").alias("first"), F.count(F.lit(1)).alias("n"), F.max("n_shingles").alias("n_shingles"),
        F.max_by(F.struct("bands", "s0", "s1", "s2", "s3"), F.bitwise_not("id")).alias("x"))
    classes, classes_at = stored(firsts.select(
        F.col("first").alias("id"), "n", "n_shingles", "digest", "x.bands", *[f"x.s{i}" for i in range(4)]), "classes")
    copies = named.select("digest", "id").join(
        classes.where("n > 1").select("digest", F.col("id").alias("first")), "digest").where(
        "id <> first").select(F.col("id").alias("u"), F.col("first").alias("v"))

    placed = classes.select("id", F.explode("bands").alias("bucket"))
    shared = placed.groupBy("bucket").agg(
        F.min("id").alias("lead"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    members, members_at = stored(placed.join(shared, "bucket"), "buckets")
    sketch = classes.select("id", F.struct("s0", "s1", "s2", "s3").alias("s"))

    u, v = (sketch.select(F.col("id").alias(x), F.col("s").alias(s)) for x, s in ("ua", "vb"))
    enough = least_agreement(percent)
    stars = members.where("id <> lead").select(F.col("id").alias("u"), F.col("lead").alias("v")).distinct()
    stars = stars.join(u, "u").join(v, "v").withColumn("agree", _agreement("a", "b")).where(
        F.col("agree") >= enough).groupBy("u").agg(
        F.max_by("v", F.struct("agree", F.bitwise_not("v"))).alias("v"))
    # an id with several texts has a class for each of them, and each is verified
    texts = source.join(members.select("id").distinct(), "id", "left_semi").withColumn(
        "row", F.xxhash64("text")).dropDuplicates(["id", "row"]).drop("row")
    texts, texts_at = stored(texts, "texts")
    links, links_at = stored(verified(stars, texts, k, percent), "links")
    first, first_at = stored(_labels(links), "labels")

    # what is left: buckets that hold classes of more than one label
    known = members.drop("lead").join(first, "id", "left").select(
        "bucket", "id", F.coalesce("component", "id").alias("component"))
    mixed = known.groupBy("bucket").agg(F.min("component").alias("a"), F.max("component").alias("b"),
                                        F.count(F.lit(1)).alias("n")).where("a < b").select("bucket", "n")
    open_, open_at = stored(known.join(mixed, "bucket"), "open")
    few = open_.where(F.col("n") <= SMALL).join(sketch, "id")
    a, b = (few.select("bucket", F.col("id").alias(f"id_{x}"), F.col("component").alias(f"c_{x}"),
                       F.col("s").alias(x)) for x in "ab")
    rest = a.join(b, "bucket").where(
        (F.col("c_a") < F.col("c_b")) & (_agreement("a", "b") >= enough)).select(
        F.col("id_a").alias("u"), F.col("id_b").alias("v")).distinct()
    more, more_at = stored(verified(rest, texts, k, percent), "links")
    met, met_reads = _across_blocks(open_.where(F.col("n") > SMALL), classes.groupBy("id").agg(
        F.sum("n_shingles").alias("n_shingles")), texts, k, percent)
    met, met_at = stored(met, "links")
    more = more.unionByName(met)
    found, _ = stored(components(links.unionByName(more).unionByName(copies)), "components")
    discard(spark, classes_at, members_at, texts_at, links_at, first_at, open_at, more_at, met_at, *met_reads)

    marked = rows.select("id", "n_shingles").join(found.withColumnRenamed("node", "id"), "id", "left")
    component = F.coalesce("component", "id")
    return marked.select(
        F.col("id").alias("doc_id"), "n_shingles", component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))
