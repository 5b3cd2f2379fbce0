"""Removal of long repeated passages by a compacted de Bruijn graph of token k-mers.

A window is ``WINDOW`` consecutive words. Every window that also starts in a document of
smaller id loses its words. All windows of a corpus would be eight times its size, so the
graph is built over chosen k-mers (after "minimizer-space de Bruijn graphs", Ekim et al., 2021):

1. Nodes. A window's anchor is its ``K``-mer with the least hash, so equal windows have equal
   anchors. Consecutive windows of one anchor form one edge of the graph: the k-mers from the
   first window's first word to the last one's last. An edge carries the hash of all its
   words, its windows, and its source coordinates (document, first window).
2. Branches. Edges are joined on their anchor with what is known of it: the documents and
   the edges it is seen with. An anchor of one document is unique and drops out. It branches
   unless all its occurrences are one edge (same hash, same extent).
3. Compaction. Two edges that do not branch are linked where the first is always followed by
   the second and the second always led by the first. Linked edges are paths; pointer jumping
   joins each to the head of its path in as many rounds as its length has binary digits. A
   link has one edge at either end, so the joins are one to one. As all edges of a path occur
   together, only heads are looked up again: one row for each place where a path is, with the
   extent of the whole path.
4. Verification. At each such place the words of the whole path are digested from the text. Where
   all digests of a path equal that of its source, the place in the smallest document, all
   others are repeated as a whole, without a look at single windows.
5. Branching anchors (ends of passages, edited copies), and paths with unequal digests. Their
   windows are hashed one by one and joined on (anchor, window) with the smallest document.
6. Repeated windows of a document merge into spans; a span is removed from the text.

A path is confirmed by a digest of its words and the hash of each edge, a window of a branching
anchor by the hashes of anchor and words, 64 bits each. Of rows with equal texts only one, of the smallest id, enters the
graph; they are known from a digest, and those of larger ids are repeated as a whole. Aggregates are
partial before a shuffle, and joins have one row per anchor or window on the other side, so a
passage in a third of all documents can be split; no group of occurrences is ever gathered.

Defined cases: a null or empty text has no words. A row without an id counts as larger than
all others. Rows of one id are one document as far as order goes: none is a smaller one for
another, so their repeats stay. Extra columns are left out by
``repeated_words`` and kept by ``removed``.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import words as W
from .storage import discard, stored

WINDOW, K = 50, 10
_LAST = (1 << 63) - 1

SCANNED = ("id long, row long, digest string, n_words long, kept_sha256 string,"
           " edges array<struct<anchor: long, edge: long, lo: int, hi: int>>")
_NOTHING = hashlib.sha256(b"").hexdigest()


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values, in log(width) passes."""
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def _anchors(hashes: np.ndarray) -> np.ndarray:
    """The anchor of each window of one text with at least ``WINDOW`` words."""
    return _sliding_min(W.grams(hashes, K), WINDOW - K + 1)


def _texts(batch: pa.RecordBatch):
    """Slices of a batch with their words, and the word hashes of each text."""
    for part in W.sliced(batch):
        found = W.of(part.column("text"))
        hashes = found.hashes()
        yield part, found, [hashes[lo:hi] for lo, hi in zip(found.first[:-1], found.first[1:])]


def _scan(batches):
    for batch in batches:
        n, shas, edges, lengths = [], [], [], []
        for part, found, texts in _texts(batch):
            for i, own in enumerate(texts):
                n.append(len(own))
                shas.append(hashlib.sha256(found.joined(i, np.ones(len(own), bool))).hexdigest())
                if len(own) < WINDOW:
                    lengths.append(0)
                    continue
                anchors = _anchors(own)
                lo = np.concatenate([[0], np.flatnonzero(anchors[1:] != anchors[:-1]) + 1])
                hi = np.concatenate([lo[1:], [len(anchors)]])
                edges.append((W.signed(anchors[lo]), W.signed(W.spans(own, lo, hi + WINDOW - 1)),
                              lo.astype(np.int32), hi.astype(np.int32)))
                lengths.append(len(lo))
        columns = [np.concatenate(c) for c in zip(*edges)] if edges else [
            np.zeros(0, t) for t in (np.int64, np.int64, np.int32, np.int32)]
        values = pa.StructArray.from_arrays([pa.array(c) for c in columns],
                                            ["anchor", "edge", "lo", "hi"])
        offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("row"), batch.column("digest"),
             pa.array(n, pa.int64()), pa.array(shas, pa.string()),
             pa.ListArray.from_arrays(offsets, values)],
            names=["id", "row", "digest", "n_words", "kept_sha256", "edges"])


def _windows(batches):
    """Hashes of the windows in given ranges of each text."""
    for batch in batches:
        lo, hi, anchor, window = [], [], [], []
        for part, _, texts in _texts(batch):
            for own, ranges in zip(texts, part.column("ranges")):
                places = np.concatenate([np.arange(r["lo"], r["hi"]) for r in ranges.as_py()])
                windows = W.grams(own, WINDOW)[places]
                # a word said over and over makes one window many times: one row for the run
                first = np.flatnonzero(np.concatenate(
                    [[True], (windows[1:] != windows[:-1]) | (np.diff(places) != 1)]))
                lo.append(places[first])
                hi.append(places[np.append(first[1:], len(places)) - 1] + 1)
                anchor.append(_anchors(own)[places[first]])
                window.append(windows[first])
        if lo:
            rows = pa.array(np.repeat(np.arange(len(lo)), [len(x) for x in lo]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(rows), batch.column("row").take(rows),
                 pa.array(W.signed(np.concatenate(anchor))), pa.array(W.signed(np.concatenate(window))),
                 *(pa.array(np.concatenate(x).astype(np.int32)) for x in (lo, hi))],
                names=["id", "row", "anchor", "window", "lo", "hi"])


def _proofs(batches):
    """A digest of the words of each path in a text: ``head, id, row, later, lo, hi, proof``."""
    for batch in batches:
        heads, later, lo, hi, proofs, lengths = [], [], [], [], [], []
        for part, found, texts in _texts(batch):
            for i, runs in enumerate(part.column("runs")):
                places = runs.as_py()
                lengths.append(len(places))
                for run in places:
                    inside = found.joined(i, slice(run["lo"], run["hi"] + WINDOW - 1))
                    proofs.append(hashlib.blake2b(inside, digest_size=8).digest())
                    heads.append(run["head"])
                    later.append(run["later"])
                    lo.append(run["lo"])
                    hi.append(run["hi"])
        rows = pa.array(np.repeat(np.arange(len(lengths)), lengths).astype(np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(heads, pa.int64()), batch.column("id").take(rows), batch.column("row").take(rows),
             pa.array(later, pa.bool_()), pa.array(lo, pa.int32()), pa.array(hi, pa.int32()),
             pa.array(np.frombuffer(b"".join(proofs), np.int64))],
            names=["head", "id", "row", "later", "lo", "hi", "proof"])


def _kept(n: int, spans: list | None) -> np.ndarray:
    keep = np.ones(n, bool)
    for s in spans or []:
        keep[s["lo"]:s["hi"] + WINDOW - 1] = False
    return keep


def _digest_cut(batches):
    for batch in batches:
        removed, shas = [], []
        for part, found, texts in _texts(batch):
            for i, spans in enumerate(part.column("spans")):
                keep = _kept(len(texts[i]), spans.as_py())
                removed.append(len(keep) - int(keep.sum()))
                shas.append(hashlib.sha256(found.joined(i, keep)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("row"), pa.array(removed, pa.int64()),
             pa.array(shas, pa.string())], names=["id", "row", "n_removed", "kept_sha256"])


def _cut_text(batches):
    """Texts without their spans; a removed run of words goes with the white space after it."""
    for batch in batches:
        out = []
        for part, found, texts in _texts(batch):
            for i, spans in enumerate(part.column("spans")):
                n, lo = len(texts[i]), found.first[i]
                keep = _kept(n, spans.as_py())
                starts, end = found.starts[lo:lo + n], found.offsets[i + 1]
                begins = np.flatnonzero(~keep & np.concatenate([[True], keep[:-1]]))
                finishes = np.flatnonzero(~keep & np.concatenate([keep[1:], [True]]))
                at, pieces = found.offsets[i], []
                for b, f in zip(begins.tolist(), finishes.tolist()):
                    pieces.append(found.data[at:starts[b]].tobytes())
                    at = starts[f + 1] if f + 1 < n else end
                pieces.append(found.data[at:end].tobytes())
                out.append(b"".join(pieces).decode())
        yield batch.set_column(batch.schema.get_field_index("text"), "text",
                               pa.array(out, pa.string())).drop_columns(["spans"])


def _keyed(docs: DataFrame) -> DataFrame:
    """``id`` (a place after all others where there is none), ``row`` (tells rows of one id
    apart) and ``text``."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.coalesce("doc_id", F.lit(_LAST)).alias("id"),
                       F.xxhash64(text).alias("row"), text.alias("text"))


def _scanned(docs: DataFrame) -> DataFrame:
    """Every row's words, edges, ``owner`` (the smallest id with the same text), and ``source``:
    whether the row is the one of its text that enters the graph."""
    rows, _ = stored(_keyed(docs).withColumn("digest", F.md5("text")).mapInArrow(_scan, SCANNED)
                     .withColumn("no", F.monotonically_increasing_id()), "scanned")
    several = rows.groupBy("digest").agg(
        F.min(F.struct("id", "no")).alias("x"), F.count(F.lit(1)).alias("n")).where("n > 1").select(
        "digest", F.col("x.id").alias("owner"), F.col("x.no").alias("source"))
    # the other columns stay away from the shuffle, so copies of one text are narrow rows
    copies = rows.select("digest", "no", F.col("id").alias("own")).join(several, "digest").select(
        "no", "owner", (F.col("no") == F.col("source")).alias("source"))
    return rows.join(copies, "no", "left").withColumns(
        {"owner": F.coalesce("owner", "id"), "source": F.coalesce("source", F.lit(True))})


def _edges(scanned: DataFrame) -> DataFrame:
    """``id, row, anchor, edge, lo, hi`` and the anchors ``prev`` and ``next`` to either side."""
    edges = F.col("edges")
    sided = F.transform(edges, lambda e, i: F.struct(
        e["anchor"].alias("anchor"), e["edge"].alias("edge"), e["lo"].alias("lo"), e["hi"].alias("hi"),
        F.get(edges, i - 1)["anchor"].alias("prev"), F.get(edges, i + 1)["anchor"].alias("next")))
    return scanned.where("source").select("id", "row", F.inline(sided))


def _links(unbranched: DataFrame) -> DataFrame:
    """``a, b, width`` from occurrences of edges that do not branch: each ``a`` is followed by
    ``b`` wherever it is, and each ``b`` led by ``a``; ``width`` is the windows of ``a``."""
    ends = unbranched.groupBy("anchor").agg(
        *[f(c).alias(f"{c}{i}") for c in ("prev", "next") for i, f in enumerate((F.min, F.max))],
        *[F.count_if(F.col(c).isNull()).alias(f"no_{c}") for c in ("prev", "next")],
        F.max(F.col("hi") - F.col("lo")).cast("long").alias("width"))
    ahead = ends.where("next0 = next1 and no_next = 0").select(
        F.col("anchor").alias("a"), F.col("next0").alias("b"), "width")
    back = ends.where("prev0 = prev1 and no_prev = 0").select(
        F.col("prev0").alias("a"), F.col("anchor").alias("b"))
    return ahead.join(back, ["a", "b"])


def paths(links: DataFrame) -> tuple[DataFrame, str]:
    """``node, head, before`` of each linked edge but the heads, by pointer jumping; also its path.

    ``links`` has ``a, b, width``, with each ``a`` and each ``b`` once and no cycle; a text ends, so
    edges that always follow each other in a ring cannot be. ``before`` is the windows from
    the head to the node. A pointer that has not arrived is at a node of its own, so each round
    joins one row to one.
    """
    spark = links.sparkSession
    links, links_at = stored(links, "paths")
    now, path = stored(links.join(links.select(F.col("b").alias("a"), F.lit(True).alias("led")), "a", "left")
                       .select(F.col("b").alias("node"), F.col("a").alias("head"),
                               F.col("width").alias("before"), F.col("led").isNull().alias("arrived")), "paths")
    discard(spark, links_at)
    while not now.where("not arrived").isEmpty():
        ahead = now.select(F.col("node").alias("head"), F.col("head").alias("h"),
                           F.col("before").alias("more"), F.col("arrived").alias("there"))
        jumped = now.where("not arrived").join(ahead, "head").select(
            "node", F.col("h").alias("head"), (F.col("before") + F.col("more")).alias("before"),
            F.col("there").alias("arrived"))
        then, at = stored(now.where("arrived").unionByName(jumped), "paths")
        discard(spark, path)
        now, path = then, at
    return now.drop("arrived"), path


def _runs(unbranched: DataFrame, links: DataFrame) -> tuple[DataFrame, str]:
    """``head, id, row, later, lo, hi``: each place of each path, and whether a document of smaller
    id has it; also the path of a table it reads."""
    found, path = paths(links)
    widths = unbranched.groupBy("anchor").agg(
        F.max(F.col("hi") - F.col("lo")).cast("long").alias("width"))
    extents = found.join(widths, F.col("node") == F.col("anchor")).groupBy("head").agg(
        F.max(F.col("before") + F.col("width")).alias("extent"))
    heads = unbranched.withColumnRenamed("anchor", "head").join(
        found.select(F.col("node").alias("head")), "head", "left_anti").join(extents, "head", "left")
    return heads.select("head", "id", "row", (F.col("id") > F.col("first")).alias("later"), "lo", F.coalesce(
        F.col("lo") + F.col("extent"), "hi").cast("int").alias("hi")), path


def _with_texts(docs: DataFrame, places: DataFrame) -> DataFrame:
    """Texts of the rows ``id, row`` of ``places``; rows that repeat a row are one."""
    return _keyed(docs).join(places, ["id", "row"]).dropDuplicates(["id", "row"])


def _spans(docs: DataFrame, scanned: DataFrame) -> DataFrame:
    """``id, row, spans`` (first and behind the last window) of rows with repeated windows,
    but for rows whose whole text is an earlier one's."""
    edges = _edges(scanned)
    # both are stored, so that the joins below read plain shuffles, which can be split
    nodes, nodes_at = stored(edges.groupBy("anchor").agg(
        F.min("id").alias("first"), F.max("id").alias("last"),
        F.min("edge").alias("e0"), F.max("edge").alias("e1"),
    ).where("first < last").select("anchor", "first", (F.col("e0") != F.col("e1")).alias("branches")),
                            "nodes")
    graph, graph_at = stored(edges.join(nodes, "anchor").drop("edge"), "graph")
    unbranched = graph.where("not branches").drop("branches")
    runs, paths_at = _runs(unbranched, _links(unbranched))
    runs = runs.groupBy("id", "row").agg(F.collect_list(F.struct("head", "later", "lo", "hi")).alias("runs"))
    proofs, proofs_at = stored(_with_texts(docs, runs).mapInArrow(
        _proofs, "head long, id long, row long, later boolean, lo int, hi int, proof long"), "proofs")
    # as a rule there are none, and neither join below moves a place
    failed, failed_at = stored(proofs.groupBy("head").agg(
        F.min("proof").alias("p0"), F.max("proof").alias("p1")).where("p0 <> p1").select("head"), "failed")
    whole = proofs.join(failed, "head", "left_anti").where("later").select("id", "row", "lo", "hi")
    looked = graph.where("branches").select("id", "row", "lo", "hi").unionByName(
        proofs.join(failed, "head", "left_semi").select("id", "row", "lo", "hi"))
    ranges = looked.groupBy("id", "row").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    windows, windows_at = stored(_with_texts(docs, ranges).mapInArrow(
        _windows, "id long, row long, anchor long, window long, lo int, hi int"), "windows")
    owners, owners_at = stored(windows.groupBy("anchor", "window").agg(
        F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").drop("last"), "owners")
    single = windows.join(owners, ["anchor", "window"]).where("id > first").select("id", "row", "lo", "hi")
    spans, _ = stored(whole.unionByName(single).groupBy("id", "row").agg(
        F.collect_list(F.struct("lo", "hi")).alias("spans")), "spans")
    discard(docs.sparkSession, nodes_at, graph_at, paths_at, proofs_at, failed_at, windows_at, owners_at)
    return spans


def repeated_words(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` to ``doc_id, n_words, n_removed, kept_sha256``, a row for each row.

    ``kept_sha256`` is the digest of the kept words joined by single spaces.
    """
    scanned = _scanned(docs)
    spans = _spans(docs, scanned)
    cut = _keyed(docs).join(spans, ["id", "row"]).mapInArrow(
        _digest_cut, "id long, row long, n_removed long, kept_sha256 string").dropDuplicates(["id", "row"])
    copy = (F.col("id") > F.col("owner")) & (F.col("n_words") >= WINDOW)
    return scanned.drop("edges", "no", "source").join(
        cut.withColumnRenamed("kept_sha256", "cut_sha256"), ["id", "row"], "left").select(
        F.nullif("id", F.lit(_LAST)).alias("doc_id"), "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(_NOTHING)).otherwise(F.coalesce("cut_sha256", "kept_sha256"))
        .alias("kept_sha256"))


def removed(docs: DataFrame) -> DataFrame:
    """Documents with their repeated passages cut out of ``text``, all columns kept.

    A document that loses every word stays, with an empty text; ``n_chars`` follows the text
    where it is there.
    """
    scanned = _scanned(docs)
    copies = scanned.where((F.col("id") > F.col("owner")) & (F.col("n_words") >= WINDOW)).select(
        F.col("id").alias("_id"), F.col("row").alias("_row"), F.lit(True).alias("_copy")).distinct()
    spans = _spans(docs, scanned).select(F.col("id").alias("_id"), F.col("row").alias("_row"), "spans")
    text = F.coalesce("text", F.lit(""))
    rows = docs.withColumns({"_id": F.coalesce("doc_id", F.lit(_LAST)), "_row": F.xxhash64(text)})
    rows = rows.join(copies, ["_id", "_row"], "left").join(spans, ["_id", "_row"], "left")
    rows = rows.withColumn("text", F.when(F.col("_copy"), F.lit("")).otherwise(F.col("text")))
    whole = rows.where("spans is null").select(*docs.columns)
    kept = rows.where("spans is not null").select(*docs.columns, "spans")
    cut = kept.mapInArrow(_cut_text, docs.schema)
    if "n_chars" in docs.columns:
        whole, cut = (x.withColumn("n_chars", F.length("text").cast("long")) for x in (whole, cut))
    return whole.unionByName(cut)
