"""Shards of equal row counts that keep linked documents together: balanced label propagation.

Documents of one group (here: of equal text) are linked with each other. The links of a group
are held as one hub per group, not as pairs.

1. Groups of more than a shard's size divided by ``LARGE`` are placed first, from large to
   small: each whole into the shard with the least room that holds it. One that no room holds
   fills the largest, and its rest is placed the same way. There are at most ``LARGE`` such
   groups for each shard, so the plan is made over their counts; their rows take its parts by
   their number within the group.
2. Every other row begins in the shard that a hash of its id and text names, among the room left.
3. In each round a group's shard with most of its rows becomes its target, and its other rows
   want to move there. How many of those from shard i to shard j may do so is a quota: the
   flows are scaled until no shard takes more linked rows than ``SLACK`` times its room. A row moves if its
   hash for this round lies below the quota's share. Counting is a partial aggregate by group
   and shard, and rows learn their group's target from a join with one row per group, so a
   group with a third of all rows is never gathered. Rounds end when no row may move.
4. Exact sizes: rows are numbered in each shard, those of large groups first, then linked ones.
   Those beyond the shard's size take the free slots of other shards in order: rows without links
   first of all, else whole groups one after the other.

The law is ``rows``: counts are at most one apart. Only groups larger than a shard, large ones
that no room is left for in one shard, and few groups at the edge of a full one, are split.

Defined cases: a null text counts as empty, with size 1. Rows that repeat others are rows of
their own. A row without an id is sharded like any other. With fewer rows than shards some
shards are empty; an empty table gives an empty result. Extra columns are left out.
"""

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .storage import discard, numbered, stored

SHARDS, ROUNDS = 8, 12
#: While rows move, a shard may hold this many times its room in linked rows.
SLACK = 1.5
#: Groups above a shard's size divided by this are placed by plan.
LARGE = 16


def plan(groups: dict[str, int], size: np.ndarray) -> tuple[list[tuple[str, int, int, int]], np.ndarray]:
    """Best fit, decreasing: parts ``(group, first row, end, shard)``, and the room left."""
    room, parts = size.copy(), []
    for n, group in sorted(((n, g) for g, n in groups.items()), reverse=True):
        at = 0
        while at < n:
            holds = np.flatnonzero(room >= n - at)
            s = int(holds[room[holds].argmin()] if len(holds) else room.argmax())
            end = min(n, at + int(room[s]))
            parts.append((group, at, end, s))
            room[s] -= end - at
            at = end
    return parts, room


def allowed(wanted: np.ndarray, load: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Shares of the wanted moves ``[from, to]`` that leave no load above its size.

    Loads that are above their size at the beginning take in no more than they give.
    """
    flow = wanted.astype(float)
    for _ in range(200):
        room = np.maximum(size - load, 0) + flow.sum(axis=1)
        into = flow.sum(axis=0)
        over = into > room + 1e-9
        if not over.any():
            break
        flow[:, over] *= room[over] / into[over]
    return np.divide(flow, wanted, out=np.zeros_like(flow), where=wanted > 0)


def _draw(*key: Column | str) -> Column:
    """A number in [0, 1) from a hash."""
    return F.pmod(F.xxhash64(*key), F.lit(1 << 30)) / F.lit(float(1 << 30))


def _looked_up(table: np.ndarray, *places: Column) -> Column:
    """An entry of a small table as a column."""
    found = F.array(*[F.lit(float(x)) for x in table.ravel()])
    index = F.lit(0)
    for size, place in zip(table.shape, places):
        index = index * size + place
    return F.get(found, index)


def propagated(rows: DataFrame, size: np.ndarray, rounds: int = ROUNDS) -> tuple[DataFrame, str]:
    """Move linked rows with ``group, salt, shard`` (stored) for some rounds."""
    spark, shards = rows.sparkSession, len(size)
    now, path = rows, None
    for turn in range(rounds):
        counts = now.groupBy("group", "shard").agg(F.count(F.lit(1)).alias("n"))
        best = F.max_by("shard", F.struct("n", F.xxhash64("group", "shard")))
        targets = counts.groupBy("group").agg(
            best.alias("target"), F.collect_list(F.struct("shard", "n")).alias("held"))
        targets, targets_at = stored(targets, "targets")
        wanted, load = np.zeros((shards, shards)), np.zeros(shards)
        for r in targets.select("target", F.inline("held")).groupBy("shard", "target").agg(
                F.sum("n").alias("n")).collect():  # at most a number for each two shards
            load[r.shard] += r["n"]
            if r.shard != r.target:
                wanted[r.shard, r.target] = r["n"]
        share = allowed(wanted, load, np.ceil(size * SLACK))
        if (share * wanted).sum() < 0.5:
            discard(spark, targets_at)
            break
        moves = _draw("salt", F.lit(turn)) < _looked_up(share, F.col("shard"), F.col("target"))
        then, then_at = stored(now.join(targets.select("group", "target"), "group").select(
            "id", "group", "salt", "bytes", "crc",
            F.when(moves, F.col("target")).otherwise(F.col("shard")).alias("shard")), "shards")
        discard(spark, targets_at, *([path] if path else []))
        now, path = then, then_at
    return now, path


def sharded(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, text`` to ``doc_id, size, text_crc32, law, shard, slot, grown_shard``."""
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").alias("id"), F.md5(text).alias("group"),
                       F.octet_length(text).cast("long").alias("bytes"), F.crc32(text).alias("crc"))
    rows, _ = stored(rows.withColumn("salt", F.xxhash64("id", "group")), "rows")
    total = rows.count()
    size = np.array([total // shards + (s < total % shards) for s in range(shards)])
    several = rows.groupBy("group").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    several, several_at = stored(several, "groups")
    large = {r.group: r["n"] for r in several.where(F.col("n") * LARGE > int(size[0])).collect()}
    parts, room = plan(large, size)
    parts = F.broadcast(spark.createDataFrame(
        parts, "group string, lo long, end long, shard int"))
    # rows of a large group are numbered over ranges, so that none is gathered
    names = sorted(large)
    begins = np.cumsum([0, *(large[g] for g in names)]).tolist()
    firsts = F.broadcast(spark.createDataFrame(list(zip(names, begins)), "group string, begin long"))
    ranks, ranks_at = numbered(rows.join(firsts, "group"), F.col("group"), F.col("salt"), name="large")
    fixed = ranks.withColumn("rank", F.col("position") - F.col("begin")).join(
        parts, "group").where("rank >= lo and rank < end")
    # a shard's share of the other rows is the room it has left
    at = F.pmod("salt", F.lit(max(int(room.sum()), 1)))
    rows = rows.join(firsts, "group", "left_anti").withColumn("shard", sum(
        ((at >= int(x)).cast("int") for x in np.cumsum(room)[:-1]), F.lit(0)))
    linked, linked_at = stored(rows.join(several, "group").drop("n"), "linked")
    single = rows.join(several, "group", "left_anti")
    placed, _ = propagated(linked, room, rounds)
    columns = ["shard", "kind", "group", "salt", "id", "bytes", "crc"]
    every = [x.withColumn("kind", F.lit(kind)).select(columns) for kind, x in enumerate((fixed, placed, single))]
    ranked, _ = numbered(every[0].unionByName(every[1]).unionByName(every[2]),
                         F.col("shard"), F.col("kind"), F.col("group"), F.col("salt"), name="slots")
    discard(spark, several_at, linked_at, ranks_at)

    load = np.zeros(shards, np.int64)
    for r in ranked.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect():
        load[r.shard] = r["n"]
    over, free = np.maximum(load - size, 0), np.maximum(size - load, 0)
    before = lambda x: np.cumsum(x) - x
    rank = F.col("position") - _looked_up(before(load), F.col("shard"))
    own_size = _looked_up(size, F.col("shard"))
    ranked = ranked.withColumn("rank", rank.cast("long")).withColumn(
        "extra", F.when(F.col("rank") >= own_size, (
            F.col("rank") - own_size + _looked_up(before(over), F.col("shard"))).cast("long")))
    new, begins = F.lit(None).cast("int"), before(free)
    for s in np.flatnonzero(free).tolist():
        new = F.when(F.col("extra") >= int(begins[s]), F.lit(s)).otherwise(new)
    ranked = ranked.withColumn("new", new)
    slot = F.col("extra") - _looked_up(begins, F.col("new")) + _looked_up(load, F.col("new"))
    stays = F.col("extra").isNull()
    return ranked.select(
        F.col("id").alias("doc_id"), (F.col("bytes") + 1).alias("size"), F.col("crc").alias("text_crc32"),
        F.lit("rows").alias("law"), F.when(stays, F.col("shard")).otherwise(F.col("new")).alias("shard"),
        F.when(stays, F.col("rank")).otherwise(slot.cast("long")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
