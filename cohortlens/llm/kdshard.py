"""K-d tree sharding: nodes are split at weighted medians along their widest metadata dimension.

The units of the tree are groups of equal texts, which stay together; a group
larger than a hundredth of a shard is cut into pieces by hashed doc_id, so a
hot group is spread like any other rows. A node for m shards is cut where its
left part has the bytes of m // 2 of them. The median is found by radix
refinement: all nodes of a level add up their bytes per key bucket in one
aggregate, and only the bucket that holds the cut is refined. The driver sees
bounded tables alone: at most ``BUCKETS`` rows per node and pass, and the at
most ``LAST`` units in the bucket where the refinement ends. Of those, the
left part takes the subset that fills it best. Rows are placed by the cuts
themselves, without a join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import numbered, stored

SHARDS = 24
BUCKET_BITS = 10
BUCKETS = 1 << BUCKET_BITS
LAST = 64
#: Bits of a key: the coordinate, then a hash of the unit that orders ties.
VALUE_BITS, TIE_BITS = 20, 40
#: Most of a shard's bytes that one group of equal texts keeps together.
GROUP_SHARE = 0.01
#: Bytes that a row costs beside its text.
ROW_BYTES = 8
DIMENSIONS = ("source_at", "lang_at", "size_at", "text_at")


@dataclass
class Node:
    first: int
    shards: int


def _coordinates(docs: DataFrame) -> DataFrame:
    """Size, checksum and metadata coordinates in [0, 1] of each row; nulls lie at 0."""
    text = F.col("text").cast("string")
    unit = lambda c: F.coalesce(F.crc32(F.col(c).cast("string")), F.lit(0)) / float(1 << 32)
    have = lambda c: unit(c) if c in docs.columns else F.lit(0.0)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
                    F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"), F.xxhash64(text).alias("tx"),
                    have("source").alias("source_at"), have("lang").alias("lang_at"))
    return d.withColumn("size_at", F.least(F.lit(1.0), F.log2("size") / 32.0)).withColumn("text_at", F.col("text_crc32") / float(1 << 32))


def _key(dim: str) -> Column:
    value = F.least(F.floor(F.col(dim) * (1 << VALUE_BITS)), F.lit((1 << VALUE_BITS) - 1))
    return F.shiftleft(value.cast("long"), TIE_BITS).bitwiseOR(F.col("tie"))


def _choice(nodes: dict[int, object], value) -> Column:
    """CASE over the open nodes (a few dozen at most)."""
    out = None
    for n, x in nodes.items():
        out = F.when(F.col("node") == n, value(x)) if out is None else out.when(F.col("node") == n, value(x))
    return out


def _cuts(units: DataFrame, split: dict[int, str], goal: dict[int, float]) -> dict[int, tuple[int, list[int]]]:
    """For each node the key below which units go left, and the keys in the last bucket that go left too."""
    keyed = units.where(F.col("node").isin(list(split))).select("node", _choice(split, _key).alias("key"), "w")
    lo = {n: 0 for n in split}
    width = {n: 1 << (VALUE_BITS + TIE_BITS) for n in split}
    left = dict(goal)
    ends: list[int] = []
    done: dict[int, tuple[int, list[int]]] = {}

    def inside(nodes: list[int]) -> DataFrame:
        return keyed.where(_choice({n: n for n in nodes}, lambda n: (F.col("key") >= lo[n]) & (F.col("key") < lo[n] + width[n])))

    while todo := [n for n in split if n not in done and n not in ends]:
        step = {n: max(1, width[n] >> BUCKET_BITS) for n in todo}
        bucket = _choice({n: n for n in todo}, lambda n: F.expr(f"(key - {lo[n]}L) div {step[n]}L"))
        found = inside(todo).groupBy("node", bucket.alias("b")).agg(F.sum("w").alias("w"), F.count(F.lit(1)).alias("n")).collect()
        for n in todo:
            rows = sorted((r for r in found if r["node"] == n), key=lambda r: r["b"])
            i = 0
            while i < len(rows) - 1 and left[n] >= rows[i]["w"]:
                left[n] -= rows[i]["w"]
                i += 1
            # the buckets beside it join while few units lie in all of them: more to fill the left part with
            j, units_in = i, rows[i]["n"]
            small = units_in <= LAST
            while small and (grow := [x for x in (i - 1, j + 1) if 0 <= x < len(rows) and units_in + rows[x]["n"] <= LAST]):
                x = grow[0]
                units_in += rows[x]["n"]
                left[n] += rows[x]["w"] if x < i else 0
                i, j = min(i, x), max(j, x)
            base = lo[n]
            lo[n], width[n] = base + rows[i]["b"] * step[n], (rows[j]["b"] - rows[i]["b"] + 1) * step[n]
            if small or step[n] == 1:
                ends.append(n)
    rows = inside(ends).groupBy("node", "key").agg(F.sum("w").alias("w")).collect() if ends else []
    for n in ends:
        take, room = [], left[n]
        mine = sorted((r for r in rows if r["node"] == n), key=lambda r: (-r["w"], r["key"]))
        for r in mine:
            if r["w"] <= room:
                take.append(r["key"])
                room -= r["w"]
        rest = [r for r in mine if r["key"] not in take]
        if rest and rest[-1]["w"] < 2 * room:
            take.append(rest[-1]["key"])
        done[n] = (lo[n], take)
    return done


def shard(docs: DataFrame, shards: int | None = SHARDS, target_bytes: int | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``target_bytes`` sets the number of shards from the total, else ``shards``
    holds. Null texts have no bytes and checksum 0; missing or null metadata
    lies at the lower end of its dimension; rows with a null doc_id are placed
    like others. Slots count the rows of a shard from 0.
    """
    t = stored(_coordinates(docs))
    total = t.agg(F.sum("size")).first()[0] or 0
    if target_bytes:
        shards = max(1, -(-total // target_bytes))
    same = ["tx", "text_crc32", "size"]
    limit = max(1.0, GROUP_SHARE * total / shards)
    groups = t.groupBy(*same).agg(F.sum("size").alias("bytes"), F.min("source_at").alias("source_at"), F.min("lang_at").alias("lang_at"))
    grouped = t.drop("source_at", "lang_at").join(groups, same)
    pieces = F.greatest(F.lit(1), F.ceil(F.col("bytes") / limit)).cast("long")
    piece = F.pmod(F.xxhash64("doc_id"), pieces)
    rows = stored(grouped.withColumn("piece", piece)
                  .withColumn("tie", F.shiftrightunsigned(F.xxhash64(*same), 64 - TIE_BITS + 10))
                  .withColumn("tie", F.shiftleft("tie", 10).bitwiseOR(F.pmod(F.xxhash64("tx", "piece"), F.lit(1024)))).drop("bytes"))
    units = rows.groupBy(*same, "piece", "tie", *DIMENSIONS).agg(F.sum("size").alias("w")).select(*DIMENSIONS, "tie", "w", F.lit(0).alias("node"))
    units = stored(units)
    placed = rows.withColumn("node", F.lit(0))
    nodes, free = {0: Node(0, shards)}, 1
    while open_ := [n for n, x in nodes.items() if x.shards > 1]:
        wide = units.where(F.col("node").isin(open_)).groupBy("node").agg(
            F.sum("w").alias("w"), *(F.max(d).alias(f"hi_{d}") for d in DIMENSIONS), *(F.min(d).alias(f"lo_{d}") for d in DIMENSIONS)).collect()
        split = {r["node"]: max(DIMENSIONS, key=lambda d: r[f"hi_{d}"] - r[f"lo_{d}"]) for r in wide}
        goal = {r["node"]: r["w"] * (nodes[r["node"]].shards // 2) / nodes[r["node"]].shards for r in wide}
        cuts = _cuts(units, split, goal) if split else {}
        right = {}
        for n in open_:
            half = nodes[n].shards // 2
            nodes[free] = Node(nodes[n].first + half, nodes[n].shards - half)
            nodes[n].shards = half
            right[n], free = free, free + 1

        def step(d: DataFrame) -> DataFrame:
            if not cuts:
                return d
            key = _choice(split, _key)
            out = None
            for n, (low, take) in cuts.items():
                goes_left = (F.col("__key") < low) | F.col("__key").isin(take) if take else F.col("__key") < low
                cond = (F.col("node") == n) & ~goes_left
                out = F.when(cond, F.lit(right[n])) if out is None else out.when(cond, F.lit(right[n]))
            return d.withColumn("__key", key).withColumn("node", out.otherwise(F.col("node"))).drop("__key")

        units = stored(step(units))
        placed = step(placed)
    names = _choice({n: x.first for n, x in nodes.items()}, F.lit)
    done = placed.select("doc_id", "size", "text_crc32", "tx", names.cast("int").alias("shard"))
    done = numbered(stored(done), ["shard"], ["doc_id", "tx"], "slot")
    return done.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
