"""Conversation prefix trie: one row per distinct prefix of rebuilt conversations.

Every conversation is a sequence of (role, text) turns. A prefix is known by a
digest: two 64-bit words, each the exclusive-or of a strong hash of (position,
role, text) over its turns, so the digest of a parent is one exclusive-or away
and running digests need no task that holds a whole conversation. Grouping the
rows by digest enumerates the nodes; the group also proves that all its members
share the last turn's full SHA-256 and the parent's digest, and the job fails on a
collision instead of merging two prefixes.

Subtree totals come from node tables in numpy. The trie is cut into shards:
the nodes whose subtree has more than ``shard_rows`` turns form the crown,
everything below falls into subtrees that fit a task. A shard gives each of its
digests a slot by a minimal perfect hash (levels of bit arrays: a digest that
is alone at its place of a level owns it, the others go on to the next level;
the digest kept in a slot verifies every look-up), scatters the counts into flat
arrays and adds them up through the array of parent slots, deepest nodes first.
The crown's totals are the sums of its own nodes and of the shards below, by one
join along the crown's paths.

Bounds: texts are never shuffled, only their hashes. A hot first turn or a hot
conversation is one row per map task after partial aggregation. A shard has at
most ``shard_rows`` nodes. The ids hashed into ``ends_sha256`` travel in chunks of
1,024 in order, so the one task that hashes a node's list reads a stream and
holds one batch. Positions and running digests are numbered over range
partitions, so a conversation may be longer than a task. What grows: the crown's
join makes one row per shard and crown node above it, so one conversation of
many times ``shard_rows`` turns (no hot group, a single giant) would cost it the
square of that number.

Defined cases: null role or text is empty; rows without a ``conv_id`` belong to
no conversation and are ignored; turns that tie are ordered by role, then by the
SHA-256 of the text; repeated rows are turns of their own; a conversation without
a rebuilt turn is a member of the root only; an empty table has no node. Extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import stored

#: A subtree of at most so many turns is worked on in one task (some 200 bytes each).
SHARD_ROWS = 200_000
#: Ids of one chunk of a list of members.
CHUNK_IDS = 1024
WORDS = r"[^\x20\x09-\x0D]+"
NODE = ["depth", "a", "b"]
#: A crown of at most so many nodes (24 bytes each) is broadcast.
FEW_NODES = 100_000


# ------------------------------------------------------------------ running values over range partitions
def _running(df: DataFrame, group: str, order: list[str], sums: dict[str, tuple[Callable, Callable]]) -> DataFrame:
    """``df`` with running aggregates (row included) along ``order`` inside each ``group``.

    ``sums`` maps a new column to (aggregate, combine): ``aggregate()`` works as a
    group and as a window aggregate, ``combine(before, inside)`` adds what earlier
    partitions hold. Rows are range-partitioned by group and order and
    written; only groups that span partitions carry a total over, at most two
    rows per partition, which are broadcast.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = stored(df.repartitionByRange(n, group, *order).withColumn("__p", F.spark_partition_id()))
    totals = parts.groupBy(group, "__p").agg(*[a().alias(f"__{c}") for c, (a, _) in sums.items()])
    spans = totals.groupBy(group).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(group)
    before = Window.partitionBy(group).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    fold = {c: (F.bit_xor if c in ("a", "b") else F.sum) for c in sums}
    carry = totals.join(spans, group, "left_semi").select(group, "__p", *[fold[c](f"__{c}").over(before).alias(f"__{c}") for c in sums])
    w = Window.partitionBy("__p", group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inside = parts.select("*", *[a().over(w).alias(f"__in_{c}") for c, (a, _) in sums.items()])
    out = inside.join(F.broadcast(carry), [group, "__p"], "left")
    return out.select(*df.columns, *[f(F.coalesce(F.col(f"__{c}"), F.lit(0)), F.col(f"__in_{c}")).alias(c) for c, (_, f) in sums.items()])


def _word(digest, pos, part: int):
    """64 bits of a strong hash of (position, turn)."""
    return F.conv(F.substring(F.sha2(F.concat_ws(":", pos.cast("string"), digest), 256), 1 + 16 * part, 15), 16, 10).cast("long")


def rebuilt_turns(conversations: DataFrame, base_every: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations (conv_id, depth, turn, tokens, n) and all conversations (conv_id, n).

    Conversation c starts with the first h turns of conversation c - c % ``base_every``,
    h = crc32(c) % ``heads``, and goes on with its own turns after its first h.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("at"), role.alias("role"), F.sha2(text, 256).alias("sha"),
        F.regexp_count(text, F.lit(WORDS)).cast("long").alias("tokens"))
    placed = _running(turns, "conv_id", ["at", "role", "sha"], {"pos": (lambda: F.count(F.lit(1)), lambda x, y: x + y)})
    rows = stored(placed.select(
        "conv_id", (F.col("pos") - 1).alias("pos"), "tokens",
        F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "sha"), 256).alias("turn")))
    size = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    convs = size.select("conv_id", "own", F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(heads)).alias("h"),
                        (F.col("conv_id") - F.col("conv_id") % base_every).alias("base"))
    bases = size.select(F.col("conv_id").alias("base"), F.col("own").alias("base_own"))
    convs = stored(convs.join(bases, "base", "left").withColumn("m", F.least("h", F.coalesce("base_own", F.lit(0))))
                   .withColumn("n", F.col("m") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).drop("base_own"))
    first = rows.where(F.col("pos") < heads - 1).select(F.col("conv_id").alias("base"), "pos", "turn", "tokens")
    head = (convs.where("m > 0").select("conv_id", "base", "m", "n").join(first, "base").where("pos < m")
            .select("conv_id", (F.col("pos") + 1).alias("depth"), "turn", "tokens", "n"))
    tail = (rows.join(convs.select("conv_id", "h", "m", "n"), "conv_id").where("pos >= h")
            .select("conv_id", (F.col("pos") - F.col("h") + F.col("m") + 1).alias("depth"), "turn", "tokens", "n"))
    return head.unionByName(tail), convs.select("conv_id", "n")


def prefixes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per conversation and depth (root included): digest (a, b), parent's digest (pa, pb), turn, tokens, rest."""
    words = turns.select("*", _word(F.col("turn"), F.col("depth"), 0).alias("wa"), _word(F.col("turn"), F.col("depth"), 1).alias("wb"))
    xor = lambda x, y: x.bitwiseXOR(y)
    run = _running(words, "conv_id", ["depth"], {"a": (lambda: F.bit_xor("wa"), xor), "b": (lambda: F.bit_xor("wb"), xor)})
    rows = run.select("conv_id", "depth", "a", "b", xor(F.col("a"), F.col("wa")).alias("pa"), xor(F.col("b"), F.col("wb")).alias("pb"),
                      "turn", "tokens", (F.col("n") - F.col("depth")).alias("rest"))
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = convs.select("conv_id", zero.alias("depth"), zero.alias("a"), zero.alias("b"), none.alias("pa"), none.alias("pb"),
                        F.lit("").alias("turn"), zero.alias("tokens"), F.col("n").alias("rest"))
    return rows.unionByName(root)


def nodes_of(rows: DataFrame) -> DataFrame:
    """One row per digest; a digest whose members differ in their last turn or parent fails the job."""
    same = (F.min("turn") == F.max("turn")) & F.min("pa").eqNullSafe(F.max("pa")) & F.min("pb").eqNullSafe(F.max("pb"))
    g = rows.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("tokens").alias("tokens"), F.max("pa").alias("pa"),
        F.max("pb").alias("pb"), F.sum(F.col("rest") + 1).alias("weight"), same.alias("same"))
    checked = F.when(F.col("same"), F.col("n_convs")).otherwise(F.raise_error(F.lit("two prefixes share a digest")).cast("long"))
    return g.withColumn("n_convs", checked).drop("same")


# ------------------------------------------------------------------ a shard: minimal perfect hash and flat arrays
def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x ^ np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class SlotTable:
    """Minimal perfect hash of distinct digests: digest -> slot 0..n-1, no slot left empty."""

    def __init__(self, depth: np.ndarray, a: np.ndarray, b: np.ndarray):
        n = len(a)
        self.levels: list[tuple[np.ndarray, int]] = []
        key, used = self._key(depth, a, b), 0
        while len(key):
            if len(self.levels) == 64:
                raise RuntimeError("digests of one shard share their hash at every level")
            at = self._place(key, len(self.levels), len(key))
            alone = np.bincount(at, minlength=len(key)) == 1
            self.levels.append((alone, used))
            used += int(alone.sum())
            key = key[~alone[at]]
        self.rank = [np.cumsum(alone) - 1 + start for alone, start in self.levels]
        self.digest = np.zeros((3, n), dtype=np.int64)
        slots = self._slots(depth, a, b)
        if used != n or len(np.unique(slots)) != n:
            raise RuntimeError("slots of digests collide")
        self.digest[:, slots] = depth, a, b

    @staticmethod
    def _key(depth: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        a, b, depth = (x.astype(np.int64).view(np.uint64) for x in (a, b, depth))
        return _mix(a ^ _mix(b ^ _mix(depth, 7), 11), 13)

    @staticmethod
    def _place(key: np.ndarray, level: int, size: int) -> np.ndarray:
        return (_mix(key, 2 * level + 1) % np.uint64(size)).astype(np.int64)

    def _slots(self, depth: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = self._key(depth, a, b)
        out = np.full(len(key), -1, dtype=np.int64)
        todo = np.arange(len(key))
        for k, (alone, _) in enumerate(self.levels):
            at = self._place(key[todo], k, len(alone))
            here = alone[at]
            out[todo[here]] = self.rank[k][at[here]]
            todo = todo[~here]
        return out

    def find(self, depth: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Slot of each digest, or -1: the digest kept in the slot decides."""
        at = self._slots(depth, a, b)
        d = self.digest[:, at]
        return np.where((at >= 0) & (d[0] == depth) & (d[1] == a) & (d[2] == b), at, -1)


def shard_totals(cols: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """n_children, n_leaves, saved and parent_conv_id (-1 flag in ``inside``) of whole subtrees."""
    table = SlotTable(cols["depth"], cols["a"], cols["b"])
    slot, n = table.find(cols["depth"], cols["a"], cols["b"]), len(cols["a"])

    def scatter(values):
        out = np.zeros(n, dtype=np.int64)
        out[slot] = values
        return out

    depth, conv = scatter(cols["depth"]), scatter(cols["conv_id"])
    parent = scatter(table.find(cols["depth"] - 1, cols["pa"], cols["pb"]))
    saved = scatter((cols["n_convs"] - 1) * cols["tokens"])
    inner = parent >= 0
    children = np.bincount(parent[inner], minlength=n).astype(np.int64)
    leaves = (children == 0).astype(np.int64)
    deepest = np.argsort(-depth, kind="stable")
    deepest = deepest[inner[deepest]]
    cuts = np.flatnonzero(np.diff(depth[deepest])) + 1
    for level in np.split(deepest, cuts):
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    up = np.where(inner, conv[np.maximum(parent, 0)], 0)
    return {"n_children": children[slot], "n_leaves": leaves[slot], "saved_tokens": saved[slot],
            "inside": inner[slot], "parent_conv_id": up[slot]}


_SHARD = [*NODE, "pa", "pb", "conv_id", "n_convs", "tokens"]


def _shards(lower: DataFrame, shard_rows: int) -> DataFrame:
    """Totals of every node below the crown; ``lower`` has the digest (ta, tb) of the subtree's top."""
    def run(batches):
        held: list[pa.Table] = []
        rows = 0

        def flush(tables):
            t = pa.concat_tables(tables)
            cols = {c: t.column(c).to_numpy() for c in _SHARD}
            got = shard_totals(cols)
            arrays = [pa.array(cols[c], pa.int64()) for c in _SHARD]
            arrays += [pa.array(got[c], pa.int64()) for c in ("n_children", "n_leaves", "saved_tokens")]
            arrays.append(pa.array(got["parent_conv_id"], pa.int64(), mask=~got["inside"]))
            for batch in pa.table(arrays, names=[*_SHARD, "n_children", "n_leaves", "saved_tokens", "parent_conv_id"]).to_batches(10_000):
                yield batch

        for batch in batches:
            t = pa.Table.from_batches([batch])
            if not t.num_rows:
                continue
            top = t.column("ta").to_numpy()
            if rows + t.num_rows > shard_rows:               # hand over the subtrees that are complete
                cut = np.flatnonzero(np.diff(top, prepend=(held[-1].column("ta")[-1].as_py() if held else top[0])))
                if len(cut):
                    yield from flush([*held, t.slice(0, int(cut[-1]))])
                    held, rows, t = [], 0, t.slice(int(cut[-1]))
            held.append(t)
            rows += t.num_rows
        if rows:
            yield from flush(held)

    n = max(int(lower.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-lower.count() // shard_rows))
    dealt = lower.repartition(n, "ta").sortWithinPartitions("ta", "tb").select(*_SHARD, "ta", "tb")
    kinds = ", ".join(f"{c} long" for c in [*_SHARD, "n_children", "n_leaves", "saved_tokens", "parent_conv_id"])
    return dealt.mapInArrow(run, kinds)


# ------------------------------------------------------------------ lists of members
def ends_hashes(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending, comma-joined ids of each node's conversations that end there."""
    names = [*NODE, "first", "ids"]

    def chunk(batches):
        last, ids = None, []
        out: list[tuple] = []
        for batch in batches:
            for *node, c in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if node != last or len(ids) == CHUNK_IDS:
                    if ids:
                        out.append((*last, ids[0], ",".join(map(str, ids))))
                    last, ids = node, []
                ids.append(c)
            if len(out) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names=names)
                out = []
        if ids:
            out.append((*last, ids[0], ",".join(map(str, ids))))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names=names)

    def digest(batches):
        last, sha = None, None
        for batch in batches:
            out = []
            for *node, ids in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if node != last:
                    if last:
                        out.append((*last, sha.hexdigest()))
                    last, sha = node, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names=[*NODE, "ends_sha256"])
        if last:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*last, sha.hexdigest())], names=[*NODE, "ends_sha256"])

    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = ends.select(*NODE, "conv_id").repartitionByRange(n, *NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
    parts = ordered.mapInArrow(chunk, "depth long, a long, b long, first long, ids string")
    return (parts.repartition(n, *NODE).sortWithinPartitions(*NODE, "first").select(*NODE, "ids")
            .mapInArrow(digest, "depth long, a long, b long, ends_sha256 string"))


# ------------------------------------------------------------------ the trie
def trie(conversations: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rows = stored(prefixes(*rebuilt_turns(conversations)))
    nodes = stored(nodes_of(rows))
    crown = stored(nodes.where((F.col("weight") > shard_rows) | (F.col("depth") == 0)))
    few = crown.count() <= FEW_NODES
    hint = F.broadcast if few else (lambda d: d)
    # the crown is closed upwards: a conversation leaves it once, at the top of its shard
    on_crown = stored(rows.select("conv_id", *NODE).join(hint(crown.select(*NODE)), NODE, "left_semi"))
    leave = on_crown.groupBy("conv_id").agg((F.max("depth") + 1).alias("depth"))
    tops = rows.join(leave, ["conv_id", "depth"]).select("conv_id", F.col("a").alias("ta"), F.col("b").alias("tb"))
    below = nodes.where((F.col("weight") <= shard_rows) & (F.col("depth") > 0))
    low = stored(_shards(stored(below.join(tops, "conv_id")), shard_rows))
    heads = low.where("parent_conv_id is null")
    # the crown: children by parent, subtree sums along the paths of the nodes' smallest members
    kids = (heads.select(*NODE, "pa", "pb").unionByName(crown.select(*NODE, "pa", "pb")).where("pa is not null")
            .groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count(F.lit(1)).alias("n_children")))
    own = (crown.join(kids, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))
    given = (heads.select("conv_id", "depth", "n_leaves", "saved_tokens")
             .unionByName(own.select("conv_id", "depth", (F.col("n_children") == 0).cast("long").alias("n_leaves"),
                                     ((F.col("n_convs") - 1) * F.col("tokens")).alias("saved_tokens"))))
    paths = on_crown.withColumnRenamed("depth", "at")
    sums = (given.join(paths, "conv_id").where("at <= depth").groupBy(F.col("at").alias("depth"), "a", "b")
            .agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")))
    up = crown.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("__up"))
    top = own.join(sums, NODE).withColumn("parent_conv_id", F.lit(None).cast("long")).select(*low.columns).unionByName(heads)
    top = top.join(hint(up), ["depth", "pa", "pb"], "left").withColumn("parent_conv_id", F.col("__up"))
    out = low.where("parent_conv_id is not null").unionByName(top.select(*low.columns))
    ends = ends_hashes(rows.where("rest = 0"))
    return out.join(ends, NODE, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
