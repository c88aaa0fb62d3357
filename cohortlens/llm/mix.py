"""Mixing sources to target weights by blocks.

The words of a source are packed end to end into blocks of fixed length.
Every output shard has the same number of block slots; how many go to which
source is a multinomial draw on the condition that each source gets its total
(the multivariate hypergeometric law), made by halving the range of shards, so
any shard finds its counts alone. The j-th slot of a source takes the block
that a keyed pseudorandom permutation of the source's block indices gives for
j; each pass over a source has its own permutation. Slots and blocks are
joined by index. Everything follows from the seed and the rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm import textops as T
from cohortlens.llm.common import numbered, stored

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
#: Words of a block; longer where the corpus would have more than MOST_SLOTS of them.
BLOCK_WORDS = 64
MOST_SLOTS = 1 << 28
SHARD_SLOTS = 4096
SEED = 20240611
_ROUNDS = np.array([0x9E3779B97F4A7C15, 0x3C6EF372FE94F82A, 0xDAA66D2C7DDF743F, 0x78DDE6E5FD29F054], dtype=np.uint64)


@dataclass(frozen=True)
class Source:
    k: int
    name: str | None
    size: int
    target: float
    blocks: int
    slots: int


def targets(sizes: list[int], weights: list[float], most: int = MOST_REPEATS) -> list[float]:
    """Shares of all sizes by weight, none above ``most`` times its size; the excess is reshared by weight."""
    out, open_ = [0.0] * len(sizes), [i for i, s in enumerate(sizes) if s > 0]
    left = float(sum(sizes))
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if weights[i] * unit > most * sizes[i]]
        if not full:
            for i in open_:
                out[i] = weights[i] * unit
            return out
        for i in full:
            out[i] = float(most * sizes[i])
            left -= out[i]
        open_ = [i for i in open_ if i not in set(full)]
    return out


def _sources(rows: DataFrame, weights, block: int) -> list[Source]:
    """One entry per source, in code-point order with null last (the mixture's own table: a row per source)."""
    found = sorted(((r["source"] is None, r["source"] or "", r["source"], int(r["n"] or 0)) for r in
                    rows.groupBy("source").agg(F.sum("size").alias("n")).collect()), key=lambda x: x[:2])
    sizes = [x[3] for x in found]
    want = targets(sizes, [weights[k % len(weights)] for k in range(len(found))])
    out = []
    for k, (x, t) in enumerate(zip(found, want)):
        blocks = -(-x[3] // block)
        out.append(Source(k, x[2], x[3], t, blocks, min(MOST_REPEATS * blocks, round(t * blocks / x[3])) if x[3] else 0))
    return out


def _draws(shard: int, shards: int, slots: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots of each source before ``shard``, and in it."""
    lo, hi, before, left = 0, shards, np.zeros_like(slots), slots.copy()
    while hi - lo > 1:
        mid = (lo + hi) // 2
        here = min(int(left.sum()), (mid - lo) * SHARD_SLOTS)
        first = np.random.default_rng([seed, lo, hi]).multivariate_hypergeometric(left, here, method="marginals")
        if shard < mid:
            left, hi = first, mid
        else:
            before, left, lo = before + first, left - first, mid
    return before, left


def _permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A keyed permutation of 0..size-1 for each row: four Feistel rounds, walked until inside."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(size, 2))).astype(np.int64) + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    size = size.astype(np.uint64)
    while len(todo):
        h, m, k = half[todo], mask[todo], key[todo]
        a, b = out[todo] >> h, out[todo] & m
        for r in range(4):
            a, b = b, a ^ (T.mix(b + k + _ROUNDS[r]) & m)
        out[todo] = a << h | b
        todo = todo[out[todo] >= size[todo]]
    return out.astype(np.int64)


def slots(spark, sources: list[Source], seed: int = SEED) -> DataFrame:
    """(shard, k, slot, block): which block each slot of each output shard takes."""
    count = np.array([s.slots for s in sources], dtype=np.int64)
    blocks = np.array([max(1, s.blocks) for s in sources], dtype=np.int64)
    shards = max(1, math.ceil(int(count.sum()) / SHARD_SLOTS))

    def run(batches):
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                before, mine = _draws(shard, shards, count, seed)
                k = np.repeat(np.arange(len(count)), mine)
                slot = np.concatenate([np.arange(b, b + m) for b, m in zip(before, mine)]) if len(count) else np.empty(0, np.int64)
                turn = slot // blocks[k]
                key = T.mix(T.mix(k.astype(np.uint64) << np.uint64(20) ^ turn.astype(np.uint64)) + np.uint64(seed))
                block = _permuted(slot % blocks[k], blocks[k], key)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), shard)), pa.array(k), pa.array(slot), pa.array(block)],
                                                 names=["shard", "k", "slot", "block"])

    return spark.range(shards).mapInArrow(run, "shard long, k long, slot long, block long")


def _counted(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, h): word count and hash of each row's text."""
    def run(batches):
        for batch in batches:
            data, off = T.utf8(batch.column(1))
            n = [np.diff(T.spans(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])[2]) for lo, hi in T.chunks(off)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(np.concatenate(n) if n else [], pa.int64()), batch.column(3)],
                                             names=["doc_id", "source", "size", "h"])

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.col("source").cast("string"),
                       F.xxhash64(text).alias("h")).mapInArrow(run, "doc_id long, source string, size long, h long")


def _planned(docs: DataFrame, weights=WEIGHTS) -> tuple[DataFrame, list[Source], int]:
    """Rows with their source's number and their first word's position in the source."""
    spark = docs.sparkSession
    rows = stored(_counted(docs))
    total = rows.agg(F.sum("size")).first()[0] or 0
    block = max(BLOCK_WORDS, -(-total // MOST_SLOTS))
    sources = _sources(rows, weights, block)
    names = spark.createDataFrame([(s.k, s.name, s.size, s.target) for s in sources] or [(0, None, 0, 0.0)],
                                  "k long, name string, source_size long, target double")
    placed = numbered(rows, ["source"], ["doc_id", "h", "size"], "start", weight="size")
    return stored(placed.join(names, F.col("source").eqNullSafe(F.col("name"))).drop("name")), sources, block


def _sorted(side: DataFrame) -> DataFrame:
    """One side of a join of two tables that grow with the corpus: files of a few numbers a row pack so small that
    their size asks for a broadcast, which the driver would hold unpacked."""
    return side.hint("merge")


def _pieces(rows: DataFrame, sources: list[Source], block: int) -> DataFrame:
    """(k, start, block, a, b, n): words a..b of a row lie in a block that the mix takes n times."""
    spark = rows.sparkSession
    own = rows.where("size > 0").select("k", "start", "size", F.explode(F.sequence(
        F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block))).alias("block"))
    cut = own.select("k", "start", "block", F.greatest(F.col("block") * block, "start").alias("a"),
                     F.least((F.col("block") + 1) * block, F.col("start") + F.col("size")).alias("b"))
    taken = slots(spark, sources).groupBy("k", "block").agg(F.count(F.lit(1)).alias("n"))
    return cut.join(_sorted(taken), ["k", "block"]).select("k", "start", "block", (F.col("a") - F.col("start")).alias("a"),
                                                  (F.col("b") - F.col("start")).alias("b"), "n")


def mix(docs: DataFrame, weights=WEIGHTS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): doc_id, size, source_size, target, taken.

    A null text has size 0 and takes nothing; rows with a null source are one
    source, the last. Repeated rows are separate rows of their source.
    """
    rows, sources, block = _planned(docs, weights)
    taken = _pieces(rows, sources, block).groupBy("k", "start").agg(F.sum((F.col("b") - F.col("a")) * F.col("n")).alias("t"))
    none = rows.where("size = 0").withColumn("t", F.lit(0).cast("long"))
    some = rows.where("size > 0").join(_sorted(taken), ["k", "start"], "left")
    return some.unionByName(none).select("doc_id", "size", "source_size", "target", F.coalesce("t", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, weights=WEIGHTS) -> DataFrame:
    """The mixture as documents: copy c of a row has the words of its blocks that are taken at least c times.

    A copy that is whole keeps its text byte for byte, else the kept words are
    joined by one space. Rows of which nothing is taken go. ``n_chars``, where
    there is such a column, is that of the copy.
    """
    docs = docs.withColumns({"doc_id": F.col("doc_id").cast("long"), "text": F.col("text").cast("string"), "source": F.col("source").cast("string")})
    rows, sources, block = _planned(docs, weights)
    same = ["source", "doc_id", "h"]
    lists = (_pieces(rows, sources, block).groupBy("k", "start").agg(F.collect_list(F.struct("a", "b", "n")).alias("pieces"))
             .join(_sorted(rows.where("size > 0").select("k", "start", *same)), ["k", "start"])
             .withColumn("rn", F.row_number().over(Window.partitionBy(*same).orderBy("start"))).drop("k", "start"))
    lists = lists.select(F.col("rn").alias("__rn"), F.col("pieces").alias("__pieces"), *(F.col(c).alias(f"__{c}") for c in same))
    own = docs.withColumn("__hash", F.xxhash64("text"))
    own = own.withColumn("__row", F.row_number().over(Window.partitionBy("source", "doc_id", "__hash").orderBy("__hash")))
    both = own.join(_sorted(lists), F.col("source").eqNullSafe(F.col("__source")) & F.col("doc_id").eqNullSafe(F.col("__doc_id"))
                    & (F.col("__hash") == F.col("__h")) & (F.col("__row") == F.col("__rn")))
    columns = docs.columns

    def run(batches):
        for batch in batches:
            at, texts = [], []
            for i, (text, pieces) in enumerate(zip(batch.column("text"), batch.column("__pieces"))):
                text = text.as_py()
                words = _words(text)
                n = np.zeros(len(words), dtype=np.int64)
                for p in pieces.as_py():
                    n[p["a"]:p["b"]] = p["n"]
                for c in range(1, int(n.max(initial=0)) + 1):
                    at.append(i)
                    texts.append(text if (n >= c).all() else " ".join(w for w, x in zip(words, n.tolist()) if x >= c))
            out = []
            for name in columns:
                own = batch.column(name)
                if name == "text":
                    out.append(pa.array(texts, own.type))
                elif name == "n_chars":
                    out.append(pa.array([len(x) for x in texts], pa.int64()).cast(own.type))
                else:
                    out.append(own.take(pa.array(at, pa.int64())))
            yield pa.RecordBatch.from_arrays(out, names=columns)

    return both.select(*columns, "__pieces").mapInArrow(run, docs.schema)


def _words(text: str) -> list[str]:
    """Words of a text, cut at the six ASCII separators only."""
    return [w.decode() for w in text.encode().split()]
