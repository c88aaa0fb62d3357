"""MinHash near-dedup by a signature-coordinate inverted join.

Every document gets a signature of ``SIGNATURE`` minimum hashes over its set of
word shingles. It is posted under each (coordinate, value) pair; pairs of
documents that collide in at least ``MATCHES`` coordinates are retained and
confirmed on their full shingle sets.

*Prefix*: values are ordered by how many documents carry them, rarest first. A
pair with ``MATCHES`` collisions shares one of the first
``SIGNATURE - MATCHES + 1`` values, so only those are merged; the frequent rest
is probed through the signature.
*Skip*: a posting list is merged against its smallest document, linked documents
become components, and a list that lies in one component is skipped. So a list
of n copies costs about n pairs. The documents of the other lists are merged
once more across components, by the same prefix rule on their shingles, so no
link between different components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm import textops as T
from cohortlens.llm.common import components, stored

SHINGLE = 5
#: Similarity a pair must reach, in hundredths.
SIMILAR = 75
SIGNATURE = 64
#: Collisions of a retained pair. A pair at 0.75 collides in 48 of 64 coordinates
#: on average, with a deviation of 3.5; fewer than 30 has a chance below 1e-6.
MATCHES = 30

_RNG = np.random.default_rng(7411)
_A = _RNG.integers(1, 1 << 63, SIGNATURE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 1 << 63, SIGNATURE, dtype=np.uint64)


def _sets(data: np.ndarray, off: np.ndarray, shingle: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each row; one for a row with fewer words than a shingle."""
    low = T.LOWER[data]
    starts, ends, first = T.spans(low, off)
    words = T.word_hashes(low, starts, ends)
    grams = T.gram_hashes(words, shingle)
    for lo, hi in zip(first[:-1], first[1:]):
        n = hi - lo
        if n == 0:
            yield np.empty(0, dtype=np.uint64)
        elif n < shingle:
            yield T.gram_hashes(words[lo:hi], int(n), salt=int(n))
        else:
            yield np.unique(grams[lo:hi - shingle + 1])


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of minimum hashes per set; an empty set's row has no meaning."""
    out = np.zeros((len(sets), SIGNATURE), dtype=np.uint64)
    full = [i for i, s in enumerate(sets) if len(s)]
    while full:
        take, n = 0, 0
        while take < len(full) and (n == 0 or n + len(sets[full[take]]) <= 32768):
            n += len(sets[full[take]])
            take += 1
        rows, full = full[:take], full[take:]
        values = np.concatenate([sets[i] for i in rows])
        at = np.concatenate([[0], np.cumsum([len(sets[i]) for i in rows])[:-1]])
        for k in range(SIGNATURE):
            out[rows, k] = np.minimum.reduceat(values * _A[k] + _B[k], at)
    return (T.mix(out) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def signatures(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, d1, d2, sig) per row; ``d1, d2`` tell shingle sets apart, empty sets have no ``sig``."""
    schema = "doc_id long, n_shingles long, d1 long, d2 long, sig array<int>"

    def run(batches):
        for batch in batches:
            data, off = T.utf8(batch.column(1))
            for lo, hi in T.chunks(off):
                sets = list(_sets(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], shingle))
                n = [len(s) for s in sets]
                d1 = [T.mix(s ^ np.uint64(0xA5A5)).sum(dtype=np.uint64).view(np.int64) for s in sets]
                d2 = [np.bitwise_xor.reduce(T.mix(s + np.uint64(0x5A5A5A))).view(np.int64) for s in sets]
                sigs = [row if k else None for row, k in zip(_signatures(sets), n)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(d1, pa.int64()),
                     pa.array(d2, pa.int64()), pa.array(sigs, pa.list_(pa.int32()))],
                    names=["doc_id", "n_shingles", "d1", "d2", "sig"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def shingle_sets(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, shingles) with the full set of each row."""
    def run(batches):
        for batch in batches:
            data, off = T.utf8(batch.column(1))
            for lo, hi in T.chunks(off, 1 << 20):
                sets = list(_sets(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], shingle))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo).cast(pa.int64()),
                     pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["doc_id", "shingles"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, shingles array<long>")


def _prefixes(reps: DataFrame) -> DataFrame:
    """(elem, rep): the rarest values of each signature, without those that only one document has."""
    posts = reps.select("rep", F.posexplode("sig")).select(
        "rep", F.shiftleft(F.col("pos").cast("long"), 32).bitwiseOR(F.col("col").cast("long").bitwiseAND(F.lit(0xFFFFFFFF))).alias("elem"))
    often = posts.groupBy("elem").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    lists = (posts.join(often, "elem").groupBy("rep")
             .agg(F.sort_array(F.collect_list(F.struct("df", "elem"))).alias("e"))
             .where(F.size("e") >= MATCHES))
    return lists.select("rep", F.explode(F.slice("e", F.lit(1), F.size("e") - MATCHES + 1)).alias("e")).select(
        F.col("e.elem").alias("elem"), "rep")


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar, as links (u, v)."""
    side = lambda x, y: sets.select(F.col("rep").alias(x), F.col("shingles").alias(y))
    both = pairs.join(side("a", "ta"), "a").join(side("b", "tb"), "b")
    inter = F.size(F.array_intersect("ta", "tb"))
    return both.where(100 * inter >= SIMILAR * (F.size("ta") + F.size("tb") - inter)).select(
        F.col("a").alias("u"), F.col("b").alias("v"))


def _confirmed(pairs: DataFrame, sigs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of like size with enough collisions whose full sets are similar."""
    side = lambda x, y, n: sigs.select(F.col("rep").alias(x), F.col("sig").alias(y), F.col("n_shingles").alias(n))
    near = (pairs.join(side("a", "sa", "na"), "a").join(side("b", "sb", "nb"), "b")
            .where(100 * F.least("na", "nb") >= SIMILAR * F.greatest("na", "nb"))
            .where(F.size(F.filter(F.zip_with("sa", "sb", lambda x, y: x == y), lambda x: x)) >= MATCHES).select("a", "b"))
    return _similar(near, sets)


def _across(nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components c that can be similar: the same prefix merge, on the shingles themselves.

    With shingles ordered rarest first, similar sets share one among their
    first ``n - ceil(0.75 n) + 1``, and from their first common place on enough
    are left in both. So texts that only share a passage never meet unless it
    makes up three quarters of them.
    """
    n = F.size("shingles").cast("long")
    posts = nodes.select("rep", "c", n.alias("n"), F.explode("shingles").alias("s"))
    often = posts.groupBy("s").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = (posts.join(often, "s").groupBy("rep", "c", "n")
              .agg(F.sort_array(F.collect_list(F.struct("df", "s"))).alias("e")).withColumn("alone", F.col("n") - F.size("e"))
              .withColumn("first", F.col("n") - F.ceil(F.col("n") * SIMILAR / 100) + 1 - F.col("alone")).where("first > 0"))
    heads = shared.select("rep", "c", "n", "alone", F.posexplode(F.slice("e", F.lit(1), F.col("first").cast("int"))).alias("at", "e")).select(
        "rep", "c", (F.col("n") - F.col("alone") - F.col("at")).alias("left"), "n", F.col("e.s").alias("s"))
    one, two = (heads.select("s", *(F.col(c).alias(f"{c}_{x}") for c in ("rep", "c", "left", "n"))) for x in "ab")
    fits = (F.col("rep_a") < F.col("rep_b")) & (F.col("c_a") != F.col("c_b")) & (
        100 * F.least("n_a", "n_b") >= SIMILAR * F.greatest("n_a", "n_b")) & (
        (100 + SIMILAR) * F.least("left_a", "left_b") >= SIMILAR * (F.col("n_a") + F.col("n_b")))
    return one.join(two, "s").where(fits).select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    A null text or one without words has ``n_shingles`` 0 and is alone. A row
    with a null doc_id links with nothing, has a null component and is kept.
    Rows that share a doc_id are texts of one node, which links wherever one of
    them does; each row is returned. Equal sets are
    linked through one representative and never paired. Ties do not arise: a
    component is named by its smallest doc_id.
    """
    t = stored(signatures(docs, shingle))
    reps = stored(t.where("n_shingles > 0 and doc_id is not null").groupBy("d1", "d2", "n_shingles")
                  .agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig")))
    lists = stored(_prefixes(reps))
    nodes = lists.select("rep").distinct()
    sigs = stored(reps.join(nodes, "rep", "left_semi").select("rep", "sig", "n_shingles"))
    sets = stored(shingle_sets(docs.join(nodes.withColumnRenamed("rep", "doc_id"), "doc_id", "left_semi"), shingle)
                  .select(F.col("doc_id").alias("rep"), "shingles"))

    heads = lists.groupBy("elem").agg(F.min("rep").alias("a"))
    star = lists.join(heads, "elem").where("rep <> a").select("a", F.col("rep").alias("b")).distinct()
    links = stored(_confirmed(star, sigs, sets))
    comp = stored(components(links))
    named = lists.join(comp.withColumnRenamed("node", "rep"), "rep", "left").select(
        "elem", "rep", F.coalesce("component", "rep").alias("c"))
    split = named.groupBy("elem").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("elem")
    open_nodes = stored(named.join(split, "elem", "left_semi").select("rep", "c").distinct())
    more = stored(_similar(_across(sets.join(open_nodes, "rep")), sets))
    if not more.isEmpty():
        comp = stored(components(links.union(more)))
    classes = (reps.join(comp.withColumnRenamed("node", "rep"), "rep", "left")
               .select("d1", "d2", "n_shingles", F.coalesce("component", "rep").alias("component_id")))
    out = t.select("doc_id", "n_shingles", "d1", "d2").join(classes, ["d1", "d2", "n_shingles"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
