"""M4 as Spark jobs: a bootstrap forest over binned rows.

MLlib sends, per level, the dense statistics of every node of 200 trees from every
partition; deep trees have a hundred thousand nodes of a few rows each. Here only
nodes of many rows are split that way (partial sums per task, added by Spark). As
soon as a node's rows fit a task they are brought together, one group per (tree,
node), and the subtree below is grown there. Every tree's bag is dealt from a hash of
the row, so no pass depends on how rows lie in partitions.

Splits follow MLlib: at most 32 bins per feature, ``ceil(sqrt)`` features per node,
Gini gain on weighted counts, ``min_samples_leaf`` on bag counts, and sibling leaves
that predict the same class are merged. MLlib's own model can be loaded from the
node table that Spark writes.
"""

from __future__ import annotations

import json
import uuid

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.util import MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.session import ensure_checkpoint_dir, materialize, parallelism

MAX_BINS = 32
#: Rows of a bag in a node that one task takes over with everything below.
NODE_ROWS = 200_000
#: (row, tree) pairs that one job brings together; more trees than that go in further jobs.
PAIRS_PER_JOB = 400_000_000
BLOCK = 8192
#: Bytes of subtrees that one scoring task holds.
SLICE_BYTES = 32 << 20
LEAST_GAIN = 1e-14
PURE = 2.2e-16
#: Cumulative probabilities of a Poisson draw of mean 1, the count of a row in a bag.
POISSON = np.cumsum(np.exp(-1.0) / np.cumprod(np.r_[1.0, np.arange(1.0, 17.0)]))

NODE = ("id int, prediction double, impurity double, impurityStats array<double>, rawCount long, gain double, leftChild int, rightChild int, "
        "split struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,numCategories:int>")


# ------------------------------------------------------------------ binned rows
def feature_cuts(x: DataFrame, n_features: int, bins: int = MAX_BINS) -> list[np.ndarray]:
    """Split thresholds per position of the array column ``x``: midpoints of its values, or quantiles where there are more than ``bins``."""
    values = materialize(x.select(F.posexplode("x").alias("f", "v")).groupBy("f", "v").agg(F.count(F.lit(1)).alias("n")), "table")
    distinct = {r["f"]: r["d"] for r in values.groupBy("f").agg(F.count(F.lit(1)).alias("d")).collect()}
    few = [f for f, d in distinct.items() if d <= bins]
    many = [f for f, d in distinct.items() if d > bins]
    by_feature: dict[int, list[float]] = {}
    for r in values.where(F.col("f").isin(few)).select("f", "v").collect() if few else []:     # bins a feature at most
        by_feature.setdefault(r["f"], []).append(r["v"])
    cuts = {f: (lambda s: (s[:-1] + s[1:]) / 2)(np.unique(vs)) for f, vs in by_feature.items()}
    shares = [i / bins for i in range(1, bins)]
    if many:
        row = x.agg(*[F.percentile_approx(F.get("x", F.lit(f)), shares, 10000).alias(str(f)) for f in many]).first()
        cuts |= {f: np.unique(np.array(row[str(f)], dtype=float)) for f in many}
    return [cuts.get(f, np.empty(0)) for f in range(n_features)]


def binned_blocks(rows: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    """``rows`` (key, x, label, weight) in blocks: bin codes by feature, labels, weights and keys as byte strings."""
    n = len(cuts)

    def run(batches):
        for whole in batches:
            for lo in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(lo, BLOCK)
                x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, n)
                codes = np.empty((n, len(x)), dtype=np.uint8)
                for f, c in enumerate(cuts):
                    codes[f] = np.searchsorted(c, x[:, f], side="left")
                key, label, weight = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 2, 3))
                yield pa.RecordBatch.from_pydict({"n": pa.array([len(x)], pa.int32()), "keys": [key.astype(np.int64).tobytes()], "codes": [codes.tobytes()],
                                                  "labels": [label.astype(np.int16).tobytes()], "weights": [weight.astype(np.float64).tobytes()]})

    blocks = rows.mapInArrow(run, "n int, keys binary, codes binary, labels binary, weights binary")
    return materialize(blocks, "table").repartition(parallelism(rows.sparkSession))


def _read(row: dict, n_features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return (np.frombuffer(row["codes"], np.uint8).reshape(n_features, row["n"]), np.frombuffer(row["labels"], np.int16),
            np.frombuffer(row["weights"], np.float64))


def bag_counts(keys: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is in the tree's bag: a Poisson draw from a mixed hash of row, tree and seed."""
    mix = (tree + 1) * 0x9E3779B97F4A7C15 + seed * 0xD1B54A32D192ED03
    z = keys.view(np.uint64) ^ np.uint64(mix & 0xFFFFFFFFFFFFFFFF)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    z ^= z >> np.uint64(31)
    return np.searchsorted(POISSON, (z >> np.uint64(11)) * 2.0 ** -53, side="right").astype(np.uint8)


# ------------------------------------------------------------------ splits
def _gini(total: np.ndarray) -> np.ndarray:
    w = total.sum(axis=-1)
    return np.where(w > 0, 1 - (total * total).sum(axis=-1) / np.where(w > 0, w * w, 1), 0.0)


def split_gains(hist: np.ndarray, raw: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Best (gain, bin) per node of one feature's histograms: class weights (nodes, bins, classes), bag counts (nodes, bins)."""
    left, count = hist.cumsum(axis=1), raw.cumsum(axis=1)
    total, n = left[:, -1:], count[:, -1:]
    left, count = left[:, :-1], count[:, :-1]
    right = total - left
    lw, rw, tw = left.sum(axis=2), right.sum(axis=2), total.sum(axis=2)
    ok = (count >= least) & (n - count >= least) & (lw > 0) & (rw > 0)
    parts = (left * left).sum(axis=2) / np.where(ok, lw, 1) + (right * right).sum(axis=2) / np.where(ok, rw, 1)
    tw = np.where(tw > 0, tw, 1)
    gain = np.where(ok, parts / tw - (total * total).sum(axis=2) / (tw * tw), -1.0)
    at = gain.argmax(axis=1)
    return gain[np.arange(len(at)), at], at


def drawn_features(rng: np.random.Generator, nodes: int, n_features: int, m: int) -> np.ndarray:
    if m >= n_features:
        return np.tile(np.arange(n_features), (nodes, 1))
    return np.sort(rng.random((nodes, n_features)).argpartition(m - 1, axis=1)[:, :m], axis=1)


def grow(codes: np.ndarray, label: np.ndarray, weight: np.ndarray, count: np.ndarray, classes: int, m: int, least: int,
         levels: int, bins: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    """The tree over binned rows, level by level: arrays over its nodes, merged where siblings predict alike."""
    out: dict[str, list] = {c: [] for c in ("total", "raw", "gain", "feature", "bin", "left", "right")}
    rows, slot, made, nodes, level = np.arange(codes.shape[1]), np.zeros(codes.shape[1], dtype=np.int64), 0, 1, 0
    while nodes:
        lab, w, c = label[rows], weight[rows], count[rows]
        total = np.bincount(slot * classes + lab, weights=w, minlength=nodes * classes).reshape(nodes, classes)
        raw = np.bincount(slot, weights=c, minlength=nodes)
        gain, feature, cut = np.full(nodes, LEAST_GAIN), np.full(nodes, -1), np.zeros(nodes, dtype=np.int64)
        open_ = (_gini(total) > PURE) & (raw >= 2 * least) & (level < levels)
        number = np.cumsum(open_) - 1
        keep = open_[slot]
        rows, lab, w, c, slot = rows[keep], lab[keep], w[keep], c[keep], slot[keep]
        at, a = number[slot], int(open_.sum())
        if a:
            chosen = drawn_features(rng, a, len(codes), m)
            best, best_f, best_b = np.full(a, LEAST_GAIN), np.full(a, -1), np.zeros(a, dtype=np.int64)
            for s in range(chosen.shape[1]):
                place = at * bins + codes[chosen[at, s], rows]
                hist = np.bincount(place * classes + lab, weights=w, minlength=a * bins * classes).reshape(a, bins, classes)
                g, b = split_gains(hist, np.bincount(place, weights=c, minlength=a * bins).reshape(a, bins), least)
                better = g > best
                best[better], best_f[better], best_b[better] = g[better], chosen[better, s], b[better]
            gain[open_], feature[open_], cut[open_] = best, best_f, best_b
        split = feature >= 0
        child = np.cumsum(split) - 1
        first = made + nodes
        for name, v in (("total", total), ("raw", raw), ("gain", np.where(split, gain, -1.0)), ("feature", feature), ("bin", cut),
                        ("left", np.where(split, first + 2 * child, -1)), ("right", np.where(split, first + 2 * child + 1, -1))):
            out[name].append(v)
        goes_on = split[slot]
        rows, slot = rows[goes_on], slot[goes_on]
        slot = 2 * child[slot] + (codes[feature[slot], rows] > cut[slot])
        made, nodes, level = first, 2 * int(split.sum()), level + 1
    return merged({c: np.concatenate(v) for c, v in out.items()})


def merged(t: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Sibling leaves of the same class become their parent; nodes are numbered anew, children behind parents."""
    left, right, says = t["left"].tolist(), t["right"].tolist(), t["total"].argmax(axis=1).tolist()
    for i in range(len(left) - 1, -1, -1):
        a, b = left[i], right[i]
        if a >= 0 and left[a] < 0 and left[b] < 0 and says[a] == says[b]:
            left[i] = right[i] = -1
    keep = np.zeros(len(left), dtype=bool)
    keep[0] = True
    for i, (a, b) in enumerate(zip(left, right)):
        if a >= 0 and keep[i]:
            keep[a] = keep[b] = True
    left, right = np.array(left), np.array(right)
    number = np.cumsum(keep) - 1
    leaf = left < 0
    t = t | {"left": np.where(leaf, -1, number[left]), "right": np.where(leaf, -1, number[right]),
             "feature": np.where(leaf, -1, t["feature"]), "gain": np.where(leaf, -1.0, t["gain"])}
    return {c: v[keep] for c, v in t.items()}


def node_rows(t: dict[str, np.ndarray], cuts: list[np.ndarray]) -> list[dict]:
    """MLlib's node rows."""
    gini, says = _gini(t["total"]).tolist(), t["total"].argmax(axis=1).tolist()
    columns = zip(t["feature"].tolist(), t["bin"].tolist(), t["left"].tolist(), t["right"].tolist(), t["gain"].tolist(), t["raw"].tolist(), t["total"].tolist())
    return [{"id": i, "prediction": float(says[i]), "impurity": gini[i], "impurityStats": total, "rawCount": int(raw), "gain": gain, "leftChild": a, "rightChild": b,
             "split": {"featureIndex": f, "leftCategoriesOrThreshold": [float(cuts[f][k])] if f >= 0 else [], "numCategories": -1}}
            for i, (f, k, a, b, gain, raw, total) in enumerate(columns)]


# ------------------------------------------------------------------ nodes of many rows
class Top:
    """The upper nodes of one tree, by path: the root is 1, the children of p are 2p and 2p + 1."""

    def __init__(self):
        self.split: dict[int, tuple[int, int, float]] = {}          # path -> feature, bin, gain
        self.total: dict[int, list[float]] = {}
        self.raw: dict[int, float] = {}
        self.leaves: set[int] = set()                               # ends of the upper part: below them a task grows on

    def paths(self, codes: np.ndarray) -> np.ndarray:
        """The end of the upper part that each row reaches."""
        at = np.ones(codes.shape[1], dtype=np.int64)
        for p in sorted(self.split):
            f, cut, _ = self.split[p]
            here = np.flatnonzero(at == p)
            at[here] = 2 * p + (codes[f, here] > cut)
        return at


def _drawn_at(seed: int, tree: int, path: int, n_features: int, m: int) -> np.ndarray:
    return drawn_features(np.random.default_rng([seed, tree, path]), 1, n_features, m)[0]


def split_large(blocks: DataFrame, tops: list[Top], n_features: int, classes: int, m: int, least: int, levels: int, bins: int,
                seed: int, bootstrap: bool, node_rows_: int) -> None:
    """Split nodes that hold more than ``node_rows_`` rows of a bag, a pass over the blocks per level."""
    sc = blocks.sparkSession.sparkContext
    active = {t: [1] for t in range(len(tops))}
    while active:
        shared = sc.broadcast((tops, active))

        def sums(batches, shared=shared):
            tops, active = shared.value
            acc: dict[tuple[int, int], np.ndarray] = {}
            for batch in batches:
                for row in batch.to_pylist():
                    codes, label, weight = _read(row, n_features)
                    keys = np.frombuffer(row["keys"], np.int64)
                    for t, paths in active.items():
                        bag = bag_counts(keys, t, seed) if bootstrap else np.ones(len(keys), dtype=np.uint8)
                        at = tops[t].paths(codes)
                        for p in paths:
                            r = np.flatnonzero((at == p) & (bag > 0))
                            h = acc.setdefault((t, p), np.zeros((m, bins, classes + 2)))
                            w = weight[r] * bag[r]
                            for s, f in enumerate(_drawn_at(seed, t, p, n_features, m)):
                                c = codes[f, r].astype(np.int64)
                                h[s, :, :classes] += np.bincount(c * classes + label[r], weights=w, minlength=bins * classes).reshape(bins, classes)
                                h[s, :, classes] += np.bincount(c, weights=bag[r], minlength=bins)
                                h[s, :, classes + 1] += np.bincount(c, minlength=bins)
            for (t, p), h in acc.items():
                yield pa.RecordBatch.from_pydict({"tree": pa.array([t], pa.int32()), "path": pa.array([p], pa.int64()), "h": [h.tobytes()]})

        def best(table):
            h = sum(np.frombuffer(b, np.float64) for b in table.column("h").to_pylist()).reshape(m, bins, classes + 2)
            t, p = table.column("tree")[0].as_py(), table.column("path")[0].as_py()
            gains = [split_gains(h[None, s, :, :classes], h[None, s, :, classes], least) for s in range(m)]
            s = max(range(m), key=lambda s: (gains[s][0][0], -s))
            gain, cut = float(gains[s][0][0]), int(gains[s][1][0])
            left = h[s, :cut + 1].sum(axis=0)
            f = int(_drawn_at(seed, t, p, n_features, m)[s]) if gain > LEAST_GAIN else -1
            return pa.table({"tree": pa.array([t], pa.int32()), "path": pa.array([p], pa.int64()), "feature": pa.array([f], pa.int32()), "bin": pa.array([cut], pa.int32()),
                             "gain": [gain], "all": [h[s].sum(axis=0).tolist()], "left": [left.tolist()]})

        got = (blocks.mapInArrow(sums, "tree int, path long, h binary").groupBy("tree", "path")
               .applyInArrow(best, "tree int, path long, feature int, bin int, gain double, `all` array<double>, `left` array<double>")).collect()   # a row per node
        active = {}
        for r in got:
            top, p, here, left = tops[r["tree"]], r["path"], np.array(r["all"]), np.array(r["left"])
            if r["feature"] < 0 or len(bin(p)) - 3 >= levels:
                continue                                            # its task finds a leaf there as well
            top.split[p] = (r["feature"], r["bin"], r["gain"])
            top.total[p], top.raw[p] = here[:classes].tolist(), here[classes]
            top.leaves.discard(p)
            for q, s in ((2 * p, left), (2 * p + 1, here - left)):
                top.leaves.add(q)
                if s[classes + 1] > node_rows_ and _gini(s[:classes]) > PURE:
                    active.setdefault(r["tree"], []).append(q)


# ------------------------------------------------------------------ the forest
def fit_forest(data: DataFrame, features_vec: str, n_features: int, rf: RandomForestClassifier, node_rows_: int | None = None) -> StoredForest:
    """``rf`` fitted to the rows of ``data``, whose vector column ``features_vec`` has ``n_features`` slots."""
    spark, node_rows_ = data.sparkSession, node_rows_ or NODE_ROWS
    label, weight = F.col(rf.getLabelCol()).cast("double"), F.col(rf.getWeightCol()).cast("double")
    key = F.xxhash64("row_id") if "row_id" in data.columns else F.monotonically_increasing_id()
    rows = materialize(data.select(key.alias("key"), vector_to_array(features_vec).alias("x"), label.alias("label"), weight.alias("weight")), "table")
    n, top_label, bad = rows.agg(F.count(F.lit(1)), F.max("label"), F.count_if(F.expr(
        "label is null or label < 0 or label <> floor(label) or weight is null or not weight >= 0"))).first()
    if not n or bad:
        raise ValueError(f"a forest needs rows with class labels 0, 1, .. and weights: {n} rows, {bad} without")
    classes = max(2, int(top_label) + 1)
    trees, seed, least, levels = rf.getNumTrees(), rf.getSeed(), rf.getMinInstancesPerNode(), rf.getMaxDepth()
    m = int(np.ceil(np.sqrt(n_features))) if rf.getFeatureSubsetStrategy() == "sqrt" else n_features
    bootstrap, seed = rf.getBootstrap(), seed & 0x7FFFFFFF
    cuts = feature_cuts(rows, n_features)
    bins = max(2, max((len(c) for c in cuts), default=0) + 1)
    blocks = binned_blocks(rows, cuts)

    tops = [Top() for _ in range(trees)]
    if n * (0.64 if bootstrap else 1.0) > node_rows_:
        split_large(blocks, tops, n_features, classes, m, least, levels, bins, seed, bootstrap, node_rows_)
    shared = spark.sparkContext.broadcast(tops)

    def dealt(batches, lo, hi):
        for batch in batches:
            for row in batch.to_pylist():
                codes, label, weight = _read(row, n_features)
                keys = np.frombuffer(row["keys"], np.int64)
                for t in range(lo, hi):
                    bag = bag_counts(keys, t, seed) if bootstrap else np.ones(len(keys), dtype=np.uint8)
                    at = np.where(bag > 0, shared.value[t].paths(codes), 0)
                    got = []
                    for p in np.unique(at[at > 0]):
                        r = np.flatnonzero(at == p)
                        got.append((t, int(p), len(r), codes[:, r].tobytes(), label[r].tobytes(), weight[r].tobytes(), bag[r].tobytes(),
                                    keys[r].astype(np.uint32).tobytes()))
                    if got:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*got), (
                            pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 5))],
                            names=["tree", "path", "n", "codes", "labels", "weights", "bag", "order"])

    def subtree(table):
        parts = table.to_pylist()
        t, p = parts[0]["tree"], parts[0]["path"]
        read = [_read(r, n_features) for r in parts]
        codes, label, weight = np.concatenate([r[0] for r in read], axis=1), *(np.concatenate([r[i] for r in read]) for i in (1, 2))
        bag = np.concatenate([np.frombuffer(r["bag"], np.uint8) for r in parts])
        # in one order, however the rows came: sums of weights are then the same in every run
        order = np.lexsort((bag, label, np.concatenate([np.frombuffer(r["order"], np.uint32) for r in parts])))
        codes, label, weight, bag = codes[:, order], label[order].astype(np.int64), weight[order], bag[order].astype(float)
        grown = grow(codes, label, weight * bag, bag, classes, m, least, levels - (len(bin(p)) - 3), bins, np.random.default_rng([seed, t, p]))
        return pa.table([pa.array([v], k) for v, k in zip((t, p, len(grown["left"]), *packed(grown)), PIECE_TYPES)], names=PIECE_NAMES)

    done = []
    per_job = max(1, int(PAIRS_PER_JOB // n))
    for lo in range(0, trees, per_job):
        hi = min(trees, lo + per_job)
        groups = sum(max(1, len(top.leaves)) for top in tops[lo:hi])
        pairs = blocks.mapInArrow(lambda b, lo=lo, hi=hi: dealt(b, lo, hi), "tree int, path long, n int, codes binary, labels binary, weights binary, bag binary, order binary")
        done.append(materialize(pairs.repartition(min(groups, 4 * parallelism(spark)), "tree", "path").groupBy("tree", "path")
                                .applyInArrow(subtree, PIECE), "table"))
    pieces = done[0]
    for d in done[1:]:
        pieces = pieces.unionByName(d)
    return StoredForest(*settled(pieces, tops), cuts, rf, n_features, classes)


def _colons(fields: str) -> str:
    head, split = fields.split(", split ")
    return ", ".join(f.replace(" ", ":", 1) for f in head.split(", ")) + f", split:{split}"


NODE_TYPE = pa.struct([("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())), ("rawCount", pa.int64()),
                       ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()),
                       ("split", pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())]))])


#: A subtree as one row: its nodes' numbers packed by column.
PIECE = "tree int, path long, n int, feature binary, bin binary, child binary, total binary, gain binary, raw binary"
PIECE_NAMES = ["tree", "path", "n", "feature", "bin", "child", "total", "gain", "raw"]
PIECE_TYPES = (pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 6)


def packed(t: dict[str, np.ndarray]) -> tuple[bytes, ...]:
    return (t["feature"].astype(np.int32).tobytes(), t["bin"].astype(np.uint8).tobytes(), np.stack([t["left"], t["right"]]).astype(np.int32).tobytes(),
            t["total"].astype(np.float64).tobytes(), t["gain"].astype(np.float64).tobytes(), t["raw"].astype(np.float64).tobytes())


def unpacked(row: dict, classes: int) -> dict[str, np.ndarray]:
    """The subtree of a row of ``PIECE``; gains and counts where the row has them."""
    left, right = np.frombuffer(row["child"], np.int32).reshape(2, -1)
    t = {"feature": np.frombuffer(row["feature"], np.int32), "bin": np.frombuffer(row["bin"], np.uint8), "left": left, "right": right,
         "total": np.frombuffer(row["total"], np.float64).reshape(-1, classes)}
    return t | {c: np.frombuffer(row[c], np.float64) for c in ("gain", "raw") if c in row}


def settled(pieces: DataFrame, tops: list[Top]) -> tuple[DataFrame, list[Top]]:
    """Subtrees and upper nodes after sibling leaves that predict alike were merged across the border; such a parent becomes a subtree of one node."""
    if not any(top.split for top in tops):
        return pieces, tops
    leaves = pieces.where("n = 1").select("tree", "path", "total").collect()             # one node each, under an upper node
    leaf: dict[int, dict[int, int]] = {}
    for r in leaves:
        leaf.setdefault(r["tree"], {})[r["path"]] = int(np.frombuffer(r["total"], np.float64).argmax())
    gone, made = [], []
    for t, top in enumerate(tops):
        says, new = leaf.get(t, {}), set()
        for p in sorted(top.split, reverse=True):
            if 2 * p in says and 2 * p + 1 in says and says[2 * p] == says[2 * p + 1]:
                del top.split[p]
                says[p] = int(np.argmax(top.total[p]))
                for q in (2 * p, 2 * p + 1):
                    new.discard(q)
                    gone.append((t, q))
                new.add(p)
        for p in new:
            one = {"feature": np.array([-1]), "bin": np.array([0]), "left": np.array([-1]), "right": np.array([-1]), "gain": np.array([-1.0]),
                   "raw": np.array([top.raw[p]]), "total": np.array([top.total[p]])}
            made.append((t, p, 1, *(bytearray(b) for b in packed(one))))
    if gone:
        spark = pieces.sparkSession
        pieces = pieces.join(F.broadcast(spark.createDataFrame(gone, "tree int, path long")), ["tree", "path"], "left_anti")    # upper nodes only
        pieces = materialize(pieces.unionByName(spark.createDataFrame(made, PIECE)), "table")
    return pieces, tops


def _numbered(pieces: DataFrame, tops: list[Top], cuts: list[np.ndarray], classes: int) -> DataFrame:
    """(treeID, nodeData) as MLlib writes them: upper nodes and subtrees as one numbering per tree."""
    spark = pieces.sparkSession
    sizes: dict[int, dict[int, int]] = {}
    for r in pieces.select("tree", "path", "n").collect():                                # a row per subtree
        sizes.setdefault(r["tree"], {})[r["path"]] = r["n"]
    upper, places = [], []
    for t, top in enumerate(tops):
        order = sorted([*top.split, *sizes.get(t, {})])
        number = {p: i for i, p in enumerate(order)}
        after = len(order)
        for p in order:
            if p in top.split:
                f, cut, gain = top.split[p]
                upper.append((t, (number[p], float(np.argmax(top.total[p])), float(_gini(np.array(top.total[p]))), top.total[p], int(top.raw[p]), gain,
                                  number[2 * p], number[2 * p + 1], (f, [float(cuts[f][cut])], -1))))
            else:
                places.append((t, p, number[p], after - 1))
                after += sizes[t][p] - 1

    def nodes(batches):
        for batch in batches:
            for row in batch.to_pylist():
                moved = lambda i: i if i < 0 else row["root"] if i == 0 else i + row["shift"]
                got = [d | {"id": moved(d["id"]), "leftChild": moved(d["leftChild"]), "rightChild": moved(d["rightChild"])}
                       for d in node_rows(unpacked(row, classes), cuts)]
                for lo in range(0, len(got), BLOCK):
                    part = got[lo:lo + BLOCK]
                    yield pa.RecordBatch.from_arrays([pa.array([row["tree"]] * len(part), pa.int32()), pa.array(part, NODE_TYPE)], names=["treeID", "nodeData"])

    schema = f"treeID int, nodeData struct<{_colons(NODE)}>"
    below = pieces.join(F.broadcast(spark.createDataFrame(places, "tree int, path long, root int, shift int")), ["tree", "path"]).mapInArrow(nodes, schema)
    return below.unionByName(spark.createDataFrame(upper, schema)) if upper else below


def _written(pieces: DataFrame, tops: list[Top], cuts: list[np.ndarray], rf: RandomForestClassifier, n_features: int, classes: int, path: str) -> None:
    """MLlib's model in the folder ``path``, written by Spark; parameters are those of ``rf``."""
    spark = pieces.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/models/{uuid.uuid4().hex}"
    rf.write().overwrite().save(f"{folder}/estimator")
    meta = json.loads(spark.read.text(f"{folder}/estimator/metadata").first()[0])
    model = meta | {"class": "org.apache.spark.ml.classification.RandomForestClassificationModel", "numFeatures": n_features, "numClasses": classes,
                    "numTrees": len(tops)}
    of_tree = ("labelCol", "featuresCol", "predictionCol", "probabilityCol", "rawPredictionCol", "weightCol", "leafCol", "impurity", "maxBins", "maxDepth",
               "maxMemoryInMB", "minInfoGain", "minInstancesPerNode", "minWeightFractionPerNode", "cacheNodeIds", "checkpointInterval", "seed")
    tree = meta | {"class": "org.apache.spark.ml.classification.DecisionTreeClassificationModel", "numFeatures": n_features, "numClasses": classes} | {
        k: {c: v for c, v in meta[k].items() if c in of_tree} for k in ("paramMap", "defaultParamMap")}
    spark.createDataFrame([(json.dumps(model),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")
    spark.createDataFrame([(t, json.dumps(tree | {"uid": f"dtc_{t}"}), 1.0) for t in range(len(tops))], "_1 int, _2 string, _3 double").coalesce(1) \
        .write.mode("overwrite").parquet(f"{path}/treesMetadata")
    _numbered(pieces, tops, cuts, classes).write.mode("overwrite").parquet(f"{path}/data")


# ------------------------------------------------------------------ the model
def bin_codes(cuts: list[np.ndarray]):
    """A column function: the bin codes of an array of feature values, a byte per feature."""
    @F.arrow_udf("binary")
    def codes(x: pa.Array) -> pa.Array:
        values = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), len(cuts))
        out = np.stack([np.searchsorted(c, values[:, f], side="left") for f, c in enumerate(cuts)], axis=1).astype(np.uint8)
        return pa.FixedSizeBinaryArray.from_buffers(pa.binary(len(cuts)), len(x), [None, pa.py_buffer(out.tobytes())]).cast(pa.binary())
    return codes


def reached(t: dict[str, np.ndarray], codes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The leaf of the subtree that each of ``rows`` ends in; ``codes`` (features, rows)."""
    at, open_ = np.zeros(len(rows), dtype=np.int64), np.arange(len(rows))
    while len(open_):
        node = at[open_]
        inner = t["left"][node] >= 0
        open_, node = open_[inner], node[inner]
        at[open_] = np.where(codes[t["feature"][node], rows[open_]] > t["bin"][node], t["right"][node], t["left"][node])
    return at


def met(pieces: DataFrame, rows: DataFrame, per_slice: int, run, schema: str) -> DataFrame:
    """Every row of ``rows`` with every subtree, in tasks that hold a slice of about ``per_slice`` bytes of subtrees and one block of rows at a time.

    ``run(pairs)`` gets, per task, an iterator over (new subtrees, row) pairs: all subtrees of the
    slice come with the first row, and ``run`` empties the list. Neither side is held whole
    anywhere: slices times chunks of rows are dealt over the tasks.
    """
    spark = pieces.sparkSession
    sizes = pieces.groupBy("tree").agg(F.sum(sum(F.octet_length(c) for c in ("feature", "bin", "child", "total"))).alias("b")).collect()   # a row per tree
    slice_of, used = {}, 0
    for r in sorted(sizes, key=lambda r: r["tree"]):
        slice_of[r["tree"]] = (used, max(1, -(-r["b"] // per_slice)))
        used += r["b"]
    slices = max(1, -(-used // per_slice))
    chunks = max(1, -(-2 * parallelism(spark) // slices))
    first = F.create_map(*[F.lit(v) for t, (at, _) in slice_of.items() for v in (t, at // per_slice)])
    parts = F.create_map(*[F.lit(v) for t, (_, n) in slice_of.items() for v in (t, n)])
    g = F.least(first[F.col("tree")] + F.pmod(F.xxhash64("tree", "path"), parts[F.col("tree")]), F.lit(slices - 1)).cast("int")
    names = rows.columns
    kinds = {f.name: f.dataType for f in rows.schema}
    left = pieces.select(g.alias("__g"), F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("__c"), F.lit(0).alias("__k"),
                         *PIECE_NAMES[:7], *[F.lit(None).cast(kinds[c]).alias(f"r_{c}") for c in names])
    piece_kinds = {f.name: f.dataType for f in pieces.schema}
    right = rows.select(F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("__g"), F.pmod(F.xxhash64(*names), F.lit(chunks)).cast("int").alias("__c"),
                        F.lit(1).alias("__k"), *[F.lit(None).cast(piece_kinds[c]).alias(c) for c in PIECE_NAMES[:7]], *[F.col(c).alias(f"r_{c}") for c in names])
    together = left.unionByName(right).repartitionById(slices * chunks, (F.col("__g") * chunks + F.col("__c")).cast("int")).sortWithinPartitions("__g", "__c", "__k", "tree", "path")

    def each(batches):
        held: list[dict] = []
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                for row in batch.slice(lo, 64).to_pylist():
                    if row["__k"] == 0:
                        held.append({c: row[c] for c in PIECE_NAMES[:7]})
                    else:
                        yield held, {c: row[f"r_{c}"] for c in names}

    return together.mapInArrow(lambda batches: run(each(batches)), schema)


class StoredForest(Model, MLWritable):
    """The fitted forest as a written table of subtrees; the driver holds the upper nodes only.

    Rows are scored and importances summed by Spark jobs over that table. What else
    MLlib's model offers (``trees``, ``toDebugString``, ..) is asked of it: it is written
    and loaded when first needed, and the driver then holds it whole.
    """

    def __init__(self, pieces: DataFrame, tops: list[Top], cuts: list[np.ndarray], rf: RandomForestClassifier, n_features: int, classes: int):
        super().__init__()
        self._pieces, self._tops, self._cuts, self._rf, self._mllib = pieces, tops, cuts, rf, None
        self.numFeatures, self.numClasses = n_features, classes

    def __getattr__(self, name: str):
        if name.startswith("_") or name in ("coefficients",):
            raise AttributeError(name)
        return getattr(self._rf if name.startswith("get") else self.mllib(), name)

    @property
    def pieces(self) -> DataFrame:
        return self._pieces

    @property
    def tops(self) -> list[Top]:
        return self._tops

    @property
    def cuts(self) -> list[np.ndarray]:
        return self._cuts

    @property
    def getNumTrees(self) -> int:
        return len(self._tops)

    @property
    def totalNumNodes(self) -> int:
        return int(self._pieces.agg(F.sum("n")).first()[0]) + sum(len(top.split) for top in self._tops)

    @property
    def featureImportances(self):
        """MLlib's: gains times weights by feature, each tree's scaled to a sum of 1, then all."""
        classes, n = self.numClasses, self.numFeatures

        def sums(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    row = batch.slice(i, 1).to_pylist()[0]
                    t = unpacked(row, classes)
                    inner = t["left"] >= 0
                    got = np.bincount(t["feature"][inner], weights=t["gain"][inner] * t["total"][inner].sum(axis=1), minlength=n)
                    f = np.flatnonzero(got)
                    yield pa.RecordBatch.from_arrays([pa.array([row["tree"]] * len(f), pa.int32()), pa.array(f, pa.int32()), pa.array(got[f], pa.float64())], names=["tree", "feature", "v"])

        worth = np.zeros((len(self._tops), n))
        for r in self._pieces.drop("raw").mapInArrow(sums, "tree int, feature int, v double").groupBy("tree", "feature").agg(F.sum("v").alias("v")).collect():
            worth[r["tree"], r["feature"]] = r["v"]
        for t, top in enumerate(self._tops):
            for p, (f, _, gain) in top.split.items():
                worth[t, f] += gain * sum(top.total[p])
        of_tree = worth.sum(axis=1, keepdims=True)
        worth = np.divide(worth, of_tree, out=np.zeros_like(worth), where=of_tree > 0).sum(axis=0)
        return Vectors.dense(worth / worth.sum() if worth.sum() > 0 else worth)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        rf, key = self._rf, "__codes"
        coded = dataset.withColumn(key, bin_codes(self._cuts)(vector_to_array(rf.getFeaturesCol())))
        out = coded.join(self._votes(coded.select(key).distinct(), key), key).drop(key)
        whole = F.aggregate("__votes", F.lit(0.0), lambda a, b: a + b)
        return out.withColumn(rf.getRawPredictionCol(), array_to_vector("__votes")).withColumn(
            rf.getProbabilityCol(), array_to_vector(F.transform("__votes", lambda v: v / whole))).withColumn(
            rf.getPredictionCol(), (F.array_position("__votes", F.array_max("__votes")) - 1).cast("double")).drop("__votes")

    def _votes(self, points: DataFrame, key: str) -> DataFrame:
        """Summed class shares of the leaves of all trees for every row of bin codes."""
        classes, n, tops = self.numClasses, self.numFeatures, self._pieces.sparkSession.sparkContext.broadcast(self._tops)

        def blocked(batches):
            for batch in batches:
                for lo in range(0, batch.num_rows, BLOCK):
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(batch.column(0).slice(lo, BLOCK).to_pylist())], pa.binary())], names=["codes"])

        def run(pairs):
            trees: dict[int, dict[int, tuple]] = {}
            for held, row in pairs:
                for piece in held:
                    t = unpacked(piece, classes)
                    weight = t["total"].sum(axis=1, keepdims=True)
                    share = np.divide(t["total"], weight, out=np.zeros_like(t["total"]), where=weight > 0)
                    trees.setdefault(piece["tree"], {})[piece["path"]] = (t, share)
                held.clear()
                codes = np.frombuffer(row["codes"], np.uint8).reshape(-1, n)
                by_feature, votes = np.ascontiguousarray(codes.T), np.zeros((len(codes), classes))
                for tree, parts in trees.items():
                    at = tops.value[tree].paths(by_feature)
                    for p, (t, share) in parts.items():
                        rows = np.flatnonzero(at == p)
                        votes[rows] += share[reached(t, by_feature, rows)]
                keys = pa.FixedSizeBinaryArray.from_buffers(pa.binary(n), len(codes), [None, pa.py_buffer(codes.tobytes())]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([keys, *(pa.array(votes[:, c]) for c in range(classes))], names=[key, *(f"v{c}" for c in range(classes))])

        votes = met(self._pieces, points.mapInArrow(blocked, "codes binary"), SLICE_BYTES, run, f"{key} binary, " + ", ".join(f"v{c} double" for c in range(classes)))
        return votes.groupBy(key).agg(F.array(*[F.sum(f"v{c}") for c in range(classes)]).alias("__votes"))

    def mllib(self) -> RandomForestClassificationModel:
        """MLlib's own model of the same nodes, whole on the driver."""
        if self._mllib is None:
            path = f"{ensure_checkpoint_dir(self._pieces.sparkSession).rstrip('/')}/models/{uuid.uuid4().hex}/model"
            self.write().overwrite().save(path)
            self._mllib = RandomForestClassificationModel.load(path)
        return self._mllib

    def write(self) -> MLWriter:
        return _ForestWriter(self)


class _ForestWriter(MLWriter):
    """Writes MLlib's folder from the table of subtrees."""

    def __init__(self, forest: StoredForest):
        super().__init__()
        self._forest = forest

    def saveImpl(self, path: str) -> None:
        f = self._forest
        _written(f.pieces, f.tops, f.cuts, f._rf, f.numFeatures, f.numClasses, path)
