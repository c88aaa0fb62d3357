"""X1 for tree ensembles: permutation attributions from the trees' paths, no masked point scored.

A leaf is reached by a mixed point (some features of the explained row, the rest
of a background row) if every split on its path is passed by whichever of the two
supplies that feature. Let A be the path's features where only the explained row
passes and B those where only the background row passes; if neither passes some
split, the leaf is out. Along a permutation the leaf is switched on by the last
feature of A and off by the first of B, if A is complete before B begins. So each
(leaf, background row) makes at most two steps, and a split on which both rows agree
makes none.

The path table is taken from the fitted model once: per leaf and distinct A the
background rows that have it. It grows with the model and the bounded background,
not with the explained rows, and is broadcast; Spark spreads the rows. A score that is
linear in the leaves (forest probability) needs the number of background rows
only; one under a link (boosting, any calibrator) keeps them apart.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.operators.forest import StoredForest, met, unpacked
from cohortlens.operators.forest import reached as leaf_of
from cohortlens.operators.models import positive_probability

#: Explained rows that one pass over a tree's nodes handles.
ROWS_PER_PASS = 256


@dataclass
class Tree:
    """Nodes in preorder: feature (-1 at leaves), threshold, children, value (leaves)."""
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray


@dataclass
class TreeScore:
    """A score ``link(sum of the leaves reached)``; without a link the score is the sum itself."""
    trees: list[Tree]
    link: Callable[[np.ndarray], np.ndarray] | None


class StoredScore:
    """The score of a :class:`StoredForest`: the sum over its subtrees, without a link, so each is explained by itself."""
    link = None

    def __init__(self, forest: StoredForest, inputs: list[str], features: list[str]):
        self.forest, self.inputs, self.features = forest, inputs, features

    @property
    def trees(self) -> list[Tree]:
        return model_trees(self.forest.mllib(), self.inputs, self.features)


def _bits(feature: int, words: int) -> np.ndarray:
    out = np.zeros(words, dtype=np.uint64)
    out[feature // 64] = np.uint64(1) << np.uint64(feature % 64)
    return out


def failed_splits(tree: Tree, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leaves of the tree and, per row and leaf, the features (bit sets) of the splits that the row does not pass."""
    words = max(1, -(-rows.shape[1] // 64))
    at: dict[int, np.ndarray] = {0: np.zeros((len(rows), words), dtype=np.uint64)}
    leaves, masks = [], []
    for node in range(len(tree.feature)):
        mask = at.pop(node)
        f = int(tree.feature[node])
        if f < 0:
            leaves.append(node)
            masks.append(mask)
            continue
        goes_left = (rows[:, f] <= tree.threshold[node])[:, None]
        bit = _bits(f, words)
        at[int(tree.left[node])] = np.where(goes_left, mask, mask | bit)
        at[int(tree.right[node])] = np.where(goes_left, mask | bit, mask)
    return np.array(leaves), np.stack(masks, axis=1)


class PathTable:
    """Per leaf and distinct set A: the background rows whose failed splits on the path are A."""

    def __init__(self, trees: list[Tree], background: np.ndarray, linked: bool = True):
        self.trees, self.n_background = trees, len(background)
        leaf, mask, value, members, size = [], [], [], [], []
        at = 0
        for tree in trees:
            leaves, failed = failed_splits(tree, background)
            for k in range(len(leaves)):
                sets, which = np.unique(failed[:, k], axis=0, return_inverse=True)
                members.append(np.argsort(which.ravel(), kind="stable").astype(np.int32))
                size.append(np.bincount(which.ravel(), minlength=len(sets)))
                leaf.append(np.full(len(sets), at + k, dtype=np.int32))
                mask.append(sets)
            value.append(tree.value[leaves])
            at += len(leaves)
        self.leaf, self.mask, self.value = np.concatenate(leaf), np.concatenate(mask), np.concatenate(value)
        self.size = np.concatenate(size).astype(np.int32)
        self.first = np.cumsum(self.size) - self.size
        self.members = np.concatenate(members)
        self.total = np.zeros(self.n_background)
        for k in np.flatnonzero(~self.mask.any(axis=1)):
            self.total[self.members[self.first[k]:self.first[k] + self.size[k]]] += self.value[self.leaf[k]]
        if not linked:                                  # only counts of background rows matter
            self.members = self.first = None

    def base(self, link: Callable | None) -> float:
        """Mean score of the background."""
        return float((link(self.total) if link else self.total).mean())

    def attribute(self, failed: np.ndarray, perms: np.ndarray, link: Callable | None) -> np.ndarray:
        """Attributions (features) of one row from its failed splits per leaf and its permutations (perms x features)."""
        n_perm, n = perms.shape
        words = self.mask.shape[1]
        clash = failed[self.leaf, 0] & self.mask[:, 0]
        for w in range(1, words):
            clash |= failed[self.leaf, w] & self.mask[:, w]
        alive = np.flatnonzero(clash == 0)
        leaf = self.leaf[alive]
        a = self.mask[alive].view(np.uint8).reshape(len(alive), -1)
        b = failed.view(np.uint8).reshape(len(failed), -1)
        size, worth = self.size[alive], self.value[leaf]
        if link:
            row = np.repeat(np.arange(len(alive)), size)
            inside = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
            group, value, groups = self.members[self.first[alive][row] + inside], worth, self.n_background
        else:
            value, groups = worth * (size / self.n_background), 1
        steps = np.zeros((groups, n_perm, n + 2))
        for p, perm in enumerate(perms):
            place = np.empty(n, dtype=np.int16)
            place[perm] = np.arange(n)
            last, first = _byte_tables(place, 8 * words)
            on = last[0, a[:, 0]]
            off = first[0, b[:, 0]]
            for k in range(1, a.shape[1]):
                np.maximum(on, last[k, a[:, k]], out=on)
                np.minimum(off, first[k, b[:, k]], out=off)
            ends = off[leaf]
            good = np.flatnonzero(on < ends)                    # complete before the first feature of B comes
            if link:
                chosen = np.zeros(len(alive), dtype=bool)
                chosen[good] = True
                keep = chosen[row]
                r, base = row[keep], group[keep].astype(np.int64) * (n + 2)
                weight, start, end = value[r], base + on[r] + 1, base + ends[r] + 1
            else:
                weight, start, end = value[good], on[good] + 1, ends[good] + 1
            length = groups * (n + 2)
            move = np.bincount(start, weights=weight, minlength=length) - np.bincount(end, weights=weight, minlength=length)
            steps[:, p] = move.reshape(groups, n + 2)
        run = np.cumsum(steps[:, :, :n + 1], axis=2)
        v = (link(run) if link else run).mean(axis=0)
        phi = np.zeros(n)
        np.add.at(phi, perms.ravel(), np.diff(v, axis=1).ravel())
        return phi / n_perm


def _byte_tables(place: np.ndarray, n_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """Latest and earliest place of the features in each value of each byte of a bit set (-1 and len(place) for none)."""
    n = len(place)
    bits = (np.arange(256)[:, None] >> np.arange(8)) & 1
    padded = np.full(8 * n_bytes, -1, dtype=np.int16)
    padded[:n] = place
    grid = padded.reshape(n_bytes, 1, 8)
    last = np.where(bits[None] == 1, grid, -1).max(axis=2).astype(np.int16)
    first = np.where((bits[None] == 1) & (grid >= 0), grid, n).min(axis=2).astype(np.int16)
    return last, first


def path_values(score: TreeScore | StoredScore, sample: DataFrame, background: np.ndarray, features: list[str],
                n_perm: int, seed: int, key: str = "row_id") -> tuple[DataFrame, float]:
    """X1 (row_id, feature, value, phi) and the base value; the permutations are those of the masked points."""
    from cohortlens.operators.attribution import both_ways, drawn_orders
    from cohortlens.session import parallelism
    spark, n = sample.sparkSession, len(features)
    if isinstance(score, StoredScore):
        return _stored_values(score, sample, background, n_perm, seed, key)
    table, link = PathTable(score.trees, background, score.link is not None), score.link
    shared = spark.sparkContext.broadcast(table)
    orders = drawn_orders(F.col(key), n_perm, n, seed)
    x = F.array(*[F.col(c).cast("double") for c in features])
    rows = sample.select(F.col(key), x.alias("x")).repartition(parallelism(spark), key).select(key, "x", orders.alias("orders"))
    names = list(features)

    def run(batches):
        paths = shared.value
        for whole in batches:
            for lo in range(0, whole.num_rows, ROWS_PER_PASS):
                batch = whole.slice(lo, ROWS_PER_PASS)
                x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, n)
                perms = both_ways(batch.column(2), n_perm, n)
                failed = np.concatenate([failed_splits(t, x)[1] for t in paths.trees], axis=1)
                phi = np.stack([paths.attribute(failed[i], perms[i], link) for i in range(len(x))])
                at = pa.array(np.repeat(np.arange(len(x)), n))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), pa.array(names * len(x), pa.string()), pa.array(x.ravel()), pa.array(phi.ravel())],
                    names=[key, "feature", "value", "phi"])

    kind = sample.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, feature string, value double, phi double"), table.base(link)


#: Bytes of subtrees that one task explains rows by; their path tables take some 30 times that.
PATH_BYTES = 4 << 20


def _subtree(t: dict[str, np.ndarray], spine: list[tuple[int, int, bool]], cuts: list[np.ndarray], column: list[int], weight: float) -> Tree:
    """A packed subtree below its ``spine`` of upper splits (feature, bin, right turn); what turns off the spine is worth 0.

    Inputs outside the features (column -1) are 0 in every row: their splits are decided here.
    """
    out: dict[str, list] = {"feature": [], "threshold": [], "left": [], "right": [], "value": []}

    def add(feature: int, threshold: float, value: float, parent: int, side: str) -> int:
        for name, v in (("feature", feature), ("threshold", threshold), ("left", -1), ("right", -1), ("value", value)):
            out[name].append(v)
        if parent >= 0:
            out[side][parent] = len(out["feature"]) - 1
        return len(out["feature"]) - 1

    parent, side = -1, ""
    todo: list[tuple[int, int, str]] = []
    for f, cut, right in spine:
        threshold = float(cuts[f][cut])
        if column[f] < 0:
            if (0.0 > threshold) != right:                                  # no row comes here
                return Tree(*(np.array(v) for v in ([-1], [0.0], [-1], [-1], [0.0])))
            continue
        here = add(column[f], threshold, 0.0, parent, side)
        if right:
            add(-1, 0.0, 0.0, here, "left")
        else:
            todo.append((-1, here, "right"))
        parent, side = here, "right" if right else "left"
    todo.append((0, parent, side))
    feature, left, right, total = (t[c].tolist() for c in ("feature", "left", "right", "total"))
    cut = t["bin"].tolist()
    while todo:
        at, parent, side = todo.pop()
        if at < 0:
            add(-1, 0.0, 0.0, parent, side)
            continue
        while left[at] >= 0 and column[feature[at]] < 0:
            at = left[at] if 0.0 <= cuts[feature[at]][cut[at]] else right[at]
        if left[at] < 0:
            add(-1, 0.0, total[at][1] / sum(total[at]) * weight, parent, side)
            continue
        here = add(column[feature[at]], float(cuts[feature[at]][cut[at]]), 0.0, parent, side)
        todo += [(right[at], here, "right"), (left[at], here, "left")]
    return Tree(*(np.array(out[c]) for c in ("feature", "threshold", "left", "right", "value")))


def _spine(top, path: int) -> list[tuple[int, int, bool]]:
    steps = [path >> k for k in range(path.bit_length() - 1, -1, -1)]
    return [(top.split[p][0], top.split[p][1], bool(q & 1)) for p, q in zip(steps, steps[1:])]


def _stored_values(score: StoredScore, sample: DataFrame, background: np.ndarray, n_perm: int, seed: int, key: str) -> tuple[DataFrame, float]:
    """X1 as in :func:`path_values`, subtree by subtree: the score is the sum over the subtrees, so are the attributions.

    Subtrees meet blocks of rows in slices, and only the path tables of one slice are
    in a task; neither the trees nor the paths are gathered.
    """
    from cohortlens.operators.attribution import both_ways, drawn_orders
    from cohortlens.session import materialize
    forest, features = score.forest, score.features
    spark, n, classes, cuts = sample.sparkSession, len(features), forest.numClasses, forest.cuts
    column = [features.index(c) if c in features else -1 for c in score.inputs]
    weight, tops = 1.0 / forest.getNumTrees, spark.sparkContext.broadcast(forest.tops)

    def tree_of(piece: dict) -> Tree:
        return _subtree(unpacked(piece, classes), _spine(tops.value[piece["tree"]], piece["path"]), cuts, column, weight)

    x = F.array(*[F.col(c).cast("double") for c in features])
    rows = sample.select(F.struct(key, x.alias("x"), drawn_orders(F.col(key), n_perm, n, seed).alias("orders")).alias("row"))
    block = F.pmod(F.xxhash64("row"), F.ceil(F.lit(max(1, sample.count())) / ROWS_PER_PASS).cast("long"))
    blocks = materialize(rows.groupBy(block.alias("block")).agg(F.sort_array(F.collect_list("row")).alias("rows")).select("rows"), "table")

    def run(pairs):
        table = None
        for held, row in pairs:
            if held:                                    # the whole slice, with the first row
                table = PathTable([tree_of(piece) for piece in held], background, False)
                held.clear()
            if table is None:
                continue
            mine = row["rows"]
            x = np.array([r["x"] for r in mine], dtype=float)
            perms = both_ways(pa.array([r["orders"] for r in mine], pa.list_(pa.list_(pa.int64()))), n_perm, n)
            failed = np.concatenate([failed_splits(t, x)[1] for t in table.trees], axis=1)
            phi = [table.attribute(failed[i], perms[i], None).tolist() for i in range(len(x))]
            yield pa.RecordBatch.from_pydict({key: pa.array([r[key] for r in mine]), "x": pa.array(x.tolist(), pa.list_(pa.float64())),
                                              "phi": pa.array(phi, pa.list_(pa.float64()))})

    points = np.zeros((len(background), len(column)))
    for i, c in enumerate(column):
        if c >= 0:
            points[:, i] = background[:, c]
    codes = np.stack([np.searchsorted(c, points[:, f], side="left") for f, c in enumerate(cuts)])

    def totals(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                piece = batch.slice(i, 1).to_pylist()[0]
                t = unpacked(piece, classes)
                here = np.flatnonzero(tops.value[piece["tree"]].paths(codes) == piece["path"])
                total = t["total"][leaf_of(t, codes, here)]
                yield pa.RecordBatch.from_pydict({"v": [float((total[:, 1] / total.sum(axis=1)).sum()) * weight / len(background)]})

    kind = sample.schema[key].dataType.simpleString()
    parts = met(forest.pieces, blocks, PATH_BYTES, run, f"`{key}` {kind}, x array<double>, phi array<double>")
    summed = parts.groupBy(key, "x").agg(*[F.sum(F.get("phi", F.lit(j))).alias(f"phi{j}") for j in range(n)])
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.get("x", F.lit(j)).alias("value"), F.col(f"phi{j}").alias("phi")) for j, c in enumerate(features)]))
    out = summed.select(key, values.alias("v")).select(key, "v.feature", "v.value", "v.phi")
    base = forest.pieces.drop("gain", "raw").mapInArrow(totals, "v double").agg(F.sum("v")).first()[0]
    return out, float(base)


# ------------------------------------------------------------------ from fitted models
def model_trees(model, inputs: list[str], features: list[str]) -> list[Tree]:
    """The ensemble's trees over ``features``, read from the node table that MLlib writes.

    Model inputs outside ``features`` are 0 in every scored row, so their splits
    are decided here and vanish from the paths.
    """
    import uuid

    from cohortlens.session import ensure_checkpoint_dir
    spark = _active()
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/models/{uuid.uuid4().hex}"
    model.write().overwrite().save(path)
    forest = isinstance(model, RandomForestClassificationModel)
    d = F.col("nodeData")
    nodes = spark.read.parquet(f"{path}/data").select(
        "treeID", d["id"].alias("id"), d["prediction"].alias("prediction"), d["impurityStats"].alias("stats"), d["leftChild"].alias("left"),
        d["rightChild"].alias("right"), d["split"]["featureIndex"].alias("feature"), d["split"]["leftCategoriesOrThreshold"].alias("cut"),
        d["split"]["numCategories"].alias("categories"))
    column = [features.index(c) if c in features else -1 for c in inputs]
    weights = [1.0 / model.getNumTrees] * model.getNumTrees if forest else list(model.treeWeights)
    # the driver holds the fitted model anyway
    by_tree: dict[int, dict] = {}
    for r in nodes.collect():
        if r["categories"] is not None and r["categories"] >= 0 and r["left"] >= 0:
            raise ValueError("categorical splits are not expected: features are numeric")
        by_tree.setdefault(r["treeID"], {})[r["id"]] = r

    def build(got: dict, weight: float) -> Tree:
        out: dict[str, list] = {"feature": [], "threshold": [], "left": [], "right": [], "value": []}
        todo = [(0, -1, "")]
        while todo:
            at, parent, side = todo.pop()
            r = got[at]
            while r["left"] >= 0 and column[r["feature"]] < 0:                  # a constant 0 takes one side
                r = got[r["left"] if 0.0 <= r["cut"][0] else r["right"]]
            node = len(out["feature"])
            if parent >= 0:
                out[side][parent] = node
            leaf = r["left"] < 0
            value = (r["stats"][1] / sum(r["stats"]) if forest else r["prediction"]) * weight if leaf else 0.0
            for name, v in (("feature", -1 if leaf else column[r["feature"]]), ("threshold", 0.0 if leaf else r["cut"][0]),
                            ("left", -1), ("right", -1), ("value", value)):
                out[name].append(v)
            if not leaf:
                todo += [(r["right"], node, "right"), (r["left"], node, "left")]
        return Tree(*(np.array(out[c]) for c in ("feature", "threshold", "left", "right", "value")))

    return [build(by_tree[t], weights[t]) for t in sorted(by_tree)]


def tree_score(base: PipelineModel, features: list[str], after: Callable[[np.ndarray], np.ndarray] | None = None) -> TreeScore | StoredScore | None:
    """The pipeline's positive probability, put through ``after``, if its last stage is a forest or boosting; else None."""
    last = base.stages[-1]
    if isinstance(last, StoredForest) and last.numClasses == 2:
        if after is None:
            return StoredScore(last, base.stages[0].getInputCols(), features)
        last = last.mllib()                             # a link needs the sum over all trees
    if not isinstance(last, (RandomForestClassificationModel, GBTClassificationModel)) or last.numClasses != 2:
        return None
    trees = model_trees(last, base.stages[0].getInputCols(), features)
    if isinstance(last, RandomForestClassificationModel):
        return TreeScore(trees, after)
    boosted = lambda m: 1.0 / (1.0 + np.exp(-2.0 * m))
    return TreeScore(trees, (lambda m: after(boosted(m))) if after else boosted)


@dataclass
class UncalibratedModel:
    """A fitted pipeline explained by its own positive probability."""
    base: PipelineModel

    def transform(self, df: DataFrame, out: str = "score") -> DataFrame:
        scored = self.base.transform(df).withColumn(out, positive_probability())
        return scored.drop("features_vec", "features_std", "rawPrediction", "probability", "prediction")

    def paths(self, features: list[str]) -> TreeScore | None:
        return tree_score(self.base, features)


def _active():
    from pyspark.sql import SparkSession
    return SparkSession.getActiveSession()
