"""M5 as Spark jobs: boosted trees over binned rows, one pass per level of a tree.

MLlib's boosting persists and re-reads the rows of every round and cannot go on
from a shorter ensemble. Here the binned rows carry their margin: a pass adds the
trees since the margins were last written, sends every row down the growing tree
and sums the statistics of its open nodes per task; Spark adds the sums and picks
a split per node. The pass of the root also sums the loss of the held-out rows,
so patience is judged round by round.

Bins of several features share one code (``Layout``), so ten features of two values
cost one count instead of ten. Rows that agree in every bin, label and weight have the
same margin in every round; they are one row with a count. Where all rows differ, that
saves nothing and costs one shuffle.

Trees follow MLlib: at most 32 bins per feature, variance gain on weighted sums,
``min_samples_leaf`` on row counts, the first tree on labels of -1 and 1 with weight
1, the others on the gradient of ``2 log(1 + exp(-2 y F))`` with the step size. The
result is MLlib's own model.
"""

from __future__ import annotations

import json
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.operators.forest import BLOCK, LEAST_GAIN, MAX_BINS, NODE, PURE, _colons
from cohortlens.session import ensure_checkpoint_dir, materialize

#: Rounds after which the margins are written anew: a pass evaluates as many trees at most.
MARGIN_ROUNDS = 16
#: Bytes of node statistics that a task holds in one pass.
STATS_BYTES = 1 << 27
#: Distinct values of a feature up to which its thresholds are MLlib's own, from all rows; quantiles of the rows above.
EXACT_VALUES = 50_000
#: Joint codes that the bins of several features may take.
JOINT = 1024
#: Sums per bin: weight, weight * target, weight * target^2, rows.
SUMS = 4


class Tree:
    """Nodes in the order they were made: children follow each other, a leaf has no feature."""

    def __init__(self):
        self.feature, self.bin, self.left, self.gain, self.sums = [-1], [0], [-1], [-1.0], [np.zeros(SUMS)]

    def split(self, node: int, feature: int, cut: int, gain: float, left: np.ndarray) -> tuple[int, int]:
        a = len(self.feature)
        self.feature[node], self.bin[node], self.left[node], self.gain[node] = feature, cut, a, gain
        for s in (left, self.sums[node] - left):
            self.feature.append(-1)
            self.bin.append(0)
            self.left.append(-1)
            self.gain.append(-1.0)
            self.sums.append(s)
        return a, a + 1

    def arrays(self) -> tuple[np.ndarray, ...]:
        """Feature, bin, left child and prediction by node, as tasks read them."""
        s = np.array(self.sums)
        return (np.array(self.feature, dtype=np.int64), np.array(self.bin, dtype=np.int64), np.array(self.left, dtype=np.int64),
                np.divide(s[:, 1], s[:, 0], out=np.zeros(len(s)), where=s[:, 0] > 0))


class Layout:
    """Features packed into joint codes: column, divisor and bins of each feature."""

    def __init__(self, bins: list[int]):
        self.bins, self.column, self.divisor, self.width = bins, [0] * len(bins), [1] * len(bins), []
        for f in sorted(range(len(bins)), key=lambda f: (-bins[f], f)):
            at = next((c for c, w in enumerate(self.width) if w * bins[f] <= JOINT), len(self.width))
            if at == len(self.width):
                self.width.append(1)
            self.column[f], self.divisor[f] = at, self.width[at]
            self.width[at] *= bins[f]

    def packed(self, codes: np.ndarray) -> np.ndarray:
        """Joint codes (rows, columns) of bin codes (features, rows)."""
        out = np.zeros((codes.shape[1], len(self.width)), dtype=np.uint16)
        for f, code in enumerate(codes):
            out[:, self.column[f]] += (code * self.divisor[f]).astype(np.uint16)
        return out

    def of(self, f: int) -> np.ndarray:
        """The bin of feature ``f`` in every joint code."""
        return np.arange(JOINT) // self.divisor[f] % self.bins[f]

    def parted(self, sums: np.ndarray, f: int) -> np.ndarray:
        """Sums (.., joint codes) of the column of ``f`` by its bins alone."""
        above = self.width[self.column[f]] // (self.divisor[f] * self.bins[f])
        return sums.reshape(*sums.shape[:-1], above, self.bins[f], self.divisor[f]).sum(axis=(-3, -1))

    def router(self, tree: tuple) -> tuple:
        """Column, right turns by joint code, child and depth of every node, for :func:`reached`; a leaf leads to itself."""
        feature, cut, left, says = tree
        turns = np.zeros((len(feature), JOINT), dtype=np.uint8)
        column, child = np.zeros(len(feature), dtype=np.int64), np.arange(len(feature))
        depth = np.zeros(len(feature), dtype=np.int64)
        for i, f in enumerate(feature.tolist()):
            if f >= 0:
                turns[i], column[i], child[i] = self.of(f) > cut[i], self.column[f], left[i]
                depth[left[i]] = depth[left[i] + 1] = depth[i] + 1
        return column, turns.ravel(), child, int(depth.max()), says


def reached(codes: np.ndarray, router: tuple) -> np.ndarray:
    """The node that each row ends in; ``codes`` (columns, rows)."""
    column, turns, child, depth, _ = router
    n = codes.shape[1]
    at, flat, rows = np.zeros(n, dtype=np.int64), codes.ravel(), np.arange(n)
    for _ in range(depth):
        at = child[at] + turns[at * JOINT + flat[column[at] * n + rows]]
    return at


def variance(sums: np.ndarray) -> float:
    return float((sums[2] - sums[1] * sums[1] / sums[0]) / sums[0]) if sums[0] > 0 else 0.0


def best_split(hist: np.ndarray, least: int) -> tuple[float, int, int]:
    """(gain, feature, bin) of the statistics (features, bins, sums) of one node; the first of equal gains."""
    left = hist.cumsum(axis=1)
    total = left[:, -1:]
    left = left[:, :-1]
    right = total - left
    ok = (left[..., 3] >= least) & (right[..., 3] >= least) & (left[..., 0] > 0) & (right[..., 0] > 0)
    parts = sum(np.divide(s[..., 1] ** 2, s[..., 0], out=np.zeros(ok.shape), where=ok) for s in (left, right))
    whole = np.where(total[..., 0] > 0, total[..., 0], 1)
    gain = np.where(ok, (parts - total[..., 1] ** 2 / whole) / whole, -1.0)
    if not gain.size:
        return -1.0, 0, 0
    at = int(gain.argmax())
    return float(gain.flat[at]), *(int(v) for v in np.unravel_index(at, gain.shape))


# ------------------------------------------------------------------ thresholds
def strides(values: np.ndarray, weights: np.ndarray, bins: int = MAX_BINS) -> np.ndarray:
    """MLlib's thresholds of ascending distinct ``values``: midpoints, where more than ``bins`` those nearest to equal shares of the weight."""
    if len(values) <= bins:
        return (values[:-1] + values[1:]) / 2
    seen = weights.cumsum()
    stride = seen[-1] / bins
    out, target = [], stride
    for i in range(1, len(values)):
        if abs(seen[i - 1] - target) < abs(seen[i] - target):
            out.append((values[i - 1] + values[i]) / 2)
            target += stride
    return np.array(out)


def weighted_cuts(rows: DataFrame, n_features: int) -> list[np.ndarray]:
    """Split thresholds per position of the array column ``x`` of ``rows`` (x, weight)."""
    values = materialize(rows.select(F.posexplode("x").alias("f", "v"), "weight").groupBy("f", "v").agg(F.sum("weight").alias("w")), "table")
    sizes = {r["f"]: r["n"] for r in values.groupBy("f").agg(F.count(F.lit(1)).alias("n")).collect()}
    few, many = [f for f, n in sizes.items() if n <= EXACT_VALUES], [f for f, n in sizes.items() if n > EXACT_VALUES]

    def of_feature(table):
        v, w = (table.column(c).to_numpy() for c in ("v", "w"))
        at = np.argsort(v)
        return pa.table({"f": pa.array([table.column("f")[0].as_py()], pa.int32()), "cuts": pa.array([strides(v[at], w[at]).tolist()], pa.list_(pa.float64()))})

    cuts: dict[int, np.ndarray] = {}
    if few:
        got = values.where(F.col("f").isin(few)).groupBy("f").applyInArrow(of_feature, "f int, cuts array<double>").collect()     # a row per feature
        cuts = {r["f"]: np.array(r["cuts"], dtype=float) for r in got}
    if many:
        shares = [i / MAX_BINS for i in range(1, MAX_BINS)]
        row = rows.agg(*[F.percentile_approx(F.get("x", F.lit(f)), shares, 10000).alias(str(f)) for f in many]).first()
        cuts |= {f: np.unique(np.array(row[str(f)], dtype=float)) for f in many}
    return [cuts.get(f, np.empty(0)) for f in range(n_features)]


# ------------------------------------------------------------------ passes over the rows
_BLOCKS = "n int, codes binary, labels binary, weights binary, counts binary, held binary, margins binary"


def _blocks(rows: DataFrame, cuts: list[np.ndarray], layout: Layout) -> DataFrame:
    """``rows`` (x, label, weight, held) in blocks: joint codes by column, labels of -1 and 1, summed weights, counts, flags and margins as byte strings."""
    n, columns = len(cuts), len(layout.width)

    def binned(batches):
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, n)
            codes = layout.packed(np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)]))
            keys = pa.FixedSizeBinaryArray.from_buffers(pa.binary(2 * columns), len(x), [None, pa.py_buffer(codes.tobytes())]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([keys, *batch.columns[1:]], names=["codes", "label", "weight", "held"])

    def blocked(batches):
        for whole in batches:
            for lo in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(lo, BLOCK)
                codes = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint16).reshape(batch.num_rows, columns)
                label, weight, held, count = (batch.column(c).to_numpy(zero_copy_only=False) for c in (1, 2, 3, 4))
                yield pa.RecordBatch.from_pydict({"n": pa.array([len(codes)], pa.int32()), "codes": [codes.T.tobytes()], "labels": [(2 * label - 1).astype(np.int8).tobytes()],
                                                  "weights": [(weight * count).astype(np.float64).tobytes()], "counts": [count.astype(np.float64).tobytes()],
                                                  "held": [held.astype(np.uint8).tobytes()], "margins": [np.zeros(len(codes)).tobytes()]})

    alike = (rows.mapInArrow(binned, "codes binary, label double, weight double, held boolean")
             .groupBy("codes", "label", "weight", "held").agg(F.count(F.lit(1)).alias("count"))
             .sortWithinPartitions("codes", "label", "weight", "held"))
    return alike.mapInArrow(blocked, _BLOCKS)


def _read(row: dict, columns: int, routers: list[tuple], weights: list[float]) -> tuple[np.ndarray, ...]:
    """Codes, labels, weights, counts, flags and the margins after the trees of ``routers``."""
    codes = np.frombuffer(row["codes"], np.uint16).reshape(columns, row["n"])
    margin = np.frombuffer(row["margins"], np.float64)
    for router, w in zip(routers, weights):
        margin = margin + (w * router[4])[reached(codes, router)]
    return (codes, np.frombuffer(row["labels"], np.int8).astype(float), np.frombuffer(row["weights"], np.float64), np.frombuffer(row["counts"], np.float64),
            np.frombuffer(row["held"], np.uint8) > 0, margin)


def _moved(blocks: DataFrame, layout: Layout, trees: list[tuple], weights: list[float]) -> DataFrame:
    """The blocks with the margins after ``trees``, written."""
    shared = blocks.sparkSession.sparkContext.broadcast((trees, weights))

    def run(batches):
        trees, weights = shared.value
        routers = [layout.router(t) for t in trees]
        for batch in batches:
            margins = [_read(row, len(layout.width), routers, weights)[5].tobytes() for row in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(margins, pa.binary())], names=batch.schema.names)

    return materialize(blocks.mapInArrow(run, _BLOCKS), "table")


def _pass(blocks: DataFrame, layout: Layout, trees: list[tuple], weights: list[float], first: bool, tree: Tree, nodes: list[int], least: int) -> list:
    """The best split of every node of ``nodes``: rows (node, gain, feature, bin, all, left). Node -1 holds the held-out rows' summed loss and weight."""
    shared = blocks.sparkSession.sparkContext.broadcast((trees, weights, tree.arrays(), nodes))
    root, n_features, bins = nodes == [0], len(layout.bins), max(layout.bins)

    def sums(batches):
        trees, weights, growing, nodes = shared.value
        routers, path = [layout.router(t) for t in trees], layout.router(growing)
        slot_of = np.full(len(growing[0]), -1)
        slot_of[nodes] = np.arange(len(nodes))
        acc = [np.zeros((SUMS, len(nodes) * width)) for width in layout.width]
        lost = np.zeros(2)
        for batch in batches:
            for row in batch.to_pylist():
                codes, y, w, count, held, margin = _read(row, len(layout.width), routers, weights)
                if root and held.any():
                    lost += w[held] @ (2 * np.logaddexp(0.0, -2 * y[held] * margin[held])), w[held].sum()
                slot = slot_of[reached(codes, path)]
                r = np.flatnonzero((slot >= 0) & ~held)
                y, w, margin, slot = y[r], w[r], margin[r], slot[r]
                target = y if first else 4 * y / (1 + np.exp(2 * y * margin))
                wt = w * target
                values = (w, wt, wt * target, count[r])
                for c, width in enumerate(layout.width):
                    at = slot * width + codes[c, r]
                    for k, v in enumerate(values):
                        acc[c][k] += np.bincount(at, weights=v, minlength=len(nodes) * width)
        part = TaskContext.get().partitionId()
        by_node = np.zeros((len(nodes), n_features, bins, SUMS))
        for f, b in enumerate(layout.bins):
            c = layout.column[f]
            by_node[:, f, :b] = layout.parted(acc[c].reshape(SUMS, len(nodes), layout.width[c]), f).transpose(1, 2, 0)
        out = [(n, part, by_node[k].tobytes()) for k, n in enumerate(nodes) if by_node[k, 0, :, 3].any()]
        if lost[1]:
            out.append((-1, part, lost.tobytes()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.binary()))], names=["node", "part", "h"])

    def best(table):
        # in the order of the tasks, however their parts came
        parts = sorted(zip(table.column("part").to_pylist(), table.column("h").to_pylist()))
        h = sum(np.frombuffer(b, np.float64) for _, b in parts)
        node = table.column("node")[0].as_py()
        if node < 0:
            gain, f, cut, whole, left = -1.0, 0, 0, h, h
        else:
            h = h.reshape(n_features, bins, SUMS)
            gain, f, cut = best_split(h, least)
            whole, left = h[f].sum(axis=0), h[f, :cut + 1].sum(axis=0)
        return pa.table({"node": pa.array([node], pa.int32()), "gain": [gain], "feature": pa.array([f], pa.int32()), "bin": pa.array([cut], pa.int32()),
                         "all": [whole.tolist()], "left": [left.tolist()]})

    return (blocks.mapInArrow(sums, "node int, part int, h binary").groupBy("node")
            .applyInArrow(best, "node int, gain double, feature int, bin int, `all` array<double>, `left` array<double>")).collect()     # a row per node


def _grown(blocks: DataFrame, layout: Layout, trees: list[tuple], weights: list[float], first: bool, least: int, levels: int) -> tuple[Tree, float | None]:
    """The next tree, and the mean loss of the held-out rows before it."""
    tree, active, loss = Tree(), [0], None
    per_pass = max(1, STATS_BYTES // (8 * SUMS * max(sum(layout.width), len(layout.bins) * max(layout.bins))))
    for level in range(levels):
        below = []
        for lo in range(0, len(active), per_pass):
            for r in sorted(_pass(blocks, layout, trees, weights, first, tree, active[lo:lo + per_pass], least), key=lambda r: r["node"]):
                node, whole = r["node"], np.array(r["all"])
                if node < 0:
                    loss = whole[0] / whole[1]
                    continue
                if node == 0:
                    tree.sums[0] = whole
                if r["gain"] > LEAST_GAIN:
                    below.append((node, r["feature"], r["bin"], r["gain"], np.array(r["left"])))
        active = [child for split in below for child in tree.split(*split) if abs(variance(tree.sums[child])) >= PURE]
        if not active:
            break
    return tree, loss


def fit_trees(rows: DataFrame, n_features: int, gbt: GBTClassifier, patience: int | None = None, tolerance: float = 0.0) -> tuple[list[Tree], list[np.ndarray], list[float]]:
    """Trees, split thresholds and staged held-out losses for ``rows`` (x, label, weight, held).

    With ``patience`` boosting ends after as many rounds without a gain of
    ``tolerance`` on the held-out rows, and the trees are those of the best prefix.
    """
    from cohortlens.operators.models import stop_round
    rows = materialize(rows, "table")
    n, n_held, bad = rows.agg(F.count_if(~F.col("held")), F.count_if("held"), F.count_if(F.expr(
        "label is null or label not in (0, 1) or weight is null or not weight >= 0"))).first()
    if not n or bad:
        raise ValueError(f"boosting needs rows with labels 0 and 1 and weights: {n} rows, {bad} without")
    if patience is not None and not n_held:
        raise ValueError("early stopping held out no row")
    cuts = weighted_cuts(rows.where("not held"), n_features)
    layout = Layout([max(2, len(c) + 1) for c in cuts])
    blocks = materialize(_blocks(rows, cuts, layout), "table")
    most, step, least, levels = gbt.getMaxIter(), gbt.getStepSize(), gbt.getMinInstancesPerNode(), gbt.getMaxDepth()
    done: list[Tree] = []
    losses: list[float] = []
    late: list[tuple] = []                          # trees that the written margins do not have yet
    scale: list[float] = []
    while True:
        if len(late) == MARGIN_ROUNDS:
            blocks = _moved(blocks, layout, late, scale)
            late, scale = [], []
        last = len(done) == most
        if last and patience is None:
            return done, cuts, losses
        # after the last round only the held-out loss is asked for
        tree, loss = _grown(blocks, layout, late, scale, not done, least, min(levels, 1) if last else levels)
        if done and patience is not None:
            losses.append(loss)
            best, over = stop_round(losses, patience, tolerance)
            if over or last:
                return done[:best], cuts, losses
        done.append(tree)
        late.append(tree.arrays())
        scale.append(1.0 if len(done) == 1 else step)


# ------------------------------------------------------------------ the model
def node_rows(tree: Tree, cuts: list[np.ndarray]) -> list[tuple]:
    """MLlib's node rows in its numbering (parents first); sibling leaves that predict alike become their parent."""
    feature, _, left, says = (a.tolist() for a in tree.arrays())
    for i in range(len(left) - 1, -1, -1):
        a = left[i]
        if a >= 0 and left[a] < 0 and left[a + 1] < 0 and says[a] == says[a + 1]:
            left[i] = -1
    order, number = [0], {}
    while order:
        i = order.pop()
        number[i] = len(number)
        if left[i] >= 0:
            order += [left[i] + 1, left[i]]
    out = []
    for i, k in number.items():
        leaf = left[i] < 0
        s = tree.sums[i]
        split = (-1, [], -1) if leaf else (feature[i], [float(cuts[feature[i]][tree.bin[i]])], -1)
        out.append((k, says[i], variance(s), s[:3].tolist(), int(s[3]), -1.0 if leaf else tree.gain[i],
                    -1 if leaf else number[left[i]], -1 if leaf else number[left[i] + 1], split))
    return out


def model_of(spark: SparkSession, trees: list[Tree], cuts: list[np.ndarray], gbt: GBTClassifier, n_features: int) -> GBTClassificationModel:
    """MLlib's model, loaded from the node table; parameters are those of ``gbt``."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/models/{uuid.uuid4().hex}"
    gbt.write().overwrite().save(f"{folder}/estimator")
    meta = json.loads(spark.read.text(f"{folder}/estimator/metadata").first()[0])
    model = meta | {"class": "org.apache.spark.ml.classification.GBTClassificationModel", "numFeatures": n_features, "numTrees": len(trees)}
    of_tree = ("labelCol", "featuresCol", "predictionCol", "weightCol", "leafCol", "maxBins", "maxDepth", "maxMemoryInMB", "minInfoGain",
               "minInstancesPerNode", "minWeightFractionPerNode", "cacheNodeIds", "checkpointInterval", "seed")
    tree = meta | {"class": "org.apache.spark.ml.regression.DecisionTreeRegressionModel", "numFeatures": n_features} | {
        k: {c: v for c, v in meta[k].items() if c in of_tree} for k in ("paramMap", "defaultParamMap")}
    tree["paramMap"]["impurity"] = "variance"
    path = f"{folder}/model"
    spark.createDataFrame([(json.dumps(model),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame([(t, json.dumps(tree | {"uid": f"dtr_{t}"}), 1.0 if t == 0 else gbt.getStepSize()) for t in range(len(trees))],
                          "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    nodes = [(t, row) for t, one in enumerate(trees) for row in node_rows(one, cuts)]
    spark.createDataFrame(nodes, f"treeID int, nodeData struct<{_colons(NODE)}>").coalesce(1).write.parquet(f"{path}/data")
    return GBTClassificationModel.load(path)


def fit_boosted(data: DataFrame, features_vec: str, n_features: int, gbt: GBTClassifier, held: str | None = None,
                patience: int | None = None, tolerance: float = 0.0) -> GBTClassificationModel:
    """``gbt`` fitted to the rows of ``data``, whose vector column ``features_vec`` has ``n_features`` slots.

    Rows flagged by the column ``held`` are not fitted; their loss ends boosting (``patience``).
    """
    rows = data.select(vector_to_array(features_vec).alias("x"), F.col(gbt.getLabelCol()).cast("double").alias("label"),
                       F.col(gbt.getWeightCol()).cast("double").alias("weight"), (F.col(held) if held else F.lit(False)).alias("held"))
    trees, cuts, _ = fit_trees(rows, n_features, gbt, patience, tolerance)
    return model_of(data.sparkSession, trees, cuts, gbt, n_features)
