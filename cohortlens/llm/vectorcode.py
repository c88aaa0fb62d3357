"""Vector code compression: product codes by k-means over anchors-hierarchy metric trees.

A vector is cut into ``PARTS`` equal consecutive parts of integers; each part
gets the index of its nearest codebook entry. Spark deals the vectors into
blocks of at most ``BLOCK`` rows. Each block builds, once, one metric tree per
part position, middle-out (Moore 2000): about sqrt(n) anchors steal points from
each other by the triangle inequality, neighbouring anchors are merged into the
balls above, and every anchor's points are cut on below. A ball caches its
count and its sum. The trees are written to the shared folder and reread in
every round: a ball inherits its parent's list of candidate entries, strikes
out those that lose against the best entry everywhere in the ball, and gives
its cached sum and count away as soon as one entry is left. Only (part, entry)
totals leave the tasks, at most 8 x 16 rows per round on the driver.

The results are those of plain k-means on integers: bounds are widened by a
margin above their rounding error, entries that tie stay candidates, and
distances to single points are exact integers.

Defined cases: rows whose vector is null or holds null or non-finite
components are dropped; null ``vec_id`` rows are coded but never seed a
codebook; of rows that share a seeding ``vec_id`` the smallest vector seeds; rows
that are repeated are coded each on its own. Parts are as wide as the longest kept
vector needs, shorter vectors count as filled with zeros on the right; empty
vectors have parts of zeros. Components are held within +-2**47 after scaling
and an error that exceeds a long is the greatest long. Without any seed (no
kept row with an id) every code is empty, errors are 0. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import stored

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Vectors of one tree: bounds what a task holds, whatever the table's size.
BLOCK = 8192
#: Points of a ball that is not cut further.
LEAF = 24
#: Up to so many different labels their totals are broadcast (some 16 bytes each).
FEW_LABELS = 100_000
LABEL_SALTS = 64
_LIMIT = 2.0 ** 47
#: Above this size squared distances no longer fit 64-bit integers.
_WIDE = 1 << 27
_LONG = (1 << 63) - 1


# ------------------------------------------------------------------ metric trees
def _spread(points: np.ndarray, rows: np.ndarray, count: int) -> tuple[list[int], np.ndarray, np.ndarray]:
    """About ``count`` anchors over ``points[rows]``: their rows, each point's owner, its distance to it.

    The next anchor is the point farthest from the anchor with the largest
    radius. It looks only into balls that it can reach: a point within half
    the distance of the two anchors cannot change its owner.
    """
    x = points[rows]
    anchors = [0]
    own = np.zeros(len(rows), dtype=np.int64)
    dist = np.sqrt(((x - x[0]) ** 2).sum(axis=1))
    while len(anchors) < count:
        far = int(dist.argmax())
        if dist[far] == 0.0:
            break
        gap = np.sqrt(((x[anchors] - x[far]) ** 2).sum(axis=1))
        reach = np.flatnonzero(dist * 2.0 > gap[own])
        new = np.sqrt(((x[reach] - x[far]) ** 2).sum(axis=1))
        won = new < dist[reach]
        moved = reach[won]
        own[moved], dist[moved] = len(anchors), new[won]
        anchors.append(far)
    return anchors, own, dist


class Tree:
    """Balls in arrays, children after their parents; leaves are runs of ``order``."""

    def __init__(self, points: np.ndarray):
        self.points = points.astype(np.float64)
        self.exact = points
        self.order: list[np.ndarray] = []
        self.at = 0
        self.pivot: list[np.ndarray] = []
        self.sum: list[np.ndarray] = []
        self.radius: list[float] = []
        self.left: list[int] = []
        self.right: list[int] = []
        self.lo: list[int] = []
        self.hi: list[int] = []
        self._grow(np.arange(len(points)))

    def _ball(self, rows: np.ndarray) -> int:
        x = self.points[rows]
        pivot = x.mean(axis=0)
        self.pivot.append(pivot)
        self.sum.append(self.exact[rows].sum(axis=0))
        self.radius.append(float(np.sqrt(((x - pivot) ** 2).sum(axis=1).max())))
        for field in (self.left, self.right, self.lo, self.hi):
            field.append(-1)
        return len(self.pivot) - 1

    def _grow(self, rows: np.ndarray) -> int:
        """Middle-out: anchors in the middle, merged upwards, each cut on downwards."""
        leaf = len(rows) <= LEAF
        if not leaf:
            anchors, own, dist = _spread(self.points, rows, max(2, int(np.sqrt(len(rows)))))
            leaf = len(anchors) == 1                          # all points are equal
        if leaf:
            node = self._ball(rows)
            self.order.append(rows)
            self.lo[node], self.hi[node] = self.at, self.at + len(rows)
            self.at += len(rows)
            return node
        groups = [rows[own == k] for k in range(len(anchors))]
        return self._emit(groups, *_merge(self.points, groups))

    def _emit(self, groups: list[np.ndarray], merges: list[tuple[int, int]], top: int) -> int:
        if top < len(groups):
            return self._grow(groups[top])
        members: list[int] = []
        todo = [top]
        while todo:
            k = todo.pop()
            members.append(k) if k < len(groups) else todo.extend(merges[k - len(groups)])
        node = self._ball(np.concatenate([groups[k] for k in members]))
        self.lo[node] = self.at
        a, b = merges[top - len(groups)]
        self.left[node] = self._emit(groups, merges, a)
        self.right[node] = self._emit(groups, merges, b)
        self.hi[node] = self.at
        return node

    def packed(self) -> dict[str, np.ndarray]:
        order = np.concatenate(self.order) if self.order else np.empty(0, dtype=np.int64)
        return {"order": order.astype(np.int32), "points": self.exact[order],
                "pivot": np.array(self.pivot).reshape(len(self.pivot), -1), "radius": np.array(self.radius),
                "sums": np.array(self.sum, dtype=np.int64).reshape(len(self.sum), -1),
                "tree": np.array([self.left, self.right, self.lo, self.hi], dtype=np.int32)}


def _merge(points: np.ndarray, groups: list[np.ndarray]) -> tuple[list[tuple[int, int]], int]:
    """Merge the two balls whose common ball is smallest until one is left (radius bound by the anchors' balls)."""
    n = len(groups)
    centre = np.zeros((2 * n - 1, points.shape[1]))
    radius, weight = np.zeros(2 * n - 1), np.zeros(2 * n - 1)
    for k, rows in enumerate(groups):
        x = points[rows]
        centre[k], weight[k] = x.mean(axis=0), len(rows)
        radius[k] = np.sqrt(((x - centre[k]) ** 2).sum(axis=1).max())
    cost = np.full((2 * n - 1, 2 * n - 1), np.inf)
    for k in range(n):
        cost[k, :k] = (np.sqrt(((centre[:k] - centre[k]) ** 2).sum(axis=1)) + radius[:k] + radius[k]) / 2
    live, merges = list(range(n)), []
    for new in range(n, 2 * n - 1):
        a, b = np.unravel_index(int(cost[:new, :new].argmin()), (new, new))
        merges.append((int(a), int(b)))
        cost[[a, b], :] = np.inf
        cost[:, [a, b]] = np.inf
        live = [k for k in live if k not in (a, b)]
        weight[new] = weight[a] + weight[b]
        centre[new] = (centre[a] * weight[a] + centre[b] * weight[b]) / weight[new]
        radius[new] = max(np.sqrt(((centre[k] - centre[new]) ** 2).sum()) + radius[k] for k in (a, b))
        if live:
            cost[new, live] = (np.sqrt(((centre[live] - centre[new]) ** 2).sum(axis=1)) + radius[live] + radius[new]) / 2
        live.append(new)
    return merges, 2 * n - 2


def _nearest(points: np.ndarray, entries: np.ndarray, candidates: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact nearest candidate entry of each point (ties to the lower index) and the squared distance."""
    most = max(int(np.abs(points).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if most >= _WIDE:                                         # Python integers: slow, exact
        points, entries = points.astype(object), entries.astype(object)
    d = ((points[:, None, :] - entries[None, candidates, :]) ** 2).sum(axis=2)
    best = d.argmin(axis=1)
    return candidates[best], d[np.arange(len(points)), best]


def assign(tree: dict[str, np.ndarray], entries: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(ball, lo, hi, entry) of every ball that one entry owns, and (-1, i, i + 1, entry) of the points of balls that none owns."""
    pivot, radius, (left, right, lo, hi) = tree["pivot"], tree["radius"], tree["tree"]
    if not len(pivot):
        return
    e = entries.astype(np.float64)
    apart = np.sqrt(((e[:, None, :] - e[None, :, :]) ** 2).sum(axis=2))
    nodes, mask = np.array([0]), np.ones((1, len(e)), dtype=bool)
    while len(nodes):
        d = ((pivot[nodes][:, None, :] - e[None, :, :]) ** 2).sum(axis=2)
        d[~mask] = np.inf
        best = d.argmin(axis=1)
        least = d[np.arange(len(nodes)), best][:, None]
        # an entry loses in the whole ball if the ball lies on the best one's side of their bisector;
        # the margin is far above the rounding of sums and squares
        size = 1.0 + np.where(mask, d, 0.0) + least
        mask = mask & ~(d - least > 2.0 * radius[nodes][:, None] * apart[best] * (1 + 1e-9) + 1e-9 * size)
        alone = mask.sum(axis=1) == 1
        for n, b in zip(nodes[alone], best[alone]):
            yield int(n), int(lo[n]), int(hi[n]), int(b)
        inner = ~alone & (left[nodes] >= 0)
        for n, m in zip(nodes[~alone & ~inner], mask[~alone & ~inner]):
            won, _ = _nearest(tree["points"][lo[n]:hi[n]], entries, np.flatnonzero(m))
            for i, b in enumerate(won):
                yield -1, int(lo[n]) + i, int(lo[n]) + i + 1, int(b)
        nodes, mask = (np.concatenate([left[nodes[inner]], right[nodes[inner]]]),
                       np.concatenate([mask[inner], mask[inner]]))


def _owners(tree: dict[str, np.ndarray], entries: np.ndarray) -> np.ndarray:
    """Entry of each point of ``tree['points']``."""
    out = np.empty(len(tree["points"]), dtype=np.int64)
    for _, lo, hi, b in assign(tree, entries):
        out[lo:hi] = b
    return out


def _totals(tree: dict[str, np.ndarray], entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and count of the points of each entry: whole balls give their cached sum."""
    n, width = len(entries), tree["points"].shape[1]
    sums, counts = np.zeros((n, width), dtype=np.int64), np.zeros(n, dtype=np.int64)
    for node, lo, hi, b in assign(tree, entries):
        sums[b] += tree["sums"][node] if node >= 0 else tree["points"][lo]
        counts[b] += hi - lo
    return sums, counts


# ------------------------------------------------------------------ rows of blocks
def _pack(tree: dict[str, np.ndarray]) -> bytes:
    """One tree as bytes: lengths, then its arrays; small integers are held in two bytes."""
    n, width = tree["points"].shape
    nodes = len(tree["radius"])
    most = int(np.abs(tree["points"]).max(initial=0))
    kind = 0 if most < 1 << 15 else 1
    pts = tree["points"].astype(np.int16 if kind == 0 else np.int64)
    head = np.array([n, width, nodes, kind], dtype=np.int64)
    return b"".join(a.tobytes() for a in (head, tree["tree"].astype(np.int32), tree["pivot"].astype(np.float64),
                                          tree["radius"].astype(np.float64), tree["sums"], pts, tree["order"].astype(np.int32)))


def _unpack(raw: bytes) -> dict[str, np.ndarray]:
    n, width, nodes, kind = (int(v) for v in np.frombuffer(raw, np.int64, 4))
    at = 32

    def take(dtype, count):
        nonlocal at
        out = np.frombuffer(raw, dtype, count, at)
        at += out.nbytes
        return out

    tree = take(np.int32, 4 * nodes).reshape(4, nodes)
    pivot = take(np.float64, nodes * width).reshape(nodes, width)
    radius = take(np.float64, nodes)
    sums = take(np.int64, nodes * width).reshape(nodes, width)
    points = take(np.int16 if kind == 0 else np.int64, n * width).astype(np.int64).reshape(n, width)
    order = take(np.int32, n)
    return {"tree": tree, "pivot": pivot, "radius": radius, "points": points, "order": order, "sums": sums}


def _integers(column: pa.Array, width: int) -> np.ndarray:
    """Scaled integer matrix of a list column without nulls, zero-filled to ``PARTS * width``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False).astype(np.float64)[offsets[0]:offsets[-1]]
    sizes = np.diff(offsets)
    out = np.zeros((len(column), PARTS * width), dtype=np.int64)
    row = np.repeat(np.arange(len(column)), sizes)
    col = np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], sizes)
    out[row, col] = np.clip(np.floor(flat * SCALE), -_LIMIT, _LIMIT).astype(np.int64)
    return out


def _blocks(kept: DataFrame, width: int) -> DataFrame:
    """Blocks of at most ``BLOCK`` vectors: ids, labels and one tree per part."""
    label_type = kept.schema["label"].dataType.simpleString()

    def run(batches):
        held: list[pa.RecordBatch] = []
        n = 0

        def block():
            t = pa.Table.from_batches(held).combine_chunks()
            x = _integers(t.column("v"), width)
            trees = [_pack(Tree(x[:, p * width:(p + 1) * width]).packed()) for p in range(PARTS)]
            one = lambda c: pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c)
            ids, labels = (t.column(c).combine_chunks() for c in ("vec_id", "label"))
            flat = lambda c: c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
            return pa.RecordBatch.from_arrays([one(flat(ids)), one(flat(labels)), pa.array([trees], pa.list_(pa.binary()))],
                                              names=["ids", "labels", "trees"])

        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, BLOCK - n)
                batch = batch.slice(part.num_rows)
                held.append(part)
                n += part.num_rows
                if n == BLOCK:
                    yield block()
                    held, n = [], 0
        if n:
            yield block()

    return kept.mapInArrow(run, f"ids array<bigint>, labels array<{label_type}>, trees array<binary>")


# ------------------------------------------------------------------ the job
def _clean(vectors: DataFrame) -> DataFrame:
    v = F.col("embedding").cast("array<double>")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.where(F.col("embedding").isNotNull() & good).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label"), v.alias("v"))


def _seeds(kept: DataFrame, width: int) -> list[np.ndarray]:
    """First codebooks: the parts of the ``ENTRIES`` smallest ids, ascending."""
    ids = [r[0] for r in kept.where("vec_id is not null").select("vec_id").distinct().orderBy("vec_id").limit(ENTRIES).collect()]
    rows = kept.where(F.col("vec_id").isin(ids)).groupBy("vec_id").agg(F.min("v").alias("v")).orderBy("vec_id").collect()
    x = _integers(pa.array([r["v"] for r in rows], pa.list_(pa.float64())), width) if rows else np.zeros((0, PARTS * width), np.int64)
    return [x[:, p * width:(p + 1) * width] for p in range(PARTS)]


def _round(blocks: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """One round: totals per (part, entry) from the trees, then floor means; unused entries stay."""
    def run(batches):
        for batch in batches:
            for trees in batch.column(0):
                part, entry, pos, total, count = [], [], [], [], []
                for p, raw in enumerate(trees):
                    sums, counts = _totals(_unpack(raw.as_py()), books[p])
                    for b in np.flatnonzero(counts):
                        for k, v in enumerate(sums[b]):
                            part.append(p), entry.append(int(b)), pos.append(k), total.append(int(v)), count.append(int(counts[b]))
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(pos, pa.int32()),
                                                  pa.array(total, pa.int64()), pa.array(count, pa.int64())],
                                                 names=["part", "entry", "pos", "total", "n"])

    got = (blocks.select("trees").mapInArrow(run, "part int, entry int, pos int, total long, n long")
           .groupBy("part", "entry", "pos").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).collect())
    out = [b.copy() for b in books]
    for r in got:
        out[r["part"]][r["entry"], r["pos"]] = int(r["total"]) // r["n"]
    return out


def _coded(blocks: DataFrame, books: list[np.ndarray], label_type: str) -> DataFrame:
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids, labels = batch.column(0)[i].values, batch.column(1)[i].values
                n = len(ids)
                codes, error = np.zeros((n, PARTS), dtype=np.int64), np.zeros(n, dtype=object)
                for p, raw in enumerate(batch.column(2)[i]):
                    tree = _unpack(raw.as_py())
                    if not len(books[p]):
                        continue
                    own = _owners(tree, books[p])
                    pts, ent = tree["points"], books[p][own]
                    if max(int(np.abs(pts).max(initial=0)), int(np.abs(ent).max(initial=0))) >= _WIDE:
                        pts, ent = pts.astype(object), ent.astype(object)
                    codes[tree["order"], p] = own
                    error[tree["order"]] += ((pts - ent) ** 2).sum(axis=1)
                text = ["".join(f"{c:02x}" for c in row) if len(books[0]) else "" for row in codes.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [ids, labels, pa.array(text, pa.string()), pa.array([min(int(v), _LONG) for v in error], pa.int64())],
                    names=["vec_id", "label", "code", "error"])

    return blocks.mapInArrow(run, f"vec_id long, label {label_type}, code string, error long")


def compress(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256) of every kept row of ``vectors``.

    ``vectors`` has ``vec_id``, ``embedding`` and ``label``. See the module
    docstring for the cases and the method.
    """
    kept = _clean(vectors)
    longest = kept.agg(F.max(F.size("v"))).first()[0] or 0
    width = max(1, -(-longest // PARTS))
    books = _seeds(kept, width)
    label_type = kept.schema["label"].dataType.simpleString()
    blocks = stored(_blocks(kept, width))
    if len(books[0]):
        for _ in range(ROUNDS):
            books = _round(blocks, books)
    sha = hashlib.sha256(",".join(str(int(v)) for b in books for v in b.ravel()).encode()).hexdigest()
    coded = stored(_coded(blocks, books, label_type))
    per = coded.groupBy("label").agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_LONG).cast("decimal(38,0)")).cast("long").alias("label_error"))
    return _with_totals(coded, stored(per)).withColumn("codebooks_sha256", F.lit(sha))


def _with_totals(coded: DataFrame, per: DataFrame) -> DataFrame:
    """Label totals beside every row; a label that holds most rows is not gathered in one task."""
    right = per.withColumnRenamed("label", "__label")
    same = F.col("label").eqNullSafe(F.col("__label"))
    if per.count() <= FEW_LABELS:
        return coded.join(F.broadcast(right), same).drop("__label")
    left = coded.withColumn("__salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(LABEL_SALTS)).cast("int"))
    right = right.withColumn("__s", F.explode(F.sequence(F.lit(0), F.lit(LABEL_SALTS - 1))))
    return left.join(right, same & (F.col("__salt") == F.col("__s"))).drop("__label", "__s", "__salt")
