"""Embedding near-dedup: spherical k-means cells, blocked cosine products inside a cell, one representative per group.

The centroids are fitted on a bounded sample by Spark (Lloyd rounds, partial
sums per task). Every vector is at home in the cell of its best centroid. It is
also a guest in each lower-numbered cell that a partner could be at home in:
partners lie within a distance r, so if y prefers centroid d to x's own c,
then x . (c - d) <= r |c - d|. So no link is lost at a cell border.

A cell is cut into blocks of bounded size. A unit of work is a pair of blocks:
two matrices are multiplied, and per vector its number of links and one link
to the smallest vector it reaches there go out, never all pairs. Equal vectors
are one class before any comparison.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import components, stored

SIMILAR = 0.95
#: Expected rows of the sample that the centroids are fitted on; Lloyd rounds.
SAMPLE = 20_000
ROUNDS = 4
PER_CELL = 4096
MOST_CELLS = 1024
BLOCK = 4096
#: Products are screened in single precision; this near the threshold they are decided in double.
CLOSE = 2e-5


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column, padded with zeros to ``dim``."""
    lengths = np.diff(col.offsets.to_numpy())
    flat = col.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == dim).all():
        return flat.reshape(len(col), dim)
    out = np.zeros((len(col), dim))
    out[np.repeat(np.arange(len(col)), lengths), np.concatenate([np.arange(k) for k in lengths] or [np.empty(0, int)])] = flat
    return out


def _unit_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, h1, h2, dim, u): the usable vectors at length 1 in double precision; equal vectors have equal h1, h2."""
    def run(batches):
        for batch in batches:
            keep, units = [], []
            for i, v in enumerate(batch.column(3)):
                values = v.values
                if values is None or not len(values) or values.null_count:
                    continue
                x = values.cast(pa.float64()).to_numpy()
                if np.isfinite(x).all() and (top := np.abs(x).max()):
                    x = x / top
                    units.append(x / np.sqrt((x * x).sum()))
                    keep.append(i)
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(at) for c in range(3)), pa.array([len(u) for u in units], pa.int64()), pa.array(units, pa.list_(pa.float64()))],
                names=["vec_id", "h1", "h2", "dim", "u"])

    rows = vectors.select(F.col("vec_id").cast("long"), *_keys(), "embedding").where("vec_id is not null and embedding is not null")
    return rows.mapInArrow(run, "vec_id long, h1 long, h2 long, dim long, u array<double>")


def _keys():
    return F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit("second"), F.col("embedding")).alias("h2")


def fit(units: DataFrame, rows: int, cells: int, dim: int, sample: int = SAMPLE, rounds: int = ROUNDS) -> np.ndarray:
    """``cells`` unit centroids, fitted on about ``sample`` rows chosen by hashed id."""
    spark = units.sparkSession
    part = units.where(F.pmod(F.xxhash64("rep"), F.lit(1 << 20)) < max(1, min(1 << 20, (sample << 20) // max(rows, 1)))).select("rep", "u")
    part = stored(part)
    start = part.orderBy(F.xxhash64("rep", F.lit(1)), "rep").limit(cells).select("u").toArrow()
    centroids = _matrix(start.column(0).combine_chunks(), dim)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(centroids)

        def sums(batches, shared=shared):
            c = shared.value
            total = np.zeros_like(c)
            for batch in batches:
                x = _matrix(batch.column(0), c.shape[1])
                np.add.at(total, (x @ c.T).argmax(axis=1), x)
            full = np.flatnonzero(np.abs(total).sum(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(list(total[full]), pa.list_(pa.float64()))], names=["cell", "s"])

        moved = np.zeros_like(centroids)
        by_dim = (part.select("u").mapInArrow(sums, "cell long, s array<double>").select("cell", F.posexplode("s").alias("p", "x"))
                  .groupBy("cell", "p").agg(F.sum("x").alias("x"))).toArrow()
        moved[by_dim.column("cell").to_numpy(), by_dim.column("p").to_numpy()] = by_dim.column("x").to_numpy()
        norm = np.sqrt((moved * moved).sum(axis=1, keepdims=True))
        centroids = np.where(norm > 0, moved / np.where(norm > 0, norm, 1), centroids)
    return centroids


def _assigned(classes: DataFrame, centroids: np.ndarray, similar: float, places_only: bool = False) -> DataFrame:
    """(cell, home, rep, n, dim, u): each vector at home, and as a guest in lower cells that a partner may be in; (cell, home) if ``places_only``."""
    shared = classes.sparkSession.sparkContext.broadcast(centroids)
    reach = np.sqrt(max(0.0, 2 - 2 * similar)) + 1e-6

    def run(batches):
        c = shared.value
        apart = np.sqrt(np.maximum(0, 2 - 2 * c @ c.T))
        for whole in batches:
            for lo in range(0, whole.num_rows, 2048):
                batch = whole.slice(lo, 2048)
                s = _matrix(batch.column(3), c.shape[1]) @ c.T
                row = np.arange(len(s))
                home = s.argmax(axis=1)
                near = (s[row, home][:, None] - s <= reach * apart[home]) & (np.arange(len(c)) < home[:, None])
                near[row, home] = True
                row, cell = near.nonzero()
                if places_only:
                    yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(home[row] == cell)], names=["cell", "home"])
                    continue
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(home[row] == cell), *(x.take(pa.array(row)) for x in batch.columns)],
                                                 names=["cell", "home", "rep", "n", "dim", "u"])

    schema = "cell long, home boolean" + ("" if places_only else ", rep long, n long, dim long, u array<double>")
    return classes.select("rep", "n", "dim", "u").mapInArrow(run, schema)


def _compare(table: pa.Table, similar: float) -> pa.Table:
    """Links of one pair of blocks (i, j): rows (rep, links, least)."""
    table = table.combine_chunks()
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    dims = table.column("dim").to_numpy()
    x = _matrix(table.column("u").chunk(0), int(dims.max()))
    x32 = x.astype(np.float32)
    rep, n, home, block = (table.column(c).to_numpy() for c in ("rep", "n", "home", "block"))
    a = np.flatnonzero(block == i)
    b = a if i == j else np.flatnonzero(block == j)
    links = np.zeros(len(rep), dtype=np.int64)
    mixed = dims.min() != dims.max()
    order = np.argsort(rep, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(rep))
    label = rank.copy()
    hits = []
    for lo in range(0, len(a), 512):
        rows = a[lo:lo + 512]
        cos = x32[rows] @ x32[b].T
        hit = cos >= similar - CLOSE
        # only rows and columns with a hit go on, whose number the pairs found bound
        if i == j:
            hit[np.arange(len(rows)), np.arange(lo, lo + len(rows))] = False
        some = np.flatnonzero(hit.any(axis=1))
        if not len(some):
            continue
        cols = np.flatnonzero(hit[some].any(axis=0))
        at = np.ix_(some, cols)
        hit, cos, rows, cols = hit[at], cos[at], rows[some], b[cols]
        hit &= home[rows][:, None] | home[cols][None, :]
        if mixed:
            hit &= dims[rows][:, None] == dims[cols][None, :]
        p, q = np.nonzero(hit & (cos < similar + CLOSE))
        for s in range(0, len(p), 65536):
            u, v = p[s:s + 65536], q[s:s + 65536]
            hit[u, v] = np.einsum("ij,ij->i", x[rows[u]], x[cols[v]]) >= similar
        links[rows] += hit @ n[cols]
        if i != j:
            links[cols] += n[rows] @ hit
        hits.append((rows, cols, np.packbits(hit, axis=1)))
    while hits:
        before = label.copy()
        for rows, cols, packed in hits:
            hit = np.unpackbits(packed, axis=1, count=len(cols)).astype(bool)
            low = np.where(hit, label[cols][None, :], len(rep)).min(axis=1)
            label[rows] = np.minimum(label[rows], low)
            low = np.where(hit, label[rows][:, None], len(rep)).min(axis=0)
            label[cols] = np.minimum(label[cols], low)
        if (label == before).all():
            break
    at = np.flatnonzero(links)
    return pa.table([pa.array(rep[at]), pa.array(links[at]), pa.array(rep[order][label[at]])], names=["rep", "links", "least"])


def _pairs_in_cells(classes: DataFrame, centroids: np.ndarray, similar: float) -> int:
    """Products that the cells would ask for, each pair twice."""
    sizes = _assigned(classes, centroids, similar, places_only=True).groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    return int(sizes.agg(F.sum(F.col("n") * F.col("n"))).first()[0] or 0)


def near_duplicates(vectors: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding): vec_id, n_links, component_id, kept.

    Vectors that are null, empty, zero, or hold null or non-finite values link
    with nothing, as do rows with a null vec_id (whose component is null).
    Vectors of different lengths are not compared. Rows that repeat a vec_id
    are separate vectors of one node. The kept one is the smallest vec_id.
    """
    units = stored(_unit_vectors(vectors))
    classes = stored(units.groupBy("h1", "h2", "dim").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("u").alias("u")))
    rows, dim = classes.agg(F.count(F.lit(1)), F.max("dim")).first()
    cells = max(1, min(MOST_CELLS, -(-rows // PER_CELL)))
    centroids = fit(classes, rows, cells, dim) if cells > 1 else None
    # guests of vectors without clusters may make the cells dearer than one cell that holds every vector once
    if centroids is not None and _pairs_in_cells(classes, centroids, similar) < rows * rows:
        assigned = stored(_assigned(classes, centroids, similar))
    else:
        assigned = classes.select(F.lit(0).cast("long").alias("cell"), F.lit(True).alias("home"), "rep", "n", "dim", "u")
    sizes = assigned.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("long").alias("blocks"))
    placed = (assigned.join(F.broadcast(sizes), "cell")                              # one row per cell, MOST_CELLS at most
              .withColumn("block", F.pmod(F.xxhash64("rep"), "blocks"))
              .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
              .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("blocks", "other"))
    found = stored(placed.groupBy("cell", "i", "j").applyInArrow(lambda t: _compare(t, similar), "rep long, links long, least long"))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    comp = components(found.select(F.col("rep").alias("u"), F.col("least").alias("v")))
    named = (classes.select("h1", "h2", "dim", "rep", "n").join(links, "rep", "left").join(comp.withColumnRenamed("node", "rep"), "rep", "left")
             .select("h1", "h2", "dim", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component")))
    usable = units.select("vec_id", "h1", "h2", "dim").distinct()
    keyed = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), *_keys()).join(usable, ["vec_id", "h1", "h2"], "left")
    out = keyed.join(named, ["h1", "h2", "dim"], "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.when(F.col("vec_id").isNotNull(), component).alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
