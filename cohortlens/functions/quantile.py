"""Exact quantiles without gathering a column's values in one task.

The values are cut at approximate percentiles; one aggregate counts each
bucket exactly, and only the buckets that hold a wanted rank are cut again,
until a bucket is one value. Each pass leaves about 1/``CUTS`` of the rows, and
the driver sees at most ``CUTS + 2`` rows per open bucket. The result is the
same at every size.
"""

from __future__ import annotations

import math
from bisect import bisect_left

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CUTS = 256


def _within(long: DataFrame, rows: list[tuple]) -> DataFrame:
    """The values of the open ranges; ``rows`` (part, column, lo, hi, cuts) are bounded by the wanted ranks."""
    schema = "part int, of string, from double, to double, cuts array<double>"
    parts = F.broadcast(long.sparkSession.createDataFrame(rows, schema))
    return long.join(parts, (F.col("column") == F.col("of")) & F.col("v").between(F.col("from"), F.col("to")))


def cuts_below(cuts: Column, v: Column) -> Column:
    """How many of at most ``CUTS`` ascending ``cuts`` lie below ``v``, by halving: nine looks instead of ``CUTS``."""
    halves = F.array(*[F.lit(2 ** i) for i in range(CUTS.bit_length() - 1, -1, -1)])
    return F.aggregate(halves, F.lit(0), lambda at, step: at + F.when(
        F.try_element_at(cuts, at + step) < v, step).otherwise(0))


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float]) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of each numeric column; nulls and NaN are left out.

    A column without values gives nulls.
    """
    if not columns:
        return {}
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v"))
                                        for c in columns])))
    found = quantiles_of(long, probs)
    return {c: found.get(c, [None] * len(probs)) for c in columns}


def quartiles_by(long: DataFrame, groups: list[str], value: str, probs: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(``__key``, q) with the quantiles of ``value`` for each combination of ``groups``; see ``group_key``.

    There is one row per group in the result and on the driver, so the groups
    must be few (features and classes).
    """
    found = quantiles_of(long.select(group_key(groups).alias("column"), F.col(value).cast("double").alias("v")), list(probs))
    return F.broadcast(long.sparkSession.createDataFrame(list(found.items()), "__key string, q array<double>"))


def group_key(groups: list[str]) -> Column:
    """A string that tells the combinations of ``groups`` apart, nulls included."""
    return F.to_json(F.struct(*groups))


def quantiles_of(long: DataFrame, probs: list[float]) -> dict[str, list[float]]:
    """Linearly interpolated quantiles of ``v`` for each ``column`` of a long table."""
    long = long.where(F.col("v").isNotNull() & ~F.isnan("v"))
    stats = [F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"),
             F.percentile_approx("v", [i / CUTS for i in range(1, CUTS)], 50 * CUTS).alias("cuts")]
    first = {r["column"]: r for r in long.groupBy("column").agg(*stats).collect()}
    wanted = {(c, k): k for c, r in first.items() for q in probs for k in (math.floor((r["n"] - 1) * q), math.ceil((r["n"] - 1) * q))}
    part_of = {w: (w[0], first[w[0]]["lo"], first[w[0]]["hi"]) for w in wanted}
    cuts = {(c, r["lo"], r["hi"]): sorted({r["lo"], *r["cuts"]}) for c, r in first.items()}
    found: dict[tuple[str, int], float] = {}
    while part_of:
        parts = sorted(set(part_of.values()))
        if any(p not in cuts for p in parts):
            got = _within(long, [(i, *p, None) for i, p in enumerate(parts)]).groupBy("part").agg(*stats).collect()
            cuts = {parts[r["part"]]: sorted({r["lo"], *r["cuts"]}) for r in got}
        # bucket i holds the values above cut i - 1 up to cut i
        counted = (_within(long, [(i, *p, cuts[p]) for i, p in enumerate(parts)])
                   .groupBy("part", cuts_below(F.col("cuts"), F.col("v")).alias("b"))
                   .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect())
        by_part: dict = {}
        for r in sorted(counted, key=lambda r: r["b"]):
            rows = by_part.setdefault(parts[r["part"]], [])
            rows.append(((rows[-1][0] if rows else 0) + r["n"], r["n"], r["lo"], r["hi"]))
        for w, p in list(part_of.items()):
            rows = by_part[p]
            end, n, lo, hi = rows[bisect_left([r[0] for r in rows], wanted[w] + 1)]
            if lo == hi:
                found[w] = lo
                del part_of[w]
            else:
                wanted[w] -= end - n
                part_of[w] = (w[0], lo, hi)
        cuts = {}
    out: dict[str, list[float]] = {}
    for c, r in first.items():
        h = [(r["n"] - 1) * q for q in probs]
        out[c] = [found[c, math.floor(x)] + (found[c, math.ceil(x)] - found[c, math.floor(x)]) * (x - math.floor(x)) for x in h]
    return out
