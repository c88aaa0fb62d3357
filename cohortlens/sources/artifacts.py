"""Feature-table sinks and scans (Parquet by default, CSV optional).

Artifacts live under a shared folder: the session's ``spark.checkpoint.dir``
unless the caller names one, so every executor and later job sees them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.operators.clean import ROW_ID
from cohortlens.session import ensure_checkpoint_dir
from cohortlens.sources.tables import assign_row_id


def artifact_dir(spark: SparkSession, name: str, base: str | None = None) -> str:
    root = base or ensure_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/artifacts/{name}-{uuid.uuid4().hex[:12]}"


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Write with ``row_id`` kept as a column."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)
    return path


def load_features(spark: SparkSession, path: str, target: str, exclude=(), redundant=(),
                  fmt: str = "parquet") -> tuple[DataFrame, list[str]]:
    """S3: an encoded table as (row_id, features..., target), and the feature names.

    One ``select`` over the columns that stay, so a scan reads nothing else. A
    table that was written without ``row_id`` gets one by position in its files.
    """
    stored = (spark.read.option("header", True).option("inferSchema", True).csv(path) if fmt == "csv"
              else spark.read.parquet(path))
    if ROW_ID not in stored.columns:
        stored = assign_row_id(stored, ROW_ID)
    plain = {c: c.replace(" ", "_") for c in stored.columns}
    if len(set(plain.values())) < len(plain):
        raise ValueError(f"{path}: column names that differ only in spaces: {sorted(plain)}")
    if target not in plain.values():
        raise KeyError(f"{path} has no column {target}, only {sorted(plain.values())}")
    unwanted = {c.replace(" ", "_") for c in (*exclude, *redundant)} - {ROW_ID, target}
    features = [new for new in plain.values() if new not in unwanted and new not in (ROW_ID, target)]
    old = {new: c for c, new in plain.items()}
    return stored.select(*[F.col(f"`{old[c]}`").alias(c) for c in (ROW_ID, *features, target)]), features
