"""Artifact manifest write / read and the freshness gate.

The manifest is one small JSON record: config hash, source signature (total
size and newest modification time of the input files, read from the scan's
``_metadata`` column), cache version, shapes, feature list and fitted levels.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import json
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from cohortlens.spec import Spec

MANIFEST_SCHEMA = T.StructType([
    T.StructField("config_hash", T.StringType()),
    T.StructField("raw_size", T.LongType()),
    T.StructField("raw_mtime", T.DoubleType()),
    T.StructField("cache_version", T.IntegerType()),
    T.StructField("built_at", T.StringType()),
    T.StructField("encoded_rows", T.LongType()),
    T.StructField("encoded_cols", T.IntegerType()),
    T.StructField("analysis_rows", T.LongType()),
    T.StructField("analysis_cols", T.IntegerType()),
    T.StructField("feature_columns", T.ArrayType(T.StringType())),
    T.StructField("categorical_levels", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
])
CACHE_VERSION = 2


def config_hash(spec: Spec) -> str:
    """Canonical JSON of the spec -> sha256 (one rule for every caller)."""
    blob = json.dumps(asdict(spec), sort_keys=True, default=str)
    return hashlib.sha256(blob.encode("utf-8")).hexdigest()


def source_signature(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One row: total bytes and newest modification time (epoch seconds) of the inputs."""
    files = None
    for p in paths:
        f = (spark.read.parquet(p)
             .select("_metadata.file_path", "_metadata.file_size",
                     "_metadata.file_modification_time").distinct())
        files = f if files is None else files.unionByName(f)
    return files.agg(
        F.sum("file_size").cast("bigint").alias("raw_size"),
        F.max(F.unix_micros("file_modification_time") / 1e6).alias("raw_mtime"),
    )


def build_manifest(spark: SparkSession, spec: Spec, source_paths: list[str],
                   encoded: DataFrame, analysis: DataFrame, feature_columns: list[str],
                   levels: dict[str, list[str]], n_rows: int | None = None) -> DataFrame:
    sig = source_signature(spark, source_paths).first()
    n = n_rows if n_rows is not None else encoded.count()
    row = (config_hash(spec), sig["raw_size"], sig["raw_mtime"], CACHE_VERSION,
           _dt.datetime.now(_dt.timezone.utc).isoformat(timespec="seconds"),
           n, len(encoded.columns), n, len(analysis.columns), list(feature_columns),
           {k: list(v) for k, v in levels.items()})
    return spark.createDataFrame([row], MANIFEST_SCHEMA)


def write_manifest(manifest: DataFrame, path: str) -> None:
    manifest.coalesce(1).write.mode("overwrite").json(path)


def read_manifest(spark: SparkSession, path: str) -> dict | None:
    """Parse; absent, malformed or mistyped -> None (never raises)."""
    try:
        # StructType.add mutates in place: build a new schema with the corrupt-record column
        schema = T.StructType(MANIFEST_SCHEMA.fields + [T.StructField("_corrupt", T.StringType())])
        df = (spark.read.schema(schema)
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt")
              .json(path))
        rows = df.limit(2).collect()
    except AnalysisException:
        return None
    if len(rows) != 1 or rows[0]["_corrupt"] is not None:
        return None
    rec = rows[0].asDict()
    rec.pop("_corrupt", None)
    if not isinstance(rec.get("feature_columns"), list):
        return None
    return rec


def freshness_reasons(stored: dict | None, current: dict, outputs_exist: bool = True) -> list[str]:
    """Why the artifacts must be rebuilt (empty list = fresh)."""
    reasons = []
    if not outputs_exist:
        reasons.append("outputs missing")
    if stored is None:
        reasons.append("manifest missing or unparsable")
        return reasons
    for key in ("config_hash", "raw_size", "raw_mtime", "cache_version"):
        if stored.get(key) != current.get(key):
            reasons.append(f"{key} changed")
    return reasons
