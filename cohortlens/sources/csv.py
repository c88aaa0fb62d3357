"""Header CSV scan with an explicit schema and null-marker normalisation.

Spark's CSV reader keeps text like ``NA`` as a value, so the configured
markers are turned into nulls after reading (a literal ``Missing`` is a real
level and is never a marker). A missing path raises ``AnalysisException``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def normalize_null_markers(df: DataFrame, markers) -> DataFrame:
    markers = list(markers)
    return df.select([
        F.when(F.trim(F.col(f.name)).isin(markers), F.lit(None)).otherwise(F.col(f.name))
        .alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema.fields
    ])


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             null_markers=("", "NA", "N/A", "NaN", "nan", "null", "NULL", "None", "#N/A"),
             infer: bool = False, key: str | None = None) -> DataFrame:
    """Header CSV with an explicit schema (inference only as a fallback).

    With ``key`` given and absent from the file, consecutive row ids are
    assigned in scan order (S2).
    """
    reader = spark.read.option("header", True).option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    df = normalize_null_markers(reader.csv(path), null_markers)
    if key and key not in df.columns:
        from cohortlens.sources.tables import assign_row_id
        df = assign_row_id(df, key)
    return df


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
