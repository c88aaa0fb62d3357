"""Structured Streaming form of the scoring path (new rows without a target).

Every step of scoring is stateless once the fits exist: fitted medians/modes
(imputer), fitted levels (encoder), the feature list (alignment) and the
model. So a stream of new records is scored in append mode with exactly the
batch operators, micro-batch by micro-batch. Orders arrive as a file stream
and meet the static dimension/line tables through stream-static joins.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.operators.clean import Imputer
from cohortlens.operators.encode import Levels
from cohortlens.operators.features import create_features
from cohortlens.session import ensure_checkpoint_dir, materialize
from cohortlens.sources.binding import line_counts
from cohortlens.sources.tables import read_table
from cohortlens.spec import Spec


def score_frame(df: DataFrame, spec: Spec, imputer: Imputer, levels: Levels,
                features: list[str], model) -> DataFrame:
    """Batch or streaming frame -> (row_id, score, prediction); stateless."""
    clean = imputer.transform(df.drop(spec.target) if spec.target in df.columns else df)
    feats = create_features(clean, spec)
    enc = levels.transform(feats)
    for c in features:                                     # E4 alignment: missing -> 0
        if c not in enc.columns:
            enc = enc.withColumn(c, F.lit(0).cast("tinyint"))
    scored = model.transform(enc)
    threshold = getattr(model, "threshold", 0.5)
    return scored.select("row_id", "score",
                         (F.col("score") >= F.lit(threshold)).cast("int").alias("prediction"))


def order_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int = 1) -> DataFrame:
    """Orders as a file stream, bound to the patient shape with stream-static joins."""
    schema = read_table(spark, sf_dir, "orders").schema
    # the pattern takes single files and folders of part files; new ones are picked up
    orders = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
              .parquet(os.path.join(sf_dir, "orders*.parquet")))
    # written once, not aggregated anew for every micro-batch
    lines = materialize(line_counts(read_table(spark, sf_dir, "lineitem")), mode="table")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey",
                                                             "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = (orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")
         .join(customer, orders.o_custkey == customer.c_custkey, "left")
         .join(nation, customer.c_nationkey == nation.n_nationkey, "left"))
    return j.select(
        F.col("o_orderkey").alias("row_id"), F.col("o_orderpriority").alias("age"),
        "time_in_hospital", "n_medications",
        F.coalesce("n_outpatient", F.lit(0)).alias("n_outpatient"),
        F.coalesce("n_inpatient", F.lit(0)).alias("n_inpatient"),
        F.coalesce("n_emergency", F.lit(0)).alias("n_emergency"),
        F.col("o_orderpriority").alias("medical_specialty"), "c_mktsegment", "n_name",
        "min_returnflag")


def run_to_table(stream: DataFrame, name: str, sink_dir: str | None = None) -> DataFrame:
    """Drain the stream (availableNow) into a parquet table under the shared folder.

    Each run gets its own sink and stream state (a reused state folder would
    treat the files as already processed)."""
    import uuid
    spark = stream.sparkSession
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}-{uuid.uuid4().hex[:12]}"
    sink = sink_dir or f"{root}/data"
    q = (stream.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", f"{root}/state")
         .trigger(availableNow=True).start(sink))
    q.awaitTermination()
    return spark.read.parquet(sink)
