"""Bind the driver's star-schema tables to the clinical table shape.

One row per order, whatever its status:

  row_id            o_orderkey
  age               o_orderpriority (ordered bracket, 5 levels)
  medical_specialty o_orderpriority (sentinel level ``4-NOT SPECIFIED``)
  c_mktsegment      customer segment (categorical)
  n_name            nation name (categorical)
  n_outpatient / n_inpatient / n_emergency
                    lines of the order with return flag N / R / A (0 without lines)
  time_in_hospital  max line number (null for orders without lines)
  n_medications     sum of line quantities (null for orders without lines)
  min_returnflag    smallest return flag of the order (null without lines)
  readmitted        ``F`` for finished orders (positive), ``O`` for all other statuses (raw text);
                    null where the status is null

Plan shape: lineitem is pre-aggregated by order key (partial aggregation on
the map side) before it meets orders, so the big join is 1:1 on the order key;
customer and nation are dimension joins that AQE turns into broadcasts only
when their measured size is under the threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.sources.tables import read_table


def line_counts(lineitem: DataFrame) -> DataFrame:
    """Per-order line aggregates. Every buffer is fixed-width (the smallest
    one-character flag is taken as its code point), so Spark plans a hash
    aggregate with map-side partial aggregation instead of a sort aggregate."""
    flag = F.col("l_returnflag")
    agg = lineitem.groupBy("l_orderkey").agg(
        F.max("l_linenumber").cast("int").alias("time_in_hospital"),
        F.sum("l_quantity").cast("bigint").alias("n_medications"),
        F.count_if(flag == "N").cast("int").alias("n_outpatient"),
        F.count_if(flag == "R").cast("int").alias("n_inpatient"),
        F.count_if(flag == "A").cast("int").alias("n_emergency"),
        F.min(F.ascii(flag)).alias("__min_flag"),
    )
    return agg.withColumn("min_returnflag", F.expr("chr(__min_flag)")).drop("__min_flag")


def order_label() -> Column:
    """``F`` against all other statuses; a null status has no label."""
    status = F.col("o_orderstatus")
    return F.when(status == "F", "F").when(status.isNotNull(), "O")


def orders_patient_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = (read_table(spark, sf_dir, "orders")
              .select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"))
    lines = line_counts(read_table(spark, sf_dir, "lineitem"))
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey",
                                                             "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    joined = (orders
              .join(lines, orders.o_orderkey == lines.l_orderkey, "left")
              .join(customer, orders.o_custkey == customer.c_custkey, "left")
              .join(nation, customer.c_nationkey == nation.n_nationkey, "left"))
    return joined.select(
        F.col("o_orderkey").alias("row_id"),
        F.col("o_orderpriority").alias("age"),
        "time_in_hospital",
        "n_medications",
        F.coalesce("n_outpatient", F.lit(0)).alias("n_outpatient"),
        F.coalesce("n_inpatient", F.lit(0)).alias("n_inpatient"),
        F.coalesce("n_emergency", F.lit(0)).alias("n_emergency"),
        F.col("o_orderpriority").alias("medical_specialty"),
        "c_mktsegment",
        "n_name",
        "min_returnflag",
        order_label().alias("readmitted"),
    )


def documents_labelled_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second binding: labelled documents; documents without a label are left out (a supervised table).

    ``quality`` is the 0/1 target, ``lang`` / ``source`` are categoricals and
    ``n_chars`` plus the toxic flag are numeric features.
    """
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return (docs.join(labels, "doc_id", "inner")
            .select(F.col("doc_id").alias("row_id"), "lang", "source", "n_chars", "toxic",
                    "quality"))
