"""A corpus pipeline: language ID, near-dedup, decontamination, mixing, sharding.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame. All but the last return the columns of ``docs``.
``run`` writes each stage's result as Parquet in the shared checkpoint folder
and rereads it for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import decontam, kdshard, langid, minhash, mix
from cohortlens.llm.common import stored, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; null texts and texts without a letter go."""
    model = langid.fit(docs.where(~langid.held_out("doc_id")))
    clash = {"lang_pred", "score"} & set(docs.columns)
    named = docs.withColumnsRenamed({c: f"__own_{c}" for c in clash})
    out = langid.predict(named, model).where(F.col("lang_pred") != langid.UNDETERMINED)
    return out.drop("lang_pred", "score").withColumnsRenamed({f"__own_{c}": c for c in clash}).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group; of rows that share a doc_id one stays, null ids all stay."""
    kept = minhash.near_duplicates(docs).where("kept and doc_id is not null").select(F.col("doc_id").alias("__kept")).distinct()
    own = docs.join(kept, docs["doc_id"].cast("long") == kept["__kept"], "left_semi")
    return own.dropDuplicates(["doc_id"]).unionByName(docs.where("doc_id is null")).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    leaks = decontam.leaks(docs, table(spark, sf_dir, "benchmark")).where("doc_id is not null").select(F.col("doc_id").alias("__leak")).distinct()
    return docs.join(leaks, docs["doc_id"].cast("long") == leaks["__leak"], "left_anti")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: copies of documents as often as their blocks are taken."""
    return mix.mixed_documents(docs).select(*docs.columns)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every row."""
    return kdshard.shard(docs)


STAGES = [("language", language), ("near_dedup", near_dedup), ("decontamination", decontamination), ("mixing", mixing), ("sharding", sharding)]

#: No SQL form: signatures, alignment and permutations; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
