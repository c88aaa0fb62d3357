"""Session helpers: a local session for tests/bench, and lineage cutting.

On a cluster the caller brings its own session; nothing here overrides a
setting that is already present (notably ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | None = None, shuffle_partitions: int | None = None,
                  app: str = "cohortlens") -> SparkSession:
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    parts = shuffle_partitions or cores
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("COHORTLENS_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None where the session does not expose one."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the session names.

    ``spark.checkpoint.dir`` (or a folder already given to
    ``SparkContext.setCheckpointDir``) wins; only when neither is set (local
    tests) is a fresh folder created.
    """
    sc = _context(spark)
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path and sc is not None:
        try:
            existing = sc.getCheckpointDir()
        except Exception:          # no getter on this API surface
            existing = None
        if existing:
            # the context appends a random sub-folder; checkpoints land there too
            return existing
    if not path:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="cohortlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if sc is not None:
        sc.setCheckpointDir(path)
    return path


def parallelism(spark: SparkSession) -> int:
    """Tasks to spread a small-but-expanding frame over."""
    sc = _context(spark)
    base = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(base, sc.defaultParallelism) if sc is not None else base


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize(df: DataFrame, mode: str | None = "checkpoint", schema=None) -> DataFrame:
    """Stage boundary for a frame that several actions or branches reuse.

    ``table`` writes it as Parquet under the shared checkpoint folder and reads
    it back (lineage cut; later scans prune columns and push filters), with
    ``schema`` if one is given;
    ``checkpoint`` uses ``DataFrame.checkpoint`` in the same folder;
    ``persist`` keeps it in executor memory/disk; ``None`` leaves the plan lazy.
    An executor loss after the boundary re-reads files instead of replaying
    the upstream joins.
    """
    if mode == "table":
        import uuid
        spark = df.sparkSession
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
        df.write.mode("overwrite").parquet(path)
        return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
    if mode == "checkpoint":
        return cut_lineage(df)
    if mode == "persist":
        from pyspark import StorageLevel
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    return df
