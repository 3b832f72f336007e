"""Session helpers: building a local session for tests and reliable checkpoints.

On a cluster the session is built by the caller; the library only reads
``spark.checkpoint.dir`` (a shared, fault-tolerant folder) from it and refuses
to write intermediate tables anywhere else.  Tests and the bench pass a folder
of their own to ``local_session``.
"""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


_KEPT: dict[str, list[DataFrame]] = {}
_CACHE_COALESCE_KEY = "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "shroud", checkpoint_dir: str | None = None) -> SparkSession:
    """A local session with AQE on and the web UI off (tests and bench)."""
    builder = SparkSession.builder
    if checkpoint_dir is not None:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    return (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config(_CACHE_COALESCE_KEY, "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Uses the directory already set on the SparkContext or ``spark.checkpoint.dir``;
    without either, nothing may be written: a folder that executors don't share
    would lose data.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared, fault-tolerant folder")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-path of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/shroud-{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (reliable checkpoint).

    Survives executor loss (unlike a local checkpoint) and bounds the plan size
    of iterative operators.  The input is persisted first so that the
    checkpoint write reads the computed partitions instead of recomputing them.
    """
    checkpoint_dir(df.sparkSession)
    kept = persisted(df)
    out = kept.checkpoint(eager=True)
    kept.unpersist()
    return out


def persisted(df: DataFrame) -> DataFrame:
    """``df.persist(MEMORY_AND_DISK)``, letting AQE coalesce the kept table.

    By default a cached plan keeps ``spark.sql.shuffle.partitions`` output
    partitions (hundreds of thousands on a large cluster) even for a tiny
    aggregate; the session option that lets AQE coalesce them is switched on
    here when it is still off."""
    spark = df.sparkSession
    if spark.conf.get(_CACHE_COALESCE_KEY, "false") == "false":
        spark.conf.set(_CACHE_COALESCE_KEY, "true")
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    _KEPT.setdefault(spark.sparkContext.applicationId, []).append(kept)
    return kept


def keep(df: DataFrame) -> tuple[DataFrame, int]:
    """Persist ``df`` (memory, spilling to disk) and compute it now; returns the
    kept frame and its row count.  For small tables one step away from a
    checkpoint: a lost block is recomputed from that short lineage."""
    kept = persisted(df)
    return kept, kept.count()


def materialize(df: DataFrame, name: str, paths: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Used at stage boundaries of long pipelines on full-size tables: columnar,
    compressed, and later steps prune columns and push filters into the scan.
    The folder's name is added to ``paths``, so that its owner can delete it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    if paths is not None:
        paths.append(path)
    return df.sparkSession.read.parquet(path)


def delete_tables(spark: SparkSession, paths: list[str]) -> None:
    """Delete written stage tables that nothing reads any more."""
    while paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release_kept(spark: SparkSession) -> int:
    """Let go of every table that the library keeps in memory or on executors' disks; returns their number.

    Results that still read one compute it again.  Call it between jobs of a long-lived session."""
    kept = _KEPT.pop(spark.sparkContext.applicationId, [])
    for df in kept:
        df.unpersist()
    return len(kept)
