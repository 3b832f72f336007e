"""Checkpoint folder, scratch paths and kept tables."""

from pyspark.sql import functions as F

from shroud import session


def test_scratch_under_checkpoint_dir(spark):
    base = session.checkpoint_dir(spark)
    assert base and spark.sparkContext.getCheckpointDir() == base
    path = session.scratch_path(spark, "t")
    assert path.startswith(base.rstrip("/") + "/shroud-t-")


def test_cut_lineage_and_materialize_keep_rows(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k")).groupBy("k").count()
    a = session.cut_lineage(df)
    b = session.materialize(df, "t")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect())) == sorted(map(tuple, df.collect()))


def test_persisted_lets_aqe_coalesce(spark):
    kept, n = session.keep(spark.range(10).groupBy((F.col("id") % 2).alias("k")).count())
    assert n == 2
    assert spark.conf.get("spark.sql.optimizer.canChangeCachedPlanOutputPartitioning") == "true"
    kept.unpersist()
