"""Helpers shared by the operators: stage tables, components, row selection.

Stage tables are written below the session's checkpoint folder (shared by all
executors), which cuts lineage: a lost executor costs a re-read, not a
recomputation.  Tables that an operator no longer needs are deleted at once;
those its (lazy) result still reads are listed until ``release`` is called.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shroud.session import scratch_path

_KEPT: dict[str, list[str]] = {}
# Spark's setting: a query's shuffle files go when it ends, not when the driver collects its garbage.
FILES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def write_stage(df: DataFrame, name: str, files_go: bool = False) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet in the shared folder and read it back.

    ``files_go``: the shuffle files of the write, which the table no longer needs, are deleted once it is written."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(FILES_GO, "false")
    spark.conf.set(FILES_GO, "true" if files_go else before)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(FILES_GO, before)
    _KEPT.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop_stage(spark: SparkSession, path: str) -> None:
    """Delete a stage table that nothing reads any more."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    kept = _KEPT.get(spark.sparkContext.applicationId, [])
    if path in kept:
        kept.remove(path)


def release(spark: SparkSession) -> int:
    """Delete every stage table written so far; call it once results are stored."""
    paths = list(_KEPT.get(spark.sparkContext.applicationId, []))
    for path in paths:
        drop_stage(spark, path)
    return len(paths)


def fresh(name: str, taken: Sequence[str]) -> str:
    """``name``, made different from every column in ``taken`` (any letter case)."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name = "_" + name
    return name


def whole_text(column: str | Column = "text") -> Column:
    """The text, NULL counting as empty."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(c.cast("string"), F.lit(""))


def id_remainder(column: str, modulus: int) -> Column:
    """``crc32(id as text) mod modulus``; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of an undirected graph: ``edges(a, b)`` -> ``(node, root)``.

    ``root`` is the smallest node of the component.  Every round points each
    node at the smallest of its neighbours and itself, flattens these pointers
    by doubling, and contracts the edges to the roots, so that the edge table
    shrinks quickly (a star is done after one round).  All steps are
    aggregations with map-side combine and equi-joins on written tables; a hub
    is combined before the shuffle or split by adaptive execution.  Nothing is
    collected but row counts.  An empty edge table gives an empty result.
    """
    spark = edges.sparkSession
    both = edges.filter("a <> b").select("a", "b")
    both = both.union(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    current, edge_path = write_stage(both, "cc-edges")
    mapping, mapping_path = None, None
    while current.limit(1).count():
        nearest = current.groupBy("a").agg(F.min("b").alias("b"))
        pointer, pointer_path = write_stage(
            nearest.select(F.col("a").alias("node"), F.least("a", "b").alias("root")), "cc-pointer")
        while True:
            up = pointer.select(F.col("node").alias("up"), F.col("root").alias("top"))
            jumped, jumped_path = write_stage(
                pointer.join(up, F.col("root") == F.col("up"))
                .select("node", F.col("top").alias("root"), (F.col("top") != F.col("root")).alias("moved")),
                "cc-jump")
            moved = jumped.filter("moved").limit(1).count()
            drop_stage(spark, pointer_path)
            pointer, pointer_path = jumped.drop("moved"), jumped_path
            if not moved:
                break
        left = pointer.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        right = pointer.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        smaller, smaller_path = write_stage(
            current.join(left, "a").join(right, "b").filter("ra <> rb")
            .select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "cc-edges")
        drop_stage(spark, edge_path)
        current, edge_path = smaller, smaller_path
        if mapping is None:
            mapping, mapping_path = pointer, pointer_path
        else:
            step = pointer.select(F.col("node").alias("up"), F.col("root").alias("top"))
            merged, merged_path = write_stage(
                mapping.join(step, F.col("root") == F.col("up"), "left")
                .select("node", F.coalesce("top", "root").alias("root")), "cc-mapping")
            drop_stage(spark, mapping_path)
            drop_stage(spark, pointer_path)
            mapping, mapping_path = merged, merged_path
    if mapping is None:
        return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    drop_stage(spark, edge_path)
    return mapping


def row_key(id_col: str, text_col: str) -> Column:
    """One key per (id, text) pair, NULLs included."""
    parts = F.concat_ws("\x1f", F.when(F.col(id_col).isNull(), "n").otherwise("v"),
                        F.coalesce(F.col(id_col).cast("string"), F.lit("")), whole_text(text_col))
    return F.sha2(parts.cast("binary"), 256)


def keep_rows(docs: DataFrame, kept: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` whose ``row_key`` is in ``kept(key, n_rows)``, one for each key.

    ``n_rows`` is how many rows of ``docs`` have the key.  Rows that are alone
    with their key pass through a semi-join; exact repeats of a row (same id
    and text) are reduced by an aggregation that combines before the shuffle,
    so that a row repeated very often doesn't meet in one task.
    """
    columns = docs.columns
    key = fresh("row_key", columns)
    keyed = docs.withColumn(key, row_key(id_col, text_col))
    alone = kept.filter("n_rows = 1").select(F.col("key").alias(key))
    many = kept.filter("n_rows > 1").select(F.col("key").alias(key))
    whole = F.struct(*[F.col(f"`{c}`") for c in columns])
    one = (keyed.join(many, key, "left_semi").groupBy(key).agg(F.first(whole).alias("row"))
           .select(*[F.col("row").getField(c).alias(c) for c in columns]))
    return keyed.join(alone, key, "left_semi").select(*columns).unionByName(one)
