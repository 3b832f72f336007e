"""Exact dedup by a tree merge of sorted digest runs (DataFrame functions only).

Every input partition becomes a run: its rows' digests, sorted, written once.
The runs are merged in rounds like a binomial tree; ``FAN_IN`` = 2^5 runs meet
in a multiway merge, so that one round does the work of five pairwise rounds.
A level keeps, for each digest of its group of runs, the winning document and
the count; the verdict then travels back down the same tree.  Going up, a
digest has one row in each run at most; going down, a verdict has ``FAN_IN``
readers at most, and a run is one input partition.  So a text that a third of
all rows share never gathers in a task.

A group is verified at every level: rows merge only if SHA-256, byte length
and an independent 64-bit hash of the normalised text all agree.

Which document stays: the one with the largest (or smallest) id; a NULL id
loses against any other; of rows that tie, the first of the input's order
counts as the larger or smaller one in the same way, so that exactly one row
of a group stays.  NULL texts count as empty; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shroud.llm.common import drop_stage, keep_rows, row_key, whole_text, write_stage

FAN_IN = 32
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_DIGEST = ["text_sha256", "n_bytes", "check"]


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def digest_runs(docs: DataFrame, id_col: str, text_col: str, keyed: bool) -> tuple[DataFrame, str]:
    """(doc_id, row, run, key, digest columns), written as one sorted run for each partition."""
    place = F.monotonically_increasing_id()
    key = row_key(id_col, text_col) if keyed else F.lit(None).cast("string")
    rows = docs.select(F.col(id_col).alias("doc_id"), place.alias("row"),
                       lower_ascii(whole_text(text_col)).alias("norm"), key.alias("key"))
    rows = rows.select("doc_id", "row", F.shiftright("row", 33).alias("run"), "key",
                       F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
                       F.octet_length("norm").cast("long").alias("n_bytes"),
                       F.xxhash64("norm").alias("check"))
    return write_stage(rows.sortWithinPartitions("text_sha256"), "dedup-runs")


def dedup_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 keep: str = "largest", keyed: bool = False) -> DataFrame:
    """One row for each document: (doc_id, row, key, keep_id, group_size, kept, text_sha256).

    ``key`` is the document's ``row_key`` if ``keyed``, else NULL."""
    spark = docs.sparkSession
    best_of = {"largest": F.max, "smallest": F.min}[keep]
    runs, _ = digest_runs(docs, id_col, text_col, keyed)
    # a NULL id loses: it is last in either order
    rank = F.col("doc_id").isNotNull() if keep == "largest" else F.col("doc_id").isNull()
    best = F.struct(rank.alias("rank"), F.col("doc_id"), F.col("row"))
    level = runs.groupBy("run", *_DIGEST).agg(best_of(best).alias("best"), F.count(F.lit(1)).alias("n"))
    levels = [write_stage(level, "dedup-level")]
    last = runs.agg(F.max("run")).first()[0] or 0
    while last > 0:  # merge FAN_IN neighbouring runs into one
        below = levels[-1][0]
        parent = F.floor(F.col("run") / F.lit(FAN_IN)).cast("long").alias("run")
        merged = below.groupBy(parent, *_DIGEST).agg(best_of("best").alias("best"), F.sum("n").alias("n"))
        levels.append(write_stage(merged, "dedup-level"))
        last //= FAN_IN
    verdict, verdict_path = levels.pop()
    while levels:  # and hand the verdicts back
        below, below_path = levels.pop()
        up = verdict.withColumnRenamed("run", "parent")
        child = below.select("run", *_DIGEST, F.floor(F.col("run") / F.lit(FAN_IN)).cast("long").alias("parent"))
        joined, joined_path = write_stage(
            child.join(up, ["parent", *_DIGEST]).drop("parent"), "dedup-verdict")
        drop_stage(spark, below_path)
        drop_stage(spark, verdict_path)
        verdict, verdict_path = joined, joined_path
    out = runs.join(verdict, ["run", *_DIGEST])
    return out.select("doc_id", "row", "key", F.col("best.doc_id").alias("keep_id"),
                      F.col("n").cast("long").alias("group_size"),
                      (F.col("row") == F.col("best.row")).alias("kept"), "text_sha256")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                keep: str = "largest") -> DataFrame:
    """``docs`` with one row for each distinct normalised text; all columns stay as they are."""
    groups = dedup_groups(docs, id_col, text_col, keep, keyed=True)
    per_key = groups.groupBy("key").agg(F.count(F.lit(1)).alias("n_rows"),
                                        F.max("kept").alias("kept"))
    return keep_rows(docs, per_key.filter("kept").select("key", "n_rows"), id_col, text_col)
