"""Pseudonyms.

I2 numbers the distinct ids in the order of a salted SHA-256 without a
single-partition sort.  The hash is uniform and the ids are distinct, so its
first hex digits split the ids into evenly sized buckets (no hot bucket):
``row_number()`` over each bucket ordered by hash gives the position inside
the bucket, and the bucket sizes (one number per bucket, at most
16**prefix_digits, collected) give each bucket's offset.  Every step is
deterministic, so a recomputed partition after executor loss gets the same
numbers.
"""

from __future__ import annotations

import secrets

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shroud.functions.joins import attach
from shroud.session import persisted

PREFIX_DIGITS = 4  # 65,536 buckets


def salted_hash(df: DataFrame, column: str, salt: str, out: str | None = None,
                bits: int = 256) -> DataFrame:
    """Hex SHA-2 of ``salt || value`` (NULL stays NULL)."""
    return df.withColumn(out or f"{column}_hash",
                         F.sha2(F.concat(F.lit(salt), F.col(column).cast("string")), bits))


def pseudonym_table(df: DataFrame, column: str, prefix: str, salt: str | None = None,
                    out: str = "userid_DI", prefix_digits: int = PREFIX_DIGITS,
                    keep_rows: bool = False) -> DataFrame:
    """Distinct non-NULL ids -> ``prefix`` + zero-padded rank in salted-hash order.

    Width is the number of digits of ``10 * n_distinct``, where a NULL id
    counts as one distinct value (it gets no pseudonym)."""
    salt = secrets.token_hex(16) if salt is None else salt
    # the NULL id is a group here (it counts for the width) but gets no number
    ids = persisted(df.select(F.col(column).cast("string").alias("__id"))
                    .groupBy("__id").agg(F.count(F.lit(1)).alias("__rows"))
                    .withColumn("__h", F.sha2(F.concat(F.lit(salt), F.col("__id")), 256))
                    .withColumn("__b", F.substring("__h", 1, prefix_digits)))
    counted = ids.groupBy("__b").agg(F.count(F.lit(1)).alias("n")).collect()
    has_null = any(r["__b"] is None for r in counted)
    sizes = sorted((r["__b"], r["n"]) for r in counted if r["__b"] is not None)
    offsets, running = [], 0
    for bucket, n in sizes:
        offsets.append((bucket, running))
        running += n
    width = len(str(10 * (running + int(has_null))))
    ids = ids.filter(F.col("__id").isNotNull())
    side = df.sparkSession.createDataFrame(offsets, "__b string, __off bigint")
    ranked = attach(ids, side, ["__b"], known_max_rows=len(offsets))
    pos = F.row_number().over(Window.partitionBy("__b").orderBy("__h", "__id"))
    rank = F.col("__off") + pos
    return ranked.select(
        F.col("__id").alias(column),
        F.concat(F.lit(prefix), F.lpad(rank.cast("string"), width, "0")).alias(out),
        *(["__rows"] if keep_rows else []))


def pseudonymize(df: DataFrame, column: str, prefix: str, salt: str | None = None,
                 out: str = "userid_DI") -> DataFrame:
    """Add the pseudonym column: same id, same pseudonym; NULL id -> NULL."""
    table = pseudonym_table(df, column, prefix, salt, out, keep_rows=True)
    keyed = df.withColumn("__id", F.col(column).cast("string"))
    side = table.select(F.col(column).alias("__id"), F.col(out).alias("__pseudo"), "__rows")
    joined = attach(keyed, side, ["__id"], rows_col="__rows")
    return joined.withColumn(out, F.col("__pseudo")).drop("__id", "__pseudo")
