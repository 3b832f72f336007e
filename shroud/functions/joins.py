"""Joining a group statistic back to the rows, broadcasting only checked sizes.

A group statistic (group size, distinct count, bin mean, ...) is computed with
``groupBy().agg()`` (map-side partial aggregation absorbs hot keys) and joined
back to the rows.  The statistic table is broadcast only when its size is
proven small: bounded by construction, or measured on the table (computed
once, kept, counted).  Beyond the bound the join shuffles; a key with more than
``TASK_ROWS`` rows is split by its own size: the key gets one salt for every
``TASK_ROWS`` rows, its statistic is copied to each salt, and its rows, exact
copies included, are spread over them.  The salts per key are broadcast as
(64-bit key hash, salts), of which there are at most ``MAX_HOT_KEYS`` by
construction.  A window over the group key would
instead put a whole hot group into one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shroud.session import persisted

# Default bounds for broadcasting a small side: rows, and bytes measured on
# the table.  The table is built on the driver and sent to every executor, so
# it must stay far below driver and executor memory.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 256 * 1024 * 1024
# Rows of one key that a task should get; a key with more is split.
TASK_ROWS = 1_000_000
# Split keys (16 bytes each in the broadcast).  At most total / TASK_ROWS keys
# can have more than TASK_ROWS rows, so this binds beyond 2 * 10^12 rows only.
MAX_HOT_KEYS = 2_000_000


def _row_bytes(schema: T.StructType) -> F.Column:
    """In-memory width of a row: the actual bytes of its texts and nested values."""
    size = F.lit(16)
    for f in schema.fields:
        t, c = f.dataType, F.col(f"`{f.name}`")
        if isinstance(t, (T.StringType, T.BinaryType)):
            size = size + 16 + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(t, (T.ArrayType, T.MapType, T.StructType)):
            size = size + 32 + 4 * F.coalesce(F.length(F.to_json(F.struct(c))), F.lit(0))
        else:
            size = size + 8
    return size.cast("long")


def measured(small: DataFrame, max_rows: int | None = None, known_max_rows: int | None = None) -> tuple[DataFrame, bool]:
    """(table, fits): ``fits`` when the row count is proven within the bounds."""
    max_rows = BROADCAST_MAX_ROWS if max_rows is None else max_rows
    if known_max_rows is not None and known_max_rows <= max_rows:
        return small, True
    kept, _, fits = sized(small, max_rows)
    return kept, fits


def sized(small: DataFrame, max_rows: int | None = None) -> tuple[DataFrame, int, bool]:
    """(kept table, its rows, whether rows and bytes are within the bounds), from one pass."""
    kept = persisted(small)
    rows, size = kept.agg(F.count(F.lit(1)), F.sum(_row_bytes(small.schema))).first()
    return kept, rows, rows <= (BROADCAST_MAX_ROWS if max_rows is None else max_rows) and (
        size or 0) <= BROADCAST_MAX_BYTES


def sized_broadcast(small: DataFrame, max_rows: int | None = None,
                    known_max_rows: int | None = None) -> DataFrame:
    """Return ``small`` marked for broadcast if its size is proven small.

    ``known_max_rows`` is a bound proven by construction (a fixed map, a domain
    such as the course list).  Otherwise the table is computed once, kept
    (memory, spilling to disk; lost blocks are recomputed from lineage) and
    counted; the join then reads the kept table.  Beyond the bound the join
    shuffles and still reads the kept table, so the statistic is never
    computed twice.
    """
    table, fits = measured(small, max_rows, known_max_rows)
    return F.broadcast(table) if fits else table


def _null_safe(left: DataFrame, right: DataFrame, pairs) -> F.Column:
    cond = None
    for a, b in pairs:
        term = left[a].eqNullSafe(right[b])
        cond = term if cond is None else cond & term
    return cond


def attach(df: DataFrame, stats: DataFrame, keys: Sequence[str], how: str = "left",
           max_rows: int | None = None, known_max_rows: int | None = None,
           rows_col: str | None = None) -> DataFrame:
    """Join a per-group statistic back to the rows on ``keys`` (NULL-safe).

    ``rows_col`` names the statistic's count of rows per group (not part of
    the output); it drives the hot-key split when the statistic is too large
    to broadcast.  Without it (a lookup table), the rows per key are counted
    on the data side in that case."""
    keys = list(keys)
    # a statistic that the rows already carry is replaced
    df = df.drop(*[c for c in stats.columns if c in df.columns and c not in keys and c != rows_col])
    renamed = {k: f"__k_{i}" for i, k in enumerate(keys)}
    if rows_col is not None:
        renamed[rows_col] = "__attach_rows"
    side = stats.select([F.col(c).alias(renamed.get(c, c)) for c in stats.columns])
    values = [c for c in stats.columns if c not in renamed]
    rows_col = renamed.get(rows_col) if rows_col is not None else None
    side, fits = measured(side, max_rows, known_max_rows)
    pairs = [(k, renamed[k]) for k in keys]
    if fits or how != "left":
        side = F.broadcast(side) if fits else side
        out = df.join(side, _null_safe(df, side, pairs), how)
        return out.drop(*renamed.values())
    if rows_col is None:
        # a large lookup table without row counts: count the rows per key on
        # the data side (one aggregation of the key columns, combined map-side)
        rows_col = "__attach_rows"
        per_key = df.groupBy(*[F.col(k).alias(renamed[k]) for k in keys]).agg(
            F.count(F.lit(1)).alias(rows_col))
        side = side.join(per_key, [renamed[k] for k in keys], "left").fillna(0, subset=[rows_col])
        side = persisted(side)
    total = side.agg(F.sum(rows_col)).first()[0] or 0
    threshold = max(TASK_ROWS, math.ceil(total / MAX_HOT_KEYS))
    side_hash = F.xxhash64(*[F.col(renamed[k]) for k in keys])
    hot = (side.filter(F.col(rows_col) > threshold).groupBy(side_hash.alias("__hot_key"))
           .agg(F.ceil(F.max(rows_col) / TASK_ROWS).cast("int").alias("__salts")))
    hot = F.broadcast(hot)  # at most total / threshold <= MAX_HOT_KEYS rows
    types = {f.name: f.dataType for f in side.schema.fields}
    row_hash = F.xxhash64(*[F.col(k).cast(types[renamed[k]]) for k in keys])
    # content hash plus input partition: exact copies of a row are spread too
    spread = F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in df.columns])
    salted = df.withColumn("__row_hash", row_hash).join(hot, F.col("__row_hash") == F.col("__hot_key"), "left")
    salted = salted.withColumn("__salt", F.coalesce(F.pmod(spread, F.col("__salts")), F.lit(0)).cast("int"))
    salted = salted.select(*df.columns, "__salt")
    # every salt of a key meets one copy of its statistic: results don't depend on the salt
    copies = side.withColumn("__side_hash", side_hash).join(hot, F.col("__side_hash") == F.col("__hot_key"), "left")
    copies = copies.select(*[renamed[k] for k in keys], *values, F.explode(
        F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1)).alias("__salt_r"))
    cond = _null_safe(salted, copies, pairs) & (salted["__salt"] == copies["__salt_r"])
    return salted.join(copies, cond, "left").select(*df.columns, *values)
