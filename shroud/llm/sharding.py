"""Sharding by jump consistent hashing.

A row's shard depends on its key and the number of shards alone.  With one
more shard, a row stays where it is or moves into the new shard, and only the
necessary fraction moves.  There is no ring table; the jumps are computed in
numpy for a batch of keys at a time.

Slots number the rows of a shard from 0 without gaps.  The narrow columns are
written once with the input partition (run) of each row; a slot is the number
of the shard's rows in earlier runs plus the row's place among the shard's
rows of its own run.  So no shard is ever sorted as a whole: the windows hold
one input partition's rows, or one count for each run.

A NULL key goes to shard 0 for any number of shards.  NULL texts have size 1
and CRC-32 0.  Repeated rows get slots of their own; an empty table gives no
rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shroud.llm.common import drop_stage, whole_text, write_stage

# Fixed value: the multiplier of the published jump consistent hash.
JUMP_MULTIPLIER = np.uint64(2862933555777941757)


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard (0 to shards - 1) of each unsigned 64-bit key."""
    if shards < 1:
        raise ValueError("there must be a shard")
    state = keys.astype(np.uint64)
    shard = np.full(len(state), -1, np.int64)
    reach = np.zeros(len(state), np.int64)
    active = np.arange(len(state))
    while len(active):
        shard[active] = reach[active]
        with np.errstate(over="ignore"):
            state[active] = state[active] * JUMP_MULTIPLIER + np.uint64(1)
        step = float(1 << 31) / ((state[active] >> np.uint64(33)).astype(np.float64) + 1.0)
        reach[active] = ((shard[active] + 1) * step).astype(np.int64)
        active = active[reach[active] < shards]
    return shard


def shard_rows(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot, grown_shard) for each row.

    ``size`` is the UTF-8 bytes of the text plus 1; ``grown_shard`` the shard
    if there were one more."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"),
        F.when(F.col(id_col).isNotNull(), F.xxhash64(F.col(id_col).cast("string"))).alias("hash"),
        (F.octet_length(whole_text(text_col)) + 1).cast("long").alias("size"),
        F.crc32(whole_text(text_col).cast("binary")).alias("text_crc32"))

    def place(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            hashed = part.column("hash")
            keys = hashed.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64)
            known = ~hashed.is_null().to_numpy(zero_copy_only=False)
            columns = [part.column(i) for i, f in enumerate(part.schema) if f.name != "hash"]
            names = [f.name for f in part.schema if f.name != "hash"]
            for n, name in ((shards, "shard"), (shards + 1, "grown_shard")):
                columns.append(pa.array(np.where(known, jump_hash(keys, n), 0).astype(np.int32)))
                names.append(name)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = dict(rows.dtypes)["doc_id"]
    placed = rows.mapInArrow(
        place, f"doc_id {kind}, row bigint, size bigint, text_crc32 bigint, shard int, grown_shard int")
    placed, _ = write_stage(placed.withColumn("run", F.shiftright("row", 33)), "shard-rows")
    counts, counts_path = write_stage(
        placed.groupBy("shard", "run").agg(F.count(F.lit(1)).alias("n")), "shard-counts")
    earlier = Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    offsets, _ = write_stage(
        counts.select("shard", "run", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset")),
        "shard-offsets")
    drop_stage(docs.sparkSession, counts_path)
    within = Window.partitionBy("shard", "run").orderBy("row")
    numbered = placed.withColumn("place", F.row_number().over(within) - 1)
    return numbered.join(offsets, ["shard", "run"]).select(
        "doc_id", "size", "text_crc32", "shard",
        (F.col("offset") + F.col("place")).cast("long").alias("slot"), "grown_shard")
