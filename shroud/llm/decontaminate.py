"""Benchmark decontamination by size-partitioned MinHash containment search.

Words are runs of letters and digits of the lower-cased text (every character
outside ASCII counts as a letter).  A document contains a benchmark item if at
least ``containment`` (0.8) of the item's distinct five-word shingles are among
the document's.

Containment of a short item in a long document says nothing about their
Jaccard similarity, so sizes are partitioned: items go to classes by their
number of shingles (bounds grow by the square root of 2), and for a class of
items with up to s shingles each document is cut into blocks of s shingles.
Two neighbouring blocks form a window; a passage of up to s shingles lies
within one.  In a window of 2s shingles, an item of its class with containment
0.8 has a Jaccard similarity of at least 0.8 * 0.707 / (2 + 0.2 * 0.707) =
0.26, so one of ``MINHASHES`` = 32 minima agrees with a probability of over
0.9999 (of 0.999998 for a whole passage).  A minimum is taken once for a block
and shared by its two windows.  Every pair that agrees in a minimum is
verified on the shingles themselves (strings, not hashes) over the whole
document, so nothing is reported wrongly; passages torn apart over more than
a window can be missed.

Items are few: a block of distinct ones (``ITEM_BLOCK_BYTES`` of texts and ids at
most, measured) travels with the task.  A larger benchmark is searched block by block over
all documents.  Documents are read once for each block and never shuffled.

Items without five words, NULL among them, match nothing; NULL or empty
documents contain nothing.  Repeated items are all reported.  Repeated
documents give repeated rows; an empty table gives none.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shroud.functions.joins import attach
from shroud.llm.buffers import Substrings, mix, powers, slices, utf8, word_spans
from shroud.llm.common import drop_stage, fresh, whole_text, write_stage

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
MINHASHES = 32
ITEM_BLOCK_BYTES = 16_000_000
ITEM_IDS = 500  # ids of one text that stay together
SLICE_BYTES = 1_500_000
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_IS_WORD = np.zeros(256, bool)
_IS_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
# Odd multipliers, one for each minimum.
_MULTIPLIERS = mix(np.arange(1, MINHASHES + 1, dtype=np.uint64)) | np.uint64(1)


def shingles(text: str | None, words: int = SHINGLE_WORDS) -> set[bytes]:
    """The distinct shingles of a text."""
    found = _WORD.findall((text or "").lower().encode("utf-8", "surrogatepass"))
    return {b" ".join(found[i:i + words]) for i in range(len(found) - words + 1)}


def shingle_hashes(lowered: list[str], words: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): 64-bit hashes of each text's shingles in order."""
    data, offsets = utf8(pa.array(lowered, pa.large_string()))
    starts, ends = word_spans(_IS_WORD[data], offsets)
    word_hash = Substrings(data).hashes(starts, ends)
    first = np.searchsorted(starts, offsets)  # of each text's words
    count = np.diff(first)
    n = len(word_hash) - words + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.zeros(len(lowered) + 1, np.int64)
    factor = powers(words)
    with np.errstate(over="ignore"):
        total = np.zeros(n, np.uint64)
        for j in range(words):
            total += word_hash[j:j + n] * factor[j]
    total = mix(total)
    row = np.repeat(np.arange(len(lowered)), count)
    within = row[:n] == row[words - 1:]  # the first and last word are of one text
    kept = np.maximum(count - words + 1, 0)
    return total[within], np.r_[0, np.cumsum(kept)]


class ItemIndex:
    """The signatures of one block of benchmark items, by size class."""

    def __init__(self, items: list[tuple[int, str]], words: int, containment: float):
        self.words, self.containment = words, containment
        self.ids = [i for i, _ in items]
        self.sets = [shingles(t, words) for _, t in items]
        hashes, offsets = shingle_hashes([(t or "").lower() for _, t in items], words)
        by_class: dict[int, list[int]] = {}
        for at, s in enumerate(self.sets):
            if s:
                step = math.ceil(2 * math.log2(len(s)) - 1e-9)  # bounds 2^(step / 2)
                by_class.setdefault(math.floor(2 ** (step / 2) + 1e-9), []).append(at)
        self.classes = []
        for bound, members in sorted(by_class.items()):
            keys = []
            for a in _MULTIPLIERS:
                with np.errstate(over="ignore"):
                    low = np.array([(hashes[offsets[i]:offsets[i + 1]] * a).min() for i in members], np.uint64)
                order = np.argsort(low, kind="stable")
                seen = np.zeros(1 << 16, bool)
                seen[(low >> np.uint64(8) & np.uint64(0xFFFF)).astype(np.int64)] = True
                keys.append((low[order], np.array(members)[order], seen))
            self.classes.append((bound, keys))

    def candidates(self, hashes: np.ndarray, offsets: np.ndarray) -> set[tuple[int, int]]:
        """(text, item) pairs that agree in a minimum of some window."""
        found: set[tuple[int, int]] = set()
        n = len(hashes)
        if not n:
            return found
        size = np.diff(offsets)
        for bound, keys in self.classes:
            blocks = -(-size // bound)
            block_row = np.repeat(np.arange(len(size)), blocks)
            block_no = np.arange(len(block_row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
            starts = offsets[:-1][block_row] + block_no * bound
            joined = np.flatnonzero(block_row[1:] == block_row[:-1])
            for a, (low, members, seen) in zip(_MULTIPLIERS, keys, strict=True):
                with np.errstate(over="ignore"):
                    least = np.minimum.reduceat(hashes * a, starts)
                window = least.copy()
                window[joined] = np.minimum(least[joined], least[joined + 1])
                maybe = np.flatnonzero(seen[(window >> np.uint64(8) & np.uint64(0xFFFF)).astype(np.int64)])
                left = np.searchsorted(low, window[maybe], "left")
                right = np.searchsorted(low, window[maybe], "right")
                for at in np.flatnonzero(right > left).tolist():
                    row = int(block_row[maybe[at]])
                    found.update((row, int(i)) for i in members[left[at]:right[at]])
        return found

    def search(self, texts: list[str | None]) -> list[list[tuple[int, float]]]:
        """The items that each text contains, with their containment, verified."""
        lowered = [(t or "").lower() for t in texts]
        hashes, offsets = shingle_hashes(lowered, self.words)
        hits: list[list[tuple[int, float]]] = [[] for _ in texts]
        sets: dict[int, set[bytes]] = {}
        for row, item in sorted(self.candidates(hashes, offsets)):
            if row not in sets:
                sets = {row: shingles(lowered[row], self.words)}  # one text's shingles at a time
            share = len(self.sets[item] & sets[row]) / len(self.sets[item])
            if share >= self.containment:
                hits[row].append((self.ids[item], share))
        return hits


def _item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[list[tuple[int, int]], str]]]:
    """Blocks of (ids with their repeats, text), of ``ITEM_BLOCK_BYTES`` at most (a larger item alone).

    Equal texts are one item; one with very many ids is split into parts of about ``ITEM_IDS``."""
    rows = items.select(F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("text"))
    ids = rows.groupBy("id", "text").agg(F.count(F.lit(1)).alias("times"))
    often = ids.groupBy("text").agg(F.count(F.lit(1)).alias("n"), F.count(F.lit(1)).alias("rows"))
    part = F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / ITEM_IDS))
    entries, path = write_stage(
        attach(ids, often, ["text"], rows_col="rows").groupBy("text", part.alias("part"))
        .agg(F.collect_list(F.struct("id", "times")).alias("ids"))
        .withColumn("bytes", F.octet_length("text") + 64 + 32 * F.size("ids")), "decontaminate-items")
    total = entries.agg(F.sum("bytes")).first()[0] or 0
    blocks = max(1, math.ceil(2 * total / ITEM_BLOCK_BYTES))  # half full on average
    while True:
        block = F.pmod(F.xxhash64("text", "part"), F.lit(blocks))
        sizes = entries.groupBy(block.alias("block")).agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n"))
        if not sizes.filter((F.col("bytes") > ITEM_BLOCK_BYTES) & (F.col("n") > 1)).limit(1).count():
            break
        blocks *= 2
    for b in range(blocks):
        found = entries.filter(block == b).orderBy("text", "part").collect()
        yield [([(i.id, i.times) for i in r.ids], r.text) for r in found]
    drop_stage(items.sparkSession, path)


def with_contained_items(docs: DataFrame, items: DataFrame, hits_name: str, text_col: str = "text",
                         item_id_col: str = "item_id", item_text_col: str = "text",
                         words: int = SHINGLE_WORDS, containment: float = CONTAINMENT) -> DataFrame:
    """``docs`` with an array of (item_id, containment) of the items that each text contains."""
    hit = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()),
                                    T.StructField("containment", T.DoubleType())]))
    out = docs.withColumn(hits_name, F.array().cast(hit))
    for block in _item_blocks(items, item_id_col, item_text_col):
        if not block:
            continue

        def batches(parts: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            index = ItemIndex([(at, text) for at, (_, text) in enumerate(block)], words, containment)
            for part in parts:
                at = part.schema.get_field_index(hits_name)
                kind = part.schema.field(at).type
                schema = part.schema.set(at, pa.field(hits_name, kind))  # the same for every batch
                for some in slices(part, text_col, SLICE_BYTES):
                    found = index.search(some.column(text_col).to_pylist())
                    columns = list(some.columns)
                    if any(found):
                        lists = [b + [{"item_id": i, "containment": c} for at_item, c in f
                                      for i, times in block[at_item][0] for _ in range(times)]
                                 for b, f in zip(columns[at].to_pylist(), found, strict=True)]
                        columns[at] = pa.array(lists, kind)
                    yield pa.RecordBatch.from_arrays(columns, schema=schema)

        out = out.mapInArrow(batches, out.schema)
    return out


def contaminated_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                           text_col: str = "text", **options) -> DataFrame:
    """One row for each document: (doc_id, contaminated, n_items, item_ids, containment)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    hits = with_contained_items(rows, items, "hits", **options)
    return hits.select("doc_id", (F.size("hits") > 0).alias("contaminated"),
                       F.size("hits").cast("long").alias("n_items"),
                       F.array_sort(F.col("hits.item_id")).alias("item_ids"),
                       F.coalesce(F.array_max("hits.containment"), F.lit(0.0)).alias("containment"))


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that contain a benchmark item; all columns stay as they are."""
    name = fresh("contained_items", docs.columns)
    marked = with_contained_items(docs, items, name, text_col=text_col, **options)
    return marked.filter(F.size(name) == 0).drop(name)
