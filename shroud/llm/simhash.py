"""SimHash near-dedup with pigeonring filtering.

Fingerprints: A-Z is lower-cased, words are runs of anything but ASCII white
space, and every 4-word shingle (repeats included, joined by one space; the
whole sequence if there are fewer words) is hashed with XXH64, seed 42.  A bit
of the 64-bit fingerprint is 1 if it is set in over half of the hashes.  Texts
without words, NULL among them, have fingerprint zero and link like any other.

Linking: fingerprints at most ``max_bits`` bits apart are linked; documents in
one connected component form a group, named after its smallest id.

Pigeonring: the 64 bits are cut into a ring of m segments.  If two
fingerprints differ in at most t bits, there is a segment from which every
chain of l consecutive segments has at most l*t/m differing bits in total
(l = 1..m).  A chain of l segments then holds at least l - floor(l*t/m)
segments without any difference; ``chain_patterns`` lists which sets of m - t
segments such a chain forces to be equal, and each set is an exact-match key.
A pair that meets under a key must pass the chain test (some start whose
every chain keeps its proportional budget) before its full Hamming distance
is taken.  The result is exact: no link is missed, none is false.

Scale: equal fingerprints are collapsed before anything else.  m is taken from
the number of distinct fingerprints, so that a key brings together about one
unrelated fingerprint or fewer; it changes the cost, never the result.  Rows
of a key are streamed in sorted order; a bucket only emits a spanning forest
of its links (breadth-first, each found fingerprint leaves the bucket's rest),
never its pairs.  A bucket of more than ``BUCKET_ROWS`` fingerprints isn't
held in memory: its members are linked exactly through the points half the
distance away (two fingerprints are at most t apart if and only if they share
a point at most t/2 from each, t even), an aggregation whose cost is linear.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shroud.llm.common import (
    connected_components, drop_stage, keep_rows, row_key, whole_text, write_stage,
)

SHINGLE_WORDS = 4
MAX_BITS = 4
BUCKET_ROWS = 32_768
_SEED = 42


def fingerprint(data: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """The unsigned 64-bit fingerprint of one UTF-8 text."""
    words = data.lower().split()  # bytes: only ASCII letters and ASCII white space count
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle_words:
        return xxhash.xxh64_intdigest(joined, _SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    n = len(words) - shingle_words + 1
    shingles = [joined[a:b] for a, b in zip(starts[:n].tolist(), ends[shingle_words - 1:].tolist(), strict=True)]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(_SEED)), "<u8", n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 65_536):  # the unpacked bits of a very long text stay small
        block = hashes[at:at + 65_536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle_words: int,
                 keyed: bool) -> DataFrame:
    """(doc_id, key, fp): the fingerprint of each document as a signed long."""
    key = row_key(id_col, text_col) if keyed else F.lit(None).cast("string")
    rows = docs.select(F.col(id_col).alias("doc_id"), key.alias("key"), whole_text(text_col).alias("text"))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = part.column("text").cast(pa.binary())
            fps = np.fromiter((fingerprint(t.as_py(), shingle_words) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("key"), pa.array(fps.view(np.int64))],
                names=["doc_id", "key", "fp"])

    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(batches, f"doc_id {kind}, key string, fp bigint")


def segments_of(m: int) -> list[tuple[int, int]]:
    """(first bit, bits) of each of m nearly equal segments of 64 bits."""
    cuts = [64 * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def chain_patterns(m: int, max_bits: int) -> list[tuple[int, ...]]:
    """The sets of m - max_bits segments that a chain within its budgets forces to be equal."""
    need = [length - length * max_bits // m for length in range(1, m + 1)]
    found = set()
    for start in range(m):
        for rest in combinations(range(1, m), m - max_bits - 1):
            places = (0, *rest)
            if all(sum(p < length for p in places) >= min(need[length - 1], len(places))
                   for length in range(1, m + 1)):
                found.add(tuple(sorted((start + p) % m for p in places)))
    return sorted(found)


def segment_count(distinct: int, max_bits: int) -> int:
    """Segments so that a fingerprint meets about one unrelated one, over all keys."""
    for m in range(max_bits + 2, 3 * max_bits + 2):
        bits = 64 * (m - max_bits) / m
        if distinct * len(chain_patterns(m, max_bits)) <= 2 ** (bits + 1):
            return m
    return 3 * max_bits + 1


def _chain_test(diff: np.ndarray, m: int, max_bits: int) -> np.ndarray:
    """Whether some start keeps every chain of up to m - 1 segments within its budget."""
    bits = np.stack([np.bitwise_count((diff >> np.uint64(a)) & np.uint64((1 << w) - 1))
                     for a, w in segments_of(m)]).astype(np.int16)
    passed = np.zeros(len(diff), bool)
    for start in range(m):
        total = np.zeros(len(diff), np.int16)
        within = np.ones(len(diff), bool)
        for length in range(1, m):
            total += bits[(start + length - 1) % m]
            within &= total * m <= length * max_bits
        passed |= within
    return passed


def _near(one: np.ndarray, other: np.ndarray, m: int, max_bits: int) -> np.ndarray:
    """Indices at which ``one ^ other`` passes the chain test and then the Hamming check."""
    diff = one ^ other
    at = np.flatnonzero(_chain_test(diff, m, max_bits))
    return at[np.bitwise_count(diff[at]) <= max_bits]


def _forest(fps: np.ndarray, m: int, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among distinct fingerprints of one bucket."""
    rest, found = fps, ([], [])
    while len(rest) > 1:
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            point = frontier.pop()
            hit = _near(np.full(len(rest), point), rest, m, max_bits)
            if len(hit):
                found[0].append(np.full(len(hit), point))
                found[1].append(rest[hit])
                frontier.extend(rest[hit])
                rest = np.delete(rest, hit)
    if not found[0]:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return np.concatenate(found[0]), np.concatenate(found[1])


def _links_of_sorted(keys: np.ndarray, fps: np.ndarray, m: int, max_bits: int):
    """Links within whole buckets (equal neighbouring keys)."""
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    size = np.diff(np.r_[first, len(keys)])
    a, b = [], []
    two = first[size == 2]  # nearly all shared buckets: one vector step
    hit = _near(fps[two], fps[two + 1], m, max_bits)
    a.append(fps[two[hit]])
    b.append(fps[two[hit] + 1])
    for at, n in zip(first[size > 2].tolist(), size[size > 2].tolist(), strict=True):
        x, y = _forest(fps[at:at + n], m, max_bits)
        a.append(x)
        b.append(y)
    return np.concatenate(a), np.concatenate(b)


def _bucket_links(m: int, max_bits: int, bucket_rows: int):
    """mapInArrow over rows sorted by key: links (a, b), and members of over-full buckets (a, NULL)."""

    def out(a: np.ndarray, b: np.ndarray | None) -> pa.RecordBatch:
        right = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b.view(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), right], names=["a", "b"])

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps, full = np.empty(0, np.int64), np.empty(0, np.uint64), None
        for part in parts:
            k = part.column("key").to_numpy(zero_copy_only=False)
            f = part.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            if full is not None:  # the rest of a bucket that is being passed on
                same = k == full
                if same.any():
                    yield out(f[same], None)
                k, f = k[~same], f[~same]
                if not len(k):
                    continue
                full = None
            keys, fps = np.concatenate([keys, k]), np.concatenate([fps, f])
            if not len(keys):
                continue
            open_at = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            if open_at:
                a, b = _links_of_sorted(keys[:open_at], fps[:open_at], m, max_bits)
                if len(a):
                    yield out(a, b)
                keys, fps = keys[open_at:], fps[open_at:]
            if len(fps) > bucket_rows:
                full = keys[0]
                yield out(fps, None)
                keys, fps = keys[:0], fps[:0]
        if len(keys):
            a, b = _links_of_sorted(keys, fps, m, max_bits)
            if len(a):
                yield out(a, b)

    return batches


def _half_way_links(crowded: DataFrame, max_bits: int) -> DataFrame:
    """Links among ``crowded(fp)`` by their shared points at half the distance."""
    half = max_bits // 2
    masks = [0]
    for r in range(1, half + 1):
        for bits in combinations(range(64), r):
            masks.append(sum(1 << b for b in bits))
    signed = np.array(masks, np.uint64).view(np.int64)

    def points(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            f = part.column("fp").to_numpy(zero_copy_only=False)
            for at in range(0, len(f), 32):
                some = f[at:at + 32]
                yield pa.RecordBatch.from_arrays(
                    [pa.array((some[:, None] ^ signed[None, :]).ravel()),
                     pa.array(np.repeat(some, len(signed)))], names=["point", "fp"])

    spread = crowded.mapInArrow(points, "point bigint, fp bigint")
    nearest = spread.groupBy("point").agg(F.min("fp").alias("b"))
    return (spread.join(nearest, "point").filter("fp <> b")
            .select(F.col("fp").alias("a"), "b").distinct())


def fingerprint_links(distinct: DataFrame, max_bits: int = MAX_BITS,
                      bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links (a, b) that connect exactly the ``distinct(fp)`` at most ``max_bits`` apart."""
    if max_bits % 2:
        raise ValueError("max_bits must be even")
    spark = distinct.sparkSession
    m = segment_count(distinct.count(), max_bits)
    segments = segments_of(m)
    keys = []
    for number, chosen in enumerate(chain_patterns(m, max_bits)):
        mask = sum(((1 << w) - 1) << a for a, w in (segments[i] for i in chosen))
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.xxhash64(F.lit(number), F.col("fp").bitwiseAND(F.lit(signed))))
    keyed = distinct.select(F.explode(F.array(*keys)).alias("key"), "fp")
    sorted_rows = keyed.repartition(F.col("key")).sortWithinPartitions("key")
    found, found_path = write_stage(
        sorted_rows.mapInArrow(_bucket_links(m, max_bits, bucket_rows), "a bigint, b bigint"), "simhash-links")
    links = found.filter("b IS NOT NULL")
    crowded = found.filter("b IS NULL").select(F.col("a").alias("fp")).distinct()
    if crowded.limit(1).count():
        links = links.unionByName(_half_way_links(crowded, max_bits))
    return links


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                   keyed: bool = False) -> DataFrame:
    """One row for each document: (doc_id, key, fingerprint, component_id).

    ``fingerprint`` is 16 lower-case hex digits; ``component_id`` the smallest
    id in the document's component (NULL ids don't count; NULL if there is no
    other).  Repeated rows give repeated rows; an empty table gives none.
    """
    marked, _ = write_stage(fingerprints(docs, id_col, text_col, shingle_words, keyed), "simhash-marks")
    spark = docs.sparkSession
    by_fp, by_fp_path = write_stage(
        marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    member = connected_components(fingerprint_links(by_fp.select("fp"), max_bits))
    linked = by_fp.join(member, F.col("fp") == F.col("node"))
    smallest = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    groups = linked.select("fp", "root").join(smallest, "root").select("fp", "component_id")
    named, _ = write_stage(
        by_fp.join(groups, "fp", "left")
        .select("fp", F.coalesce("component_id", "first_id").alias("component_id")), "simhash-groups")
    drop_stage(spark, by_fp_path)
    return marked.join(named, "fp").select(
        "doc_id", "key", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id.

    Of rows with that same id, the one with the smallest row key stays; where
    a component has no id at all, each of its fingerprints keeps a row."""
    groups = simhash_groups(docs, id_col, text_col, shingle_words, max_bits, keyed=True)
    # a component whose ids are all NULL has no name: its fingerprint stands in
    name = F.coalesce(F.col("component_id").cast("string"), F.concat(F.lit("fp:"), "fingerprint"))
    first = F.col("component_id").isNull() | F.col("component_id").eqNullSafe(F.col("doc_id"))
    per_key = groups.filter(first).groupBy(name.alias("name"), "key").agg(F.count(F.lit(1)).alias("n_rows"))
    best = per_key.groupBy("name").agg(F.min_by(F.struct("key", "n_rows"), "key").alias("best"))
    return keep_rows(docs, best.select("best.key", "best.n_rows"), id_col, text_col)
