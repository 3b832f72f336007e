"""A Merkle manifest of a dataset, by nested intervals (free style, DataFrame functions).

Every row is a leaf: the SHA-256 of its fields.  The leaves of a group (a
source) ascend by id; ``FAN`` consecutive nodes become their hash, level by
level, until one node remains, the group's subroot.  The subroots, in the order
of their groups, form a tree of the same kind above, whose top is the root.  A
leaf's proof has, for each level, its siblings to the left and to the right;
leaf and proof fold to the root.

A node is labelled with the interval [lo, hi) of leaf ranks that it covers in
its tree.  Nodes of a level lie in buckets of ``FAN ** level`` ranks, so a node
and its parent meet in an equi-join on the bucket, with the parent's interval
containing the node's; of the parent's children, those whose interval ends at
or before the node's are its siblings to the left, those that start at or after
its end the siblings to the right.  Proofs are handed down from the root: a
node's proof is its siblings and then its parent's proof.  So a level moves one
proof for each node of the level above, a third of the level's nodes.

Ranks come from one range sort by (group, id, leaf), in which equal rows are
spread by a hash, and the sizes of each group's pieces in the partitions: a
group that holds a third of all rows lies in many partitions and is never one
task's.  A bucket has ``FAN`` nodes at most.  All tables between are written
to the shared folder.

A NULL group is a group of its own, before all others; NULL ids come first; of
rows with one id, the smaller leaf comes first (equal rows have equal leaves,
and any order of them gives the same tree).  An empty table gives no rows.
Columns that aren't named may have any name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shroud.llm.common import drop_stage, id_remainder, write_stage

FAN = 3
_PLACE = (1 << 33) - 1  # the place in the partition, in a monotonically increasing id


def sha(text: Column) -> Column:
    """SHA-256 as bytes."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def as_hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def leaf_hash(values: Sequence[Column]) -> Column:
    """Each value as UTF-8 byte count, ``:``, value, or ``-`` if NULL, concatenated and hashed."""
    def one(value: Column) -> Column:
        text = value.cast("string")
        return F.when(text.isNull(), F.lit("-")).otherwise(
            F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))
    return sha(F.concat(*[one(v) for v in values]))


def _ranked(rows: DataFrame, group: str | None, order: Sequence[str]) -> tuple[DataFrame, str]:
    """``rows`` as leaves of one tree for each group: with ``tree`` (ascending as the groups do),
    ``lo`` (rank in the tree) and ``size`` (leaves of the tree)."""
    spark = rows.sparkSession
    group_col = F.col(group) if group else F.lit(0)
    keyed = rows.withColumn("__group", group_col).withColumn("__tie", F.xxhash64(F.monotonically_increasing_id()))
    by = [F.col(c).asc_nulls_first() for c in ["__group", *order, "__tie"]]
    placed, placed_path = write_stage(
        keyed.orderBy(*by).drop("__tie").withColumn("__at", F.monotonically_increasing_id())
        .withColumn("__part", F.shiftright("__at", 33)), "merkle-sorted")
    # a piece is a group's rows in one partition, so no key of the join below is larger than that
    pieces = placed.groupBy("__group", "__part").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    whole = Window.partitionBy("__group")
    earlier = whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    pieces, pieces_path = write_stage(pieces.select(
        F.col("__group").alias("__g"), F.col("__part").alias("__p"), "__first",
        F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"),
        F.min("__first").over(whole).alias("tree"), F.sum("__n").over(whole).alias("size")), "merkle-pieces")
    same = (F.col("__part") == F.col("__p")) & F.col("__group").eqNullSafe(F.col("__g"))
    leaves, path = write_stage(
        placed.join(pieces, same).withColumn("lo", F.col("__before") + F.col("__at") - F.col("__first"))
        .select("tree", "lo", "size", *rows.columns), "merkle-leaves")
    drop_stage(spark, placed_path)
    drop_stage(spark, pieces_path)
    return leaves, path


def _grown(leaves: DataFrame) -> list[tuple[DataFrame, str]]:
    """The levels above the leaves, each a table (tree, lo, hi, size, digest, children)."""
    most = leaves.agg(F.max("size")).first()[0] or 0
    below = leaves.select("tree", "lo", (F.col("lo") + 1).alias("hi"), "size", "digest")
    levels, width = [], 1
    while width < most:
        width *= FAN
        grouped = (below.filter("hi - lo < size")
                   .groupBy("tree", (F.col("lo") - F.col("lo") % width).alias("bucket"), "size")
                   .agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "digest"))).alias("children")))
        text = F.array_join(F.transform("children", lambda c: as_hex(c["digest"])), "")
        level = write_stage(grouped.select(
            "tree", F.col("bucket").alias("lo"), F.array_max(F.col("children.hi")).alias("hi"), "size",
            sha(text).alias("digest"), "children"), "merkle-level")
        levels.append(level)
        below = level[0].drop("children")
    return levels


def _handed_down(leaves: DataFrame, levels: list[tuple[DataFrame, str]], tops: DataFrame) -> DataFrame:
    """``leaves`` with their ``proof`` and what else ``tops`` has for their tree.

    ``tops``: (tree, proof, further columns) of each tree's top.  The level tables are deleted."""
    spark = leaves.sparkSession
    more = [c for c in tops.columns if c not in ("tree", "proof")]
    tops = tops.withColumnRenamed("tree", "__tree")
    above, above_path = None, None
    nodes = [leaves.withColumn("hi", F.col("lo") + 1)] + [t for t, _ in levels]
    for depth in range(len(levels), -1, -1):
        here = nodes[depth]
        out = here.filter("hi - lo = size").join(tops, F.col("tree") == F.col("__tree")).drop("__tree")
        if above is not None:
            width = FAN ** (depth + 1)
            parents = above.select(F.col("tree").alias("__tree"), F.col("lo").alias("__lo"), F.col("hi").alias("__hi"),
                                   F.col("children").alias("__children"), F.col("proof").alias("__proof"), *more)
            inside = ((F.col("tree") == F.col("__tree")) & (F.col("lo") - F.col("lo") % width == F.col("__lo"))
                      & (F.col("lo") >= F.col("__lo")) & (F.col("hi") <= F.col("__hi")))
            met = here.filter("hi - lo < size").join(parents, inside)
            # the lambdas below must see the node's interval under names the children don't have
            met = met.withColumns({"__from": F.col("lo"), "__to": F.col("hi")})

            def side(test) -> Column:
                picked = F.filter("__children", test)
                return F.unhex(F.array_join(F.transform(picked, lambda c: F.hex(c["digest"])), ""))

            step = F.struct(side(lambda c: c["hi"] <= F.col("__from")).alias("left"),
                            side(lambda c: c["lo"] >= F.col("__to")).alias("right"))
            met = met.withColumn("proof", F.concat(F.array(step), "__proof"))
            out = out.unionByName(met.select(*out.columns))
        if depth == 0:
            return out.drop("hi")
        done, path = write_stage(out, "merkle-proofs")
        drop_stage(spark, levels[depth - 1][1])
        if above_path:
            drop_stage(spark, above_path)
        above, above_path = done, path
    raise AssertionError("unreachable")


def _tops(leaves: DataFrame, levels: list[tuple[DataFrame, str]]) -> DataFrame:
    """(tree, digest) of the node of each tree that covers all of it."""
    out = leaves.filter("size = 1").select("tree", "digest")
    for level, _ in levels:
        out = out.union(level.filter("hi - lo = size").select("tree", "digest"))
    return out


def merkle_manifest(rows: DataFrame, id_col: str, group_col: str, leaf_col: str,
                    carried: Sequence[str] = ()) -> DataFrame:
    """(id, leaf, subroot, root, proof, carried columns) for each row.

    ``leaf_col`` holds the leaves as bytes (see ``leaf_hash``).  ``proof`` is an
    array, from the leaf to the root, of (left, right): the joined digests of
    the siblings on either side.  Digests are bytes; ``fold`` checks a proof."""
    spark = rows.sparkSession
    given = rows.select(F.col(id_col).alias("id"), F.col(group_col).alias("in_group"),
                        F.col(leaf_col).alias("digest"), *[F.col(c).alias(f"kept_{i}") for i, c in enumerate(carried)])
    written, written_path = write_stage(given, "merkle-rows")
    leaves, _ = _ranked(written, "in_group", ["id", "digest"])
    drop_stage(spark, written_path)
    levels = _grown(leaves)
    subroots, subroots_path = write_stage(
        _tops(leaves, levels).select(F.col("tree").alias("of"), "digest"), "merkle-subroots")
    upper, _ = _ranked(subroots, None, ["of"])
    drop_stage(spark, subroots_path)
    upper_levels = _grown(upper)
    tops = _tops(upper, upper_levels).withColumnRenamed("digest", "root")
    root, root_path = write_stage(tops.withColumn(
        "proof", F.array().cast("array<struct<left:binary,right:binary>>")), "merkle-root")  # one row
    lower_tops, _ = write_stage(
        _handed_down(upper, upper_levels, root)
        .select(F.col("of").alias("tree"), "proof", F.col("digest").alias("subroot"), "root"), "merkle-subproofs")
    drop_stage(spark, root_path)
    out = _handed_down(leaves, levels, lower_tops)
    return out.select(F.col("id").alias(id_col), F.col("digest").alias("leaf"), "subroot", "root", "proof",
                      *[F.col(f"kept_{i}").alias(c) for i, c in enumerate(carried)])


def fold(leaf: Column, proof: str | Column) -> Column:
    """The root, in hex, that a leaf (bytes) and a proof give."""
    return F.aggregate(proof, as_hex(leaf), lambda acc, p: F.sha2(
        F.concat(as_hex(p["left"]), acc, as_hex(p["right"])).cast("binary"), 256))


def proof_digest(proof: str | Column) -> Column:
    """The hash, in hex, of all siblings of a proof."""
    text = F.array_join(F.transform(proof, lambda p: F.concat(as_hex(p["left"]), as_hex(p["right"]))), "")
    return F.sha2(text.cast("binary"), 256)


def tamper_check(docs: DataFrame, id_col: str = "doc_id", group_col: str = "source",
                 fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
                 text_col: str = "text") -> DataFrame:
    """The manifest in hex, and whether each row still folds to the root after tampering.

    Tampering deletes the line feeds of the texts whose id has an even crc32
    (NULL texts stay).  Columns: (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)."""
    tampered = F.when(id_remainder(id_col, 2) == 0, F.translate(F.col(text_col), "\n", "")).otherwise(F.col(text_col))
    leaf = leaf_hash([F.col(c) for c in fields])
    changed = F.when((id_remainder(id_col, 2) == 0) & F.col(text_col).contains("\n"),
                     leaf_hash([tampered if c == text_col else F.col(c) for c in fields]))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(group_col).alias("source"), leaf.alias("leaf"),
                       changed.alias("changed"))
    out = merkle_manifest(rows, "doc_id", "source", "leaf", ["changed"])
    out = out.select("doc_id", as_hex(F.col("leaf")).alias("leaf"), as_hex(F.col("subroot")).alias("subroot"),
                     as_hex(F.col("root")).alias("root"), proof_digest("proof").alias("proof_sha256"),
                     fold(F.coalesce("changed", "leaf"), "proof").alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
