"""Row-wise k-anonymity and l-diversity (K1-K6).

Group sizes come from ``groupBy(key).agg(sum(weight))`` (partial aggregation,
so a huge safe group costs no more than a small one) and are joined back to
the rows behind a size check.  K3 measures every level of a nested QI list in
one scan with GROUPING SETS.  K4 runs its few sequential passes on the table
of distinct QI tuples, not on the rows, and joins the flags back once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shroud.functions.columns import concat_key, missing_flag, r6, weight_col
from shroud.functions.joins import attach
from shroud.session import cut_lineage


def _scope(df: DataFrame, flag: str | None) -> DataFrame:
    """Rows still to be checked: those with ``flag = 'False'`` when the flag exists."""
    if flag and flag in df.columns:
        return df.filter(F.col(flag) == "False")
    return df


def _key(df: DataFrame, qis: Sequence[str] | None, key: str, sep: str):
    return concat_key(list(qis), sep) if qis is not None else F.col(key)


# K1 / K2 --------------------------------------------------------------------
def k_anonymity(df: DataFrame, k: int, qis: Sequence[str] | None = None, key: str = "kkey",
                weight: str | None = "Count", flag: str | None = "kCheckFlag", sep: str | None = "") -> DataFrame:
    """One row: (k_anonymous, suppress_fraction, rows, rows_below_k).

    Rows below k are weighted, the denominator counts raw rows.  Only rows
    with ``kCheckFlag='False'`` are considered when that column exists."""
    scoped = _scope(df, flag)
    groups = scoped.groupBy(_key(scoped, qis, key, sep).alias("__key")).agg(
        F.sum(weight_col(scoped, weight)).alias("n"), F.count(F.lit(1)).alias("raw"))
    below = F.coalesce(F.sum(F.when(F.col("n") < k, F.col("n"))), F.lit(0))
    rows = F.coalesce(F.sum("raw"), F.lit(0))
    return groups.agg(
        (below == 0).alias("k_anonymous"),
        r6(F.when(rows > 0, below / rows).otherwise(F.lit(0.0))).alias("suppress_fraction"),
        rows.alias("rows"), below.alias("rows_below_k"))


# K3 -------------------------------------------------------------------------
def k_anonymity_path(df: DataFrame, k: int, core: Sequence[str], optional: Sequence[str],
                     weight: str | None = "Count", flag: str | None = "kCheckFlag",
                     sep: str | None = "") -> DataFrame:
    """Suppression needed for the core QIs, then with each optional QI added in
    turn: (level, added_variable, k_anonymous, suppress_fraction).

    All levels in one scan: GROUPING SETS over the per-level keys."""
    scoped = _scope(df, flag)
    core, optional = list(core), list(optional)
    names = [f"__k{j}" for j in range(len(optional) + 1)]
    keyed = scoped.select(
        *[concat_key(core + optional[:j], sep).alias(names[j]) for j in range(len(names))],
        weight_col(scoped, weight).alias("__w"))
    grouped = keyed.groupingSets([[n] for n in names], *names).agg(
        F.sum("__w").alias("n"), F.count(F.lit(1)).alias("raw"),
        *[F.grouping(n).alias(f"__g{j}") for j, n in enumerate(names)])
    level = F.lit(None).cast("int")
    for j in reversed(range(len(names))):
        level = F.when(F.col(f"__g{j}") == 0, F.lit(j)).otherwise(level)
    per_level = grouped.groupBy(level.alias("level")).agg(
        F.coalesce(F.sum(F.when(F.col("n") < k, F.col("n"))), F.lit(0)).alias("below"),
        F.sum("raw").alias("rows"))
    # one row for each level asked for; a scope without rows needs no suppression
    asked = df.sparkSession.createDataFrame(list(enumerate(["core"] + optional)), "level int, added_variable string")
    below = F.coalesce("below", F.lit(0))
    return asked.join(F.broadcast(per_level), "level", "left").select(
        "level", "added_variable", (below == 0).alias("k_anonymous"),
        r6(F.coalesce(below / F.col("rows"), F.lit(0.0))).alias("suppress_fraction"))


# K4 -------------------------------------------------------------------------
def iter_k_check(df: DataFrame, qis: Sequence[str], k: int, weight: str | None = "Count",
                 flag: str = "kCheckFlag", sep: str | None = "", keep_flag: bool = False) -> DataFrame:
    """Sequential check of partly missing rows.

    ``nullSum`` concatenates the ``<q>_NF`` flags.  For each pattern with a
    missing QI, in ascending order, rows are keyed on the QIs valid in that
    pattern; group sizes count every row not yet cleared (any pattern), and
    rows of this pattern in groups of at least k get ``kCheckFlag='True'``.
    Rows with all QIs present are never cleared here.  Runs on the distinct
    QI tuples (with their weights): one aggregate gives every pattern's group
    sizes, one join the tuples that may be cleared; a pass (at most
    2**len(qis) - 1) reads its pattern's tuples among these and takes from
    their sizes what earlier passes cleared.
    """
    qis = list(qis)
    nf = [f"{q}_NF" for q in qis]
    rows = df.withColumns({n: missing_flag(q) for n, q in zip(nf, qis)})
    rows = rows.withColumn("nullSum", F.concat_ws("", *[F.col(n) for n in nf]))
    start = F.col(flag) if (keep_flag and flag in df.columns) else F.lit("False")
    rows = rows.withColumn("__f0", start)
    tuples = rows.groupBy(*qis, "nullSum", "__f0").agg(F.sum(weight_col(rows, weight)).alias("__n"),
                                                       F.count(F.lit(1)).alias("__rows"))
    open_tuples = cut_lineage(tuples.filter(F.col("__f0") == "False"))
    patterns = sorted(r["nullSum"] for r in open_tuples.select("nullSum").distinct().collect() if "0" in r["nullSum"])
    if not patterns:
        return rows.withColumn(flag, F.col("__f0")).drop("__f0")

    def key_in(pattern: str) -> Column:
        return concat_key([q for q, bit in zip(qis, pattern) if bit == "1"], sep)

    # every pattern's group sizes before any pass, in one aggregate
    keys = F.array(*[F.struct(F.lit(p).alias("p"), key_in(p).alias("key")) for p in patterns])
    sizes = (open_tuples.select("__n", F.explode(keys).alias("__in")).groupBy("__in.p", "__in.key")
             .agg(F.sum("__n").alias("__size"), F.count(F.lit(1)).alias("__tuples")))
    sizes = sizes.select(F.col("p").alias("nullSum"), F.col("key").alias("__nk"), "__size", "__tuples")
    own = F.coalesce(*[F.when(F.col("nullSum") == p, key_in(p)) for p in patterns])
    partly = open_tuples.filter(F.col("nullSum").isin(patterns)).withColumn("__nk", own)
    # a pass only takes from a size, so no other tuple can be cleared
    hopeful = cut_lineage(attach(partly, sizes, ["nullSum", "__nk"], rows_col="__tuples").filter(F.col("__size") >= k))
    cleared = None
    for pattern in sorted(r["nullSum"] for r in hopeful.select("nullSum").distinct().collect()):
        mine = hopeful.filter(F.col("nullSum") == pattern)
        if cleared is not None:
            taken = cleared.groupBy(key_in(pattern).alias("__nk")).agg(F.sum("__n").alias("__taken"))
            mine = attach(mine, taken, ["__nk"])
            # only the pattern's cleared tuples are written, not the table of all
            mine = cut_lineage(mine.filter(F.col("__size") - F.coalesce("__taken", F.lit(0)) >= k).drop("__taken"))
        cleared = mine if cleared is None else cleared.unionByName(mine)
    if cleared is None:
        return rows.withColumn(flag, F.col("__f0")).drop("__f0")
    flags = cleared.select(*qis, "__f0", F.lit("True").alias("__new"), "__rows")
    out = attach(rows, flags, qis + ["__f0"], rows_col="__rows")
    return out.withColumn(flag, F.coalesce("__new", "__f0")).drop("__new", "__f0")


# K5 -------------------------------------------------------------------------
def flag_k(df: DataFrame, qis: Sequence[str], k: int, key: str = "kkey", flag: str = "kCheckFlag",
           weight: str | None = "Count", sep: str | None = "") -> DataFrame:
    """``kkey`` over the QIs and ``kCheckFlag`` = ``'True'`` where the group has at least k rows."""
    keyed = df.withColumn(key, concat_key(list(qis), sep))
    sizes = keyed.groupBy(key).agg(F.sum(weight_col(keyed, weight)).alias("__size"),
                                   F.count(F.lit(1)).alias("__rows"))
    out = attach(keyed, sizes, [key], rows_col="__rows")
    return (out.withColumn(flag, F.when(F.col("__size") >= k, F.lit("True")).otherwise(F.lit("False")))
            .drop("__size"))


# K6 -------------------------------------------------------------------------
def l_diversity(df: DataFrame, key: str | Sequence[str], sensitive: str, l: int = 2,
                blank: str = " ", sep: str | None = "") -> DataFrame:
    """Blank the sensitive value in groups with fewer than ``l`` distinct values
    (NULL counts as a value; a one-row group is always blanked)."""
    if isinstance(key, str):
        keyed, key_col = df, key
    else:
        key_col = "kkey"
        keyed = df.withColumn(key_col, concat_key(list(key), sep))
    s = F.col(sensitive).cast("string")
    if l == 2:
        # least and greatest value and the number of NULLs tell whether there are two: one aggregation
        many = F.coalesce(F.min(s) < F.max(s), F.lit(False)) | (
            (F.count(s) > 0) & (F.count(F.lit(1)) > F.count(s)))
        stats = keyed.groupBy(key_col).agg(F.when(many, 2).otherwise(1).alias("__nd"), F.count(F.lit(1)).alias("__rows"))
    else:
        # two aggregations (both partial map-side): distinct values per group,
        # then their number; NULL is one of the values
        values = keyed.groupBy(key_col, s.alias("__v")).agg(F.count(F.lit(1)).alias("__r"))
        stats = values.groupBy(key_col).agg(F.count(F.lit(1)).alias("__nd"), F.sum("__r").alias("__rows"))
    out = attach(keyed, stats, [key_col], rows_col="__rows")
    return (out.withColumn(sensitive, F.when(F.col("__nd") < l, F.lit(blank)).otherwise(s))
            .drop("__nd"))
