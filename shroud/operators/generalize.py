"""Generalisation of quasi-identifiers.

Per-category decisions (roll-up of small countries) come from one grouped
aggregate joined back behind a size check; numeric recodes (tails, bins) need
at most one scalar (the minimum) and are otherwise row-local expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shroud.functions.columns import canonical_int, number_text, to_double, to_int, weight_col
from shroud.functions.joins import attach
from shroud.session import persisted

# Country codes always replaced by their continent.
SPECIAL_CODES = ("A1", "A2", "AP", "EU", "")


# G1 -------------------------------------------------------------------------
def roll_up_rare(df: DataFrame, column: str, parent: str, threshold: int,
                 weight: str | None = "Count", special: Sequence[str] = SPECIAL_CODES,
                 out: str | None = None) -> DataFrame:
    """``<v>_DI``: the value if it has at least ``threshold`` rows and is not a
    special code, else its parent (smallest parent seen for the value)."""
    w = weight_col(df, weight)
    stats = (df.filter(F.col(column).isNotNull())
             .groupBy(column)
             .agg(F.sum(w).alias("__n"), F.min(parent).alias("__parent"), F.count(F.lit(1)).alias("__rows")))
    keep = (F.col("__n") >= threshold) & ~F.col(column).isin(*special)
    stats = stats.select(column, F.when(keep, F.col(column)).otherwise(F.col("__parent")).alias("__di"), "__rows")
    joined = attach(df, stats, [column], rows_col="__rows")
    return joined.withColumn(out or f"{column}_DI", F.col("__di")).drop("__di")


# G2 -------------------------------------------------------------------------
def tail_candidates(df: DataFrame, column: str, cat_size: int, weight: str | None = "Count") -> DataFrame:
    """Integer values with fewer than ``cat_size`` rows, ascending: (value, n).

    Spellings of one integer (``'5'``, ``'05'``) are summed."""
    w = weight_col(df, weight)
    v = to_int(column)
    return (df.filter(v.isNotNull()).groupBy(v.alias("value")).agg(F.sum(w).alias("n"))
            .filter(F.col("n") < cat_size).orderBy("value"))


# G3 -------------------------------------------------------------------------
def trim_tails(df: DataFrame, column: str, low: int | None = None, high: int | None = None,
               out: str | None = None, keep_text: bool = True) -> DataFrame:
    """Label integers ``<= low`` / ``>= high`` (``>=`` wins when both hold) -> ``<v>_DI``.

    Canonical integer spellings are recoded; other text is kept
    (``keep_text=False``: NULL, as on the reference's first run)."""
    c = F.col(column)
    n = to_int(column)
    label = n.cast("string")
    if low is not None:
        label = F.when(n <= low, F.lit(f"<= {low}")).otherwise(label)
    if high is not None:
        label = F.when(n >= high, F.lit(f">= {high}")).otherwise(label)
    other = c if keep_text else F.lit(None).cast("string")
    return df.withColumn(out or f"{column}_DI", F.when(canonical_int(column), label).otherwise(other))


# G4 -------------------------------------------------------------------------
def bin_numeric(df: DataFrame, column: str, bw: int = 5, overwrite: bool = False,
                out: str | None = None) -> DataFrame:
    """Fixed-width bins ``"lo-hi"`` anchored at the smallest integer value.

    ``lo = x - (x - min) % bw`` (exact integer arithmetic).  Only canonical
    spellings are binned, other text is kept; without any integer the column
    is unchanged.  The minimum is a scalar subquery (one aggregate, no join)."""
    if bw <= 0:
        raise ValueError("bin width must be positive")
    target = column if overwrite else (out or f"{column}_DI")
    lo_min = df.agg(F.min(to_int(column))).scalar()
    n = to_int(column)
    lo = n - (n - lo_min) % F.lit(bw)
    label = F.concat(lo.cast("string"), F.lit("-"), (lo + F.lit(bw - 1)).cast("string"))
    return df.withColumn(target, F.when(canonical_int(column), label).otherwise(F.col(column)))


# G5 -------------------------------------------------------------------------
def generalize_numeric(df: DataFrame, column: str, bw: int = 5, low: int | None = None,
                       high: int | None = None, zero_label: str | None = "zero",
                       with_average: bool = True) -> DataFrame:
    """Recipe: mark zeros, trim tails into ``<v>_DI``, bin ``<v>_DI`` in place,
    then the bin means of the true values into ``<v>_DI_avg``.

    Every step depends on the row's value only, so the recipe runs on the
    table of distinct values (one aggregation over the rows, kept) and the
    result is joined back on the value: two passes over the rows instead of
    one per step.  Same result as chaining ``mark_value``, ``trim_tails``,
    ``bin_numeric`` and ``bin_average``."""
    c = F.col(column)
    marked = F.when(c == "0", F.lit(zero_label)).otherwise(c) if zero_label is not None else c
    di, avg = f"{column}_DI", f"{column}_DI_avg"
    values = persisted(df.groupBy(marked.alias(column)).agg(F.count(F.lit(1)).alias("__n")))
    table = trim_tails(values, column, low=low, high=high, out=di)
    table = bin_numeric(table, di, bw=bw, overwrite=True)
    cols = [column, di]
    if with_average:
        x = to_double(column)
        means = (table.filter(F.col(di).isNotNull()).groupBy(di)
                 .agg((F.sum(x * F.col("__n")) / F.sum(F.when(x.isNotNull(), F.col("__n"))))
                      .alias("__mean"))
                 .select(F.col(di).alias("__bin"), number_text("__mean").alias(avg)))
        table = table.join(means, table[di] == means["__bin"], "left").drop("__bin")
        cols.append(avg)
    mapping = table.select(F.col(column).alias("__value"), *[F.col(k).alias(f"__{k}") for k in cols[1:]],
                           F.col("__n").alias("__rows"))
    base = df.drop(*cols[1:])
    out = attach(base.withColumn(column, marked).withColumn("__value", F.col(column)), mapping, ["__value"],
                 rows_col="__rows")
    return out.select(*base.columns, *[F.col(f"__{k}").alias(k) for k in cols[1:]])
