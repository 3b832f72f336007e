"""Aggregates, entropy and utility measures.

Every measure is one or two aggregations; several columns are measured in one
pass by unpivoting them into (variable, value) pairs, so the table is scanned
once however many variables are asked for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shroud.functions.columns import concat_key, number_text, r6, to_double, to_int, weight_col
from shroud.functions.entropy import entropy_agg
from shroud.functions.joins import attach


def _pairs(df: DataFrame, columns: Sequence[str], weight: str | None) -> DataFrame:
    """(variable, pos, value, w) for each listed column of each row."""
    w = weight_col(df, weight)
    entries = [F.struct(F.lit(c).alias("variable"), F.lit(i).alias("pos"),
                        F.col(c).cast("string").alias("value"))
               for i, c in enumerate(columns)]
    return df.select(F.inline(F.array(*entries)), w.alias("w"))


# A1 / A2 --------------------------------------------------------------------
def value_counts(df: DataFrame, column: str, weight: str | None = "Count", out: str = "n") -> DataFrame:
    """Weighted frequency of each value; NULL is a group of its own."""
    return df.groupBy(column).agg(F.sum(weight_col(df, weight)).alias(out))


def total_records(df: DataFrame, weight: str | None = "Count") -> DataFrame:
    return df.agg(F.coalesce(F.sum(weight_col(df, weight)), F.lit(0)).alias("n_records"))


# A3 / A4 --------------------------------------------------------------------
def value_shares(df: DataFrame, columns: Sequence[str], weight: str | None = "Count") -> DataFrame:
    """(variable, value, n, share) for each value of each column; one scan (the
    totals come from the counts, whose exchange is reused)."""
    counts = _pairs(df, columns, weight).groupBy("variable", "value").agg(F.sum("w").alias("n"))
    totals = counts.groupBy("variable").agg(F.sum("n").alias("__total"))
    # one row for each of the columns asked for
    return counts.join(F.broadcast(totals), "variable").select(
        "variable", "value", "n", r6(F.col("n") / F.col("__total")).alias("share"))


def gender_shares(df: DataFrame, column: str = "gender", exclude: Sequence[str] = ("", "NA", "o"),
                  weight: str | None = "Count", as_written: bool = False) -> DataFrame:
    """Shares among the values not excluded (NULL is a category).

    ``as_written=True`` reproduces the reference: the excluded counts are taken
    off the total only once visited, in SQLite's order (NULL first, then text
    order), so a value is divided by total minus the excluded values before it.
    """
    counts = value_counts(df, column, weight)
    excluded = F.coalesce(F.col(column).isin(*exclude), F.lit(False))
    kept = counts.filter(~excluded)
    if not as_written:
        denom = counts.agg(F.sum(F.when(~excluded, F.col("n")))).scalar()
        return kept.select(column, "n", r6(F.col("n") / denom).alias("share"))
    # every total is read from the counts, whose exchange is reused
    denom = counts.agg(F.sum("n")).scalar()
    for e in exclude:
        before = F.col(column).isNotNull() & (F.col(column) > F.lit(e))
        share = counts.agg(F.coalesce(F.sum(F.when(F.col(column) == e, F.col("n"))), F.lit(0))).scalar()
        denom = denom - F.when(before, share).otherwise(F.lit(0))
    return kept.select(column, "n", r6(F.col("n") / denom).alias("share"))


# A5 -------------------------------------------------------------------------
def mean_age(df: DataFrame, column: str = "YoB", year: int = 2013, weight: str | None = "Count") -> DataFrame:
    """Weighted mean of ``year - YoB`` over integer birth years."""
    w = weight_col(df, weight)
    age = F.lit(year) - to_int(column)
    return df.agg(r6(F.sum(age * w) / F.sum(F.when(age.isNotNull(), w))).alias("mean_age"))


# A6 - A8 --------------------------------------------------------------------
def entropy(df: DataFrame, columns: Sequence[str], weight: str | None = "Count",
            base: float = 2.0) -> DataFrame:
    """Entropy of each column's value distribution: (variable, entropy); one scan."""
    counts = _pairs(df, columns, weight).groupBy("variable", "pos", "value").agg(F.sum("w").alias("n"))
    return (counts.groupBy("variable", "pos").agg(r6(entropy_agg("n", base)).alias("entropy"))
            .select("variable", "entropy"))


def table_entropy(df: DataFrame, columns: Sequence[str], weight: str | None = "Count",
                  base: float = 2.0, sep: str | None = "") -> DataFrame:
    """Entropy of the whole-row key over ``columns`` (one row).

    Rows are grouped on the SHA-256 of the key, so the shuffle carries 32
    bytes for each distinct row and not the text of all columns."""
    key = F.unhex(F.sha2(concat_key(list(columns), sep).cast("binary"), 256))
    counts = df.groupBy(key.alias("__row")).agg(F.sum(weight_col(df, weight)).alias("n"))
    return counts.agg(entropy_agg("n", base).alias("entropy"))


def perplexity_change(before: DataFrame, after: DataFrame, columns_before: Sequence[str],
                      columns_after: Sequence[str] | None = None, weight: str | None = "Count") -> DataFrame:
    """``2**H(before) - 2**H(after)``: equivalent number of rows lost to generalisation."""
    columns_after = list(columns_after or columns_before)
    h0 = table_entropy(before, columns_before, weight).scalar()
    h1 = table_entropy(after, columns_after, weight).scalar()
    return before.sparkSession.range(1).select(
        r6(h0).alias("entropy_before"), r6(h1).alias("entropy_after"),
        r6(F.pow(F.lit(2.0), h0) - F.pow(F.lit(2.0), h1)).alias("perplexity_change"))


# A9 / A10 -------------------------------------------------------------------
def grain_size(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(variable, pos, grain_size) = distinct values (NULL counts) / rows,
    unweighted; one scan.  An empty table gives NULL grains."""
    pairs = _pairs(df, columns, None)
    per_value = pairs.groupBy("variable", "pos", "value").agg(F.count(F.lit(1)).alias("n"))
    grains = (per_value.groupBy("variable", "pos")
              .agg(r6(F.count(F.lit(1)) / F.sum("n")).alias("grain_size")))
    asked = df.sparkSession.createDataFrame([(c, i) for i, c in enumerate(columns)], "variable string, pos int")
    # one row per requested column: a bound by construction
    return asked.join(F.broadcast(grains), ["variable", "pos"], "left").select("variable", "pos", "grain_size")


def pick_next_to_generalize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The column with the largest grain; ties go to the first listed (one row)."""
    g = grain_size(df, columns)
    best = g.agg(F.max_by(F.struct("variable", "grain_size"),
                          F.struct("grain_size", -F.col("pos"))).alias("b"))
    return best.select(F.col("b.variable").alias("variable"), F.col("b.grain_size").alias("grain_size"))


# A11 - A13 ------------------------------------------------------------------
def utility_matrix(df: DataFrame, columns: Sequence[str], weight: str | None = "Count",
                   base: float = 2.0) -> DataFrame:
    """(variable, entropy, mean, sd) for each column in one pass.

    Entropy uses all values (NULL and text too, weighted); mean and population
    SD use the numeric values of the raw rows.  The per-value table carries
    both the weighted count and the raw count, so one aggregation over the
    unpivoted rows feeds all three measures."""
    pairs = _pairs(df, columns, weight)
    per_value = pairs.groupBy("variable", "pos", "value").agg(
        F.sum("w").alias("n"), F.count(F.lit(1)).alias("raw"))
    x = to_double("value")
    m = per_value.groupBy("variable", "pos").agg(
        entropy_agg("n", base).alias("entropy"),
        F.sum(F.when(x.isNotNull(), F.col("raw"))).alias("cnt"),
        (F.sum(x * F.col("raw")) / F.sum(F.when(x.isNotNull(), F.col("raw")))).alias("mean"))
    # deviations from the mean itself: no cancellation on large values; one
    # row for each column asked for is broadcast
    around = per_value.join(F.broadcast(m.select("variable", "mean")), "variable")
    squares = around.groupBy("variable").agg(
        F.sum((x - F.col("mean")) * (x - F.col("mean")) * F.col("raw")).alias("s2"))
    return m.join(F.broadcast(squares), "variable").select(
        "variable", r6("entropy").alias("entropy"), r6("mean").alias("mean"),
        r6(F.sqrt(F.col("s2") / F.col("cnt"))).alias("sd"))


def utility_diff(after: DataFrame, before: DataFrame) -> DataFrame:
    """Cell-wise difference of two utility matrices (after - before), by variable."""
    b = before.select("variable", *[F.col(c).alias(f"__b_{c}") for c in ("entropy", "mean", "sd")])
    j = after.join(b, "variable", "full_outer")
    return j.select("variable", *[r6(F.col(c) - F.col(f"__b_{c}")).alias(f"d_{c}")
                                  for c in ("entropy", "mean", "sd")])


# A14 ------------------------------------------------------------------------
def bin_average(df: DataFrame, bin_column: str, value_column: str, out: str | None = None) -> DataFrame:
    """``<bin>_avg``: mean of the true numbers in each bin, 2 decimals, as text.

    Bins without any number get NULL.  The per-bin table is joined back
    (broadcast behind a size check)."""
    out = out or f"{bin_column}_avg"
    x = to_double(value_column)
    stats = df.groupBy(bin_column).agg(
        number_text(F.avg(x)).alias("__avg"), F.count(F.lit(1)).alias("__rows"))
    joined = attach(df, stats.filter(F.col(bin_column).isNotNull()), [bin_column], rows_col="__rows")
    return joined.withColumn(out, F.col("__avg")).drop("__avg")
