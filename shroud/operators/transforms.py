"""Projections, recodes, filters and lookups.

All row-local: each is a projection or filter that stays inside whole-stage
codegen.  Lookups against a table use a join whose small side is broadcast
only behind a size check (``shroud.functions.joins``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shroud.functions.columns import concat_key, missing_flag, to_double, weight_col
from shroud.functions.joins import attach

# A dict of so many characters is broadcast unmeasured (at most a few MB).
LOCAL_MAP_CHARS = 1_000_000

# Level-of-education recode.
EDUCATION_MAP = {
    "": "", "NA": "NA", "a": "Secondary", "b": "Bachelor's", "el": "Less than Secondary",
    "hs": "Secondary", "jhs": "Less than Secondary", "learn": "", "m": "Master's",
    "none": "", "other": "", "p": "Doctorate", "p_oth": "Doctorate", "p_se": "Doctorate",
}

# Roles removed before release.
STAFF_ROLES = ("instructor", "staff")


# P1 -------------------------------------------------------------------------
def set_constant(df: DataFrame, column: str, value: str | None) -> DataFrame:
    """Add or overwrite a text column holding one value (NULL allowed)."""
    return df.withColumn(column, F.lit(value).cast("string"))


# P2 -------------------------------------------------------------------------
def _map_expr(mapping: Mapping[str, str | None]) -> Column:
    items = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v).cast("string")]
    return F.create_map(*items)


def recode(df: DataFrame, column: str, mapping: Mapping[str, str | None] | DataFrame,
           new_column: str | None = None, key_col: str = "key", value_col: str = "value") -> DataFrame:
    """Apply an old->new value map, all keys at once (no chaining).

    In place (``new_column=None``): unmatched values are kept.  Into a new
    column: unmatched rows get NULL.  A dict or a 2-column DataFrame is joined,
    broadcast only behind a size check.
    """
    target = new_column or column
    known = None
    if isinstance(mapping, Mapping):
        pairs = [(k, v) for k, v in mapping.items() if k is not None]
        if sum(len(k) + len(v or "") for k, v in pairs) <= LOCAL_MAP_CHARS:
            known = len(pairs)
        mapping = df.sparkSession.createDataFrame(pairs, f"{key_col} string, {value_col} string")
    side = (mapping.select(F.col(key_col).cast("string").alias("__map_key"),
                           F.col(value_col).cast("string").alias("__map_val"),
                           F.lit(True).alias("__map_hit"))
            .filter(F.col("__map_key").isNotNull())
            .groupBy("__map_key").agg(F.min("__map_val").alias("__map_val"),
                                      F.first("__map_hit").alias("__map_hit")))
    joined = attach(df.withColumn("__map_key", F.col(column)), side, ["__map_key"],
                    known_max_rows=known)
    if new_column is None:
        value = F.when(F.col("__map_hit"), F.col("__map_val")).otherwise(F.col(column))
    else:
        value = F.col("__map_val")
    return joined.withColumn(target, value).drop("__map_key", "__map_val", "__map_hit")


# P3 -------------------------------------------------------------------------
def date_part_only(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """Text before the first ``'T'`` (the whole text when there is none) -> ``<v>_DI``."""
    return df.withColumn(out or f"{column}_DI", F.substring_index(F.col(column), "T", 1))


# P4 -------------------------------------------------------------------------
def drop_roles(df: DataFrame, column: str = "roles", roles: Sequence[str] = STAFF_ROLES) -> DataFrame:
    """Remove staff rows; NULL roles are kept."""
    return df.filter(~F.coalesce(F.col(column).isin(*roles), F.lit(False)))


# P5 -------------------------------------------------------------------------
def blank_missing(df: DataFrame, column: str, out: str | None = None, values: Sequence[str] = ("NA",),
                  blank: str = "") -> DataFrame:
    """Copy of the column with ``'NA'`` replaced by ``''`` -> ``<v>_DI``."""
    c = F.col(column)
    return df.withColumn(out or f"{column}_DI", F.when(c.isin(*values), F.lit(blank)).otherwise(c))


# P6 -------------------------------------------------------------------------
def recode_education(df: DataFrame, column: str = "LoE", out: str | None = None) -> DataFrame:
    """Fixed education recode into ``<v>_DI``; unlisted values give NULL."""
    return df.withColumn(out or f"{column}_DI", F.try_element_at(_map_expr(EDUCATION_MAP), F.col(column)))


# P7 -------------------------------------------------------------------------
def mark_value(df: DataFrame, column: str, value: str = "0", label: str = "zero") -> DataFrame:
    """Replace one value by a text label (in place), e.g. ``'0'`` -> ``'zero'``."""
    c = F.col(column)
    return df.withColumn(column, F.when(c == value, F.lit(label)).otherwise(c))


# P8 / P9 --------------------------------------------------------------------
def _incomplete_terms(nevents: str, nchapters: str, nforum_posts: str, ndays_act: str,
                      zero_values: Sequence[str]) -> list[Column]:
    blank_events = F.col(nevents) == ""
    return [
        blank_events & (F.col(nchapters) != ""),
        blank_events & ~F.col(nforum_posts).isin(*zero_values),
        blank_events & (F.col(ndays_act) != ""),
    ]


def incomplete_flag(df: DataFrame, out: str = "incomplete_flag", nevents: str = "nevents",
                    nchapters: str = "nchapters", nforum_posts: str = "nforum_posts",
                    ndays_act: str = "ndays_act", zero_values: Sequence[str] = ("0", "zero")) -> DataFrame:
    """``'1'`` for rows with blank events but some activity, else NULL.

    ``zero_values=('0',)`` reproduces the reference run, where ``'0'`` had
    already become ``'zero'`` and the posts test was true for every row."""
    a, b, c = _incomplete_terms(nevents, nchapters, nforum_posts, ndays_act, zero_values)
    return df.withColumn(out, F.when(a | b | c, F.lit("1")))


def incomplete_counts(df: DataFrame, weight: str | None = "Count", nevents: str = "nevents",
                      nchapters: str = "nchapters", nforum_posts: str = "nforum_posts",
                      ndays_act: str = "ndays_act", zero_values: Sequence[str] = ("0", "zero")) -> DataFrame:
    """Weighted row counts for each of the three conditions and for their union (one pass)."""
    w = weight_col(df, weight)
    a, b, c = _incomplete_terms(nevents, nchapters, nforum_posts, ndays_act, zero_values)
    return df.agg(
        F.sum(F.when(a, w)).alias("n_events_blank_chapters"),
        F.sum(F.when(b, w)).alias("n_events_blank_posts"),
        F.sum(F.when(c, w)).alias("n_events_blank_days"),
        F.sum(F.when(a | b | c, w)).alias("n_incomplete"),
    )


# P10 ------------------------------------------------------------------------
def mark_nulls(df: DataFrame, columns: Sequence[str], suffix: str = "_NF") -> DataFrame:
    """``<v>_NF`` = ``'0'`` if NULL/''/'NA' else ``'1'``, for each column, in one projection."""
    return df.withColumns({f"{c}{suffix}": missing_flag(c) for c in columns})


# P11 ------------------------------------------------------------------------
def with_kkey(df: DataFrame, columns: Sequence[str], out: str = "kkey", sep: str | None = "") -> DataFrame:
    """Group key column: the QIs' text concatenated (NULL as ``'NULL'``);
    ``sep=EXACT`` (None) for a collision-free key."""
    return df.withColumn(out, concat_key(list(columns), sep))


# P12 / P13 ------------------------------------------------------------------
def censor(df: DataFrame, column: str, value: str = "", flag: str = "export_flag") -> DataFrame:
    """Set ``column`` to ``value`` on rows whose flag is ``'False'``."""
    c = F.col(column)
    return df.withColumn(column, F.when(F.col(flag) == "False", F.lit(value)).otherwise(c))


def censor_to_parent(df: DataFrame, column: str, parent: str, flag: str = "export_flag") -> DataFrame:
    """``<v>_DI`` = parent value on rows whose flag is ``'False'`` (else current ``<v>_DI``)."""
    target = f"{column}_DI"
    base = F.col(target) if target in df.columns else F.col(column)
    return df.withColumn(target, F.when(F.col(flag) == "False", F.col(parent)).otherwise(base))


# P14 ------------------------------------------------------------------------
def to_number(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """Numeric value of the text (DOUBLE), NULL when it is not a number."""
    return df.withColumn(out or f"{column}_num", to_double(column))


# P15 / P16 ------------------------------------------------------------------
def suppress_unique_users(df: DataFrame, flag: str = "uniqUserFlag") -> DataFrame:
    """Delete the rows of users whose course set is still rare."""
    return df.filter(~F.coalesce(F.col(flag) == "True", F.lit(False)))


def suppress_below_k(df: DataFrame, flag: str = "kCheckFlag") -> DataFrame:
    """Delete the rows in groups below k."""
    return df.filter(~F.coalesce(F.col(flag) == "False", F.lit(False)))


# J1 / J2 --------------------------------------------------------------------
def lookup_name(df: DataFrame, column: str, codes: DataFrame, code_col: str = "code",
                name_col: str = "name", out: str | None = None) -> DataFrame:
    """Code -> name from a code table, falling back to the code -> ``<v>_cname``."""
    side = (codes.select(F.col(code_col).cast("string").alias("__code"),
                         F.col(name_col).cast("string").alias("__name"))
            .filter(F.col("__code").isNotNull())
            .groupBy("__code").agg(F.min("__name").alias("__name")))
    joined = attach(df.withColumn("__code", F.col(column).cast("string")), side, ["__code"])
    return (joined.withColumn(out or f"{column}_cname", F.coalesce(F.col("__name"), F.col(column)))
            .drop("__code", "__name"))


def lookup_parent(df: DataFrame, column: str, mapping: DataFrame, child_col: str, parent_col: str,
                  out: str = "continent") -> DataFrame:
    """Child value -> parent value from a mapping table; unmatched rows get NULL."""
    side = (mapping.select(F.col(child_col).cast("string").alias("__child"),
                           F.col(parent_col).cast("string").alias("__parent"))
            .filter(F.col("__child").isNotNull())
            .groupBy("__child").agg(F.min("__parent").alias("__parent")))
    joined = attach(df.withColumn("__child", F.col(column)), side, ["__child"])
    return joined.withColumn(out, F.col("__parent")).drop("__child", "__parent")


__all__ = [
    "EDUCATION_MAP", "STAFF_ROLES", "set_constant", "recode", "date_part_only", "drop_roles",
    "blank_missing", "recode_education", "mark_value", "incomplete_flag", "incomplete_counts",
    "mark_nulls", "with_kkey", "censor", "censor_to_parent", "to_number", "suppress_unique_users",
    "suppress_below_k", "lookup_name", "lookup_parent",
]
