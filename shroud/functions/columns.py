"""Text semantics of the person-level tables as Spark expressions.

All columns of a loaded table are text.  Numbers are recognised by a regex
guard followed by ``try_cast`` so that both Spark and an SQL oracle agree on
what counts as a number (engines differ on inputs like ``'12.5'`` -> INT or
``'1.0d'`` -> DOUBLE).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Integer text (optional sign, digits) and float text
# (digits with optional fraction or a bare fraction, optional exponent).
INT_PATTERN = r"^[+-]?[0-9]+$"
FLOAT_PATTERN = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"

# The three encodings of a missing value.
MISSING_TEXT = ("", "NA")


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_int(c: str | Column) -> Column:
    """Integer value of integer text, else NULL (BIGINT)."""
    c = col_of(c)
    return F.when(c.rlike(INT_PATTERN), c.try_cast("bigint"))


def to_double(c: str | Column) -> Column:
    """Float value of numeric text, else NULL (DOUBLE); ``nan``/``inf`` excluded."""
    c = col_of(c)
    return F.when(c.rlike(FLOAT_PATTERN), c.try_cast("double"))


def canonical_int(c: str | Column) -> Column:
    """True when the text is the canonical spelling of an integer (``'5'``, not ``'05'``)."""
    c = col_of(c)
    return F.coalesce(to_int(c).cast("string") == c, F.lit(False))


def is_missing(c: str | Column) -> Column:
    """NULL, ``''`` or ``'NA'``."""
    c = col_of(c)
    return c.isNull() | c.isin(*MISSING_TEXT)


def missing_flag(c: str | Column) -> Column:
    """``'0'`` when missing, ``'1'`` when valid (text flag)."""
    return F.when(is_missing(c), F.lit("0")).otherwise(F.lit("1"))


EXACT = None  # pass as ``sep`` for a collision-free key


def concat_key(cols: Sequence[str | Column], sep: str | None = "") -> Column:
    """Group key: the columns' text joined by ``sep``, NULL spelled ``'NULL'``.

    With ``sep=''`` distinct tuples can share a key (``('a','bc')`` and
    ``('ab','c')``, NULL and the text ``'NULL'``); that is the reference
    behaviour and the default.  ``sep=EXACT`` (None) gives an exact key: the
    JSON text of the tuple with NULLs kept, one key per distinct tuple.
    """
    if not cols:
        return F.lit("")
    if sep is None:
        fields = [col_of(c).cast("string").alias(f"c{i}") for i, c in enumerate(cols)]
        return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    parts = [F.coalesce(col_of(c).cast("string"), F.lit("NULL")) for c in cols]
    return F.concat_ws(sep, *parts)


def weight_col(df: DataFrame, weight: str | None) -> Column:
    """The row weight: the ``Count`` column when present, else 1."""
    if weight and weight in df.columns:
        return F.col(weight).cast("bigint")
    return F.lit(1).cast("bigint")


def number_text(c: str | Column) -> Column:
    """A double at 2 decimals as plain text: ``'3.0'``, ``'0.25'``, ``'12345678.5'`` (never an exponent)."""
    fixed = F.round(col_of(c).cast("double"), 2).cast("decimal(38,2)").cast("string")
    return F.regexp_replace(fixed, "0$", "")


def r6(c: str | Column) -> Column:
    """Round a double to 6 decimals and fold ``-0.0`` into ``0.0``."""
    return F.round(col_of(c).cast("double"), 6) + F.lit(0.0)
