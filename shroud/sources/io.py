"""Loading and exporting person-level tables.

S1 ``load_source``: CSV with header -> all-text DataFrame plus ``kkey=''`` and
``Count=1``.  Empty fields stay ``''`` (never NULL), quoted fields may hold
quotes and newlines, ragged rows fail the load.
S2: the DataFrame is immutable, so the untouched copy is the input itself.
S3 ``derive_mapping``/``write_mapping``: one parent value per child value.
S4 ``export_view``/``export_csv``: only k-anonymous rows, only chosen columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shroud.session import materialize


def from_table(df: DataFrame, weight: str = "Count", key: str = "kkey") -> DataFrame:
    """Any DataFrame as the all-text working table: every column cast to string,
    NULL kept, plus the group key column and the integer weight column."""
    cols = [F.col(c).cast("string").alias(c) for c in df.columns if c not in (weight, key)]
    return df.select(*cols, F.lit("").alias(key), F.lit(1).cast("int").alias(weight))


def load_source(spark: SparkSession, path: str, weight: str = "Count",
                key: str = "kkey", multi_line: bool = True, staged: bool = False) -> DataFrame:
    """Read a CSV file (or folder of part files) as an all-text table.

    Quoted fields may hold newlines; each file is then read by one task, so
    give large input as many files.  ``multi_line=False`` splits files across
    tasks, for input known to have no quoted newlines.  With ``staged`` the
    parsed rows are spread over all tasks and written once to the shared
    checkpoint folder, so that of one large file only the parse is serial and
    happens once.  Every record is parsed
    in full and every file's header is compared with the first one's, whatever
    columns a query needs: a ragged record or another order of columns fails
    the load instead of being read wrongly."""
    raw = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("nullValue", "\u0000")
        .option("mode", "FAILFAST")
        .option("columnPruning", False)
        .option("enforceSchema", False)
        .csv(path)
    )
    # Unquoted empty fields still read as NULL; the reference keeps them as ''.
    texts = [f.name for f in raw.schema.fields if isinstance(f.dataType, T.StringType)]
    raw = raw.na.fill("", subset=texts) if texts else raw
    if staged:
        # by the hash of the place, so that repeated rows are spread too
        spread = F.xxhash64(F.monotonically_increasing_id())
        raw = materialize(raw.withColumn("__spread", spread).repartition("__spread").drop("__spread"), "source")
    return from_table(raw, weight=weight, key=key)


def derive_mapping(df: DataFrame, child: str, parent: str) -> DataFrame:
    """One parent per child value (the smallest, so the result is deterministic)."""
    return df.groupBy(child).agg(F.min(parent).alias(parent))


def write_mapping(mapping: DataFrame, path: str, fmt: str = "parquet") -> None:
    mapping.write.mode("overwrite").format(fmt).option("header", True).save(path)


def export_view(df: DataFrame, columns: Sequence[str], flag: str = "kCheckFlag",
                direct_identifiers: Sequence[str] = ("user_id",)) -> DataFrame:
    """Rows cleared for release (``flag = 'True'``), chosen columns only.

    Names listed in ``direct_identifiers`` are refused: export only columns
    that are de-identified."""
    columns = list(columns)
    if not columns:
        raise ValueError("export needs an explicit column list")
    bad = [c for c in columns if c in set(direct_identifiers)]
    if bad:
        raise ValueError(f"direct identifiers cannot be exported: {bad}")
    return df.filter(F.col(flag) == "True").select(*columns)


def export_csv(df: DataFrame, columns: Sequence[str], path: str, flag: str = "kCheckFlag",
               direct_identifiers: Sequence[str] = ("user_id",)) -> None:
    """Distributed CSV write (one part file per partition) with header; values
    are written as they are, leading and trailing blanks included."""
    write_csv(export_view(df, columns, flag, direct_identifiers), path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header that ``load_source`` reads back value for value."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
