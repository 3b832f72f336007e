"""The ``person_course`` table derived from the driver tables.

The reference ships no data.  This view turns orders x customer x nation x
region into one row per (user, course) with the text columns the reference
uses, planting NULL, ``''``, ``'NA'``, ``'o'``, staff rows and blank activity
by key arithmetic.  The same SQL text runs in Spark and in DuckDB (the oracle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# The fixture view text (identical rows in Spark and DuckDB).
# Table names are placeholders: plain names for the oracle, DataFrames for Spark.
PERSON_COURSE_TEMPLATE = """
SELECT CAST(o.o_custkey AS STRING) AS user_id,
       o.o_orderpriority AS course_id,
       n.n_name AS country, r.r_name AS continent,
       CASE WHEN o.o_custkey % 13 = 0 THEN NULL WHEN o.o_custkey % 11 = 0 THEN 'NA' WHEN o.o_custkey % 7 = 0 THEN ''
            WHEN o.o_custkey % 29 = 0 THEN 'o' WHEN o.o_custkey % 2 = 0 THEN 'f' ELSE 'm' END AS gender,
       CASE WHEN o.o_custkey % 17 = 0 THEN 'NA' WHEN o.o_custkey % 19 = 0 THEN ''
            ELSE CAST(1950 + (o.o_custkey * 7) % 50 AS STRING) END AS YoB,
       CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'b' WHEN 'BUILDING' THEN 'hs' WHEN 'FURNITURE' THEN 'm'
            WHEN 'HOUSEHOLD' THEN 'p_oth' ELSE 'learn' END AS LoE,
       CAST(COUNT(*) - 1 AS STRING) AS nforum_posts,
       CAST(CAST(FLOOR(MAX(c.c_acctbal) / 2000) AS INT) AS STRING) AS grade,
       CONCAT(CAST(CAST(MIN(o.o_orderdate) AS DATE) AS STRING), 'T00:00:00') AS start_time,
       CASE WHEN o.o_custkey % 97 = 0 THEN 'staff' WHEN o.o_custkey % 101 = 0 THEN 'instructor'
            WHEN o.o_custkey % 3 = 0 THEN NULL ELSE 'student' END AS roles,
       CASE WHEN o.o_custkey % 5 = 0 THEN '' ELSE CAST(COUNT(*) * 3 AS STRING) END AS nevents,
       CASE WHEN o.o_custkey % 10 = 0 THEN '' ELSE CAST(o.o_custkey % 9 AS STRING) END AS nchapters,
       CASE WHEN o.o_custkey % 4 = 0 THEN '' ELSE CAST(o.o_custkey % 30 AS STRING) END AS ndays_act,
       CASE WHEN COUNT(*) > 1 THEN '1' ELSE '0' END AS viewed,
       CASE WHEN COUNT(*) > 2 THEN '1' ELSE '0' END AS explored,
       CASE WHEN COUNT(*) > 4 THEN '1' ELSE '0' END AS certified
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {nation} n ON c.c_nationkey = n.n_nationkey JOIN {region} r ON n.n_regionkey = r.r_regionkey
GROUP BY o.o_custkey, o.o_orderpriority, n.n_name, r.r_name, c.c_mktsegment
"""
# Orders as users, the brands they bought as courses (25 courses, many rare sets).
ORDER_BRAND_TEMPLATE = """
SELECT CAST(l.l_orderkey AS STRING) AS user_id, p.p_brand AS course_id, COUNT(*) AS items
FROM {lineitem} l JOIN {part} p ON l.l_partkey = p.p_partkey
GROUP BY l.l_orderkey, p.p_brand
"""
BRAND_TABLES = ("lineitem", "part")
ORDER_BRAND_SQL = ORDER_BRAND_TEMPLATE.format(**{t: t for t in BRAND_TABLES})
VIEW_TABLES = ("orders", "customer", "nation", "region")
PERSON_COURSE_SQL = PERSON_COURSE_TEMPLATE.format(**{t: t for t in VIEW_TABLES})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_tables(spark: SparkSession, sf_dir: str, names=VIEW_TABLES) -> None:
    """Register driver tables as session temp views (for interactive SQL)."""
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


def person_course(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture view as a DataFrame (reads only the columns it uses).

    The tables are passed to ``spark.sql`` as DataFrame parameters, so no
    session view is created or replaced."""
    return spark.sql(PERSON_COURSE_TEMPLATE, **{t: table(spark, sf_dir, t) for t in VIEW_TABLES})


def order_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, course_id, items): one row for each order and brand, over a catalogue of 25 brands."""
    return spark.sql(ORDER_BRAND_TEMPLATE, **{t: table(spark, sf_dir, t) for t in BRAND_TABLES})
