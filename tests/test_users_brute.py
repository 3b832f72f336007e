"""The Spark user-wise loop against the brute-force loop."""

import hashlib

import pytest
from brute_users import user_k_anonymity as brute
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shroud.operators import transforms as P
from shroud.operators import users as U
from shroud.sources.fixture import person_course


def _spark_run(df, k, strategy, max_comb, shadow_k=False):
    res = U.user_k_anonymity(df, "user_id", "course_id", k, strategy=strategy, max_comb=max_comb,
                             shadow_k=shadow_k)
    kept = sorted((r["user_id"], r["course_id"]) for r in
                  P.suppress_unique_users(res.rows).select("user_id", "course_id").collect())
    tally = {r["course_id"]: r["rows_dropped"] for r in res.tally.collect()}
    return kept, tally


@pytest.mark.parametrize("sf,k,strategy,max_comb", [
    ("sf0.001", 5, "single", 1), ("sf0.001", 5, "multi", 2), ("sf0.001", 3, "multi", 1),
    ("sf0.01", 5, "single", 1), ("sf0.01", 5, "multi", 2)])
def test_fixture_matches_brute_force(spark, sf, k, strategy, max_comb):
    pc = person_course(spark, f"/root/testdata/{sf}").select("user_id", "course_id")
    rows = [(r["user_id"], r["course_id"]) for r in pc.collect()]
    kept, tally = brute(rows, k, strategy, max_comb)
    assert _spark_run(pc, k, strategy, max_comb) == (sorted(kept), tally)


USERS = st.sampled_from([f"u{i}" for i in range(9)])
COURSES = st.sampled_from(["A", "B", "C", "D", "E"])


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(USERS, COURSES), min_size=1, max_size=40), st.integers(2, 3),
       st.sampled_from([("single", 1, False), ("multi", 1, False), ("multi", 2, False), ("multi", 2, True)]))
def test_generated_matches_brute_force(spark, rows, k, mode):
    strategy, max_comb, shadow_k = mode
    df = spark.createDataFrame(rows, "user_id string, course_id string")
    kept, tally = brute(rows, k, strategy, max_comb, shadow_k)
    assert _spark_run(df, k, strategy, max_comb, shadow_k) == (sorted(kept), tally)


def test_large_catalogue_matches_brute_force(spark):
    courses = [f"c{i:04d}" for i in range(1100)]
    rows = [(f"u{u}", courses[(u * 37 + j * 101) % 1100]) for u in range(12) for j in range(1 + u % 3)]
    rows += [(f"v{u}", courses[5]) for u in range(4)] + [(f"w{u}", c) for u in range(3) for c in courses[:1100]]
    df = spark.createDataFrame(rows, "user_id string, course_id string")
    kept, tally = brute(rows, 3, "single", 1)
    assert _spark_run(df, 3, "single", 1) == (sorted(kept), tally)
    sets = U.user_course_sets(df, "user_id", "course_id")
    pos = {r["user_id"]: r["combo"] for r in U.positions_of(sets, "user_id", U.courses_of(sets)).collect()}
    assert pos["w0"] == list(range(1100)) and pos["v1"] == [5]


def test_catalogue_has_no_bound(spark):
    df = spark.range(120_000).select(F.lit("u").alias("user_id"), F.format_string("c%06d", "id").alias("course_id"))
    catalogue = U.course_list(df, "course_id")
    assert catalogue.size == 120_000
    wrong = catalogue.table.filter(F.col("__c") != F.format_string("c%06d", "__p"))
    assert wrong.count() == 0
    bits = U.course_combos(df.unionByName(spark.createDataFrame([("v", "c000002")], df.schema)),
                           "user_id", "course_id", catalogue)
    assert {r[0]: r[1] for r in bits.select("user_id", F.sha1("course_combo")).collect()} == {
        "u": hashlib.sha1(b"1" * 120_000).hexdigest(), "v": hashlib.sha1(b"001" + b"0" * 119_997).hexdigest()}
