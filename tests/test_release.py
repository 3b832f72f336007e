"""Invariants of the release pipeline (X1) and its report."""

from collections import Counter, defaultdict

import pytest

from shroud.plans.release import ReleaseConfig, anonymize, release_report
from shroud.sources.fixture import person_course

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def release(spark):
    cfg = ReleaseConfig(k=3, country_threshold=250, posts_high=5, posts_bw=2, yob_bw=10,
                        salt="pipeline-test", prefix="T")
    pc = person_course(spark, SF)
    return pc, anonymize(pc, cfg), cfg


def test_export_is_k_anonymous_and_deidentified(release):
    pc, rel, cfg = release
    out = rel.export.collect()
    assert out, "the release should keep some rows"
    assert "user_id" not in rel.export.columns and "userid_DI" in rel.export.columns
    groups = Counter(tuple(r[q] for q in cfg.release_qis()) for r in out)
    assert min(groups.values()) >= cfg.k


def test_sensitive_value_l_diverse_in_release(release):
    pc, rel, cfg = release
    values = defaultdict(set)
    for r in rel.export.collect():
        values[tuple(r[q] for q in cfg.release_qis())].add(r[cfg.sensitive])
    assert all(v == {" "} or len(v) >= cfg.l for v in values.values())


def test_pseudonyms_unique_per_user(release):
    pc, rel, cfg = release
    pairs = {(r["user_id"], r["userid_DI"]) for r in rel.table.select("user_id", "userid_DI").collect()}
    assert len({u for u, _ in pairs}) == len(pairs) == len({p for _, p in pairs})


def test_rows_accounted(release):
    pc, rel, cfg = release
    staff = pc.filter("roles IN ('instructor', 'staff')").count()
    dropped = sum(r["rows_dropped"] for r in rel.tally.collect())
    assert rel.table.count() <= pc.count() - staff - dropped
    assert rel.export.count() == rel.table.count()


def test_report_totals(spark, release):
    pc, rel, cfg = release
    rep = {r["measure"]: r for r in release_report(pc, rel.table, cfg).collect()}
    assert rep["records"]["original"] == pc.count()
    assert rep["records"]["released"] == rel.table.count()
    assert rep["release:suppress_fraction"]["released"] == 0.0
    assert rep["release:uniform_groups_shown"]["released"] == 0.0


def test_readings(release):
    pc, rel, cfg = release
    r = rel.readings
    p = r["perplexity_change"].first()
    assert p["entropy_after"] <= p["entropy_before"] and p["perplexity_change"] >= 0
    k = r["k_generalized"].first()
    assert 0.0 <= k["suppress_fraction"] <= 1.0
    assert {x["variable"] for x in r["utility_diff"].collect()} == {cfg.posts, cfg.yob, cfg.sensitive}


def test_as_written_variant(spark):
    cfg = ReleaseConfig(k=3, country_threshold=250, posts_high=5, posts_bw=2, yob_bw=10,
                        salt="pipeline-test", prefix="T", as_written=True, strategy="multi", max_comb=1)
    pc = person_course(spark, "/root/testdata/sf0.001")
    rel = anonymize(pc, cfg)
    out = rel.export.collect()
    groups = Counter(tuple(r[q] for q in cfg.release_qis()) for r in out)
    assert all(n >= cfg.k for n in groups.values())
    assert "user_id" not in rel.export.columns


def test_null_check_reading(spark):
    cfg = ReleaseConfig(k=3, country_threshold=250, posts_high=5, posts_bw=2, yob_bw=10, salt="s", prefix="T",
                        null_check_qis=("gender_DI", "YoB_DI"))
    pc = person_course(spark, "/root/testdata/sf0.001")
    rel = anonymize(pc, cfg)
    checked = {(r["nullSum"], r["kCheckFlag"]): r["rows"] for r in rel.readings["null_check"].collect()}
    assert all(flag == "False" for (pattern, flag) in checked if pattern == "11")
    k = rel.readings["k_generalized"].first()
    assert k["rows"] == sum(n for (_, flag), n in checked.items() if flag == "False")
