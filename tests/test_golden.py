"""Hand-worked cases (FIXTURES.md section 4) and operator semantics."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shroud.operators import generalize as G
from shroud.operators import kanon as K
from shroud.operators import stats as A
from shroud.operators import transforms as P
from shroud.operators import users as U
from shroud.operators.pseudonym import pseudonymize
from shroud.sources import io as S


def test_bin_numeric_bw5(spark):
    vals = ["1", "2", "3", "7", "12", "05", "zero", ">= 20"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    out = [r["v_DI"] for r in G.bin_numeric(df, "v", bw=5).orderBy("i").collect()]
    assert out == ["1-5", "1-5", "1-5", "6-10", "11-15", "05", "zero", ">= 20"]


def test_bin_numeric_negative_and_no_integers(spark):
    df = spark.createDataFrame([(0, "-5"), (1, "-1"), (2, "3")], "i int, v string")
    out = [r["v_DI"] for r in G.bin_numeric(df, "v", bw=5).orderBy("i").collect()]
    assert out == ["-5--1", "-5--1", "0-4"]
    txt = spark.createDataFrame([(0, "a"), (1, None)], "i int, v string")
    assert [r["v"] for r in G.bin_numeric(txt, "v", overwrite=True).orderBy("i").collect()] == ["a", None]


def test_trim_tails(spark):
    vals = ["1", "2", "3", "7", "9", "NA"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    out = [r["v_DI"] for r in G.trim_tails(df, "v", low=2, high=7).orderBy("i").collect()]
    assert out == ["<= 2", "<= 2", "3", ">= 7", ">= 7", "NA"]
    out = [r["v_DI"] for r in G.trim_tails(df, "v", low=2, high=7, keep_text=False).orderBy("i").collect()]
    assert out[-1] is None


def test_trim_tails_both_match_high_wins(spark):
    df = spark.createDataFrame([("5",)], "v string")
    assert G.trim_tails(df, "v", low=6, high=4).first()["v_DI"] == ">= 4"


def test_tail_candidates_sums_spellings(spark):
    df = spark.createDataFrame([("5",), ("05",), ("7",), ("x",)], "v string")
    assert rows(G.tail_candidates(df, "v", 3)) == [(5, 2), (7, 1)]


def test_entropy_values(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "v string")
    assert A.entropy(df, ["v"]).first()["entropy"] == 1.5
    one = spark.createDataFrame([("a",), ("a",)], "v string")
    e = A.entropy(one, ["v"]).first()["entropy"]
    assert e == 0.0 and str(e) == "0.0"


def test_iter_k_check_golden(spark):
    data = [(1, "f", "1990"), (2, "f", "1990"), (3, "f", ""), (4, "f", "NA"), (5, "m", "1991"), (6, "", "1990")]
    df = spark.createDataFrame(data, "row int, g string, y string")
    out = K.iter_k_check(df, ["g", "y"], 3)
    assert rows(out, "row", "nullSum", "kCheckFlag") == [
        (1, "11", "False"), (2, "11", "False"), (3, "10", "True"),
        (4, "10", "True"), (5, "11", "False"), (6, "01", "True")]
    k1 = K.k_anonymity(P.with_kkey(out, ["g", "y"]), 3).first()
    assert (k1["k_anonymous"], k1["suppress_fraction"]) == (False, 1.0)


def test_l_diversity_golden(spark):
    data = [(1, "A", "1"), (2, "A", "1"), (3, "B", "1"), (4, "B", None), (5, "C", "2"),
            (6, "D", None), (7, "D", None)]
    df = spark.createDataFrame(data, "row int, kkey string, grade string")
    out = K.l_diversity(df, "kkey", "grade", l=2)
    assert rows(out, "row", "grade") == [(1, " "), (2, " "), (3, "1"), (4, None), (5, " "), (6, " "), (7, " ")]


def test_k_anonymity_golden(spark):
    data = [("a",)] * 5 + [("b",)] * 3 + [("c",)] * 2
    df = spark.createDataFrame(data, "kkey string")
    r = K.k_anonymity(df, 4).first()
    assert (r["k_anonymous"], r["suppress_fraction"], r["rows"], r["rows_below_k"]) == (False, 0.5, 10, 5)
    r = K.k_anonymity(df, 2).first()
    assert (r["k_anonymous"], r["suppress_fraction"]) == (True, 0.0)


def test_k_anonymity_path_levels(spark):
    data = [("x", "1", "p")] * 4 + [("x", "2", "q")] + [("y", "1", "p")] * 2
    df = spark.createDataFrame(data, "a string, b string, c string")
    out = rows(K.k_anonymity_path(df, 2, ["a"], ["b", "c"]), "level", "added_variable", "suppress_fraction")
    assert out == [(0, "core", 0.0), (1, "b", round(1 / 7, 6)), (2, "c", round(1 / 7, 6))]


def test_flag_k_and_suppress(spark):
    data = [("a", "1")] * 3 + [("b", "2")]
    df = spark.createDataFrame(data, "g string, y string")
    out = P.suppress_below_k(K.flag_k(df, ["g", "y"], 2))
    assert out.count() == 3 and {r["kkey"] for r in out.collect()} == {"a1"}


def _users(spark):
    sets = {"u1": "AB", "u2": "AB", "u3": "AC", "u4": "A", "u5": "A", "u6": "BC"}
    data = [(u, c) for u, cs in sets.items() for c in cs]
    return spark.createDataFrame(data, "user_id string, course_id string")


def test_course_combos_golden(spark):
    out = U.course_combos(_users(spark), "user_id", "course_id")
    assert [r["course_combo"] for r in out.orderBy("user_id").collect()] == ["110", "110", "101", "100", "100", "011"]
    share = U.unique_user_share(U.with_course_combo(_users(spark), "user_id", "course_id"), "user_id", 2).first()
    assert share["unique_share"] == round(2 / 6, 6) and share["unique_combos"] == 2


def test_course_combos_many_courses_uses_arrays(spark):
    data = [(f"u{u}", f"c{c:03d}") for u in range(3) for c in range(70) if (c + u) % 3 == 0]
    df = spark.createDataFrame(data, "user_id string, course_id string")
    out = {r["user_id"]: r["course_combo"] for r in U.course_combos(df, "user_id", "course_id").collect()}
    for u in range(3):
        assert out[f"u{u}"] == "".join("1" if (c + u) % 3 == 0 else "0" for c in range(70))


def test_best_drop_single_golden(spark):
    cand = {r["drop_courses"]: r for r in U.best_drop(_users(spark), "user_id", "course_id", 2).collect()}
    assert cand["C"]["chosen"] and cand["C"]["loss"] == 0.0 and cand["C"]["n_change"] == 1
    assert cand["A"]["n_change"] == 0 and cand["B"]["n_change"] == 0


def test_user_k_anonymity_single_golden(spark):
    res = U.user_k_anonymity(_users(spark), "user_id", "course_id", 2, strategy="single")
    assert rows(res.tally) == [("C", 1)]
    kept = P.suppress_unique_users(res.rows)
    assert rows(kept, "user_id", "course_id") == [("u1", "A"), ("u1", "B"), ("u2", "A"), ("u2", "B"), ("u3", "A"),
                          ("u4", "A"), ("u5", "A")]


def test_user_k_anonymity_multi_golden(spark):
    res = U.user_k_anonymity(_users(spark), "user_id", "course_id", 2, strategy="multi")
    assert res.tally.count() == 0 and res.steps == []
    kept = P.suppress_unique_users(res.rows)
    assert {r["user_id"] for r in kept.collect()} == {"u1", "u2", "u4", "u5"}


def test_gender_shares_golden(spark):
    data = [("",)] * 2 + [("NA",)] + [("f",)] * 3 + [("m",)] * 3 + [("o",)]
    df = spark.createDataFrame(data, "gender string")
    assert rows(A.gender_shares(df), "gender", "share") == [("f", 0.5), ("m", 0.5)]
    assert rows(A.gender_shares(df, as_written=True), "gender", "share") == [
        ("f", round(3 / 7, 6)), ("m", round(3 / 7, 6))]


def test_pseudonymize_width_and_bijection(spark):
    df = spark.createDataFrame([("x",), ("y",), ("z",), ("x",), (None,)], "user_id string")
    out = pseudonymize(df, "user_id", "P", salt="s")
    got = {r["user_id"]: r["userid_DI"] for r in out.collect()}
    assert sorted(v for k, v in got.items() if k is not None) == ["P01", "P02", "P03"]
    assert got[None] is None
    assert out.filter(F.col("user_id") == "x").select("userid_DI").distinct().count() == 1


def test_pseudonymize_many_partitions_dense(spark):
    df = spark.range(0, 5000, numPartitions=7).select(F.col("id").cast("string").alias("user_id"))
    out = pseudonymize(df.repartition(11), "user_id", "U", salt="t")
    nums = sorted(int(r["userid_DI"][1:]) for r in out.collect())
    assert nums == list(range(1, 5001))
    assert {len(r["userid_DI"]) for r in out.collect()} == {1 + len(str(50000))}


def test_recode_simultaneous_and_new_column(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "v string")
    m = {"a": "b", "b": "c"}
    assert [r["v"] for r in P.recode(df, "v", m).collect()] == ["b", "c", "c", None]
    assert [r["w"] for r in P.recode(df, "v", m, new_column="w").collect()] == ["b", "c", None, None]


def test_recode_large_map_joins(spark):
    big = {str(i): f"v{i}" for i in range(1500)}
    df = spark.createDataFrame([("7",), ("x",)], "v string")
    assert rows(P.recode(df, "v", big)) == [("v7",), ("x",)]


def test_date_part_only(spark):
    df = spark.createDataFrame([(0, "2013-01-02T10:00"), (1, "Tue 01"), (2, "2013"), (3, None)], "i int, d string")
    assert [r["d_DI"] for r in P.date_part_only(df, "d").orderBy("i").collect()] == ["2013-01-02", "", "2013", None]


def test_incomplete_flag_as_written(spark):
    df = spark.createDataFrame([("", "", "zero", "")], "nevents string, nchapters string, nforum_posts string, ndays_act string")
    assert P.incomplete_flag(df).first()["incomplete_flag"] is None
    assert P.incomplete_flag(df, zero_values=("0",)).first()["incomplete_flag"] == "1"


def test_mark_nulls(spark):
    df = spark.createDataFrame([(None,), ("",), ("NA",), ("x",)], "v string")
    assert [r["v_NF"] for r in P.mark_nulls(df, ["v"]).collect()] == ["0", "0", "0", "1"]


def test_roll_up_rare(spark):
    data = [("DE", "Europe")] * 3 + [("FR", "Europe")] + [("EU", "Europe")] * 4
    df = spark.createDataFrame(data, "c string, p string")
    assert rows(G.roll_up_rare(df, "c", "p", 3).select("c", "c_DI").distinct()) == [
        ("DE", "DE"), ("EU", "Europe"), ("FR", "Europe")]


def test_bin_average_text(spark):
    df = spark.createDataFrame([("1-5", "1"), ("1-5", "4"), ("zero", "zero"), ("6-10", "7")], "b string, v string")
    got = {r["b"]: r["b_avg"] for r in A.bin_average(df, "b", "v").collect()}
    assert got == {"1-5": "2.5", "zero": None, "6-10": "7.0"}


def test_utility_matrix_matches_numpy(spark):
    import numpy as np
    vals = ["1", "2", "2", "x", None, "10.5"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    r = A.utility_matrix(df, ["v"]).first()
    nums = np.array([1, 2, 2, 10.5])
    assert r["mean"] == round(nums.mean(), 6) and r["sd"] == round(nums.std(), 6)


def test_load_source_csv_traps(spark, tmp_path):
    p = tmp_path / "in.csv"
    p.write_text('a,b,c\n1,,"x ""q"" y"\n2,"","multi\nline"\n')
    df = S.load_source(spark, str(p), multi_line=True)
    got = rows(df, "a", "b", "c", "kkey", "Count")
    assert got == [("1", "", 'x "q" y', "", 1), ("2", "", "multi\nline", "", 1)]


def test_export_view_refuses_identifiers(spark):
    df = spark.createDataFrame([("u", "True")], "user_id string, kCheckFlag string")
    with pytest.raises(ValueError):
        S.export_view(df, ["user_id"])


def test_partition_count_independent(spark):
    from shroud.sources.fixture import person_course
    pc = person_course(spark, "/root/testdata/sf0.001")
    a = K.flag_k(pc, ["continent", "gender", "LoE"], 5)
    b = K.flag_k(pc.repartition(13), ["continent", "gender", "LoE"], 5)
    assert rows(a, "user_id", "course_id", "kCheckFlag") == rows(b, "user_id", "course_id", "kCheckFlag")


@pytest.mark.parametrize("column,bw,low,high", [("nforum_posts", 2, None, 5), ("nforum_posts", 5, 1, 4),
                                                ("YoB", 2, 1960, 1990), ("YoB", 5, None, None)])
def test_generalize_numeric_equals_chain(spark, column, bw, low, high):
    from shroud.sources.fixture import person_course
    pc = person_course(spark, "/root/testdata/sf0.001")
    got = G.generalize_numeric(pc, column, bw=bw, low=low, high=high)
    chain = P.mark_value(pc, column, "0", "zero")
    chain = G.trim_tails(chain, column, low=low, high=high)
    chain = G.bin_numeric(chain, f"{column}_DI", bw=bw, overwrite=True)
    chain = A.bin_average(chain, f"{column}_DI", column)
    cols = ("user_id", "course_id", column, f"{column}_DI", f"{column}_DI_avg")
    assert rows(got, *cols) == rows(chain, *cols)
    assert set(got.columns) == set(pc.columns) | {f"{column}_DI", f"{column}_DI_avg"}


def test_export_csv_and_mapping_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("u1", "x", "1", "True"), ("u2", "y", "", "False"), ("u3", "z, w", None, "True")],
                               "user_id string, a string, b string, kCheckFlag string")
    S.export_csv(df, ["a", "b"], str(tmp_path / "out"))
    back = S.load_source(spark, str(tmp_path / "out"))
    assert rows(back, "a", "b") == [("x", "1"), ("z, w", "")]
    m = S.derive_mapping(spark.createDataFrame([("DE", "EU"), ("DE", "AS"), ("FR", "EU")], "c string, p string"), "c", "p")
    S.write_mapping(m, str(tmp_path / "map"))
    assert rows(spark.read.parquet(str(tmp_path / "map"))) == [("DE", "AS"), ("FR", "EU")]


def test_flag_unique_users_both_paths_agree(spark):
    df = _users(spark)
    a = U.flag_unique_users(df, "user_id", 2, course="course_id")
    b = U.flag_unique_users(U.with_course_combo(df, "user_id", "course_id"), "user_id", 2)
    cols = ("user_id", "course_id", "course_combo", "uniqUserFlag")
    assert rows(a, *cols) == rows(b, *cols)
    assert {r["user_id"] for r in a.filter("uniqUserFlag = 'True'").collect()} == {"u3", "u6"}


def test_load_source_ragged_rows_fail(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text("a,b\n1,2\n3,4,5\n")
    with pytest.raises(Exception):
        S.load_source(spark, str(p)).collect()


def test_iter_k_check_keep_flag(spark):
    data = [(1, "f", "", "True"), (2, "f", "", "False"), (3, "f", "1990", "False")]
    df = spark.createDataFrame(data, "row int, g string, y string, kCheckFlag string")
    # with the flag kept, row 1 is already cleared and does not count for row 2's group
    kept = K.iter_k_check(df, ["g", "y"], 2, keep_flag=True)
    assert rows(kept, "row", "kCheckFlag") == [(1, "True"), (2, "True"), (3, "False")]
    reset = K.iter_k_check(df, ["g", "y"], 3)
    assert rows(reset, "row", "kCheckFlag") == [(1, "True"), (2, "True"), (3, "False")]


def test_pseudonym_width_counts_null(spark):
    ids = [(str(i),) for i in range(99)] + [(None,)]
    df = spark.createDataFrame(ids, "user_id string")
    out = pseudonymize(df, "user_id", "P", salt="w")
    widths = {len(r["userid_DI"]) - 1 for r in out.collect() if r["userid_DI"] is not None}
    assert widths == {len(str(10 * 100))}
    assert out.filter("user_id IS NULL").first()["userid_DI"] is None


def test_exact_key_separates_colliding_tuples(spark):
    from shroud.functions.columns import EXACT
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), (None, "x"), ("NULL", "x")], "g string, y string")
    assert P.with_kkey(df, ["g", "y"]).select("kkey").distinct().count() == 2
    assert P.with_kkey(df, ["g", "y"], sep=EXACT).select("kkey").distinct().count() == 4
    r = K.k_anonymity(df, 2, qis=["g", "y"], sep=EXACT).first()
    assert r["rows_below_k"] == 4
    assert K.k_anonymity(df, 2, qis=["g", "y"]).first()["rows_below_k"] == 0


def test_grain_size_values_and_empty(spark):
    df = spark.createDataFrame([("a", None), ("a", "x"), ("b", None), ("c", "y")], "g string, h string")
    assert rows(A.grain_size(df, ["g", "h"]), "variable", "grain_size") == [("g", 0.75), ("h", 0.75)]
    assert rows(A.pick_next_to_generalize(df, ["g", "h"])) == [("g", 0.75)]
    empty = df.filter("g = 'none'")
    assert rows(A.grain_size(empty, ["g", "h"]), "variable", "grain_size") == [("g", None), ("h", None)]


def test_pruned_reads_see_broken_records(spark, tmp_path):
    (tmp_path / "ragged.csv").write_text("a,b,c\n1,2\n1,2,3,4\n")
    ragged = S.load_source(spark, str(tmp_path / "ragged.csv"))
    for read in (lambda: ragged.groupBy("a").count().collect(), lambda: ragged.select("c").collect()):
        with pytest.raises(Exception):
            read()
    (tmp_path / "quoted.csv").write_text('a,b\n"x\ny",1\n')
    assert [r.a for r in S.load_source(spark, str(tmp_path / "quoted.csv")).select("a").collect()] == ["x\ny"]


def test_files_with_another_header_order_fail(spark, tmp_path):
    folder = tmp_path / "mixed"
    folder.mkdir()
    (folder / "p1.csv").write_text("a,b\n1,2\n")
    (folder / "p2.csv").write_text("b,a\n20,10\n")
    with pytest.raises(Exception):
        S.load_source(spark, str(folder)).collect()


def test_staged_load_spreads_one_file(spark, tmp_path):
    path = tmp_path / "one.csv"
    path.write_text("a,b\n" + "".join(f"{i % 3},\"x\n{i}\"\n" for i in range(4000)))
    plain, staged = S.load_source(spark, str(path)), S.load_source(spark, str(path), staged=True)
    assert plain.select(F.spark_partition_id()).distinct().count() == 1
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, staged.collect()))
    assert len(staged.inputFiles()) >= 1 and staged.columns == plain.columns


def test_export_keeps_blanks(spark, tmp_path):
    df = spark.createDataFrame([(" ", " x ", "True"), ('q"q', "a\nb", "True"), ("no", "no", "False")],
                               "g string, v string, kCheckFlag string")
    path = str(tmp_path / "out")
    S.export_csv(df, ["g", "v"], path)
    assert sorted((r.g, r.v) for r in S.load_source(spark, path).collect()) == [(" ", " x "), ('q"q', "a\nb")]


def test_long_strings_are_not_broadcast(spark, monkeypatch):
    from shroud.functions import joins

    monkeypatch.setattr(joins, "BROADCAST_MAX_BYTES", 1_000_000)
    small = spark.range(100).select(F.col("id"), F.repeat(F.lit("x"), 20_000).alias("bits"))
    assert not joins.measured(small, None, None)[1]
    assert joins.measured(small.select("id"), None, None)[1]


def test_course_combo_twice_overwrites(spark):
    df = spark.createDataFrame([("u1", "a"), ("u1", "b"), ("u2", "a")], "user_id string, course_id string")
    once = U.with_course_combo(df, "user_id", "course_id")
    twice = U.with_course_combo(once, "user_id", "course_id")
    assert twice.columns == once.columns
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))
