"""Registered queries: one per operator of the inventory, each over the whole
driver tables (or the ``person_course`` view Spark derives from them).

Every callable takes (spark, sf_dir) and returns a DataFrame whose column
names match the oracle SQL in ``shroud.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shroud.operators import generalize as G
from shroud.operators import kanon as K
from shroud.operators import transforms as P
from shroud.operators import stats as A
from shroud.operators import users as U
from shroud.operators.pseudonym import pseudonymize, salted_hash
from shroud.plans.release import (
    ReleaseConfig, anonymize, generalize_stage, release_report, release_stage,
)
from shroud.session import scratch_path
from shroud.sources import io as S
from shroud.sources.fixture import order_brand, person_course, table

# Fixed query parameters (chosen from the measured sf0.01 data, see FIXTURES.md).
K_ROWS = 5
SALT = "shroud-test-salt"
PREFIX = "PC"
RECODE_MAP = {"b": "hs", "hs": "m", "p_oth": "other"}
QI4 = ["country", "gender", "LoE", "course_id"]
QI3 = ["continent", "gender", "LoE"]
PC_COLUMNS = ["user_id", "course_id", "country", "continent", "gender", "YoB", "LoE",
              "nforum_posts", "grade", "start_time", "roles", "nevents", "nchapters",
              "ndays_act", "viewed", "explored", "certified"]
ENTROPY_COLS = ["country", "gender", "LoE", "YoB"]
UTILITY_COLS = ["nforum_posts", "grade", "YoB", "nevents", "nchapters", "ndays_act", "viewed"]
PERPLEXITY_COLS = ["country", "gender", "LoE", "YoB", "course_id"]
COUNTRY_TH = 250
K4_K = 112
RELEASE_COUNTRY_TH = 1_000_000_000
RELEASE_YOB_BW = 25
EXPORT_K = 10


def _pc(spark: SparkSession, sf: str) -> DataFrame:
    return person_course(spark, sf)


# sources --------------------------------------------------------------------
def q_load_source(spark, sf):
    path = scratch_path(spark, "csv")
    S.write_csv(_pc(spark, sf), path)
    return S.load_source(spark, path)


def q_derive_mapping(spark, sf):
    return S.derive_mapping(_pc(spark, sf), "country", "continent")


def q_export_view(spark, sf):
    flagged = K.flag_k(_pc(spark, sf), QI4, K_ROWS)
    return S.export_view(flagged, ["course_id", "country", "gender", "LoE"])


def q_export_csv(spark, sf):
    """Texts with newlines, blanks and quotes, written for release and read back."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "text", "lang", "source")
    path = scratch_path(spark, "export")
    S.export_csv(K.flag_k(docs, ["lang", "source"], EXPORT_K), ["doc_id", "text", "lang"], path)
    return S.load_source(spark, path).select("doc_id", "text", "lang")


def q_utility_large_values(spark, sf):
    orders = table(spark, sf, "orders").select(
        (F.col("o_orderkey") + F.lit(1_000_000_000)).cast("string").alias("far"),
        (F.col("o_custkey") % 10 + F.lit(1_000_000_000)).cast("string").alias("far_narrow"))
    return A.utility_matrix(orders, ["far", "far_narrow"])


def q_bin_average_large_values(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderpriority", (F.col("o_custkey") * 12_345 + F.lit(0.25)).cast("string").alias("amount"))
    return A.bin_average(orders, "o_orderpriority", "amount").select(
        "o_orderkey", "o_orderpriority", "o_orderpriority_avg")


def q_k_anonymity_path_cleared(spark, sf):
    pc = _pc(spark, sf).withColumn("kCheckFlag", F.lit("True"))
    return K.k_anonymity_path(pc, K_ROWS, ["continent", "gender"], ["LoE"])


# projections, recodes, filters ---------------------------------------------
def q_set_constant(spark, sf):
    df = _pc(spark, sf).select("user_id", "course_id")
    return P.set_constant(P.set_constant(df, "export_flag", None), "release", "v1")


def q_recode(spark, sf):
    df = _pc(spark, sf).select("user_id", "course_id", "LoE")
    df = P.recode(df, "LoE", RECODE_MAP, new_column="LoE_new")
    return P.recode(df, "LoE", RECODE_MAP)


def q_recode_table(spark, sf):
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    mapping = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_name").alias("key"), F.col("r_name").alias("value"))
    df = _pc(spark, sf).select("user_id", "course_id", "country")
    return P.recode(df, "country", mapping, new_column="country_parent")


def q_date_part_only(spark, sf):
    return P.date_part_only(_pc(spark, sf).select("user_id", "course_id", "start_time"), "start_time")


def q_drop_roles(spark, sf):
    return P.drop_roles(_pc(spark, sf))


def q_blank_missing(spark, sf):
    return P.blank_missing(_pc(spark, sf).select("user_id", "course_id", "gender"), "gender")


def q_recode_education(spark, sf):
    return P.recode_education(_pc(spark, sf).select("user_id", "course_id", "LoE"), "LoE")


def q_mark_value(spark, sf):
    return P.mark_value(_pc(spark, sf).select("user_id", "course_id", "nforum_posts"), "nforum_posts")


def q_incomplete_flag(spark, sf):
    df = P.mark_value(_pc(spark, sf), "nforum_posts")
    return P.incomplete_flag(df).select("user_id", "course_id", "incomplete_flag")


def q_incomplete_counts(spark, sf):
    return P.incomplete_counts(P.mark_value(_pc(spark, sf), "nforum_posts"))


def q_mark_nulls(spark, sf):
    df = P.mark_nulls(_pc(spark, sf), ["gender", "YoB"])
    return df.select("user_id", "course_id", "gender_NF", "YoB_NF")


def q_with_kkey(spark, sf):
    df = P.with_kkey(_pc(spark, sf), QI3)
    df = P.with_kkey(df, QI3, out="kkey_sep", sep="|")
    return df.select("user_id", "course_id", "kkey", "kkey_sep")


def _export_flagged(spark, sf):
    return K.flag_k(_pc(spark, sf), QI4, K_ROWS).withColumnRenamed("kCheckFlag", "export_flag")


def q_censor(spark, sf):
    return P.censor(_export_flagged(spark, sf), "gender").select("user_id", "course_id", "gender")


def q_censor_to_parent(spark, sf):
    df = P.censor_to_parent(_export_flagged(spark, sf), "country", "continent")
    return df.select("user_id", "course_id", "country_DI")


def q_to_number(spark, sf):
    return P.to_number(_pc(spark, sf).select("user_id", "course_id", "YoB"), "YoB")


def _user_flags(spark, sf):
    return U.flag_unique_users(_pc(spark, sf), "user_id", K_ROWS, course="course_id")


def q_suppress_unique_users(spark, sf):
    return P.suppress_unique_users(_user_flags(spark, sf)).select("user_id", "course_id")


def q_suppress_below_k(spark, sf):
    return P.suppress_below_k(K.flag_k(_pc(spark, sf), QI4, K_ROWS)).select("user_id", "course_id", "kkey")


# lookups ----------------------------------------------------------------------
def _named_customers(spark, sf):
    nation = table(spark, sf, "nation")
    codes = nation.filter(F.col("n_regionkey") < 3).select(
        F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("name"))
    cust = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("c_nationkey"))
    return P.lookup_name(cust, "c_nationkey", codes)


def q_lookup_name(spark, sf):
    return _named_customers(spark, sf)


def q_lookup_parent(spark, sf):
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    mapping = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_name", "r_name")
    df = P.lookup_parent(_named_customers(spark, sf), "c_nationkey_cname", mapping, "n_name", "r_name")
    return df.select("c_custkey", "c_nationkey_cname", "continent")


# pseudonyms -----------------------------------------------------------------
def q_salted_hash(spark, sf):
    return salted_hash(_pc(spark, sf).select("user_id", "course_id"), "user_id", SALT)


def q_pseudonymize(spark, sf):
    return pseudonymize(_pc(spark, sf).select("user_id", "course_id"), "user_id", PREFIX, SALT)


# aggregates -------------------------------------------------------------------
def q_value_counts(spark, sf):
    return A.value_counts(_pc(spark, sf), "gender")


def q_total_records(spark, sf):
    return A.total_records(_pc(spark, sf))


def q_value_shares(spark, sf):
    return A.value_shares(_pc(spark, sf), ["viewed", "explored", "certified"])


def q_gender_shares(spark, sf):
    return A.gender_shares(_pc(spark, sf))


def q_gender_shares_as_written(spark, sf):
    return A.gender_shares(_pc(spark, sf), as_written=True)


def q_mean_age(spark, sf):
    return A.mean_age(_pc(spark, sf))


def q_entropy(spark, sf):
    return A.entropy(_pc(spark, sf), ENTROPY_COLS)


def q_table_entropy(spark, sf):
    return A.table_entropy(_pc(spark, sf), PC_COLUMNS).select(
        F.round("entropy", 6).alias("entropy"))


def q_perplexity_change(spark, sf):
    pc = _pc(spark, sf)
    after = G.roll_up_rare(pc, "country", "continent", COUNTRY_TH)
    cols_after = ["country_DI"] + PERPLEXITY_COLS[1:]
    return A.perplexity_change(pc, after, PERPLEXITY_COLS, cols_after)


def q_grain_size(spark, sf):
    return A.grain_size(_pc(spark, sf), ENTROPY_COLS)


def q_pick_next_to_generalize(spark, sf):
    return A.pick_next_to_generalize(_pc(spark, sf), ENTROPY_COLS)


def q_utility_matrix(spark, sf):
    return A.utility_matrix(_pc(spark, sf), UTILITY_COLS)


def q_utility_diff(spark, sf):
    pc = _pc(spark, sf)
    return A.utility_diff(A.utility_matrix(P.drop_roles(pc), UTILITY_COLS), A.utility_matrix(pc, UTILITY_COLS))


def q_bin_average(spark, sf):
    df = G.bin_numeric(_pc(spark, sf), "nforum_posts", bw=2)
    df = A.bin_average(df, "nforum_posts_DI", "nforum_posts")
    return df.select("user_id", "course_id", "nforum_posts_DI", "nforum_posts_DI_avg")


# generalisation ---------------------------------------------------------------
def q_roll_up_rare(spark, sf):
    df = G.roll_up_rare(_pc(spark, sf), "country", "continent", COUNTRY_TH)
    return df.select("user_id", "course_id", "country", "country_DI")


def q_tail_candidates(spark, sf):
    return G.tail_candidates(_pc(spark, sf), "nforum_posts", 30)


def q_trim_tails(spark, sf):
    df = G.trim_tails(_pc(spark, sf), "nforum_posts", low=1, high=5)
    return df.select("user_id", "course_id", "nforum_posts", "nforum_posts_DI")


def q_bin_numeric(spark, sf):
    return G.bin_numeric(_pc(spark, sf), "YoB", bw=5).select("user_id", "course_id", "YoB", "YoB_DI")


def q_bin_numeric_part(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", F.col("p_size").cast("string").alias("p_size"))
    return G.bin_numeric(part, "p_size", bw=7)


def q_generalize_numeric(spark, sf):
    df = G.generalize_numeric(_pc(spark, sf), "nforum_posts", bw=2, high=5)
    return df.select("user_id", "course_id", "nforum_posts", "nforum_posts_DI", "nforum_posts_DI_avg")


# row-wise k-anonymity -----------------------------------------------------------
def q_k_anonymity(spark, sf):
    return K.k_anonymity(_pc(spark, sf), K_ROWS, qis=QI3)


def q_k_anonymity_path(spark, sf):
    return K.k_anonymity_path(_pc(spark, sf), K_ROWS, ["continent", "gender"], ["LoE", "course_id", "country"])


def q_iter_k_check(spark, sf):
    df = K.iter_k_check(_pc(spark, sf), ["gender", "YoB"], K4_K)
    return df.select("user_id", "course_id", "nullSum", "kCheckFlag")


def q_k_anonymity_checked(spark, sf):
    df = K.iter_k_check(_pc(spark, sf), ["gender", "YoB"], K4_K)
    return K.k_anonymity(P.with_kkey(df, ["gender", "YoB"]), K4_K)


def q_flag_k(spark, sf):
    return K.flag_k(_pc(spark, sf), QI4, K_ROWS).select("user_id", "course_id", "kkey", "kCheckFlag")


def q_l_diversity(spark, sf):
    df = K.l_diversity(_pc(spark, sf), ["country", "gender", "LoE"], "grade", l=2)
    return df.select("user_id", "course_id", "kkey", "grade")


def q_l_diversity_docs(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source")
    labels = table(spark, sf, "labels").select("doc_id", "toxic")
    df = K.l_diversity(docs.join(labels, "doc_id", "left"), ["lang", "source"], "toxic", l=2)
    return df.select("doc_id", "kkey", "toxic")


# user-wise k-anonymity ----------------------------------------------------------
def q_course_combos(spark, sf):
    return U.course_combos(_pc(spark, sf), "user_id", "course_id")


def q_user_combos(spark, sf):
    return U.user_combos(_user_flags(spark, sf), "user_id", records="True")


def q_combo_counts(spark, sf):
    df = U.with_course_combo(_pc(spark, sf), "user_id", "course_id")
    return U.combo_counts(df, "user_id")


def q_unique_user_share(spark, sf):
    df = U.with_course_combo(_pc(spark, sf), "user_id", "course_id")
    return U.unique_user_share(df, "user_id", K_ROWS)


def q_flag_unique_users(spark, sf):
    return _user_flags(spark, sf).select("user_id", "course_id", "course_combo", "uniqUserFlag")


def q_best_drop_single(spark, sf):
    return U.best_drop(_pc(spark, sf), "user_id", "course_id", K_ROWS, n_comb=1, strategy="single")


def q_best_drop_multi(spark, sf):
    return U.best_drop(_pc(spark, sf), "user_id", "course_id", K_ROWS, n_comb=2, strategy="multi")


def q_flag_unique_users_brands(spark, sf):
    return U.flag_unique_users(order_brand(spark, sf).select("user_id", "course_id"), "user_id", K_ROWS, course="course_id")


def q_best_drop_single_brands(spark, sf):
    return U.best_drop(order_brand(spark, sf), "user_id", "course_id", K_ROWS, n_comb=1, strategy="single")


def q_best_drop_multi_brands(spark, sf):
    return U.best_drop(order_brand(spark, sf), "user_id", "course_id", K_ROWS, n_comb=2, strategy="multi")


def q_apply_drops(spark, sf):
    rows, _ = U.apply_drops(_pc(spark, sf), "user_id", "course_id", K_ROWS)
    return rows.select("user_id", "course_id")


def q_drop_tally(spark, sf):
    _, tally = U.apply_drops(_pc(spark, sf), "user_id", "course_id", K_ROWS)
    return tally


def q_user_k_anonymity_single(spark, sf):
    res = U.user_k_anonymity(_pc(spark, sf), "user_id", "course_id", K_ROWS, strategy="single")
    return P.suppress_unique_users(res.rows).select("user_id", "course_id")


def q_user_k_anonymity_multi(spark, sf):
    res = U.user_k_anonymity(_pc(spark, sf), "user_id", "course_id", K_ROWS, strategy="multi", max_comb=2)
    return P.suppress_unique_users(res.rows).select("user_id", "course_id")


# composite ----------------------------------------------------------------------
def _release_config() -> ReleaseConfig:
    # every country to its continent and wide bins, so that most groups have k rows
    return ReleaseConfig(k=K_ROWS, country_threshold=RELEASE_COUNTRY_TH, posts_high=2, posts_bw=5,
                         yob_bw=RELEASE_YOB_BW, salt=SALT, prefix=PREFIX)


def _stage_config() -> ReleaseConfig:
    # the key's text as the reference writes it
    return ReleaseConfig(k=3, country_threshold=COUNTRY_TH, posts_high=5, posts_bw=2, yob_bw=5, sep="")


def q_release_stages(spark, sf):
    cfg = _stage_config()
    df = release_stage(generalize_stage(_pc(spark, sf), cfg), cfg)
    return df.select("user_id", "course_id", "kkey", "grade", "nforum_posts_DI_avg", "incomplete_flag")


def q_anonymize(spark, sf):
    return anonymize(_pc(spark, sf), _release_config()).export


def q_release_report(spark, sf):
    cfg = _release_config()
    pc = _pc(spark, sf)
    return release_report(pc, anonymize(pc, cfg).table, cfg)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
