"""The release pipeline (X1) and the before/after report.

``anonymize`` chains the operators in the order of the reference notebook:
cut dates, country names and continents where their tables are given (J1, J2),
drop staff, pseudonyms, user-wise k-anonymity, roll up small countries, clean
gender, k reading (K2), check of partly missing rows (K4) where it is asked
for, education, forum posts and birth year, second k reading, final key, flag
and delete rows below k, l-diversity of the sensitive value on the released
groups, export view.
Every step is a DataFrame transform; only the user-wise loop and the K4
passes run driver-side loops, each over aggregated tables.  The row table is
written to the shared checkpoint folder (Parquet) at three stage boundaries,
so the group statistics of a stage read one materialised table instead of
re-running the whole upstream lineage each.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shroud.functions.columns import EXACT, concat_key, r6
from shroud.operators import generalize as G
from shroud.operators import kanon as K
from shroud.operators import transforms as P
from shroud.operators import stats as A
from shroud.operators import users as U
from shroud.operators.pseudonym import pseudonymize
from shroud.session import delete_tables, materialize
from shroud.sources.io import export_view


@dataclass
class ReleaseConfig:
    user: str = "user_id"
    course: str = "course_id"
    country: str = "country"
    continent: str = "continent"
    gender: str = "gender"
    loe: str = "LoE"
    posts: str = "nforum_posts"
    yob: str = "YoB"
    sensitive: str = "grade"
    roles: str = "roles"
    date_columns: tuple = ("start_time", "last_event")
    country_names: DataFrame | None = None   # J1: (code, name) of the values in ``country``
    continents: DataFrame | None = None      # J2: (country, continent), after J1
    k: int = 5
    country_threshold: int = 5000
    posts_low: int | None = None
    posts_high: int | None = None
    posts_bw: int = 5
    yob_low: int | None = None
    yob_high: int | None = None
    yob_bw: int = 2
    l: int = 2
    prefix: str = "PC"
    salt: str | None = None
    strategy: str = "multi"
    max_comb: int = 1
    as_written: bool = False
    nevents: str = "nevents"
    nchapters: str = "nchapters"
    ndays_act: str = "ndays_act"
    sep: str | None = EXACT  # release key: exact, or '' as the reference writes it
    export_columns: tuple | None = None
    # K4 between the two k readings (the notebook's iterKcheck); a ``_DI`` column that is
    # generalised only later is checked as it stands
    null_check_qis: tuple | None = None
    entropy_columns: tuple | None = None
    utility_columns: tuple | None = None

    def key_sep(self) -> str | None:
        return "" if self.as_written else self.sep

    def incomplete(self) -> dict:
        """Arguments of ``incomplete_flag`` and ``incomplete_counts``."""
        return {"nevents": self.nevents, "nchapters": self.nchapters, "nforum_posts": self.posts,
                "ndays_act": self.ndays_act, "zero_values": ("0",) if self.as_written else ("0", "zero")}

    def release_qis(self) -> list[str]:
        return [self.course, f"{self.country}_DI", f"{self.gender}_DI", f"{self.loe}_DI",
                f"{self.posts}_DI", f"{self.yob}_DI"]


@dataclass
class Release:
    table: DataFrame        # all rows kept, all columns (internal)
    export: DataFrame       # de-identified columns of k-anonymous rows
    tally: DataFrame        # rows dropped per course by the user-wise step
    steps: list             # user-wise drops chosen
    config: ReleaseConfig
    readings: dict = field(default_factory=dict)  # lazy one-row / small DataFrames
    paths: list = field(default_factory=list)     # stage tables, which hold ids next to pseudonyms

    def close(self) -> None:
        """Delete the stage tables; call it once the results are stored."""
        delete_tables(self.table.sparkSession, self.paths)


def anonymize(df: DataFrame, cfg: ReleaseConfig | None = None) -> Release:
    """Run the release pipeline; readings taken along the way are lazy
    DataFrames in ``Release.readings`` (computed only when read):
    ``entropy_before`` / ``perplexity_change`` (whole-row entropy of the
    input columns before and after the user-wise step), ``utility_before`` / ``utility_after`` /
    ``utility_diff``, ``k_rolled_up`` (suppression needed after G1 and P5),
    ``k_generalized`` (suppression needed after
    generalisation, over the rows not cleared by the null-pattern check when
    ``null_check_qis`` is set; then also ``null_check``) and
    ``incomplete_counts``."""
    cfg = cfg or ReleaseConfig()
    if cfg.country_names is not None:
        df = P.lookup_name(df, cfg.country, cfg.country_names, *cfg.country_names.columns[:2])
        cfg = replace(cfg, country=f"{cfg.country}_cname", country_names=None)
    if cfg.continents is not None:
        df = P.lookup_parent(df, cfg.country, cfg.continents, *cfg.continents.columns[:2], out=cfg.continent)
    paths: list[str] = []
    # the untouched copy loses its staff too before any utility is measured
    original = P.drop_roles(df, cfg.roles) if cfg.roles in df.columns else df
    ent_cols = list(cfg.entropy_columns or df.columns)
    util_cols = [c for c in (cfg.utility_columns or (cfg.posts, cfg.yob, cfg.sensitive)) if c in df.columns]
    for c in cfg.date_columns:
        if c in df.columns:
            df = P.date_part_only(df, c)
    if cfg.roles in df.columns:
        df = P.drop_roles(df, cfg.roles)
    df = materialize(pseudonymize(df, cfg.user, cfg.prefix, cfg.salt), "release-ids", paths)
    entering = df
    readings = {"entropy_before": A.table_entropy(entering, ent_cols)}

    # user-wise k-anonymity, then delete users still rare
    uk = U.user_k_anonymity(df, cfg.user, cfg.course, cfg.k, strategy=cfg.strategy,
                            max_comb=cfg.max_comb)
    df = materialize(P.suppress_unique_users(uk.rows), "release-users", paths)
    readings["perplexity_change"] = A.perplexity_change(entering, df, ent_cols)

    readings["incomplete_counts"] = P.incomplete_counts(
        P.mark_value(df, cfg.posts, "0", "zero") if cfg.posts in df.columns else df, **cfg.incomplete())
    df = roll_up_stage(df, cfg)
    raw = [q if q in df.columns else q.removesuffix("_DI") for q in cfg.release_qis()]
    readings["k_rolled_up"] = K.k_anonymity(df, cfg.k, qis=raw, flag=None, sep=cfg.key_sep())
    df = materialize(recode_stage(df, cfg), "release-generalized", paths)
    # with K4 the reading covers the rows not cleared (K5 below decides the
    # release on its own, as in the notebook)
    readings["k_generalized"] = K.k_anonymity(df, cfg.k, qis=cfg.release_qis(), sep=cfg.key_sep(),
                                              flag="kCheckFlag" if cfg.null_check_qis else None)
    if cfg.null_check_qis:
        readings["null_check"] = df.groupBy("nullSum", "kCheckFlag").agg(F.count(F.lit(1)).alias("rows"))
    df = release_stage(df, cfg)
    export_cols = list(cfg.export_columns or (
        ["userid_DI"] + cfg.release_qis() + [cfg.sensitive, "incomplete_flag"]))
    export = export_view(df, export_cols, direct_identifiers=(cfg.user,))
    if util_cols:
        readings["utility_before"] = A.utility_matrix(original, util_cols)
        readings["utility_after"] = A.utility_matrix(df, util_cols)
        readings["utility_diff"] = A.utility_diff(readings["utility_after"], readings["utility_before"])
    return Release(table=df, export=export, tally=uk.tally, steps=uk.steps, config=cfg, readings=readings,
                   paths=paths)


def generalize_stage(df: DataFrame, cfg: ReleaseConfig) -> DataFrame:
    """Generalise the quasi-identifiers (``roll_up_stage``, then ``recode_stage``)."""
    return recode_stage(roll_up_stage(df, cfg), cfg)


def roll_up_stage(df: DataFrame, cfg: ReleaseConfig) -> DataFrame:
    """Small countries to continents, gender recode."""
    return P.blank_missing(G.roll_up_rare(df, cfg.country, cfg.continent, cfg.country_threshold), cfg.gender)


def recode_stage(df: DataFrame, cfg: ReleaseConfig) -> DataFrame:
    """Check of partly missing rows (if asked for), education recode, forum posts (zeros, tails, bins,
    bin means), birth year (tails, bins); then the incomplete-record flag."""
    if cfg.null_check_qis:
        qis = [q if q in df.columns else q.removesuffix("_DI") for q in cfg.null_check_qis]
        df = K.iter_k_check(df, qis, cfg.k).drop(*[f"{q}_NF" for q in qis])
    df = P.recode_education(df, cfg.loe)
    df = G.generalize_numeric(df, cfg.posts, bw=cfg.posts_bw, low=cfg.posts_low, high=cfg.posts_high)
    df = G.trim_tails(df, cfg.yob, low=cfg.yob_low, high=cfg.yob_high)
    df = G.bin_numeric(df, f"{cfg.yob}_DI", bw=cfg.yob_bw, overwrite=True)
    if cfg.as_written:
        # the notebook blanks the sensitive value on an intermediate key
        df = K.l_diversity(df, [f"{cfg.country}_DI", f"{cfg.gender}_DI", f"{cfg.loe}_DI",
                                f"{cfg.posts}_DI", f"{cfg.yob}_DI"], cfg.sensitive, cfg.l)
    return P.incomplete_flag(df, **cfg.incomplete())


def release_stage(df: DataFrame, cfg: ReleaseConfig) -> DataFrame:
    """Final key over the release QIs, flag and delete rows below k, then
    blank the sensitive value in groups that are not l-diverse."""
    df = K.flag_k(df, cfg.release_qis(), cfg.k, sep=cfg.key_sep())
    df = P.suppress_below_k(df)
    if not cfg.as_written:
        df = K.l_diversity(df, "kkey", cfg.sensitive, cfg.l)
    return df


def release_report(original: DataFrame, released: DataFrame, cfg: ReleaseConfig | None = None,
                   flags: tuple = ("viewed", "explored", "certified")) -> DataFrame:
    """(measure, original, released) for totals, flag shares, gender shares,
    mean age, the utility matrix (staff left out of the original there) and the
    share of users with a rare course set; plus re-measured k-anonymity and
    uniform groups of the release.  Totals and shares of the original are those
    of the table as given, staff included."""
    cfg = cfg or ReleaseConfig()

    def measures(df: DataFrame) -> DataFrame:
        parts = [A.total_records(df).select(F.lit("records").alias("measure"),
                                            F.col("n_records").cast("double").alias("value"))]
        present = [f for f in flags if f in df.columns]
        if present:
            parts.append(A.value_shares(df, present).select(
                F.concat(F.lit("share:"), "variable", F.lit("="), F.coalesce("value", F.lit("NULL"))).alias("measure"),
                F.col("share").alias("value")))
        if cfg.gender in df.columns:
            parts.append(A.gender_shares(df, cfg.gender, as_written=cfg.as_written).select(
                F.concat(F.lit("gender:"), F.coalesce(cfg.gender, F.lit("NULL"))).alias("measure"),
                F.col("share").alias("value")))
        if cfg.yob in df.columns:
            parts.append(A.mean_age(df, cfg.yob).select(F.lit("mean_age").alias("measure"),
                                                        F.col("mean_age").alias("value")))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    util_cols = [c for c in (cfg.utility_columns or (cfg.posts, cfg.yob, cfg.sensitive))
                 if c in original.columns and c in released.columns]

    def utility(df: DataFrame) -> DataFrame:
        if cfg.roles in df.columns:
            df = P.drop_roles(df, cfg.roles)
        parts = [F.struct(F.concat(F.lit(f"{name}:"), "variable").alias("measure"), F.col(name).alias("value"))
                 for name in ("entropy", "mean", "sd")]
        return A.utility_matrix(df, util_cols).select(F.inline(F.array(*parts)))

    def unique_share(df: DataFrame) -> DataFrame:
        combos = U.with_course_combo(df.select(cfg.user, cfg.course), cfg.user, cfg.course)
        return U.unique_user_share(combos, cfg.user, cfg.k).select(
            F.lit("unique_user_share").alias("measure"), F.col("unique_share").alias("value"))

    def all_measures(df: DataFrame) -> DataFrame:
        out = measures(df)
        if util_cols:
            out = out.unionByName(utility(df))
        if {cfg.user, cfg.course} <= set(original.columns) & set(released.columns):
            out = out.unionByName(unique_share(df))
        return out

    a = all_measures(original).withColumnRenamed("value", "original")
    b = all_measures(released).withColumnRenamed("value", "released")
    base = a.join(b, "measure", "full_outer")
    qis = [c for c in cfg.release_qis() if c in released.columns]
    extra = []
    if qis:
        ka = K.k_anonymity(released, cfg.k, qis=qis, flag=None, sep=cfg.key_sep())
        extra.append(ka.select(F.lit("release:suppress_fraction").alias("measure"),
                               F.lit(None).cast("double").alias("original"),
                               F.col("suppress_fraction").alias("released")))
        if cfg.sensitive in released.columns:
            # distinct values per group as in the l-diversity step: NULL is one of them
            values = released.groupBy(concat_key(qis, cfg.key_sep()).alias("__key"),
                                      F.col(cfg.sensitive).alias("__v")).agg(F.count(F.lit(1)).alias("__r"))
            uniform = (values.groupBy("__key").agg(F.count(F.lit(1)).alias("nd"),
                                                   F.max(F.col("__v") == " ").alias("blank"))
                       .agg(F.count(F.when((F.col("nd") < cfg.l) & ~F.coalesce("blank", F.lit(False)), 1))
                            .cast("double").alias("released")))
            extra.append(uniform.select(F.lit("release:uniform_groups_shown").alias("measure"),
                                        F.lit(None).cast("double").alias("original"), "released"))
    for e in extra:
        base = base.unionByName(e)
    return base.select("measure", r6("original").alias("original"), r6("released").alias("released"))
