"""User-wise k-anonymity over the set of courses of each user.

A user's course set is a bitstring (one character per course, courses in
ascending order).  Users whose bitstring is shared by fewer than k users are
"unique"; the greedy repair drops, for such users, the course (or set of
courses) that loses the least entropy.

Scale design
* The rows are aggregated once into per-user course sets (``collect_set``,
  combined map-side); the course catalogue, a numbered table of any size, and
  the bitstrings are derived from that kept table, and joined back to the rows
  where rows need them, once by user.
* Scoring never forms combos x candidates.  Dropping the position set D only
  changes the combos that intersect D, so each rare combo is exploded into
  the candidates that hit one of its set bits (the first hit generates each
  candidate once), and the entropy change is computed from those rows alone:
  ``loss(D) = sum_g [f(A_g + n_g) - f(n_g)] - sum_c f(n_c)`` over post groups g,
  with ``f(x) = x log2 x``, divided by the number of rare users.
* The greedy loop runs on the aggregated combo table
  ``(origin, current, dropped, n)`` - all users with one combo are treated
  alike - so row data is touched twice in total (build combos, apply drops).
  The table is written to the shared checkpoint folder every iteration.
* The driver collects only the number of courses and the chosen candidate.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shroud.functions import joins
from shroud.functions.columns import r6, weight_col
from shroud.functions.joins import attach, sized
from shroud.operators import drops as D
from shroud.session import cut_lineage, keep, persisted

# The driver holds the combos' hash table several times while it builds and sends it.
COUNTS_BROADCAST_BYTES = 8 * 1024 * 1024

# U1 -------------------------------------------------------------------------
def user_course_sets(df: DataFrame, user: str, course: str) -> DataFrame:
    """(user, sorted distinct courses) - the one aggregation over the rows.

    ``collect_set`` is combined map-side, so a user with a huge number of rows
    ships at most one set per map task.  The table is kept (memory, spilling
    to disk) because the course list and the bitstrings are both read from it.
    """
    return persisted(df.filter(F.col(user).isNotNull())
                     .groupBy(user).agg(F.array_sort(F.collect_set(F.col(course).cast("string"))).alias("__set"),
                                        F.count(F.lit(1)).alias("__rows")))


@dataclass
class Catalogue:
    """The distinct courses in ascending order, numbered from 0."""

    table: DataFrame         # (__c course, __p position)
    size: int
    bound: int | None        # rows if the table's measured size allows a broadcast


def _numbered(rows: DataFrame, order: Sequence[str] = ("__c",), out: str = "__p") -> Catalogue:
    """Number the rows from 0 in ascending order of columns that no two rows share.

    The rows are sorted in runs, one for each partition; a position is the
    place in the run plus the sizes of the runs before.  Only these sizes (one
    row per partition) pass through one task."""
    runs = cut_lineage(rows.orderBy(*order).withColumn("__id", F.monotonically_increasing_id()))
    run = F.shiftright("__id", 33)
    sizes = runs.groupBy(run.alias("__run")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__run", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    place = F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    table = runs.join(F.broadcast(starts), run == F.col("__run")).select(
        *rows.columns, (F.col("__start") + place).cast("int").alias(out))
    table, size, fits = sized(table)
    return Catalogue(table, size, size if fits else None)


def courses_of(sets: DataFrame) -> Catalogue:
    """The course catalogue of the per-user sets."""
    return _numbered(sets.select(F.explode("__set").alias("__c")).distinct())


def course_list(df: DataFrame, course: str) -> Catalogue:
    """The catalogue of the non-NULL courses of the rows."""
    return _numbered(df.select(F.col(course).cast("string").alias("__c")).filter("__c IS NOT NULL").distinct())


def _given(spark: SparkSession, sets: DataFrame, courses: Catalogue | Sequence[str] | None) -> Catalogue:
    if courses is None:
        return courses_of(sets)
    if isinstance(courses, Catalogue):
        return courses
    return _numbered(spark.createDataFrame([(c,) for c in courses], "__c string").distinct())


def positions_of(sets: DataFrame, user: str, courses: Catalogue, out: str = "combo",
                 with_rows: bool = False) -> DataFrame:
    """(user, sorted catalogue positions of the user's courses): the compact
    form of a course set used by the greedy loop (size = courses taken, not
    catalogue size), plus the user's row count ``__rows`` with ``with_rows``."""
    taken = sets.select(user, "__rows", F.explode_outer("__set").alias("__c"))
    taken = attach(taken, courses.table, ["__c"], known_max_rows=courses.bound)
    rows = [F.first("__rows").alias("__rows")] if with_rows else []
    return taken.groupBy(user).agg(F.array_sort(F.collect_list("__p")).alias(out), *rows)


def bitstring(positions: Column, n: int) -> Column:
    """The bitstring of a sorted position array (one character per catalogue course)."""
    # the one before is read from the array itself: an expression here is computed for each element
    ones = F.transform(positions, lambda p, i: F.concat(
        F.repeat(F.lit("0"), p - F.coalesce(F.get(positions, i - 1), F.lit(-1)) - 1), F.lit("1")))
    last = F.when(F.size(positions) > 0, F.element_at(positions, -1)).otherwise(F.lit(-1))
    return F.concat(F.array_join(ones, ""), F.repeat(F.lit("0"), F.lit(n - 1) - last))


def combos_of(sets: DataFrame, user: str, courses: Catalogue, out: str = "course_combo",
              with_rows: bool = False) -> DataFrame:
    """(user, bitstring) from the per-user sets: one character per catalogue course
    (plus the user's row count ``__rows`` with ``with_rows``)."""
    extra = ["__rows"] if with_rows else []
    placed = positions_of(sets, user, courses, "__at", with_rows)
    return placed.select(user, bitstring(F.col("__at"), courses.size).alias(out), *extra)


def course_combos(df: DataFrame, user: str, course: str, courses: Catalogue | Sequence[str] | None = None,
                  out: str = "course_combo") -> DataFrame:
    """(user, bitstring of the user's courses); NULL users are left out."""
    sets = user_course_sets(df, user, course)
    courses = _given(df.sparkSession, sets, courses)
    return combos_of(sets, user, courses, out)


def with_course_combo(df: DataFrame, user: str, course: str, courses: Catalogue | Sequence[str] | None = None,
                      out: str = "course_combo") -> DataFrame:
    """Rows with their user's bitstring (NULL user -> NULL bitstring)."""
    sets = user_course_sets(df, user, course)
    courses = _given(df.sparkSession, sets, courses)
    rows = attach(df.drop(out), positions_of(sets, user, courses, "__at", with_rows=True), [user], rows_col="__rows")
    return rows.withColumn(out, bitstring(F.col("__at"), courses.size)).drop("__at")


# U2 - U5 --------------------------------------------------------------------
def user_combos(df: DataFrame, user: str, records: str = "all", flag: str = "uniqUserFlag",
                combo: str = "course_combo") -> DataFrame:
    """Distinct (user, combo); ``records='True'``/``'False'`` keeps only flagged/unflagged rows."""
    scoped = df if records == "all" else df.filter(F.col(flag) == records)
    return scoped.filter(F.col(user).isNotNull()).select(user, combo).distinct()


def combo_counts(df: DataFrame, user: str, records: str = "all", flag: str = "uniqUserFlag",
                 combo: str = "course_combo") -> DataFrame:
    """(combo, n_users)."""
    return (user_combos(df, user, records, flag, combo).groupBy(combo)
            .agg(F.count(F.col(user)).alias("n_users")))


def combo_status(df: DataFrame, user: str, k: int, combo: str = "course_combo") -> DataFrame:
    """(combo, n_users, is_unique) with ``is_unique`` = fewer than k users."""
    return combo_counts(df, user, combo=combo).withColumn("is_unique", F.col("n_users") < k)


def unique_user_share(df: DataFrame, user: str, k: int, combo: str = "course_combo") -> DataFrame:
    """One row: share of users in rare combos, users, rare users, rare combos."""
    st = combo_status(df, user, k, combo)
    users = F.coalesce(F.sum("n_users"), F.lit(0))
    rare = F.coalesce(F.sum(F.when(F.col("is_unique"), F.col("n_users"))), F.lit(0))
    return st.agg(r6(F.when(users > 0, rare / users).otherwise(F.lit(0.0))).alias("unique_share"),
                  users.alias("users"), rare.alias("unique_users"),
                  F.count(F.when(F.col("is_unique"), 1)).alias("unique_combos"))


def flag_unique_users(df: DataFrame, user: str, k: int, flag: str = "uniqUserFlag",
                      combo: str = "course_combo", course: str | None = None) -> DataFrame:
    """``uniqUserFlag`` = ``'True'`` on rows whose combo has fewer than k users.

    With ``course`` given (and no combo column yet) the combos and flags are
    computed on the per-user table and joined to the rows once, adding both
    ``course_combo`` and the flag: two passes over the rows."""
    if combo not in df.columns:
        if course is None:
            raise ValueError(f"no {combo} column: pass course= to build it")
        sets = user_course_sets(df, user, course)
        courses = courses_of(sets)
        # sets travel as position arrays (as long as the courses taken); strings are built on the rows
        per_user = positions_of(sets, user, courses, "__at", with_rows=True)
        counts = per_user.groupBy("__at").agg(F.count(F.lit(1)).alias("__users"))
        status = counts.select("__at", (F.col("__users") < k).alias("__unique"), F.col("__users").alias("__n"))
        per_user = attach(per_user, status, ["__at"], rows_col="__n")
        per_user = per_user.select(
            user, "__at", "__rows",
            F.when(F.coalesce(F.col("__unique"), F.lit(False)), F.lit("True")).otherwise(F.lit("False")).alias(flag))
        rows = attach(df, per_user, [user], rows_col="__rows")
        return rows.select(*[c for c in df.columns if c != flag], bitstring(F.col("__at"), courses.size).alias(combo),
                           F.coalesce(F.col(flag), F.lit("False")).alias(flag))
    per_user = (df.filter(F.col(user).isNotNull()).groupBy(user, combo)
                .agg(F.count(F.lit(1)).alias("__r")))
    st = per_user.groupBy(combo).agg((F.count(F.lit(1)) < k).alias("is_unique"), F.sum("__r").alias("__rows"))
    out = attach(df, st, [combo], rows_col="__rows")
    return (out.withColumn(flag, F.when(F.coalesce(F.col("is_unique"), F.lit(False)), F.lit("True"))
                           .otherwise(F.lit("False"))).drop("is_unique"))


# U6 / U7 --------------------------------------------------------------------
def _state_counts(st: DataFrame) -> DataFrame:
    """(combo, n users) per current combo; users with no course left are gone."""
    return (st.filter(F.size("current") > 0).groupBy("current").agg(F.sum("n").alias("n"))
            .withColumnRenamed("current", "combo"))


@dataclass
class _Counts:
    """The users of each combo, kept, with what one pass over them tells."""

    table: DataFrame        # (combo, n)
    rare_users: int
    bound: int | None       # rows if the measured size allows a broadcast

    @classmethod
    def of(cls, counts: DataFrame, k: int) -> _Counts:
        kept = persisted(counts)
        rows, places, rare = kept.agg(F.count(F.lit(1)), F.sum(F.size("combo")),
                                      F.sum(F.when(F.col("n") < k, F.col("n")))).first()
        # a row of the hash table holds its combo as key and as value
        fits = rows <= joins.BROADCAST_MAX_ROWS and 200 * rows + 8 * (places or 0) <= COUNTS_BROADCAST_BYTES
        return cls(kept, rare or 0, rows if fits else None)


def _ranked(rows: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    return _numbered(rows, order, out).table


def score_drops(counts: DataFrame, k: int, n_comb: int = 1, shadow_k: bool = False,
                bound: int | None = None) -> DataFrame:
    """The terms (X, loss, n_change, n_rows, fresh) whose sums over the subsets of a candidate score it
    (see ``operators.drops``); ``counts``: (combo, n users), combos as sorted position arrays."""
    return D.summed(D.terms(counts.withColumn("sign", F.lit(1)), k, n_comb, shadow_k, bound=bound))


def best_drop(df: DataFrame, user: str, course: str, k: int, n_comb: int = 1,
              strategy: str = "single", shadow_k: bool = False,
              courses: Catalogue | Sequence[str] | None = None) -> DataFrame:
    """One scoring step on the current table: every candidate with
    (drop_courses, loss, n_change, chosen)."""
    sets = user_course_sets(df, user, course)
    courses = _given(df.sparkSession, sets, courses)
    combos = positions_of(sets, user, courses, "combo")
    counts = _Counts.of(combos.filter(F.size("combo") > 0).groupBy("combo").agg(F.count(F.lit(1)).alias("n")), k)
    scores, _ = keep(score_drops(counts.table, k, n_comb, shadow_k, counts.bound))
    best = D.best_set(scores, counts.rare_users, courses.size, n_comb, strategy == "multi", _ranked)
    chosen = F.lit(False) if best is None else (F.col("D") == F.lit(best["D"]).cast("array<int>"))
    listed = D.candidates(scores, counts.rare_users, courses.size, n_comb)
    named = attach(listed.select("*", F.explode("D").alias("__p")), courses.table, ["__p"],
                   known_max_rows=courses.bound)
    named = named.groupBy("D").agg(F.first("loss").alias("loss"), F.first("n_change").alias("n_change"),
                                   F.array_sort(F.collect_list("__c")).alias("__names"))
    return named.select(
        F.array_join("__names", ",").alias("drop_courses"),
        r6("loss").alias("loss"), F.col("n_change").cast("bigint").alias("n_change"),
        chosen.alias("chosen"))


# U8 - U11 -------------------------------------------------------------------
@dataclass
class UserKResult:
    rows: DataFrame          # rows after the drops, with course_combo and uniqUserFlag
    tally: DataFrame         # (course, rows_dropped)
    steps: list              # chosen drops: (courses, loss) per iteration
    state: DataFrame         # (origin, current, dropped, n) per original combo
    scored: list             # rows computed for each scoring


def _apply_to_state(st: DataFrame, counts: _Counts, positions: list[int], k: int, shadow_k: bool) -> DataFrame:
    d = F.lit(positions).cast("array<int>")
    safe = D.made_safe(counts.table, positions, k, shadow_k, counts.bound)
    acc = safe.select(F.col("combo").alias("current"), F.lit(True).alias("__acc"))
    j = attach(st, acc, ["current"], known_max_rows=counts.bound)
    hit = F.coalesce(F.col("__acc"), F.lit(False))
    # New values get fresh names first: a lambda inside the same select would
    # otherwise resolve ``current`` to the new alias (lateral column alias).
    out = j.select(
        "origin", "n", "rows",
        F.when(hit, F.array_except("current", d)).otherwise(F.col("current")).alias("__cur"),
        F.when(hit, F.array_sort(F.array_union("dropped", F.array_intersect("current", d))))
        .otherwise(F.col("dropped")).alias("__drp"))
    return out.select("origin", F.col("__cur").alias("current"), F.col("__drp").alias("dropped"), "n", "rows")


def apply_state(df: DataFrame, user: str, course: str, courses: Catalogue, state: DataFrame,
                k: int, weight: str | None = "Count", flag: str = "uniqUserFlag",
                combo: str = "course_combo", sets: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Delete the dropped (user, course) rows and flag users still rare.

    Returns (rows, tally).  Rows keep their user's current combo.  What a user
    loses is settled on the table of original combos, brought to the users, and
    joined to the rows once."""
    sets = sets if sets is not None else user_course_sets(df, user, course)
    rare = _state_counts(state).filter(F.col("n") < k).select(F.col("combo").alias("current"),
                                                              F.lit(True).alias("__rare"))
    st = attach(state, rare, ["current"]).select("*", F.explode_outer("dropped").alias("__p"))
    st = attach(st, courses.table, ["__p"], known_max_rows=courses.bound).groupBy("origin").agg(
        F.first("current").alias("current"), F.first("__rare").alias("__rare"), F.first("n").alias("__users"),
        F.collect_list("__c").alias("__dropped"))
    st = st.select(F.col("origin").alias("__origin"), "__users", "__dropped",
                   F.col("current").alias("__at"),
                   F.when(F.col("__rare"), F.lit("True")).otherwise(F.lit("False")).alias(flag))
    users = attach(positions_of(sets, user, courses, "__origin", with_rows=True), st, ["__origin"],
                   rows_col="__users").drop("__origin")
    rows = attach(df.drop(combo), users, [user], rows_col="__rows")
    gone = F.array_contains("__dropped", F.col(course).cast("string"))
    rows = rows.withColumn("__gone", F.coalesce(gone, F.lit(False))).drop("__dropped")
    tally = (rows.filter("__gone").groupBy(F.col(course).alias(course))
             .agg(F.sum(weight_col(rows, weight)).alias("rows_dropped")))
    kept = rows.filter(~F.col("__gone")).withColumn(flag, F.coalesce(F.col(flag), F.lit("False")))
    return kept.withColumn(combo, bitstring(F.col("__at"), courses.size)).drop("__gone", "__at"), tally


def initial_state(sets: DataFrame, user: str, courses: Catalogue) -> DataFrame:
    """(origin, current, dropped, n, rows): users and their rows per original
    course set (sorted position arrays)."""
    combos = positions_of(sets, user, courses, "origin", with_rows=True)
    return (combos.groupBy("origin").agg(F.count(F.lit(1)).alias("n"), F.sum("__rows").alias("rows"))
            .select("origin", F.col("origin").alias("current"), F.array().cast("array<int>").alias("dropped"),
                    "n", "rows"))


def apply_drops(df: DataFrame, user: str, course: str, k: int, n_comb: int = 1,
                strategy: str = "single", shadow_k: bool = False,
                weight: str | None = "Count") -> tuple[DataFrame, DataFrame]:
    """One greedy step (U6/U7 choice, then U8): (remaining rows, tally per course)."""
    sets = user_course_sets(df, user, course)
    courses = courses_of(sets)
    st = cut_lineage(initial_state(sets, user, courses))
    counts = _Counts.of(_state_counts(st), k)
    scores, _ = keep(score_drops(counts.table, k, n_comb, shadow_k, counts.bound))
    best = D.best_set(scores, counts.rare_users, courses.size, n_comb, strategy == "multi", _ranked)
    if best is not None:
        st = _apply_to_state(st, counts, list(best["D"]), k, shadow_k)
    return apply_state(df, user, course, courses, st, k, weight, sets=sets)


def user_k_anonymity(df: DataFrame, user: str, course: str, k: int, strategy: str = "multi",
                     max_comb: int = 1, shadow_k: bool = False, weight: str | None = "Count",
                     max_steps: int | None = None) -> UserKResult:
    """Greedy repair until no combo is rare or no drop helps.

    ``strategy='single'``: least-loss single course (U9).  ``'multi'``: only
    strictly positive loss, and when no set of ``n`` courses helps, sets of
    ``n + 1`` are tried up to ``max_comb`` (1 = the reference run).
    Rows of users still rare afterwards are flagged, not deleted (see
    ``suppress_unique_users``).

    The score terms are kept from step to step: a drop computes again only the
    groups next to combos whose users changed (``scored`` has the rows computed
    for each scoring).  State and terms are cut from their lineage by a
    checkpoint in the shared folder at every step."""
    sets = user_course_sets(df, user, course)
    courses = courses_of(sets)
    st = cut_lineage(initial_state(sets, user, courses))
    counts = _Counts.of(_state_counts(st), k)
    n_comb, chosen, scored, scores = 1, [], [], None
    while counts.rare_users and (max_steps is None or len(chosen) < max_steps):
        if scores is None:
            scores = cut_lineage(score_drops(counts.table, k, n_comb, shadow_k, counts.bound))
            scored.append(scores.agg(F.sum("fresh")).first()[0])
        best = D.best_set(scores, counts.rare_users, courses.size, n_comb, strategy == "multi", _ranked)
        if best is None:
            if strategy != "multi" or n_comb >= max_comb:
                break
            n_comb, scores = n_comb + 1, None
            continue
        # both tables are cut at every step: each is read several times by the next one's plan
        st = cut_lineage(_apply_to_state(st, counts, list(best["D"]), k, shadow_k))
        after = _Counts.of(_state_counts(st), k)
        chosen.append((list(best["D"]), float(best["loss"])))
        if after.rare_users:
            bound = None if counts.bound is None or after.bound is None else counts.bound + after.bound
            later, held = D.updated(scores, counts.table, after.table, k, n_comb, shadow_k, bound)
            scores = cut_lineage(later)
            scored.append(scores.agg(F.sum("fresh")).first()[0])
            for frame in held:
                frame.unpersist()
        counts.table.unpersist()
        counts = after
    names = {r["__p"]: r["__c"] for r in courses.table.filter(
        F.col("__p").isin(sorted({p for d, _ in chosen for p in d}))).collect()} if chosen else {}
    steps = [([names[p] for p in d], loss) for d, loss in chosen]
    rows, tally = apply_state(df, user, course, courses, st, k, weight, sets=sets)
    return UserKResult(rows=rows, tally=tally, steps=steps, state=st, scored=scored)
