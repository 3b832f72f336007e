"""Scores of course drops on a subset lattice (U6, U7) and their upkeep in the greedy loop.

Combos are sorted position arrays.  Dropping the set D turns a rare combo S
that meets D into the group g = S - D.  With A_g the rare users that arrive at
g and n_g those already there, ``loss(D) = sum_g [f(A_g + n_g) - f(n_g)] -
sum f(n_S)`` over the rare combos S that meet D, with ``f(x) = x log2 x``,
divided by the number of rare users; ``n_change`` counts the combos made safe.

No candidate set is formed to compute this.  Every measure of D is a sum of
terms of the subsets X of D, ``loss(D) = sum over X of term(X)``, and the terms
come from the subsets of each combo's own set:

* S reaches g = S - T by each of its subsets T of at most ``n_comb`` courses.
  Where one T reaches g, the term of g is f(n + n_g) - f(n_g) - f(n).
* Where several T reach g, a set U that holds more than one of them gets the
  Moebius correction of the joint count (inclusion-exclusion over the subsets
  of U).
* g counts for D only if D has no course of g: each W, a subset of g, takes the
  term of g back from U + W with sign (-1)^|W|.

So rows depend on the courses that users took, not on the catalogue.  A sum of
terms is kept up to date after a drop: only the groups next to a changed combo
are computed again, once with the old and once with the new counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shroud.functions.joins import attach, sized

LOSS_EPS = 1e-9
# Up to so many courses all pairs are listed, above the best pair is found without (same result).
LIST_POSITIONS = 64


def flx(x: str) -> str:
    """x * log2(x) as SQL, 0 for x = 0."""
    return f"(CASE WHEN {x} > 0 THEN {x} * log2(CAST({x} AS DOUBLE)) ELSE 0D END)"


def subsets(items: Column, most: int) -> Column:
    """The sorted subsets of 1 to ``most`` items of a sorted array."""
    last = F.transform(items, lambda x: F.array(x))
    found = [last]
    for _ in range(most - 1):
        last = F.flatten(F.transform(last, lambda t: F.transform(
            F.filter(items, lambda x: x > F.element_at(t, -1)), lambda x: F.concat(t, F.array(x)))))
        found.append(last)
    return F.concat(*found) if len(found) > 1 else last


def _joint(n_comb: int, k: int, shadow_k: bool) -> tuple[str, str]:
    """SQL of (loss, n_change): the joint measures of every subset v of U, alternately added and taken away."""
    loss, change = [], []
    for size in range(1, n_comb + 1):
        terms_l, terms_c = [], []
        for v in range(1, 1 << size):
            inside = [m for m in range(1, v + 1) if m & v == m]
            arrived = "(" + " + ".join(["n_g"] + [f"coalesce(n{m}, 0L)" for m in inside]) + ")"
            sign = "+" if (size - v.bit_count()) % 2 == 0 else "-"
            terms_l.append(f"{sign} ({flx(arrived)} - {flx('n_g')})")
            for m in inside:
                enough = f"{arrived} >= {m.bit_count() - 1 if shadow_k else int(k)}"
                terms_c.append(f"{sign} if(n{m} IS NOT NULL AND (g_safe OR {enough}), 1L, 0L)")
        loss.append(f"WHEN {size} THEN 0D {' '.join(terms_l)}")
        change.append(f"WHEN {size} THEN 0L {' '.join(terms_c)}")
    return tuple(f"CASE size(U) {' '.join(whens)} END" for whens in (loss, change))


def terms(counts: DataFrame, k: int, n_comb: int = 1, shadow_k: bool = False, groups: DataFrame | None = None,
          changed: DataFrame | None = None, bound: int | None = None) -> DataFrame:
    """(X, loss, n_change, n_rows) contributions, several rows for each X.

    ``counts``: (combo, n, sign) of all users; sign 1 adds the terms of these
    counts, -1 takes them away, so that two states are worked through at once.
    ``groups`` (g) and ``changed`` (combo) restrict the work to these groups and
    combos; ``bound``: rows of ``counts`` if its measured size allows a
    broadcast.  ``loss`` isn't divided by the number of rare users."""
    rare = counts.filter(F.col("n") < k).select("combo", "n", "sign")
    own = subsets(F.col("combo"), n_comb)
    reach = rare.select("sign", "combo", "n", F.explode(own).alias("T"))
    reach = reach.select("sign", F.array_except("combo", "T").alias("g"), "T", "n")
    paid = rare if changed is None else rare.join(changed, "combo", "left_semi")
    paid = paid.select("sign", "n", F.explode(own).alias("X")).select(
        "X", (F.expr(flx("n")) * F.when(F.size("X") % 2 == 1, -1.0).otherwise(1.0) * F.col("sign")).alias("loss"),
        F.lit(0).cast("bigint").alias("n_change"), F.col("sign").cast("bigint").alias("n_rows"))
    if groups is not None:
        reach = reach.join(groups, "g", "left_semi")
    known = counts.select("sign", F.col("combo").alias("g"), (F.col("n") >= k).alias("g_safe"),
                          F.when(F.col("n") < k, F.col("n")).otherwise(F.lit(0)).alias("n_g"))
    # the counts of a group join what reaches it before that is combined; the joins and groups below then
    # find their rows in place
    reach = reach.join(known if bound is None else F.broadcast(known), ["sign", "g"], "left").select(
        "sign", "g", "T", "n", F.coalesce("n_g", F.lit(0)).cast("bigint").alias("n_g"),
        F.coalesce("g_safe", F.lit(False)).alias("g_safe"))
    # (U, T): every T that reaches g with every union U of sets that do, itself among them; T comes first and
    # each further set adds some course
    parts = last = reach.withColumn("U", F.col("T"))
    for _ in range(n_comb - 1):
        other = reach.select("sign", "g", F.col("T").alias("more"))
        last = last.filter(F.size("U") < n_comb).join(other, ["sign", "g"]).withColumn(
            "both", F.array_sort(F.array_union("U", "more")))
        last = last.filter((F.size("both") > F.size("U")) & (F.size("both") <= n_comb)).select(
            "sign", "g", "T", "n", "n_g", "g_safe", F.col("both").alias("U"))
        parts = parts.unionByName(last)
    # n1, n2, ...: the users that arrive by the subset of U with this mask, NULL if none does
    mask = F.lit(0)
    for i in range(n_comb):
        mask = mask + F.when(F.array_contains("T", F.get("U", F.lit(i))), 1 << i).otherwise(0)
    by_mask = [F.max(F.when(F.col("mask") == m, F.col("n"))).cast("bigint").alias(f"n{m}") for m in range(1, 1 << n_comb)]
    sets = parts.withColumn("mask", mask).groupBy("sign", "g", "U").agg(
        F.max("n_g").alias("n_g"), F.max("g_safe").alias("g_safe"), *by_mask)
    loss, change = _joint(n_comb, k, shadow_k)
    sets = sets.select("sign", "g", "U", F.expr(loss).alias("loss"), F.expr(change).alias("n_change"))
    # each set U, and U + W taken back, from one pass
    away = F.array(F.array().cast("array<int>"))
    if n_comb > 1:
        room = F.filter(subsets(F.col("g"), n_comb - 1), lambda w: F.size(w) + F.size("U") <= n_comb)
        away = F.when(F.size("U") < n_comb, F.concat(away, room)).otherwise(away)
    sets = sets.select("sign", "U", "loss", "n_change", F.explode(away).alias("W"))
    sign = F.col("sign") * F.when(F.size("W") % 2 == 1, -1).otherwise(1)
    return paid.unionByName(sets.select(
        F.array_sort(F.concat("U", "W")).alias("X"), (F.col("loss") * sign).alias("loss"),
        (F.col("n_change") * sign).cast("bigint").alias("n_change"), F.col("sign").cast("bigint").alias("n_rows")))


def summed(contributions: DataFrame) -> DataFrame:
    """One row for each X: its term, the contributions that it has (``n_rows``; without any it is no
    candidate) and those that were added or taken away just now (``fresh``)."""
    fresh = F.col("fresh") if "fresh" in contributions.columns else F.lit(1)
    return contributions.groupBy("X").agg(
        F.sum("loss").alias("loss"), F.sum("n_change").cast("bigint").alias("n_change"),
        F.sum("n_rows").cast("bigint").alias("n_rows"), F.sum(fresh).cast("bigint").alias("fresh"))


def updated(scores: DataFrame, before: DataFrame, after: DataFrame, k: int, n_comb: int, shadow_k: bool,
            bound: int | None) -> tuple[DataFrame, list[DataFrame]]:
    """The terms after the counts (combo, n) have changed from ``before`` to ``after``, and the kept
    tables that they read.  ``bound``: rows of both if their measured size allows a broadcast."""
    both = (after.select("combo", "n", F.lit(1).alias("sign"))
            .unionByName(before.select("combo", "n", F.lit(-1).alias("sign"))))
    moved = both.groupBy("combo").agg(F.sum(F.col("n") * F.col("sign")).alias("more")).filter("more <> 0").select("combo")
    moved, _, small = sized(moved)
    near = F.concat(F.array("combo"), F.transform(subsets(F.col("combo"), n_comb),
                                                  lambda t: F.array_except("combo", t)))
    groups, _, few = sized(moved.select(F.explode(near).alias("g")).distinct())
    fresh = terms(both, k, n_comb, shadow_k, F.broadcast(groups) if few else groups,
                  F.broadcast(moved) if small else moved, bound)
    kept = scores.filter("n_rows <> 0").withColumn("fresh", F.lit(0))
    return summed(kept.unionByName(fresh.withColumn("fresh", F.lit(1)))), [moved, groups]


def candidates(scores: DataFrame, total: int, n_positions: int, n_comb: int) -> DataFrame:
    """(D, loss, n_change) of every set of ``n_comb`` positions that meets a rare combo.

    This is the full report: its rows are the sets, so they grow with the catalogue."""
    scores = scores.filter("n_rows <> 0")
    single = scores.filter("size(X) = 1")
    if n_comb == 1:
        return single.select(F.col("X").alias("D"), (F.col("loss") / total).alias("loss"), "n_change")
    sets = single.select(F.col("X").alias("D"), F.lit(-1).alias("last"))
    for _ in range(n_comb - 1):
        sets = sets.select("D", F.explode(F.filter(
            F.sequence(F.lit(0), F.lit(max(n_positions - 1, 0))),
            lambda j: (j > F.col("last")) & ~F.array_contains("D", j))).alias("next"))
        sets = sets.select(F.concat("D", F.array("next")).alias("D"), F.col("next").alias("last"))
    sets = sets.select(F.array_sort("D").alias("D")).distinct()
    parts = sets.select("D", F.explode(subsets(F.col("D"), n_comb)).alias("X")).join(scores, "X")
    return parts.groupBy("D").agg((F.sum("loss") / total).alias("loss"), F.sum("n_change").alias("n_change"))


def _best_of(found: DataFrame, positive: bool):
    ok = found.filter(F.col("n_change") > 0)
    if positive:
        ok = ok.filter(F.col("loss") > LOSS_EPS)
    best = ok.orderBy(F.round("loss", 9), "D").limit(1).collect()
    return best[0] if best else None


def best_set(scores: DataFrame, total: int, n_positions: int, n_comb: int, positive: bool, numbered):
    """The candidate with the least loss that makes some combo safe (ties: first position set), or None.

    ``positive`` also asks for a loss above 0.  Pairs are found without listing
    them: a pair with a term of its own is scored from it; any other pair costs
    the sum of its courses, so a course that makes a combo safe takes the
    cheapest partner with which it has no common term.  ``numbered`` numbers a
    table's rows in the order of columns.  Sets of three and more, and pairs of
    up to ``LIST_POSITIONS`` courses, are listed."""
    if n_comb != 2 or n_positions <= LIST_POSITIONS:
        return _best_of(candidates(scores, total, n_positions, n_comb), positive)
    scores = scores.filter("n_rows <> 0")
    single = scores.filter("size(X) = 1").select(F.col("X")[0].alias("p"), "loss", "n_change")
    spark = scores.sparkSession
    # a course of no rare combo costs nothing; the first one stands for all
    idle = (spark.range(n_positions).select(F.col("id").cast("int").alias("p")).join(single, "p", "left_anti")
            .agg(F.min("p").alias("p")).filter("p IS NOT NULL")
            .select("p", F.lit(0.0).alias("loss"), F.lit(0).cast("bigint").alias("n_change")))
    single = numbered(single.unionByName(idle).select(
        (F.round(F.col("loss") / total, 9) + 0.0).alias("price"), "p", "loss", "n_change"), ["price", "p"], "rank")
    # a loss that is not positive needs a partner that is
    free = single.filter(F.col("loss") / total <= LOSS_EPS).count() if positive else 0
    pairs = scores.filter("size(X) = 2").select(F.col("X")[0].alias("a"), F.col("X")[1].alias("b"), "loss", "n_change")
    a, b = (single.select(F.col("p").alias(n), F.col("loss").alias(f"loss_{n}"), F.col("n_change").alias(f"n_{n}"),
                          F.col("rank").alias(f"rank_{n}")) for n in "ab")
    met = pairs.join(a, "a").join(b, "b")
    joint = met.select(F.array("a", "b").alias("D"), ((F.col("loss") + F.col("loss_a") + F.col("loss_b")) / total).alias("loss"),
                       (F.col("n_change") + F.col("n_a") + F.col("n_b")).alias("n_change"))
    useful = a.filter("n_a > 0").withColumn(
        "from", F.when(F.col("loss_a") / total > LOSS_EPS, 0).otherwise(free) if positive else F.lit(0))
    barred = met.select("a", F.col("rank_b").alias("rank")).unionByName(
        met.select(F.col("b").alias("a"), F.col("rank_a").alias("rank"))).unionByName(
        a.select("a", F.col("rank_a").alias("rank")))
    barred = useful.select("a", "from").join(barred, "a").filter(F.col("rank") >= F.col("from"))
    place = F.row_number().over(Window.partitionBy("a").orderBy("rank")) - 1 + F.col("from")
    barred = barred.withColumn("place", place)
    first = barred.groupBy("a").agg(F.min(F.when(F.col("rank") != F.col("place"), F.col("place"))).alias("gap"),
                                    F.max("place").alias("most"))
    partner = useful.join(first, "a", "left").select(
        "a", "loss_a", "n_a", F.coalesce("gap", F.col("most") + 1, F.col("from")).alias("rank_b"))
    apart = partner.join(b, "rank_b").select(
        F.array_sort(F.array("a", "b")).alias("D"), ((F.col("loss_a") + F.col("loss_b")) / total).alias("loss"),
        (F.col("n_a") + F.col("n_b")).alias("n_change"))
    return _best_of(joint.unionByName(apart), positive)


def made_safe(counts: DataFrame, positions: list[int], k: int, shadow_k: bool = False,
              bound: int | None = None) -> DataFrame:
    """(combo) of the rare combos that dropping ``positions`` makes safe: the group after the drop has at
    least k rare users (``hits - 1`` with ``shadow_k``, the reference's shadowed k) or is a safe combo."""
    d = F.lit(positions).cast("array<int>")
    met = counts.filter((F.col("n") < k) & F.arrays_overlap("combo", d)).select(
        "combo", "n", F.array_except("combo", d).alias("g"), F.size(F.array_intersect("combo", d)).alias("hits"))
    groups = met.groupBy("g").agg(F.sum("n").alias("arrived"), F.count(F.lit(1)).alias("__rows"))
    known = counts.select(F.col("combo").alias("g"), F.col("n").alias("n_g"))
    groups = attach(groups, known, ["g"], known_max_rows=bound)
    # a safe combo has k users at least, so it passes either test
    groups = groups.select("g", "__rows", (F.col("arrived") + F.coalesce("n_g", F.lit(0))).alias("post"),
                           (F.coalesce("n_g", F.lit(0)) >= k).alias("g_safe"))
    need = (F.col("hits") - 1) if shadow_k else F.lit(k)
    joined = attach(met, groups, ["g"], known_max_rows=bound, rows_col="__rows")
    return joined.filter((F.col("post") >= need) | F.col("g_safe")).select("combo")
