"""Drop scores from the subset lattice against scoring every candidate set from scratch."""

import math
import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from shroud.operators import drops as D
from shroud.operators import users as U

COURSES = 7


def _f(x):
    return x * math.log2(x) if x else 0.0


def _brute(counts, k, n_comb, shadow_k):
    """(loss, n_change) of every set that meets a rare combo."""
    rare = {c: n for c, n in counts.items() if n < k}
    total, out = sum(rare.values()), {}
    for d in combinations(range(COURSES), n_comb):
        cut = {c: tuple(x for x in c if x not in d) for c in rare if set(c) & set(d)}
        if not cut:
            continue
        post = Counter()
        for c, n in rare.items():
            post[cut.get(c, c)] += n
        loss = sum(_f(post[g]) for g in post) - sum(_f(n) for n in rare.values())
        change = sum(post[g] >= (len(set(c) & set(d)) - 1 if shadow_k else k) or counts.get(g, 0) >= k
                     for c, g in cut.items())
        out[d] = (loss / total, change)
    return out


def _counts(seed, combos, k):
    rng = random.Random(seed)
    found = {}
    for _ in range(combos):
        c = tuple(sorted(rng.sample(range(COURSES), rng.randint(1, 4))))
        found[c] = rng.choice([1, 1, 2, k - 1, k, 3 * k])
    return found


def _table(spark, counts):
    return spark.createDataFrame([(list(c), n) for c, n in counts.items()], "combo array<int>, n bigint")


@pytest.mark.parametrize("n_comb,shadow_k,seed", [(1, False, 1), (2, False, 2), (2, True, 3), (3, False, 4)])
def test_every_candidate_equals_brute_force(spark, n_comb, shadow_k, seed):
    counts = _counts(seed, 45, 4)
    scores = U.score_drops(_table(spark, counts), 4, n_comb, shadow_k).persist()
    want = _brute(counts, 4, n_comb, shadow_k)
    total = sum(n for n in counts.values() if n < 4)
    got = {tuple(r.D): (r.loss, r.n_change) for r in D.candidates(scores, total, COURSES, n_comb).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[d][0] - want[d][0]) < 1e-9 and got[d][1] == want[d][1] for d in want)


@pytest.mark.parametrize("seed,combos", [(5, 6), (6, 14), (9, 10)])
def test_best_pair_without_a_list(spark, monkeypatch, seed, combos):
    counts = _counts(seed, combos, 3)
    total = sum(n for n in counts.values() if n < 3)
    scores = U.cut_lineage(U.score_drops(_table(spark, counts), 3, 2))
    want = _brute(counts, 3, 2, False)
    monkeypatch.setattr(D, "LIST_POSITIONS", 0)
    for positive in (False, True):
        ok = [(round(loss, 9), d) for d, (loss, change) in want.items() if change and (not positive or loss > 1e-9)]
        best = D.best_set(scores, total, COURSES, 2, positive, U._ranked)
        assert (None if best is None else tuple(best["D"])) == (min(ok)[1] if ok else None)
    # the catalogue's size is no size of the work: courses of no rare combo cost nothing
    some = any(change for _, change in want.values())
    assert (D.best_set(scores, total, 10_000_000, 2, False, U._ranked) is not None) == some


def test_rows_do_not_depend_on_the_catalogue(spark):
    one = _table(spark, {(3, 150): 1}).withColumn("sign", F.lit(1))
    assert [D.terms(one, 2, n).count() for n in (1, 2, 3)] == [4, 8, 8]


@pytest.mark.parametrize("n_comb", [1, 2])
def test_kept_terms_equal_terms_from_scratch(spark, n_comb):
    before = _counts(8, 40, 4)
    after = dict(before)
    for c in list(after)[:4]:
        after[c[:-1] or (6,)] = after.get(c[:-1] or (6,), 0) + after.pop(c)
    a, b = _table(spark, before), _table(spark, after)
    later, _ = D.updated(U.score_drops(a, 4, n_comb), a, b, 4, n_comb, False, None)
    got = {tuple(r.X): r for r in later.filter("n_rows <> 0").collect()}
    want = {tuple(r.X): r for r in U.score_drops(b, 4, n_comb).collect()}
    assert got.keys() == want.keys()
    for x, r in want.items():
        assert abs(got[x].loss - r.loss) < 1e-9 and (got[x].n_change, got[x].n_rows) == (r.n_change, r.n_rows)
    # only groups next to a change were computed again
    assert 0 < sum(r.fresh for r in got.values()) < 2 * sum(r.n_rows for r in want.values())


def test_many_combos_are_not_held_by_the_driver(spark):
    counts = spark.range(100_000).select(
        F.transform(F.sequence(F.lit(0), F.lit(6)), lambda i: (F.col("id") + i).cast("int")).alias("combo"),
        F.lit(1).cast("bigint").alias("n"))
    kept = U._Counts.of(counts, 5)
    assert (kept.rare_users, kept.bound) == (100_000, None)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scores = U.score_drops(kept.table.limit(100), 5, 2, bound=kept.bound)
        plan = scores._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        kept.table.unpersist()
    # no table of all combos is built whole, and groups are combined in memory that can spill
    assert "Broadcast" not in plan and "ObjectHashAggregate" not in plan
