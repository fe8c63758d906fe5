from itertools import permutations
from math import comb

import numpy as np
import pytest
from pyspark.sql import functions as F

from lagweave.functions import maths as M
from lagweave.operators import coexpression as X
from lagweave.operators import learning as L
from lagweave.operators import profiles as P
from lagweave.operators import relational as R
from lagweave.operators import sequences as Q
from lagweave.operators import timewarp as T


def test_false_discovery(spark):
    df = spark.createDataFrame([(1, 0.005), (2, 0.01), (3, 0.03), (4, 0.04), (5, None)], "i int, p double")
    got = {r.i: r.fdr for r in R.false_discovery(df).collect()}
    assert [round(got[k], 9) for k in (1, 2, 3, 4)] == [0.02, 0.02, 0.04, 0.04] and got[5] is None


def test_hypergeometric_and_fisher(spark):
    df = spark.createDataFrame([(3, 10, 20, 8)], "q long, m long, n long, k long")
    exact = sum(comb(10, i) * comb(20, 8 - i) for i in range(3, 9)) / comb(30, 8)
    assert df.select(M.hypergeometric_tail(*(F.col(c) for c in "qmnk"))).first()[0] == pytest.approx(exact, rel=1e-9)
    t = spark.createDataFrame([(3, 5, 7, 15)], "a long, b long, c long, d long")
    probs = [comb(10, i) * comb(20, 8 - i) / comb(30, 8) for i in range(9)]
    assert t.select(M.fisher_two_sided(*(F.col(c) for c in "abcd"))).first()[0] == pytest.approx(sum(p for p in probs if p <= probs[3] * (1 + 1e-7)), rel=1e-9)


def test_t_tail(spark):
    p = spark.createDataFrame([(0.0,), (2.0,), (-2.0,)], "t double").select(M.t_two_sided(F.col("t"), 4)).collect()
    assert p[0][0] == pytest.approx(1.0) and p[1][0] == pytest.approx(0.116116523, rel=1e-6) and p[1][0] == p[2][0]


def test_average_rank_with_ties(spark):
    df = spark.createDataFrame([("g", 1.0), ("g", 2.0), ("g", 2.0), ("g", 5.0)], "g string, v double")
    assert sorted(r[0] for r in df.select(R.average_rank("v", ["g"])).collect()) == [1, 2.5, 2.5, 4]


def test_classes_are_total_and_disjoint(spark):
    rows = [(w, m, d, l) for w in (True, False) for m in (True, False) for d in (True, False) for l in (True, False)]
    df = spark.createDataFrame(rows, "w boolean, m boolean, d boolean, l boolean")
    got = {tuple(r)[:4]: r.c for r in df.withColumn("c", X.edge_class(F.col("w"), F.col("m"), F.col("d"), F.col("l"))).collect()}
    assert set(got.values()) <= set(X.CLASSES) and got[True, False, True, False] == "Lost" and got[True, True, False, True] == "Conserved"


def plain_warp(x, y, band):
    n, m = len(x), len(y)
    d = np.full((n + 1, m + 1), np.inf)
    d[0, 0] = 0
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            if band is None or abs(j - round(i * m / n)) <= band:
                d[i, j] = (x[i - 1] - y[j - 1]) ** 2 + min(d[i - 1, j], d[i, j - 1], d[i - 1, j - 1])
    i, j, path = n, m, [(n - 1, m - 1)]
    while (i, j) != (1, 1):
        i, j = min([p for p in ((i - 1, j), (i, j - 1), (i - 1, j - 1)) if min(p) >= 1], key=lambda p: d[p])
        path.append((i - 1, j - 1))
    return float(np.sqrt(d[n, m])), path


@pytest.mark.parametrize("n, m, band", [(9, 9, None), (7, 11, None), (12, 12, 2), (1, 5, None), (4, 1, None), (8, 8, 0)])
def test_warp_against_the_plain_recurrence(n, m, band):
    draw = np.random.default_rng(5)
    a, b = np.round(draw.normal(size=(20, n)), 1), np.round(draw.normal(size=(20, m)), 1)  # rounded, so that sums tie
    distance, i, j = T.warp(a, b, band)
    for k in range(20):
        want, path = plain_warp(a[k], b[k], band)
        assert distance[k] == pytest.approx(want) and [(x, y) for x, y in zip(i[k].tolist(), j[k].tolist(), strict=True) if x >= 0] == path


def test_compare_against_a_plain_version():
    draw, times = np.random.default_rng(6), np.array([0.0, 1, 2, 4, 7])
    a, b = draw.normal(size=(6, 5)), draw.normal(size=(6, 5))
    a[5] = b[5] = [0, 1, 3, 1, 0]
    got, grid = T.compare(a, b, times), np.linspace(0, 7, 100)
    for k in range(6):
        da, db = (np.gradient(T.natural_spline(times, v[k], grid), grid) for v in (a, b))
        d, path = plain_warp(da, db, None)
        ra, rb, mean = np.ptp(a[k]), np.ptp(b[k]), np.mean([abs(i - j) for i, j in path])
        want = min(1, d / np.sqrt(len(path)) / (max(np.ptp(da), np.ptp(db)) + 1e-6)), abs(ra - rb) / (ra + rb), min(1, mean / 50)
        assert [got[c][k] for c in ("shape", "amp", "phase")] == pytest.approx(want) and got["cost"][k] == pytest.approx(np.dot(want, (0.5, 0.3, 0.2)))
        assert got["distance"][k] == pytest.approx(d) and got["path_length"][k] == len(path) and got["max_deviation"][k] == max(abs(i - j) for i, j in path)
        assert got["pearson_r"][k] == pytest.approx(np.corrcoef(a[k], b[k])[0, 1]) and got["deriv_r"][k] == pytest.approx(np.corrcoef(da, db)[0, 1])
    assert got["cost"][5] < 1e-9


def test_costs_of_odd_pairs(spark):
    t = [0.0, 1.0, 2.0]
    rows = [(1, 1, t, [0.0, 1.0, 0.0], [0.0, 2.0, 0.0]), (1, 2, t, None, [0.0, 1.0, 0.0]), (1, 3, t, [0.0, None, 1.0], t), (1, 4, t, [1.0, 1.0, 1.0], t), (1, 5, t, [1.0, 2.0], t), (2, 1, [0.0, 2.0], [0.0, 1.0], [0.0, 1.0])]
    got = {(r.wt, r.mut): r for r in T.centre_costs(spark.createDataFrame(rows, "wt int, mut int, times array<double>, a array<double>, b array<double>")).collect()}
    assert got[1, 1].amp == pytest.approx(1 / 3) and got[1, 1].pearson_r == pytest.approx(1.0)
    assert got[2, 1].shape == pytest.approx(0, abs=1e-9) and got[2, 1].amp == 0 and got[2, 1].deriv_r is None
    assert all(got[1, k].cost is None and got[1, k].path_length is None for k in (2, 3, 5))
    assert got[1, 4].pearson_r is None and got[1, 4].deriv_r is None and got[1, 4].cost is not None


def test_smoothing_is_local_or_a_line():
    x, y = np.arange(15.0), np.random.default_rng(2).normal(size=15)
    got = T.loess(x, y, np.array([7.25]))[0]
    near = np.sort(np.abs(x - 7.25))[5]
    w = np.clip(1 - (np.abs(x - 7.25) / near) ** 3, 0, None) ** 3
    assert got == pytest.approx(np.polyval(np.polyfit(x, y, 2, w=np.sqrt(w)), 7.25))
    assert T.loess(np.arange(7.0), y[:7], np.array([2.5]))[0] == pytest.approx((y[2] + y[3]) / 2)  # two points of seven give no parabola


def test_assignment_against_all_permutations():
    draw = np.random.default_rng(3)
    for n, m in ((3, 3), (4, 5), (5, 3), (1, 4)):
        c = draw.random((n, m))
        got = sum(c[i, j] for i, j in T.assignment(c))
        a = c if n <= m else c.T
        assert got == pytest.approx(min(sum(a[i, p[i]] for i in range(len(a))) for p in permutations(range(a.shape[1]), len(a))))


def test_spline_goes_through_its_points():
    x, y = np.arange(6.0), np.array([0, 2, 1, 3, 5, 4.0])
    assert np.allclose(T.natural_spline(x, y, x), y)


def test_loess_keeps_a_line():
    x = np.arange(7.0)
    assert np.allclose(T.loess(x, 2 * x + 1, np.linspace(0, 6, 13)), 2 * np.linspace(0, 6, 13) + 1, atol=1e-6)


def test_memberships_add_up(spark):
    rows = [(g, "WT", t, float((hash((g, t)) % 97) / 10)) for g in "abcdef" for t in range(7)]
    z = P.standardised(P.profiles(spark.createDataFrame(rows, "gene string, cond string, time int, value double")))
    centres = z.filter("gene IN ('a', 'b')").select("cond", (F.col("gene") == "b").cast("int").alias("cluster"), "time", F.col("z").alias("centre"))
    m, _ = P.fuzzy_cmeans(z, centres, rounds=2)
    assert all(abs(r[1] - 1) < 1e-5 for r in m.groupBy("gene").agg(F.sum("membership")).collect())


def test_auc(spark):
    df = spark.createDataFrame([(True, 3.0), (True, 2.0), (False, 1.0), (False, 2.0)], "positive boolean, score double")
    assert L.auc(df).first().auc == 0.875


def test_near_kmers_against_all_pairs(spark):
    draw = np.random.default_rng(1)
    words = ["".join(draw.choice(list("ACGT"), 6)) for _ in range(60)]
    got = {(r.a, r.b): r.distance for r in Q.near_kmers(spark.createDataFrame([("g", w) for w in words], "group string, kmer string")).collect()}
    want = {(a, b): d for a in set(words) for b in set(words) if a < b and (d := Q._edits(a, b)) <= 2}
    assert got == want


def all_pairs_families(names, cut):
    """Complete linkage by rescanning all pairs of clusters, nearest first, ties by the least names."""
    groups = [[x] for x in sorted(names)]
    while len(groups) > 1:
        far, x, y = min((max(Q._edits(a, b) for a in groups[x] for b in groups[y]), x, y) for y in range(len(groups)) for x in range(y))
        if far > cut:
            break
        groups[x] += groups.pop(y)
    return {n: k + 1 for k, g in enumerate(sorted(groups, key=min)) for n in g}


def test_families_against_all_pairs(spark):
    draw = np.random.default_rng(2)
    words = {g: {"".join(draw.choice(list("ACGT"), draw.integers(1, 8))) for _ in range(n)} for g, n in (("g", 45), ("h", 12), ("i", 1))}
    rows = [(g, w) for g, ws in words.items() for w in sorted(ws)] + [("g", min(words["g"])), ("j", None)]
    got = {(r.group, r.kmer): r.family for r in Q.families(spark.createDataFrame(rows, "group string, kmer string")).collect()}
    assert got == {(g, w): k for g, ws in words.items() for w, k in all_pairs_families(ws, 2).items()}


def test_families_of_all_parts(spark, tmp_path):
    from lagweave.plans import models

    parts = [(k, "azure" if k <= 400 else "zzzzzz", "b") for k in range(395, 405)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    assert len({r.kmer for r in models.QUERIES["cl9_families"](spark, str(tmp_path)).collect()}) == 2


def test_motif_matches_itself():
    m = np.array([[0.7, 0.1, 0.1, 0.1], [0.1, 0.7, 0.1, 0.1], [0.25, 0.25, 0.25, 0.25], [0.1, 0.1, 0.1, 0.7]])
    assert Q.column_correlation(m, m) == pytest.approx(0.75)


def test_empty_and_null_inputs(spark):
    none = spark.createDataFrame([], "gene string, cond string, time int, rep int, value double")
    tfs = spark.createDataFrame([("a",)], "tf string")
    assert X.edges(none, tfs).count() == 0
    assert R.venn(none, none).count() == 0
    assert R.false_discovery(spark.createDataFrame([], "p double")).count() == 0
    one = spark.createDataFrame([("a", "WT", t, 0, 1.0) for t in range(3)], "gene string, cond string, time int, rep int, value double")
    assert X.lag_correlations(one, tfs).first().r is None  # constant


def test_tails_of_t_in_any_depth(spark):
    """Against the closed sums in exact fractions: for even degrees of freedom p is a finite sum."""
    from decimal import Decimal, getcontext

    from lagweave.functions.maths import t_two_sided

    getcontext().prec = 400
    cases = [(t, n) for n in (4, 16, 34) for t in (0.5, 3.0, 9.0, 60.0, 4e4, 1e9)]
    rows = spark.createDataFrame([(float(t), n) for t, n in cases], "t double, n int").select("t", "n", t_two_sided(F.col("t"), F.col("n")).alias("p")).collect()
    for r in rows:
        c2 = Decimal(r.n) / (Decimal(r.n) + Decimal(r.t) ** 2)
        term, total = Decimal(1), Decimal(1)
        for k in range(1, r.n // 2):
            term = term * c2 * (2 * k - 1) / (2 * k)
            total += term
        assert r.p == pytest.approx(float(1 - (1 - c2).sqrt() * total), rel=1e-6), (r.t, r.n)
