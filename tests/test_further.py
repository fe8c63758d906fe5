"""Operators without SQL, held against plain versions of their definitions."""

import hashlib
import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from lagweave.functions import maths as M
from lagweave.functions import strings as S
from lagweave.operators import coexpression as X
from lagweave.operators import learning as L
from lagweave.operators import network as N
from lagweave.operators import relational as R
from lagweave.operators import sequences as Q
from lagweave.operators import timewarp as T
from lagweave.sources import files


def t_tail(t, df):
    """Two-sided p by integration of the density."""
    x = np.linspace(0, abs(t), 200_001)
    y = (1 + x * x / df) ** (-(df + 1) / 2) * math.gamma((df + 1) / 2) / math.gamma(df / 2) / math.sqrt(df * math.pi)
    return 1 - 2 * float(((y[1:] + y[:-1]) / 2).sum() * (x[1] - x[0]))


def test_t_with_any_degrees_of_freedom(spark):
    rows = [(t, df) for t in (-2.5, 0.0, 0.7, 3.1) for df in (1, 2, 3, 4, 5, 7, 8, 15, 16, 31)] + [(1.0, 0)]
    got = spark.createDataFrame(rows, "t double, df int").select("t", "df", M.t_two_sided(F.col("t"), F.col("df")).alias("p")).collect()
    for r in got:
        assert r.p == pytest.approx(1.0 if r.df < 1 else t_tail(r.t, r.df), abs=1e-8), r


def plain_bh(p):
    order = np.argsort(p)
    q, low = np.empty(len(p)), 1.0
    for k in range(len(p) - 1, -1, -1):
        ties = np.searchsorted(p[order], p[order][k], side="right")
        low = min(low, p[order][k] * len(p) / ties)
        q[order[k]] = low
    return q


def test_false_discovery_by_groups(spark):
    draw = np.random.default_rng(3)
    p = {"a": np.round(draw.random(300) ** 6, 9), "b": np.concatenate([np.zeros(3), np.full(5, 1.0), draw.choice([1e-300, 1e-12, 0.01, 0.5], 40)])}
    rows = [(g, k, float(v)) for g, vs in p.items() for k, v in enumerate(vs)] + [("a", 999, None)]
    got = R.false_discovery(spark.createDataFrame(rows, "g string, k int, p double"), by=["g"]).collect()
    want = {(g, k): q for g, vs in p.items() for k, q in enumerate(plain_bh(vs))}
    assert len(got) == len(rows)
    for r in got:
        assert r.fdr is None if r.p is None else r.fdr == pytest.approx(want[r.g, r.k], rel=1e-12)


def test_digest_rank_is_the_order_of_digests(spark):
    rows = [(k, k % 3 == 0) for k in range(500)]
    got = R.digest_rank(spark.createDataFrame(rows, "id int, positive boolean"), ["positive"], F.md5(F.col("id").cast("string"))).collect()
    for flag in (True, False):
        order = sorted((hashlib.md5(str(k).encode()).hexdigest(), k) for k, p in rows if p == flag)
        assert {r.id: r.k_ for r in got if r.positive == flag} == {k: i + 1 for i, (_, k) in enumerate(order)}


def test_value_rank(spark):
    draw = np.random.default_rng(9)
    rows = [(f"k{k}", float(draw.choice([0.0, 1.0, 0.5, 1e-9, 0.30001, 0.3]))) for k in range(200)]
    got = R.value_rank(spark.createDataFrame(rows, "kmer string, p double"), "p", ["kmer"]).collect()
    assert {r.kmer: r["rank"] for r in got} == {k: i + 1 for i, (_, k) in enumerate(sorted((p, k) for k, p in rows))}


def test_balanced_split(spark):
    rows = spark.range(400).select(F.col("id"), (F.col("id") % 5 == 0).alias("positive"))
    for fold in range(4):
        got = L.balanced_split(rows, fold, 4).collect()
        n = {(p, t): sum(r.positive == p and r.test == t for r in got) for p in (True, False) for t in (True, False)}
        assert n[True, True] == n[False, True] == 20 and n[True, False] == n[False, False] == 60 and len({r.id for r in got}) == 160
    one, other = ({r.id for r in L.balanced_split(rows, f, 4).collect() if not r.positive} for f in (0, 1))
    assert one != other  # negatives are drawn anew


def test_forests_learn_what_is_there(spark):
    from pyspark.ml.functions import array_to_vector

    rows = spark.range(300).select("id", (F.col("id") % 3 == 0).alias("positive"), array_to_vector(F.array((F.col("id") % 3 == 0).cast("double") + F.rand(1), F.rand(2))).alias("features"))
    scored, importance = L.forest_scores(rows, k=2, trees=5, replicates=2)
    assert all(r.auc > 0.9 for r in L.auc(scored, ["replicate", "fold"]).collect())
    summary = {r.feature: r for r in L.importance_summary(importance).collect()}
    assert summary[0]["rank"] == 1 and summary[0]["mean"] > 0.6
    null = L.permuted_auc(rows, rounds=2, k=2, trees=5).collect()
    assert len(null) == 2 and all(0.25 < r.auc < 0.75 for r in null)


def test_components_against_decomposition(spark):
    draw = np.random.default_rng(5)
    x = draw.normal(size=(40, 6)) @ np.diag([5, 3, 1, 1, 0.5, 0.1])
    got = L.principal_components(spark.createDataFrame([(k, [float(v) for v in r]) for k, r in enumerate(x)], "id int, v array<double>")).orderBy("id").collect()
    u, s, vt = np.linalg.svd(x - x.mean(0), full_matrices=False)
    for j in (0, 1):
        pc = u[:, j] * s[j] * np.sign(vt[j][np.abs(vt[j]).argmax()])
        assert [r[f"pc{j + 1}"] for r in got] == pytest.approx(pc.tolist(), abs=1e-5)
        assert got[0][f"share{j + 1}"] == round(100 * s[j] ** 2 / (s**2).sum(), 1)


def test_sample_components(spark):
    draw = np.random.default_rng(6)
    x = draw.normal(size=(5, 30))
    x[:, 7] = 2.0  # does not vary
    rows = [("t1", f"s{i}", f"g{j}", float(x[i, j])) for i in range(5) for j in range(30)] + [("t2", f"s{i}", "g1", 1.0 * i) for i in range(2)]
    got = {r.sample: r for r in L.sample_components(spark.createDataFrame(rows, "group string, sample string, gene string, value double")).collect()}
    c = x - x.mean(0)
    u, s, _ = np.linalg.svd(c, full_matrices=False)
    pc = u[:, 0] * s[0]
    pc = pc if pc[np.abs(pc).argmax()] > 0 else -pc
    assert [got[f"s{i}"].pc1 for i in range(5)] == pytest.approx(pc.tolist(), abs=1e-5) and {r.group for r in got.values()} == {"t1"}


def study(spark, drop=()):
    draw = np.random.default_rng(8)
    rows = [(f"g{g}", c, t, r, float(draw.normal())) for g in range(6) for c in ("WT", "MUT") for t in range(4) for r in range(3)]
    return [r for r in rows if r[:4] not in drop]


def ranks(v):
    v = np.array(v)
    return np.array([(v < x).sum() + ((v == x).sum() + 1) / 2 for x in v])


def test_lag_correlations_where_times_are_missing(spark):
    rows = study(spark, {("g1", "WT", 2, 1), ("g4", "MUT", 0, 0), ("g4", "MUT", 3, 2)})
    values = spark.createDataFrame(rows, "gene string, cond string, time int, rep int, value double")
    tfs = spark.createDataFrame([("g0",), ("g1",), ("zz",)], "tf string")
    got = {(r.tf, r.target, r.cond): r for r in X.lag_correlations(values, tfs).collect()}
    cell = {r[:4]: r[4] for r in rows}
    assert len(got) == 2 * 6 * 2
    for (tf, target, cond), r in got.items():
        side = {}
        for g in (tf, target):
            at = [(rep, t) for rep in range(3) for t in range(3) if (g, cond, t, rep) in cell and (g, cond, t + 1, rep) in cell]
            rx, ry = ranks([cell[g, cond, t, rep] for rep, t in at]), ranks([cell[g, cond, t + 1, rep] for rep, t in at])
            side[g] = {k: (x, y) for k, x, y in zip(at, rx, ry, strict=True)}
        both = sorted(side[tf].keys() & side[target].keys())
        assert r.n == len(both)
        assert r.r == pytest.approx(np.corrcoef([side[tf][k][0] for k in both], [side[target][k][1] for k in both])[0, 1], abs=1e-8)


def test_permutation_null_against_a_direct_one(spark):
    rows = study(spark)
    values = spark.createDataFrame(rows, "gene string, cond string, time int, rep int, value double").repartition(3)
    tfs = spark.createDataFrame([("g0",), ("g3",)], "tf string")
    got = {(r.tf, r.target): r for r in X.permutation_null(values, tfs, rounds=12, block=2).collect()}
    cell = {r[:4]: r[4] for r in rows}
    sheet = [(t, c, r) for t in range(4) for c in ("MUT", "WT") for r in range(3)]

    def z(tf, target, groups):
        out = []
        for c in ("WT", "MUT"):
            x = [cell[tf, sheet[k][1], sheet[k][0], sheet[k][2]] for t in range(3) for k in groups[t, c]]
            y = [cell[target, sheet[k][1], sheet[k][0], sheet[k][2]] for t in range(1, 4) for k in groups[t, c]]
            out.append(math.atanh(max(-0.9999, min(0.9999, np.corrcoef(ranks(x), ranks(y))[0, 1]))))
        return abs(out[0] - out[1]) / math.sqrt(2 / 6)

    at = {(t, c): [k for k, s in enumerate(sheet) if s[:2] == (t, c)] for t in range(4) for c in ("WT", "MUT")}
    draws = []
    for i in range(12):
        draw, groups = np.random.default_rng([42, i]), {}
        for t in range(4):
            both = draw.permutation(np.array(at[t, "WT"] + at[t, "MUT"]))
            groups[t, "WT"], groups[t, "MUT"] = both[:3], both[3:]
        draws.append(groups)
    assert len(got) == 12
    for (tf, target), r in got.items():
        null = np.array([z(tf, target, g) for g in draws])
        assert r.z == pytest.approx(z(tf, target, at), abs=2e-6) and r.mean == pytest.approx(null.mean(), abs=2e-6) and r.sd == pytest.approx(null.std(), abs=2e-6)
        assert r.p == pytest.approx(0.5 * math.erfc((z(tf, target, at) - null.mean()) / null.std() / math.sqrt(2)), abs=2e-6)


def test_component_of_a_seed(spark):
    chain = spark.createDataFrame([(f"n{k}", f"n{k + 1}") for k in range(6)] + [("x", "y")], "tf string, target string")
    assert sorted(r.node for r in N.connected(chain, "n0").collect()) == [f"n{k}" for k in range(7)]
    assert [r.node for r in N.connected(chain, "alone").collect()] == ["alone"]
    with pytest.raises(RuntimeError):
        N.connected(chain, "n0", rounds=3)


def test_conditional_odds_maximise_the_likelihood(spark):
    tables = [(3, 7, 5, 2), (1, 1, 1, 1), (10, 2, 3, 15), (0, 4, 3, 3), (4, 0, 0, 3)]
    got = N.conditional_odds(spark.createDataFrame(tables, "a long, b long, c long, d long")).collect()
    for r in got:
        m, n, k = r.a + r.c, r.b + r.d, r.a + r.b
        low, high = max(0, k - n), min(k, m)
        if r.a in (low, high):
            assert r.odds_mle == (0 if r.a == low else math.inf)
            continue
        like = lambda odds: math.comb(m, r.a) * math.comb(n, k - r.a) * odds**r.a / sum(math.comb(m, i) * math.comb(n, k - i) * odds**i for i in range(low, high + 1))  # noqa: B023, E731
        assert like(r.odds_mle) >= max(like(r.odds_mle * 1.01), like(r.odds_mle / 1.01))


def test_valleys_and_forms():
    assert T.valleys([5, 3, 3.2, 1, 6]) == [3]  # the dip at 3 ends where 1 lies below it
    assert T.valleys([5, 1, 4, 2, 6]) == [1, 3] and T.valleys([1, 2, 3]) == [] and T.valleys([2, 2, 2]) == []
    assert T.curve_class([9, 4, 2, 1, 2, 5, 9]) == "U" and T.curve_class([9, 8, 7, 6, 5, 4, 3, 2]) == "monotonic"
    assert T.curve_class([1, 2, 3, 4, 5, 6]) == "fluctuating" and T.curve_class([9, 7, 8.5, 6.5, 6, 5.8, 5.7, 5.6, 5.6]) == "valley"
    assert T.choose_clusters([2, 3, 4, 5, 6, 7, 8], [9, 4, 2, 1, 2, 5, 9]) == 5
    assert T.choose_clusters([2, 3, 4, 5, 6, 7, 8, 9], [9, 5, 1.2, 1.1, 1.0, 0.9, 0.8, 0.7]) == 4  # the bend
    assert T.choose_clusters([2, 3, 4, 5, 6, 7], [1.0, 0.999, 0.998, 0.997, 0.996, 0.995]) == 3  # flat: a third along
    assert T.choose_clusters([4, 5], [1, 2]) == 4
    assert [T.cluster_limit(n) for n in (30, 100, 900)] == [3, 10, 30] and [T.cluster_limit(n, True) for n in (30, 64, 900)] == [3, 5, 30]
    assert T.limited_counts([2, 3, 4, 5, 6], 25) == [2, 3, 4]


def test_lowess_keeps_lines_and_forgets_outliers():
    x = np.arange(10.0)
    assert T.lowess(x, 2 * x + 1, 0.5) == pytest.approx(2 * x + 1)
    y = 2 * x + 1
    y[4] = 100
    assert np.abs(np.delete(T.lowess(x, y, 0.6), 4) - np.delete(2 * x + 1, 4)).max() < 5


def test_scan_stops_and_finds_two_groups():
    draw = np.random.default_rng(1)
    x = np.concatenate([draw.normal(0, 0.1, (30, 4)), draw.normal(5, 0.1, (30, 4))])
    assert T.scanned_clusters(x, [2, 3, 4, 5]) == 2


def test_fates_are_those_of_their_centres(spark):
    times = [0.0, 1.0, 2.0, 3.0, 4.0]
    wt = [-1.0, 0.0, 1.0, 0.0, -1.0]
    genes = [(f"a{k}", [v + 0.01 * k for v in wt]) for k in range(8)] + [(f"b{k}", [-v + 0.01 * k for v in wt]) for k in range(8)]
    profiles = spark.createDataFrame(genes, "gene string, z array<double>")
    core = profiles.select("gene", F.lit(1).alias("wt_cluster")).union(spark.createDataFrame([("a0", 2)], "gene string, wt_cluster int"))
    centres = spark.createDataFrame([(1, times, wt), (2, times, wt)], "wt_cluster int, times array<double>, centre array<double>")
    got = {r.gene: r for r in T.fates(core, profiles, centres, counts=(2,)).collect()}
    assert len(got) == 16 and len({r.sub_cluster for r in got.values()}) == 2
    assert got["a3"].label == "Conserved" and got["b3"].label == "Shape_Diverged" and got["a3"]["size"] == 8
    totals = {r.label: (r.genes, r.n_sub) for r in T.fate_totals(T.fates(core, profiles, centres, counts=(2,))).collect()}
    assert totals == {"Conserved": (8, 1), "Shape_Diverged": (8, 1)}


def test_merged_motifs_find_shift_and_strand():
    merged = Q.merged_motif(["ACGTTA", "CGTTAG", "CTAACG"], [3.0, 2.0, 1.0])  # the third is the second's complement
    assert "".join("ACGT"[c.argmax()] for c in merged) == "ACGTTAG" and merged[0].tolist() == [1, 0, 0, 0]
    assert Q.merged_motif(["ACG"], [1.0]).tolist() == [[1, 0, 0, 0], [0, 1, 0, 0], [0, 0, 1, 0]]
    assert len(Q.merged_motif(["NACGTN"], [1.0])) == 4  # edges without information go


def test_alignment_to_a_motif(spark):
    one = lambda s: [[1.0 if c == x else 0.0 for c in "ACGT"] for x in s]
    rows = [("inside", "db", one("CGTTA"), one("AACGTTACC")), ("turned", "db", one("TGACC"), one("AAGGTCACC")), ("over", "db", one("GGAACGTT"), one("AACGTTACC"))]
    got = {r.name: r for r in Q.aligned_to(spark.createDataFrame(rows, "name string, motif string, query array<array<double>>, base array<array<double>>")).collect()}
    letters = lambda p: "".join("ACGT"[int(np.argmax(c))] if max(c) > 0.5 else "." for c in p)
    assert letters(got["inside"].ppm) == "..CGTTA.." and letters(got["turned"].ppm) == "..GGTCA.." and letters(got["over"].ppm) == "AACGTT..." and got["over"].shift == -2


def test_names_of_families_and_clusters(spark):
    got = spark.createDataFrame([("C2C2dof",), ("wrky",), ("xyz",), ("TC",), ("AP2EREBP",), ("",)], "n string").select("n", S.family_of(F.col("n"), ["DOF", "WRKY", "TCP", "ERF", "AP2"], {"AP2EREBP": "ERF"}).alias("f")).collect()
    assert {r.n: r.f for r in got} == {"C2C2dof": "DOF", "wrky": "WRKY", "xyz": None, "TC": "TCP", "AP2EREBP": "ERF", "": None}
    assert N.resolved_clusters(["WT_1", "C1", "9", "WT_"], ["WT_1", "WT_C10", "WT_C1"]) == {"WT_1": "WT_1", "C1": "WT_C10"}
    assert R.time_columns(spark.createDataFrame([(1, 1, 1, 1)], "WT_3h int, WT_Cluster int, MUT_12h int, x_3h int"), ["WT", "MUT"]) == ["WT_3h", "MUT_12h"]


def test_written_lists(spark, tmp_path):
    genes = lambda rows: spark.createDataFrame(rows, "gene string, cluster int")
    pairs = spark.createDataFrame([(1, 2)], "wt int, mut int")
    files.write_cluster_pairs(genes([("a", 1), ("b", 1), ("z", 3)]), genes([("b", 2), ("c", 2)]), pairs, f"{tmp_path}/pairs")
    back = {(r["list"], r.value) for r in spark.read.text(f"{tmp_path}/pairs").collect()}
    assert back == {("WT_ClusterGenes", "a"), ("WT_ClusterGenes", "b"), ("MUT_ClusterGenes", "b"), ("MUT_ClusterGenes", "c"), ("Intersection_Genes", "b"), ("WT_Only_Genes", "a"), ("MUT_Only_Genes", "c")}
    fates = spark.createDataFrame([(1, 2, "Conserved", "a", 0.9), (1, 1, "Amp_Altered", "b", 0.2)], "wt_cluster int, sub_cluster int, label string, gene string, membership double")
    files.write_fates(fates, f"{tmp_path}/fates")
    assert [(r.cluster, r["list"], r.value) for r in spark.read.text(f"{tmp_path}/fates").collect()] == [("WT_C01", "SubCluster_2_Conserved_Genes", "a")]
    files.write_venn(R.venn(genes([("a", 1)]), genes([("a", 1), ("b", 1)])), f"{tmp_path}/venn")
    assert sorted(os.listdir(f"{tmp_path}/venn"))[-2:] == ["part=both", "part=only_b"]
    files.write_network(spark.createDataFrame([("x",)], "Node_ID string"), spark.createDataFrame([("x", "y")], "Source string, Target string"), f"{tmp_path}/net")
    assert files.read_table(spark, f"{tmp_path}/net/edges", ",").first().Target == "y"
