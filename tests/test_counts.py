from math import lgamma

import numpy as np
import pytest
from pyspark.sql import functions as F

from lagweave.operators import counts as C


def test_log_rising():
    for x in (1e-3, 0.5, 3.0, 40.0, 1e4):
        for y in (0, 1, 7, 500):
            assert C.log_rising(np.array([x]), np.array([float(y)]))[0] == pytest.approx(lgamma(x + y) - lgamma(x), abs=1e-7)
    assert C.log_rising(np.array([1e9]), np.array([3.0]))[0] == pytest.approx(3 * np.log(1e9), rel=1e-9)


def test_trigamma():
    assert C.trigamma(1.0) == pytest.approx(np.pi**2 / 6, rel=1e-7)


@pytest.fixture(scope="module")
def simulated():
    """400 genes in two groups of eight samples; the first 40 change eightfold, up and down by turns."""
    draw = np.random.default_rng(11)
    size, mean = np.exp(draw.normal(0, 0.3, 16)), np.exp(draw.uniform(3, 8, 400))
    change = np.zeros(400)
    change[:40] = np.where(np.arange(40) % 2, 3, -3)
    alpha = (0.05 + 3 / mean) * np.exp(draw.normal(0, 0.3, 400))
    mu = mean[:, None] * 2.0 ** (change[:, None] * (np.arange(16) >= 8)) * size
    return size, change, alpha, draw.negative_binomial(1 / alpha[:, None], 1 / (1 + alpha[:, None] * mu))


def test_planted_changes_come_back(spark, simulated):
    size, change, alpha, y = simulated
    rows = [(f"g{g}", f"s{s:02}", int(y[g, s])) for g in range(400) for s in range(16)]
    counts = spark.createDataFrame([*rows, ("none", "s00", 0), ("g1", "elsewhere", 9)], "gene string, sample string, n long")
    sheet = [(f"s{s:02}", "b" if s >= 8 else "a") for s in range(16)]
    model = C.fit(counts, sheet)
    found = np.array([model.factors[s] for s, _ in sheet])
    assert np.allclose(found / found.mean(), size / size.mean(), rtol=0.08)
    got = {r.gene: r for r in model.contrast([("b_vs_a", "b", "a")]).collect()}
    assert len(got) == 400
    lfc = np.array([got[f"g{g}"].lfc for g in range(400)])
    assert np.abs(lfc[:40] - change[:40]).max() < 1.2 and np.sqrt(np.mean((lfc[:40] - change[:40]) ** 2)) < 0.4
    fdr, p = (np.array([got[f"g{g}"][c] for g in range(400)]) for c in ("fdr", "p"))
    assert (fdr[:40] < 0.05).all() and (fdr[40:] < 0.05).mean() < 0.03
    assert 0.015 < (p[40:] < 0.05).mean() < 0.1  # near uniform without a change
    d = {r.gene: r for r in model.genes.collect()}
    ratio = np.log([d[f"g{g}"].dispersion / alpha[g] for g in range(400)])
    raw = np.log([max(d[f"g{g}"].dispersion_gene, 1e-8) / alpha[g] for g in range(400)])
    assert abs(np.median(ratio)) < 0.2 and np.std(ratio) < np.std(raw)  # shrinkage helps
    assert model.trend[0] == pytest.approx(0.05, rel=0.35)
    # groups' means solve their likelihood equation
    g, group = 7, np.array([s >= 8 for s in range(16)])
    for k in (0, 1):
        mu = found[group == k] * np.exp(d["g7"].means[k])
        assert ((y[g][group == k] - mu) / (1 + d["g7"].dispersion * mu)).sum() == pytest.approx(0, abs=1e-6)


def test_stabilised_variance_does_not_follow_the_mean(spark, simulated):
    y = simulated[3][:, :8]
    counts = spark.createDataFrame([(f"g{g}", f"s{s}", int(y[g, s])) for g in range(400) for s in range(8)], "gene string, sample string, n long")
    model = C.fit(counts, [(f"s{s}", "ab"[s % 2]) for s in range(8)])
    got = model.stabilised(counts).groupBy("gene").agg(F.stddev("value").alias("sd"), F.avg("value").alias("m")).collect()
    sd, m = np.array([r.sd for r in got]), np.array([r.m for r in got])
    assert abs(np.corrcoef(sd, m)[0, 1]) < 0.35 and np.corrcoef(np.log1p(y).std(1), np.log1p(y).mean(1))[0, 1] < -0.35
    big = model.stabilised(counts.sparkSession.createDataFrame([("x", "s0", 10**6), ("x", "s1", 10**6)], "gene string, sample string, n long")).collect()
    assert all(r.value == pytest.approx(np.log2(1e6 / model.factors[r.sample]), abs=0.02) for r in big)


def test_groups_without_counts_and_tables_that_fit_nothing(spark):
    rows = [(g, s, n) for g, n in (("a", 20), ("b", 35), ("c", 50)) for s in "pqrs"] + [("d", "p", 30), ("d", "q", 42), ("e", "r", None)]
    model = C.fit(spark.createDataFrame(rows, "gene string, sample string, n long"), [("p", "x"), ("q", "x"), ("r", "y"), ("s", "y")])
    got = {r.gene: r for r in model.contrast([("c", "y", "x")]).collect()}
    assert set(got) == set("abcd") and got["d"].lfc < -5 and abs(got["a"].lfc) < 1e-6
    assert C.size_factors(spark.createDataFrame([], "gene string, sample string, n long")).count() == 0
    with pytest.raises(ValueError, match="every sample"):
        C.fit(spark.createDataFrame([("a", "p", 1)], "gene string, sample string, n long"), [("p", "x"), ("q", "x")])
