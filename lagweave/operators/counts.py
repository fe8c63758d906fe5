"""Count model over groups of samples: size factors, negative-binomial dispersions, contrasts, variance stabilisation."""

from __future__ import annotations

from collections.abc import Callable
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import stored
from .coexpression import normal_two_sided
from .relational import false_discovery

#: Least dispersion, and the least one that the trend is fitted to.
LEAST, USABLE = 1e-8, 1e-6
#: Least variance of the prior of log dispersions; residuals beyond so many deviations keep their own estimate.
LEAST_PRIOR, OUTLIER = 0.25, 2.0


def size_factors(counts: DataFrame) -> DataFrame:
    """sample, size_factor: the median over genes of a sample's counts over the genes' geometric means (counts: gene, sample, n).

    Genes count that have a count above 0 in every sample. Where no gene has, the result is empty. A sample's ratios, one for each gene, meet in one task."""
    samples = counts.select("sample").distinct().count()
    seen = counts.filter("n > 0").withColumn("l", F.log("n"))
    centre = seen.groupBy("gene").agg(F.avg("l").alias("m"), F.count("*").alias("k")).filter(F.col("k") == samples)
    return seen.join(centre, "gene").groupBy("sample").agg(F.exp(F.median(F.col("l") - F.col("m"))).alias("size_factor"))


def expressed(counts: DataFrame, least: int = 10, samples: int = 3) -> DataFrame:
    """The counts of genes that have `least` or more in so many samples."""
    kept = counts.groupBy("gene").agg(F.count_if(F.col("n") >= least).alias("k")).filter(F.col("k") >= samples)
    return counts.join(kept.select("gene"), "gene", "left_semi")


def log_rising(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """ln of gamma(x + y) / gamma(x), without the loss of digits of a difference where x is large: eight steps of the recurrence, then Stirling's series."""
    ratio = np.ones(np.broadcast(x, y).shape)
    for k in range(8):
        ratio *= 1 + y / (x + k)
    u = x + 8
    tail = lambda v: 1 / (12 * v) - 1 / (360 * v**3) + 1 / (1260 * v**5)
    return (u - 0.5) * np.log1p(y / u) + y * np.log(u + y) - y + tail(u + y) - tail(u) - np.log(ratio)


def trigamma(x: float) -> float:
    out = 0.0
    while x < 10:
        out, x = out + 1 / x**2, x + 1
    return out + 1 / x + 1 / (2 * x**2) + 1 / (6 * x**3) - 1 / (30 * x**5)


def _sums(values: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Sums of the columns of each group, for every row."""
    return values @ (group[:, None] == np.arange(group.max() + 1)[None]).astype(float)


def adjusted_likelihood(y: np.ndarray, mu: np.ndarray, group: np.ndarray, log_alpha: np.ndarray) -> np.ndarray:
    """For each gene (row) the log likelihood of a dispersion, less half the log determinant of the groups' information (Cox and Reid)."""
    alpha = np.exp(log_alpha)[:, None]
    fit = log_rising(1 / alpha, y) + y * np.log(alpha) - (y + 1 / alpha) * np.log1p(alpha * mu)
    return fit.sum(1) - 0.5 * np.log(_sums(mu / (1 + alpha * mu), group)).sum(1)


def highest(f: Callable[[np.ndarray], np.ndarray], rows: int, low: float, high: float, grid: int = 30, steps: int = 30) -> np.ndarray:
    """Where f is highest between low and high, for many rows at once: best point of a grid, then golden sections around it."""
    at = np.linspace(low, high, grid)
    best = np.argmax(np.stack([f(np.full(rows, a)) for a in at]), axis=0)
    a, b = at[np.maximum(best - 1, 0)], at[np.minimum(best + 1, grid - 1)]
    share = (np.sqrt(5) - 1) / 2
    c, d = b - share * (b - a), a + share * (b - a)
    fc, fd = f(c), f(d)
    for _ in range(steps):
        left = fc >= fd
        a, b = np.where(left, a, c), np.where(left, d, b)
        new = np.where(left, b - share * (b - a), a + share * (b - a))
        f_new = f(new)
        c, d, fc, fd = np.where(left, new, d), np.where(left, c, new), np.where(left, f_new, fd), np.where(left, fc, f_new)
    return (a + b) / 2


def group_means(y: np.ndarray, size: np.ndarray, group: np.ndarray, alpha: np.ndarray, steps: int = 25) -> tuple[np.ndarray, np.ndarray]:
    """(ln of the mean, its variance) of every group of each gene by Fisher scoring at the gene's dispersion.

    A group without counts takes half a count a sample."""
    n = _sums(np.ones((1, len(group))), group)
    beta = np.log(np.maximum(_sums(y / size, group) / n, 0.5 * n / _sums(size[None], group)))
    y = np.where((_sums(y, group) > 0)[:, group], y, 0.5)
    a = alpha[:, None]
    for _ in range(steps):
        mu = size * np.exp(beta[:, group])
        move = _sums((y - mu) / (1 + a * mu), group) / _sums(mu / (1 + a * mu), group)
        beta = beta + np.clip(move, -2, 2)
        if np.abs(move).max(initial=0) < 1e-10:
            break
    mu = size * np.exp(beta[:, group])
    return beta, 1 / _sums(mu / (1 + a * mu), group)


def _matrix(b: pa.RecordBatch, samples: int) -> np.ndarray:
    """The counts of a batch, a row for each gene, from its lists of places and counts; what is not there is 0."""
    out = np.zeros((b.num_rows, samples))
    rows = np.repeat(np.arange(b.num_rows), np.diff(b.column("places").offsets.to_numpy()))
    out[rows, b.column("places").flatten().to_numpy()] = b.column("counts").flatten().to_numpy()
    return out


class Model:
    """A fitted count model: `genes` (gene, base_mean, dispersion_gene, trend, dispersion, outlier, means, variances: of ln, by group), and the fit's few numbers."""

    def __init__(self, genes: DataFrame, groups: list[str], trend: tuple[float, float], prior: float, factors: dict[str, float]) -> None:
        self.genes, self.groups, self.trend, self.prior, self.factors = genes, groups, trend, prior, factors

    def contrast(self, pairs: list[tuple[str, str, str]]) -> DataFrame:
        """contrast, gene, base_mean, lfc, se, stat, p, fdr: Wald tests of pairs (name, target group, base group), log2 fold changes, Benjamini-Hochberg by contrast."""
        at = {g: k for k, g in enumerate(self.groups)}
        each = F.explode(F.array(*[F.struct(F.lit(n).alias("contrast"), F.lit(at[t]).alias("t"), F.lit(at[b]).alias("b")) for n, t, b in pairs]))
        d = self.genes.select("gene", "base_mean", "means", "variances", each.alias("x")).select("*", "x.*")
        d = d.withColumns({"d": F.col("means")[F.col("t")] - F.col("means")[F.col("b")], "v": F.sqrt(F.col("variances")[F.col("t")] + F.col("variances")[F.col("b")])})
        d = d.select("contrast", "gene", "base_mean", (F.col("d") / log(2)).alias("lfc"), (F.col("v") / log(2)).alias("se"), (F.col("d") / F.col("v")).alias("stat"))
        return false_discovery(d.withColumn("p", normal_two_sided(F.col("stat"))), by=["contrast"])

    def stabilised(self, counts: DataFrame) -> DataFrame:
        """gene, sample, value: counts over size factors on the scale, log2 for large ones, whose variance the trend makes constant."""
        a0, a1 = self.trend
        sizes = counts.sparkSession.createDataFrame(list(self.factors.items()), "sample string, size_factor double")
        q = F.col("n") / F.col("size_factor")
        root = F.sqrt(a0 * q * (1 + a1 + a0 * q))
        return counts.join(F.broadcast(sizes), "sample").select("gene", "sample", (F.log((1 + a1 + 2 * a0 * q + 2 * root) / (4 * a0)) / log(2)).alias("value"))


def _trend(genes: DataFrame, rounds: int = 50) -> tuple[float, float]:
    """(a0, a1) of the dispersions' trend a0 + a1 / mean: a Gamma regression by iterated weights, whose sums are one aggregation each.

    Genes far from the trend (below 1e-4 or above 15 times) do not count. Where it does not come out positive: the mean dispersion, a1 = 0."""
    usable = genes.filter(F.col("dispersion_gene") >= USABLE)
    a0, a1 = 0.1, 1.0
    for _ in range(rounds):
        fit = a0 + a1 / F.col("base_mean")
        ratio = F.col("dispersion_gene") / fit
        w, x, y = 1 / (fit * fit), 1 / F.col("base_mean"), F.col("dispersion_gene")
        s = usable.filter((ratio > 1e-4) & (ratio < 15)).agg(*[F.sum(e).alias(n) for n, e in (("w", w), ("wx", w * x), ("wxx", w * x * x), ("wy", w * y), ("wxy", w * x * y))]).first()
        det = s.w * s.wxx - s.wx**2 if s.w else 0.0
        if det <= 1e-12 * (s.w or 0) * (s.wxx or 0) or det == 0:
            break
        new = (s.wxx * s.wy - s.wx * s.wxy) / det, (s.w * s.wxy - s.wx * s.wy) / det
        if min(new) <= 0:
            break
        moved, (a0, a1) = log(new[0] / a0) ** 2 + log(new[1] / a1) ** 2, new
        if moved < 1e-10:
            return a0, a1
    mean = usable.agg(F.avg("dispersion_gene")).first()[0]
    return (mean or USABLE), 0.0


def fit(counts: DataFrame, sheet: list[tuple[str, str]]) -> Model:
    """The model of counts (gene, sample, n; one row for each pair, what is missing is 0) under a sheet of (sample, group).

    Size factors by medians of ratios; gene-wise dispersions at the groups' means by the adjusted likelihood; their trend over
    the mean; dispersions shrunk towards it by a normal prior of the logs, whose variance is the residuals' beyond that of the sampling, outliers
    above keep their own; groups' means by Fisher scoring. A gene is one row with its counts, so genes are spread over tasks and batches of
    them are fitted as matrices. The driver holds the sheet, the size factors and the trend's two numbers. Counts of samples that the sheet lacks do not take part;
    null counts are 0; negative ones are an error of Spark's job. Genes without counts drop out. Needs more samples than groups, and a gene counted in all samples."""
    spark = counts.sparkSession
    names, groups = [s for s, _ in sheet], sorted({g for _, g in sheet})
    group = np.array([groups.index(g) for _, g in sheet])
    if len(names) <= len(groups):
        raise ValueError("dispersions need more samples than groups")
    known = F.broadcast(spark.createDataFrame([(s, k) for k, s in enumerate(names)], "sample string, place int"))
    rows = stored(counts.filter("n > 0").join(known, "sample").select("gene", "sample", "place", F.col("n").cast("double").alias("n")), "counts")
    factors = {r.sample: r.size_factor for r in size_factors(rows).collect()}
    if set(factors) != set(names):
        raise ValueError("no gene is counted in every sample of the sheet")
    size, n = np.array([factors[s] for s in names]), len(names)
    top = log(max(10.0, n))
    per_gene = rows.groupBy("gene").agg(F.sort_array(F.collect_list(F.struct("place", "n"))).alias("s")).select("gene", F.col("s.place").alias("places"), F.col("s.n").alias("counts"))

    def crude(y: np.ndarray) -> np.ndarray:
        held = _sums(np.ones((1, n)), group)
        return np.maximum(size * (_sums(y / size, group) / held)[:, group], 0.5)

    def first(batches):
        for b in batches:
            y = _matrix(b, n)
            mu = crude(y)
            own = np.exp(highest(lambda a: adjusted_likelihood(y, mu, group, a), len(y), log(LEAST), top)) if len(y) else np.zeros(0)
            yield pa.record_batch([b.column("gene"), b.column("places"), b.column("counts"), pa.array((y / size).mean(1)), pa.array(own)], names=["gene", "places", "counts", "base_mean", "dispersion_gene"])

    genes = stored(per_gene.mapInArrow(first, "gene string, places array<int>, counts array<double>, base_mean double, dispersion_gene double"), "count-dispersions")
    a0, a1 = _trend(genes)
    left = genes.filter(F.col("dispersion_gene") >= USABLE).select((F.log("dispersion_gene") - F.log(a0 + a1 / F.col("base_mean"))).alias("r"))
    centre = left.agg(F.median("r")).first()[0] or 0.0
    spread = (1.4826 * (left.agg(F.median(F.abs(F.col("r") - centre))).first()[0] or 0.0)) ** 2
    prior = max(spread - trigamma((n - len(groups)) / 2), LEAST_PRIOR)

    def second(batches):
        for b in batches:
            y, mean, own = _matrix(b, n), b.column("base_mean").to_numpy(), b.column("dispersion_gene").to_numpy()
            mu, line = crude(y), a0 + a1 / mean
            shrunk = np.exp(highest(lambda a: adjusted_likelihood(y, mu, group, a) - (a - np.log(line)) ** 2 / (2 * prior), len(y), log(LEAST), top)) if len(y) else np.zeros(0)
            odd = np.log(own) > np.log(line) + OUTLIER * np.sqrt(spread)
            alpha = np.where(odd, own, shrunk)
            beta, var = group_means(y, size, group, alpha)
            lists = lambda v: pa.array(list(v), pa.list_(pa.float64()))
            yield pa.record_batch([b.column("gene"), b.column("base_mean"), b.column("dispersion_gene"), pa.array(line), pa.array(alpha), pa.array(odd), lists(beta), lists(var)], names=["gene", "base_mean", "dispersion_gene", "trend", "dispersion", "outlier", "means", "variances"])

    schema = "gene string, base_mean double, dispersion_gene double, trend double, dispersion double, outlier boolean, means array<double>, variances array<double>"
    return Model(stored(genes.mapInArrow(second, schema), "count-model"), groups, (a0, a1), prior, factors)
