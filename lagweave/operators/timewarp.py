"""Elastic comparison of profiles, their smoothing, assignment of clusters, and choice of their number."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def natural_spline(x: np.ndarray, y: np.ndarray, grid: np.ndarray) -> np.ndarray:
    """Values of the natural cubic spline through (x, y); y may hold many curves, one in each row."""
    n, h = len(x), np.diff(x)
    if n < 3:
        return np.apply_along_axis(lambda v: np.interp(grid, x, v), -1, y)
    a, rhs = np.eye(n), np.zeros_like(y, float)
    for i in range(1, n - 1):
        a[i, i - 1 : i + 2] = h[i - 1], 2 * (h[i - 1] + h[i]), h[i]
        rhs[..., i] = 6 * ((y[..., i + 1] - y[..., i]) / h[i] - (y[..., i] - y[..., i - 1]) / h[i - 1])
    m = np.linalg.solve(a, rhs.T).T
    k = np.clip(np.searchsorted(x, grid, side="right") - 1, 0, n - 2)
    t, u = x[k + 1] - grid, grid - x[k]
    cubes = (m[..., k] * t**3 + m[..., k + 1] * u**3) / (6 * h[k])
    return cubes + (y[..., k] / h[k] - m[..., k] * h[k] / 6) * t + (y[..., k + 1] / h[k] - m[..., k + 1] * h[k] / 6) * u


def warp(a: np.ndarray, b: np.ndarray, band: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distance, i, j) of dynamic time warping, with squared costs, of many pairs at once: the rows of a and of b.

    Cells of one anti-diagonal depend on the two before it only, so that each is one step for all pairs. The band is a mask: j stays
    within it of round(i m / n). i and j, from 0, are the cells of the path from the end on, padded with -1. Of equal
    predecessors (i - 1, j) goes first, then (i, j - 1). A band that shuts the end out gives an infinite distance."""
    (pairs, n), m = a.shape, b.shape[1]
    total = np.full((n + 1, m + 1, pairs), np.inf)
    total[0, 0] = 0
    allowed = np.ones((n + 1, m + 1), bool) if band is None else np.abs(np.arange(m + 1) - np.round(np.arange(n + 1) * m / n)[:, None]) <= band
    left, right = a.T, b.T
    for d in range(2, n + m + 1):
        i = np.arange(max(1, d - m), min(n, d - 1) + 1)
        i = i[allowed[i, d - i]]
        j = d - i
        least = np.minimum(np.minimum(total[i - 1, j], total[i, j - 1]), total[i - 1, j - 1])
        total[i, j] = (left[i - 1] - right[j - 1]) ** 2 + least
    every = np.arange(pairs)
    i, j = np.full(pairs, n), np.full(pairs, m)
    path_i, path_j = (np.full((pairs, n + m - 1), -1) for _ in "ij")
    path_i[:, 0], path_j[:, 0] = n - 1, m - 1
    for step in range(1, n + m - 1):
        going = (i > 1) | (j > 1)
        if not going.any():
            break
        up, back, both = (np.where(ok, total[np.maximum(k, 0), np.maximum(q, 0), every], np.inf) for k, q, ok in ((i - 1, j, i > 1), (i, j - 1, j > 1), (i - 1, j - 1, (i > 1) & (j > 1))))
        take_up = (j == 1) | ((i > 1) & (up <= back) & (up <= both))
        take_back = ~take_up & ((i == 1) | (back <= both))
        i, j = np.where(going & ~take_back, i - 1, i), np.where(going & ~take_up, j - 1, j)
        path_i[going, step], path_j[going, step] = i[going] - 1, j[going] - 1
    return np.sqrt(total[n, m]), path_i, path_j


def _correlation(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Pearson's r of the rows of a and b; NaN where one is constant."""
    a, b = a - a.mean(1, keepdims=True), b - b.mean(1, keepdims=True)
    norm = np.sqrt((a * a).sum(1) * (b * b).sum(1))
    return np.divide((a * b).sum(1), norm, out=np.full(len(a), np.nan), where=norm > 1e-12)


#: What compare() gives, in the order of the result's columns.
METRICS = ("shape", "amp", "phase", "cost", "distance", "pearson_r", "deriv_r", "range_wt", "range_mut", "path_length", "mean_deviation", "max_deviation")


def compare(a: np.ndarray, b: np.ndarray, times: np.ndarray, weights: tuple[float, float, float] = (0.5, 0.3, 0.2), points: int = 100, band: int | None = None) -> dict[str, np.ndarray]:
    """METRICS of pairs of profiles (rows of a and b) over the same times.

    Derivatives of the splined curves on an even grid are warped onto each other: shape is their distance, over the root of the path's length and
    the larger range of both, amp the difference of the profiles' own ranges over their sum, phase the path's mean way off the diagonal over
    half the grid; cost weighs the three. pearson_r is of the profiles, deriv_r of the derivatives."""
    grid = np.linspace(times[0], times[-1], points)
    da, db = (np.gradient(natural_spline(times, v, grid), grid[1] - grid[0], axis=1) for v in (a, b))
    distance, i, j = warp(da, db, band)
    on = i >= 0
    length, off = on.sum(1), np.where(on, np.abs(i - j), 0)
    widest = np.maximum(np.maximum(np.ptp(da, axis=1), np.ptp(db, axis=1)), 1e-6)
    shape = np.minimum(distance / np.sqrt(length) / (widest + 1e-6), 1)
    ra, rb = np.ptp(a, axis=1), np.ptp(b, axis=1)
    amp = np.abs(ra - rb) / (ra + rb + 1e-10)
    mean = off.sum(1) / length
    phase = np.minimum(mean / (points / 2), 1)
    cost = weights[0] * shape + weights[1] * amp + weights[2] * phase
    return dict(zip(METRICS, (shape, amp, phase, cost, distance, _correlation(a, b), _correlation(da, db), ra, rb, length, mean, off.max(1)), strict=True))


def centre_costs(pairs: DataFrame, points: int = 100, band: int | None = None) -> DataFrame:
    """wt, mut and METRICS for pairs of centres (wt, mut, times, a, b: arrays), a batch at once; r is null where a curve is constant.

    Pairs whose arrays are null, hold nulls, differ in length or have less than two times give null metrics."""
    most = 256  # pairs whose tables of sums are held at once: 20 MB at 100 points

    def run(batches):
        for batch in batches:
            for lo in range(0, len(batch), most):
                pdf = batch.iloc[lo : lo + most].reset_index(drop=True)
                out = pd.DataFrame(np.nan, index=pdf.index, columns=list(METRICS))
                groups: dict[tuple, list[int]] = {}
                for k, (t, a, b) in enumerate(zip(pdf["times"], pdf["a"], pdf["b"], strict=True)):
                    if all(v is not None and not pd.isna(v).any() for v in (t, a, b)) and len(t) == len(a) == len(b) >= 2:
                        groups.setdefault(tuple(t), []).append(k)
                for t, rows in groups.items():
                    a, b = (np.stack([np.array(v, float) for v in pdf.loc[rows, c]]) for c in "ab")
                    for name, v in compare(a, b, np.array(t, float), points=points, band=band).items():
                        out.loc[rows, name] = v
                yield pd.concat([pdf[["wt", "mut"]], out.astype(object).where(out.notna(), None)], axis=1)

    got = pairs.select("wt", "mut", "times", "a", "b").mapInPandas(run, "wt int, mut int, " + ", ".join(f"{c} double" for c in METRICS))
    return got.withColumns({c: F.col(c).cast("int") for c in ("path_length", "max_deviation")})


def priority(shape: Column, amp: Column, phase: Column, limits: tuple[float, float, float] = (0.15, 0.15, 0.25)) -> Column:
    """Shape before Amp before Phase, all strict; else Conserved."""
    return F.when(shape > limits[0], "Shape").when(amp > limits[1], "Amp").when(phase > limits[2], "Phase").otherwise("Conserved")


def assignment(cost: np.ndarray) -> list[tuple[int, int]]:
    """The pairs of a rectangular assignment of least total cost (potentials and augmenting paths); the larger side keeps some unmatched."""
    if cost.shape[0] > cost.shape[1]:
        return sorted((i, j) for j, i in assignment(cost.T))
    n, m = cost.shape
    u, v, match, way = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, int), np.zeros(m + 1, int)
    for i in range(1, n + 1):
        match[0], j0, least, used = i, 0, np.full(m + 1, np.inf), np.zeros(m + 1, bool)
        while match[j0]:
            used[j0] = True
            free = np.flatnonzero(~used[1:]) + 1
            now = cost[match[j0] - 1, free - 1] - u[match[j0]] - v[free]
            better = now < least[free]
            least[free[better]], way[free[better]] = now[better], j0
            j1 = free[np.argmin(least[free])]
            step = least[j1]
            u[match[used]] += step
            v[used] -= step
            least[~used] -= step
            j0 = j1
        while j0:
            match[j0], j0 = match[way[j0]], way[j0]
    return sorted((int(match[j]) - 1, j - 1) for j in range(1, m + 1) if match[j])


def matched(costs: DataFrame) -> DataFrame:
    """The rows of centre costs that the assignment pairs; clusters are at most some tens, so the matrix is read by the driver."""
    rows = costs.select("wt", "mut", "cost").collect()
    wt, mut = sorted({r.wt for r in rows}), sorted({r.mut for r in rows})
    matrix = np.full((len(wt), len(mut)), 1e9)
    for r in rows:
        matrix[wt.index(r.wt), mut.index(r.mut)] = r.cost
    pairs = [(wt[i], mut[j]) for i, j in assignment(matrix)]
    return costs.join(F.broadcast(costs.sparkSession.createDataFrame(pairs, "wt int, mut int")), ["wt", "mut"])


def loess(x: np.ndarray, y: np.ndarray, grid: np.ndarray, span: float = 0.4) -> np.ndarray:
    """Local regression with tricube weights: quadratic from five points, linear at four (span 0.5 at least), a spline below that.

    floor(span * n) nearest points count, the farthest of them with weight 0. Where these determine no polynomial
    anywhere on the grid, the whole curve is the line through neighbouring points."""
    n = len(x)
    if n < 4:
        return natural_spline(x, y, grid)
    degree, k = (2, int(n * span + 1e-5)) if n >= 5 else (1, int(n * max(span, 0.5) + 1e-5))
    out = []
    for g in grid:
        d = np.abs(x - g)
        reach = np.sort(d)[min(k, n) - 1] if k else 0.0
        w = np.where(d < 0.999 * reach, np.clip(1 - (d / (reach or 1)) ** 3, 0, None) ** 1.5, 0.0)
        a = np.vander(x - g, degree + 1, increasing=True) * w[:, None]
        fit, _, rank, _ = np.linalg.lstsq(a, y * w, rcond=None)
        if rank <= degree:
            return np.interp(grid, x, y)
        out.append(fit[0])
    return np.array(out)


def smooth_peaks(profiles: DataFrame, points: int = 100, span: float = 0.4) -> DataFrame:
    """gene, cond, peak: the first highest point of each smoothed profile (gene, cond, time, value). A profile is one row with its two arrays, smoothed batch by batch."""
    own = F.sort_array(F.collect_list(F.struct(F.col("time").cast("double").alias("x"), F.col("value").alias("y"))))
    arrays = profiles.filter("value IS NOT NULL").groupBy("gene", "cond").agg(own.alias("s")).select("gene", "cond", F.transform("s", lambda e: e["x"]).alias("x"), F.transform("s", lambda e: e["y"]).alias("y"))

    def run(batches):
        for b in batches:
            peaks = []
            for x, y in zip(b.column("x").to_pylist(), b.column("y").to_pylist(), strict=True):
                x, y = np.array(x, float), np.array(y, float)
                grid = np.linspace(x[0], x[-1], points)
                peaks.append(float(grid[np.argmax(loess(x, y, grid, span))]))
            yield pa.record_batch([b.column("gene"), b.column("cond"), pa.array(peaks, pa.float64())], names=["gene", "cond", "peak"])

    return arrays.mapInArrow(run, "gene string, cond string, peak double")


def cluster_limit(n: int, nested: bool = False) -> int:
    """Most clusters for n genes: the root of n and n / 10; inside a cluster fewer for less than 50 and 100 genes."""
    limit = min(int(n**0.5), n // 10)
    if nested and n < 50:
        limit = min(4, limit)
    elif nested and n < 100:
        limit = min(int(n**0.5 / 1.5), n // 10, 6)
    return limit


def limited_counts(counts: list[int], n: int, nested: bool = False) -> list[int]:
    """The numbers of clusters to try for n genes; three at least, if there are so many."""
    kept = [c for c in counts if c <= max(cluster_limit(n, nested), min(counts) + 2)]
    return kept if len(kept) >= 3 else [c for c in range(min(counts), min(counts) + 3) if c <= max(counts)]


def valleys(values: list[float], prominence: float = 0.10) -> list[int]:
    """Places of local minima whose prominence is a share of the range or more.

    A side's peak is the highest value up to the first one below the minimum; the lower of both peaks counts."""
    v = np.array(values, float)
    spread = np.ptp(v) or 1.0
    out = []
    for k in range(1, len(v) - 1):
        if v[k] < v[k - 1] and v[k] <= v[k + 1]:
            sides = []
            for side in (v[:k][::-1], v[k + 1 :]):
                lower = np.flatnonzero(side < v[k])
                sides.append(side[: lower[0] if len(lower) else len(side)].max(initial=v[k]))
            if min(sides) - v[k] >= prominence * spread:
                out.append(k)
    return out


def curve_class(values: list[float], prominence: float = 0.10) -> str:
    """U, valley, monotonic or fluctuating: the form of an index over numbers of clusters.

    U: the means of the first third (two values at least) and of the last third lie 5 % above the least value of the middle half."""
    v, n = np.array(values, float), len(values)
    first, last = v[: max(2, n // 3)], v[max(1, n - n // 3 + 1) - 1 :]
    middle = v[max(2, n // 4) - 1 : max(max(2, n // 4), min(n - 1, 3 * n // 4))]
    if first.mean() > 1.05 * middle.min() and last.mean() > 1.05 * middle.min():
        return "U"
    if valleys(values, prominence):
        return "valley"
    return "monotonic" if n > 1 and (np.diff(v) < 0).mean() > 0.85 else "fluctuating"


def bending(values: list[float]) -> np.ndarray:
    """Curvature |y''| / (1 + y'^2)^1.5 at each place, from its neighbours; 0 at the ends."""
    v = np.array(values, float)
    out = np.zeros(len(v))
    if len(v) >= 3:
        slope = (v[2:] - v[:-2]) / 2
        out[1:-1] = np.abs(np.diff(v, 2)) / (1 + slope**2) ** 1.5
    return out


def lowess(x: np.ndarray, y: np.ndarray, share: float = 0.3, passes: int = 3) -> np.ndarray:
    """Locally weighted lines through the share of nearest points, tricube weights, with bisquare weights of the residuals in some further passes."""
    n = len(x)
    k = max(2, min(n, int(n * share + 1e-7)))
    trust, fit = np.ones(n), y.astype(float)
    for _ in range(passes + 1):
        fit = np.empty(n)
        for i in range(n):
            d = np.abs(x - x[i])
            h = np.sort(d)[k - 1]
            w = np.where(d <= 0.999 * h, np.where(d > 0.001 * h, (1 - np.minimum(1, d / (h or 1)) ** 3) ** 3, 1.0), 0.0) * trust
            if w.sum() <= 0:
                fit[i] = y[i]
                continue
            w = w / w.sum()
            centre = (w * x).sum()
            spread = (w * (x - centre) ** 2).sum()
            fit[i] = (w * y).sum() + ((x[i] - centre) * (w * (x - centre) * y).sum() / spread if np.sqrt(spread) > 0.001 * np.ptp(x) else 0.0)
        left = np.abs(y - fit)
        scale = 6 * np.median(left)
        if scale < 1e-7 * max(1e-300, left.mean()):
            break
        trust = np.where(left <= 0.001 * scale, 1.0, np.where(left <= 0.999 * scale, (1 - np.minimum(1, left / scale) ** 2) ** 2, 0.0))
    return fit


def choose_clusters(counts: list[int], values: list[float], nested: bool = False) -> int:
    """The number of clusters by the form of the index: the least value on a U or valley; on a falling curve the place of most curvature, or a third along where it is flat; else the least value after smoothing.

    Below three numbers the middle one."""
    if len(counts) < 3:
        return counts[(len(counts) + 1) // 2 - 1]
    form = curve_class(values, 0.15 if nested else 0.10)
    if form in ("U", "valley"):
        return counts[int(np.argmin(values))]
    if form == "monotonic":
        bend = bending(values)
        return counts[int(np.argmax(bend[1:-1])) + 1 if bend.max() >= 0.01 else max(2, -(-len(counts) // 3)) - 1]
    smooth = lowess(np.array(counts, float), np.array(values, float), 0.5 if nested else 0.3) if len(counts) >= 4 else np.array(values)
    return counts[int(np.argmin(smooth))]


def _cmeans(x: np.ndarray, clusters: int, m: float = 2.0, rounds: int = 25) -> tuple[np.ndarray, np.ndarray]:
    """(memberships, centres) of fuzzy c-means from evenly spread rows; a small helper for one cluster's genes."""
    centre = x[np.linspace(0, len(x) - 1, clusters).astype(int)]
    for _ in range(rounds):
        d = ((x[:, None] - centre[None]) ** 2).sum(2) + 1e-12
        u = d ** (-1 / (m - 1))
        u = u / u.sum(1, keepdims=True)
        centre = (u.T**m @ x) / (u.T**m).sum(1, keepdims=True)
    return u, centre


def scanned_clusters(x: np.ndarray, counts: list[int], m: float = 2.0, nested: bool = True) -> int:
    """The number of clusters for the rows of x: Kwon's index over the numbers that are allowed for so many rows, until one leaves a cluster without a member of 0.5."""
    tried, values = [], []
    for c in limited_counts(counts, len(x), nested):
        u, centre = _cmeans(x, c, m)
        if (u.max(0) < 0.5).any():
            break
        d = ((x[:, None] - centre[None]) ** 2).sum(2)
        apart = min(((a - b) ** 2).sum() for i, a in enumerate(centre) for b in centre[:i]) if c > 1 else 1.0
        values.append(((u**m * d).sum() + ((centre - centre.mean(0)) ** 2).sum() / c) / max(apart, 1e-12))
        tried.append(c)
    return choose_clusters(tried, values, nested) if tried else min(counts)


def fate_label(shape: Column, amp: Column, phase: Column, limits: tuple[float, float, float] = (0.15, 0.15, 0.25)) -> Column:
    """Shape_Diverged before Amp_Altered before Phase_Shifted, all strict; else Conserved."""
    return F.when(shape > limits[0], "Shape_Diverged").when(amp > limits[1], "Amp_Altered").when(phase > limits[2], "Phase_Shifted").otherwise("Conserved")


def fates(core: DataFrame, profiles: DataFrame, centres: DataFrame, counts: tuple[int, ...] = (2, 3, 4, 5, 6), least: int = 4) -> DataFrame:
    """wt_cluster, gene, sub_cluster, membership, shape, amp, phase, size: what becomes of the core genes of a WT cluster in MUT, by splitting their MUT profiles.

    core: gene, wt_cluster. profiles: gene, z (array by time). centres: wt_cluster, times, centre (arrays). The number of sub-clusters is
    scanned for; shape, amp and phase compare each sub-cluster's centre with the WT centre; size counts members of 0.5 or more. Groups below `least`
    genes drop out; a group is one cluster's core, a list of the study's genes."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("gene")
        names = ["wt_cluster", "gene", "sub_cluster", "membership", "shape", "amp", "phase", "size"]
        if len(pdf) < least:
            return pd.DataFrame([], columns=names)
        x = np.stack(pdf["z"].map(lambda v: np.array(v, float)).to_list())
        u, centre = _cmeans(x, scanned_clusters(x, list(counts)))
        times, wt = np.array(pdf["times"].iloc[0], float), np.array(pdf["centre"].iloc[0], float)
        metrics = compare(np.repeat(wt[None], len(centre), 0), centre, times)
        own = u.argmax(1)
        sizes = (u >= 0.5).sum(0)
        return pd.DataFrame({"wt_cluster": pdf["wt_cluster"], "gene": pdf["gene"], "sub_cluster": own + 1, "membership": u[np.arange(len(x)), own], "shape": metrics["shape"][own], "amp": metrics["amp"][own], "phase": metrics["phase"][own], "size": sizes[own]})

    joined = core.join(profiles, "gene").join(F.broadcast(centres), "wt_cluster")
    out = joined.groupBy("wt_cluster").applyInPandas(one, "wt_cluster int, gene string, sub_cluster int, membership double, shape double, amp double, phase double, size int")
    return out.withColumn("label", fate_label(F.col("shape"), F.col("amp"), F.col("phase")))


def fate_totals(fates_: DataFrame) -> DataFrame:
    """label, genes (sum of the sizes of sub-clusters), n_sub: totals by fate, over the sub-clusters (wt_cluster, sub_cluster, label, size)."""
    each = fates_.select("wt_cluster", "sub_cluster", "label", "size").distinct()
    return each.groupBy("label").agg(F.sum("size").cast("long").alias("genes"), F.count("*").alias("n_sub"))


#: Patterns of a label and the column that its genes count to, first that fits (fixed values).
FATES = (("^Conserved$", "conserved"), ("Shape", "shape_diverged"), ("Phase", "phase_shifted"), ("Amp|Repressed|Enhanced", "amp_altered"))


def fate_composition(fates_: DataFrame) -> DataFrame:
    """wt_cluster with the genes of its sub-clusters by fate, one column each, by the first pattern that a label fits."""
    kind = reduce(lambda tail, f: F.when(F.col("label").rlike(f[0]), f[1]).otherwise(tail), reversed(FATES), F.lit(None))
    each = fates_.select("wt_cluster", "sub_cluster", "label", "size").distinct().withColumn("kind", kind)
    return each.groupBy("wt_cluster").agg(*[F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("size"))), F.lit(0)).cast("long").alias(k) for _, k in FATES])


def cascade(clusters: DataFrame, composition: DataFrame) -> DataFrame:
    """place, and clusters (cluster, stage, peak) with their composition (wt_cluster, ...), in the order of stage, then peak, then cluster. Clusters are some tens."""
    order = F.row_number().over(W.orderBy("stage", "peak", "cluster"))
    return clusters.withColumn("place", order).join(composition.withColumnRenamed("wt_cluster", "cluster"), "cluster", "left")


def unmatched(costs: DataFrame, pairs: DataFrame) -> DataFrame:
    """side, cluster: the clusters of either side (wt, mut) that the assignment leaves without a partner."""
    side = lambda c: costs.select(F.col(c).alias("cluster")).distinct().join(pairs.select(F.col(c).alias("cluster")), "cluster", "left_anti").select(F.lit(c.upper()).alias("side"), "cluster")
    return side("wt").unionByName(side("mut"))
