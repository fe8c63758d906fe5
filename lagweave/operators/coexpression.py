"""Lagged differential co-expression: pairs, ranks, correlations, significance, edge classes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import erfc, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.maths import correlation_p, fisher_z
from ..storage import stored
from .relational import average_rank, false_discovery, lagged_pairs

CLASSES = ("Conserved", "Lost", "Gained", "Rewired", "WT_only", "MUT_only", "NS")


@dataclass(frozen=True)
class EdgeParams:
    lag: int = 1
    fdr: float = 0.05
    fdr_diff: float = 0.05
    fdr_loose: float = 0.10
    least_r: float = 0.0
    self_pairs_count: bool = True


def ranked_pairs(values: DataFrame, lag: int = 1) -> DataFrame:
    """gene, cond, rep, time, rx, ry: average ranks of x and of its later y inside a gene and condition."""
    pairs = lagged_pairs(values, ["gene", "cond", "rep"], lag)
    return pairs.select("gene", "cond", "rep", "time", average_rank("x", ["gene", "cond"]).alias("rx"), average_rank("y", ["gene", "cond"]).alias("ry"))


#: Regulators whose rank arrays are broadcast at a time; at 18 pairs of times and replicates some 3 MB.
REGULATORS = 4096


def lag_correlations(values: DataFrame, tfs: DataFrame, lag: int = 1) -> DataFrame:
    """tf, target, cond, r, n: Spearman correlation of a regulator with each target `lag` times later, over the replicates and times that both have.

    Null where either side is constant. A gene's ranks in a condition are one array; the regulators' arrays are broadcast by blocks of
    bounded size, so that pairs are made and summed up without a shuffle."""
    ranks = ranked_pairs(values, lag)
    own = F.sort_array(F.collect_list(F.struct("rep", "time", "rx", "ry")))
    arrays = ranks.groupBy("gene", "cond").agg(own.alias("s"))
    arrays = stored(arrays.select("gene", "cond", F.transform("s", lambda e: F.struct(e["rep"].alias("rep"), e["time"].alias("time"))).alias("at"), F.transform("s", lambda e: e["rx"]).alias("rx"), F.transform("s", lambda e: e["ry"]).alias("ry")), "rank-arrays")
    x = arrays.join(tfs.select(F.col("tf").alias("gene")).distinct(), "gene").select(F.col("gene").alias("tf"), "cond", F.col("at").alias("at_x"), "rx")
    y = arrays.select(F.col("gene").alias("target"), "cond", F.col("at").alias("at_y"), "ry")
    blocks = -(-max(1, tfs.select("tf").distinct().count()) // REGULATORS)
    parts = [y.join(F.broadcast(x.filter(F.pmod(F.hash("tf"), F.lit(blocks)) == k)), "cond") for k in range(blocks)]
    met = reduce(lambda a, b: a.unionByName(b), parts)
    later = F.map_from_arrays("at_y", "ry")
    aligned = F.when(F.col("at_x") == F.col("at_y"), F.col("ry")).otherwise(F.transform("at_x", lambda k: F.try_element_at(later, k)))
    pairs = F.filter(F.zip_with("rx", aligned, lambda a, b: F.struct(a.alias("a"), b.alias("b"))), lambda p: p["b"].isNotNull())
    total = lambda f: F.aggregate("p", F.lit(0.0), lambda s, p: s + f(p))
    s = met.select("tf", "target", "cond", pairs.alias("p")).filter(F.size("p") > 0).select(
        "tf", "target", "cond", F.size("p").cast("long").alias("n"), total(lambda p: p["a"]).alias("sx"), total(lambda p: p["b"]).alias("sy"),
        total(lambda p: p["a"] * p["b"]).alias("sxy"), total(lambda p: p["a"] * p["a"]).alias("sxx"), total(lambda p: p["b"] * p["b"]).alias("syy"),
    )
    root = F.sqrt((F.col("n") * F.col("sxx") - F.col("sx") ** 2) * (F.col("n") * F.col("syy") - F.col("sy") ** 2))
    return s.select("tf", "target", "cond", F.round(F.try_divide(F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy"), root), 9).alias("r"), "n")


def edge_class(wt: Column, mut: Column, diff: Column, loose: Column) -> Column:
    """Class from the significance in WT (W), in MUT (M), of the difference (D), and loosely in MUT (L)."""
    return (
        F.when(wt & diff & ~loose, "Lost").when(~wt & diff & mut, "Gained").when(wt & diff & loose, "Rewired")
        .when(wt & mut & ~diff, "Conserved").when(wt & ~mut & ~diff, "WT_only").when(~wt & mut & ~diff, "MUT_only").otherwise("NS")
    )


def edges(values: DataFrame, tfs: DataFrame, params: EdgeParams = EdgeParams()) -> DataFrame:
    """tf, target, r_wt, r_mut, p_wt, p_mut, fdr_wt, fdr_mut, z_diff, p_diff, fdr_diff, edge_class, direction.

    The p of a correlation has n - 2 degrees of freedom, by the pair's own n. The p of the difference is the two-sided t of the z (a closed form in place of the permutation null, see permutation_null)."""
    r = lag_correlations(values, tfs, params.lag)
    wide = r.groupBy("tf", "target").agg(*[F.max(F.when(F.col("cond") == c, F.col(v))).alias(f"{v}_{c.lower()}") for c in ("WT", "MUT") for v in ("r", "n")])
    e = wide.withColumns({f"p_{c}": correlation_p(F.col(f"r_{c}"), F.col(f"n_{c}") - 2) for c in ("wt", "mut")})
    z = F.coalesce(fisher_z(F.col("r_wt"), F.col("n_wt"), F.col("r_mut"), F.col("n_mut")), F.lit(0.0))
    e = e.withColumn("z_diff", z)
    e = e.withColumn("p_diff", normal_two_sided(F.col("z_diff")))
    if not params.self_pairs_count:
        e = e.filter("tf <> target")
    if params.least_r:
        strong = F.greatest(F.abs("r_wt"), F.abs("r_mut")) >= params.least_r
        e = e.withColumns({p: F.when(strong, F.col(p)) for p in ("p_wt", "p_mut", "p_diff")})
    e, sides = stored(e, "edge-tests"), ("wt", "mut", "diff")
    tests = e.select("tf", "target", F.explode(F.create_map(*[x for s in sides for x in (F.lit(s), F.col(f"p_{s}"))])).alias("side", "p"))
    fdr = false_discovery(tests, by=["side"]).groupBy("tf", "target").agg(*[F.coalesce(F.max(F.when(F.col("side") == s, F.col("fdr"))), F.lit(1.0)).alias(f"fdr_{s}") for s in sides])
    e = e.join(fdr, ["tf", "target"])
    sig = lambda c, t: F.col(c) < t
    kind = edge_class(sig("fdr_wt", params.fdr), sig("fdr_mut", params.fdr), sig("fdr_diff", params.fdr_diff), sig("fdr_mut", params.fdr_loose))
    lead = F.when(F.col("fdr_wt") < params.fdr, F.col("r_wt")).when(F.col("fdr_mut") < params.fdr, F.col("r_mut"))
    direction = F.when(lead > 0, "positive").when(lead < 0, "negative").otherwise("NS")
    return e.filter("tf <> target").withColumn("edge_class", kind).withColumn("direction", direction).select("tf", "target", "r_wt", "r_mut", "p_wt", "p_mut", "fdr_wt", "fdr_mut", "z_diff", "p_diff", "fdr_diff", "edge_class", "direction")


#: Coefficients of the rational approximation of the normal tail, error below 1.2e-7 (fixed values).
_TAIL = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)


def normal_two_sided(z: Column) -> Column:
    """Two-sided p of a normal z, as a column."""
    x = F.abs(z) / sqrt(2)
    t = 1 / (1 + 0.5 * x)
    total = F.lit(0.0)
    for c in reversed(_TAIL):
        total = F.lit(c) + t * total
    return t * F.exp(-x * x + total)


def normal_two_sided_sql(z: str) -> str:
    x = f"(abs({z}) / {sqrt(2)!r})"
    t = f"(1 / (1 + 0.5 * {x}))"
    total = "0.0"
    for c in reversed(_TAIL):
        total = f"({c!r} + {t} * {total})"
    return f"{t} * exp(-{x} * {x} + {total})"


def shown(edges_: DataFrame) -> DataFrame:
    """A table of tests for reading: p to nine digits, z and FDR to six. Nothing should be computed from it."""
    return edges_.withColumns({c: F.round(c, 9 if c.split("_")[0] == "p" else 6) for c in edges_.columns if c.split("_")[0] in ("p", "fdr", "z")})


def output_mode(edges_: DataFrame, mode: str, fdr: float = 0.05) -> DataFrame:
    """full, classified (any class but NS) or significant (in WT or MUT)."""
    if mode == "classified":
        return edges_.filter("edge_class <> 'NS'")
    return edges_.filter((F.col("fdr_wt") < fdr) | (F.col("fdr_mut") < fdr)) if mode == "significant" else edges_


def tf_summary(edges_: DataFrame) -> DataFrame:
    """Counts and mean strengths by regulator."""
    n = lambda c: F.sum(F.when(F.col("edge_class") == c, 1).otherwise(0)).alias(f"n_{c.lower()}")
    sig = lambda s: F.sum(F.when(F.col(f"fdr_{s}") < 0.05, 1).otherwise(0))
    changed = F.col("edge_class").isin("Lost", "Gained", "Rewired")
    return edges_.groupBy("tf").agg(F.count("*").alias("n"), *map(n, CLASSES), (sig("mut") - sig("wt")).alias("delta_out"), F.round(F.avg(F.abs("r_wt")), 6).alias("mean_wt"), F.round(F.avg(F.when(changed, F.abs(F.col("r_wt") - F.col("r_mut")))), 6).alias("mean_change"))


def permutation_null(values: DataFrame, tfs: DataFrame, rounds: int = 100, lag: int = 1, seed: int = 42, block: int = 256) -> DataFrame:
    """tf, target, z, mean, sd, p: how the difference z compares with relabelled data.

    Each round shuffles the samples of a time between the conditions (the first half of them are the new WT), the same for all
    genes. Genes are rows with an array of values by sample, and stay where they are: a task takes `block` of them at a time against
    the regulators' rows, which are broadcast, for all rounds. Only the sample sheet and the regulators come to the driver.
    p is the one-sided normal tail of |z| against the null's moments, or the empirical (count + 1) / (rounds + 1) where the null does not vary. Genes that lack a sample drop out."""
    spark = values.sparkSession
    sheet = [(r.time, r.cond, r.rep) for r in values.select("time", "cond", "rep").distinct().orderBy("time", "cond", "rep").collect()]
    times = sorted({t for t, _, _ in sheet})
    at = {(t, c): np.array([k for k, (u, d, _) in enumerate(sheet) if (u, d) == (t, c)], np.int64) for t in times for c in ("WT", "MUT")}
    cell = F.sort_array(F.collect_list(F.struct("time", "cond", "rep", "value")))
    whole = values.filter("value IS NOT NULL").groupBy("gene").agg(cell.alias("s")).filter(F.size("s") == len(sheet)).select("gene", F.transform("s", lambda e: e["value"].cast("double")).alias("x"))
    known = whole.join(tfs.select(F.col("tf").alias("gene")).distinct(), "gene").orderBy("gene").limit(REGULATORS + 1).collect()
    if len(known) > REGULATORS:
        raise ValueError(f"more than {REGULATORS} regulators: give them in parts")
    given = spark.sparkContext.broadcast(([r.gene for r in known], np.array([r.x for r in known], float).reshape(len(known), len(sheet))))

    def ranked(x: np.ndarray, groups: dict) -> dict:
        """By condition, the centred ranks of the earlier and of the later values, with their norms."""
        out = {}
        for c in ("WT", "MUT"):
            for side, these in (("x", times[:-lag]), ("y", times[lag:])):
                r = pd.DataFrame(np.concatenate([x[:, groups[t, c]] for t in these], axis=1)).rank(axis=1).to_numpy()
                r = r - r.mean(1, keepdims=True)
                out[c, side] = r, np.sqrt((r**2).sum(1))
        return out

    def z_of(own: dict, other: dict) -> np.ndarray:
        z, spare = [], []
        for c in ("WT", "MUT"):
            (a, na), (b, nb) = own[c, "x"], other[c, "y"]
            scale = na[:, None] * nb[None]
            r = np.divide(a @ b.T, scale, out=np.zeros_like(scale), where=scale > 0)
            z.append(np.arctanh(np.clip(r, -0.9999, 0.9999)))
            spare.append(1 / max(1, a.shape[1] - 3))
        return (z[0] - z[1]) / np.sqrt(sum(spare))

    def relabelled(i: int) -> dict:
        draw, groups = np.random.default_rng([seed, i]), {}
        for t in times:
            both = draw.permutation(np.concatenate([at[t, "WT"], at[t, "MUT"]]))
            groups[t, "WT"], groups[t, "MUT"] = np.split(both, [len(at[t, "WT"])])
        return groups

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, x = given.value
        for b in batches if names else ():
            for k in range(0, b.num_rows, block):
                genes = b.column("gene").slice(k, block).to_pylist()
                y = np.array(b.column("x").slice(k, block).to_pylist(), float)
                real = np.abs(z_of(ranked(x, at), ranked(y, at)))
                count, total, square = (np.zeros_like(real) for _ in range(3))
                for i in range(rounds):
                    groups = relabelled(i)
                    z = np.abs(z_of(ranked(x, groups), ranked(y, groups)))
                    count, total, square = count + (z >= real), total + z, square + z * z
                mean = total / rounds
                sd = np.sqrt(np.maximum(0.0, square / rounds - mean * mean))
                tail = np.array([0.5 * erfc(v / sqrt(2)) for v in ((real - mean) / np.maximum(sd, 1e-10)).ravel()]).reshape(real.shape)
                p = np.where(sd > 1e-10, tail, (count + 1) / (rounds + 1))
                yield pa.record_batch([pa.array(np.repeat(names, len(genes)).tolist(), pa.string()), pa.array(genes * len(names), pa.string()), *(pa.array(np.round(v.ravel(), 6)) for v in (real, mean, sd, p))], names=["tf", "target", "z", "mean", "sd", "p"])

    return whole.withColumn("gene", F.col("gene").cast("string")).mapInArrow(run, "tf string, target string, z double, mean double, sd double, p double")
