"""Time profiles, fuzzy memberships and validity of clusters as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def profiles(values: DataFrame) -> DataFrame:
    """gene, cond, time, value: means over replicates."""
    return values.groupBy("gene", "cond", "time").agg(F.avg("value").alias("value"))


def standardised(profile: DataFrame, n_times: int = 7, least: float = 1e-9) -> DataFrame:
    """Profiles with all times and some spread, with z: centred and scaled by the sample deviation."""
    own = W.partitionBy("gene", "cond")
    p = profile.withColumns({"k_": F.count("*").over(own), "s_": F.stddev_samp("value").over(own), "m_": F.avg("value").over(own)})
    return p.filter((F.col("k_") == n_times) & (F.col("s_") > least)).select("gene", "cond", "time", "value", ((F.col("value") - F.col("m_")) / F.col("s_")).alias("z"))


def squared_distances(z: DataFrame, centres: DataFrame) -> DataFrame:
    """gene, cond, cluster, d2 of profiles (z by time) from centres (cond, cluster, time, centre)."""
    return z.join(centres, ["cond", "time"]).groupBy("gene", "cond", "cluster").agg(F.sum((F.col("z") - F.col("centre")) ** 2).alias("d2"))


def fuzzy_membership(z: DataFrame, centres: DataFrame, m: float = 2.0) -> DataFrame:
    """gene, cond, cluster, membership: the membership step of fuzzy c-means with fuzzifier m."""
    own = W.partitionBy("gene", "cond")
    weight = F.pow(1 / F.greatest("d2", F.lit(1e-12)), 1 / (m - 1))
    exact = F.min("d2").over(own) < 1e-12
    u = F.when(exact, F.when(F.col("d2") < 1e-12, 1.0).otherwise(0.0)).otherwise(weight / F.sum(weight).over(own))
    return squared_distances(z, centres).withColumn("membership", F.round(u, 6)).select("gene", "cond", "cluster", "membership")


def centre_step(z: DataFrame, membership: DataFrame, m: float = 2.0) -> DataFrame:
    """cond, cluster, time, centre: the centre step of fuzzy c-means."""
    w = F.pow("membership", F.lit(m))
    return z.join(membership, ["gene", "cond"]).groupBy("cond", "cluster", "time").agg((F.sum(w * F.col("z")) / F.sum(w)).alias("centre"))


def fuzzy_cmeans(z: DataFrame, centres: DataFrame, m: float = 2.0, rounds: int = 10) -> tuple[DataFrame, DataFrame]:
    """(memberships, centres) after some rounds of both steps; the centres, a few numbers, cut the lineage each round."""
    spark = z.sparkSession
    for _ in range(rounds):
        centres = spark.createDataFrame(centre_step(z, fuzzy_membership(z, centres, m), m).collect(), "cond string, cluster int, time int, centre double")
    return fuzzy_membership(z, centres, m), centres


def core(membership: DataFrame, cutoff: float = 0.5) -> DataFrame:
    return membership.filter(F.col("membership") >= cutoff)


def best_cluster(membership: DataFrame) -> DataFrame:
    """gene, cond, cluster of the largest membership; ties to the smaller."""
    return membership.groupBy("gene", "cond").agg(F.min_by("cluster", F.struct(-F.col("membership"), "cluster")).alias("cluster"))


def validity(z: DataFrame, membership: DataFrame, centres: DataFrame, m: float = 2.0) -> DataFrame:
    """cond, xie_beni, kwon: compactness over the least distance of two centres; Kwon adds the mean spread of the centres and does not divide by the genes."""
    compact = squared_distances(z, centres).join(membership, ["gene", "cond", "cluster"]).groupBy("cond").agg(F.sum(F.pow("membership", F.lit(m)) * F.col("d2")).alias("j"), F.count_distinct("gene").alias("n"), F.count_distinct("cluster").alias("c"))
    a, b = (centres.select("cond", "time", F.col("cluster").alias(k), F.col("centre").alias(v)) for k, v in (("i", "x"), ("k", "y")))
    apart = a.join(b, ["cond", "time"]).filter("i < k").groupBy("cond", "i", "k").agg(F.sum((F.col("x") - F.col("y")) ** 2).alias("d")).groupBy("cond").agg(F.min("d").alias("apart"))
    middle = centres.withColumn("mean_", F.avg("centre").over(W.partitionBy("cond", "time"))).groupBy("cond").agg(F.sum((F.col("centre") - F.col("mean_")) ** 2).alias("spread"))
    return compact.join(apart, "cond").join(middle, "cond").select("cond", F.round(F.col("j") / (F.col("n") * F.col("apart")), 6).alias("xie_beni"), F.round((F.col("j") + F.col("spread") / F.col("c")) / F.col("apart"), 6).alias("kwon"))


def curvature(profile: DataFrame) -> DataFrame:
    """gene, cond, time, slope (central difference, one-sided at the ends) and second difference."""
    w = W.partitionBy("gene", "cond").orderBy("time")
    before, after, t0, t1 = F.lag("value").over(w), F.lead("value").over(w), F.lag("time").over(w), F.lead("time").over(w)
    slope = (F.coalesce(after, F.col("value")) - F.coalesce(before, F.col("value"))) / (F.coalesce(t1, F.col("time")) - F.coalesce(t0, F.col("time")))
    return profile.select("gene", "cond", "time", F.round(slope, 9).alias("slope"), F.round(after - 2 * F.col("value") + before, 9).alias("bend"))


def peak(profile: DataFrame) -> DataFrame:
    """gene, cond, peak: the first time of the largest value."""
    return profile.groupBy("gene", "cond").agg(F.min_by("time", F.struct(-F.col("value"), "time")).alias("peak"))


def regulation_status(df: DataFrame, shape: float = 0.15, amp: float = 0.15, phase: float = 0.25) -> DataFrame:
    """status of a matched pair of clusters from shape, amp, phase, range_wt, range_mut: shape before amplitude before phase, all strict."""
    status = F.when(F.col("shape") > shape, "Shape_Altered").when((F.col("amp") > amp) & (F.col("range_mut") < F.col("range_wt")), "Amplitude_Repressed").when(F.col("amp") > amp, "Amplitude_Enhanced").when(F.col("phase") > phase, "Phase_Shifted").otherwise("Conserved")
    return df.withColumn("status", status)


#: The constants of the fuzzifier below are its published ones (fixed values).
def fuzzifier(n: int, d: int, compat: bool = False) -> float:
    """Fuzzifier from genes and times, in its published form, clipped to 1.25 to 2; compat keeps 0.1134 outside the exponent."""
    from math import log

    first = (1418 / n + 22.05) * d**-2
    second = (12.33 / n + 0.243) * (d ** (-0.0406 * log(n)) - 0.1134 / (12.33 / n + 0.243) if compat else d ** (-0.0406 * log(n) - 0.1134))
    return min(2.0, max(1.25, 1 + first + second))
