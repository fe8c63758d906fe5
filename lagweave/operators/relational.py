"""Filters, joins, aggregates, windows, top-k, sets and reshaping over relations."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


# filters ---------------------------------------------------------------------------------------------------------------


def aligned(values: DataFrame, sheet: DataFrame, on: list[str]) -> DataFrame:
    """Rows of values whose sample the sheet has."""
    return values.join(sheet.select(*on).distinct(), on, "left_semi")


def expressed(counts: DataFrame, key: str = "gene", count: str = "n", least: int = 10, samples: int = 3) -> DataFrame:
    """Rows of the keys with `least` or more in at least `samples` samples."""
    keep = counts.groupBy(key).agg(F.sum(F.when(F.col(count) >= least, 1).otherwise(0)).alias("k_")).filter(F.col("k_") >= samples)
    return counts.join(keep.select(key), key, "left_semi")


def differential(contrasts: DataFrame, fdr: float = 0.05, lfc: float = 1.0, padj: str = "padj") -> DataFrame:
    """Rows with padj < fdr and |lfc| > lfc, both strict; a null in either drops the row."""
    return contrasts.filter((F.col(padj) < fdr) & (F.abs("lfc") > lfc))


def directional(contrasts: DataFrame, fdr: float = 0.05, lfc: float = 1.0, padj: str = "padj") -> DataFrame:
    """Differential rows with direction Up (lfc > t) or Down (lfc < -t)."""
    return differential(contrasts, fdr, lfc, padj).withColumn("direction", F.when(F.col("lfc") > lfc, "Up").otherwise("Down"))


def varying_inside(values: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the keys whose values differ at all; constant ones would leave nothing to a component."""
    have = values.groupBy(*keys).agg(F.var_samp("value").alias("v_")).filter(F.col("v_") > 0)
    return values.join(have.select(*keys), keys, "left_semi")


def target_filter(edges_or_genes: DataFrame, mode: str, common: DataFrame | None = None, changed: DataFrame | None = None, key: str = "gene") -> DataFrame:
    """Rows whose key is among the clustered genes (mode `mfuzz`) or those whose fate is not Conserved (`non_conserved`); all of them for `all`, and where the list is not there."""
    wanted = {"mfuzz": common, "non_conserved": changed}.get(mode)
    return edges_or_genes if wanted is None else edges_or_genes.join(wanted.select(F.col("gene").alias(key)).distinct(), key, "left_semi")


def time_columns(df: DataFrame, conditions: list[str], time: str = r"\d+h$") -> list[str]:
    """The columns that start with a condition and end in a time, and no others."""
    return [c for c in df.columns if any(c.startswith(f"{k}_") for k in conditions) and re.search(time, c)]


def contrast_parts(contrasts: DataFrame) -> DataFrame:
    """cond_ and time_ from names like Time_WT_3_vs_0; other names drop out."""
    pattern = r"^(?:Time|TimeCourse)_([^_]+)_(.+?)_vs_"
    out = contrasts.withColumn("cond_", F.regexp_extract("contrast", pattern, 1)).withColumn("time_", F.regexp_extract("contrast", pattern, 2))
    return out.filter(F.col("cond_") != "")


def complete(values: DataFrame, keys: list[str], axis: str, n: int) -> DataFrame:
    """Rows of the keys that have all n values of the axis."""
    have = values.filter(F.col("value").isNotNull()).groupBy(*keys).agg(F.count_distinct(axis).alias("k_")).filter(F.col("k_") == n)
    return values.join(have.select(*keys), keys, "left_semi")


def varying(values: DataFrame, keys: list[str], least: float) -> DataFrame:
    """Rows of the keys whose sample standard deviation is `least` or more."""
    have = values.groupBy(*keys).agg(F.stddev_samp("value").alias("s_")).filter(F.col("s_") >= least)
    return values.join(have.select(*keys), keys, "left_semi")


def nonresponsive(genes: DataFrame, responsive: DataFrame, lfc: float | None, least: float = 1.0) -> DataFrame:
    """Genes with max |lfc| below lfc and mean of `least` or more, without the responsive ones; lfc None takes all."""
    pool = genes if lfc is None else genes.filter((F.col("max_lfc") < lfc) & (F.col("mean") >= least))
    return pool.join(responsive.select("gene"), "gene", "left_anti")


# joins -----------------------------------------------------------------------------------------------------------------


def wide(values: DataFrame, key: str, column: str, value: str, names: list | None = None, fill: float = 0.0) -> DataFrame:
    """One row for each key and one column for each name, missing cells filled: an N-way full join without joins."""
    grouped = values.groupBy(key)
    return (grouped.pivot(column, names) if names else grouped.pivot(column)).agg(F.sum(value)).fillna(fill)


def first_per(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in a stated order."""
    return df.withColumn("k_", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter("k_ = 1").drop("k_")


def lookup_first(df: DataFrame, right: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Left join to the first row of each key on the right, so that no row of df is repeated."""
    return df.join(first_per(right, keys, order), keys, "left")


def endpoints(edges: DataFrame, a: str = "tf", b: str = "target") -> DataFrame:
    """node: both ends of each edge."""
    return edges.select(F.explode(F.array(a, b)).alias("node"), *[c for c in edges.columns if c not in (a, b)])


def touching(edges: DataFrame, anchors: DataFrame, a: str = "tf", b: str = "target") -> DataFrame:
    """Edges with an end among the anchors (node)."""
    mark = lambda c, flag: anchors.select(F.col("node").alias(c)).distinct().withColumn(flag, F.lit(True))
    out = edges.join(mark(a, "a_"), a, "left").join(mark(b, "b_"), b, "left")
    return out.filter(F.col("a_") | F.col("b_")).select(*edges.columns)


def shared_targets(edges: DataFrame, one: str, other: str) -> DataFrame:
    """target, with what both regulators do to it, for the targets of both."""
    side = lambda tf, name: edges.filter(F.col("tf") == tf).select("target", F.col("edge_class").alias(f"class_{name}"), F.col("r").alias(f"r_{name}"))
    return side(one, "a").join(side(other, "b"), "target")


def merged_highlights(primary: DataFrame, automatic: DataFrame) -> DataFrame:
    """gene, source: the user's list as primary, and what the automatic list adds as secondary."""
    own = primary.select("gene").distinct()
    return own.withColumn("source", F.lit("primary")).unionByName(automatic.select("gene").distinct().join(own, "gene", "left_anti").withColumn("source", F.lit("secondary")))


# aggregates ------------------------------------------------------------------------------------------------------------


def max_fold(values: DataFrame, control: int | None = None) -> DataFrame:
    """gene, max_lfc, mean: the largest |difference| of a gene's means from those at the control time, or at its condition's first time where there is none."""
    means = values.groupBy("gene", "cond", "time").agg(F.avg("value").alias("m"))
    own = W.partitionBy("gene", "cond")
    first = F.first("m").over(own.orderBy("time").rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    base = first if control is None else F.coalesce(F.max(F.when(F.col("time") == control, F.col("m"))).over(own), first)
    return means.withColumn("d", F.abs(F.col("m") - base)).groupBy("gene").agg(F.max("d").alias("max_lfc"), F.avg("m").alias("mean"))


def genotype_contrasts(groups: DataFrame, control: str) -> DataFrame:
    """target, reference, time, contrast for the pairs of conditions that a time has (cond, time): the control is the reference, without it the first in order."""
    a, b = groups.select("time", F.col("cond").alias("target")), groups.select("time", F.col("cond").alias("reference"))
    pairs = a.join(b, "time").filter((F.col("target") != F.col("reference")) & ((F.col("reference") == control) | ((F.col("target") != control) & (F.col("reference") < F.col("target")))))
    return pairs.select("target", "reference", "time", F.format_string("Genotype_%s_vs_%s_at_%d", "target", "reference", "time").alias("contrast"))


def confusion(a: DataFrame, b: DataFrame) -> DataFrame:
    """wt_cluster, mut_cluster, overlap, total, ratio: for each cluster of a, the cluster of b that shares most genes; ties to the smaller."""
    n = a.select("gene", F.col("cluster").alias("wt_cluster")).join(b.select("gene", F.col("cluster").alias("mut_cluster")), "gene").groupBy("wt_cluster", "mut_cluster").agg(F.count("*").alias("overlap"))
    by = W.partitionBy("wt_cluster")
    n = n.withColumn("total", F.sum("overlap").over(by)).withColumn("k_", F.row_number().over(by.orderBy(F.desc("overlap"), "mut_cluster")))
    return n.filter("k_ = 1").select("wt_cluster", "mut_cluster", "overlap", "total", F.round(F.col("overlap") / F.col("total"), 3).alias("ratio"))


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Counts of a column's values with their share as a label in whole percent."""
    n = df.groupBy(column).agg(F.count("*").alias("n"))
    return n.withColumn("label", F.concat(F.round(100 * F.col("n") / F.sum("n").over(W.partitionBy()), 0).cast("int").cast("string"), F.lit("%")))


def dominant(df: DataFrame, key: str, column: str, last: str | None = None) -> DataFrame:
    """key, its most frequent value of the column and the count; ties to the first in order; `last` wins only if it is alone."""
    n = df.groupBy(key, column).agg(F.count("*").alias("n"))
    order = ([(F.col(column) == last).cast("int")] if last else []) + [F.desc("n"), F.col(column)]
    return first_per(n, [key], order)


def degrees(edges: DataFrame, without: str = "Conserved") -> DataFrame:
    """node, degree, effective (without the class that does not count)."""
    return endpoints(edges.select("tf", "target", "edge_class")).groupBy("node").agg(F.count("*").alias("degree"), F.sum((F.col("edge_class") != without).cast("long")).alias("effective"))


def group_statistics(df: DataFrame, by: list[str], value: str, member: str) -> DataFrame:
    """n, total, mean, largest value and the members, joined by ';' in order of value, of each group."""
    own = F.sort_array(F.collect_list(F.struct((-F.col(value)).alias("v"), F.col(member).alias("m"))))
    return df.groupBy(*by).agg(F.count("*").alias("n"), F.round(F.sum(value), 6).alias("total"), F.round(F.avg(value), 6).alias("mean"), F.max(value).alias("largest"), F.array_join(F.transform(own, lambda x: x["m"].cast("string")), ";").alias("members"))


def quantile(df: DataFrame, column: str, q: list[float], by: list[str] = ()) -> DataFrame:
    """Exact quantiles with linear interpolation, one column q<percent> each."""
    return df.groupBy(*by).agg(*[F.percentile(column, F.lit(x)).alias(f"q{int(x * 100)}") for x in q])


# windows and top-k -----------------------------------------------------------------------------------------------------


def ranked(df: DataFrame, by: list[str], order: list[Column], name: str = "rank") -> DataFrame:
    return df.withColumn(name, F.row_number().over(W.partitionBy(*by).orderBy(*order)))


def top(df: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of each group."""
    return ranked(df, by, order, "k_").filter(F.col("k_") <= n).drop("k_")


def replicate_index(samples: DataFrame, by: list[str], order: str) -> DataFrame:
    """samples with rep_idx, their place in the group in the order of the sheet, whatever a replicate column says."""
    return samples.withColumn("rep_idx", F.row_number().over(W.partitionBy(*by).orderBy(order)))


def average_rank(column: str, by: list[str]) -> Column:
    """Rank in a group, ties averaged."""
    own = W.partitionBy(*by)
    return F.rank().over(own.orderBy(column)) + (F.count("*").over(W.partitionBy(*by, column)) - 1) / 2


def lagged_pairs(values: DataFrame, keys: list[str], lag: int = 1) -> DataFrame:
    """keys, time, x, y: each value with that of the same series `lag` distinct times later; a series without it drops out."""
    times = values.select("time").distinct()
    order = times.withColumn("i_", F.dense_rank().over(W.orderBy("time")))
    v = values.join(order, "time")
    later = v.select(*keys, F.col("value").alias("y"), (F.col("i_") - lag).alias("i_"))
    return v.select(*keys, "time", F.col("value").alias("x"), "i_").join(later, [*keys, "i_"]).drop("i_")


def false_discovery(df: DataFrame, p: str = "p", by: list[str] = (), name: str = "fdr") -> DataFrame:
    """Benjamini-Hochberg by groups; null p stays null and does not count.

    Counted by distinct p first, then in two levels: steps of p (64 to each halving, some 70 thousand at most) are summed up in order, and the
    distinct p of one step are ordered among themselves, so that no task orders all p of a group."""
    by = list(by)
    step = F.when(F.col(p) > 0, F.floor(F.log2(p) * 64)).otherwise(-(1 << 20)).cast("int")
    n = df.filter(F.col(p).isNotNull()).groupBy(*by, p).agg(F.count("*").alias("n_")).withColumn("g_", step)
    in_order, inside = W.partitionBy(*by).orderBy("g_"), W.partitionBy(*by, "g_")
    sums = n.groupBy(*by, "g_").agg(F.sum("n_").alias("s_")).withColumns({"before_": F.sum("s_").over(in_order) - F.col("s_"), "all_": F.sum("s_").over(W.partitionBy(*by))})
    n = n.join(sums.drop("s_"), [*by, "g_"]).withColumn("at_", F.col("before_") + F.sum("n_").over(inside.orderBy(p)))
    n = n.withColumn("q_", F.col(p) * F.col("all_") / F.col("at_"))
    later = F.min("low_").over(W.partitionBy(*by).orderBy(F.desc("g_")).rowsBetween(W.unboundedPreceding, -1))
    lows = n.groupBy(*by, "g_").agg(F.min("q_").alias("low_")).withColumn("later_", later).drop("low_")
    n = n.join(lows, [*by, "g_"]).withColumn(name, F.least(F.lit(1.0), F.min("q_").over(inside.orderBy(F.desc(p))), "later_"))
    return df.join(n.select(*by, p, name), [*by, p], "left")


def value_rank(df: DataFrame, p: str, order: list[str], name: str = "rank") -> DataFrame:
    """df with the rank, from 1, of all its rows by a share p and then by other columns, without ordering them in one task: steps of p (64 to each halving) are counted first."""
    step = F.when(F.col(p) > 0, F.floor(F.log2(p) * 64)).otherwise(-(1 << 20)).cast("int")
    d = df.withColumn("g_", step)
    before = d.groupBy("g_").agg(F.count("*").alias("n_")).withColumn("before_", F.sum("n_").over(W.orderBy("g_")) - F.col("n_")).drop("n_")
    own = F.row_number().over(W.partitionBy("g_").orderBy(p, *order))
    return d.join(F.broadcast(before), "g_").withColumn(name, F.col("before_") + own).drop("g_", "before_")


def digest_rank(df: DataFrame, by: list[str], digest: Column, name: str = "k_") -> DataFrame:
    """df with the rank, from 1, of a row in its group by a hexadecimal digest. Counts of the digests' first three digits come first, so that no task orders a whole group."""
    d = df.withColumn("digest_", digest).withColumn("g_", F.substring("digest_", 1, 3))
    counts = d.groupBy(*by, "g_").agg(F.count("*").alias("n_"))
    before = counts.withColumn("before_", F.sum("n_").over(W.partitionBy(*by).orderBy("g_")) - F.col("n_")).drop("n_")
    own = F.row_number().over(W.partitionBy(*by, "g_").orderBy("digest_"))
    return d.join(before, [*by, "g_"]).withColumn(name, F.col("before_") + own).drop("digest_", "g_", "before_")


def tiered_cap(edges: DataFrame, n: int, level: Column, score: str, keys: list[str]) -> DataFrame:
    """At most n edges, filled level by level, by |score|."""
    return edges.orderBy(level, F.desc(F.abs(score)), *keys).limit(n)


# sets ------------------------------------------------------------------------------------------------------------------


def venn(a: DataFrame, b: DataFrame) -> DataFrame:
    """gene, part: both, only_a or only_b."""
    x, y = a.select("gene").distinct().withColumn("a_", F.lit(True)), b.select("gene").distinct().withColumn("b_", F.lit(True))
    return x.join(y, "gene", "full").select("gene", F.when(F.col("a_") & F.col("b_"), "both").when(F.col("a_"), "only_a").otherwise("only_b").alias("part"))


def set_overlaps(members: DataFrame) -> DataFrame:
    """a, b, common, overlap (of the smaller set), jaccard, share (of b), for pairs of sets (set, item) with a <= b that share an item, and each with itself."""
    m = members.select("set", "item").distinct()
    size = m.groupBy("set").agg(F.count("*").alias("n"))
    common = m.select(F.col("set").alias("a"), "item").join(m.select(F.col("set").alias("b"), "item"), "item").filter("a <= b").groupBy("a", "b").agg(F.count("*").alias("common"))
    both = common.join(size.select(F.col("set").alias("a"), F.col("n").alias("na")), "a").join(size.select(F.col("set").alias("b"), F.col("n").alias("nb")), "b")
    return both.select("a", "b", "common", F.round(F.col("common") / F.least("na", "nb"), 6).alias("overlap"), F.round(F.col("common") / (F.col("na") + F.col("nb") - F.col("common")), 6).alias("jaccard"), F.round(F.col("common") / F.col("nb"), 6).alias("share"))


def overlap_labels(members: DataFrame) -> DataFrame:
    """a, b, common, label for all pairs of sets (set, item) that share an item, and each with itself: 'common/size of b(percent%)', and the size alone on the diagonal."""
    m = members.select("set", "item").distinct()
    size = m.groupBy(F.col("set").alias("b")).agg(F.count("*").alias("nb"))
    common = m.select(F.col("set").alias("a"), "item").join(m.select(F.col("set").alias("b"), "item"), "item").groupBy("a", "b").agg(F.count("*").alias("common")).join(size, "b")
    share = F.concat(F.col("common").cast("string"), F.lit("/"), F.col("nb").cast("string"), F.lit("("), F.bround(100 * F.col("common") / F.col("nb"), 0).cast("int").cast("string"), F.lit("%)"))
    return common.select("a", "b", "common", F.when(F.col("a") == F.col("b"), F.col("nb").cast("string")).otherwise(share).alias("label"))


def overlap_matrix(members: DataFrame, names: list[str]) -> DataFrame:
    """One row a set, one column for each of the named sets, with the labels of their overlap; '0/n(0%)' is left null where nothing is shared."""
    return overlap_labels(members.filter(F.col("set").isin(names))).groupBy("a").pivot("b", names).agg(F.first("label"))


def intersections(members: DataFrame) -> DataFrame:
    """pattern, n: how many items lie in exactly the sets of a pattern, most first."""
    return members.groupBy("item").agg(F.array_join(F.sort_array(F.collect_set("set")), "&").alias("pattern")).groupBy("pattern").agg(F.count("*").alias("n"))
