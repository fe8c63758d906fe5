"""Scores and tiers of edges, enrichment of classes, anchors, ego networks, pruning and the questions asked of a network."""

from __future__ import annotations

import re
from functools import reduce
from math import lgamma

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.maths import fisher_two_sided, hypergeometric_tail, minus_log10, stars
from ..storage import stored
from .relational import dominant, endpoints, false_discovery, first_per, overlap_labels, shared_targets, touching

CHANGED = ("Lost", "Gained", "Rewired")


# evidence ----------------------------------------------------------------------------------------------------------------


def scored(edges: DataFrame, weights: tuple[float, float, float] = (1.0, 1.0, 1.5)) -> DataFrame:
    """edges with s1, s2, s3, mecs and tier, from fdr_diff, membership, divergence and evidence_rank (null: none).

    s1: -log10 FDR over its 99th percentile among positive ones, at most 1. s2: membership times divergence, null as 0.
    s3: 1 - rank / largest rank, 0 without one. A weight counts only if its evidence is there for some edge."""
    logs = edges.withColumn("l_", F.greatest(F.lit(0.0), minus_log10(F.col("fdr_diff"))))
    facts = logs.agg(F.percentile(F.when(F.col("l_") > 0, F.col("l_")), F.lit(0.99)).alias("cap_"), F.count(F.col("membership") * F.col("divergence")).alias("w2_"), F.max("evidence_rank").alias("worst_"))
    s1 = F.when(F.coalesce("cap_", F.lit(0.0)) > 0, F.least(F.lit(1.0), F.col("l_") / F.col("cap_"))).otherwise(F.least(F.lit(1.0), F.col("l_")))
    e = logs.join(F.broadcast(facts)).withColumns({"s1": F.round(s1 + 0.0, 6), "s2": F.round(F.coalesce(F.col("membership") * F.col("divergence"), F.lit(0.0)), 6), "s3": F.round(F.coalesce(1 - F.col("evidence_rank") / F.col("worst_"), F.lit(0.0)), 6)})
    w1, w2, w3 = F.lit(weights[0]), F.when(F.col("w2_") > 0, weights[1]).otherwise(0.0), F.when(F.col("worst_").isNotNull(), weights[2]).otherwise(0.0)
    e = e.withColumn("mecs", F.round((w1 * F.col("s1") + w2 * F.col("s2") + w3 * F.col("s3")) / (w1 + w2 + w3), 6))
    return e.withColumn("tier", tier(F.col("edge_class"), F.col("s2"), F.col("s3"), F.col("worst_").isNotNull())).drop("l_", "cap_", "w2_", "worst_")


def tier(kind: Column, s2: Column, s3: Column, with_s3: Column) -> Column:
    changed = kind.isin(*CHANGED)
    return (
        F.when(changed & (s2 > 0.5) & (~with_s3 | (s3 > 0)), 1).when(changed & (s2 > 0.5), 2).when(changed, 3)
        .when((kind == "Conserved") & (s2 < 0.2), 4).otherwise(5)
    )


def evidence_ranks(hits: DataFrame) -> DataFrame:
    """cluster, family, max_importance, n_hits, evidence_rank: ties share the least rank, by cluster."""
    best = hits.groupBy("cluster", "family").agg(F.max("importance").alias("max_importance"), F.count("*").alias("n_hits"))
    return best.withColumn("evidence_rank", F.rank().over(W.partitionBy("cluster").orderBy(F.desc("max_importance"))))


def divergence_ratios(fates: DataFrame) -> DataFrame:
    """cluster, n_sub, n_diverged, divergence: of the sub-clusters that a cluster's genes fall into (cluster, sub_cluster, label), the share whose label is not Conserved, to three digits."""
    n = fates.groupBy("cluster").agg(F.count_distinct("sub_cluster").alias("n_sub"), F.count_distinct(F.when(F.col("label") != "Conserved", F.col("sub_cluster"))).alias("n_diverged"))
    return n.withColumn("divergence", F.round(F.col("n_diverged") / F.col("n_sub"), 3))


def class_enrichment(edges: DataFrame, key: str, cluster: str = "cluster", least: int = 1) -> DataFrame:
    """key, cluster, edge_class, q, k, m, all, p, fdr: hypergeometric tail of a key's edges of a class in a cluster.

    Margins are those of the class; edges without a cluster do not count."""
    n = edges.filter(F.col(cluster).isNotNull()).groupBy(key, cluster, "edge_class").agg(F.count("*").alias("q"))
    total = lambda *c: F.sum("q").over(W.partitionBy(*c))
    t = n.withColumns({"m": total(key, "edge_class"), "k": total(cluster, "edge_class"), "all": total("edge_class")}).filter(F.col("q") >= least)
    t = t.withColumn("p", hypergeometric_tail(F.col("q"), F.col("m"), F.col("all") - F.col("m"), F.col("k")))
    return false_discovery(t, "p")


def class_fisher(edges: DataFrame, key: str, cluster: str = "cluster", least: int = 5) -> DataFrame:
    """key, cluster, edge_class, a, b, c, d, odds, log2_odds, p, fdr, score, mark: two-sided Fisher tests; odds is the sample ratio ad / bc."""
    n = edges.filter(F.col(cluster).isNotNull()).groupBy(key, cluster, "edge_class").agg(F.count("*").alias("a"))
    every = W.partitionBy("edge_class")
    t = n.withColumn("b", F.sum("a").over(W.partitionBy(key, "edge_class")) - F.col("a")).withColumn("c", F.sum("a").over(W.partitionBy(cluster, "edge_class")) - F.col("a"))
    t = t.withColumn("d", F.sum("a").over(every) - F.col("a") - F.col("b") - F.col("c")).filter(F.col("a") >= least)
    odds = F.try_divide(F.col("a") * F.col("d"), F.col("b") * F.col("c"))
    t = t.withColumn("odds", F.round(odds, 6)).withColumn("log2_odds", F.round(F.log2(F.greatest(odds, F.lit(1e-10))), 6)).withColumn("p", fisher_two_sided(*(F.col(x) for x in "abcd")))
    return false_discovery(t, "p").withColumn("score", minus_log10(F.col("fdr"), 10.0)).withColumn("mark", stars(F.col("fdr")))


def conditional_odds(tests: DataFrame) -> DataFrame:
    """tests (a, b, c, d) with odds_mle, the conditional maximum-likelihood odds ratio, found by bisection."""
    @F.pandas_udf("double")
    def mle(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
        def one(a: int, b: int, c: int, d: int) -> float:
            m, n, k = a + c, b + d, a + b
            low, high = max(0, k - n), min(k, m)
            if a == low:
                return 0.0
            if a == high:
                return float("inf")
            x = np.arange(low, high + 1)
            base = np.array([-lgamma(i + 1) - lgamma(m - i + 1) - lgamma(k - i + 1) - lgamma(n - k + i + 1) for i in x])

            def mean(log_odds: float) -> float:
                w = base + x * log_odds
                w = np.exp(w - w.max())
                return float((w * x).sum() / w.sum())

            lo, hi = -40.0, 40.0
            for _ in range(100):
                mid = (lo + hi) / 2
                lo, hi = (mid, hi) if mean(mid) < a else (lo, mid)
            return float(np.exp((lo + hi) / 2))

        return pd.Series([one(*v) for v in zip(a, b, c, d, strict=True)])

    return tests.withColumn("odds_mle", mle("a", "b", "c", "d"))


def focus_profile(edges: DataFrame) -> DataFrame:
    """By regulator: counts, cluster specificity, consistency of direction and mean |change| (needs divergence, r_wt, r_mut, direction)."""
    far, lost = F.coalesce(F.col("divergence") > 0.5, F.lit(False)), F.col("edge_class") == "Lost"
    n = lambda c: F.sum(c.cast("long"))
    pos, neg = n(F.col("direction") == "positive"), n(F.col("direction") == "negative")
    csi = F.try_divide(F.try_divide(n(lost & far), n(lost)), F.try_divide(n(far), F.count("*")))
    changed = F.col("edge_class").isin(*CHANGED)
    return edges.groupBy("tf").agg(
        F.count("*").alias("n"), n(lost).alias("n_lost"), n(F.col("edge_class") == "Gained").alias("n_gained"), n(F.col("edge_class") == "Rewired").alias("n_rewired"),
        F.round(csi, 3).alias("csi"), F.round(F.greatest(pos, neg) / F.greatest(F.lit(1), pos + neg), 3).alias("consistency"), F.round(F.avg(F.when(changed, F.abs(F.col("r_wt") - F.col("r_mut")))), 4).alias("rewiring"),
    )


def upstream(edges: DataFrame, gene: str, families: DataFrame) -> DataFrame:
    """Regulators of a gene with their families and the number of regulators of each family."""
    up = edges.filter(F.col("target") == gene).join(families, "tf", "left")
    return up.withColumn("family_n", F.count("*").over(W.partitionBy("family")))


# graph -------------------------------------------------------------------------------------------------------------------


def undirected(edges: DataFrame) -> DataFrame:
    pairs = edges.select(F.col("tf").alias("a"), F.col("target").alias("b"))
    return pairs.union(pairs.select("b", "a")).distinct()


def within_hops(edges: DataFrame, seeds: DataFrame, hops: int) -> DataFrame:
    """node, hop: nodes at most `hops` undirected edges from a seed (node), with the least number of them. Each hop is one join."""
    pairs = undirected(edges)
    reached = seeds.select("node").distinct().withColumn("hop", F.lit(0))
    for k in range(1, hops + 1):
        new = reached.filter(F.col("hop") == k - 1).join(pairs, F.col("node") == F.col("a")).select(F.col("b").alias("node")).distinct()
        reached = reached.unionByName(new.join(reached, "node", "left_anti").withColumn("hop", F.lit(k)))
    return reached


def ego(edges: DataFrame, seeds: DataFrame, hops: int) -> DataFrame:
    """Edges between nodes within some hops of the seeds."""
    near = within_hops(edges, seeds, hops).select("node")
    inside = lambda e, c: e.join(near.select(F.col("node").alias(c)), c, "left_semi")
    return inside(inside(edges, "tf"), "target")


def connected(edges: DataFrame, seed: str, rounds: int = 100) -> DataFrame:
    """node: the component of a seed, hop by hop until nothing is new; each hop is stored. More hops than rounds are an error."""
    spark = edges.sparkSession
    pairs, n = stored(undirected(edges), "pairs"), 1
    reached = new = spark.createDataFrame([(seed,)], "node string")
    for _ in range(rounds):
        new = stored(new.join(pairs, F.col("node") == F.col("a")).select(F.col("b").alias("node")).distinct().join(reached, "node", "left_anti"), "hop")
        if not new.take(1):
            return reached
        reached = reached.union(new)
    raise RuntimeError(f"the component of {seed} has not settled in {rounds} rounds")


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node, component (its least node) for the nodes of edges (a, b); each round is stored in the shared folder.

    Every node's larger neighbours, then its smaller ones, point to its least neighbour: rounds grow with the logarithm of the nodes."""
    now, before = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"), None
    for _ in range(rounds):
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        now = stored(small.select("e.u", "e.v").filter("u <> v").distinct(), "edges")
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003)).first())
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    ends = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return ends.union(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).groupBy("node").agg(F.min("component").alias("component"))


def anchored(edges: DataFrame, primary: DataFrame, hops: int = 2) -> DataFrame:
    """Edges that touch a primary anchor or a secondary one (within some hops of a primary), of the four classes."""
    kept = edges.filter(F.col("edge_class").isin(*CHANGED, "Conserved"))
    return touching(kept, within_hops(kept, primary, hops).select("node"))


def completed(network: DataFrame, edges: DataFrame) -> DataFrame:
    """network with all edges between its own nodes that it lacks."""
    nodes = endpoints(network.select("tf", "target")).distinct()
    inside = edges.join(nodes.select(F.col("node").alias("tf")), "tf", "left_semi").join(nodes.select(F.col("node").alias("target")), "target", "left_semi")
    return network.unionByName(inside.join(network.select("tf", "target"), ["tf", "target"], "left_anti").select(*network.columns))


def graded_anchors(focus_tfs: DataFrame, focus_gene: DataFrame, highlights: DataFrame) -> DataFrame:
    """node, grade: primary for focus regulators, the focus gene (both: node) and highlights of source primary (gene, source); secondary for other highlights that are no primary anchor."""
    primary = focus_tfs.select("node").union(focus_gene.select("node")).union(highlights.filter("source = 'primary'").select(F.col("gene").alias("node"))).distinct()
    rest = highlights.filter("source <> 'primary'").select(F.col("gene").alias("node")).distinct().join(primary, "node", "left_anti")
    return primary.withColumn("grade", F.lit("primary")).unionByName(rest.withColumn("grade", F.lit("secondary")))


def pruned(edges: DataFrame, keep: DataFrame, keep_all: bool = False, focus: DataFrame | None = None) -> DataFrame:
    """Edges whose target has more than one edge that is not Conserved, is a regulator, or is among the nodes to keep.

    keep_all exempts all targets; focus (node) exempts those next to a focus gene, by any edge."""
    if keep_all:
        return edges
    n = endpoints(edges.filter("edge_class <> 'Conserved'").select("tf", "target")).groupBy("node").agg(F.count("*").alias("n"))
    stay = n.filter("n > 1").select("node").union(keep.select("node")).union(edges.select(F.col("tf").alias("node")))
    if focus is not None:
        stay = stay.union(endpoints(touching(edges, focus).select("tf", "target")).select("node"))
    return edges.join(stay.distinct().select(F.col("node").alias("target")), "target", "left_semi").select(*edges.columns)


def tier_capped(edges: DataFrame, n: int, anchors: DataFrame, score: str = "mecs") -> DataFrame:
    """At most n edges, with level: 1 touches a primary anchor, 2 a secondary one (node, grade), 3 none; full levels first, the last by |score|, ties by tf and target."""
    mark = lambda c, grade, flag: anchors.filter(F.col("grade") == grade).select(F.col("node").alias(c)).distinct().withColumn(flag, F.lit(True))
    e = edges
    for grade, flags in (("primary", ("p1_", "p2_")), ("secondary", ("s1_", "s2_"))):
        e = e.join(mark("tf", grade, flags[0]), "tf", "left").join(mark("target", grade, flags[1]), "target", "left")
    level = F.when(F.col("p1_") | F.col("p2_"), 1).when(F.col("s1_") | F.col("s2_"), 2).otherwise(3)
    return e.withColumn("level", level).orderBy("level", F.desc(F.abs(score)), "tf", "target").limit(n).select(*edges.columns, "level")


def display_network(edges: DataFrame, n: int, anchors: DataFrame, focus_gene: str, keep: DataFrame, score: str = "mecs") -> DataFrame:
    """The network of a figure: capped by tiers, pruned again, and cut to what still connects to the focus gene, if that is left in it."""
    cut = stored(pruned(tier_capped(edges, n, anchors, score), keep), "network")
    if not cut.filter((F.col("tf") == focus_gene) | (F.col("target") == focus_gene)).take(1):
        return cut
    near = connected(cut, focus_gene)
    for end in ("tf", "target"):
        cut = cut.join(near.select(F.col("node").alias(end)), end, "left_semi")
    return cut


def capped(edges: DataFrame, n: int, primary: DataFrame) -> DataFrame:
    """At most n edges: those between primary anchors first, then those that touch one, then others, each by |z_diff|."""
    mark = lambda c, flag: primary.select(F.col("node").alias(c), F.lit(1).alias(flag)).distinct()
    e = edges.join(mark("tf", "a_"), "tf", "left").join(mark("target", "b_"), "target", "left").fillna(0, ["a_", "b_"])
    return e.withColumn("level", 3 - F.col("a_") - F.col("b_")).orderBy("level", F.desc(F.abs("z_diff")), "tf", "target").limit(n).select(*edges.columns, "level")


def node_table(edges: DataFrame, families: DataFrame, focus: list[str], highlights: DataFrame) -> DataFrame:
    """node, kind, family, degree; kind by the first that holds: focus regulator, regulator, highlight, target."""
    n = endpoints(edges.select("tf", "target")).groupBy("node").agg(F.count("*").alias("degree"))
    out = n.join(families.select(F.col("tf").alias("node"), "family"), "node", "left").join(highlights.select(F.col("gene").alias("node"), F.lit(True).alias("h_")).distinct(), "node", "left")
    kind = F.when(F.col("node").isin(focus) & F.col("family").isNotNull(), "Focus TF").when(F.col("family").isNotNull(), "Other TF").when(F.col("h_"), "Highlight").otherwise("Target")
    return out.select("node", kind.alias("kind"), "family", "degree")


# questions ---------------------------------------------------------------------------------------------------------------


def gene_edges(edges: DataFrame, genes: list[str]) -> DataFrame:
    """Edges out of and into the genes, with the gene asked for and the side."""
    out = edges.filter(F.col("tf").isin(genes)).select(F.col("tf").alias("gene"), F.lit("Out").alias("side"), F.col("target").alias("partner"), "edge_class", "r_wt", "r_mut")
    into = edges.filter(F.col("target").isin(genes)).select(F.col("target").alias("gene"), F.lit("In").alias("side"), F.col("tf").alias("partner"), "edge_class", "r_wt", "r_mut")
    return out.unionByName(into)


def with_symbols(nodes: DataFrame, *symbols: DataFrame) -> DataFrame:
    """nodes (node) with label: the first symbol that is there and not empty, of several lists (gene, symbol) in this order, else the node itself."""
    out = nodes
    for k, s in enumerate(symbols):
        out = out.join(s.filter("symbol IS NOT NULL AND symbol <> ''").groupBy(F.col("gene").alias("node")).agg(F.min("symbol").alias(f"s{k}_")), "node", "left")
    names = [f"s{k}_" for k in range(len(symbols))]
    return out.withColumn("label", F.coalesce(*names, "node")).drop(*names)


def reference_overlap(edges: DataFrame, reference: str) -> DataFrame:
    """node, overlap: how many of a reference regulator's targets each regulator has, as 'common/size(percent%)'; '---' for itself, and nodes without targets as such."""
    targets = edges.select(F.col("tf").alias("node"), "target").distinct()
    ref = targets.filter(F.col("node") == reference).select("target")
    size = ref.agg(F.count("*").alias("n_"))
    common = targets.join(F.broadcast(ref.withColumn("r_", F.lit(1))), "target", "left").groupBy("node").agg(F.count("r_").alias("c_"))
    nodes = endpoints(edges.select("tf", "target")).select("node").distinct().join(common, "node", "left").join(F.broadcast(size))
    share = F.concat(F.col("c_").cast("string"), F.lit("/"), F.col("n_").cast("string"), F.lit("("), F.bround(F.try_divide(100 * F.col("c_"), F.col("n_")), 0).cast("int").cast("string"), F.lit("%)"))
    return nodes.select("node", F.when(F.col("node") == reference, "---").when(F.col("c_").isNull(), "--- (pure target)").otherwise(share).alias("overlap"))


def subspace_pools(edges: DataFrame, least: int = 3) -> DataFrame:
    """target, public, private, gained, degree, n_lost: which pools a target lies in, those of regulators (out-degree `least` or more) whose most frequent class is Conserved, Lost or Gained; with its edges and how many are Lost.

    Pool sizes and overlaps are counts of the flags; targets both public and private are junctions."""
    spaces = subspace(edges, least)
    has = lambda c: F.array_contains(F.split("spaces", "&"), c)
    n = endpoints(edges.select("tf", "target", "edge_class")).groupBy(F.col("node").alias("target")).agg(F.count("*").alias("degree"), F.sum((F.col("edge_class") == "Lost").cast("long")).alias("n_lost"))
    return spaces.select("target", has("Conserved").alias("public"), has("Lost").alias("private"), has("Gained").alias("gained")).join(n, "target")


def pool_overlaps(pools: DataFrame) -> DataFrame:
    """One row: sizes of the pools of subspace_pools() and of their overlaps."""
    n = lambda *c: F.coalesce(F.sum(reduce(lambda a, b: a & b, [F.col(x) for x in c]).cast("long")), F.lit(0))
    return pools.agg(n("public").alias("n_public"), n("private").alias("n_private"), n("gained").alias("n_gained"), n("public", "private").alias("n_junction"), n("public", "gained").alias("n_public_gained"), n("private", "gained").alias("n_private_gained"))


def divergence_summary(divergence: DataFrame) -> DataFrame:
    """cluster, edge_class, time, n, mean_diff, sd_diff, mean_wt, mean_mut of the genes' changes (cluster, edge_class, time, wt, mut)."""
    d = F.col("wt") - F.col("mut")
    return divergence.groupBy("cluster", "edge_class", "time").agg(F.count("*").alias("n"), F.round(F.avg(d), 4).alias("mean_diff"), F.round(F.stddev_samp(d), 4).alias("sd_diff"), F.round(F.avg("wt"), 4).alias("mean_wt"), F.round(F.avg("mut"), 4).alias("mean_mut"))


def full_report(edges: DataFrame, genes: list[str], least: int = 1) -> DataFrame:
    """section, key, text: the modes' results as one table of lines: topology, pools, shared targets of the first two genes, overlaps, and the genes' own edges."""
    line = lambda section, key, df, *c: df.select(F.lit(section).alias("section"), F.col(key).cast("string").alias("key"), F.concat_ws(" ", *[F.concat(F.lit(f"{x}="), F.coalesce(F.col(x).cast("string"), F.lit("NA"))) for x in c]).alias("text"))
    top = topology(edges, least)
    parts = [line("topology", "node", top, *top.columns[1:]), line("subspace", "target", subspace(edges, 3), "spaces", "n_tf")]
    own = gene_edges(edges, genes)
    parts.append(line("profile", "gene", own, "side", "partner", "edge_class"))
    if len(genes) > 1:
        sets = edges.filter(F.col("tf").isin(genes)).select(F.col("tf").alias("set"), F.col("target").alias("item"))
        parts.append(line("overlap", "a", overlap_labels(sets), "b", "label"))
        parts.append(line("shared", "target", shared_targets(edges.withColumn("r", F.col("r_wt")), *genes[:2]), "class_a", "class_b"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def cytoscape_nodes(nodes: DataFrame) -> DataFrame:
    """Node_ID, Display_Label, NodeType, Family, Degree: the columns of a network program's node file, from node_table() with labels."""
    return nodes.select(F.col("node").alias("Node_ID"), F.col("label").alias("Display_Label"), F.col("kind").alias("NodeType"), F.coalesce("family", F.lit("NA")).alias("Family"), F.col("degree").alias("Degree"))


def cytoscape_edges(edges: DataFrame) -> DataFrame:
    """Source, Target, Edge_Class, Delta_r and, where they are there, MECS_Score and Tier: the columns of a network program's edge file."""
    more = [F.col(c).alias(n) for c, n in (("mecs", "MECS_Score"), ("tier", "Tier")) if c in edges.columns]
    return edges.select(F.col("tf").alias("Source"), F.col("target").alias("Target"), F.col("edge_class").alias("Edge_Class"), F.round(F.col("r_wt") - F.col("r_mut"), 6).alias("Delta_r"), *more)


def resolved_clusters(wanted: list[str], have: list[str]) -> dict[str, str]:
    """Each wanted cluster name with the column it stands for: the same name, else the first that holds it without its condition (so C1 can stand for C10); names without one drop out."""
    out = {}
    for name in wanted:
        bare = re.sub(r"^(WT_|MUT_)", "", name)
        found = [name] if name in have else [h for h in have if bare and re.search(bare, h)]
        if found:
            out[name] = found[0]
    return out


def topology(edges: DataFrame, least: int = 1) -> DataFrame:
    """node, out, in, degree and edges by class, for nodes with `least` edges or more."""
    kinds = ("Conserved", *CHANGED)
    sides = edges.select(F.col("tf").alias("node"), F.lit(1).alias("o"), F.lit(0).alias("i"), "edge_class").unionByName(edges.select(F.col("target").alias("node"), F.lit(0).alias("o"), F.lit(1).alias("i"), "edge_class"))
    t = sides.groupBy("node").agg(F.sum("o").alias("n_out"), F.sum("i").alias("n_in"), F.count("*").alias("degree"), *[F.sum((F.col("edge_class") == k).cast("long")).alias(f"n_{k.lower()}") for k in kinds])
    return t.filter(F.col("degree") >= least)


def subspace(edges: DataFrame, least: int = 3) -> DataFrame:
    """target, spaces: the dominant classes (Conserved, Lost, Gained) of the regulators of a target that have `least` edges or more."""
    out = edges.groupBy("tf").agg(F.count("*").alias("n_")).filter(F.col("n_") >= least).select("tf")
    lead = dominant(edges.join(out, "tf", "left_semi"), "tf", "edge_class").filter(F.col("edge_class").isin("Conserved", "Lost", "Gained")).select("tf", F.col("edge_class").alias("space"))
    return edges.select("tf", "target").distinct().join(lead, "tf").groupBy("target").agg(F.array_join(F.sort_array(F.collect_set("space")), "&").alias("spaces"), F.count_distinct("tf").alias("n_tf"))


def automatic_highlights(memberships: DataFrame, edges: DataFrame, per_cluster: int = 50, tier_: int = 3, least: int = 1) -> DataFrame:
    """gene: the strongest members of each cluster that have `least` edges or more of at most that tier."""
    best = memberships.withColumn("k_", F.row_number().over(W.partitionBy("cluster").orderBy(F.desc("membership"), "gene"))).filter(F.col("k_") <= per_cluster)
    backed = endpoints(edges.filter(F.col("tier") <= tier_).select("tf", "target")).groupBy("node").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    return best.join(backed.select(F.col("node").alias("gene")), "gene", "left_semi").select("gene", "cluster", "membership")


def marked_changes(contrasts: DataFrame, padj: float = 0.05, lfc: float = 1.0) -> DataFrame:
    """contrasts with star (by padj) and box: the side that is higher where the change is significant and large."""
    star = F.when(F.col("padj") < 0.001, "***").when(F.col("padj") < 0.01, "**").when(F.col("padj") < 0.05, "*").otherwise("")
    box = F.when((F.col("padj") < padj) & (F.abs("lfc") >= lfc), F.when(F.col("lfc") > 0, "later").otherwise("base"))
    return contrasts.withColumn("star", star).withColumn("box", box)


def volcano_points(contrasts: DataFrame, labels: list[str], most_x: float, most_y: float) -> DataFrame:
    """contrast, gene, label (of the listed genes only), x (lfc) and y (-log10 p), both capped."""
    y = F.least(F.lit(most_y), minus_log10(F.col("p")))
    return contrasts.select("contrast", "gene", F.when(F.col("gene").isin(labels), F.col("gene")).otherwise("").alias("label"), F.greatest(F.lit(-most_x), F.least(F.lit(most_x), F.col("lfc"))).alias("x"), F.round(y, 6).alias("y"))


def first_family(tfs: DataFrame) -> DataFrame:
    return first_per(tfs, ["tf"], [F.col("family")])
