"""The flagship query, edges from expression, and what is asked of them, with the SQL that they are held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.maths import correlation_p_sql, fisher_two_sided_sql, hypergeometric_tail_sql
from ..operators import coexpression as X
from ..operators import network as N
from ..operators import profiles as P
from ..operators import relational as R
from ..sources.views import MEMBERSHIPS_SQL, REGULATORS_SQL, expression, expression_sql, memberships, regulators
from ..storage import once

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


DF = 16


def _complete(spark: SparkSession, sf: str) -> DataFrame:
    """Expression of the genes with all 2 x 7 x 3 cells, stored once for each folder of inputs."""

    def make() -> DataFrame:
        values = once(spark, "expression", sf, make=lambda: expression(spark, sf))
        have = values.groupBy("gene").agg(F.count("*").alias("k_")).filter("k_ = 42")
        return values.join(have.select("gene"), "gene", "left_semi")

    return once(spark, "complete", sf, make=make)


def _edges(spark: SparkSession, sf: str, params: X.EdgeParams = X.EdgeParams()) -> DataFrame:
    """The edge table of these inputs and parameters, stored once: what is asked of it starts from there."""
    return once(spark, "edges", sf, params, make=lambda: X.edges(_complete(spark, sf), regulators(spark, sf), params))


def _members(spark: SparkSession, sf: str) -> DataFrame:
    return once(spark, "memberships", sf, make=lambda: memberships(spark, sf))


def _divergence(members: DataFrame) -> DataFrame:
    """cluster, divergence: for each WT cluster the share of MUT clusters that its genes go to which are not its own."""
    best = P.best_cluster(members)
    side = lambda c, n: best.filter(F.col("cond") == c).select("gene", F.col("cluster").alias(n))
    fate = side("WT", "cluster").join(side("MUT", "sub_cluster"), "gene").withColumn("label", F.when(F.col("cluster") == F.col("sub_cluster"), "Conserved").otherwise("Diverged"))
    return N.divergence_ratios(fate).select("cluster", "divergence")


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    """Edges with the cluster, membership and divergence of the target and the rank of the regulator's family there; stored once."""

    def make() -> DataFrame:
        members = _members(spark, sf)
        m = members.filter("cond = 'WT'")
        own = P.best_cluster(m).join(m, ["gene", "cond", "cluster"]).select(F.col("gene").alias("target"), "cluster", "membership")
        e = _edges(spark, sf).join(own, "target", "left").join(F.broadcast(_divergence(members)), "cluster", "left")
        e = e.join(regulators(spark, sf), "tf")
        hits = e.filter("cluster IS NOT NULL AND r_wt > 0.2").select("cluster", "family", F.col("r_wt").alias("importance"))
        return N.scored(e.join(N.evidence_ranks(hits).select("cluster", "family", "evidence_rank"), ["cluster", "family"], "left"))

    return once(spark, "scored", sf, make=make)


def _bh(name: str, src: str, p: str, out: str) -> str:
    return f"""{name}_u AS (SELECT {p}, count(*) AS n FROM {src} WHERE {p} IS NOT NULL GROUP BY ALL),
    {name}_c AS (SELECT {p}, sum(n) OVER (ORDER BY {p}) AS at_, sum(n) OVER () AS all_ FROM {name}_u),
    {name} AS (SELECT {p}, least(1.0, min({p} * all_ / at_) OVER (ORDER BY {p} DESC)) AS {out} FROM {name}_c)"""


EDGES = f"""{expression_sql()}, {REGULATORS_SQL},
whole AS (SELECT * FROM expr WHERE gene IN (SELECT gene FROM expr GROUP BY gene HAVING count(*) = 42)),
pairs AS (SELECT a.gene, a.cond, a.rep, a.time, a.value AS x, b.value AS y FROM whole a JOIN whole b ON a.gene = b.gene AND a.cond = b.cond AND a.rep = b.rep AND b.time = a.time + 1),
ranks AS (SELECT gene, cond, rep, time, rank() OVER (PARTITION BY gene, cond ORDER BY x) + (count(*) OVER (PARTITION BY gene, cond, x) - 1) / 2.0 AS rx,
  rank() OVER (PARTITION BY gene, cond ORDER BY y) + (count(*) OVER (PARTITION BY gene, cond, y) - 1) / 2.0 AS ry FROM pairs),
sums AS (SELECT a.gene AS tf, b.gene AS target, a.cond, count(*) AS n, sum(a.rx) AS sx, sum(b.ry) AS sy, sum(a.rx * b.ry) AS sxy, sum(a.rx * a.rx) AS sxx, sum(b.ry * b.ry) AS syy
  FROM ranks a JOIN tfs ON a.gene = tfs.tf JOIN ranks b USING (cond, rep, time) GROUP BY ALL),
corr AS (SELECT tf, target, cond, n, round((n * sxy - sx * sy) / nullif(sqrt((n * sxx - sx * sx) * (n * syy - sy * sy)), 0), 9) AS r FROM sums),
wide AS (SELECT tf, target, max(r) FILTER (cond = 'WT') AS r_wt, max(r) FILTER (cond = 'MUT') AS r_mut, max(n) AS n FROM corr GROUP BY ALL),
tested AS (SELECT *, {correlation_p_sql('r_wt', DF)} AS p_wt, {correlation_p_sql('r_mut', DF)} AS p_mut,
  coalesce((atanh(greatest(-0.9999, least(0.9999, r_wt))) - atanh(greatest(-0.9999, least(0.9999, r_mut)))) / sqrt(2.0 / greatest(1, n - 3)), 0.0) AS z_diff FROM wide),
zed AS (SELECT *, {X.normal_two_sided_sql('z_diff')} AS p_diff FROM tested),
{_bh('b1', 'zed', 'p_wt', 'fdr_wt')}, {_bh('b2', 'zed', 'p_mut', 'fdr_mut')}, {_bh('b3', 'zed', 'p_diff', 'fdr_diff')},
rated AS (SELECT tf, target, r_wt, r_mut, p_wt, p_mut, coalesce(fdr_wt, 1.0) AS fdr_wt, coalesce(fdr_mut, 1.0) AS fdr_mut, z_diff, p_diff, coalesce(fdr_diff, 1.0) AS fdr_diff
  FROM zed JOIN b1 USING (p_wt) JOIN b2 USING (p_mut) JOIN b3 USING (p_diff) WHERE tf <> target),
flags AS (SELECT *, fdr_wt < 0.05 AS w, fdr_mut < 0.05 AS m, fdr_diff < 0.05 AS d, fdr_mut < 0.1 AS l FROM rated),
edges AS (SELECT tf, target, r_wt, r_mut, p_wt, p_mut, fdr_wt, fdr_mut, z_diff, p_diff, fdr_diff,
  CASE WHEN w AND d AND NOT l THEN 'Lost' WHEN NOT w AND d AND m THEN 'Gained' WHEN w AND d AND l THEN 'Rewired' WHEN w AND m AND NOT d THEN 'Conserved' WHEN w AND NOT m AND NOT d THEN 'WT_only' WHEN NOT w AND m AND NOT d THEN 'MUT_only' ELSE 'NS' END AS edge_class,
  CASE WHEN CASE WHEN w THEN r_wt WHEN m THEN r_mut END > 0 THEN 'positive' WHEN CASE WHEN w THEN r_wt WHEN m THEN r_mut END < 0 THEN 'negative' ELSE 'NS' END AS direction FROM flags)"""

SCORED = f"""{EDGES}, {MEMBERSHIPS_SQL},
own AS (SELECT gene AS target, cluster, membership FROM (SELECT *, row_number() OVER (PARTITION BY gene ORDER BY membership DESC, cluster) AS k FROM members WHERE cond = 'WT') WHERE k = 1),
best_of AS (SELECT gene, cond, cluster FROM (SELECT *, row_number() OVER (PARTITION BY gene, cond ORDER BY membership DESC, cluster) AS k FROM members) WHERE k = 1),
ratios AS (SELECT a.cluster, round(count(DISTINCT b.cluster) FILTER (b.cluster <> a.cluster) / count(DISTINCT b.cluster), 3) AS divergence FROM best_of a JOIN best_of b ON a.gene = b.gene AND a.cond = 'WT' AND b.cond = 'MUT' GROUP BY a.cluster),
placed AS (SELECT e.*, o.cluster, o.membership, r.divergence, f.family FROM edges e LEFT JOIN own o USING (target) LEFT JOIN ratios r ON o.cluster = r.cluster JOIN tfs f ON e.tf = f.tf),
hits AS (SELECT cluster, family, max(r_wt) AS max_importance, count(*) AS n_hits FROM placed WHERE cluster IS NOT NULL AND r_wt > 0.2 GROUP BY ALL),
hit_ranks AS (SELECT cluster, family, rank() OVER (PARTITION BY cluster ORDER BY max_importance DESC) AS evidence_rank FROM hits),
joined AS (SELECT p.*, h.evidence_rank, greatest(0.0, -log10(greatest(fdr_diff, 1e-300))) AS lg FROM placed p LEFT JOIN hit_ranks h ON p.cluster = h.cluster AND p.family = h.family),
facts AS (SELECT coalesce(quantile_cont(lg, 0.99) FILTER (lg > 0), 0.0) AS cap, count(membership * divergence) AS w2, max(evidence_rank) AS worst FROM joined),
parts AS (SELECT j.*, facts.*, round(CASE WHEN cap > 0 THEN least(1.0, lg / cap) ELSE least(1.0, lg) END, 6) AS s1, round(coalesce(membership * divergence, 0.0), 6) AS s2, round(coalesce(1 - evidence_rank / worst, 0.0), 6) AS s3 FROM joined j, facts),
scored AS (SELECT *, round((s1 + CASE WHEN w2 > 0 THEN 1.0 ELSE 0.0 END * s2 + CASE WHEN worst IS NOT NULL THEN 1.5 ELSE 0.0 END * s3) / (1 + CASE WHEN w2 > 0 THEN 1.0 ELSE 0.0 END + CASE WHEN worst IS NOT NULL THEN 1.5 ELSE 0.0 END), 6) AS mecs,
  CASE WHEN edge_class IN ('Lost', 'Gained', 'Rewired') AND s2 > 0.5 AND (worst IS NULL OR s3 > 0) THEN 1 WHEN edge_class IN ('Lost', 'Gained', 'Rewired') AND s2 > 0.5 THEN 2 WHEN edge_class IN ('Lost', 'Gained', 'Rewired') THEN 3 WHEN edge_class = 'Conserved' AND s2 < 0.2 THEN 4 ELSE 5 END AS tier FROM parts)"""


SHOWN = ", ".join(f"round({c}, {n}) AS {c}" for c, n in (("p_wt", 9), ("p_mut", 9), ("p_diff", 9), ("z_diff", 6), ("fdr_wt", 6), ("fdr_mut", 6), ("fdr_diff", 6)))


@query(f"WITH {EDGES} SELECT * REPLACE ({SHOWN}) FROM edges")
def edges_lag1(spark, sf):
    """ST4-ST7, ST10, ST11: lag-1 differential co-expression edges."""
    return X.shown(_edges(spark, sf))


@query(f"WITH {EDGES} SELECT tf, target, edge_class FROM edges WHERE fdr_wt < 0.3 OR fdr_mut < 0.3")
def flt12_significant(spark, sf):
    return X.output_mode(_edges(spark, sf), "significant", 0.3).select("tf", "target", "edge_class")


@query(f"WITH {EDGES} SELECT tf, target, cond, r, n FROM corr")
def st4_lag_correlations(spark, sf):
    return X.lag_correlations(_complete(spark, sf), regulators(spark, sf))


@query(f"""WITH {EDGES} SELECT tf, count(*) AS n, {', '.join(f"count(*) FILTER (edge_class = '{c}') AS n_{c.lower()}" for c in X.CLASSES)},
count(*) FILTER (fdr_mut < 0.05) - count(*) FILTER (fdr_wt < 0.05) AS delta_out, round(avg(abs(r_wt)), 6) AS mean_wt, round(avg(abs(r_wt - r_mut)) FILTER (edge_class IN ('Lost', 'Gained', 'Rewired')), 6) AS mean_change FROM edges GROUP BY tf""")
def agg4_tf_summary(spark, sf):
    return X.tf_summary(_edges(spark, sf))


@query(f"WITH {SCORED} SELECT tf, target, s1, s2, s3, mecs, tier FROM scored")
def st23_scored_edges(spark, sf):
    """ST20-ST23: evidence, weighted score and tier."""
    return _scored(spark, sf).select("tf", "target", "s1", "s2", "s3", "mecs", "tier")


ENRICHED = f"""{SCORED}, kinds AS (SELECT tf, family, cluster, target, CASE WHEN r_wt > 0.3 THEN 'Lost' WHEN r_wt < -0.3 THEN 'Gained' ELSE 'Conserved' END AS edge_class FROM scored WHERE cluster IS NOT NULL)"""


def _kinds(spark, sf):
    """Edges classed by the strength in WT, so that every class has some."""
    kind = F.when(F.col("r_wt") > 0.3, "Lost").when(F.col("r_wt") < -0.3, "Gained").otherwise("Conserved")
    return _scored(spark, sf).filter("cluster IS NOT NULL").select("tf", "family", "cluster", "target", kind.alias("edge_class"))


@query(f"""WITH {ENRICHED}, t AS (SELECT tf, cluster, edge_class, count(*) AS q FROM kinds GROUP BY ALL),
g AS (SELECT *, CAST(sum(q) OVER (PARTITION BY tf, edge_class) AS BIGINT) AS m, CAST(sum(q) OVER (PARTITION BY cluster, edge_class) AS BIGINT) AS k, CAST(sum(q) OVER (PARTITION BY edge_class) AS BIGINT) AS every FROM t),
h AS (SELECT *, {hypergeometric_tail_sql('q', 'm', '(every - m)', 'k')} AS p FROM g), {_bh('bh', 'h', 'p', 'fdr')}
SELECT tf, cluster, edge_class, q, m, k, round(p, 9) AS p, round(fdr, 6) AS fdr FROM h JOIN bh USING (p)""")
def st12_hub_enrichment(spark, sf):
    return X.shown(N.class_enrichment(_kinds(spark, sf), "tf")).select("tf", "cluster", "edge_class", "q", "m", "k", "p", "fdr")


@query(f"""WITH {ENRICHED}, t AS (SELECT family, cluster, edge_class, count(*) AS a FROM kinds GROUP BY ALL),
g AS (SELECT *, CAST(sum(a) OVER (PARTITION BY family, edge_class) AS BIGINT) - a AS b, CAST(sum(a) OVER (PARTITION BY cluster, edge_class) AS BIGINT) - a AS c, CAST(sum(a) OVER (PARTITION BY edge_class) AS BIGINT) AS every FROM t),
f AS (SELECT *, every - a - b - c AS d FROM g WHERE a >= 2),
h AS (SELECT *, {fisher_two_sided_sql('a', 'b', 'c', 'd')} AS p, round(CASE WHEN b * c > 0 THEN a * d / (b * c) END, 6) AS odds FROM f), {_bh('bh', 'h', 'p', 'fdr')}
SELECT family, cluster, edge_class, a, b, c, d, odds, round(p, 9) AS p, round(fdr, 6) AS fdr, CASE WHEN fdr < 0.01 THEN '**' WHEN fdr < 0.05 THEN '*' ELSE '' END AS mark FROM h JOIN bh USING (p)""")
def st13_family_fisher(spark, sf):
    return X.shown(N.class_fisher(_kinds(spark, sf), "family", least=2)).select("family", "cluster", "edge_class", "a", "b", "c", "d", "odds", "p", "fdr", "mark")


@query("")
def st13_conditional_odds(spark, sf):
    return N.conditional_odds(N.class_fisher(_kinds(spark, sf), "family", least=2)).select("family", "cluster", "edge_class", "odds", F.round("odds_mle", 6).alias("odds_mle"))


@query(f"""WITH {SCORED} SELECT tf, count(*) AS n, count(*) FILTER (edge_class = 'Lost') AS n_lost, count(*) FILTER (edge_class = 'Gained') AS n_gained, count(*) FILTER (edge_class = 'Rewired') AS n_rewired,
round((count(*) FILTER (edge_class = 'Lost' AND divergence > 0.5) / nullif(count(*) FILTER (edge_class = 'Lost'), 0)) / nullif(count(*) FILTER (divergence > 0.5) / count(*), 0), 3) AS csi,
round(greatest(count(*) FILTER (direction = 'positive'), count(*) FILTER (direction = 'negative')) / greatest(1, count(*) FILTER (direction IN ('positive', 'negative'))), 3) AS consistency,
round(avg(abs(r_wt - r_mut)) FILTER (edge_class IN ('Lost', 'Gained', 'Rewired')), 4) AS rewiring FROM scored GROUP BY tf""")
def st18_focus_profile(spark, sf):
    return N.focus_profile(_scored(spark, sf))


@query(f"WITH {EDGES} SELECT e.tf, e.edge_class, f.family, count(*) OVER (PARTITION BY f.family) AS family_n FROM edges e LEFT JOIN tfs f ON e.tf = f.tf WHERE e.target = 'Brand#22'")
def st19_upstream(spark, sf):
    return N.upstream(_edges(spark, sf), "Brand#22", regulators(spark, sf)).select("tf", "edge_class", "family", "family_n")


NET = f"{EDGES}, net AS (SELECT tf, target, z_diff, r_wt, r_mut, CASE WHEN r_wt > 0.3 THEN 'Lost' WHEN r_wt < -0.3 THEN 'Gained' ELSE 'Conserved' END AS edge_class FROM edges WHERE abs(r_wt) > 0.25)"


def _net(spark, sf):
    kind = F.when(F.col("r_wt") > 0.3, "Lost").when(F.col("r_wt") < -0.3, "Gained").otherwise("Conserved")
    return _edges(spark, sf).filter(F.abs("r_wt") > 0.25).select("tf", "target", "z_diff", "r_wt", "r_mut", kind.alias("edge_class"))


HOPS = """pairs_ AS (SELECT tf AS a, target AS b FROM net UNION SELECT target, tf FROM net),
h0 AS (SELECT 'Brand#11' AS node), h1 AS (SELECT DISTINCT b AS node FROM pairs_ JOIN h0 ON a = node WHERE b NOT IN (SELECT node FROM h0)),
h2 AS (SELECT DISTINCT b AS node FROM pairs_ JOIN h1 ON a = node WHERE b NOT IN (SELECT node FROM h0 UNION SELECT node FROM h1)),
near AS (SELECT node, 0 AS hop FROM h0 UNION ALL SELECT node, 1 FROM h1 UNION ALL SELECT node, 2 FROM h2)"""


@query(f"WITH {NET}, {HOPS} SELECT node, hop FROM near")
def gr2_secondary_anchors(spark, sf):
    return N.within_hops(_net(spark, sf), spark.createDataFrame([("Brand#11",)], "node string"), 2)


@query(f"WITH {NET}, {HOPS} SELECT tf, target, edge_class FROM net WHERE tf IN (SELECT node FROM near WHERE hop < 2) OR target IN (SELECT node FROM near WHERE hop < 2)")
def gr3_anchor_edges(spark, sf):
    return N.anchored(_net(spark, sf), spark.createDataFrame([("Brand#11",)], "node string"), 1).select("tf", "target", "edge_class")


@query(f"WITH {NET}, {HOPS} SELECT tf, target, edge_class FROM net WHERE tf IN (SELECT node FROM near WHERE hop < 2) AND target IN (SELECT node FROM near WHERE hop < 2)")
def gr7_ego(spark, sf):
    return N.ego(_net(spark, sf), spark.createDataFrame([("Brand#11",)], "node string"), 1).select("tf", "target", "edge_class")


@query(f"WITH {NET}, one AS (SELECT * FROM net WHERE tf = 'Brand#11'), nodes AS (SELECT tf AS node FROM one UNION SELECT target FROM one) SELECT tf, target, edge_class FROM net WHERE tf IN (SELECT node FROM nodes) AND target IN (SELECT node FROM nodes)")
def gr4_completed(spark, sf):
    net = _net(spark, sf)
    return N.completed(net.filter("tf = 'Brand#11'"), net).select("tf", "target", "edge_class")


@query(f"WITH {NET}, ends AS (SELECT tf AS node FROM net WHERE edge_class <> 'Conserved' UNION ALL SELECT target FROM net WHERE edge_class <> 'Conserved'), many AS (SELECT node FROM ends GROUP BY node HAVING count(*) > 1) SELECT tf, target, edge_class FROM net WHERE target IN (SELECT node FROM many UNION SELECT tf FROM net UNION SELECT 'Brand#22')")
def gr6_pruned(spark, sf):
    return N.pruned(_net(spark, sf), spark.createDataFrame([("Brand#22",)], "node string")).select("tf", "target", "edge_class")


@query(f"WITH {NET} SELECT tf, target, 3 - CASE WHEN tf IN ('Brand#11', 'Brand#13') THEN 1 ELSE 0 END - CASE WHEN target IN ('Brand#11', 'Brand#13') THEN 1 ELSE 0 END AS level FROM net ORDER BY level, abs(z_diff) DESC, tf, target LIMIT 40")
def gr8_capped(spark, sf):
    return N.capped(_net(spark, sf), 40, spark.createDataFrame([("Brand#11",), ("Brand#13",)], "node string")).select("tf", "target", "level")


@query(f"WITH {NET}, ends AS (SELECT tf AS node FROM net UNION ALL SELECT target FROM net) SELECT node, CASE WHEN node = 'Brand#11' THEN 'Focus TF' WHEN family IS NOT NULL THEN 'Other TF' WHEN node = 'Brand#22' THEN 'Highlight' ELSE 'Target' END AS kind, family, count(*) AS degree FROM ends LEFT JOIN tfs ON node = tfs.tf GROUP BY ALL")
def gr9_nodes(spark, sf):
    return N.node_table(_net(spark, sf), regulators(spark, sf), ["Brand#11"], spark.createDataFrame([("Brand#22",)], "gene string"))


@query(f"WITH {NET} SELECT tf AS gene, 'Out' AS side, target AS partner, edge_class, r_wt, r_mut FROM net WHERE tf IN ('Brand#11', 'Brand#22') UNION ALL SELECT target, 'In', tf, edge_class, r_wt, r_mut FROM net WHERE target IN ('Brand#11', 'Brand#22')")
def gr10_gene_edges(spark, sf):
    return N.gene_edges(_net(spark, sf), ["Brand#11", "Brand#22"])


@query(f"WITH {NET}, s AS (SELECT tf AS node, 1 AS o, edge_class FROM net UNION ALL SELECT target, 0, edge_class FROM net) SELECT node, CAST(sum(o) AS BIGINT) AS n_out, CAST(sum(1 - o) AS BIGINT) AS n_in, count(*) AS degree, count(*) FILTER (edge_class = 'Conserved') AS n_conserved, count(*) FILTER (edge_class = 'Lost') AS n_lost, count(*) FILTER (edge_class = 'Gained') AS n_gained, count(*) FILTER (edge_class = 'Rewired') AS n_rewired FROM s GROUP BY node HAVING count(*) >= 3")
def agg13_topology(spark, sf):
    return N.topology(_net(spark, sf), 3)


@query(f"""WITH {NET}, big AS (SELECT tf FROM net GROUP BY tf HAVING count(*) >= 3), c AS (SELECT tf, edge_class, count(*) AS n FROM net JOIN big USING (tf) GROUP BY ALL), lead AS (SELECT tf, edge_class AS space FROM (SELECT *, row_number() OVER (PARTITION BY tf ORDER BY n DESC, edge_class) AS k FROM c) WHERE k = 1)
SELECT target, array_to_string(list_sort(list_distinct(list(space))), '&') AS spaces, count(DISTINCT tf) AS n_tf FROM net JOIN lead USING (tf) GROUP BY target""")
def set7_subspace(spark, sf):
    return N.subspace(_net(spark, sf), 3)


@query(f"WITH {SCORED}, best AS (SELECT gene, cluster, membership FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY membership DESC, gene) AS k FROM members WHERE cond = 'WT') WHERE k <= 5), backed AS (SELECT tf AS gene FROM scored WHERE tier <= 5 UNION SELECT target FROM scored WHERE tier <= 5) SELECT gene, cluster, membership FROM best SEMI JOIN backed USING (gene)")
def gr11_highlights(spark, sf):
    return N.automatic_highlights(_members(spark, sf).filter("cond = 'WT'"), _scored(spark, sf), 5, 5)


@query(f"WITH {NET} SELECT target AS node, tf AS a, n AS b FROM (SELECT target, tf, row_number() OVER (PARTITION BY target ORDER BY abs(z_diff) DESC, tf) AS n FROM net) WHERE n <= 2")
def top3_best_two(spark, sf):
    out = R.ranked(_net(spark, sf), ["target"], [F.desc(F.abs("z_diff")), F.col("tf")], "b").filter("b <= 2")
    return out.select(F.col("target").alias("node"), F.col("tf").alias("a"), F.col("b").cast("long").alias("b"))


@query("")
def st8_permutation_null(spark, sf):
    """ST8, ST9: the null of the difference by relabelling the samples of each time."""
    return X.permutation_null(_complete(spark, sf), regulators(spark, sf), rounds=40)


# profiles and clusters -----------------------------------------------------------------------------------------------------


@query(f"WITH {expression_sql()}, {MEMBERSHIPS_SQL} SELECT * FROM members")
def cl1_membership(spark, sf):
    return memberships(spark, sf)


@query(f"WITH {expression_sql()}, {MEMBERSHIPS_SQL} SELECT * FROM members WHERE membership >= 0.5")
def flt9_core(spark, sf):
    return P.core(memberships(spark, sf))


@query(f"WITH {expression_sql()}, {MEMBERSHIPS_SQL} SELECT cond, cluster, time, round(sum(membership ** 2 * z) / sum(membership ** 2), 5) AS centre FROM stand JOIN members USING (gene, cond) GROUP BY ALL")
def cl1_centres(spark, sf):
    z = P.standardised(P.profiles(expression(spark, sf)))
    return P.centre_step(z, memberships(spark, sf)).withColumn("centre", F.round("centre", 5))


CENTRES = """cent AS (SELECT s.cond, n.cluster, s.time, s.z AS centre FROM stand s JOIN names n USING (gene)),
compact AS (SELECT d.cond, sum(m.membership ** 2 * d.d2) AS j, count(DISTINCT d.gene) AS n, count(DISTINCT d.cluster) AS c FROM dists d JOIN members m USING (gene, cond, cluster) GROUP BY ALL),
apart AS (SELECT cond, min(d) AS apart FROM (SELECT a.cond, a.cluster AS i, b.cluster AS k, sum((a.centre - b.centre) ** 2) AS d FROM cent a JOIN cent b ON a.cond = b.cond AND a.time = b.time AND a.cluster < b.cluster GROUP BY ALL) GROUP BY cond),
mid AS (SELECT cond, sum((centre - m) ** 2) AS spread FROM (SELECT *, avg(centre) OVER (PARTITION BY cond, time) AS m FROM cent) GROUP BY cond)"""


@query(f"WITH {expression_sql()}, {MEMBERSHIPS_SQL}, {CENTRES} SELECT cond, round(j / (n * apart), 4) AS xie_beni, round((j + spread / c) / apart, 4) AS kwon FROM compact JOIN apart USING (cond) JOIN mid USING (cond)")
def cl3_validity(spark, sf):
    from pyspark.sql import Window as W

    z = P.standardised(P.profiles(expression(spark, sf)))
    names = z.select("gene").distinct().orderBy("gene").limit(3).withColumn("cluster", F.row_number().over(W.orderBy("gene")))
    v = P.validity(z, memberships(spark, sf), z.join(names, "gene").select("cond", "cluster", "time", F.col("z").alias("centre")))
    return v.select("cond", F.round("xie_beni", 4).alias("xie_beni"), F.round("kwon", 4).alias("kwon"))


@query(f"WITH {expression_sql()}, prof AS (SELECT gene, cond, time, avg(value) AS v FROM expr GROUP BY ALL), n AS (SELECT *, lag(v) OVER w AS a, lead(v) OVER w AS b, lag(time) OVER w AS t0, lead(time) OVER w AS t1 FROM prof WINDOW w AS (PARTITION BY gene, cond ORDER BY time)) SELECT gene, cond, time, round((coalesce(b, v) - coalesce(a, v)) / (coalesce(t1, time) - coalesce(t0, time)), 9) AS slope, round(b - 2 * v + a, 9) AS bend FROM n")
def ts4_derivative(spark, sf):
    return P.curvature(P.profiles(expression(spark, sf)))


@query(f"WITH {expression_sql()}, prof AS (SELECT gene, cond, time, avg(value) AS v FROM expr GROUP BY ALL), k AS (SELECT *, row_number() OVER (PARTITION BY gene, cond ORDER BY v DESC, time) AS k FROM prof) SELECT gene, cond, time AS peak, CASE WHEN time <= 2 THEN 'Early' WHEN time <= 4 THEN 'Middle' WHEN time <= 6 THEN 'Late' ELSE 'Unclassified' END AS stage FROM k WHERE k = 1")
def ts13_peak_stage(spark, sf):
    from ..functions.strings import stage

    return P.peak(P.profiles(expression(spark, sf))).withColumn("stage", stage(F.col("peak"), [("Early", 0, 2), ("Middle", 2, 4), ("Late", 4, 6)]))


@query("SELECT p_partkey AS pair, CASE WHEN p_size / 50 > 0.6 THEN 'Shape_Altered' WHEN p_size / 100 > 0.15 AND p_partkey % 7 < p_partkey % 5 THEN 'Amplitude_Repressed' WHEN p_size / 100 > 0.15 THEN 'Amplitude_Enhanced' WHEN p_size / 30 > 0.25 THEN 'Phase_Shifted' ELSE 'Conserved' END AS status FROM part")
def ts9_status(spark, sf):
    from ..sources.views import table

    d = table(spark, sf, "part").select(F.col("p_partkey").alias("pair"), (F.col("p_size") / 50).alias("shape"), (F.col("p_size") / 100).alias("amp"), (F.col("p_size") / 30).alias("phase"), (F.col("p_partkey") % 5).alias("range_wt"), (F.col("p_partkey") % 7).alias("range_mut"))
    return P.regulation_status(d, shape=0.6).select("pair", "status")


@query(f"WITH {expression_sql()}, prof AS (SELECT gene, cond, time, avg(value) AS v FROM expr GROUP BY ALL) SELECT w.gene, w.time, round(w.v - m.v, 9) AS divergence FROM prof w JOIN prof m ON w.gene = m.gene AND w.time = m.time AND w.cond = 'WT' AND m.cond = 'MUT'")
def st24_expression_divergence(spark, sf):
    p = P.profiles(expression(spark, sf))
    side = lambda c, n: p.filter(F.col("cond") == c).select("gene", "time", F.col("value").alias(n))
    return side("WT", "w").join(side("MUT", "m"), ["gene", "time"]).select("gene", "time", F.round(F.col("w") - F.col("m"), 9).alias("divergence"))
