"""Queries of anchors, reports, fates, features and model gates, each with the SQL that it is held against where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import strings as S
from ..functions.maths import fisher_two_sided_sql, hypergeometric_tail_sql
from ..operators import coexpression as X
from ..operators import learning as L
from ..operators import network as N
from ..operators import profiles as P
from ..operators import relational as R
from ..operators import sequences as Q
from ..operators import timewarp as T
from ..sources.views import MEMBERSHIPS_SQL, contrasts, contrasts_sql, expression, expression_sql, regulators, table
from ..storage import once
from . import models
from .networks import EDGES, NET, SCORED, _bh, _complete, _edges, _members, _net, _scored

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str = ""):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


E = expression_sql()
#: The contrasts after a list that already has the expression.
CONTRASTS = contrasts_sql()[len(E) :]


def _nodes(spark: SparkSession, *names: str) -> DataFrame:
    return spark.createDataFrame([(n,) for n in names], "node string")


# filters, joins and statistics -------------------------------------------------------------------------------------------


@query(f"WITH {E} SELECT gene, cond, time, rep FROM expr WHERE (gene, time) IN (SELECT (gene, time) FROM expr GROUP BY gene, time HAVING var_samp(value) > 0)")
def flt8_varying_inside(spark, sf):
    return R.varying_inside(expression(spark, sf), ["gene", "time"]).select("gene", "cond", "time", "rep")


@query(f"""WITH {EDGES}, {MEMBERSHIPS_SQL}, best_of AS (SELECT gene, cond, cluster, membership FROM (SELECT *, row_number() OVER (PARTITION BY gene, cond ORDER BY membership DESC, cluster) AS k FROM members) WHERE k = 1),
common AS (SELECT gene FROM best_of WHERE membership >= 0.5 GROUP BY gene HAVING count(*) = 2), changed AS (SELECT gene FROM best_of GROUP BY gene HAVING count(DISTINCT cluster) = 2)
SELECT 'all' AS mode, tf, target FROM edges UNION ALL SELECT 'mfuzz', tf, target FROM edges WHERE target IN (SELECT gene FROM common) UNION ALL SELECT 'non_conserved', tf, target FROM edges WHERE target IN (SELECT gene FROM changed)""")
def flt13_target_filters(spark, sf):
    members = _members(spark, sf)
    common = P.core(members).groupBy("gene").agg(F.count_distinct("cond").alias("n")).filter("n = 2")
    changed = P.best_cluster(members).groupBy("gene").agg(F.count_distinct("cluster").alias("n")).filter("n = 2")
    edges, out = _edges(spark, sf), None
    for mode in ("all", "mfuzz", "non_conserved"):
        own = R.target_filter(edges, mode, common, changed, "target").select(F.lit(mode).alias("mode"), "tf", "target")
        out = own if out is None else out.unionByName(own)
    return out


LEAST_R = (
    EDGES.replace("zed AS (", "zed_ AS (").replace("b1_u AS", "zed AS (SELECT * REPLACE (CASE WHEN strong THEN p_wt END AS p_wt, CASE WHEN strong THEN p_mut END AS p_mut, CASE WHEN strong THEN p_diff END AS p_diff) FROM (SELECT *, greatest(abs(r_wt), abs(r_mut)) >= 0.3 AS strong FROM zed_)),\nb1_u AS")
    .replace("JOIN b1 USING (p_wt) JOIN b2 USING (p_mut) JOIN b3 USING (p_diff)", "LEFT JOIN b1 USING (p_wt) LEFT JOIN b2 USING (p_mut) LEFT JOIN b3 USING (p_diff)")
)


@query(f"WITH {LEAST_R} SELECT tf, target, r_wt, r_mut, round(fdr_wt, 6) AS fdr_wt, round(fdr_mut, 6) AS fdr_mut, round(fdr_diff, 6) AS fdr_diff, edge_class FROM edges")
def flt15_strong_pairs(spark, sf):
    """Only pairs with |r| of 0.3 or more in a condition are tested; the others have an FDR of 1."""
    return X.shown(_edges(spark, sf, X.EdgeParams(least_r=0.3))).select("tf", "target", "r_wt", "r_mut", "fdr_wt", "fdr_mut", "fdr_diff", "edge_class")


@query(f"WITH {EDGES} SELECT tf, target, edge_class FROM edges WHERE edge_class <> 'NS'")
def flt12_classified(spark, sf):
    return X.output_mode(_edges(spark, sf), "classified").select("tf", "target", "edge_class")


TIMES = [(c, t) for c in ("WT", "MUT") for t in range(1, 4)]


@query(f"""WITH {E}, prof AS (SELECT gene, cond, time, round(avg(value), 6) AS v FROM expr GROUP BY ALL) SELECT gene, {', '.join(f"max(v) FILTER (cond = '{c}' AND time = {t}) AS {c}_{t}h" for c, t in TIMES)} FROM prof GROUP BY gene""")
def flt16_time_columns(spark, sf):
    """The columns of a condition at a time, picked by name from a table that also has a WT_Cluster."""
    v = P.profiles(expression(spark, sf)).withColumns({"name": F.format_string("%s_%dh", "cond", "time"), "value": F.round("value", 6)})
    wide = v.groupBy("gene").pivot("name", [f"{c}_{t}h" for c, t in TIMES]).agg(F.max("value")).withColumn("WT_Cluster", F.lit(1)).withColumn("other_1h", F.lit(1.0))
    return wide.select("gene", *R.time_columns(wide, ["WT", "MUT"]))


@query(f"""WITH {E}, sheet AS (SELECT DISTINCT cond || '_' || time || '_' || rep AS sample, cond, time FROM expr), scores AS (SELECT cond || '_' || time || '_' || rep AS sample, round(avg(value), 6) AS score FROM expr WHERE rep < 2 GROUP BY ALL)
SELECT sample, score, cond, time FROM scores JOIN sheet USING (sample)""")
def jn2_scores_with_sheet(spark, sf):
    e = expression(spark, sf).withColumn("sample", F.concat_ws("_", "cond", "time", "rep"))
    return e.filter("rep < 2").groupBy("sample").agg(F.round(F.avg("value"), 6).alias("score")).join(e.select("sample", "cond", "time").distinct(), "sample")


@query()
def st3_time_components(spark, sf):
    """Components of the samples over genes: all together, and of each time; joined with the sheet."""
    e = _complete(spark, sf).withColumn("sample", F.concat_ws("_", "cond", "time", "rep"))
    own = lambda g: e.select(g.alias("group"), "sample", "gene", "value")
    scores = L.sample_components(own(F.lit("all")).unionByName(own(F.concat(F.lit("t"), F.col("time").cast("string")))))
    return scores.join(e.select("sample", "cond", "time").distinct(), "sample")


@query("""WITH words AS (SELECT DISTINCT p_brand AS family, substr(p_name, 1, 4) AS kmer FROM part), known AS (SELECT kmer, mfgr, size FROM (SELECT substr(p_name, 1, 4) AS kmer, p_type AS mfgr, p_size AS size, row_number() OVER (PARTITION BY substr(p_name, 1, 4) ORDER BY p_type, p_size) AS k FROM part WHERE p_size > 45) WHERE k = 1)
SELECT family, kmer, mfgr, size FROM words LEFT JOIN known USING (kmer)""")
def jn5_annotated(spark, sf):
    p = table(spark, sf, "part").withColumn("kmer", F.substring("p_name", 1, 4))
    return Q.annotated(p.select(F.col("p_brand").alias("family"), "kmer").distinct(), p.filter("p_size > 45").select("kmer", F.col("p_type").alias("mfgr"), F.col("p_size").alias("size")), "kmer")


@query(f"""WITH {SCORED} SELECT a.cluster, count(DISTINCT b.cluster) AS n_sub, count(DISTINCT b.cluster) FILTER (b.cluster <> a.cluster) AS n_diverged, round(count(DISTINCT b.cluster) FILTER (b.cluster <> a.cluster) / count(DISTINCT b.cluster), 3) AS divergence
FROM best_of a JOIN best_of b ON a.gene = b.gene AND a.cond = 'WT' AND b.cond = 'MUT' GROUP BY a.cluster""")
def jn7_divergence_ratios(spark, sf):
    best = P.best_cluster(_members(spark, sf))
    side = lambda c, n: best.filter(F.col("cond") == c).select("gene", F.col("cluster").alias(n))
    fate = side("WT", "cluster").join(side("MUT", "sub_cluster"), "gene")
    return N.divergence_ratios(fate.withColumn("label", F.when(F.col("cluster") == F.col("sub_cluster"), "Conserved").otherwise("Diverged")))


@query(f"""WITH {E}, means AS (SELECT gene, cond, time, avg(value) AS m FROM expr GROUP BY ALL), base AS (SELECT gene, cond, coalesce(max(m) FILTER (time = 2), arg_min(m, time)) AS b FROM means GROUP BY ALL)
SELECT gene, round(max(abs(m - b)), 9) AS max_lfc, round(avg(m), 6) AS mean FROM means JOIN base USING (gene, cond) GROUP BY gene""")
def agg2_control_time(spark, sf):
    """Largest change against a control time, or the first time where a gene has no value then."""
    return R.max_fold(expression(spark, sf), control=2).select("gene", F.round("max_lfc", 9).alias("max_lfc"), F.round("mean", 6).alias("mean"))


@query("""WITH w AS (SELECT p_brand AS family, p_name AS kmer, max(p_size) / 10 AS weight FROM part GROUP BY ALL)
SELECT family, count(*) AS n, round(sum(weight), 6) AS total, round(avg(weight), 6) AS mean, max(weight) AS largest, string_agg(kmer, ';' ORDER BY weight DESC, kmer) AS members FROM w GROUP BY family""")
def agg10_family_statistics(spark, sf):
    w = table(spark, sf, "part").groupBy(F.col("p_brand").alias("family"), F.col("p_name").alias("kmer")).agg((F.max("p_size") / 10).alias("weight"))
    return R.group_statistics(w, ["family"], "weight", "kmer")


@query(f"""WITH {SCORED}{CONTRASTS}, lead_of AS (SELECT target AS gene, edge_class FROM (SELECT target, edge_class, row_number() OVER (PARTITION BY target ORDER BY count(*) DESC, edge_class) AS k FROM edges GROUP BY target, edge_class) WHERE k = 1),
change AS (SELECT w.gene, w.time, w.lfc AS wt, m.lfc AS mut FROM contrasts w JOIN contrasts m ON w.gene = m.gene AND w.time = m.time AND w.cond = 'WT' AND m.cond = 'MUT')
SELECT cluster, edge_class, time, count(*) AS n, round(avg(wt - mut), 4) AS mean_diff, round(stddev_samp(wt - mut), 4) AS sd_diff, round(avg(wt), 4) AS mean_wt, round(avg(mut), 4) AS mean_mut
FROM change JOIN lead_of USING (gene) JOIN own ON own.target = gene GROUP BY ALL""")
def agg11_divergence_summary(spark, sf):
    c = contrasts(spark, sf)
    side = lambda k, n: c.filter(F.col("cond") == k).select("gene", "time", F.col("lfc").alias(n))
    lead = R.dominant(_edges(spark, sf), "target", "edge_class").select(F.col("target").alias("gene"), "edge_class")
    own = P.best_cluster(_members(spark, sf).filter("cond = 'WT'")).select("gene", "cluster")
    return N.divergence_summary(side("WT", "wt").join(side("MUT", "mut"), ["gene", "time"]).join(lead, "gene").join(own, "gene"))


@query("SELECT n.n_name AS cond, CAST(s_suppkey AS VARCHAR) AS sample, row_number() OVER (PARTITION BY n.n_name ORDER BY s_name) AS rep_idx FROM supplier JOIN nation n ON s_nationkey = n_nationkey")
def win4_replicate_index(spark, sf):
    s = table(spark, sf, "supplier").join(F.broadcast(table(spark, sf, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))
    return R.replicate_index(s.select(F.col("n_name").alias("cond"), F.col("s_suppkey").cast("string").alias("sample"), "s_name"), ["cond"], "s_name").select("cond", "sample", F.col("rep_idx").cast("long").alias("rep_idx"))


GENOTYPES = "SELECT DISTINCT CASE WHEN l_returnflag = 'A' THEN 'WT' WHEN l_returnflag = 'R' THEN 'MUT' ELSE 'ALT' END AS cond, CAST(year(l_shipdate) - 1995 AS INT) AS time FROM lineitem"


@query(f"WITH g AS ({GENOTYPES}) SELECT a.cond AS target, b.cond AS reference, a.time, 'Genotype_' || a.cond || '_vs_' || b.cond || '_at_' || a.time AS contrast FROM g a JOIN g b ON a.time = b.time AND a.cond <> b.cond AND (b.cond = 'WT' OR (a.cond <> 'WT' AND b.cond < a.cond))")
def st2_genotype_contrasts(spark, sf):
    """Pairs of conditions at each time: WT is the reference where it is one of them, else the first in the alphabet."""
    cond = F.when(F.col("l_returnflag") == "A", "WT").when(F.col("l_returnflag") == "R", "MUT").otherwise("ALT")
    g = table(spark, sf, "lineitem").select(cond.alias("cond"), (F.year("l_shipdate") - 1995).alias("time")).distinct()
    return R.genotype_contrasts(g, "WT")


# fates -------------------------------------------------------------------------------------------------------------------

FATES = "fates AS (SELECT DISTINCT p_size % 5 AS wt_cluster, p_partkey % 4 AS sub_cluster, CASE p_partkey % 4 WHEN 0 THEN 'Conserved' WHEN 1 THEN 'Shape_Diverged' WHEN 2 THEN 'Phase_Shifted' ELSE 'Amplitude_Repressed' END AS label, CAST(p_partkey % 4 + p_size % 5 + 3 AS INT) AS size FROM part)"


def _fates(spark, sf):
    k = F.col("p_partkey") % 4
    label = F.when(k == 0, "Conserved").when(k == 1, "Shape_Diverged").when(k == 2, "Phase_Shifted").otherwise("Amplitude_Repressed")
    return table(spark, sf, "part").select((F.col("p_size") % 5).alias("wt_cluster"), k.alias("sub_cluster"), label.alias("label"), (k + F.col("p_size") % 5 + 3).cast("int").alias("size")).distinct()


@query(f"WITH {FATES} SELECT label, CAST(sum(size) AS BIGINT) AS genes, count(*) AS n_sub FROM fates GROUP BY label")
def agg18_fate_totals(spark, sf):
    return T.fate_totals(_fates(spark, sf))


COMPOSITION = "SELECT wt_cluster, " + ", ".join(f"CAST(coalesce(sum(size) FILTER ({c}), 0) AS BIGINT) AS {n}" for n, c in (("conserved", "label = 'Conserved'"), ("shape_diverged", "label LIKE '%Shape%'"), ("phase_shifted", "label LIKE '%Phase%'"), ("amp_altered", "label LIKE '%Repressed%'"))) + " FROM fates GROUP BY wt_cluster"


@query(f"WITH {FATES} {COMPOSITION}")
def agg18_fate_composition(spark, sf):
    return T.fate_composition(_fates(spark, sf))


@query(f"""WITH {FATES}, comp AS ({COMPOSITION}), clusters AS (SELECT p_size % 5 AS cluster, CASE WHEN p_size % 5 < 2 THEN '1_Early' ELSE '2_Late' END AS stage, round(avg(p_retailprice) / 1000, 6) AS peak FROM part GROUP BY ALL)
SELECT CAST(row_number() OVER (ORDER BY stage, peak, cluster) AS INT) AS place, clusters.*, comp.* EXCLUDE (wt_cluster) FROM clusters LEFT JOIN comp ON cluster = wt_cluster""")
def ts14_cascade(spark, sf):
    p = table(spark, sf, "part").groupBy((F.col("p_size") % 5).alias("cluster")).agg(F.round(F.avg("p_retailprice") / 1000, 6).alias("peak"))
    return T.cascade(p.withColumn("stage", F.when(F.col("cluster") < 2, "1_Early").otherwise("2_Late")), T.fate_composition(_fates(spark, sf)))


@query("SELECT p_partkey AS pair, CASE WHEN p_size / 250 > 0.15 THEN 'Shape_Diverged' WHEN p_partkey % 40 / 200 > 0.15 THEN 'Amp_Altered' WHEN p_partkey % 50 / 100 > 0.25 THEN 'Phase_Shifted' ELSE 'Conserved' END AS label FROM part")
def ts10_fate_labels(spark, sf):
    return table(spark, sf, "part").select(F.col("p_partkey").alias("pair"), T.fate_label(F.col("p_size") / 250, F.col("p_partkey") % 40 / 200, F.col("p_partkey") % 50 / 100).alias("label"))


@query()
def ts8_unmatched(spark, sf):
    """Clusters that the assignment leaves alone: with two MUT clusters there is always one WT cluster."""
    costs = models._costs(spark, sf).filter("mut < 3")
    return T.unmatched(costs, T.matched(costs))


# sequences ---------------------------------------------------------------------------------------------------------------

PARTS = f"{models.SEQ}, parts AS (SELECT gene, region, substr(seq, lo, 10) AS part FROM seqs, (VALUES ('core', 1), ('distal', 9)) r(region, lo) WHERE length(seq) >= lo + 9)"


def _parts(spark, sf):
    s = models._seqs(spark, sf)
    cut = lambda name, lo: s.filter(F.length("seq") >= lo + 9).select("gene", F.lit(name).alias("region"), F.substring("seq", lo, 10).alias("part"))
    return cut("core", 1).unionByName(cut("distal", 9))


@query(f"WITH {PARTS} SELECT gene, round(avg(length(regexp_replace(part, '[^GCgc]', '', 'g')) / length(part)), 6) AS gc FROM parts GROUP BY gene")
def agg19_mean_gc(spark, sf):
    return Q.mean_gc(_parts(spark, sf))


@query(f"""WITH {PARTS}, present AS (SELECT DISTINCT gene, region, substr(part, i, 3) AS kmer FROM (SELECT *, unnest(range(1, 9)) AS i FROM parts) WHERE regexp_matches(substr(part, i, 3), '^[ACGT]+$')),
listed AS (SELECT region, kmer FROM present GROUP BY ALL HAVING count(*) >= 20), common AS (SELECT gene FROM present GROUP BY gene HAVING count(DISTINCT region) = 2)
SELECT gene, region || '_' || kmer AS feature FROM present SEMI JOIN common USING (gene) SEMI JOIN listed USING (region, kmer)""")
def sq3_region_features(spark, sf):
    present = _parts(spark, sf).select("gene", "region", F.explode(S.kmers(F.col("part"), 3)).alias("kmer")).filter(F.col("kmer").rlike("^[ACGT]+$"))
    return Q.region_features(present, present.groupBy("region", "kmer").agg(F.count("*").alias("n")).filter("n >= 20"))


@query("""WITH w AS (SELECT DISTINCT upper(substr(translate(p_name, 'abcdefghijklmnopqrst', 'acgtacgtacgtacgtacgt'), 1, 6)) AS kmer FROM part), e AS (SELECT kmer, i - 1 AS place, substr(kmer, i, 1) AS l FROM (SELECT kmer, unnest(range(1, length(kmer) + 1)) AS i FROM w))
SELECT kmer, CAST(place AS INT) AS place, """ + ", ".join(f"CASE WHEN l = '{c}' THEN 1.0 WHEN l IN ('A', 'C', 'G', 'T') THEN 0.0 ELSE 0.25 END::DOUBLE AS {c}" for c in "ACGT") + " FROM e")
def sq4_kmer_matrices(spark, sf):
    w = table(spark, sf, "part").select(F.upper(F.substring(F.translate("p_name", "abcdefghijklmnopqrst", "acgtacgtacgtacgtacgt"), 1, 6)).alias("kmer")).distinct()
    return w.select("kmer", F.posexplode(S.kmer_ppm(F.col("kmer"))).alias("place", "c")).select("kmer", "place", *[F.col("c")[k].alias(c) for k, c in enumerate("ACGT")])


@query("SELECT s_suppkey AS gene, region, greatest(1, lo) AS start, least(len, hi) AS end, substr(repeat('ACGTTGCA', 375), greatest(1, lo), least(len, hi) - greatest(1, lo) + 1) AS part FROM (SELECT s_suppkey, 3000 AS len, region, CASE WHEN s_suppkey % 2 = 0 THEN 1000 + a ELSE 1400 - b END AS lo, CASE WHEN s_suppkey % 2 = 0 THEN 1000 + b ELSE 1400 - a END AS hi, b - a + 1 AS width FROM supplier, (VALUES ('core', -50, 100), ('proximal', -500, -51), ('distal', -3000, -501)) r(region, a, b)) WHERE least(len, hi) - greatest(1, lo) + 1 >= 0.5 * width")
def sq1_region_sequences(spark, sf):
    g = models.sq1_regions(spark, sf)
    return Q.with_subsequence(g, g.select("gene").distinct().withColumn("seq", F.repeat(F.lit("ACGTTGCA"), F.lit(375))))


def _motif_words(spark, sf):
    s = models._seqs(spark, sf).filter(F.length("seq") >= 8)
    return s.select((F.col("gene") % 5).cast("string").alias("name"), F.substring("seq", 1, 8).alias("kmer"), (F.col("gene") % 7 + 1).cast("double").alias("weight")).groupBy("name", "kmer").agg(F.max("weight").alias("weight"))


@query()
def sq5_consensus_motifs(spark, sf):
    return Q.consensus_motifs(_motif_words(spark, sf))


@query()
def sq8_aligned_motifs(spark, sf):
    m = once(spark, "motifs", sf, make=lambda: Q.consensus_motifs(_motif_words(spark, sf)))
    base = m.select(F.col("name").alias("motif"), F.col("ppm").alias("base"))
    return Q.aligned_to(m.select("name", F.col("ppm").alias("query"), ((F.col("name").cast("int") + 1) % 5).cast("string").alias("motif")).join(base, "motif"))


@query("""WITH m AS (SELECT CAST(p_size % 6 AS VARCHAR) AS query, p_brand AS motif, CASE WHEN count(*) % 7 = 0 THEN NULL ELSE round(avg(p_retailprice) / 10000, 6) END AS pcc FROM part GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY coalesce(pcc, -1) DESC, motif) AS k FROM m)
SELECT query, max(motif) FILTER (k = 1) AS top1, max(pcc) FILTER (k = 1) AS pcc1, max(motif) FILTER (k = 2) AS top2, max(pcc) FILTER (k = 2) AS pcc2 FROM k GROUP BY query""")
def top3_two_best(spark, sf):
    p = table(spark, sf, "part").groupBy((F.col("p_size") % 6).cast("string").alias("query"), F.col("p_brand").alias("motif")).agg(F.when(F.count("*") % 7 != 0, F.round(F.avg("p_retailprice") / 10000, 6)).alias("pcc"))
    return Q.best_two(p)


FAMILIES = ["Medium", "stan", "ARD", "Large Drum", "O", "promotion", "econ"]


@query("""WITH fam AS (SELECT * FROM (VALUES """ + ", ".join(f"({k}, '{f}')" for k, f in enumerate(FAMILIES)) + """) t(k, f)), names AS (SELECT DISTINCT p_type AS name FROM part),
s AS (SELECT name, k, f, CASE WHEN lower(name) = lower(f) THEN 1000 WHEN contains(lower(name), lower(f)) THEN length(f) WHEN contains(lower(f), lower(name)) THEN length(name) ELSE 0 END AS s FROM names, fam),
best AS (SELECT name, f FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY s DESC, k) AS r FROM s WHERE s > 0) WHERE r = 1)
SELECT name, CASE WHEN name = 'SMALL' THEN 'pouch' ELSE f END AS family FROM names LEFT JOIN best USING (name)""")
def map_families(spark, sf):
    """The family of each name by alias, equality or containment."""
    names = table(spark, sf, "part").select(F.col("p_type").alias("name")).distinct()
    return names.withColumn("family", S.family_of(F.col("name"), FAMILIES, {"SMALL": "pouch"}))


# networks ----------------------------------------------------------------------------------------------------------------

ANCHORS = "highlights AS (SELECT * FROM (VALUES ('Brand#22', 'primary'), ('Brand#34', 'secondary'), ('Brand#11', 'secondary'), ('Brand#45', 'secondary')) t(gene, source)), focus AS (SELECT tf AS node FROM tfs WHERE family = '1'), first_ AS (SELECT node FROM focus UNION SELECT 'Brand#25' UNION SELECT gene FROM highlights WHERE source = 'primary'), anchors AS (SELECT node, 'primary' AS grade FROM first_ UNION ALL SELECT DISTINCT gene, 'secondary' FROM highlights WHERE source <> 'primary' AND gene NOT IN (SELECT node FROM first_))"


def _anchors(spark, sf):
    focus = regulators(spark, sf).filter("family = '1'").select(F.col("tf").alias("node"))
    highlights = spark.createDataFrame([("Brand#22", "primary"), ("Brand#34", "secondary"), ("Brand#11", "secondary"), ("Brand#45", "secondary")], "gene string, source string")
    return N.graded_anchors(focus, _nodes(spark, "Brand#25"), highlights)


@query(f"WITH {EDGES}, {ANCHORS} SELECT node, grade FROM anchors")
def gr1_graded_anchors(spark, sf):
    return _anchors(spark, sf)


NETS = f"{SCORED}, net AS (SELECT tf, target, z_diff, r_wt, r_mut, mecs, tier, CASE WHEN r_wt > 0.3 THEN 'Lost' WHEN r_wt < -0.3 THEN 'Gained' ELSE 'Conserved' END AS edge_class FROM scored WHERE abs(r_wt) > 0.25)"
CAPPED = "levels AS (SELECT *, CASE WHEN tf IN (SELECT node FROM anchors WHERE grade = 'primary') OR target IN (SELECT node FROM anchors WHERE grade = 'primary') THEN 1 WHEN tf IN (SELECT node FROM anchors) OR target IN (SELECT node FROM anchors) THEN 2 ELSE 3 END AS level FROM net), capped AS (SELECT * FROM levels ORDER BY level, abs(mecs) DESC, tf, target LIMIT 50)"


def _nets(spark, sf):
    kind = F.when(F.col("r_wt") > 0.3, "Lost").when(F.col("r_wt") < -0.3, "Gained").otherwise("Conserved")
    return _scored(spark, sf).filter(F.abs("r_wt") > 0.25).select("tf", "target", "z_diff", "r_wt", "r_mut", "mecs", "tier", kind.alias("edge_class"))


@query(f"WITH {NETS}, {ANCHORS}, {CAPPED} SELECT tf, target, mecs, level FROM capped")
def gr8_tier_capped(spark, sf):
    return N.tier_capped(_nets(spark, sf), 50, _anchors(spark, sf)).select("tf", "target", "mecs", "level")


@query(f"""WITH RECURSIVE {NETS}, {ANCHORS}, {CAPPED}, ends AS (SELECT tf AS node FROM capped WHERE edge_class <> 'Conserved' UNION ALL SELECT target FROM capped WHERE edge_class <> 'Conserved'),
stay AS (SELECT node FROM ends GROUP BY node HAVING count(*) > 1 UNION SELECT tf FROM capped UNION SELECT 'Brand#22'), cut AS (SELECT * FROM capped WHERE target IN (SELECT node FROM stay)), both_ AS (SELECT tf AS a, target AS b FROM cut UNION SELECT target, tf FROM cut),
reach AS (SELECT 'Brand#22' AS node UNION SELECT b FROM both_ JOIN reach ON a = node)
SELECT tf, target, edge_class, level FROM cut WHERE tf IN (SELECT node FROM reach) AND target IN (SELECT node FROM reach)""")
def gr8_display_network(spark, sf):
    """Capped by tiers, pruned again, cut to what connects to the focus gene."""
    return N.display_network(_nets(spark, sf), 50, _anchors(spark, sf), "Brand#22", _nodes(spark, "Brand#22")).select("tf", "target", "edge_class", "level")


@query(f"WITH RECURSIVE {NET}, both_ AS (SELECT tf AS a, target AS b FROM net UNION SELECT target, tf FROM net), reach AS (SELECT 'Brand#11' AS node UNION SELECT b FROM both_ JOIN reach ON a = node) SELECT node FROM reach")
def gr7_component(spark, sf):
    """No limit of hops: the component of a seed."""
    return N.connected(_net(spark, sf), "Brand#11")


@query(f"""WITH {NET}, ends AS (SELECT tf AS node FROM net WHERE edge_class <> 'Conserved' UNION ALL SELECT target FROM net WHERE edge_class <> 'Conserved'), many AS (SELECT node FROM ends GROUP BY node HAVING count(*) > 1),
near_ AS (SELECT tf AS node FROM net WHERE target = 'Brand#22' UNION SELECT target FROM net WHERE tf = 'Brand#22' UNION SELECT 'Brand#22')
SELECT tf, target, edge_class FROM net WHERE target IN (SELECT node FROM many UNION SELECT tf FROM net UNION SELECT node FROM near_)""")
def gr6_pruned_with_focus(spark, sf):
    return N.pruned(_net(spark, sf), _nodes(spark, "Brand#22"), focus=_nodes(spark, "Brand#22")).select("tf", "target", "edge_class")


LABELS = "one AS (SELECT tf AS gene, CASE WHEN family IN ('1', '2') THEN 'TF' || family ELSE '' END AS symbol FROM tfs), two AS (SELECT p_brand AS gene, min(p_type) AS symbol FROM part WHERE p_size > 20 GROUP BY ALL)"
NODES = f"""ends AS (SELECT tf AS node FROM net UNION ALL SELECT target FROM net), nodes AS (SELECT node, CASE WHEN node = 'Brand#11' THEN 'Focus TF' WHEN family IS NOT NULL THEN 'Other TF' WHEN node = 'Brand#22' THEN 'Highlight' ELSE 'Target' END AS kind, family, count(*) AS degree FROM ends LEFT JOIN tfs ON node = tfs.tf GROUP BY ALL), {LABELS},
labelled AS (SELECT n.*, coalesce(nullif(one.symbol, ''), nullif(two.symbol, ''), node) AS label FROM nodes n LEFT JOIN one ON n.node = one.gene LEFT JOIN two ON n.node = two.gene)"""


def _labelled(spark, sf):
    nodes = N.node_table(_net(spark, sf), regulators(spark, sf), ["Brand#11"], spark.createDataFrame([("Brand#22",)], "gene string"))
    one = regulators(spark, sf).select(F.col("tf").alias("gene"), F.when(F.col("family").isin("1", "2"), F.concat(F.lit("TF"), "family")).otherwise("").alias("symbol"))
    two = table(spark, sf, "part").filter("p_size > 20").groupBy(F.col("p_brand").alias("gene")).agg(F.min("p_type").alias("symbol"))
    return N.with_symbols(nodes, one, two)


@query(f"WITH {NET}, {NODES} SELECT node, kind, label FROM labelled")
def gr9_symbols(spark, sf):
    return _labelled(spark, sf).select("node", "kind", "label")


@query(f"WITH {NET}, {NODES} SELECT node AS Node_ID, label AS Display_Label, kind AS NodeType, coalesce(family, 'NA') AS Family, degree AS Degree FROM labelled")
def snk5_cytoscape_nodes(spark, sf):
    return N.cytoscape_nodes(_labelled(spark, sf))


@query(f"WITH {NETS} SELECT tf AS Source, target AS Target, edge_class AS Edge_Class, round(r_wt - r_mut, 6) AS Delta_r, mecs AS MECS_Score, tier AS Tier FROM net")
def snk5_cytoscape_edges(spark, sf):
    return N.cytoscape_edges(_nets(spark, sf))


PERCENT = "TRY_CAST(round_even(100 * {} / {}, 0) AS INT)"


@query(f"""WITH {NET}, t AS (SELECT DISTINCT tf, target FROM net), ref AS (SELECT target FROM t WHERE tf = 'Brand#11'), n AS (SELECT count(*) AS n FROM ref), c AS (SELECT tf, count(ref.target) AS c FROM t LEFT JOIN ref USING (target) GROUP BY tf)
SELECT node, CASE WHEN node = 'Brand#11' THEN '---' WHEN c IS NULL THEN '--- (pure target)' ELSE c || '/' || n || '(' || {PERCENT.format('c', 'n')} || '%)' END AS overlap FROM (SELECT tf AS node FROM net UNION SELECT target FROM net) LEFT JOIN c ON node = tf, n""")
def agg13_reference_overlap(spark, sf):
    return N.reference_overlap(_net(spark, sf), "Brand#11")


NAMED = ["Brand#11", "Brand#13", "Brand#21"]
LABELLED = f"""sets AS (SELECT DISTINCT tf AS s, target FROM net WHERE tf IN ({', '.join(f"'{n}'" for n in NAMED)})), sizes AS (SELECT s, count(*) AS n FROM sets GROUP BY s),
pairs_of AS (SELECT a.s AS a, b.s AS b, count(*) AS common FROM sets a JOIN sets b USING (target) GROUP BY ALL), labels AS (SELECT a, b, CASE WHEN a = b THEN '' || n ELSE common || '/' || n || '(' || {PERCENT.format('common', 'n')} || '%)' END AS label FROM pairs_of JOIN sizes ON b = s)"""


@query(f"""WITH {NET}, {LABELLED} SELECT a, {', '.join(f'''max(label) FILTER (b = '{n}') AS "{n}"''' for n in NAMED)} FROM labels GROUP BY a""")
def set6_overlap_matrix(spark, sf):
    return R.overlap_matrix(_net(spark, sf).select(F.col("tf").alias("set"), F.col("target").alias("item")), NAMED)


POOLS = """big AS (SELECT tf FROM net GROUP BY tf HAVING count(*) >= 3), c AS (SELECT tf, edge_class, count(*) AS n FROM net JOIN big USING (tf) GROUP BY ALL), lead AS (SELECT tf, edge_class AS space FROM (SELECT *, row_number() OVER (PARTITION BY tf ORDER BY n DESC, edge_class) AS k FROM c) WHERE k = 1 AND edge_class IN ('Conserved', 'Lost', 'Gained')),
ends AS (SELECT tf AS node, edge_class FROM net UNION ALL SELECT target, edge_class FROM net), of_node AS (SELECT node, count(*) AS degree, count(*) FILTER (edge_class = 'Lost') AS n_lost FROM ends GROUP BY node),
pools AS (SELECT n.target, bool_or(space = 'Conserved') AS public, bool_or(space = 'Lost') AS private, bool_or(space = 'Gained') AS gained FROM net n JOIN lead USING (tf) GROUP BY n.target)"""


@query(f"WITH {NET}, {POOLS} SELECT target, public, private, gained, degree, n_lost FROM pools JOIN of_node ON target = node")
def set7_pools(spark, sf):
    return N.subspace_pools(_net(spark, sf))


@query(f"WITH {NET}, {POOLS} SELECT count(*) FILTER (public) AS n_public, count(*) FILTER (private) AS n_private, count(*) FILTER (gained) AS n_gained, count(*) FILTER (public AND private) AS n_junction, count(*) FILTER (public AND gained) AS n_public_gained, count(*) FILTER (private AND gained) AS n_private_gained FROM pools")
def set7_pool_overlaps(spark, sf):
    return N.pool_overlaps(N.subspace_pools(_net(spark, sf)))


@query(f"""WITH {NET}, {POOLS}, {LABELLED},
s AS (SELECT tf AS node, 1 AS o, edge_class FROM net UNION ALL SELECT target, 0, edge_class FROM net),
top_ AS (SELECT node, CAST(sum(o) AS BIGINT) AS n_out, CAST(sum(1 - o) AS BIGINT) AS n_in, count(*) AS degree, count(*) FILTER (edge_class = 'Conserved') AS n_conserved, count(*) FILTER (edge_class = 'Lost') AS n_lost, count(*) FILTER (edge_class = 'Gained') AS n_gained, count(*) FILTER (edge_class = 'Rewired') AS n_rewired FROM s GROUP BY node)
SELECT 'topology' AS section, node AS key, 'n_out=' || n_out || ' n_in=' || n_in || ' degree=' || degree || ' n_conserved=' || n_conserved || ' n_lost=' || n_lost || ' n_gained=' || n_gained || ' n_rewired=' || n_rewired AS text FROM top_
UNION ALL SELECT 'subspace', target, 'spaces=' || array_to_string(list_sort(list_distinct(list(space))), '&') || ' n_tf=' || count(DISTINCT tf) FROM net JOIN lead USING (tf) GROUP BY target
UNION ALL SELECT 'profile', tf, 'side=Out partner=' || target || ' edge_class=' || edge_class FROM net WHERE tf IN ('Brand#11', 'Brand#13', 'Brand#21') UNION ALL SELECT 'profile', target, 'side=In partner=' || tf || ' edge_class=' || edge_class FROM net WHERE target IN ('Brand#11', 'Brand#13', 'Brand#21')
UNION ALL SELECT 'overlap', a, 'b=' || b || ' label=' || label FROM labels
UNION ALL SELECT 'shared', x.target, 'class_a=' || x.edge_class || ' class_b=' || y.edge_class FROM net x JOIN net y ON x.target = y.target AND x.tf = 'Brand#11' AND y.tf = 'Brand#13'""")
def gr10_full_report(spark, sf):
    return N.full_report(_net(spark, sf), NAMED)


@query(f"WITH {E}, {MEMBERSHIPS_SQL} SELECT gene, cluster, membership FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY membership DESC, gene) AS k FROM members WHERE cond = 'WT' AND membership >= 0.3 AND cluster IN (1, 3)) WHERE k <= 6")
def gr11_named_clusters(spark, sf):
    """Clusters by name, exactly or by what stands after the condition; their strongest members."""
    columns = {f"WT_{k}": k for k in (1, 2, 3)}
    picked = [columns[c] for c in N.resolved_clusters(["WT_1", "MUT_3", "C9"], list(columns)).values()]
    m = _members(spark, sf).filter(F.col("cluster").isin(picked) & (F.col("cond") == "WT") & (F.col("membership") >= 0.3))
    return R.top(m, ["cluster"], [F.desc("membership"), F.col("gene")], 6).select("gene", "cluster", "membership")


WT_CONTRASTS = [f"Time_WT_{t}_vs_0" for t in (1, 2, 3)]


@query(f"""WITH {contrasts_sql()}, m AS (SELECT contrast, gene, CASE WHEN p < 0.001 THEN '***' WHEN p < 0.01 THEN '**' WHEN p < 0.05 THEN '*' ELSE '' END AS star, lfc FROM contrasts) SELECT gene, {', '.join(f"max(lfc) FILTER (contrast = '{c}') AS {c}_lfc, max(star) FILTER (contrast = '{c}') AS {c}_star" for c in WT_CONTRASTS)} FROM m GROUP BY gene""")
def gr12_matrices(spark, sf):
    m = N.marked_changes(contrasts(spark, sf).withColumn("padj", F.col("p")))
    return m.groupBy("gene").pivot("contrast", WT_CONTRASTS).agg(F.max("lfc").alias("lfc"), F.max("star").alias("star"))


@query(f"""WITH {contrasts_sql()} SELECT contrast, gene, CASE WHEN gene IN ('Brand#11', 'Brand#22') THEN gene ELSE '' END AS label, greatest(-2.0, least(2.0, lfc)) AS x, round(least(3.0, -log10(greatest(p, 1e-300))), 6) AS y FROM contrasts""")
def gr13_volcano_points(spark, sf):
    return N.volcano_points(contrasts(spark, sf), ["Brand#11", "Brand#22"], 2.0, 3.0)


# the same questions of the classes that edges() itself gives ---------------------------------------------------------------

REAL = f"{SCORED}, kinds AS (SELECT tf, family, cluster, target, edge_class FROM scored WHERE cluster IS NOT NULL)"


def _real(spark, sf):
    return _scored(spark, sf).filter("cluster IS NOT NULL").select("tf", "family", "cluster", "target", "edge_class")


@query(f"""WITH {REAL}, t AS (SELECT tf, cluster, edge_class, count(*) AS q FROM kinds GROUP BY ALL),
g AS (SELECT *, CAST(sum(q) OVER (PARTITION BY tf, edge_class) AS BIGINT) AS m, CAST(sum(q) OVER (PARTITION BY cluster, edge_class) AS BIGINT) AS k, CAST(sum(q) OVER (PARTITION BY edge_class) AS BIGINT) AS every FROM t),
h AS (SELECT *, {hypergeometric_tail_sql('q', 'm', '(every - m)', 'k')} AS p FROM g), {_bh('bh', 'h', 'p', 'fdr')}
SELECT tf, cluster, edge_class, q, m, k, round(p, 9) AS p, round(fdr, 6) AS fdr FROM h JOIN bh USING (p)""")
def st12_enrichment_of_classes(spark, sf):
    return X.shown(N.class_enrichment(_real(spark, sf), "tf")).select("tf", "cluster", "edge_class", "q", "m", "k", "p", "fdr")


@query(f"""WITH {REAL}, t AS (SELECT family, cluster, edge_class, count(*) AS a FROM kinds GROUP BY ALL),
g AS (SELECT *, CAST(sum(a) OVER (PARTITION BY family, edge_class) AS BIGINT) - a AS b, CAST(sum(a) OVER (PARTITION BY cluster, edge_class) AS BIGINT) - a AS c, CAST(sum(a) OVER (PARTITION BY edge_class) AS BIGINT) AS every FROM t),
f AS (SELECT *, every - a - b - c AS d FROM g WHERE a >= 2), h AS (SELECT *, {fisher_two_sided_sql('a', 'b', 'c', 'd')} AS p FROM f) SELECT family, cluster, edge_class, a, b, c, d, round(p, 9) AS p FROM h""")
def st13_fisher_of_classes(spark, sf):
    return X.shown(N.class_fisher(_real(spark, sf), "family", least=2)).select("family", "cluster", "edge_class", "a", "b", "c", "d", "p")


@query(f"WITH {EDGES}, s AS (SELECT tf AS node, 1 AS o, edge_class FROM edges UNION ALL SELECT target, 0, edge_class FROM edges) SELECT node, CAST(sum(o) AS BIGINT) AS n_out, CAST(sum(1 - o) AS BIGINT) AS n_in, count(*) AS degree, count(*) FILTER (edge_class = 'Conserved') AS n_conserved, count(*) FILTER (edge_class = 'Lost') AS n_lost, count(*) FILTER (edge_class = 'Gained') AS n_gained, count(*) FILTER (edge_class = 'Rewired') AS n_rewired FROM s GROUP BY node")
def agg13_topology_of_classes(spark, sf):
    return N.topology(_edges(spark, sf))


@query(f"""WITH {EDGES}, near_ AS (SELECT 'Brand#11' AS node UNION SELECT target FROM edges WHERE tf = 'Brand#11' AND edge_class IN ('Lost', 'Gained', 'Rewired', 'Conserved') UNION SELECT tf FROM edges WHERE target = 'Brand#11' AND edge_class IN ('Lost', 'Gained', 'Rewired', 'Conserved'))
SELECT tf, target, edge_class FROM edges WHERE edge_class IN ('Lost', 'Gained', 'Rewired', 'Conserved') AND (tf IN (SELECT node FROM near_) OR target IN (SELECT node FROM near_))""")
def gr3_anchor_edges_of_classes(spark, sf):
    return N.anchored(_edges(spark, sf), _nodes(spark, "Brand#11"), 1).select("tf", "target", "edge_class")


# learning ----------------------------------------------------------------------------------------------------------------


@query("""SELECT label % 3 AS "group", count(*) FILTER (label < 5) AS n_positive, max(len(embedding)) AS n_features, count(*) FILTER (label < 5) >= 30 AND max(len(embedding)) >= 10 AS ready FROM embeddings GROUP BY ALL""")
def ml5_fit_gates(spark, sf):
    e = table(spark, sf, "embeddings").select((F.col("label") % 3).alias("group"), (F.col("label") < 5).alias("positive"), F.col("embedding").alias("features"))
    return L.fit_gates(e, ["group"])


@query("""WITH s AS (SELECT source, lang, n_chars AS score, quality = 1 AS positive FROM documents JOIN labels USING (doc_id)), n AS (SELECT source, lang, score, count(*) FILTER (positive) AS p, count(*) FILTER (NOT positive) AS q FROM s GROUP BY ALL),
w AS (SELECT source, lang, p, q, p * (sum(q) OVER (PARTITION BY source, lang ORDER BY score) - q + q / 2) AS won FROM n), a AS (SELECT source, lang, round(sum(won) / nullif(sum(p) * sum(q), 0), 6) AS auc FROM w GROUP BY ALL)
SELECT lang, round(avg(auc), 6) AS mean, round(stddev_samp(auc), 6) AS sd, count(*) AS n FROM a WHERE auc IS NOT NULL GROUP BY lang HAVING count(*) >= 2""")
def ml5_summarised_auc(spark, sf):
    s = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select("source", "lang", F.col("n_chars").alias("score"), (F.col("quality") == 1).alias("positive"))
    return L.summarised_auc(L.auc(s, ["source", "lang"]), ["lang"], 2)


@query("""WITH p AS (SELECT vec_id AS id, (row_number() OVER (ORDER BY md5('7|' || vec_id)) - 1) % 5 = 2 AS test FROM embeddings WHERE label < 5), n AS (SELECT count(*) FILTER (NOT test) AS a, count(*) FILTER (test) AS b FROM p),
q AS (SELECT vec_id AS id, row_number() OVER (ORDER BY md5('n7.2|' || vec_id)) AS k FROM embeddings WHERE NOT label < 5)
SELECT id, true AS positive, test FROM p UNION ALL SELECT id, false, k > a FROM q, n WHERE k <= a + b""")
def ml2_balanced_split(spark, sf):
    return L.balanced_split(table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), (F.col("label") < 5).alias("positive")), 2)


@query()
def ml6_refitted_null(spark, sf):
    """Forests fitted again to permuted labels."""
    return L.permuted_auc(models._vectors(spark, sf), rounds=2, k=2, trees=10)
