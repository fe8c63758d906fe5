"""Queries of sequence, profile comparison and learning operators, with SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import strings as S
from ..operators import learning as L
from ..operators import network as N
from ..operators import profiles as P
from ..operators import relational as R
from ..operators import sequences as Q
from ..operators import timewarp as T
from ..sources.views import contrasts, contrasts_sql, expression, memberships, table
from ..functions.maths import hypergeometric_tail_sql

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str = ""):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# sequences: the letters of part names stand for bases ------------------------------------------------------------------

SEQ = "seqs AS (SELECT p_partkey AS gene, upper(translate(lower(p_name) || p_type || p_brand, 'abcdefghijklmnopqrstuvwxyz #0123456789', 'acgtacgtacgtacgtacgtacgtac')) AS seq, p_size > 25 AS positive FROM part)"


def _seqs(spark, sf):
    text = F.concat(F.lower("p_name"), "p_type", "p_brand")
    return table(spark, sf, "part").select(F.col("p_partkey").alias("gene"), F.upper(F.translate(text, "abcdefghijklmnopqrstuvwxyz #0123456789", "acgtacgtacgtacgtacgtacgtac")).alias("seq"), (F.col("p_size") > 25).alias("positive"))


@query("SELECT s_suppkey AS gene, region, greatest(1, lo) AS start, least(len, hi) AS end FROM (SELECT s_suppkey, 3000 AS len, region, CASE WHEN s_suppkey % 2 = 0 THEN 1000 + a ELSE 1400 - b END AS lo, CASE WHEN s_suppkey % 2 = 0 THEN 1000 + b ELSE 1400 - a END AS hi, b - a + 1 AS width FROM supplier, (VALUES ('core', -50, 100), ('proximal', -500, -51), ('distal', -3000, -501)) r(region, a, b)) WHERE least(len, hi) - greatest(1, lo) + 1 >= 0.5 * width")
def sq1_regions(spark, sf):
    genes = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("gene"), F.lit(3000).alias("length"), F.lit(1000).alias("start"), F.lit(1400).alias("end"), F.when(F.col("s_suppkey") % 2 == 0, "+").otherwise("-").alias("strand"))
    return Q.regions(genes, {"core": (-50, 100), "proximal": (-500, -51), "distal": (-3000, -501)})


KMERS = f"{SEQ}, present AS (SELECT DISTINCT gene, substr(seq, i, 4) AS kmer, positive FROM (SELECT *, unnest(range(1, length(seq) - 2)) AS i FROM seqs WHERE length(seq) >= 4) WHERE regexp_matches(substr(seq, i, 4), '^[ACGT]+$'))"


@query(f"WITH {KMERS} SELECT gene, kmer FROM present")
def sq2_presence(spark, sf):
    return Q.presence(_seqs(spark, sf), 4)


@query(f"""WITH {KMERS}, t AS (SELECT count(*) FILTER (positive) AS np, count(*) FILTER (NOT positive) AS nn FROM seqs),
n AS (SELECT kmer, count(*) FILTER (positive) AS pos, count(*) FILTER (NOT positive) AS neg FROM present GROUP BY kmer HAVING count(*) >= 5),
r AS (SELECT n.*, np, nn, round(pos / np, 4) AS pos_ratio, round(neg / nn, 4) AS neg_ratio, round({hypergeometric_tail_sql('pos', 'np', 'nn', '(pos + neg)')}, 9) AS p FROM n, t)
SELECT kmer, pos, neg, pos_ratio, neg_ratio, round(CASE WHEN neg_ratio > 0 THEN least(100.0, pos_ratio / neg_ratio) WHEN pos_ratio > 0 THEN 10.0 ELSE 1.0 END, 6) AS fold, round(p, 6) AS p FROM r""")
def st14_kmer_enrichment(spark, sf):
    s = _seqs(spark, sf)
    return Q.enrichment(Q.presence(s, 4), s.select("gene", "positive"), ranked=False).withColumn("p", F.round("p", 6))


@query(f"WITH {SEQ} SELECT gene, round(length(regexp_replace(seq, '[^GCgc]', '', 'g')) / length(seq), 6) AS gc, reverse(translate(seq, 'ACGT', 'TGCA')) AS rc FROM seqs")
def sq_gc_and_complement(spark, sf):
    return Q.with_gc(_seqs(spark, sf)).select("gene", F.round("gc", 6).alias("gc"), S.reverse_complement(F.col("seq")).alias("rc"))


@query(f"""WITH {SEQ}, g AS (SELECT gene, positive, length(regexp_replace(seq, '[^GC]', '', 'g')) / length(seq) AS gc FROM seqs), c AS (SELECT quantile_cont(gc, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS cuts FROM g),
b AS (SELECT g.*, len(list_filter(cuts, lambda c: gc > c)) AS bin FROM g, c), need AS (SELECT bin, count(*) * 3 AS need FROM b WHERE positive GROUP BY bin),
o AS (SELECT gene, bin, row_number() OVER (PARTITION BY bin ORDER BY md5('42|' || gene)) AS k FROM b WHERE NOT positive)
SELECT gene, CAST(bin AS INT) AS bin FROM o JOIN need USING (bin) WHERE k <= need""")
def st16_matched_negatives(spark, sf):
    s = Q.with_gc(_seqs(spark, sf)).select("gene", (F.col("positive")).alias("positive"), "gc")
    return Q.matched_negatives(s)


WORDS = "words AS (SELECT DISTINCT p_brand AS grp, substr(upper(translate(lower(p_name), 'abcdefghijklmnopqrstuvwxyz ', 'acgtacgtacgtacgtacgtacgtac')), 1, 6) AS kmer FROM part)"


def _words(spark, sf):
    w = table(spark, sf, "part")
    return w.select(F.col("p_brand").alias("group"), F.substring(F.upper(F.translate(F.lower("p_name"), "abcdefghijklmnopqrstuvwxyz ", "acgtacgtacgtacgtacgtacgtac")), 1, 6).alias("kmer")).distinct()


@query("WITH " + WORDS + ' SELECT a.grp AS "group", a.kmer AS a, b.kmer AS b, CAST(levenshtein(a.kmer, b.kmer) AS INT) AS distance FROM words a JOIN words b ON a.grp = b.grp AND a.kmer < b.kmer WHERE levenshtein(a.kmer, b.kmer) <= 2')
def cl9_near_kmers(spark, sf):
    w = table(spark, sf, "part")
    return Q.near_kmers(w.select(F.col("p_brand").alias("group"), F.substring(F.upper(F.translate(F.lower("p_name"), "abcdefghijklmnopqrstuvwxyz ", "acgtacgtacgtacgtacgtacgtac")), 1, 6).alias("kmer")))


@query()
def cl9_families(spark, sf):
    return Q.families(_words(spark, sf))


@query(f"""WITH {SEQ}, e AS (SELECT CAST(gene % 5 AS VARCHAR) AS "group", CAST(i - 1 AS INT) AS place, substr(seq, i, 1) AS l, CAST(gene % 7 + 1 AS DOUBLE) AS w FROM (SELECT *, unnest(range(1, 7)) AS i FROM seqs WHERE length(seq) >= 6))
SELECT "group", place, round(coalesce(sum(w) FILTER (l = 'A'), 0) / sum(w), 6) AS A, round(coalesce(sum(w) FILTER (l = 'C'), 0) / sum(w), 6) AS C, round(coalesce(sum(w) FILTER (l = 'G'), 0) / sum(w), 6) AS G, round(coalesce(sum(w) FILTER (l = 'T'), 0) / sum(w), 6) AS T FROM e GROUP BY ALL""")
def sq5_position_weights(spark, sf):
    s = _seqs(spark, sf).filter(F.length("seq") >= 6)
    w = Q.position_weights(s.select((F.col("gene") % 5).cast("string").alias("group"), F.substring("seq", 1, 6).alias("kmer"), (F.col("gene") % 7 + 1).cast("double").alias("weight")))
    return w.select("group", "place", *[F.round(c, 6).alias(c) for c in "ACGT"])


@query()
def sq7_best_motifs(spark, sf):
    w = sq5_position_weights(spark, sf).groupBy(F.col("group").alias("name")).agg(F.transform(F.sort_array(F.collect_list(F.struct("place", F.array(*"ACGT").alias("c")))), lambda x: x["c"]).alias("ppm"))
    return Q.best_motifs(w, w.withColumn("name", F.concat(F.lit("db_"), "name")))


# profiles --------------------------------------------------------------------------------------------------------------


def _centres(spark, sf):
    z = P.standardised(P.profiles(expression(spark, sf)))
    c = P.centre_step(z, memberships(spark, sf))
    return c.groupBy("cond", "cluster").agg(F.sort_array(F.collect_list(F.struct("time", "centre"))).alias("s")).select("cond", "cluster", F.transform("s", lambda x: x["time"].cast("double")).alias("times"), F.transform("s", lambda x: x["centre"]).alias("c"))


def _costs(spark, sf):
    c = _centres(spark, sf)
    wt = c.filter("cond = 'WT'").select(F.col("cluster").alias("wt"), "times", F.col("c").alias("a"))
    mut = c.filter("cond = 'MUT'").select(F.col("cluster").alias("mut"), F.col("c").alias("b"))
    return T.centre_costs(wt.crossJoin(F.broadcast(mut)))


@query()
def ts7_centre_costs(spark, sf):
    """TS5 to TS7: every pair of centres with all metrics and the first dimension that differs."""
    c = _costs(spark, sf).withColumn("priority", T.priority(F.col("shape"), F.col("amp"), F.col("phase")))
    return c.select(*[F.round(n, 6).alias(n) if t == "double" else n for n, t in c.dtypes])


@query()
def ts8_matched_clusters(spark, sf):
    """TS8, TS9: clusters paired at least cost, with the status of each pair."""
    return P.regulation_status(T.matched(_costs(spark, sf))).select("wt", "mut", F.round("cost", 6).alias("cost"), "status")


@query()
def ts11_fates(spark, sf):
    p = P.standardised(P.profiles(expression(spark, sf))).filter("cond = 'MUT'").groupBy("gene").agg(F.sort_array(F.collect_list(F.struct("time", "z"))).alias("s")).select("gene", F.transform("s", lambda x: x["z"]).alias("z"))
    core = P.best_cluster(memberships(spark, sf).filter("cond = 'WT'")).select("gene", F.col("cluster").alias("wt_cluster"))
    f = T.fates(core, p, _centres(spark, sf).filter("cond = 'WT'").select(F.col("cluster").alias("wt_cluster"), "times", F.col("c").alias("centre")))
    return f.withColumns({c: F.round(c, 6) for c in ("membership", "shape", "amp", "phase")})


@query()
def ts12_smooth_peaks(spark, sf):
    return T.smooth_peaks(P.profiles(expression(spark, sf))).withColumn("peak", F.round("peak", 6))


@query()
def cl1_fuzzy_cmeans(spark, sf):
    z = P.standardised(P.profiles(expression(spark, sf)))
    names = z.select("gene").distinct().orderBy("gene").limit(3).withColumn("cluster", F.row_number().over(W.orderBy("gene")))
    return P.fuzzy_cmeans(z, z.join(names, "gene").select("cond", "cluster", "time", F.col("z").alias("centre")), rounds=4)[0]


@query("SELECT n AS genes, d AS times, round(greatest(1.25, least(2.0, 1 + (1418 / n + 22.05) * power(d, -2) + (12.33 / n + 0.243) * power(d, -0.0406 * ln(n) - 0.1134))), 9) AS m FROM (VALUES (100, 5), (2000, 7), (5000, 12)) t(n, d)")
def cl2_fuzzifier(spark, sf):
    return spark.createDataFrame([(n, d, round(P.fuzzifier(n, d), 9)) for n, d in ((100, 5), (2000, 7), (5000, 12))], "genes int, times int, m double")


@query(f"WITH {contrasts_sql()} SELECT contrast, gene, CASE WHEN p < 0.001 THEN '***' WHEN p < 0.01 THEN '**' WHEN p < 0.05 THEN '*' ELSE '' END AS star, CASE WHEN p < 0.05 AND abs(lfc) >= 0.1 THEN CASE WHEN lfc > 0 THEN 'later' ELSE 'base' END END AS box FROM contrasts")
def gr12_marked_changes(spark, sf):
    return N.marked_changes(contrasts(spark, sf).withColumn("padj", F.col("p")), lfc=0.1).select("contrast", "gene", "star", "box")


@query(f"WITH {contrasts_sql()} SELECT contrast, CASE WHEN p < 0.05 AND lfc > 0.1 THEN 'Up' WHEN p < 0.05 AND lfc < -0.1 THEN 'Down' ELSE 'NS' END AS side, count(*) AS n, round(max(-log10(greatest(p, 1e-300))), 6) AS top FROM contrasts GROUP BY ALL")
def gr13_volcano(spark, sf):
    c = contrasts(spark, sf)
    side = F.when((F.col("p") < 0.05) & (F.col("lfc") > 0.1), "Up").when((F.col("p") < 0.05) & (F.col("lfc") < -0.1), "Down").otherwise("NS")
    return c.groupBy("contrast", side.alias("side")).agg(F.count("*").alias("n"), F.round(F.max(-F.log10(F.greatest("p", F.lit(1e-300)))), 6).alias("top"))


@query("SELECT DISTINCT a.cond AS cond, a.time AS time, b.time AS base, 'Time_' || a.cond || '_' || a.time || '_vs_' || b.time AS contrast FROM (SELECT DISTINCT CASE WHEN l_returnflag = 'A' THEN 'WT' ELSE 'MUT' END AS cond, CAST(year(l_shipdate) - 1995 AS INT) AS time FROM lineitem WHERE l_returnflag IN ('A', 'R')) a JOIN (SELECT DISTINCT CASE WHEN l_returnflag = 'A' THEN 'WT' ELSE 'MUT' END AS cond, CAST(year(l_shipdate) - 1995 AS INT) AS time FROM lineitem WHERE l_returnflag IN ('A', 'R')) b ON a.cond = b.cond AND b.time = 0 AND a.time > 0")
def st2_contrast_names(spark, sf):
    g = expression(spark, sf).select("cond", "time").distinct()
    base = g.filter("time = 0").select("cond", F.col("time").alias("base"))
    return g.filter("time > 0").join(base, "cond").withColumn("contrast", F.format_string("Time_%s_%d_vs_%d", "cond", "time", "base"))


# learning --------------------------------------------------------------------------------------------------------------


@query("SELECT vec_id AS id, label < 5 AS positive, CAST((row_number() OVER (PARTITION BY label < 5 ORDER BY md5('7|' || vec_id)) - 1) % 5 AS INT) AS fold FROM embeddings")
def ml2_folds(spark, sf):
    return L.folds(table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), (F.col("label") < 5).alias("positive")))


@query("""WITH s AS (SELECT lang, n_chars AS score, quality = 1 AS positive FROM documents JOIN labels USING (doc_id)), n AS (SELECT lang, score, count(*) FILTER (positive) AS p, count(*) FILTER (NOT positive) AS q FROM s GROUP BY ALL),
w AS (SELECT lang, p, q, p * (sum(q) OVER (PARTITION BY lang ORDER BY score) - q + q / 2) AS won FROM n)
SELECT lang, round(sum(won) / nullif(sum(p) * sum(q), 0), 6) AS auc FROM w GROUP BY lang""")
def ml4_auc(spark, sf):
    s = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select("lang", F.col("n_chars").alias("score"), (F.col("quality") == 1).alias("positive"))
    return L.auc(s, ["lang"])


def _vectors(spark, sf):
    from pyspark.ml.functions import array_to_vector

    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), (F.col("label") < 5).alias("positive"), array_to_vector(F.transform("embedding", lambda x: x.cast("double"))).alias("features"))


@query()
def ml1_forest_auc(spark, sf):
    """ML1-ML4: AUC by fold of a forest on balanced folds."""
    return L.auc(L.forest_scores(_vectors(spark, sf))[0], ["replicate", "fold"])


@query()
def ml3_importance(spark, sf):
    """Two replicates with their own folds and negatives."""
    return L.importance_summary(L.forest_scores(_vectors(spark, sf), k=2, replicates=2)[1])


@query()
def st17_permutation_auc(spark, sf):
    """ST17: AUC of document length for quality against shuffled labels; ml6_refitted_null fits models anew."""
    s = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select(F.col("doc_id").alias("id"), F.col("n_chars").alias("score"), (F.col("quality") == 1).alias("positive"))
    null = L.auc(L.shuffled_labels(s, 20).join(s.select("id", "score"), "id"), ["round"]).withColumnRenamed("auc", "value")
    return L.empirical(null.join(F.broadcast(L.auc(s).withColumnRenamed("auc", "real"))), F.col("real"), 20)


#: The name that the query had first.
QUERIES["ml6_permutation_auc"] = st17_permutation_auc


@query()
def st3_principal_components(spark, sf):
    return L.principal_components(table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.transform("embedding", lambda x: x.cast("double")).alias("v")))


@query("SELECT date_trunc('day', ts) AS start, CAST(user_id AS VARCHAR) AS gene, count(*) AS n, round(avg(value), 6) AS value FROM events GROUP BY ALL")
def ext_windowed_profiles(spark, sf):
    """An extension: what the streaming profile gives over a table."""
    from ..streaming import windowed_profiles

    out = windowed_profiles(table(spark, sf, "events").select("ts", F.col("user_id").cast("string").alias("gene"), "value"))
    return out.withColumn("start", F.col("start").cast("timestamp_ntz"))
