"""Queries of the relational operators over the star schema, each with the SQL that it is held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import strings as S
from ..operators import relational as R
from ..sources.views import REGULATORS_SQL, contrasts, contrasts_sql, expression, expression_sql, regulators, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    """Registers a query under its name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


E, ED = expression_sql(), expression_sql(by_type=True)
C = contrasts_sql()


def _contrasts(spark: SparkSession, sf: str) -> DataFrame:
    return contrasts(spark, sf).withColumn("padj", F.col("p"))


# sources -----------------------------------------------------------------------------------------------------------------


@query("SELECT DISTINCT CASE WHEN l_returnflag = 'A' THEN 'WT' ELSE 'MUT' END AS cond, CAST(year(l_shipdate) - 1995 AS INT) AS time, CAST(l_linenumber % 3 AS INT) AS rep FROM lineitem WHERE l_returnflag IN ('A', 'R')")
def sample_sheet(spark, sf):
    return expression(spark, sf).select("cond", "time", "rep").distinct()


@query("SELECT p_type AS label, CAST(regexp_replace(p_type || '12.5h', '[^0-9.]', '', 'g') AS DOUBLE) AS value, count(*) AS n FROM part GROUP BY ALL")
def ts1_time_label(spark, sf):
    return table(spark, sf, "part").groupBy(F.col("p_type").alias("label")).agg(F.count("*").alias("n")).withColumn("value", S.time_value(F.concat("label", F.lit("12.5h"))))


@query("SELECT DISTINCT trim(x) AS gene FROM (SELECT unnest(string_split('Brand#11, Brand#12,Brand#11 ,Brand#99', ',')) AS x) JOIN part ON trim(x) = p_brand")
def src8_query_list(spark, sf):
    wanted = spark.range(1).select(F.explode(F.split(F.lit("Brand#11, Brand#12,Brand#11 ,Brand#99"), ",")).alias("x")).select(F.trim("x").alias("gene")).distinct()
    return wanted.join(table(spark, sf, "part").select(F.col("p_brand").alias("gene")), "gene", "left_semi")


@query("SELECT k AS low_high, count(*) AS n FROM part, (SELECT unnest(['00-10', '10-20', '20-50']) AS k) WHERE p_size >= CAST(string_split(k, '-')[1] AS DOUBLE) AND p_size <= CAST(string_split(k, '-')[2] AS DOUBLE) GROUP BY ALL")
def src10_ranges(spark, sf):
    parts = table(spark, sf, "part").select("p_size", F.explode(S.ranges(F.lit("00-10,10-20,20-50"))).alias("r")).filter((F.col("p_size") >= F.col("r.low")) & (F.col("p_size") <= F.col("r.high")))
    return parts.groupBy(F.concat(F.format_string("%02d", F.col("r.low").cast("int")), F.lit("-"), F.col("r.high").cast("int")).alias("low_high")).agg(F.count("*").alias("n"))


@query("SELECT map_extract(MAP {'WT': 'blue', 'MUT': 'red'}, cond)[1] AS colour, count(*) AS n FROM (SELECT CASE WHEN l_returnflag = 'A' THEN 'WT' ELSE 'MUT' END AS cond FROM lineitem WHERE l_returnflag IN ('A', 'R')) GROUP BY ALL")
def src9_config_map(spark, sf):
    line = table(spark, sf, "lineitem").filter(F.col("l_returnflag").isin("A", "R"))
    cond = F.when(F.col("l_returnflag") == "A", "WT").otherwise("MUT")
    return line.select(F.element_at(S.key_values(F.lit("WT:blue,MUT:red")), cond).alias("colour")).groupBy("colour").agg(F.count("*").alias("n"))


# filters -----------------------------------------------------------------------------------------------------------------


@query(f"WITH {E} SELECT gene, cond, time, rep, n FROM expr SEMI JOIN (SELECT * FROM (VALUES ('WT', 1), ('MUT', 2)) t(cond, time)) s ON expr.cond = s.cond AND expr.time = s.time")
def flt1_aligned(spark, sf):
    sheet = spark.createDataFrame([("WT", 1), ("MUT", 2)], "cond string, time int")
    return R.aligned(expression(spark, sf), sheet, ["cond", "time"]).select("gene", "cond", "time", "rep", "n")


@query(f"WITH {E} SELECT gene, cond, time, rep, n FROM expr WHERE gene IN (SELECT gene FROM expr GROUP BY gene HAVING count(*) FILTER (n >= 20) >= 3)")
def flt2_low_counts(spark, sf):
    return R.expressed(expression(spark, sf), least=20).select("gene", "cond", "time", "rep", "n")


@query(f"WITH {C} SELECT contrast, gene, lfc, p FROM contrasts WHERE p < 0.2 AND abs(lfc) > 0.1")
def flt3_differential(spark, sf):
    return R.differential(_contrasts(spark, sf), 0.2, 0.1).select("contrast", "gene", "lfc", "p")


@query(f"WITH {C} SELECT contrast, CASE WHEN lfc > 0.1 THEN 'Up' ELSE 'Down' END AS direction, count(*) AS n FROM contrasts WHERE p < 0.2 AND abs(lfc) > 0.1 GROUP BY ALL")
def flt4_directional(spark, sf):
    return R.directional(_contrasts(spark, sf), 0.2, 0.1).groupBy("contrast", "direction").agg(F.count("*").alias("n"))


@query(f"WITH {C} SELECT DISTINCT contrast, regexp_extract(contrast, '^(?:Time|TimeCourse)_([^_]+)_(.+?)_vs_', 1) AS cond_, regexp_extract(contrast, '^(?:Time|TimeCourse)_([^_]+)_(.+?)_vs_', 2) AS time_ FROM contrasts")
def flt5_contrast_parts(spark, sf):
    return R.contrast_parts(contrasts(spark, sf)).select("contrast", "cond_", "time_").distinct()


@query(f"WITH {ED} SELECT gene, cond, time, rep FROM expr WHERE gene IN (SELECT gene FROM expr GROUP BY gene HAVING count(DISTINCT time) = 7 AND count(*) > 0)")
def flt6_complete(spark, sf):
    return R.complete(expression(spark, sf, True), ["gene"], "time", 7).select("gene", "cond", "time", "rep")


@query(f"WITH {E}, prof AS (SELECT gene, cond, time, avg(value) AS value FROM expr GROUP BY ALL) SELECT gene, cond, time, round(value, 6) AS value FROM prof WHERE (gene, cond) IN (SELECT (gene, cond) FROM prof GROUP BY gene, cond HAVING stddev_samp(value) >= 0.1)")
def flt7_varying(spark, sf):
    from ..operators.profiles import profiles

    return R.varying(profiles(expression(spark, sf)), ["gene", "cond"], 0.1).withColumn("value", F.round("value", 6))


@query(f"""WITH {E}, means AS (SELECT gene, cond, time, avg(value) AS m FROM expr GROUP BY ALL),
d AS (SELECT gene, m, abs(m - first_value(m) OVER (PARTITION BY gene, cond ORDER BY time)) AS d FROM means),
pool AS (SELECT gene, max(d) AS max_lfc, avg(m) AS mean FROM d GROUP BY gene)
SELECT gene, round(max_lfc, 9) AS max_lfc, round(mean, 6) AS mean FROM pool WHERE max_lfc < 0.8 AND mean >= 1 AND gene NOT IN (SELECT DISTINCT p_brand FROM part WHERE regexp_matches(p_brand, '[13]$'))""")
def flt10_nonresponsive(spark, sf):
    out = R.nonresponsive(R.max_fold(expression(spark, sf)), regulators(spark, sf).select(F.col("tf").alias("gene")), 0.8)
    return out.select("gene", F.round("max_lfc", 9).alias("max_lfc"), F.round("mean", 6).alias("mean"))


@query("SELECT p_partkey, p_name FROM part WHERE lower(p_name) LIKE '%red%' OR lower(p_type) LIKE '%brass%'")
def flt18_keywords(spark, sf):
    return table(spark, sf, "part").filter(S.contains_any(["RED", "brass"], F.col("p_name"), F.col("p_type"))).select("p_partkey", "p_name")


@query("SELECT doc_id, nullif(source, 'src3') AS source FROM documents")
def prj1_symbol_cleanup(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.nullif("source", F.lit("src3")).alias("source"))


@query(f"WITH {E} SELECT gene, regexp_replace(cond, '^MUT$', 'dof') AS cond, regexp_replace(gene, '#.*$', '') AS stem, count(*) AS n FROM expr GROUP BY ALL")
def prj2_labels(spark, sf):
    return expression(spark, sf).groupBy("gene", F.regexp_replace("cond", "^MUT$", "dof").alias("cond"), S.strip_id(F.col("gene"), "#.*$").alias("stem")).agg(F.count("*").alias("n"))


# joins -------------------------------------------------------------------------------------------------------------------


@query("""SELECT l_partkey AS part, coalesce(sum(l_quantity) FILTER (l_returnflag = 'A'), 0.0) AS A, coalesce(sum(l_quantity) FILTER (l_returnflag = 'N'), 0.0) AS N, coalesce(sum(l_quantity) FILTER (l_returnflag = 'R'), 0.0) AS R FROM lineitem GROUP BY ALL""")
def jn1_wide_matrix(spark, sf):
    return R.wide(table(spark, sf, "lineitem").withColumnRenamed("l_partkey", "part"), "part", "l_returnflag", "l_quantity", ["A", "N", "R"])


@query("SELECT o_orderkey, c_name, n_name FROM orders LEFT JOIN (SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_mktsegment = 'BUILDING') ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey")
def jn3_left_annotation(spark, sf):
    cust = table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'").select("c_custkey", "c_name", "c_nationkey")
    out = table(spark, sf, "orders").join(cust, F.col("o_custkey") == F.col("c_custkey"), "left")
    return out.join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left").select("o_orderkey", "c_name", "n_name")


@query("""SELECT c_custkey, o_orderkey, o_totalprice FROM customer LEFT JOIN (SELECT * FROM (SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS k FROM orders) WHERE k = 1) ON c_custkey = o_custkey""")
def jn4_first_match(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    return R.lookup_first(table(spark, sf, "customer").select("c_custkey"), orders, ["c_custkey"], [F.col("o_totalprice"), F.col("o_orderkey")])


@query("""WITH t AS (SELECT s_nationkey AS n, p_type AS k, count(*) AS q FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey GROUP BY ALL)
SELECT n AS nation, k AS kind, q, CAST(sum(q) OVER (PARTITION BY n) AS BIGINT) AS by_nation, CAST(sum(q) OVER (PARTITION BY k) AS BIGINT) AS by_kind, CAST(sum(q) OVER () AS BIGINT) AS every FROM t""")
def jn6_margins(spark, sf):
    line = table(spark, sf, "lineitem").select("l_suppkey", "l_partkey")
    t = line.join(table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation")), F.col("l_suppkey") == F.col("s_suppkey")).join(table(spark, sf, "part").select("p_partkey", F.col("p_type").alias("kind")), F.col("l_partkey") == F.col("p_partkey")).groupBy("nation", "kind").agg(F.count("*").alias("q"))
    return t.withColumns({"by_nation": F.sum("q").over(W.partitionBy("nation")), "by_kind": F.sum("q").over(W.partitionBy("kind")), "every": F.sum("q").over(W.partitionBy())})


@query("SELECT l_partkey, l_returnflag, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_quantity DESC, l_extendedprice, l_orderkey, l_linenumber, l_returnflag) AS k FROM lineitem) WHERE k = 1")
def jn8_first_per_key(spark, sf):
    first = R.first_per(table(spark, sf, "lineitem"), ["l_partkey"], [F.desc("l_quantity"), F.col("l_extendedprice"), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_returnflag")])
    return first.select("l_partkey", "l_returnflag", "l_quantity")


SHIP = """ship AS (SELECT DISTINCT c_nationkey AS tf, s_nationkey AS target, l_returnflag AS edge_class FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey WHERE l_quantity > 49)"""


def _ship(spark, sf):
    """Customer nation to supplier nation, by return flag, of large lines: a small directed graph."""
    line = table(spark, sf, "lineitem").filter("l_quantity > 49").select("l_orderkey", "l_suppkey", F.col("l_returnflag").alias("edge_class"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey").join(table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("tf")), F.col("o_custkey") == F.col("c_custkey"))
    supp = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("target"))
    return line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(supp, F.col("l_suppkey") == F.col("s_suppkey")).select("tf", "target", "edge_class").distinct()


@query(f"WITH {SHIP} SELECT tf, target, edge_class FROM ship WHERE tf IN (3, 7) OR target IN (3, 7)")
def jn11_touching(spark, sf):
    return R.touching(_ship(spark, sf), spark.createDataFrame([(3,), (7,)], "node int"))


@query(f"WITH {SHIP} SELECT a.tf, a.target, a.edge_class FROM ship a ANTI JOIN (SELECT * FROM ship WHERE edge_class = 'A') b ON a.tf = b.tf AND a.target = b.target")
def jn12_not_yet(spark, sf):
    e = _ship(spark, sf)
    return e.join(e.filter("edge_class = 'A'").select("tf", "target"), ["tf", "target"], "left_anti")


@query(f"WITH {SHIP} SELECT a.target, a.edge_class AS class_a, b.edge_class AS class_b FROM ship a JOIN ship b ON a.target = b.target WHERE a.tf = 1 AND b.tf = 2")
def jn13_shared_targets(spark, sf):
    return R.shared_targets(_ship(spark, sf).withColumn("r", F.lit(0)), 1, 2).select("target", "class_a", "class_b")


@query("""SELECT gene, source FROM (SELECT DISTINCT p_brand AS gene, 'primary' AS source FROM part WHERE p_size = 1 UNION ALL SELECT DISTINCT p_brand, 'secondary' FROM part WHERE p_size < 4 AND p_brand NOT IN (SELECT p_brand FROM part WHERE p_size = 1))""")
def jn15_highlights(spark, sf):
    part = table(spark, sf, "part").withColumnRenamed("p_brand", "gene")
    return R.merged_highlights(part.filter("p_size = 1"), part.filter("p_size < 4"))


# aggregates --------------------------------------------------------------------------------------------------------------


@query(f"WITH {E} SELECT gene, cond, time, round(avg(value), 6) AS value FROM expr GROUP BY ALL")
def agg1_replicate_mean(spark, sf):
    from ..operators.profiles import profiles

    return profiles(expression(spark, sf)).withColumn("value", F.round("value", 6))


@query(f"WITH {E}, means AS (SELECT gene, cond, time, avg(value) AS m FROM expr GROUP BY ALL), d AS (SELECT gene, m, abs(m - first_value(m) OVER (PARTITION BY gene, cond ORDER BY time)) AS d FROM means) SELECT gene, round(max(d), 9) AS max_lfc, round(avg(m), 6) AS mean FROM d GROUP BY gene")
def agg2_max_fold(spark, sf):
    return R.max_fold(expression(spark, sf)).select("gene", F.round("max_lfc", 9).alias("max_lfc"), F.round("mean", 6).alias("mean"))


@query(f"WITH {C} SELECT DISTINCT gene FROM contrasts WHERE p < 0.2 AND abs(lfc) > 0.1")
def agg3_union(spark, sf):
    return R.differential(_contrasts(spark, sf), 0.2, 0.1).select("gene").distinct()


@query("SELECT o_orderpriority AS tf, o_orderstatus AS cluster, count(*) AS n, grouping(o_orderpriority) + 0 AS all_tf, grouping(o_orderstatus) + 0 AS all_cluster FROM orders GROUP BY CUBE (o_orderpriority, o_orderstatus)")
def agg5_margins(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("tf"), F.col("o_orderstatus").alias("cluster"))
    return orders.cube("tf", "cluster").agg(F.count("*").alias("n"), F.grouping("tf").cast("long").alias("all_tf"), F.grouping("cluster").cast("long").alias("all_cluster"))


@query("""WITH n AS (SELECT CAST(p_size % 5 AS INT) AS w, CAST(p_partkey % 4 AS INT) AS m, count(*) AS overlap FROM part GROUP BY ALL), t AS (SELECT w, m, overlap, CAST(sum(overlap) OVER (PARTITION BY w) AS BIGINT) AS total, row_number() OVER (PARTITION BY w ORDER BY overlap DESC, m) AS k FROM n)
SELECT w AS wt_cluster, m AS mut_cluster, overlap, total, round(overlap / total, 3) AS ratio FROM t WHERE k = 1""")
def agg6_confusion(spark, sf):
    part = table(spark, sf, "part")
    return R.confusion(part.select(F.col("p_partkey").alias("gene"), (F.col("p_size") % 5).alias("cluster")), part.select(F.col("p_partkey").alias("gene"), (F.col("p_partkey") % 4).cast("int").alias("cluster")))


@query("SELECT p_brand AS cluster, round(count(DISTINCT p_size) FILTER (p_type LIKE '%BRASS%') / count(DISTINCT p_size), 6) AS divergence FROM part GROUP BY ALL")
def agg7_divergence(spark, sf):
    return table(spark, sf, "part").groupBy(F.col("p_brand").alias("cluster")).agg(F.round(F.count_distinct(F.when(F.col("p_type").contains("BRASS"), F.col("p_size"))) / F.count_distinct("p_size"), 6).alias("divergence"))


@query("SELECT l_partkey AS feature, round(avg(l_discount), 6) AS mean_importance, round(stddev_samp(l_discount), 6) AS sd_importance, round(avg(CASE WHEN l_discount > 0 THEN 1.0 ELSE 0.0 END), 6) AS selection_freq FROM lineitem GROUP BY ALL")
def agg8_importance(spark, sf):
    return table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("feature")).agg(F.round(F.avg("l_discount"), 6).alias("mean_importance"), F.round(F.stddev_samp("l_discount"), 6).alias("sd_importance"), F.round(F.avg((F.col("l_discount") > 0).cast("double")), 6).alias("selection_freq"))


@query("SELECT p_type AS kmer, min_by(p_brand, p_retailprice * 1000000 + p_partkey) AS first_cluster, count(*) AS n, array_to_string(list_sort(list_distinct(list(p_brand))), ';') AS clusters, max(p_retailprice) AS max_fe, min(p_retailprice) AS min_p FROM part GROUP BY ALL")
def agg9_whitelist(spark, sf):
    return table(spark, sf, "part").groupBy(F.col("p_type").alias("kmer")).agg(F.min_by("p_brand", F.col("p_retailprice") * 1000000 + F.col("p_partkey")).alias("first_cluster"), F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_set("p_brand")), ";").alias("clusters"), F.max("p_retailprice").alias("max_fe"), F.min("p_retailprice").alias("min_p"))


@query("SELECT l_returnflag AS edge_class, count(*) AS n, CAST(CAST(round(100.0 * count(*) / sum(count(*)) OVER (), 0) AS INT) AS VARCHAR) || '%' AS label FROM lineitem GROUP BY ALL")
def agg12_distribution(spark, sf):
    return R.distribution(table(spark, sf, "lineitem").withColumnRenamed("l_returnflag", "edge_class"), "edge_class")


@query("SELECT node, edge_class, n FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY CASE WHEN edge_class = 'MACHINERY' THEN 1 ELSE 0 END, n DESC, edge_class) AS k FROM (SELECT c_nationkey AS node, c_mktsegment AS edge_class, count(*) AS n FROM customer GROUP BY ALL)) WHERE k = 1")
def agg14_dominant(spark, sf):
    return R.dominant(table(spark, sf, "customer").select(F.col("c_nationkey").alias("node"), F.col("c_mktsegment").alias("edge_class")), "node", "edge_class", last="MACHINERY")


@query(f"WITH {SHIP}, e AS (SELECT tf AS node, edge_class FROM ship UNION ALL SELECT target, edge_class FROM ship) SELECT node, count(*) AS degree, count(*) FILTER (edge_class <> 'N') AS effective FROM e GROUP BY ALL")
def agg16_degree(spark, sf):
    return R.degrees(_ship(spark, sf), "N")


@query("SELECT o_orderpriority AS priority, round(quantile_cont(o_totalprice, 0.95), 4) AS q95, round(quantile_cont(o_totalprice, 0.99), 4) AS q99 FROM orders GROUP BY ALL")
def agg17_quantiles(spark, sf):
    q = R.quantile(table(spark, sf, "orders").withColumnRenamed("o_orderpriority", "priority"), "o_totalprice", [0.95, 0.99], ["priority"])
    return q.select("priority", F.round("q95", 4).alias("q95"), F.round("q99", 4).alias("q99"))


@query("""WITH top AS (SELECT p_brand, p_type FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 300)
SELECT p_brand AS family, count(*) FILTER (p_type LIKE '%STEEL%') AS steel, count(*) FILTER (p_type LIKE '%BRASS%') AS brass, count(*) AS n FROM top GROUP BY ALL""")
def agg20_circos(spark, sf):
    top = table(spark, sf, "part").orderBy(F.desc("p_retailprice"), "p_partkey").limit(300)
    has = lambda w: F.sum(F.col("p_type").contains(w).cast("long"))
    return top.groupBy(F.col("p_brand").alias("family")).agg(has("STEEL").alias("steel"), has("BRASS").alias("brass"), F.count("*").alias("n"))


# windows, top-k, reshaping -----------------------------------------------------------------------------------------------


@query("SELECT p_brand, p_partkey, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice, p_partkey) AS INT) AS rank FROM part")
def win1_row_number(spark, sf):
    return R.ranked(table(spark, sf, "part"), ["p_brand"], [F.col("p_retailprice"), F.col("p_partkey")]).select("p_brand", "p_partkey", "rank")


@query("SELECT p_brand, p_partkey FROM (SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS k FROM part) WHERE k <= 5")
def win2_top_per_group(spark, sf):
    return R.top(table(spark, sf, "part"), ["p_brand"], [F.desc("p_retailprice"), F.col("p_partkey")], 5).select("p_brand", "p_partkey")


@query("SELECT *, CAST(rank() OVER (PARTITION BY cluster ORDER BY max_importance DESC) AS INT) AS evidence_rank FROM (SELECT p_type AS cluster, p_brand AS family, max(p_size) AS max_importance, count(*) AS n_hits FROM part GROUP BY ALL)")
def win3_evidence_rank(spark, sf):
    from ..operators.network import evidence_ranks

    return evidence_ranks(table(spark, sf, "part").select(F.col("p_type").alias("cluster"), F.col("p_brand").alias("family"), F.col("p_size").alias("importance")))


@query(f"WITH {E}, v AS (SELECT *, dense_rank() OVER (ORDER BY time) AS i FROM expr) SELECT a.gene, a.cond, a.rep, a.time, a.value AS x, b.value AS y FROM v a JOIN v b ON a.gene = b.gene AND a.cond = b.cond AND a.rep = b.rep AND b.i = a.i + 2")
def win5_lagged_pairs(spark, sf):
    return R.lagged_pairs(expression(spark, sf), ["gene", "cond", "rep"], 2)


@query("SELECT p_partkey, rank() OVER (PARTITION BY p_brand ORDER BY p_size) + (count(*) OVER (PARTITION BY p_brand, p_size) - 1) / 2.0 AS avg_rank FROM part")
def win6_average_rank(spark, sf):
    return table(spark, sf, "part").select("p_partkey", R.average_rank("p_size", ["p_brand"]).cast("double").alias("avg_rank"))


@query(f"""WITH {C}, u AS (SELECT contrast, p, count(*) AS n FROM contrasts GROUP BY ALL), c AS (SELECT contrast, p, sum(n) OVER (PARTITION BY contrast ORDER BY p) AS at_, sum(n) OVER (PARTITION BY contrast) AS all_ FROM u),
f AS (SELECT contrast, p, least(1.0, min(p * all_ / at_) OVER (PARTITION BY contrast ORDER BY p DESC)) AS fdr FROM c)
SELECT contrast, gene, t.p, round(fdr, 6) AS fdr FROM contrasts t JOIN f USING (contrast, p)""")
def win7_false_discovery(spark, sf):
    return R.false_discovery(contrasts(spark, sf), by=["contrast"]).select("contrast", "gene", "p", F.round("fdr", 6).alias("fdr"))


@query(f"WITH {E}, prof AS (SELECT gene, cond, time, avg(value) AS v FROM expr GROUP BY ALL) SELECT gene, cond, time, round(greatest(-2.5, least(2.5, (v - avg(v) OVER w) / stddev_samp(v) OVER w)), 6) AS z FROM prof WINDOW w AS (PARTITION BY gene, cond)")
def win8_z_scores(spark, sf):
    from ..operators.profiles import profiles

    own = W.partitionBy("gene", "cond")
    z = (F.col("value") - F.avg("value").over(own)) / F.stddev_samp("value").over(own)
    return profiles(expression(spark, sf)).select("gene", "cond", "time", F.round(F.greatest(F.lit(-2.5), F.least(F.lit(2.5), z)), 6).alias("z"))


@query("SELECT source, CAST(row_number() OVER (ORDER BY CAST(regexp_replace(source, '\\D', '', 'g') AS BIGINT), source) AS INT) AS place FROM (SELECT DISTINCT source FROM documents)")
def win9_natural_sort(spark, sf):
    return table(spark, sf, "documents").select("source").distinct().withColumn("place", F.row_number().over(W.orderBy(S.natural_key(F.col("source")), "source")))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def top1_global(spark, sf):
    return table(spark, sf, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20).select("o_orderkey", "o_totalprice")


@query("SELECT o_orderkey, o_orderstatus FROM orders ORDER BY CASE o_orderstatus WHEN 'P' THEN 1 WHEN 'F' THEN 2 ELSE 3 END, abs(o_totalprice - 150000) DESC, o_orderkey LIMIT 500")
def top2_tiered_cap(spark, sf):
    level = F.when(F.col("o_orderstatus") == "P", 1).when(F.col("o_orderstatus") == "F", 2).otherwise(3)
    return R.tiered_cap(table(spark, sf, "orders").withColumn("d", F.col("o_totalprice") - 150000), 500, level, "d", ["o_orderkey"]).select("o_orderkey", "o_orderstatus")


@query("SELECT c_nationkey AS nation, round(coalesce(sum(c_acctbal) FILTER (c_mktsegment = 'BUILDING'), 0), 2) AS BUILDING, round(coalesce(sum(c_acctbal) FILTER (c_mktsegment = 'MACHINERY'), 0), 2) AS MACHINERY FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') GROUP BY ALL")
def rsh1_pivot(spark, sf):
    cust = table(spark, sf, "customer").filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).withColumnRenamed("c_nationkey", "nation")
    w = R.wide(cust, "nation", "c_mktsegment", "c_acctbal", ["BUILDING", "MACHINERY"])
    return w.select("nation", F.round("BUILDING", 2).alias("BUILDING"), F.round("MACHINERY", 2).alias("MACHINERY"))


@query("SELECT p_partkey, 'p_size' AS name, CAST(p_size AS DOUBLE) AS value FROM part UNION ALL SELECT p_partkey, 'p_retailprice', p_retailprice FROM part")
def rsh2_long(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_retailprice")
    return part.unpivot("p_partkey", ["p_size", "p_retailprice"], "name", "value")


# sets --------------------------------------------------------------------------------------------------------------------


@query("SELECT gene, CASE WHEN a AND b THEN 'both' WHEN a THEN 'only_a' ELSE 'only_b' END AS part FROM (SELECT c_nationkey AS gene, bool_or(c_acctbal > 9500) AS a, bool_or(c_acctbal < -900) AS b FROM customer GROUP BY ALL) WHERE a OR b")
def set1_venn(spark, sf):
    cust = table(spark, sf, "customer").withColumnRenamed("c_nationkey", "gene")
    return R.venn(cust.filter("c_acctbal > 9500"), cust.filter("c_acctbal < -900"))


@query("""WITH m AS (SELECT DISTINCT p_brand AS s, p_size AS i FROM part), n AS (SELECT s, count(*) AS n FROM m GROUP BY ALL), c AS (SELECT a.s AS a, b.s AS b, count(*) AS common FROM m a JOIN m b ON a.i = b.i AND a.s <= b.s GROUP BY ALL)
SELECT a, b, common, round(common / least(x.n, y.n), 6) AS overlap, round(common / (x.n + y.n - common), 6) AS jaccard, round(common / y.n, 6) AS share FROM c JOIN n x ON c.a = x.s JOIN n y ON c.b = y.s""")
def set4_overlaps(spark, sf):
    return R.set_overlaps(table(spark, sf, "part").select(F.col("p_brand").alias("set"), F.col("p_size").alias("item")))


@query("SELECT pattern, count(*) AS n FROM (SELECT c_nationkey, array_to_string(list_sort(list_distinct(list(c_mktsegment))), '&') AS pattern FROM customer WHERE c_acctbal > 8000 GROUP BY ALL) GROUP BY ALL")
def rsh4_upset(spark, sf):
    return R.intersections(table(spark, sf, "customer").filter("c_acctbal > 8000").select(F.col("c_mktsegment").alias("set"), F.col("c_nationkey").alias("item")))
