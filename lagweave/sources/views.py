"""The domain's tables over the star schema: expression, sample sheet, contrasts, regulators, memberships.

Each view is a DataFrame and, for the SQL that checks it, the text of the same view.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def expression(spark: SparkSession, sf_dir: str, by_type: bool = False) -> DataFrame:
    """gene, cond, time, rep, value: log revenue of a brand (or brand and type) by return flag, ship year and line number."""
    line = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag").isin("A", "R"))
    gene = F.concat_ws("_", "p_brand", "p_type") if by_type else F.col("p_brand")
    return (
        line.join(table(spark, sf_dir, "part").select("p_partkey", gene.alias("gene")), F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("gene", F.when(F.col("l_returnflag") == "A", "WT").otherwise("MUT").alias("cond"), (F.year("l_shipdate") - 1995).alias("time"), (F.col("l_linenumber") % 3).alias("rep"))
        .agg(F.round(F.log(1 + F.sum("l_extendedprice")), 6).alias("value"), F.count("*").alias("n"))
    )


def expression_sql(by_type: bool = False) -> str:
    gene = "p_brand || '_' || p_type" if by_type else "p_brand"
    return f"""expr AS (SELECT {gene} AS gene, CASE WHEN l_returnflag = 'A' THEN 'WT' ELSE 'MUT' END AS cond,
      CAST(year(l_shipdate) - 1995 AS INT) AS time, CAST(l_linenumber % 3 AS INT) AS rep,
      round(ln(1 + sum(l_extendedprice)), 6) AS value, count(*) AS n
    FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag IN ('A', 'R') GROUP BY ALL)"""


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """gene, sample, n: quantities of a brand and type by sample, which is the condition, time and replicate of `expression`."""
    line = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag").isin("A", "R"))
    sample = F.concat_ws("_", F.when(F.col("l_returnflag") == "A", "WT").otherwise("MUT"), F.year("l_shipdate") - 1995, F.col("l_linenumber") % 3)
    part = table(spark, sf_dir, "part").select("p_partkey", F.concat_ws("_", "p_brand", "p_type").alias("gene"))
    return line.join(part, F.col("l_partkey") == F.col("p_partkey")).groupBy("gene", sample.alias("sample")).agg(F.sum("l_quantity").cast("long").alias("n"))


COUNTS_SQL = """counts AS (SELECT p_brand || '_' || p_type AS gene, CASE WHEN l_returnflag = 'A' THEN 'WT' ELSE 'MUT' END || '_' || CAST(year(l_shipdate) - 1995 AS INT) || '_' || CAST(l_linenumber % 3 AS INT) AS sample,
      CAST(sum(l_quantity) AS BIGINT) AS n FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag IN ('A', 'R') GROUP BY ALL)"""


def contrasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """contrast, gene, lfc, p: each condition and time against time 0, by a pooled t-test (a stand-in for a count model)."""
    from ..functions.maths import t_two_sided

    e = expression(spark, sf_dir)
    means = e.groupBy("gene", "cond", "time").agg(F.avg("value").alias("m"), F.var_samp("value").alias("v"), F.count("*").alias("k"))
    base = means.filter("time = 0").select("gene", "cond", F.col("m").alias("m0"), F.col("v").alias("v0"), F.col("k").alias("k0"))
    both = means.filter("time > 0").join(base, ["gene", "cond"]).filter("k = 3 AND k0 = 3")
    t = (F.col("m") - F.col("m0")) / F.sqrt((F.col("v") + F.col("v0")) / 3)
    return both.select(
        F.format_string("Time_%s_%d_vs_0", "cond", "time").alias("contrast"), "gene", "cond", "time",
        F.round((F.col("m") - F.col("m0")) / F.log(F.lit(2.0)), 6).alias("lfc"), F.round(t_two_sided(t, 4), 9).alias("p"),
    )


def contrasts_sql() -> str:
    from ..functions.maths import t_two_sided_sql

    return f"""{expression_sql()},
    means AS (SELECT gene, cond, time, avg(value) AS m, var_samp(value) AS v, count(*) AS k FROM expr GROUP BY ALL),
    tests AS (SELECT a.gene, a.cond, a.time, a.m - b.m AS d, (a.m - b.m) / sqrt((a.v + b.v) / 3) AS t
      FROM means a JOIN means b ON a.gene = b.gene AND a.cond = b.cond AND b.time = 0 WHERE a.time > 0 AND a.k = 3 AND b.k = 3),
    contrasts AS (SELECT 'Time_' || cond || '_' || time || '_vs_0' AS contrast, gene, cond, time,
      round(d / ln(2.0), 6) AS lfc, round({t_two_sided_sql('t', 4)}, 9) AS p FROM tests)"""


def regulators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tf, family: brands whose number ends in 1 or 3; the family is the first digit."""
    return table(spark, sf_dir, "part").select(F.col("p_brand").alias("tf")).distinct().filter(F.col("tf").rlike("[13]$")).withColumn("family", F.regexp_extract("tf", r"#(\d)", 1))


REGULATORS_SQL = "tfs AS (SELECT DISTINCT p_brand AS tf, regexp_extract(p_brand, '#(\\d)', 1) AS family FROM part WHERE regexp_matches(p_brand, '[13]$'))"


def memberships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """gene, cond, cluster, membership: fuzzy memberships (fuzzifier 2) of standardised profiles in three clusters.

    The clusters' centres are the profiles of the three genes first in name."""
    from ..operators.profiles import fuzzy_membership, profiles, standardised

    p = standardised(profiles(expression(spark, sf_dir)))
    names = p.select("gene").distinct().orderBy("gene").limit(3)
    rank = names.select("gene", (F.dense_rank().over(W.orderBy("gene"))).alias("cluster"))
    return fuzzy_membership(p, p.join(rank, "gene").select("cond", "cluster", "time", F.col("z").alias("centre")))


MEMBERSHIPS_SQL = """prof AS (SELECT gene, cond, time, avg(value) AS value FROM expr GROUP BY ALL),
    full_genes AS (SELECT gene, cond FROM prof GROUP BY ALL HAVING count(*) = 7 AND stddev_samp(value) > 1e-9),
    stand AS (SELECT gene, cond, time, (value - avg(value) OVER w) / stddev_samp(value) OVER w AS z FROM prof JOIN full_genes USING (gene, cond) WINDOW w AS (PARTITION BY gene, cond)),
    names AS (SELECT gene, CAST(row_number() OVER (ORDER BY gene) AS INT) AS cluster FROM (SELECT DISTINCT gene FROM stand) ORDER BY gene LIMIT 3),
    dists AS (SELECT s.gene, s.cond, n.cluster, sum((s.z - c.z) ** 2) AS d2 FROM stand s JOIN stand c ON s.cond = c.cond AND s.time = c.time JOIN names n ON n.gene = c.gene GROUP BY ALL),
    members AS (SELECT gene, cond, cluster, round(CASE WHEN min(d2) OVER g < 1e-12 THEN CASE WHEN d2 < 1e-12 THEN 1.0 ELSE 0.0 END ELSE (1 / d2) / sum(1 / greatest(d2, 1e-12)) OVER g END, 6) AS membership FROM dists WINDOW g AS (PARTITION BY gene, cond))"""
