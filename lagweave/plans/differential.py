"""Queries of the count model, each with the SQL that it is held against where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import counts as C
from ..sources.views import COUNTS_SQL, counts
from ..storage import stored

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str = ""):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _model(spark: SparkSession, sf: str) -> tuple[C.Model, DataFrame]:
    """The model of the counts of expressed genes, with a group for each condition and time, and those counts."""
    n = stored(C.expressed(counts(spark, sf)), "expressed")
    sheet = sorted((r.sample, r.sample.rsplit("_", 1)[0]) for r in n.select("sample").distinct().collect())
    return C.fit(n, sheet), n


@query(f"""WITH {COUNTS_SQL}, centre AS (SELECT gene, avg(ln(n)) AS m FROM counts WHERE n > 0 GROUP BY gene HAVING count(*) = (SELECT count(DISTINCT sample) FROM counts))
SELECT sample, round(exp(median(ln(n) - m)), 6) AS size_factor FROM counts JOIN centre USING (gene) WHERE n > 0 GROUP BY sample""")
def st1_size_factors(spark, sf):
    return C.size_factors(counts(spark, sf)).withColumn("size_factor", F.round("size_factor", 6))


@query(f"WITH {COUNTS_SQL}, kept AS (SELECT gene FROM counts GROUP BY gene HAVING count(*) FILTER (n >= 10) >= 3) SELECT gene, sample, n FROM counts JOIN kept USING (gene)")
def st1_expressed(spark, sf):
    return C.expressed(counts(spark, sf))


@query()
def st1_contrasts(spark, sf):
    """Every condition and time against the condition's time 0, and MUT against WT at each time."""
    model, _ = _model(spark, sf)
    pairs = [(f"Time_{g}_vs_0", g, f"{g.rsplit('_', 1)[0]}_0") for g in model.groups if not g.endswith("_0")]
    pairs += [(f"Cond_MUT_vs_WT_{g[4:]}", g, f"WT_{g[4:]}") for g in model.groups if g.startswith("MUT") and f"WT_{g[4:]}" in model.groups]
    found = model.contrast([p for p in pairs if p[2] in model.groups])
    return found.select("contrast", "gene", *[F.round(c, 6).alias(c) for c in ("base_mean", "lfc", "se", "stat", "p", "fdr")])


@query()
def st1_dispersions(spark, sf):
    model, _ = _model(spark, sf)
    return model.genes.select("gene", *[F.round(c, 6).alias(c) for c in ("base_mean", "dispersion_gene", "trend", "dispersion")], "outlier")


@query()
def st1_stabilised(spark, sf):
    model, n = _model(spark, sf)
    return model.stabilised(n).withColumn("value", F.round("value", 6))
