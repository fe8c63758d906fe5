"""Readers and writers of the domain's file formats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, path: str, sep: str = "\t", comment: str | None = None) -> DataFrame:
    """A delimited file with a header; columns keep their names, types are inferred. Malformed rows give nulls."""
    reader = spark.read.option("header", True).option("inferSchema", True).option("sep", sep).option("mode", "PERMISSIVE")
    return (reader.option("comment", comment) if comment else reader).csv(path)


def read_table_or_none(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame | None:
    """As read_table(); None where the path cannot be read."""
    from pyspark.errors import AnalysisException

    try:
        return read_table(spark, path, sep)
    except AnalysisException:
        return None


def read_directory(spark: SparkSession, pattern: str, name: str, sep: str = "\t") -> DataFrame:
    """All files of a glob, with column source: the first group of `name` in the file's name."""
    return read_table(spark, pattern, sep).withColumn("source", F.regexp_extract(F.col("_metadata.file_name"), name, 1))


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """gene, sample, n from a counting tool's table: comment lines and the five annotation columns go, sample names lose folders and suffixes."""
    raw = read_table(spark, path, comment="#")
    samples = raw.columns[6:]
    clean = {c: c.rsplit("/", 1)[-1].removesuffix(".bam").removesuffix(".sorted") for c in samples}
    long = raw.select(F.col(f"`{raw.columns[0]}`").cast("string").alias("gene"), *[F.col(f"`{c}`").cast("long").alias(n) for c, n in clean.items()])
    return long.unpivot("gene", list(clean.values()), "sample", "n")


def read_alignment_logs(spark: SparkSession, pattern: str) -> DataFrame:
    """sample, reads, rate scraped from aligners' logs, one file a sample."""
    lines = spark.read.text(pattern).select(F.regexp_extract(F.col("_metadata.file_name"), r"^([^.]+)", 1).alias("sample"), "value")
    grab = lambda p: F.max(F.when(F.regexp_extract("value", p, 1) != "", F.regexp_extract("value", p, 1)))
    return lines.groupBy("sample").agg(grab(r"^(\d+) reads").cast("long").alias("reads"), grab(r"([\d.]+)% overall alignment rate").cast("double").alias("rate"))


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """name, seq: records split at '>', line ends removed."""
    raw = spark.read.option("lineSep", ">").text(path).filter(F.trim("value") != "")
    body = F.split("value", "\n", 2)
    return raw.select(F.regexp_extract(body[0], r"^(\S+)", 1).alias("name"), F.upper(F.regexp_replace(F.coalesce(F.get(body, 1), F.lit("")), r"\s", "")).alias("seq"))


def read_gff(spark: SparkSession, path: str, feature: str = "gene") -> DataFrame:
    """seqid, start, end, strand, attributes (map) of the features of one kind."""
    names = ("seqid", "origin", "feature", "start", "end", "score", "strand", "phase", "attribute")
    raw = spark.read.option("sep", "\t").option("comment", "#").csv(path, schema=", ".join(f"`{n}` string" for n in names))
    return raw.filter(F.col("feature") == feature).select("seqid", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "strand", F.str_to_map("attribute", F.lit(";"), F.lit("=")).alias("attributes"))


def read_meme(spark: SparkSession, path: str) -> DataFrame:
    """name, ppm (array of columns of four shares) from a motif file."""
    raw = spark.read.option("lineSep", "MOTIF ").text(path).filter(F.col("value").contains("letter-probability matrix"))
    lines = F.split(F.regexp_extract("value", r"letter-probability matrix[^\n]*\n([\s\S]*)", 1), "\n")
    numbers = F.filter(F.transform(lines, lambda x: F.transform(F.filter(F.split(F.trim(x), r"\s+"), lambda y: y.rlike(r"^[\d.eE+-]+$")), lambda y: y.cast("double"))), lambda x: F.size(x) == 4)
    return raw.select(F.regexp_extract("value", r"^(\S+)", 1).alias("name"), numbers.alias("ppm"))


def read_highlights(spark: SparkSession, path: str) -> DataFrame:
    """symbol, gene, source from a list with or without a header, of two or three columns."""
    parts = F.split(F.col("value"), r"[\t,]")
    raw = spark.read.text(path).filter(F.trim("value") != "")
    third = F.when(F.size(parts) > 2, F.trim(F.get(parts, 2))).otherwise("primary")
    return raw.filter(~F.lower("value").rlike("^symbol")).select(F.trim(parts[0]).alias("symbol"), F.trim(F.get(parts, 1)).alias("gene"), third.alias("source"))


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """gene: distinct trimmed lines without comments."""
    return spark.read.text(path).select(F.trim(F.split("value", "#")[0]).alias("gene")).filter("gene <> ''").distinct()


def write_table(df: DataFrame, path: str, sep: str = "\t") -> None:
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def write_lists(df: DataFrame, path: str, by: list[str], gene: str = "gene") -> None:
    """One folder of plain lists for each value of the columns; values without genes get none."""
    df.select(*by, F.col(gene).cast("string").alias("gene")).distinct().write.mode("overwrite").partitionBy(*by).text(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_venn(parts: DataFrame, path: str) -> None:
    """Lists of venn() (gene, part): one folder for each part that has genes."""
    write_lists(parts, path, ["part"])


def write_cluster_pairs(wt: DataFrame, mut: DataFrame, pairs: DataFrame, path: str) -> None:
    """Five lists for each pair of clusters (wt, mut): genes of either (gene, cluster), common ones and those of one side, in folders pair=, list=."""
    a = pairs.select("wt", "mut").join(wt.select(F.col("cluster").alias("wt"), "gene"), "wt").withColumn("a_", F.lit(True)).distinct()
    b = pairs.select("wt", "mut").join(mut.select(F.col("cluster").alias("mut"), "gene"), "mut").withColumn("b_", F.lit(True)).distinct()
    both = a.join(b, ["wt", "mut", "gene"], "full")
    here, there = F.coalesce("a_", F.lit(False)), F.coalesce("b_", F.lit(False))
    kinds = [("WT_ClusterGenes", here), ("MUT_ClusterGenes", there), ("Intersection_Genes", here & there), ("WT_Only_Genes", here & ~there), ("MUT_Only_Genes", ~here & there)]
    lists = both.select(F.format_string("WT_C%02d_MUT_C%02d", "wt", "mut").alias("pair"), "gene", F.explode(F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in kinds]), lambda x: x.isNotNull())).alias("list"))
    write_lists(lists, path, ["pair", "list"])


def write_fates(fates: DataFrame, path: str, cutoff: float = 0.5) -> None:
    """Core genes of each sub-cluster with its fate (wt_cluster, sub_cluster, label, gene, membership), in folders cluster=, list=."""
    core = fates.filter(F.col("membership") >= cutoff)
    write_lists(core.select(F.format_string("WT_C%02d", "wt_cluster").alias("cluster"), F.format_string("SubCluster_%d_%s_Genes", "sub_cluster", "label").alias("list"), "gene"), path, ["cluster", "list"])


def write_network(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """Node and edge tables of a network program, as CSV in two folders."""
    write_table(nodes, f"{path}/nodes", ",")
    write_table(edges, f"{path}/edges", ",")
