"""Token counts by a digest cache."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, new_path, rows, table
from .tokens import encoder, tokenizer_version

CACHE = "content string, tokenizer string, n_tokens long"


def as_given(text: Column) -> Column:
    """The normal form of content that keeps every count as it is: null becomes the empty text."""
    return F.coalesce(text, F.lit(""))


def open_cache(spark: SparkSession, path: str) -> DataFrame:
    """The stored counts at path; a cache that does not exist yet is written empty."""
    spark.createDataFrame([], CACHE).write.mode("append").parquet(path)
    return spark.read.schema(CACHE).parquet(path)


def _encode(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = encoder(path).ids
        for b in rows(batches):
            counts = [len(ids(t)) for t in b.column("text").to_pylist()]
            yield pa.record_batch([b.column("content"), b.column("tokenizer"), pa.array(counts, pa.int64())], names=["content", "tokenizer", "n_tokens"])

    return run


def count_tokens(docs: DataFrame, tokenizer: str, cache: str, normalise: Callable[[Column], Column] = as_given) -> DataFrame:
    """docs with n_tokens: the number of ids of each whole text under the tokenizer file.

    The cache is a Parquet table of counts by digest of the normalised content and digest of the
    tokenizer's file and library. Only distinct contents that it lacks are encoded, once each, and
    appended before they are joined; equal texts in any number cost one encoding. A null text counts
    as the empty one; a column n_tokens of docs is replaced; two runs that append at the same
    time may both store a content, which the join collapses.
    """
    spark, version = docs.sparkSession, tokenizer_version(tokenizer)
    text = normalise(F.col("text"))
    digest = F.sha2(F.encode(text, "UTF-8"), 256)
    stored = open_cache(spark, cache).filter(F.col("tokenizer") == version)
    misses = (
        docs.select(digest.alias("content"), F.lit(version).alias("tokenizer"), text.alias("text"))
        .groupBy("content", "tokenizer")
        .agg(F.first("text").alias("text"))
        .join(stored, ["content", "tokenizer"], "left_anti")
    )
    misses.mapInArrow(_encode(tokenizer), CACHE).write.mode("append").parquet(cache)
    counts = open_cache(spark, cache).filter(F.col("tokenizer") == version).groupBy("content").agg(F.first("n_tokens").alias("n_tokens"))
    own = docs.drop("n_tokens")
    (content,) = fresh(own, "content")
    return own.withColumn(content, digest).join(counts.withColumnRenamed("content", content), content).drop(content)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens under byte_bpe_50k.json, by a cache of its own that starts empty."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    slim = docs.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    counted = count_tokens(slim, public_tokenizers.path("byte_bpe_50k.json"), new_path(spark, "token-cache"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))
