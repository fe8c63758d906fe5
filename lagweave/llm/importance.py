"""Importance resampling towards a target's distribution of hashed features."""

from __future__ import annotations

from math import floor, log

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

BUCKETS, RUNS, LEAST_WORDS, PERCENT, SEED = 10_000, 1, 20, 10, 2024
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERMS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; none where it is null."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), F.lit(TERMS), F.lit(0))


def bucket_array(text: Column, runs: int = RUNS, buckets: int = BUCKETS) -> Column:
    """The bucket of each run of 1 to `runs` words of a text, repeats kept: an array expression, without a row for each run."""
    own = words(text)
    of = lambda x: (F.crc32(F.encode(x, "UTF-8")) % buckets).cast("int")
    parts = [F.transform(own, of)]
    for k in range(2, runs + 1):
        at = F.when(F.size(own) >= k, F.sequence(F.lit(1), F.size(own) - (k - 1))).otherwise(F.array().cast("array<int>"))
        run = F.transform(at, lambda i: F.array_join(F.slice(own, i, k), " "))  # noqa: B023 (called at once)
        parts.append(F.transform(run, of))
    return parts[0] if runs == 1 else F.concat(*parts)


def totals(hashed: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket. Tasks add up their own rows first, so that at most `buckets` totals of each are shuffled and `buckets` rows reach the driver."""
    out = np.zeros(buckets, object)
    for r in hashed.select(F.explode("hashed").alias("bucket")).groupBy("bucket").count().collect():
        out[r.bucket] = r["count"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> list[int]:
    """floor(1000 ln) of the ratio of a bucket's smoothed shares in the target and in the corpus."""
    n, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    return [floor(1000 * log((int(t) + 1) * (s_all + n) / ((int(s) + 1) * (t_all + n)))) for s, t in zip(corpus, target, strict=True)]


def scored(hashed: DataFrame, gain: list[int], seed: int = SEED) -> DataFrame:
    """hashed with n_features, weight (floored mean gain of the features, 0 without any) and score (weight and a Gumbel number drawn by the document's id)."""
    literal = F.split(F.lit(",".join(map(str, gain))), ",").cast("array<long>")  # folded to one literal array
    sum_ = F.aggregate("hashed", F.lit(0).cast("long"), lambda a, b: a + F.element_at(literal, b + 1))
    out = hashed.withColumn("n_features", F.size("hashed").cast("long")).withColumn("sum_", sum_)
    out = out.withColumn("weight", F.when(F.col("n_features") > 0, F.expr("(sum_ - pmod(sum_, n_features)) div n_features")).otherwise(F.lit(0).cast("long")))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return out.withColumn("score", (F.col("weight") + noise).cast("long")).drop("sum_", "hashed")


def ranked(rows: DataFrame, draws: int) -> DataFrame:
    """rows (doc_id, score, eligible, ...) with rank: 1 to `draws` over the eligible rows by falling score and rising doc_id (null last), null elsewhere.

    A score is a whole number of thousandths of a logarithm, of which there are some hundred thousand at most whatever the corpus, so the least drawn score
    comes from their counts. Rows from it on are dealt by ranges of (score, doc_id), and numbered by what stands before their range and their place in it;
    equal rows, which no order tells apart, are spread by a random number. No window holds a group, and no row is joined."""
    counts = sorted(((r.score, r["count"]) for r in rows.filter("eligible").groupBy("score").count().collect()), reverse=True)
    least, have = None, 0
    for s, n in counts:
        if have >= draws:
            break
        least, have = s, have + n
    plain = rows.withColumn("rank", F.lit(None).cast("long"))
    if least is None:
        return plain
    inside = F.col("eligible") & (F.col("score") >= least)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    spread = rows.filter(inside).withColumn("spread", F.xxhash64(*rows.columns))
    dealt = spread.repartitionByRange(*order, "spread").sortWithinPartitions(*order, "spread").withColumn("at", F.monotonically_increasing_id()).drop("spread")
    dealt = stored(dealt, "drawn")
    part = F.shiftright("at", 33)
    before, offsets = 0, []
    for p, n in sorted((r.part, r["count"]) for r in dealt.groupBy(part.alias("part")).count().collect()):
        offsets.append((p, before))
        before += n
    offset = rows.sparkSession.createDataFrame(offsets, "part long, before long")  # a row for each partition
    place = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    drawn = dealt.withColumn("part", part).join(F.broadcast(offset), "part").withColumn("rank", F.when(place <= draws, place)).drop("part", "before", "at")
    return plain.filter(~inside).unionByName(drawn)


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, runs: int = RUNS, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, and rank among the drawn documents (null if not drawn).

    docs has doc_id and text, target has text; other columns are ignored, whatever their names. The bucket array of every whole text is made once by higher-order
    functions and stored; the corpus' and the target's totals by bucket are the only numbers that are shuffled, and a document is scored by looking its
    buckets up in a literal array of `buckets` gains. A null or empty text has no features and weight 0. A null doc_id draws as the empty id.
    Repeated rows are scored and drawn each for itself. Of no documents, or an empty target, nothing and the corpus' own counts decide. A very long text needs
    room for its array of buckets in a task."""
    hashed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.size(words(F.col("text"))).alias("n_words") if runs > 1 else F.lit(0).alias("n_words"), bucket_array(F.col("text"), runs, buckets).alias("hashed"))
    hashed = stored(hashed, "buckets")
    gain = gains(totals(hashed, buckets), totals(target.select(bucket_array(F.col("text"), runs, buckets).alias("hashed")), buckets))
    n_words = F.col("n_words") if runs > 1 else F.col("n_features")
    rows = stored(scored(hashed, gain, seed).withColumn("eligible", n_words >= least_words).drop("n_words"), "scored")
    draws = percent * rows.filter("eligible").count() // 100
    return ranked(rows, draws).select("doc_id", "n_features", "weight", "score", "rank")


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents of twenty words or more, drawn towards the benchmark's words."""
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
