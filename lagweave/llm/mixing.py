"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import fresh, stored, table

WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2.0
#: Words of a block and blocks of a shard, on average, at most: what a task handles, at any size.
BLOCK_WORDS, SHARD_BLOCKS = 1 << 16, 64
#: Shards at least, and blocks of each, on average; blocks below the most words shrink until there are so many, down to the least words.
LEAST_SHARDS, LEAST_BLOCKS, LEAST_WORDS = 64, 16, 128
#: Blocks that are summed up before sums over all blocks of a source are taken; shards of a task.
GROUPED, SHARDS_OF_TASK = 1024, 8


def word_count(text):
    """Words of a text, native: every maximal run of other characters than the six spaces."""
    squeezed = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[ \x09-\x0D]+", " "))
    return F.when(squeezed == "", 0).otherwise(F.length(squeezed) - F.length(F.replace(squeezed, F.lit(" "))) + 1).cast("long")


def targets(sizes: list[int], weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> list[float]:
    """Targets of sources of these sizes: share * sum(sizes) split by weight (repeating), none above most * its size.

    What stops at its ceiling leaves its excess to the others by weight, until none is above."""
    weight = [weights[k % len(weights)] for k in range(len(sizes))]
    left, open_, out = share * sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    while open_:
        total = sum(weight[k] for k in open_)
        over = {k for k in open_ if left * weight[k] / total >= most * sizes[k]}
        if not over:
            for k in open_:
                out[k] = left * weight[k] / total
            break
        for k in over:
            out[k] = most * sizes[k]
            left -= out[k]
        open_ -= over
    return out


def quotas(blocks: np.ndarray, shards: int, shard: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(blocks of each source that lie before the shard, blocks of each source in it).

    The tree halves the range of shards from the root; at each node the left half gets its share of all
    blocks by a draw from the multivariate hypergeometric distribution of the node's quotas, the right
    half the rest. A node's draw depends on seed and node alone, so that each shard walks its own path and all
    paths agree: the leaves' quotas add up to `blocks` exactly."""
    low, high, have, before = 0, shards, blocks.astype(np.int64), np.zeros(len(blocks), np.int64)
    while high - low > 1:
        mid = (low + high) // 2
        take = round(int(have.sum()) * (mid - low) / (high - low))
        draw = np.random.default_rng([seed, low, high])
        left = np.zeros_like(have)
        rest = int(have.sum())
        for k, n in enumerate(have.tolist()):
            rest -= n
            left[k] = got = int(draw.hypergeometric(n, rest, take)) if n and take and rest else min(n, take)
            take -= got
        if shard < mid:
            high, have = mid, left
        else:
            low, before, have = mid, before + left, have - left
    return before, have


def grain(words: float) -> int:
    """Words of a block for a mix of so many words: BLOCK_WORDS, or fewer, so that LEAST_SHARDS shards have LEAST_BLOCKS blocks each."""
    return min(BLOCK_WORDS, max(LEAST_WORDS, int(words) // (LEAST_SHARDS * LEAST_BLOCKS)))


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word, native; whatever characters it holds, they stay."""
    words = F.filter(F.split(text, r"[ \x09-\x0D]+"), lambda w: w != "")
    gaps = F.split(text, r"[^ \x09-\x0D]+")
    total = lambda parts: F.aggregate(F.slice(parts, F.lit(1), n.cast("int")), F.lit(0), lambda have, x: have + F.length(x))
    return F.substring(text, F.lit(1), total(words) + total(gaps))


def _before(blocks: DataFrame, value: str, keys: list[str], group: Column, order: list[str]) -> DataFrame:
    """blocks with `before`: the sum of value over the rows of the same keys that come earlier, by group, then by order.

    Sums of groups come first, so that no task sorts all rows of a key."""
    grouped = blocks.withColumn("grouped", group)
    sums = grouped.groupBy(*keys, "grouped").agg(F.sum(value).alias("s"))
    earlier = sums.withColumn("earlier", F.sum("s").over(W.partitionBy(*keys).orderBy("grouped")) - F.col("s")).drop("s")
    inside = F.sum(value).over(W.partitionBy(*keys, "grouped").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)) - F.col(value)
    return grouped.join(earlier, [*keys, "grouped"]).withColumn("before", F.col("earlier") + inside).drop("earlier", "grouped")


def mix(docs: DataFrame, seed: int = 17, shards: int | None = None, size: Column | None = None) -> tuple[DataFrame, DataFrame, int]:
    """(draws, plan, number of shards) for docs with doc_id, source, text; size: their words, if a column has them.

    plan: row_id, doc_id, source_no, size, source_size, target, taken, shards, places, one row for each row of docs.
    draws: row_id, lap, shard, place, words: a row for each time that a document enters the mix; words is what
    it gives (less than its size only for the one document where a source reaches its target), and
    place its order after the local shuffle of its shard; shards and places of the plan are those of a document's draws. row_id is docs' own column of that name if it
    has one, else a number given here.

    Every source is permuted by a keyed hash of its rows (id, source and whole text) and cut by that hash into blocks of about grain() words; the target is reached by
    whole passes over the source and the first blocks of one more permutation, so a document gives at most
    twice its size. Block counts go to shards by quotas(). Sources are a table of a few numbers each, which the
    driver reads; documents, blocks and draws never leave the executors, and a hot source only has more blocks.
    Null sources are one source, after all others; a null or wordless text has size 0 and is taken 0 words. A very long text is
    one draw like any other. Repeated rows are mixed each for itself, in the same block; equal ones may exchange their parts, nothing else differs
    between runs. An empty table gives empty results.
    """
    spark = docs.sparkSession
    row_id = F.col("row_id") if "row_id" in docs.columns else F.monotonically_increasing_id()
    text = F.coalesce("text", F.lit(""))
    content = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("source", F.lit("")), text)
    hashed = lambda salt: F.pmod(F.xxhash64(F.lit(seed), F.lit(salt), "content"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    read = docs.select(row_id.alias("row_id"), "doc_id", "source", (word_count(F.col("text")) if size is None else size).alias("size"), content.alias("content"))
    slim = stored(read.withColumns({"h1": hashed(1), "h2": hashed(2)}), "mix-sizes")
    found = slim.groupBy("source").agg(F.sum("size").alias("n")).collect()
    found = sorted((r for r in found if r.source is not None), key=lambda r: [ord(c) for c in r.source]) + [r for r in found if r.source is None]
    goal = targets([r.n for r in found])
    block_words = grain(sum(goal))
    table_ = [(r.source, r.n, t, -(-max(1, r.n) // block_words), k) for k, (r, t) in enumerate(zip(found, goal, strict=True))]
    sources = spark.createDataFrame(table_, "source string, source_size long, target double, blocks long, source_no int")
    # two passes over each source at most, the second by another permutation
    seen = slim.join(sources, slim.source.eqNullSafe(sources.source)).drop(sources.source)
    passes = seen.select("*", F.explode(F.array([F.struct(F.lit(k).alias("lap"), F.col(h).alias("h")) for k, h in enumerate(("h1", "h2"))])).alias("x"))
    laps = passes.select("row_id", "size", "source_no", "x.lap", "x.h", F.floor(F.col("x.h") * F.col("blocks")).alias("block"), F.greatest(F.lit(0), F.round(F.col("target")).cast("long") - F.col("x.lap") * F.col("source_size")).alias("quota"))
    sums = stored(laps.filter("size > 0").groupBy("source_no", "lap", "block").agg(F.sum("size").alias("n"), F.first("quota").alias("quota")), "mix-sums")
    before = _before(sums, "n", ["source_no", "lap"], F.floor(F.col("block") / GROUPED), ["block"])
    blocks = stored(before.filter("before < quota").select("source_no", "lap", "block", "before"), "mix-blocks")
    counts = {r.source_no: r["count"] for r in blocks.groupBy("source_no").count().collect()}
    have = np.array([counts.get(k, 0) for k in range(len(found))], np.int64)
    n_shards = shards or max(-(-max(1, int(have.sum())) // SHARD_BLOCKS), min(LEAST_SHARDS, int(have.sum()) // LEAST_BLOCKS))

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for shard in pdf["id"]:
                first, n = quotas(have, n_shards, int(shard), seed)
                out = [(k, a + i) for k, (a, m) in enumerate(zip(first.tolist(), n.tolist(), strict=True)) for i in range(m)]
                yield pd.DataFrame(out, columns=["source_no", "drawn"]).assign(shard=int(shard))

    drawn = spark.range(n_shards).mapInPandas(walk, "source_no int, drawn long, shard long")
    # the block that a source gives as its i-th: a permutation of 0 .. have - 1 by a hash
    groups = spark.createDataFrame([(k, -(-max(1, int(n)) // GROUPED)) for k, n in enumerate(have)], "source_no int, groups long")
    keyed = blocks.join(F.broadcast(groups), "source_no").withColumns({"key": F.xxhash64(F.lit(seed), F.lit(3), "lap", "block"), "one": F.lit(1).cast("long")})
    part = F.floor(F.pmod("key", F.lit(1 << 40)) / F.lit(float(1 << 40)) * F.col("groups"))
    order = _before(keyed.withColumnRenamed("before", "words_before"), "one", ["source_no"], part, ["key", "lap", "block"]).withColumnsRenamed({"before": "drawn", "words_before": "before"})
    placed = order.join(drawn, ["source_no", "drawn"]).select("source_no", "lap", "block", "before", "shard")
    inside = laps.filter("size > 0").join(placed, ["source_no", "lap", "block"])
    running = F.sum("size").over(W.partitionBy("source_no", "lap", "block").orderBy("h", "row_id").rowsBetween(W.unboundedPreceding, 0)) - F.col("size") + F.col("before")
    words = F.least(F.col("size"), F.col("quota") - running)
    draws = inside.withColumn("words", words).filter("words > 0").withColumn("place", F.xxhash64(F.lit(seed), F.lit(4), "lap", "row_id"))
    draws = draws.select("row_id", "lap", "shard", "place", "words")
    each = F.array_sort(F.collect_list(F.struct("lap", "shard", "place")))
    taken = draws.groupBy("row_id").agg(F.sum("words").alias("taken"), each.alias("each"))
    plan = seen.select("row_id", "doc_id", "source_no", "size", "source_size", "target").join(taken, "row_id", "left").fillna(0, ["taken"])
    return draws, plan.withColumns({"shards": F.col("each.shard"), "places": F.col("each.place")}).drop("each"), n_shards


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: docs' columns, a row for each draw, dealt by shards and in the shards' local order.

    The one document where a source reaches its target keeps only the words that it gives. docs is read once, numbered, and
    written to the shared folder; draws and texts both come from there, so docs may give its rows in any order."""
    row_id, size, shard, place, words = fresh(docs, "row_id", "size", "shard", "place", "words")
    rows_ = stored(docs.withColumns({row_id: F.monotonically_increasing_id(), size: word_count(F.col("text"))}), "mix-docs")
    draws, _, n_shards = mix(rows_.select(F.col(row_id).alias("row_id"), "doc_id", "source", "text", F.col(size).alias("words")), size=F.col("words"), **options)
    draws = draws.select(F.col("row_id").alias(row_id), F.col("shard").alias(shard), F.col("place").alias(place), F.col("words").alias(words))
    both = rows_.join(draws, row_id)
    cut = both.withColumn("text", F.when(F.col(words) < F.col(size), first_words(F.col("text"), F.col(words))).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast("long"))
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n_shards // SHARDS_OF_TASK))
    ranges = F.floor(F.col(shard) * tasks / n_shards).cast("int")  # shards in a row, as many for each task
    return cut.repartitionById(tasks, ranges).sortWithinPartitions(shard, place, row_id).select(*docs.columns)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, plan, _ = mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return plan.select("doc_id", "size", "source_size", "target", "taken", "shards", "places")
