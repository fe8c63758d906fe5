"""Approximate nearest neighbours by additive quantisation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import rows, stored, table

#: Codebooks, codewords of each, width of the beam, vectors that fit the codebooks (a documented bound), Lloyd rounds of each.
BOOKS, WORDS, BEAM, SAMPLE, ROUNDS = 32, 256, 4, 16_384, 8
#: Vectors of an index block and components of it, at most; index blocks that a task holds together, and queries of a block.
BLOCK, COMPONENTS, TOGETHER, QUERIES = 4096, 1 << 18, 16, 512
#: Candidates of a query in the index blocks of a task whose exact scores set the limit for all others; vectors that are scored exactly at a time.
RERANK, EXACT = 256, 16_384
#: Slack of the limit, above what rounding can do to an angle; the same for a plain inner product; decoded vectors shorter than this bound nothing.
SLACK, ROUNDING, SHORT = 1e-7, 1e-9, 1e-3


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled by powers of two first, so that no square leaves the range of doubles."""
    x = x / 2.0 ** np.floor(np.log2(np.abs(x).max(axis=1, keepdims=True)))
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _nearest(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    x, words = x.astype(np.float32), words.astype(np.float32)
    return np.argmin((words * words).sum(1) - x @ (2 * words.T), axis=1)


def fit(sample: np.ndarray, books: int = BOOKS, words: int = WORDS, seed: int = 5) -> np.ndarray:
    """books x words x dim codewords over the full dimension: k-means of the residuals, one book after the other."""
    draw, residual, out = np.random.default_rng(seed), sample.astype(np.float64), []
    words = min(words, len(sample))
    for _ in range(books):
        book = residual[draw.choice(len(residual), words, replace=False)].copy()
        for _ in range(ROUNDS):
            at = _nearest(residual, book)
            n = np.bincount(at, minlength=words)
            used = np.flatnonzero(n)
            starts = np.concatenate([[0], np.cumsum(n[used])[:-1]])
            book = residual[draw.integers(0, len(residual), words)]
            book[used] = np.add.reduceat(residual[np.argsort(at, kind="stable")], starts, axis=0) / n[used, None]
        out.append(book)
        residual = residual - book[_nearest(residual, book)]
    return np.stack(out)


def encode(x: np.ndarray, books: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, squared norms of the decoded vectors, their inner products with x): beam search over the books for the sum of codewords next to each row of x.

    The beam is searched in single precision, norms and products are those of the codes chosen, in double precision."""
    n, (_, k, dim) = len(x), books.shape
    residual, codes, row = x.astype(np.float32)[:, None], np.zeros((n, 1, 0), np.int64), np.arange(n)
    for book in books.astype(np.float32):
        # |r - c|^2 = |r|^2 + |c|^2 - 2 r.c for what is left of a row and the next book's codeword c
        grown = (residual.reshape(-1, dim) @ (-2 * book.T)).reshape(n, -1, k)
        grown += (book * book).sum(1)
        grown += (residual * residual).sum(axis=2, keepdims=True)
        grown, best = grown.reshape(n, -1), []
        for _ in range(min(beam, grown.shape[1])):
            best.append(np.argmin(grown, axis=1))
            grown[row, best[-1]] = np.inf
        source, word = np.divmod(np.stack(best, axis=1), k)
        codes = np.concatenate([codes[row[:, None], source], word[:, :, None]], axis=2)
        residual = residual[row[:, None], source] - book[word]
    codes = codes[row, np.argmin((residual * residual).sum(axis=2), axis=1)]
    decoded = np.zeros((n, dim))
    for book, word in zip(books, codes.T, strict=True):
        decoded += book[word]
    return codes.astype(np.uint8 if k <= 256 else np.int32), (decoded**2).sum(axis=1), (decoded * x).sum(axis=1)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id long, v array<double>: the vectors that take part.

    Left out are a null id, a null or zero vector, one with null or non-finite components, and one
    whose length is not that of most vectors. Of several vectors with one id the least takes part."""
    v = F.transform(F.col("embedding"), lambda x: x.cast("double"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    some = some.filter(~bad & F.exists("v", lambda x: x != 0.0)).groupBy("vec_id").agg(F.min("v").alias("v"))
    sizes = some.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1)
    return some.join(sizes.select("dim"), F.size("v") == F.col("dim")).drop("dim")


def _packed(x: np.ndarray) -> bytes:
    """As single floats where that loses nothing."""
    with np.errstate(over="ignore"):
        single = x.astype("<f4")
    return (single if np.array_equal(single, x) else x.astype("<f8")).tobytes()


def _unpacked(raw: bytes, dim: int, n: int) -> np.ndarray:
    return np.frombuffer(raw, f"<f{len(raw) // (n * dim)}").reshape(n, dim).astype(np.float64)


def _blocks(vectors: DataFrame, count: int) -> DataFrame:
    """block long, ids binary, vectors binary; the vectors in `count` blocks, dealt by a hash of their ids, in the order of the ids."""
    dealt = vectors.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(count)))

    def gather(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("vec_id")
        return pd.DataFrame({"block": [int(group["block"].iloc[0])], "ids": [group["vec_id"].to_numpy("<i8").tobytes()], "vectors": [_packed(np.stack(group["v"].to_numpy()))]})

    return dealt.groupBy("block").applyInPandas(gather, "block long, ids binary, vectors binary")


def _best(near: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the n largest scores, even ones by smaller ids."""
    if len(near) <= n:
        return np.arange(len(near))
    least = np.partition(near, len(near) - n)[len(near) - n]
    sure, even = np.flatnonzero(near > least), np.flatnonzero(near == least)
    return np.concatenate([sure, even[np.argsort(ids[even], kind="stable")][: n - len(sure)]])


def _nearest_exactly(x: np.ndarray, ids: np.ndarray, q: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, scores) of the k rows of x[at] with the largest inner products with q, ties to the smaller id; equal rows score equally."""
    if len(at) > k:
        rough = (x @ q)[at] if 4 * len(at) > len(x) else np.concatenate([x[at[i : i + EXACT]] @ q for i in range(0, len(at), EXACT)])
        at = at[rough >= np.partition(rough, len(at) - k)[len(at) - k] - ROUNDING]
    scores = np.concatenate([(x[at[i : i + EXACT]] * q).sum(axis=1) for i in range(0, len(at), EXACT)] or [np.zeros(0)]) + 0.0
    best = np.lexsort((ids[at], -scores))[:k]
    return at[best], scores[best]


class _Slice:
    """Index blocks that a task holds together: unit vectors, codes by book, and what bounds a vector's score from its code.

    With d the decoded vector's direction, `cosine` and `sine` are those of the angle between d and the vector; a vector whose
    code says nothing, because the decoded one is next to zero, has 0 and 1."""

    def __init__(self, blocks: list[dict], books: np.ndarray):
        m, words, dim = books.shape
        self.books, self.ids = books, np.concatenate([np.frombuffer(r["ids"], "<i8") for r in blocks])
        self.x = np.concatenate([unit(_unpacked(r["vectors"], dim, len(r["ids"]) // 8)) for r in blocks])
        codes = [np.frombuffer(r["codes"], "<u1" if words <= 256 else "<i4").reshape(-1, m) for r in blocks]
        self.codes = np.ascontiguousarray(np.concatenate(codes).T, np.intp)
        length = np.sqrt(np.concatenate([np.frombuffer(r["norms"], "<f8") for r in blocks]))
        self.inverse = np.where(length < SHORT, 0.0, 1 / np.maximum(length, SHORT))
        self.cosine = np.clip(np.concatenate([np.frombuffer(r["products"], "<f8") for r in blocks]) * self.inverse, -1, 1)
        self.sine = np.sqrt(1 - self.cosine**2)

    def nearest(self, query_id: int, q: np.ndarray, k: int, rerank: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores) of the k vectors that are truly nearest to the unit vector q, without the one of that id."""
        lookup = self.books @ q
        near = lookup[0][self.codes[0]]
        for table_, codes in zip(lookup[1:], self.codes[1:], strict=True):
            near += table_[codes]
        near *= self.inverse
        near[self.ids == query_id] = -np.inf
        first = _best(near, self.ids, rerank)
        first = first[near[first] > -np.inf]
        at, scores = _nearest_exactly(self.x, self.ids, q, first, k)
        if len(first) < rerank or not len(scores):
            return at, scores  # these were all
        # A vector scores t or more only if it lies within arccos(t) of q, so that d lies within that and the angle between both.
        t = float(np.clip(scores[-1], -1, 1)) if len(scores) == k else -1.0
        least = np.where(self.cosine <= -t, -2.0, self.cosine * t - self.sine * np.sqrt(1 - t * t) - SLACK)
        return _nearest_exactly(self.x, self.ids, q, np.union1d(first, np.flatnonzero(near >= least)), k)


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, rerank: int = RERANK) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of each query by cosine, ties to the smaller id, without itself.

    vectors and queries are usable() tables. The codebooks are fitted to at most SAMPLE unit vectors, those with the
    least hashes of their ids. Every vector is encoded; the index, by blocks of ids, vectors, codes, norms of the decoded vectors and their
    products with the vectors, is written to the shared folder. TOGETHER index blocks make a slice, which a task holds while blocks of queries pass: tables of inner
    products with all codewords score the slice's codes, the `rerank` best are scored exactly in double precision, and the k-th of these scores is the limit for the others: every vector
    whose code does not rule out that it reaches the limit is scored exactly too. So the k of a slice are its true ones on any vectors, codes that tell little cost time only, and
    k rows of a query leave a slice. Queries are split into groups only where there are fewer slices than tasks, so that large indexes move once.
    Fewer candidates than k give fewer rows; no vectors give none. Equal vectors get equal scores.
    """
    spark = vectors.sparkSession
    vectors, queries = stored(vectors, "ann-vectors"), stored(queries, "ann-queries")
    n, n_queries = vectors.count(), queries.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if not n or not n_queries:
        return spark.createDataFrame([], schema)
    key = F.pmod(F.xxhash64("vec_id", F.lit(9)), F.lit(1 << 40))
    few = vectors.filter(key < int(min(1.0, 2 * SAMPLE / n) * (1 << 40)) + 1) if n > 4 * SAMPLE else vectors
    sample = np.array([r.v for r in few.orderBy(key, "vec_id").limit(SAMPLE).select("v").collect()], np.float64)
    books = fit(unit(sample))
    size = max(1, min(BLOCK, COMPONENTS // books.shape[2]))

    def add_codes(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows(group):
            codes, norms, products = [], [], []
            for ids, raw in zip(b.column("ids").to_pylist(), b.column("vectors").to_pylist(), strict=True):
                x = unit(_unpacked(raw, books.shape[2], len(ids) // 8))
                parts = [encode(x[at : at + 512], books) for at in range(0, len(x), 512)]
                codes.append(np.concatenate([p[0] for p in parts]).astype("<u1" if books.shape[1] <= 256 else "<i4").tobytes())
                norms.append(np.concatenate([p[1] for p in parts]).astype("<f8").tobytes())
                products.append(np.concatenate([p[2] for p in parts]).astype("<f8").tobytes())
            added = [pa.array(c, pa.binary()) for c in (codes, norms, products)]
            yield pa.record_batch([b.column("block"), b.column("ids"), b.column("vectors"), *added], names=["block", "ids", "vectors", "codes", "norms", "products"])

    index = stored(_blocks(vectors, -(-n // size)).mapInArrow(add_codes, "block long, ids binary, vectors binary, codes binary, norms binary, products binary"), "ann-index")
    n_asked, n_slices = -(-n_queries // QUERIES), -(-n // (size * TOGETHER))
    at_once = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_groups = max(1, min(n_asked, -(-at_once // n_slices)))
    each = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))
    held = index.withColumns({"slice": F.pmod("block", F.lit(n_slices)), "asked": F.lit(False), "group": each(n_groups)})
    asked = _blocks(queries, n_asked).withColumns({"group": F.pmod("block", F.lit(n_groups)), "asked": F.lit(True), "slice": each(n_slices)})
    met = held.unionByName(asked, allowMissingColumns=True).repartition(max(at_once, n_groups * n_slices), "group", "slice").sortWithinPartitions("group", "slice", "asked", "block")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, blocks, together = None, [], None
        for b in rows(batches):
            for row in b.to_pylist():
                if own != (row["group"], row["slice"]):
                    own, blocks, together = (row["group"], row["slice"]), [], None
                if not row["asked"]:
                    blocks.append(row)
                    continue
                if together is None and blocks:
                    together, blocks = _Slice(blocks, books), []
                if together is None:
                    continue
                q_ids = np.frombuffer(row["ids"], "<i8")
                q = unit(_unpacked(row["vectors"], books.shape[2], len(q_ids)))
                found = [together.nearest(query_id, one, k, rerank) for query_id, one in zip(q_ids.tolist(), q, strict=True)]
                columns = [np.repeat(q_ids, [len(at) for at, _ in found]), together.ids[np.concatenate([at for at, _ in found])], np.concatenate([s for _, s in found])]
                yield pa.record_batch([pa.array(c.astype(t)) for c, t in zip(columns, (np.int64, np.int64, np.float64), strict=True)], names=["query_id", "vec_id", "score"])

    found = met.mapInArrow(score, "query_id long, vec_id long, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op1_additive_quantisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = usable(table(spark, sf_dir, "embeddings"))
    return search(vectors, vectors.filter(F.col("vec_id") % 50 == 0))
