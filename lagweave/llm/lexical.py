"""Ranked lexical search by three phases over posting lists: list heads, one threshold for all lists, exact look-ups."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import rows, stored, table

TOP = 10
#: Bytes of query texts that one pass over the documents answers; more queries take more passes.
PASS_BYTES = 64 << 20

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_BLOCK = "block long, n_docs long, n_terms long, doc_ids array<long>, lengths array<long>, terms array<int>, sizes array<int>, at array<int>, tf array<int>"


def terms_of(text: str | None) -> list[str]:
    """All terms of a text in order, A-Z lower-cased."""
    return _TERM.findall((text or "").translate(_LOWER))


def _post(number):
    """Blocks of documents as posting lists of the terms in `number`, in order of terms; at[k] is a document's place in its block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), 0
        for b in rows(batches):
            ids, lengths, lists = [], [], {}
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                found = terms_of(text)
                for term, n in Counter(found).items():
                    k = number.value.get(term)
                    if k is not None:
                        lists.setdefault(k, []).append((len(ids), n))
                ids.append(doc_id), lengths.append(len(found))
            names = sorted(lists)
            flat = [p for k in names for p in lists[k]]
            one = lambda x, kind: pa.array([x], kind)
            i64, i32 = pa.list_(pa.int64()), pa.list_(pa.int32())
            yield pa.record_batch(
                [one((task << 20) + seen, pa.int64()), one(sum(n > 0 for n in lengths), pa.int64()), one(sum(lengths), pa.int64()), one(ids, i64), one(lengths, i64),
                 one(names, i32), one([len(lists[k]) for k in names], i32), one([p for p, _ in flat], i32), one([n for _, n in flat], i32)],
                names=[x.split()[0] for x in _BLOCK.split(", ")],
            )
            seen += 1

    return run


class Lists:
    """The posting lists of one block: contribution of each posting, and where each term's list lies."""

    def __init__(self, row: dict, weight: np.ndarray, n_docs: int, n_terms: int) -> None:
        self.block, self.ids = row["block"], row["doc_ids"]
        sizes = np.asarray(row["sizes"], np.int64)
        self.terms, self.first = np.asarray(row["terms"], np.int64), np.concatenate([[0], np.cumsum(sizes)])
        self.at, tf = np.asarray(row["at"], np.int64), np.asarray(row["tf"], np.int64)
        m = 10 + (90 * np.asarray(row["lengths"], np.int64) * n_docs) // max(1, n_terms)
        self.part = np.repeat(weight[self.terms], sizes) * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[self.at])) if len(tf) else np.zeros(0, np.int64)
        self.place = {t: k for k, t in enumerate(self.terms.tolist())}
        self.best = np.maximum.reduceat(self.part, self.first[:-1]) if len(tf) else np.zeros(0, np.int64)

    def heads(self, top: int) -> Iterator[tuple[int, int, int]]:
        """(term, key of a document, contribution) of the first `top` of each list."""
        for t, k in self.place.items():
            a, b = self.first[k], self.first[k + 1]
            part = self.part[a:b]
            these = np.argpartition(-part, top - 1)[:top] if b - a > top else np.arange(b - a)
            for i in these.tolist():
                yield t, (self.block << 22) + int(self.at[a + i]), int(part[i])

    def search(self, terms: list[int], least: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, exact scores) of all documents that can reach the score `least`, which is above 0.

        Every list gives its postings of least / (number of lists) or more: a document without any of them stays below least. What is
        fetched, and for each other list the most that an unfetched posting can add, bounds a document from above; the rest is looked up in all lists."""
        lists = [self.place[t] for t in terms if t in self.place]
        if not lists:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        cut = -(-least // len(lists))
        sure, slack = np.zeros(len(self.ids), np.int64), np.zeros(len(self.ids), np.int64)
        seen = np.zeros(len(self.ids), bool)
        for k in lists:
            unseen = min(int(self.best[k]), cut - 1)
            slack += unseen
            if self.best[k] < cut:
                continue
            a, b = self.first[k], self.first[k + 1]
            fetched = self.part[a:b] >= cut
            where = self.at[a:b][fetched]
            sure[where] += self.part[a:b][fetched]
            slack[where] -= unseen
            seen[where] = True
        found = np.flatnonzero(seen & (sure + slack >= least))
        exact = np.zeros(len(found), np.int64)
        for k in lists if len(found) else ():
            a, b = self.first[k], self.first[k + 1]
            at = np.searchsorted(self.at[a:b], found)
            hit = (at < b - a) & (self.at[a:b][np.minimum(at, b - a - 1)] == found)
            exact[hit] += self.part[a:b][at[hit]]
        good = exact >= least
        return found[good], exact[good]


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for k in range(b.num_rows):
            row = {c: b.column(c)[k] for c in b.schema.names}
            yield {c: x.values.to_numpy(zero_copy_only=False) if c in ("lengths", "terms", "sizes", "at", "tf") else x.as_py() for c, x in row.items()}


def _answer(docs: DataFrame, items: list[tuple], top: int) -> DataFrame:
    """item (number), doc_id, score: the best of each task for each item, `top` at most; items are (number, list of terms)."""
    spark = docs.sparkSession
    number: dict[str, int] = {}
    asked = [(k, sorted({number.setdefault(t, len(number)) for t in terms})) for k, terms in items]
    blocks = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_post(spark.sparkContext.broadcast(number)), _BLOCK), "postings")
    whole = blocks.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    n_docs, n_terms = int(whole.n or 0), int(whole.l or 0)
    weight = np.zeros(max(1, len(number)), np.int64)
    for r in blocks.select(F.explode(F.arrays_zip("terms", "sizes")).alias("x")).groupBy("x.terms").agg(F.sum("x.sizes").alias("df")).collect():  # a row for each query term
        weight[r.terms] = floor(1000 * log((2 * n_docs + 2) / (2 * r.df + 1)))
    given = spark.sparkContext.broadcast(weight)

    def head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[int, int]]] = {}
        for row in _rows_of(batches):
            for t, key, part in Lists(row, given.value, n_docs, n_terms).heads(top):
                best.setdefault(t, []).append((part, key))
            for t, have in best.items():
                if len(have) > top:
                    have.sort(reverse=True)
                    del have[top:]
        flat = [(t, key, part) for t, have in best.items() for part, key in have]
        for k in range(0, len(flat), 1 << 16):
            yield pa.record_batch([pa.array(x, kind) for x, kind in zip(zip(*flat[k : k + (1 << 16)], strict=True), (pa.int32(), pa.int64(), pa.int64()), strict=True)], names=["term", "key", "part"])

    heads = blocks.mapInArrow(head, "term int, key long, part long")
    first = Window.partitionBy("term").orderBy(F.desc("part"), "key")
    heads = heads.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= top)
    pairs = spark.createDataFrame(pa.table({"item": pa.array([k for k, ts in asked for _ in ts], pa.int64()), "term": pa.array([t for _, ts in asked for t in ts], pa.int32())}))
    low = heads.join(pairs, "term").groupBy("item", "key").agg(F.sum("part").alias("low"))
    low = low.withColumn("r", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("low")))).filter(F.col("r") == top).select("item", "low")
    bound = {r.item: r.low for r in low.collect()}
    plan = spark.sparkContext.broadcast([(k, ts, max(1, bound.get(k, 1))) for k, ts in asked])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple]] = {}
        for row in _rows_of(batches):
            lists = Lists(row, given.value, n_docs, n_terms)
            for k, ts, least in plan.value:
                have = best.setdefault(k, [])
                if len(have) == top:  # the last of the best so far bounds as well
                    least = max(least, -have[-1][0])
                where, score = lists.search(ts, least)
                have += [(-int(s), lists.ids[w] is None, lists.ids[w] or 0) for w, s in zip(where.tolist(), score.tolist(), strict=True)]
                have.sort()
                del have[top:]
        flat = [(k, None if null else d, -s) for k, have in best.items() for s, null, d in have]
        if flat:
            yield pa.record_batch([pa.array(x, pa.int64()) for x in zip(*flat, strict=True)], names=["item", "doc_id", "score"])

    return blocks.mapInArrow(search, "item long, doc_id long, score long")


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: for each item its `top` documents of highest score above 0, equal scores by ascending doc_id (null last).

    docs has doc_id and text, items has item_id and text; other columns are ignored. Each task turns blocks of documents into posting lists of the queries' terms: lists are
    kept by term, and a long list lies in pieces, one for each block, so that a term of a third of the documents is no task's whole work. The
    table of blocks is stored. Three phases go over it: the heads of every list give each item a lower bound for its last place; one threshold, bound / number of lists, cuts
    every list; documents that what was fetched leaves possible are looked up exactly. Only heads and results are shuffled.

    Null and empty texts hold no term: such documents are not found and such items have no rows. Texts of one item_id (null is one) make one item. Repeated documents count and are
    returned each. Empty tables give no rows. Texts are read whole; a very long one is a block of its own. Items are read by passes of about PASS_BYTES."""
    spark = docs.sparkSession
    asked = items.filter(F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "text")
    passes = 1 + int(asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // PASS_BYTES
    out = None
    for p in range(passes):
        terms: dict = {}
        for r in asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == p).collect():
            terms.setdefault(r.item_id, set()).update(terms_of(r.text))
        names = sorted(terms, key=lambda x: (x is None, x or 0))
        got = _answer(docs, [(k, sorted(terms[x])) for k, x in enumerate(names)], top)
        by_item = spark.createDataFrame([*enumerate(names)], "item long, item_id long")
        r = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))
        got = got.withColumn("rank", r).filter(F.col("rank") <= top).join(by_item, "item").select("item_id", "rank", "doc_id", "score")
        out = got if out is None else out.unionByName(got)
    return out


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten documents for each benchmark item, of all documents."""
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_SQL_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP11_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, {_SQL_TERMS} AS t FROM documents WHERE text IS NOT NULL),
s AS (SELECT id, doc_id, len(t) AS n, t FROM d WHERE len(t) > 0),
g AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM s),
q AS (SELECT DISTINCT item_id, unnest({_SQL_TERMS}) AS term FROM benchmark WHERE text IS NOT NULL),
tf AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(t) AS term FROM s) WHERE term IN (SELECT term FROM q) GROUP BY id, term),
w AS (SELECT term, CAST(floor(1000 * ln((2.0 * any_value(g.docs) + 2) / (2.0 * count(*) + 1))) AS BIGINT) AS w FROM tf, g GROUP BY term),
c AS (SELECT q.item_id, s.id, s.doc_id, sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (10 + (90 * s.n * g.docs) // g.words)))) AS score
      FROM tf JOIN w USING (term) JOIN q USING (term) JOIN s USING (id), g GROUP BY q.item_id, s.id, s.doc_id),
r AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM c WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM r WHERE rank <= 10
"""
