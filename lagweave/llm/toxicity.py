"""Toxic passages by maximum-scoring segments over token log-odds."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, rows, table

#: Buckets of hashed tokens, weight of the Dirichlet prior in documents, least z-score of a token that scores above the drift.
BUCKETS, PRIOR, LEAST_Z = 1 << 20, 1.0, 4.0
#: Score of a neutral token: what makes segments end.
DRIFT, CEILING = -0.35, 4.0
#: Chance of its score in clean text of the document's length up to which a segment is significant.
MOST_P = 0.01
#: Share of clean texts, those of highest best segments, that the extreme-value law is fitted to.
TAIL = 0.1
#: Labelled documents that the classifier is fitted to (its documented bound), and those of them that fit its calibration; both are expected sizes of draws by a hash of the id.
LABELLED, SAMPLE = 200_000, 20_000

_TOKEN = re.compile(r"[^\W_]+")


class _Vocabulary(dict):
    """Numbers the tokens of a task; features[number] holds the buckets of the token and of its stems, its first 4 to 7 letters."""

    STEMS, MOST = (4, 5, 6, 7), 300_000

    def __init__(self) -> None:
        super().__init__()
        self.buckets = array("q")

    def __missing__(self, token: str) -> int:
        self[token] = n = len(self)
        whole = xxhash.xxh64_intdigest(token) % BUCKETS
        self.buckets.append(whole)
        for k in self.STEMS:
            self.buckets.append(xxhash.xxh64_intdigest(token[:k], seed=k) % BUCKETS if len(token) > k else whole)
        return n

    def numbers(self, text: str) -> np.ndarray:
        """Of the lower-cased tokens (runs of letters and digits) of a text, in order. Good until the next call."""
        if len(self) > self.MOST:
            self.clear()
            self.buckets = array("q")
        return np.fromiter(map(self.__getitem__, _TOKEN.findall(text.lower())), np.int64)

    def features(self, numbers: np.ndarray) -> np.ndarray:
        return np.frombuffer(self.buckets, np.int64).reshape(-1, 1 + len(self.STEMS))[numbers].copy() if len(numbers) else np.zeros((0, 1), np.int64)


_WORDS = _Vocabulary()


def presence(text: str) -> np.ndarray:
    """The distinct buckets of a text."""
    return np.unique(_WORDS.features(np.unique(_WORDS.numbers(text))))


def token_scores(text: str, weight: np.ndarray) -> np.ndarray:
    """For each token the best score of itself and its stems."""
    distinct, back = np.unique(_WORDS.numbers(text), return_inverse=True)
    return weight[_WORDS.features(distinct)].max(axis=1)[back] if len(distinct) else np.zeros(0, weight.dtype)


def places(text: str, tokens: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(start, end) in characters of the text of passages given by the numbers of their first token and of that after their last.

    Tokens are those of the lower-cased text; where lower case has more characters than the text, places are carried back."""
    if not tokens:
        return []
    lower = text.lower()
    found = [m.span() for m in _TOKEN.finditer(lower)]
    spans = [(found[a][0], found[b - 1][1]) for a, b in tokens]
    if len(lower) == len(text):
        return spans
    at = np.cumsum([0, *(len(c.lower()) for c in text)])  # of each character in the lower-cased text
    return [(int(np.searchsorted(at, a, side="right")) - 1, int(np.searchsorted(at, b, side="left"))) for a, b in spans]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = {0: np.zeros(BUCKETS, np.int64), 1: np.zeros(BUCKETS, np.int64)}
    for b in rows(batches):
        for text, toxic in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist(), strict=True):
            total[toxic][presence(text)] += 1
    both = np.flatnonzero(total[0] + total[1])
    if len(both):
        yield pa.record_batch([pa.array(both, pa.int32()), pa.array(total[0][both], pa.int64()), pa.array(total[1][both], pa.int64())], names=["bucket", "clean", "toxic"])


def log_odds(clean: np.ndarray, toxic: np.ndarray, n_clean: int, n_toxic: int) -> np.ndarray:
    """Score of each bucket from the documents of either kind that hold it: log-odds ratio with a Dirichlet prior, PRIOR documents like all of them and half a document.

    Where the ratio is LEAST_Z of its standard deviations above 0 it scores, up to CEILING; else the bucket scores DRIFT."""
    alpha = 0.5 + PRIOR * (clean + toxic) / max(1, n_clean + n_toxic)
    odds = lambda n, all_: np.log((n + alpha) / (all_ + PRIOR + 1 - n - alpha + 0.5))
    delta = odds(toxic, n_toxic) - odds(clean, n_clean)
    z = delta / np.sqrt(1 / (toxic + alpha) + 1 / (clean + alpha))
    return np.where((z >= LEAST_Z) & (toxic >= 3), np.minimum(delta, CEILING), DRIFT).astype(np.float32)


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) of a sequence, left to right, in linear time.

    Runs of one sign count as one step. A list of candidate segments keeps the sums left and right of each; a new one joins
    with those before it back to the last one whose left sum is smaller, if its right sum is larger than that one's."""
    if not (scores > 0).any():
        return []
    sign = scores > 0
    cuts = np.flatnonzero(np.diff(sign, prepend=~sign[:1]))
    sums = np.add.reduceat(scores.astype(np.float64), cuts)
    ends = np.append(cuts[1:], len(scores))
    found: list[list[float]] = []  # start, end, sum before it, sum with it
    total = 0.0
    for start, end, s in zip(cuts.tolist(), ends.tolist(), sums.tolist(), strict=True):
        left, total = total, total + s
        if s <= 0:
            continue
        new = [start, end, left, total]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= new[2]:
                j -= 1
            if j < 0 or found[j][3] >= new[3]:
                break
            new = [found[j][0], new[1], found[j][2], new[3]]
            del found[j:]
        found.append(new)
    return [(int(a), int(b), r - left) for a, b, left, r in found]


def evidence(text: str | None, weight: np.ndarray) -> tuple[int, list[tuple[int, int, float]]]:
    """(tokens, all maximal segments as (first token, token after the last, score))."""
    scores = token_scores(text or "", weight)
    return len(scores), segments(scores)


def significant(n: int, found: list[tuple[int, int, float]], law: tuple[float, float]) -> list[tuple[int, int, float, float]]:
    """(start, end, score, p) of the segments of a text of n tokens whose chance p is MOST_P at most."""
    if not found:
        return []
    p = chance(np.array(n), np.array([s for *_, s in found]), law)
    return [(a, b, s, float(q)) for (a, b, s), q in zip(found, p, strict=True) if q <= MOST_P]


def extreme_value(best: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """(lambda, log K) of the law of the best of n tokens of clean text, P(best >= x) = 1 - exp(-K n e^(-lambda x)), fitted to the tail.

    Most clean texts have no token that scores, so that their best is 0, which is no draw from this law: bests below the TAIL
    highest count as censored there. For a given lambda the likelihood's K is a quotient; lambda is where the rest is highest. With less than ten positive bests a cautious
    law is taken as given."""
    positive = np.sort(best[best > 0])
    if len(positive) < 10:
        return 1.0, -4.0
    cut = max(positive[0], float(np.quantile(best, 1 - TAIL)))
    above, n = best >= cut, np.maximum(n, 1)
    x, count = np.where(above, best, cut) - cut, int(above.sum())

    def fitted(lam: float) -> tuple[float, float]:
        log_k = np.log(count) - np.log((n * np.exp(-lam * x)).sum())
        return count * (log_k + np.log(lam)) - lam * x[above].sum(), log_k

    low, high = np.log(0.05), np.log(20.0)
    share = (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - share * (high - low), low + share * (high - low)
        low, high = (low, b) if fitted(np.exp(a))[0] >= fitted(np.exp(b))[0] else (a, high)
    lam = float(np.exp((low + high) / 2))
    return lam, float(fitted(lam)[1] + lam * cut)


def chance(n: np.ndarray, score: np.ndarray, law: tuple[float, float]) -> np.ndarray:
    """The chance that clean text of n tokens has a segment of that score or a better one."""
    lam, log_k = law
    return -np.expm1(-np.exp(np.clip(log_k + np.log(np.maximum(n, 1)) - lam * score, -80, 50)))


def surprise(n: np.ndarray, best: np.ndarray, law: tuple[float, float]) -> np.ndarray:
    """-log10 of the chance of the best segment, 0 to 30."""
    return np.where(best > 0, np.clip(-np.log10(np.maximum(chance(n, best, law), 1e-30)), 0, 30), 0.0)


def features(n, best, every, total, law) -> np.ndarray:
    """Of texts of n tokens: their best segment with its surprise, the sums of every segment and of the significant ones, each also by length, and the length."""
    n, best, every, total = (np.asarray(x, np.float64) for x in (n, best, every, total))
    size = np.maximum(n, 20)
    return np.stack([np.ones_like(best), np.log1p(best), surprise(n, best, law) / 10, np.log1p(total), total / size, np.log1p(n) / 10, np.log1p(every), every / size], axis=1)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Coefficients by Newton's method with step halving; the ridge spares the constant."""
    w, pull = np.zeros(x.shape[1]), ridge * np.append(1e-6, np.ones(x.shape[1] - 1))

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((np.logaddexp(0, z) - y * z).sum() + (pull * w * w).sum() / 2)

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(pull), x.T @ (y - p) - pull * w)
        size = 1.0
        while size > 1e-6 and loss(w + size * step) > loss(w):
            size /= 2
        w = w + size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return w


def _calibration_rows(weight):
    """toxic, tokens and scores of all maximal segments, as arrays of one row for each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows(batches):
            got = [evidence(t, weight.value) for t in b.column("text").to_pylist()]
            yield pa.record_batch([b.column("toxic"), pa.array([n for n, _ in got], pa.int64()), pa.array([[s for *_, s in x] for _, x in got], pa.list_(pa.float64()))], names=["toxic", "n", "scores"])

    return run


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, tuple[float, float], np.ndarray]:
    """(token scores, extreme-value law, coefficients) from docs (doc_id, text) and labels (doc_id, toxic 0 or 1).

    Fitted to about LABELLED labelled documents, or all if they are fewer, and calibrated on about SAMPLE of them, drawn by a hash
    of the id: the labels of the draw have a bounded size and are broadcast, so that no text is shuffled. The model has
    BUCKETS numbers, whatever the corpus. Of contradicting labels of one id the larger holds."""
    spark = docs.sparkSession
    known = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    drawn = lambda df, n, of: df.filter(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 30)) < int(min(1.0, n / max(1, of)) * (1 << 30)))
    known = drawn(known, LABELLED, known.count())
    both = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(known), "doc_id")
    clean, toxic, size = np.zeros(BUCKETS), np.zeros(BUCKETS), {r.toxic: r["count"] for r in both.groupBy("toxic").count().collect()}
    counted = both.select("text", "toxic").mapInArrow(_count, "bucket int, clean long, toxic long").groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    got = counted.toArrow()  # at most BUCKETS rows
    clean[np.asarray(got["bucket"])], toxic[np.asarray(got["bucket"])] = np.asarray(got["clean"]), np.asarray(got["toxic"])
    weight = log_odds(clean, toxic, size.get(0, 0), size.get(1, 0))
    evident = _calibration_rows(spark.sparkContext.broadcast(weight))
    got = drawn(both, SAMPLE, sum(size.values())).select("toxic", "text").mapInArrow(evident, "toxic int, n long, scores array<double>").collect()
    y, n, best = (np.array(x, np.float64) for x in ([r.toxic for r in got], [r.n for r in got], [max(r.scores, default=0.0) for r in got]))
    law = extreme_value(best[y == 0], n[y == 0])
    total = np.array([sum(s for *_, s, _ in significant(r.n, [(0, 0, s) for s in r.scores], law)) for r in got], np.float64)
    if not len(y):
        return weight, law, np.array([-5.0, 0, 1, 0, 0, 0, 0, 0])
    every = np.array([sum(r.scores) for r in got], np.float64)
    return weight, law, logistic(features(n, best, every, total, law), y)


def score(docs: DataFrame, model: tuple[np.ndarray, tuple[float, float], np.ndarray]) -> DataFrame:
    """docs' doc_id and held_out with score, predicted, the evidence (tokens n, score of the best segment, total of the significant ones), and segments.

    segments holds every significant passage, left to right: start and end in characters of the text (text[start:end] is the
    passage), score, and p, its chance in clean text of that length. Null and empty texts have no passage and get the score of that. Rows are judged one by one, whole, in time linear in their
    tokens; a very long text needs room for its own tokens in a task. Copies, repeated rows and other columns need no rule."""
    weight, law, w = model
    given = docs.sparkSession.sparkContext.broadcast(weight)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("p", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows(batches):
            n, best, every, total, passages = [], [], [], [], []
            for text in b.column("text").to_pylist():
                tokens, found = evidence(text, given.value)
                sure = significant(tokens, found, law)
                n.append(tokens), best.append(max((s for *_, s in found), default=0.0)), every.append(float(sum(s for *_, s in found))), total.append(float(sum(s for _, _, s, _ in sure)))
                at = places(text or "", [(a, z) for a, z, *_ in sure])
                passages.append([{"start": a, "end": z, "score": s, "p": q} for (a, z), (_, _, s, q) in zip(at, sure, strict=True)])
            p = 1 / (1 + np.exp(-np.clip(features(n, best, every, total, law) @ w, -30, 30)))
            yield pa.record_batch([b.column("doc_id"), b.column("held_out"), pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32)), pa.array(n, pa.int64()), pa.array(best, pa.float64()), pa.array(total, pa.float64()), pa.array(passages, kind)], names=["doc_id", "held_out", "score", "predicted", "n", "best", "total", "segments"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "held_out", "text").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, n long, best double, total double, segments array<struct<start:int,end:int,score:double,p:double>>")


def op10_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out(F.col("doc_id")))
    return score(docs, fit(docs.filter(~F.col("held_out")), table(spark, sf_dir, "labels")))
