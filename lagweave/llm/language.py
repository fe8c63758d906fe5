"""Language of documents by multilingual mixture inference."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, rows, stored, table

#: Buckets of hashed trigrams of letters, pseudo-count of each bucket, EM rounds.
BUCKETS, PRIOR, ROUNDS = 1 << 16, 0.1, 30
#: Languages that a task counts at a time, entries of a model that the driver reads at a time, and numbers (words by languages) that are looked at in memory at a time. None bounds a result.
HELD, SLICE, CELLS = 128, 4 << 20, 4 << 20
#: Letters that are looked at a time.
SPAN = 1 << 20

_LETTER: np.ndarray | None = None


class Model(NamedTuple):
    """Languages in order of code points, log-likelihood of a bucket that a language never had, and by how much those that it had exceed it: entries first[b] to first[b + 1] are the languages and gains of bucket b."""

    names: list[str]
    base: np.ndarray
    first: np.ndarray
    lang: np.ndarray
    gain: np.ndarray


def _letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(k).isalpha() for k in range(0x110000)), bool, 0x110000)
    return _LETTER


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(hashed trigram around each letter, number of the letter's word); everything but letters counts as one blank."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    letter = _letters()[points]
    points = np.concatenate([[0], np.where(letter, points, 0), [0]]).astype(np.uint64)
    with np.errstate(over="ignore"):
        mixed = (points[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ (points[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (points[2:] * np.uint64(0x165667B19E3779F9))
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    starts = letter & ~np.concatenate([[False], letter[:-1]])
    return (mixed >> np.uint64(48)).astype(np.int64)[letter], (np.cumsum(starts) - 1)[letter]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of trigrams by language over a task's documents; given whenever HELD languages are counted."""
    total: dict[str, np.ndarray] = {}

    def give() -> Iterator[pa.RecordBatch]:
        for lang, have in total.items():
            at = np.flatnonzero(have)
            yield pa.record_batch([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(have[at], pa.int64())], names=["lang", "bucket", "n"])
        total.clear()

    for b in rows(batches):
        for text, lang in zip(b.column("text").to_pylist(), b.column("lang").to_pylist(), strict=True):
            if lang not in total:
                if len(total) >= HELD:
                    yield from give()
                total[lang] = np.zeros(BUCKETS, np.int64)
            for at in range(0, len(text), SPAN):
                total[lang] += np.bincount(trigrams(text[at : at + SPAN])[0], minlength=BUCKETS)
    yield from give()


def fit(docs: DataFrame) -> Model:
    """The model of all languages in the text and lang of docs.

    Counts cover all of docs. The model has an entry for each bucket that a language has, at most BUCKETS a language, whatever the
    corpus; it is read by slices and broadcast. Rows without text or lang, and languages without a letter, take no part."""
    known = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang")
    counted = known.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counted = stored(counted, "language-counts")
    got = sorted(counted.groupBy("lang").agg(F.sum("n").alias("n"), F.count("*").alias("entries")).collect(), key=lambda r: [ord(c) for c in r.lang])
    base = np.log(PRIOR / (np.array([r.n for r in got], np.float64) + PRIOR * BUCKETS))
    if not got:
        return Model([], base, np.zeros(BUCKETS + 1, np.int64), np.zeros(0, np.int32), np.zeros(0, np.float32))
    numbers = docs.sparkSession.createDataFrame([(r.lang, k) for k, r in enumerate(got)], "lang string, number int")
    entries = counted.join(F.broadcast(numbers), "lang").select("bucket", "number", F.log(F.col("n") / PRIOR + 1).cast("float").alias("gain"))
    slices = min(BUCKETS, 1 + sum(r.entries for r in got) // SLICE)
    cuts = [BUCKETS * k // slices for k in range(slices + 1)]
    size, lang, gain = np.zeros(BUCKETS + 1, np.int64), [], []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        part = entries.filter((F.col("bucket") >= a) & (F.col("bucket") < b)).toArrow()
        bucket, number = np.asarray(part["bucket"]), np.asarray(part["number"])
        order = np.lexsort((number, bucket))
        size[1:] += np.bincount(bucket, minlength=BUCKETS)
        lang.append(number[order])
        gain.append(np.asarray(part["gain"])[order])
    return Model([r.lang for r in got], base, np.cumsum(size), np.concatenate(lang), np.concatenate(gain))


def proportions(words: np.ndarray, chosen: np.ndarray | None = None, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """(proportions of the chosen languages, or all, in a document, log-likelihood): EM over its words; words[i, k] is the log-likelihood of word i in language k.

    CELLS numbers are looked at at a time."""
    n = words.shape[1] if chosen is None else len(chosen)
    step = max(1, CELLS // n)

    def look(at: int) -> tuple[np.ndarray, np.ndarray]:
        part = words[at : at + step]
        part = (part if chosen is None else part[:, chosen]).astype(np.float64)
        top = part.max(axis=1, keepdims=True)
        return np.exp(part - top), top[:, 0]

    starts = range(0, len(words), step)
    whole = look(0) if len(starts) == 1 else None
    share = np.full(n, 1 / n)
    for _ in range(rounds):
        now = np.zeros(n)
        for at in starts:
            part = (whole or look(at))[0] * share
            part /= part.sum(axis=1, keepdims=True)
            now += part.sum(axis=0)
        now /= len(words)
        done = np.abs(now - share).max() < min(1e-4, 0.1 / n)
        share = now
        if done:
            break
    fit_ = 0.0
    for at in starts:
        like, top = whole or look(at)
        fit_ += float((np.log(like @ share + 1e-300) + top).sum())
    return share, fit_


def infer(words: np.ndarray) -> np.ndarray:
    """Proportions over the language set of the best penalised likelihood (BIC: half the log of the words for each language beyond the first).

    The set shrinks from all languages, least share first, for as long as that does not cost more than the penalty."""
    chosen = np.arange(words.shape[1])
    share, fit_ = proportions(words)
    penalty = 0.5 * np.log(max(2, len(words)))
    while len(chosen) > 1:
        drop = share < max(1e-3, 0.5 / len(words))
        if not drop.any() or drop.all():
            drop = np.arange(len(chosen)) == np.argmin(share)
        less, less_fit = proportions(words, chosen[~drop])
        if less_fit + penalty * drop.sum() < fit_:
            break
        chosen, share, fit_ = chosen[~drop], less, less_fit
    out = np.zeros(words.shape[1])
    out[chosen] = share
    return out


def _add(out: np.ndarray, grams: np.ndarray, word: np.ndarray, model: Model) -> None:
    """Add the log-likelihoods of trigrams to the rows of their words, by runs of at most about CELLS numbers."""
    n = len(model.names)
    count = model.first[grams + 1] - model.first[grams]
    cost = np.cumsum(count + np.where(np.diff(word, prepend=-1) != 0, n, 0))
    cuts = np.unique(np.concatenate([[0], np.searchsorted(cost, np.arange(CELLS, cost[-1], CELLS), side="left") + 1, [len(grams)]]))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        low, high, many = int(word[a]), int(word[b - 1]) + 1, count[a:b]
        at = np.arange(many.sum()) + np.repeat(model.first[grams[a:b]] - np.cumsum(many) + many, many)
        gained = np.bincount(np.repeat(word[a:b] - low, many) * n + model.lang[at], model.gain[at], minlength=(high - low) * n)
        out[low:high] += gained.reshape(-1, n) + np.bincount(word[a:b] - low, minlength=high - low)[:, None] * model.base


def word_likelihoods(text: str, model: Model) -> np.ndarray:
    """One row for each word of a text, a column for each language; on disk if that is more than CELLS numbers. A word that spans two looks of SPAN characters counts as two."""
    spans = range(0, len(text), SPAN)
    whole = trigrams(text) if len(spans) == 1 else None
    look = lambda at: whole or trigrams(text[at : at + SPAN])
    sizes = [int(word[-1]) + 1 if len(word := look(at)[1]) else 0 for at in spans]
    shape = sum(sizes), len(model.names)
    if shape[0] * shape[1] <= CELLS:
        out = np.zeros(shape)
    else:
        with tempfile.TemporaryFile() as f:
            out = np.memmap(f, np.float64, "w+", shape=shape)
    row = 0
    for at, size in zip(spans, sizes, strict=True):
        if size:
            _add(out[row : row + size], *look(at), model)
        row += size
    return out


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """docs' doc_id and held_out with lang_pred, score and languages (of proportion 0.05 or more, largest first).

    score is the proportion of lang_pred; a null text, one without letters, or an empty model gives 'und', 0 and none. Rows are
    judged one by one, whole, a very long text by runs of its words, so nulls, copies and ties of ids need no rule; equal proportions go to the language first in code points."""
    given = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*given.value)
        names = model.names
        for b in rows(batches):
            pred, score, all_ = [], [], []
            for text in b.column("text").to_pylist():
                words = word_likelihoods(text, model) if text and names else np.zeros((0, 1))
                if not len(words):
                    pred.append("und"), score.append(0.0), all_.append([])
                    continue
                share = infer(words)
                order = np.argsort(-share, kind="stable")
                pred.append(names[order[0]]), score.append(float(min(1.0, share[order[0]])))
                all_.append([names[k] for k in order if share[k] >= 0.05])
            yield pa.record_batch([b.column("doc_id"), b.column("held_out"), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(all_, pa.list_(pa.string()))], names=["doc_id", "held_out", "lang_pred", "score", "languages"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "held_out", "text").mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, languages array<string>")


def op8_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out(F.col("doc_id")))
    return identify(docs, fit(docs.filter(~F.col("held_out"))))
