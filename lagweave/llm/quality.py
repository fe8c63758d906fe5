"""Quality rules: base counts of a text, and compression bands over whole texts and fixed chunks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import rows, table

#: Bytes up to which a limit holds, lowest ratio, highest ratio. Prose of any of the usual languages
#: compresses to a ratio of 1.4 at some hundred bytes and 2.8 at 64 KB; shorter texts hardly at all.
WHOLE = ((128, 0.0, 3.0), (512, 0.95, 2.6), (2048, 1.15, 2.8), (8192, 1.25, 3.2), (65536, 1.3, 4.0), (float("inf"), 1.3, 5.0))
CHUNK, CHUNK_BAND, BAD_SHARE = 4096, (1.15, 3.2), 0.25
LEAST_WORDS, MOST_REPEATED = 50, 50

_SPACES, _SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"
STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, ratio double, n_chunks long, n_bad_chunks long"


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a window of three that occurs twice or more among the words."""
    n = len(words)
    if n < 4:  # three words have one window
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    pairs = np.unique(ids[:-1] * len(seen) + ids[1:], return_inverse=True)[1]
    _, back, count = np.unique(pairs[:-1] * len(seen) + ids[2:], return_inverse=True, return_counts=True)
    often = np.flatnonzero(count[back] > 1)
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[often + k] = True
    return int(covered.sum())


def counts(text: str) -> tuple[int, int, int, int, int]:
    data = text.encode()
    words = data.split()  # bytes.split cuts at exactly space, \\t, \\n, \\v, \\f and \\r
    lines = [x for x in data.split(b"\n") if x.strip(_SPACES)]
    chars = len(text) - (len(data) - len(data.translate(None, _SPACES)))
    return len(words), chars, len(data) - len(data.translate(None, _SYMBOLS)), len(lines) - len(set(lines)), repeat_words(words)


def bands(text: str, zstd: zstandard.ZstdCompressor) -> tuple[float, int, int]:
    """Ratio of the whole text, its full chunks, and those of them outside the band of chunks."""
    data = text.encode()
    ratio = lambda b: len(b) / len(zstd.compress(b)) if b else 1.0
    chunks = [ratio(data[at : at + CHUNK]) for at in range(0, len(data) - CHUNK + 1, CHUNK)]
    return ratio(data), len(chunks), sum(not CHUNK_BAND[0] <= r <= CHUNK_BAND[1] for r in chunks)


def passes(n_bytes: int, ratio: float, n_chunks: int, n_bad: int) -> bool:
    low, high = next((low, high) for most, low, high in WHOLE if n_bytes <= most)
    return low <= ratio <= high and n_bad <= BAD_SHARE * n_chunks


def _judge(keep_only: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zstd = zstandard.ZstdCompressor(level=3)
        for b in rows(batches):
            out = []
            for text in b.column("text").to_pylist():
                base, band = counts(text or ""), bands(text or "", zstd)
                failed = base[0] < LEAST_WORDS or 100 * base[4] > MOST_REPEATED * base[0]
                out.append((*base, *band, failed, not failed and passes(len((text or "").encode()), *band)))
            if keep_only:
                yield b.filter(pa.array([x[-1] for x in out], pa.bool_()))
                continue
            kinds = [pa.int64()] * 5 + [pa.float64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]
            names = [x.split()[0] for x in STATS.split(", ")] + ["base_failed", "kept"]
            yield pa.record_batch([b.column("doc_id"), *(pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds))], names=["doc_id", *names])

    return run


def judge(docs: DataFrame) -> DataFrame:
    """One row per document: base counts, ratio of the whole text, chunks and chunks outside their band, base_failed, kept.

    A text is kept if the base rules pass, its zstandard ratio lies in the band for its length, and at most a
    quarter of its full chunks lie outside theirs. A null text has no words and fails. Each row is
    judged by itself, so repeated rows and null ids need no rule. No shuffle; memory is that of a few texts.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(_judge(False), f"doc_id long, {STATS}, base_failed boolean, kept boolean")


def keep(docs: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, whose text judge() keeps."""
    return docs.mapInArrow(_judge(True), docs.schema)


def op9_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))
