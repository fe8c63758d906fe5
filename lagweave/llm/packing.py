"""Hierarchical packing of token sequences into windows of several lengths."""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import rows, table
from .tokens import encoder

TIERS = (256, 512, 1024, 2048)
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, window long, step_group long"
#: Tokens that a task packs at a time: bounds its memory and the length of its lists.
POOL = 4_000_000
#: Tokens of a step group.
STEP = 1 << 19


class Pool:
    """Left-over stretches (document number, start, length), kept by length."""

    def __init__(self) -> None:
        self.lengths: list[int] = []
        self.items: list[list[tuple[int, int]]] = []

    def put(self, doc: int, start: int, length: int) -> None:
        at = bisect_right(self.lengths, length)
        if at and self.lengths[at - 1] == length:
            self.items[at - 1].append((doc, start))
        else:
            self.lengths.insert(at, length)
            self.items.insert(at, [(doc, start)])

    def take(self, most: int) -> tuple[int, int, int] | None:
        """The longest stretch of at most `most` tokens."""
        at = bisect_right(self.lengths, most) - 1
        return self._pop(at) if at >= 0 else None

    def cut(self, length: int) -> tuple[int, int, int]:
        """`length` tokens off the start of the shortest stretch; call only if all stretches are longer."""
        doc, start, n = self._pop(0)
        self.put(doc, start + length, n - length)
        return doc, start, length

    def _pop(self, at: int) -> tuple[int, int, int]:
        n, (doc, start) = self.lengths[at], self.items[at].pop()
        if not self.items[at]:
            del self.lengths[at], self.items[at]
        return doc, start, n

    def __bool__(self) -> bool:
        return bool(self.lengths)


def pack(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Sequences (window, [(document, start, length)]) that hold every token of documents of these lengths once.

    A document is cut into full windows of the longest tier; what is left goes to the shortest tier
    that holds it. Tiers are packed from the longest down: each stretch opens a window, and shorter
    stretches, longest first, fill its gap; the last gap is closed by cutting the shortest stretch left.
    When nothing is left to fill a gap, the open stretches are cut into windows of powers of two, so
    no window is padded.
    """
    top, out = max(tiers), []
    pools = {t: Pool() for t in sorted(tiers)}
    for doc, n in enumerate(lengths):
        for start in range(0, n - top + 1, top):
            out.append((top, [(doc, start, top)]))
        if rest := n % top:
            pools[min(t for t in tiers if t >= rest)].put(doc, n - rest, rest)
    for tier in sorted(tiers, reverse=True):
        below = [t for t in sorted(tiers, reverse=True) if t <= tier]
        while pools[tier]:
            parts, gap = [pools[tier].take(tier)], tier
            gap -= parts[0][2]
            while gap:
                found = next((x for t in below if (x := pools[t].take(gap))), None)
                if found is None:
                    if (shortest := next((t for t in sorted(below) if pools[t]), None)) is None:
                        break
                    found = pools[shortest].cut(gap)
                    if (over := pools[shortest].take(top)) is not None:  # what was cut may belong to a shorter tier now
                        pools[min(t for t in tiers if t >= over[2])].put(*over)
                parts.append(found)
                gap -= found[2]
            if gap:
                out += _powers(parts)
            else:
                out.append((tier, parts))
    return out


def _powers(parts: list[tuple[int, int, int]]) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """The parts' tokens, in order, in windows of falling powers of two."""
    out, left = [], sum(n for *_, n in parts)
    doc, start, n = (rest := list(reversed(parts))).pop()
    while left:
        window = need = 1 << (left.bit_length() - 1)
        got = []
        while need:
            if not n:
                doc, start, n = rest.pop()
            k = min(n, need)
            got.append((doc, start, k))
            start, n, need = start + k, n - k, need - k
        out.append((window, got))
        left -= window
    return out


def balanced(windows: list[tuple[int, list[tuple[int, int, int]]]], step: int = STEP) -> list[int]:
    """A step group for each window: groups have near equal tokens and near equal cost of attention, which grows with the squares of the pieces.

    Windows are dealt back and forth over the groups, longest window and dearest first."""
    groups = max(1, round(sum(w for w, _ in windows) / step))
    order = sorted(range(len(windows)), key=lambda k: (-windows[k][0], -sum(n * n for *_, n in windows[k][1]), k))
    group = [0] * len(windows)
    for place, k in enumerate(order):
        lap, at = divmod(place, groups)
        group[k] = at if lap % 2 == 0 else groups - 1 - at
    return group


def _packer(tokenizer: str, end_id: int):
    def emit(docs: list, first: int, number: int) -> tuple[pa.RecordBatch, int, int]:
        windows = pack([len(ids) for _, ids in docs])
        columns: list[list] = [[] for _ in range(9)]
        for k, ((window, parts), group) in enumerate(zip(windows, balanced(windows), strict=True)):
            offset = 0
            for doc, start, n in parts:
                doc_id, ids = docs[doc]
                for column, v in zip(columns, (doc_id, start, n, zlib.crc32(ids[start : start + n]), len(ids), first + k, offset, window, number + group), strict=True):
                    column.append(v)
                offset += n
        return pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=[x.split()[0] for x in PIECES.split(", ")]), first + len(windows), number + 1 + max(balanced(windows), default=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).ids
        first = number = TaskContext.get().partitionId() << 36
        docs, n = [], 0
        for b in rows(batches):
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                docs.append((doc_id, np.array([*encode(text or ""), end_id], "<u4")))
                n += len(docs[-1][1])
                if n >= POOL:
                    batch, first, number = emit(docs, first, number)
                    yield batch
                    docs, n = [], 0
        if docs:
            yield emit(docs, first, number)[0]

    return run


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """One row for each piece of a document in a packed sequence.

    Each document is encoded whole and ends with end_id; a null text is the empty one. Pieces of a
    sequence lie at offsets 0, 1, ... without gaps, and a sequence is as long as its window. Packing
    is local to a task and to pools of some millions of tokens, so it needs no shuffle and its memory
    is bounded; ids of sequences and step groups are unique over all tasks. Repeated rows are packed
    each for itself, and a null doc_id is kept.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_packer(tokenizer, end_id), PIECES)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
