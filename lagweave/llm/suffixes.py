"""Removal of repeated passages by a common-prefix-aware distributed merge sort of suffixes.

Sorting every suffix of a corpus would exchange the corpus hundreds of times over. A passage of `length` bytes
that occurs twice has the same least K-byte string (by a hash, leftmost of equals) at both places, so it is
enough to sort the suffixes that start at such anchors, two in some length - K positions, with the
bytes before and after that the passages around an anchor cover. Tasks sort their suffixes into runs, front-code
them (each keeps only what differs from its predecessor), cut them at common splitters and exchange the
segments; a loser tree that carries the lengths of common prefixes merges the segments of a range. Passages whose
core of three quarters of their length occurs once in the corpus are found beforehand by a bitmap of fixed size and not
exchanged; its false hits only cost room.

The length is a parameter. LENGTH (400) is the one that op5 removes by. SHORT (200) is for passages of over fifty words:
fifty-one words of three letters and a space have 204 bytes, so 400 bytes would miss most of them. Any two passages
that agree in `length` bytes are found, whatever the length, from 2 * K on.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, mix64, stored, table

LENGTH, SHORT, K = 400, 200, 48
#: Bits of the slots of the bitmap (32 MB for each length), and of a block of it; blocks that are summed up together.
SLOT, BLOCK, BLOCKS = 28, 16, 32
#: Bytes of text that are looked at a time, bytes of a sorted run, windows that are compared at a time, bytes of text for each range of suffixes.
PIECE, RUN, WINDOWS, RANGE = 1 << 19, 16 << 20, 1 << 19, 8 << 20
#: Samples of suffixes that a task gives, at least, and for RANGE bytes; groups in which they are gathered, and most of a group.
SAMPLES, GATHERED, MOST_SAMPLES = 64, 16, 1 << 14

_LETTER = np.random.default_rng(400).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """The first n powers; a worker keeps those of some MB of text."""
    out = _POWERS.get(base, np.ones(1, np.uint64))
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), 2**64))])
    if len(out) <= 1 << 21:
        _POWERS[base] = out
    return out[:n]


def _hashes(buf: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the K = 48 bytes at each position."""
    h = _LETTER[buf]
    for n in (1, 2, 4, 8):
        h = h[:-n] * np.uint64(pow(_BASE, n, 2**64)) + h[n:]
    p = np.uint64(pow(_BASE, 16, 2**64))
    double = h[:-16] * p + h[16:]
    return mix64(double[: len(h) - 32] * p + h[32:])


def anchors(h: np.ndarray, n_bytes: int, starts: np.ndarray, sizes: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, last window, hash at the anchor) for texts that lie at starts with sizes in n_bytes bytes, at most 2^24, whose _hashes are h.

    Every window of `length` bytes inside one text belongs to exactly one row, by its place and its anchor."""
    if n_bytes < length:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    low = np.uint64((1 << 24) - 1)
    key = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    w = length - K + 1
    blocks = np.full(-(-len(key) // w) * w, np.iinfo(np.uint64).max, np.uint64)
    blocks[: len(key)] = key
    blocks = blocks.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(blocks, axis=1).ravel()
    n = n_bytes - length + 1
    least = (np.minimum(ahead[:n], behind[w - 1 : w - 1 + n]) & low).astype(np.int64)
    valid = np.zeros(n + 1, np.int64)
    long = sizes >= length
    np.add.at(valid, starts[long], 1)
    np.add.at(valid, starts[long] + sizes[long] - length + 1, -1)
    inside = np.cumsum(valid)[:n] > 0
    new = np.ones(n, bool)
    new[1:] = (least[1:] != least[:-1]) | ~inside[:-1]
    new[starts[long]] = True
    first = np.flatnonzero(new & inside)
    ends = np.append(np.flatnonzero(new | ~inside), n)
    last = ends[np.searchsorted(ends, first, side="right")] - 1
    return least[first], first, last, h[least[first]]


def _totals(buf: np.ndarray) -> np.ndarray:
    """Sums of the bytes' numbers times powers, from which the hash of any string follows."""
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_LETTER[buf] * _powers(_BASE, len(buf)), out=total[1:])
    return total


def cores(total: np.ndarray, at: np.ndarray, first: np.ndarray, last: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(anchor's number, class, first window, last window, slot of the core): an anchor's windows by four classes of their distance, in this order."""
    step = length // 4
    inverse, out = _powers(_INVERSE, len(total)), []
    for k in range(-(-length // step)):
        low, high = np.maximum(at - last, k * step), np.minimum(at - first, (k + 1) * step - 1)
        i = np.flatnonzero(low <= high)
        a = at[i] - k * step
        slot = mix64((total[a + length - step] - total[a]) * inverse[a] + np.uint64(k)) >> np.uint64(64 - SLOT)
        out.append((i, np.full(len(i), k), at[i] - high[i], at[i] - low[i], slot.astype(np.int64)))
    own, kind, first, last, slot = (np.concatenate(c) for c in zip(*out, strict=True))
    order = np.lexsort((kind, own))
    return own[order], kind[order], first[order], last[order], slot[order]


def _looks(batches: Iterator[pa.RecordBatch], most: int = LENGTH) -> Iterator[tuple[bytes, list[tuple[int, int, int]], np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, [(k1, k2, place in the text)], starts, sizes, how many places can start a window): texts of a task by about PIECE bytes.

    Longer texts come in pieces, so that windows of up to `most` bytes start in one piece each."""
    parts, keys, starting, n = [], [], [], 0

    def give():
        sizes = np.array([len(p) for p in parts], np.int64)
        return b"".join(parts), keys, np.cumsum(sizes) - sizes, sizes, np.array(starting, np.int64)

    for b in batches:
        for k1, k2, text in zip(b.column("k1").to_pylist(), b.column("k2").to_pylist(), b.column("text").to_pylist(), strict=True):
            data = (text or "").encode()
            for at in range(0, max(1, len(data) - most + 1), PIECE):
                parts.append(data[at : at + PIECE + most - 1])
                keys.append((k1, k2, at))
                starting.append(PIECE if at + PIECE < len(data) - most + 1 else len(data))
                n += len(parts[-1])
                if n >= PIECE:
                    yield give()
                    parts, keys, starting, n = [], [], [], 0
    if parts:
        yield give()


def _anchored(data: bytes, starts: np.ndarray, sizes: np.ndarray, starting: np.ndarray, lengths: tuple[int, ...]):
    """For each length: (its number, anchors(), cores()) of what _looks() gives."""
    buf = np.frombuffer(data, np.uint8)
    h, total = _hashes(buf) if len(buf) >= K else np.zeros(0, np.uint64), _totals(buf)
    for k, length in enumerate(lengths):
        found = anchors(h, len(buf), starts, np.minimum(sizes, starting + length - 1), length)
        yield k, found, cores(total, *found[:3], length)


def _slot(h: np.ndarray) -> np.ndarray:
    """The slot of an anchor by the hash of its K bytes. A passage occurs again only if its anchor and its core do; asked for both, the bitmap is wrong more seldom."""
    return (mix64(h + np.uint64(K)) >> np.uint64(64 - SLOT)).astype(np.int64)


def _note(lengths: tuple[int, ...]):
    """Slots of a task's anchors by blocks of the bitmaps, one for each length (seen once, seen more often); in blocks below 0 its bytes and samples of the suffixes."""
    kinds = (pa.int32(), pa.binary(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, samples, size = [], {}, 0
        for data, _, starts, sizes, starting in _looks(batches, max(lengths)):
            size += len(data)
            for k, (at, _, _, h), core in _anchored(data, starts, sizes, starting, lengths):
                slots += [core[4] + (k << SLOT), _slot(h) + (k << SLOT)]
                if k == 0:
                    few = max(SAMPLES, SAMPLES * size // RANGE)
                    for i in np.argsort(h * np.uint64(0xD6E8FEB86659FD93))[:few].tolist():
                        samples[int(h[i])] = data[at[i] : at[i] + K]
                    samples = dict(sorted(samples.items())[:few])
        out = [(-1, size.to_bytes(8, "little"), b"")] + [(-BLOCKS * (2 + h % GATHERED), h.to_bytes(8, "big") + s, b"") for h, s in samples.items()]
        if slots:
            slot, count = np.unique(np.concatenate(slots), return_counts=True)
            block = slot >> BLOCK
            cuts = np.append(np.flatnonzero(np.diff(block, prepend=-1)), len(slot))
            low = (slot & ((1 << BLOCK) - 1)).astype("<u2")
            out += [(int(block[a]), low[a:b][count[a:b] == 1].tobytes(), low[a:b][count[a:b] > 1].tobytes()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        yield pa.record_batch([pa.array(list(c), kind) for c, kind in zip(zip(*out, strict=True), kinds, strict=True)], names=["block", "once", "more"])

    return run


def _combine(group: pd.DataFrame) -> pd.DataFrame:
    """The bitmaps' blocks (bits that are set more than once), the bytes of all tasks, or samples, of a group of blocks."""
    if int(group["block"].iloc[0]) == -1:
        return pd.DataFrame({"block": [-1], "bits": [sum(int.from_bytes(x, "little") for x in group["once"]).to_bytes(8, "little")]})
    if int(group["block"].iloc[0]) < 0:  # an even choice of the suffixes, whose order is by a hash until here
        return pd.DataFrame({"block": int(group["block"].iloc[0]), "bits": [x[8:] for x in sorted(group["once"])[:MOST_SAMPLES]]})
    out = []
    for block, own in group.groupby("block"):
        once, more = (np.frombuffer(b"".join(own[c]), "<u2") for c in ("once", "more"))
        count = np.bincount(once, minlength=1 << BLOCK)
        count[more] = 2
        out.append((block, zstandard.compress(np.packbits(count > 1).tobytes(), 1)))
    return pd.DataFrame(out, columns=["block", "bits"])


def common_prefix(a: bytes, b: bytes, at: int = 0) -> int:
    """Length of the common prefix of a and b, known to be `at` or more."""
    n = min(len(a), len(b))
    step = 8
    while at < n:
        x, y = a[at : at + step], b[at : at + step]
        if x != y:
            m = min(len(x), len(y))
            differ = int.from_bytes(x[:m], "big") ^ int.from_bytes(y[:m], "big")
            return at + m - (differ.bit_length() + 7) // 8
        at += len(x)
        step = 512
    return min(at, n)


class LoserTree:
    """Merges sorted runs of strings, given with the common prefix of each string with its predecessor in the run.

    ahead[r] is the common prefix of run r's next string with the string put out last on its path. Of two strings
    the one that shares more with it comes first, without a look at either; only at a tie are bytes compared, and only
    from the shared length on."""

    def __init__(self, runs: list[list[bytes]], prefixes: list[list[int]]) -> None:
        self.runs, self.prefixes = runs, prefixes
        self.size = 1 << max(0, len(runs) - 1).bit_length()
        self.next, self.ahead = [0] * self.size, [0] * self.size
        self.head: list[bytes | None] = [runs[r][0] if r < len(runs) and runs[r] else None for r in range(self.size)]
        self.losers = [0] * self.size
        self.winner = self._start(1)

    def _play(self, a: int, b: int) -> tuple[int, int]:
        x, y = self.head[a], self.head[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        ahead = self.ahead
        if ahead[a] != ahead[b]:
            return (a, b) if ahead[a] > ahead[b] else (b, a)
        n = common_prefix(x, y, ahead[a])
        if n == len(x) or (n < len(y) and x[n] < y[n]):
            ahead[b] = n
            return a, b
        ahead[a] = n
        return b, a

    def _start(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        winner, self.losers[node] = self._play(self._start(2 * node), self._start(2 * node + 1))
        return winner

    def __iter__(self) -> Iterator[tuple[int, int, int]]:
        """(run, place in it, common prefix with the string before) in sorted order."""
        while self.head[self.winner] is not None:
            r = self.winner
            at = self.next[r]
            yield r, at, self.ahead[r]
            self.next[r] = at = at + 1
            if at < len(self.runs[r]):
                self.head[r], self.ahead[r] = self.runs[r][at], self.prefixes[r][at]
            else:
                self.head[r] = None
            node = (r + self.size) >> 1
            while node:
                r, self.losers[node] = self._play(r, self.losers[node])
                node >>= 1
            self.winner = r


#: Of an entry (a distinct suffix with what lies before it): size of the suffix's new part, shared prefix, size of what lies before, members, whether it is seen twice; of a member: k1, k2, place.
def _packed(entries: list[tuple[bytes, bytes, set, bool]]) -> bytes:
    """A front-coded segment of a run: [(suffix, before, members, seen twice)] in sorted order."""
    prefix, last = [], b""
    for suffix, *_ in entries:
        prefix.append(common_prefix(last, suffix))
        last = suffix
    ints = np.array([(len(s) - p, p, len(b), len(m), t) for (s, b, m, t), p in zip(entries, prefix, strict=True)], "<i4")
    members = np.array([x for *_, m, _ in entries for x in sorted(m)], "<i8")
    tails = b"".join(s[p:] for (s, *_), p in zip(entries, prefix, strict=True))
    return zstandard.compress(len(entries).to_bytes(4, "little") + ints.T.tobytes() + len(members).to_bytes(4, "little") + members.T.tobytes() + tails + b"".join(e[1] for e in entries), 3)


def _unpacked(blob: bytes) -> tuple[list[bytes], list[int], list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """(suffixes, common prefixes, what lies before, members of each, members, seen twice)."""
    data = zstandard.decompress(blob)
    n = int.from_bytes(data[:4], "little")
    new, prefix, before, count, twice = np.frombuffer(data, "<i4", 5 * n, 4).reshape(5, n)
    at = 4 + 20 * n
    m = int.from_bytes(data[at : at + 4], "little")
    members = np.frombuffer(data, "<i8", 3 * m, at + 4).reshape(3, m).T
    at += 4 + 24 * m
    suffixes, befores, last = [], [], b""
    for size, p in zip(new.tolist(), prefix.tolist(), strict=True):
        suffixes.append(last := last[:p] + data[at : at + size])
        at += size
    for size in before.tolist():
        befores.append(data[at : at + size])
        at += size
    return suffixes, prefix.tolist(), befores, count, members, twice


def _runs(bitmap, splitters, lengths: tuple[int, ...]):
    """Front-coded segments of sorted runs, by ranges of suffixes; the ranges of each length follow those of the one before."""

    def segments(entries: list[dict]) -> Iterator[tuple[int, bytes]]:
        for k, own in enumerate(entries):
            order = sorted(own)
            cuts = [0, *(bisect.bisect_left(order, (s,)) for s in splitters.value), len(order)]
            for part, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                if a < b:
                    yield k * (len(cuts) - 1) + part, _packed([(s, p, *own[s, p]) for s, p in order[a:b]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries: list[dict[tuple[bytes, bytes], list]] = [{} for _ in lengths]
        size, number = 0, TaskContext.get().partitionId() << 24

        def give() -> pa.RecordBatch:
            got = list(segments(entries))
            return pa.record_batch([pa.array([g[0] for g in got], pa.int32()), pa.array([number] * len(got), pa.int64()), pa.array([g[1] for g in got], pa.binary())], names=["part", "run", "blob"])

        for data, keys, starts, sizes, starting in _looks(batches, max(lengths)):
            for which, (at, _, _, h), (own, kind, first, last, slot) in _anchored(data, starts, sizes, starting, lengths):
                bits = bitmap.value[which << (SLOT - 3) : (which + 1) << (SLOT - 3)]
                has = lambda x: ((bits[x >> 3] >> (7 - (x & 7)).astype(np.uint8)) & 1).astype(bool)  # noqa: B023, E731
                hit = np.flatnonzero(has(slot) & has(_slot(h))[own])
                own, kind, first, last = own[hit], kind[hit], first[hit], last[hit]
                new = np.ones(len(own), bool)  # classes that follow each other make one entry
                new[1:] = (own[1:] != own[:-1]) | (kind[1:] != kind[:-1] + 1)
                head = np.flatnonzero(new)
                tail = np.append(head[1:], len(own))[: len(head)] - 1
                own, first, last = own[head], first[tail], last[head]
                doc = np.searchsorted(starts, at[own], side="right") - 1
                for k, p, a, b in zip(doc.tolist(), at[own].tolist(), first.tolist(), last.tolist(), strict=True):
                    k1, k2, place = keys[k]
                    entry = data[p : b + lengths[which]], data[a:p]
                    member = k1, k2, place + p - int(starts[k])
                    if (have := entries[which].get(entry)) is None:
                        entries[which][entry] = [{member}, False]
                        size += len(entry[0]) + len(entry[1]) + 400
                    else:
                        have[0].add(member)
                        have[1] = True
            if size >= RUN:
                yield give()
                entries, size, number = [{} for _ in lengths], 0, number + 1
        if any(entries):
            yield give()

    return run


def _repeated(left: list[bytes], right: list[bytes], group: np.ndarray, twice: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """(entry, first, last) of the runs of windows that occur twice: entries of one group share K bytes, and first and last are places relative to the anchor."""
    sizes = np.array([len(a) + len(b) for a, b in zip(left, right, strict=True)], np.int64)
    before = np.array([len(a) for a in left], np.int64)
    windows = sizes - length + 1
    start = np.cumsum(sizes) - sizes
    buf = np.frombuffer(b"".join(x for pair in zip(left, right, strict=True) for x in pair), np.uint8)
    total = _totals(buf)
    entry = np.repeat(np.arange(len(sizes)), windows)
    place = np.arange(len(entry)) - np.repeat(np.cumsum(windows) - windows, windows)
    at = start[entry] + place
    h = mix64((total[at + length] - total[at]) * _powers(_INVERSE, len(buf) + 1)[at]) ^ mix64(group[entry].astype(np.uint64))
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    hit = np.repeat(twice.astype(bool), windows)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    head = hit & ~(np.concatenate([[False], hit[:-1]]) & (np.diff(entry, prepend=-1) == 0))
    tail = hit & ~(np.concatenate([hit[1:], [False]]) & (np.diff(entry, append=-1) == 0))
    offset = place - before[entry]
    return [entry[head], offset[head], offset[tail]]


def _merge(lengths: tuple[int, ...], ranges: int):
    def merge(group: pd.DataFrame) -> pd.DataFrame:
        """Bytes that the suffixes of one range show to be repeated (k1, k2, length, begin, end)."""
        length = lengths[int(group["part"].iloc[0]) // ranges]
        runs = [_unpacked(b) for b in group.sort_values("run")["blob"]]
        member_at = [np.concatenate([[0], np.cumsum(r[3])]) for r in runs]
        found: list[np.ndarray] = []

        def settle(pending: list[tuple[int, int]], groups: list[int]) -> None:
            left, right = [runs[r][2][i] for r, i in pending], [runs[r][0][i] for r, i in pending]
            twice = np.array([runs[r][5][i] for r, i in pending])
            entry, first, last = _repeated(left, right, np.array(groups), twice, length)
            members = np.concatenate([runs[r][4][member_at[r][i] : member_at[r][i + 1]] for r, i in pending])
            count = np.array([runs[r][3][i] for r, i in pending], np.int64)
            n = count[entry]
            row = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - (np.cumsum(count) - count)[entry], n)
            at = members[row, 2]
            found.append(np.stack([members[row, 0], members[row, 1], np.full(len(row), length), at + np.repeat(first, n), at + np.repeat(last, n) + length], axis=1))

        pending, groups, windows, same, number, n_same = [], [], 0, [], 0, 0
        for r, i, shared in LoserTree([x[0] for x in runs], [x[1] for x in runs]):
            if shared < K and same:
                if len(same) > 1 or runs[same[0][0]][5][same[0][1]]:
                    if windows + n_same > WINDOWS and pending:
                        settle(pending, groups)
                        pending, groups, windows = [], [], 0
                    pending += same
                    groups += [number] * len(same)
                    windows += n_same
                same, number, n_same = [], number + 1, 0
            same.append((r, i))
            n_same += len(runs[r][0][i]) + len(runs[r][2][i]) - length + 1
        if len(same) > 1 or (same and runs[same[0][0]][5][same[0][1]]):
            pending += same
            groups += [number] * len(same)
        if pending:
            settle(pending, groups)
        return pd.DataFrame(np.concatenate(found) if found else np.zeros((0, 5), np.int64), columns=["k1", "k2", "length", "begin", "end"]).drop_duplicates()

    return merge


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The maximal runs that the spans cover."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((begin, end))
    return out


def _cut(spans_: str, length: int, shorter: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, texts = [], []
            for text, spans in zip(b.column("text").to_pylist(), b.column(spans_).to_pylist(), strict=True):
                data, kept, at = (text or "").encode(), [], 0
                gone = _union([(s["begin"], s["end"]) for s in spans or [] if s["length"] == length])
                for begin, end in gone:
                    kept.append(data[at:begin])
                    at = end
                kept = b"".join([*kept, data[at:]])
                out.append((len(data), len(data) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), sum(e - a for a, e in _union([(s["begin"], s["end"]) for s in spans or [] if s["length"] == shorter]))))
                texts.append(None if text is None else kept.decode("utf-8", "ignore") if gone else text)
            names, kinds = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "n_repeated"), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64())
            columns = {n: b.column(n) for n in b.schema.names if n not in ("text", spans_)}
            columns |= {n: pa.array([o[k] for o in out], kind) for k, (n, kind) in enumerate(zip(names, kinds, strict=True)) if shorter or n != "n_repeated"}
            yield pa.record_batch([*columns.values(), pa.array(texts, pa.string())], names=[*columns, "text"])

    return run


def _keys(text: Column) -> dict[str, Column]:
    """Two hashes of a text, which stand for it: what is removed depends on the text alone."""
    text = F.coalesce(text, F.lit(""))
    return {"k1": F.xxhash64(text), "k2": F.xxhash64(F.lit(400), text)}


def repeats(docs: DataFrame, *lengths: int) -> DataFrame:
    """k1, k2, length, begin, end: byte ranges of the texts (by their _keys) that strings of one of the lengths cover which start anywhere else too."""
    spark, lengths = docs.sparkSession, lengths or (LENGTH,)
    if min(lengths) < 2 * K:
        raise ValueError(f"passages have {2 * K} bytes at least")
    texts = docs.select("text").withColumns(_keys(F.col("text")))
    noted = texts.mapInArrow(_note(lengths), "block int, once binary, more binary").groupBy(F.floor(F.col("block") / BLOCKS)).applyInPandas(_combine, "block int, bits binary").collect()
    bitmap, total, samples = np.zeros(len(lengths) << (SLOT - 3), np.uint8), 0, []
    for r in noted:
        if r.block >= 0:
            bitmap[r.block << (BLOCK - 3) : (r.block + 1) << (BLOCK - 3)] = np.frombuffer(zstandard.decompress(bytes(r.bits)), np.uint8)
        elif r.block == -1:
            total = int.from_bytes(bytes(r.bits), "little")
        else:
            samples.append(bytes(r.bits))
    samples.sort()
    ranges = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), total // RANGE)
    splitters = sorted({samples[k * len(samples) // ranges] for k in range(1, ranges)}) if samples else []
    given = spark.sparkContext.broadcast(bitmap), spark.sparkContext.broadcast(splitters)
    runs = texts.mapInArrow(_runs(*given, lengths), "part int, run long, blob binary")
    return runs.groupBy("part").applyInPandas(_merge(lengths, len(splitters) + 1), "k1 long, k2 long, length int, begin long, end long")


def dedup(docs: DataFrame, length: int = LENGTH, shorter: int | None = None) -> DataFrame:
    """docs with its text cut, and n_bytes, n_removed, n_spans, kept_sha256 (of the bytes that stay).

    Every byte of a text, as UTF-8, goes that a string of `length` bytes covers which also starts anywhere else, in the same text or
    another; strings are judged on the input. A null text has no bytes and stays null; shorter texts stay; copies of
    a text all lose it. Where a cut splits a character, its other bytes are left out of the text, not of the digest. Columns
    of the names that are added are replaced. A row's result depends on its text alone, so ties and repeated rows need no rule.
    Very long texts are looked at in pieces, and need room for themselves in a task.
    With `shorter`, n_repeated counts the bytes that strings of that many bytes cover which start anywhere else too; they stay.
    """
    added = {"n_bytes": "long", "n_removed": "long", "n_spans": "long", "kept_sha256": "string"} | ({"n_repeated": "long"} if shorter else {})
    own = docs.drop(*added)
    k1, k2, spans = fresh(own, "k1", "k2", "spans")
    lengths = (length, shorter) if shorter else (length,)
    found = stored(repeats(docs, *lengths).groupBy("k1", "k2").agg(F.collect_set(F.struct("length", "begin", "end")).alias(spans)).withColumnsRenamed({"k1": k1, "k2": k2}), "suffix-spans")
    keys = _keys(F.col("text"))
    both = own.withColumns({k1: keys["k1"], k2: keys["k2"]}).join(found, [k1, k2], "left").drop(k1, k2)
    schema = ", ".join([f"`{n}` {t}" for n, t in own.dtypes if n != "text"] + [f"{n} {t}" for n, t in added.items()] + ["text string"])
    return both.mapInArrow(_cut(spans, length, shorter), schema).select(*own.columns, *added)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 400-byte removal; n_repeated counts what a removal by 200 bytes would reach, passages of over fifty words among them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup(docs, LENGTH, SHORT).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_repeated")
