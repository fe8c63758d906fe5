"""Joins of documents by the Jaccard similarity of their sets of five-word shingles; no link is lost.

1. Copies collapse: documents with the same set are one node.
2. Documents that can have a partner: two sets of similarity 0.8 share `need` or more of the first
   n - ceil(0.8 n) + need shingles in the order of their hashes. Only hashes are exchanged, packed; a set
   whose leading shingles are too seldom shared takes no further part. The sets left are known by a Bloom filter of 40-bit tags;
   sets that it lets through by chance only cost room. A set travels as its text, compressed, which is a third of
   its hashes, and is made again where it is needed.
3. Communities: over what is left, shingles are ordered by the number of sets that hold them, rarest first. Linked sets
   share one of their first n - ceil(0.8 n) + 1; those that only one set holds drop out at once. Sets that share one are joined
   into communities, which hold all links. Here 48 bits stand for a shingle: hashes that are cut alike only join communities.
4. T-occurrence search inside each community, by pairs of blocks of bounded size: a set's short inverted lists are
   merged, its long ones probed (DivideSkip), and the sets that reach the overlap are linked. Merging counts the lists' entries
   in one array instead of a heap, which gives the same counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import discard, fresh, mix64, rows, stored, table
from .graph import components
from .suffixes import _BASE, _INVERSE, _LETTER, _powers

WORDS, PERCENT = 5, 80
#: Bytes of text looked at a time, shingles of a block of a community and of a bucket or task on average, most bits of the filter of sets (32 MB).
PIECE, BLOCK, SHARE, MOST_BITS = 1 << 20, 1 << 20, 1 << 20, 1 << 28
#: Shingles that a task packs at a time.
PACKED = 1 << 20
#: Sets of the sample that finds hot shingles, how many of them hold a hot one, most hot ones (16 bytes each).
HOT_SAMPLE, HOT_SEEN, MOST_HOT = 1 << 14, 16, 1 << 18
#: A tag that no set has: stands for two or more sets of one task.
MARK = np.uint64(1 << 40)
#: DivideSkip's weight of the length of the longest list.
MU = 0.01


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """For each text the sorted 64-bit hashes of its distinct shingles, A-Z lower-cased; fewer words than five are one."""
    datas = [(t or "").encode().lower() for t in texts]
    buf = np.frombuffer(b" ".join([*datas, b""]), np.uint8)
    sizes = np.array([len(d) + 1 for d in datas], np.int64)
    space = (buf == 32) | ((buf >= 9) & (buf <= 13))
    edge = np.diff(np.concatenate([[True], space]).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    power = _powers(_BASE, len(buf) + 1)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_LETTER[buf] * power[:-1], out=total[1:])
    word = mix64((total[end] - total[start]) * _powers(_INVERSE, len(buf) + 1)[start])
    doc = np.searchsorted(np.cumsum(sizes), start, side="right")
    first = np.searchsorted(doc, np.arange(len(datas) + 1))
    run = word[: max(0, len(word) - WORDS + 1)].copy()
    for k in range(1, WORDS):
        run = run * np.uint64(_BASE) + word[k : len(word) - WORDS + 1 + k]
    run = mix64(run)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= WORDS:
            out.append(np.unique(run[a : b - WORDS + 1]))
        else:
            out.append(np.array([xxhash.xxh3_64_intdigest(word[a:b].tobytes(), seed=b - a)] if b > a else [], np.uint64))
    return out


def _looks(batches: Iterator[pa.RecordBatch], extra: list[str]) -> Iterator[tuple[list[tuple], list[np.ndarray]]]:
    """(values of the extra columns, sets) of a few MB of texts at a time."""
    for b in rows(batches, PIECE):
        yield list(zip(*(b.column(c).to_pylist() for c in extra), strict=True)) if extra else [()] * b.num_rows, shingle_sets(b.column("text").to_pylist())


def _sid(s: np.ndarray) -> bytes:
    """128-bit digest of a set; its first five bytes are its tag."""
    return xxhash.xxh3_128_digest(s.tobytes())


def _tag(sid: bytes) -> int:
    return int.from_bytes(sid[:5], "big")


def _ids(extra: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for values, sets in _looks(batches, extra):
            columns = [pa.array([v[k] for v in values], pa.int64()) for k in range(len(extra))]
            yield pa.record_batch([*columns, pa.array([len(s) for s in sets], pa.int64()), pa.array([_sid(s) if len(s) else None for s in sets], pa.binary())], names=[*extra, "n_shingles", "sid"])

    return run


def least_overlap(n):
    """ceil(0.8 n): the least overlap of a set of n with any partner."""
    return -(-PERCENT * n // 100)


def need(n):
    """Leading shingles, over the bare prefix, that are exchanged in the order of hashes, and so must be shared.

    A tenth of the set: then more than a quarter of the leading shingles must be shared, which the chance
    sharing of common word sequences does not reach, however large the corpus."""
    return 1 + n // 10


def _dealt(key: np.ndarray, buckets: int) -> list[tuple[int, np.ndarray]]:
    """Buckets of the keys' high bits, and which keys they have."""
    at = ((key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(key, kind="stable")
    cuts = np.searchsorted(at[order], np.arange(buckets + 1))
    return [(k, order[a:b]) for k, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)) if a < b]


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of equal length, the first sorted (its differences are kept); bytes of one place lie together."""
    n = len(columns[0])
    parts = [np.diff(columns[0], prepend=columns[0].dtype.type(0)), *columns[1:]]
    return n.to_bytes(4, "little") + zstandard.compress(b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(n, -1).T.tobytes() for c in parts), 1)


def _unpack(blob: bytes, *kinds) -> list[np.ndarray]:
    n, data, at, out = int.from_bytes(blob[:4], "little"), zstandard.decompress(blob[4:]), 0, []
    for kind in kinds:
        size = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(np.frombuffer(data, np.uint8, n * size, at).reshape(size, n).T).view(kind).ravel())
        at += n * size
    out[0] = np.cumsum(out[0], dtype=out[0].dtype)
    return out


def _blobs(found: list[tuple[int, bytes]], key: str) -> pa.RecordBatch:
    return pa.record_batch([pa.array([k for k, _ in found], pa.int32()), pa.array([b for _, b in found], pa.binary())], names=[key, "blob"])


def _least_of(tags: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct tags, how often each occurs, its least requirement): sets whose tags collide are held to the lower one."""
    order = np.argsort(tags, kind="stable")
    tags, least = tags[order], least[order]
    head = np.flatnonzero(np.concatenate([[True], tags[1:] != tags[:-1]])) if len(tags) else np.zeros(0, np.int64)
    return tags[head], np.diff(np.append(head, len(tags))), np.minimum.reduceat(least, head) if len(tags) else least


def _counted(h: np.ndarray, tag: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order of the distinct pairs of hash and tag, which of them have a hash of more than one tag); MARK stands for two tags."""
    order = np.lexsort((tag, h))
    new = np.concatenate([[True], (h[order][1:] != h[order][:-1]) | (tag[order][1:] != tag[order][:-1])])
    # of equal pairs the least requirement stays
    starts = np.flatnonzero(new)
    least[order[starts]] = np.minimum.reduceat(least[order], starts)
    order = order[starts]
    head = np.concatenate([[True], h[order][1:] != h[order][:-1]])
    group = np.cumsum(head) - 1
    often = (np.bincount(group) > 1) | (np.bincount(group, weights=tag[order] == MARK) > 0)
    return order, often[group]


def _tag_blobs(tag: np.ndarray, least: np.ndarray, buckets: int) -> list[tuple[int, bytes]]:
    tags, count, low = _least_of(tag, least)
    return [(k, _pack(tags[i], np.minimum(count[i], 65535).astype(np.uint16), low[i])) for k, i in _dealt(tags << np.uint64(24), buckets)]


def _leading(buckets: int):
    """Leading shingles by hash: blobs (48 bits of the hash, tag, least count of shared ones) by buckets of the hash. Hashes that are cut alike only keep a set that could go.

    What a task's own sets share is counted before it is sent: such a hash goes out once, as MARK, and its
    tags with their counts (kind 1) to the buckets of tags, so that a hash of very many sets is no large group anywhere.
    Copies of a set in several tasks may add the same share more than once, which only keeps it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def give() -> pa.RecordBatch:
            h, tag, least = (np.concatenate(c) for c in zip(*parts, strict=True))
            h = h >> np.uint64(16)
            order, often = _counted(h, tag, least)
            h, tag, least = h[order], tag[order], least[order]
            own = [(k, 1, b) for k, b in _tag_blobs(tag[often], least[often], buckets)]
            marks = np.unique(h[often])
            h = np.concatenate([h[~often], marks])
            tag, least = np.concatenate([tag[~often], np.full(len(marks), MARK, np.uint64)]), np.concatenate([least[~often], np.full(len(marks), 255, np.uint8)])
            out = own + [(k, 0, _pack(h[i], tag[i], least[i])) for k, i in _dealt(h << np.uint64(16), buckets)]
            return pa.record_batch([pa.array([o[k] for o in out], kind) for k, kind in enumerate((pa.int32(), pa.int32(), pa.binary()))], names=["bucket", "kind", "blob"])

        for _, sets in _looks(batches, []):
            for s in sets:
                if not len(s) or (sid := _sid(s)) in seen:
                    continue
                if len(seen) < 1_000_000:
                    seen.add(sid)
                n = len(s)
                lead = s[: n - least_overlap(n) + need(n)]
                parts.append((lead, np.full(len(lead), _tag(sid), np.uint64), np.full(len(lead), min(255, need(least_overlap(n))), np.uint8)))
                size += len(lead)
            if size > PACKED:
                yield give()
                parts, size = [], 0
        if parts:
            yield give()

    return run


def _shared(buckets: int):
    """From the blobs of a bucket of hashes: how many of its shingles each tag shares with another, by buckets of tags."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        out = [(int(group["bucket"].iloc[0]), b) for b in group["blob"][group["kind"] == 1]]
        if blobs := list(group["blob"][group["kind"] == 0]):
            h, tag, least = (np.concatenate(c) for c in zip(*(_unpack(b, np.uint64, np.uint64, np.uint8) for b in blobs), strict=True))
            order, often = _counted(h, tag, least)
            order = order[often & (tag[order] != MARK)]
            out += _tag_blobs(tag[order], least[order], buckets)
        return pd.DataFrame(out, columns=["bucket", "blob"]).astype({"bucket": "int32"})

    return run


def _enough(group: pd.DataFrame) -> pd.DataFrame:
    """The tags of a bucket whose shared leading shingles reach the least requirement that any blob has for them."""
    tag, count, least = (np.concatenate(c) for c in zip(*(_unpack(b, np.uint64, np.uint16, np.uint8) for b in group["blob"]), strict=True))
    tags, back = np.unique(tag, return_inverse=True)
    return pd.DataFrame({"tag": tags[np.bincount(back, weights=count) >= _least_of(tag, least)[2]].astype(np.int64)})


def _places(tag: np.ndarray, bits: int) -> list[np.ndarray]:
    """The two bits of a Bloom filter that stand for each tag."""
    h = mix64(tag.astype(np.uint64))
    return [(h & np.uint64(bits - 1)).astype(np.int64), ((h >> np.uint64(32)) & np.uint64(bits - 1)).astype(np.int64)]


def _marks(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.unique(np.concatenate(_places(b.column("tag").to_numpy(), bits)))
            cuts = np.flatnonzero(np.diff(at >> 16, prepend=-1)).tolist()
            yield _blobs([(int(at[i]) >> 16, (at[i:j] & 0xFFFF).astype("<u2").tobytes()) for i, j in zip(cuts, [*cuts[1:], len(at)], strict=True)], "bucket")

    return run


def _block_of(group: pd.DataFrame) -> pd.DataFrame:
    set_ = np.zeros(1 << 16, bool)
    set_[np.frombuffer(b"".join(group["blob"]), "<u2")] = True
    return pd.DataFrame({"bucket": group["bucket"].iloc[:1], "blob": [np.packbits(set_).tobytes()]})


def _filter(tags: DataFrame):
    """A broadcast Bloom filter of the tags, of 2^16 to MOST_BITS bits; fuller ones only let more sets through."""
    bits = min(MOST_BITS, 1 << max(16, (16 * tags.count()).bit_length()))
    given = np.zeros(bits >> 3, np.uint8)
    for r in tags.mapInArrow(_marks(bits), "bucket int, blob binary").groupBy("bucket").applyInPandas(_block_of, "bucket int, blob binary").collect():
        given[r.bucket << 13 : (r.bucket + 1) << 13] = np.frombuffer(bytes(r.blob), np.uint8)
    return tags.sparkSession.sparkContext.broadcast(given)


def _sets(given):
    """The sets (sid, n, compressed text, from which the set is made again) of a task's texts that the filter lets through, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for texts, sets in _looks(batches, ["text"]):
            sids = [_sid(s) if len(s) else b"\0" * 16 for s in sets]
            ok = np.ones(len(sets), bool)
            for at in _places(np.array([_tag(s) for s in sids], np.uint64), 8 * len(given.value)):
                ok &= ((given.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).astype(bool)
            out = []
            for (text,), s, sid, fits in zip(texts, sets, sids, ok.tolist(), strict=True):
                if not fits or not len(s) or sid in seen:
                    continue
                if len(seen) < 1_000_000:
                    seen.add(sid)
                out.append((sid, len(s), zstandard.compress(text.encode(), 3)))
            yield pa.record_batch([pa.array([o[k] for o in out], kind) for k, kind in enumerate((pa.binary(), pa.int64(), pa.binary()))], names=["sid", "n", "packed"])

    return run


def _again(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    """(node, set) of rows (node, packed), by a few MB of texts at a time."""
    nodes, texts, size = [], [], 0
    for b in batches:
        for node, packed in zip(b.column("node").to_pylist(), b.column("packed").to_pylist(), strict=True):
            nodes.append(node)
            texts.append(zstandard.decompress(packed).decode())
            size += len(texts[-1])
            if size > PIECE:
                yield from zip(nodes, shingle_sets(texts), strict=True)
                nodes, texts, size = [], [], 0
    yield from zip(nodes, shingle_sets(texts), strict=True)


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles (48 bits of their hashes) of a task's sets with their number; of a sample."""
    found, parts, size = [], [], 0
    for _, s in _again(batches):
        parts.append(s >> np.uint64(16))
        size += len(s)
        if size > 2 * PACKED:
            found.append(np.unique(np.concatenate(parts), return_counts=True))
            parts, size = [], 0
    found += [np.unique(np.concatenate(parts), return_counts=True)] if parts else []
    for h, n in found:
        yield pa.record_batch([pa.array(h.astype(np.int64)), pa.array(n.astype(np.int64))], names=["hash", "n"])


def _hot(sets: DataFrame, count: int):
    """A broadcast list of the shingles that are most frequent in a sample of the sets, with their number there, sorted by hash.

    They come last in the order of shingles, by that number, and are not counted in the corpus, so that no shingle of very many
    sets meets in one task. The order is the same for all sets, whatever the list holds."""
    rate = F.lit(min(1.0, HOT_SAMPLE / max(1, count)) * 2**40)
    sample = sets.filter(F.pmod(F.xxhash64(F.lit(11), "sid"), F.lit(1 << 40)) < rate).select("node", "packed")
    seen = sample.mapInArrow(_tokens, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n")).filter(F.col("n") >= HOT_SEEN)
    top = seen.orderBy(F.desc("n"), "hash").limit(MOST_HOT).collect()
    pairs = np.array(sorted((r.hash, r.n) for r in top), np.int64).reshape(-1, 2)
    return sets.sparkSession.sparkContext.broadcast((pairs[:, 0].astype(np.uint64), pairs[:, 1]))


def _found(h: np.ndarray, hot: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(which hashes are hot, their number in the sample)."""
    hashes, number = hot
    if not len(hashes):
        return np.zeros(len(h), bool), np.zeros(len(h), np.int64)
    at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
    return hashes[at] == h, number[at]


def _postings(buckets: int, hot):
    """Blobs (48 bits of a shingle's hash, node, size of its set) by buckets of the hash, or of the node where the shingle is hot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0

        def give() -> pa.RecordBatch:
            h, node, n = (np.concatenate(c) for c in zip(*parts, strict=True))
            h = h >> np.uint64(16)
            often, _ = _found(h, hot.value)
            out = []
            for which, key in ((~often, h << np.uint64(16)), (often, mix64(node))):
                own = np.flatnonzero(which)
                for k, i in _dealt(key[own], buckets):
                    i = own[i]
                    i = i[np.argsort(h[i], kind="stable")]
                    out.append((k, _pack(h[i], node[i], n[i])))
            return _blobs(out, "bucket")

        for node, s in _again(batches):
            parts.append((s, np.full(len(s), node, np.int64), np.full(len(s), len(s), np.int32)))
            size += len(s)
            if size > PACKED:
                yield give()
                parts, size = [], 0
        if parts:
            yield give()

    return run


def _frequent(buckets: int, hot):
    """Shingles of a bucket that two sets or more hold, with their number, back to the sets."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        h, node, n = (np.concatenate(c) for c in zip(*(_unpack(b, np.uint64, np.int64, np.int32) for b in group["blob"]), strict=True))
        order = np.argsort(h, kind="stable")
        h, node, n = h[order], node[order], n[order]
        head = np.concatenate([[True], h[1:] != h[:-1]])
        count = np.bincount(np.cumsum(head) - 1)[np.cumsum(head) - 1]
        known, number = _found(h, hot.value)
        count = np.where(known, (1 << 30) + np.minimum(number, (1 << 30) - 1), np.minimum(count, (1 << 30) - 1))
        often = count > 1
        h, node, n, count = h[often], node[often], n[often], count[often]
        out = []
        for k, i in _dealt(mix64(node), buckets):
            i = i[np.argsort(node[i], kind="stable")]
            out.append((k, _pack(node[i], h[i], n[i], count[i].astype(np.int32))))
        return pd.DataFrame(out, columns=["bucket", "blob"]).astype({"bucket": "int32"})

    return run


def _rarest(group: pd.DataFrame) -> pd.DataFrame:
    """hash, node: the leading shingles of each set in the order of their frequency, without those that it alone holds."""
    node, h, n, count = (np.concatenate(c) for c in zip(*(_unpack(b, np.int64, np.uint64, np.int32, np.int32) for b in group["blob"]), strict=True))
    order = np.lexsort((h, count, node))
    node, h, n = node[order], h[order], n[order]
    start = np.concatenate([[True], node[1:] != node[:-1]])
    at = np.flatnonzero(start)
    held = np.diff(np.append(at, len(node)))
    place = np.arange(len(node)) - np.repeat(at, held) + np.repeat(n[at] - held, held)
    lead = place < n - least_overlap(n.astype(np.int64)) + 1
    return pd.DataFrame({"hash": h[lead].astype(np.int64), "node": node[lead]})


class Inverted:
    """Inverted lists over sets, for T-occurrence search."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.sizes = np.array([len(s) for s in sets], np.int64)
        h = np.concatenate(sets)
        order = np.argsort(h, kind="stable")
        self.hashes, first = np.unique(h[order], return_index=True)
        self.docs = np.repeat(np.arange(len(sets)), self.sizes)[order]
        self.starts, self.ends = first, np.append(first[1:], len(h))

    def search(self, s: np.ndarray) -> np.ndarray:
        """The sets that s links with: 100 * overlap >= 80 * union.

        Of the lists of s the L longest are put aside; what occurs T - L times in the others, which are merged, is
        then looked up in the long ones by binary search, where it can still reach T."""
        at = np.searchsorted(self.hashes, s)
        at = at[(at < len(self.hashes)) & (self.hashes[np.minimum(at, len(self.hashes) - 1)] == s)]
        t = least_overlap(len(s))
        if len(at) < t:
            return np.zeros(0, np.int64)
        lengths = self.ends[at] - self.starts[at]
        order = np.argsort(lengths, kind="stable")
        aside = min(t - 1, int(t / (MU * np.log2(max(2, lengths[order[-1]])) + 1)))
        short, long = at[order[: len(at) - aside]], at[order[len(at) - aside :]]
        sizes = self.ends[short] - self.starts[short]
        merged = self.docs[np.arange(sizes.sum()) + np.repeat(self.starts[short] - np.cumsum(sizes) + sizes, sizes)]
        count = np.bincount(merged, minlength=len(self.sizes))
        found = np.flatnonzero(count >= max(1, t - aside))
        found = found[(PERCENT * self.sizes[found] <= 100 * len(s)) & (PERCENT * len(s) <= 100 * self.sizes[found])]
        overlap = count[found]
        for k, j in enumerate(long):
            if not len(found):
                break
            docs = self.docs[self.starts[j] : self.ends[j]]
            place = np.searchsorted(docs, found)
            overlap = overlap + (docs[np.minimum(place, len(docs) - 1)] == found)
            still = overlap + (len(long) - k - 1) >= t
            found, overlap = found[still], overlap[still]
        return found[100 * overlap >= PERCENT * (len(s) + self.sizes[found] - overlap)]


def links(left: list[np.ndarray], right: list[np.ndarray] | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links between two lists of sets (right's numbers follow left's), or inside one."""
    index, n = Inverted(right if right is not None else left), len(left)
    parent = list(range(n + (len(right) if right is not None else 0)))

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    out = []
    for k, s in enumerate(left):
        for j in index.search(s).tolist():
            j += n if right is not None else 0
            a, b = root(k), root(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((k, j))
    return out


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of the pairs of blocks (community, i, j), which arrive one after the other."""
    key, members = None, []

    def give() -> pa.RecordBatch:
        _, i, j = key
        block = np.array([m[0] for m in members])
        both = list(_again(iter([pa.record_batch([pa.array([m[1] for m in members], pa.int64()), pa.array([m[2] for m in members], pa.binary())], names=["node", "packed"])])))
        own, other = [both[k] for k in np.flatnonzero(block == i)], [both[k] for k in np.flatnonzero(block == j)]
        nodes = [m[0] for m in own] + ([m[0] for m in other] if i != j else [])
        found = links([m[1] for m in own], [m[1] for m in other] if i != j else None) if own and other else []
        return pa.record_batch([pa.array([nodes[x] for x, _ in found], pa.int64()), pa.array([nodes[y] for _, y in found], pa.int64())], names=["a", "b"])

    for b in batches:
        for community, i, j, block, node, packed in zip(*(b.column(c).to_pylist() for c in ("community", "i", "j", "block", "node", "packed")), strict=True):
            if (community, i, j) != key:
                if members:
                    yield give()
                key, members = (community, i, j), []
            members.append((block, node, packed))
    if members:
        yield give()


def link_sets(texts: DataFrame, shingles: int) -> DataFrame:
    """sid, component (a number of the linked sets' component): for the sets of texts (text) that link with another.

    shingles: about how many all sets have together; buckets are so many that each holds some SHARE of them."""
    spark = texts.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(tasks, -(-3 * shingles // (10 * SHARE)))
    leading = texts.select("text").mapInArrow(_leading(buckets), "bucket int, kind int, blob binary").groupBy("bucket").applyInPandas(_shared(buckets), "bucket int, blob binary")
    tags = stored(leading.groupBy("bucket").applyInPandas(_enough, "tag long"), "jaccard-tags")
    given = _filter(tags)
    found = texts.select("text").mapInArrow(_sets(given), "sid binary, n long, packed binary")
    sets = stored(found.groupBy("sid").agg(F.first("n").alias("n"), F.first("packed").alias("packed")).withColumn("node", F.monotonically_increasing_id()), "jaccard-sets")
    size = sets.agg(F.count("*").alias("sets"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    buckets, hot = max(tasks, -(-size.n // SHARE)), _hot(sets, size.sets)
    often = sets.select("node", "packed").mapInArrow(_postings(buckets, hot), "bucket int, blob binary").groupBy("bucket").applyInPandas(_frequent(buckets, hot), "bucket int, blob binary")
    lead = stored(often.groupBy("bucket").applyInPandas(_rarest, "hash long, node long"), "jaccard-lists")
    least = lead.groupBy("hash").agg(F.min("node").alias("b"), F.count("*").alias("n")).filter("n > 1")
    community = stored(components(lead.join(least, "hash").select(F.col("node").alias("a"), "b")), "jaccard-communities")
    sized = stored(community.join(sets.select("node", "n"), "node"), "jaccard-sized")
    whole = sized.groupBy("component").agg(F.ceil(F.sum("n") / BLOCK).alias("blocks"), F.sum("n").alias("total"))
    shipped = whole.agg(F.coalesce(F.sum(F.col("total") * F.col("blocks")), F.lit(0)).alias("n")).first().n
    blocks = sized.join(whole, "component").select("node", F.col("component").alias("community"), "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block"))
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("o")
    met = blocks.join(sets.select("node", "packed"), "node").select("node", "packed", "community", "block", others).withColumns({"i": F.least("block", "o"), "j": F.greatest("block", "o")})
    dealt = met.repartition(max(tasks, -(-int(shipped) // SHARE)), "community", "i", "j").sortWithinPartitions("community", "i", "j", "node")
    linked = components(dealt.mapInArrow(_search, "a long, b long"))
    out = stored(linked.join(sets.select("node", "sid"), "node").select("sid", "component"), "jaccard-components")
    discard(tags, sets, lead, community, sized)
    return out


def component_ids(docs: DataFrame, extra: list[str]) -> DataFrame:
    """doc_id, the extra long columns, n_shingles, sid, component_id, part for each row of docs (doc_id, text, extra).

    component_id is the smallest doc_id that links lead to, itself included; rows with equal sets are linked. A row
    without words or text has an empty set, no sid, no part, and its own doc_id. part names the component even where ids repeat. A null doc_id is kept and is never the smallest
    unless all are null; repeated rows each get a row."""
    ids = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), *extra, "text").mapInArrow(_ids(["doc_id", *extra]), ", ".join(f"{c} long" for c in ["doc_id", *extra]) + ", n_shingles long, sid binary"), "jaccard-ids")
    same = ids.filter("sid IS NOT NULL").groupBy("sid").agg(F.min("doc_id").alias("low"))
    linked = link_sets(docs, int(ids.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]))
    lows = linked.join(same, "sid").groupBy("component").agg(F.min("low").alias("component_low"))
    found = linked.join(lows, "component").select("sid", "component_low", F.col("component").cast("string").alias("part"))
    # stored, so that the last join has plain sides, of which Spark splits the part of a set that very many rows have
    by_set = stored(same.join(found, "sid", "left").select("sid", F.coalesce("component_low", "low").alias("component_id"), F.coalesce("part", F.hex("sid")).alias("part")), "jaccard-by-set")
    return ids.join(by_set, "sid", "left").withColumn("component_id", F.when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, of which one of each component stays: that of the smallest doc_id.

    Of rows with that doc_id the one with the least hashes of its text stays, and of repeated rows one. Rows without words all stay;
    a null doc_id stays only where its component has no other."""
    text = F.coalesce("text", F.lit(""))
    k1, k2, dk, number = fresh(docs, "k1", "k2", "dk", "number")
    key = docs.withColumns({k1: F.xxhash64(text), k2: F.xxhash64(F.lit(7), text), dk: F.coalesce(F.col("doc_id").cast("string"), F.lit(""))})
    ids = component_ids(key.select("doc_id", "text", F.col(k1).alias("k1"), F.col(k2).alias("k2")), ["k1", "k2"])
    first = ids.filter("sid IS NOT NULL").groupBy("part").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2")).alias("w"))
    winners = first.select(F.col("w.k1").alias(k1), F.col("w.k2").alias(k2), F.coalesce(F.col("w.doc_id").cast("string"), F.lit("")).alias(dk))
    one = F.row_number().over(W.partitionBy(k1, k2, dk).orderBy(*[c for c in ("lang", "source", "n_chars") if c in docs.columns] or [dk]))
    with_words = key.join(winners, [k1, k2, dk]).withColumn(number, one).filter(F.col(number) == 1).select(*docs.columns)
    return with_words.unionByName(docs.filter(~text.rlike(r"[^\x20\x09-\x0D]")))


def op7_jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return component_ids(table(spark, sf_dir, "documents").select("doc_id", "text"), []).select("doc_id", "n_shingles", "component_id")
