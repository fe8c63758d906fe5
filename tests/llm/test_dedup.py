import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from lagweave.llm import jaccard, suffixes
from lagweave.llm.graph import components


def prose(seed, n):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefgh") for _ in range(draw.randrange(2, 8))) for _ in range(n))


# suffix dedup ------------------------------------------------------------------------------------------------------------


def brute_repeats(texts, n=400):
    datas = [(t or "").encode() for t in texts]
    seen = Counter(d[s : s + n] for d in datas for s in range(len(d) - n + 1))
    out = []
    for d in datas:
        cover = np.zeros(len(d), bool)
        for s in range(len(d) - n + 1):
            if seen[d[s : s + n]] > 1:
                cover[s : s + n] = True
        kept = bytes(b for b, c in zip(d, cover, strict=True) if not c)
        out.append((len(d), int(cover.sum()), int((np.diff(np.concatenate([[0], cover.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def test_lengths_against_brute_force(spark):
    """Passages of 51 to 80 words, shorter than 400 bytes for the most part, and the length at its edges."""
    passages = [prose(30 + k, 51 + 3 * k) for k in range(10)]
    texts = [f"{prose(50 + k, 40)} {passages[k % 10]} {prose(80 + k, 30 + k)}" for k in range(30)] + [passages[0][:199], passages[0][:200], passages[0][1:201], None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    short, long = brute_repeats(texts, 200), brute_repeats(texts, 400)
    got = {r.doc_id: r for r in suffixes.dedup(docs, 200).collect()}
    assert [tuple(got[k][c] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")) for k in range(len(texts))] == short
    assert all(p[1:-1] not in got[k].text for k in range(30) for p in passages)
    both = {r.doc_id: r for r in suffixes.dedup(docs, 400, 200).collect()}
    assert [tuple(both[k][c] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")) for k in range(len(texts))] == long
    assert [both[k].n_repeated for k in range(len(texts))] == [s[1] for s in short]


def test_repeats_against_brute_force(spark):
    shared, other = prose(1, 120), "é" * 250
    texts = [
        None, "", "short", prose(2, 90), prose(2, 90), prose(3, 50) + shared + prose(4, 60), shared, prose(5, 10) + shared, shared[:399], shared[:400], shared[3:404],
        "ab" * 700, "x" * 399, "x" * 400, "x" * 401, prose(6, 40) + other, other + prose(7, 40), prose(8, 100) + " mid " + prose(8, 100), prose(9, 3000), shared[-410:] + shared[:410],
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.dedup(docs).collect()}
    assert [got[k] for k in range(len(texts))] == brute_repeats(texts)


def test_long_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "PIECE", 700)
    texts = [prose(1, 300), prose(2, 50) + prose(1, 300)[500:1500], prose(3, 10), prose(4, 45)]
    batch = spark.createDataFrame([(k, k, t) for k, t in enumerate(texts)], "k1 long, k2 long, text string").toArrow().to_batches()
    seen = {0: set(), 1: set()}
    for data, keys, starts, sizes, starting in suffixes._looks(iter(batch), 400):
        for which, (at, first, last, _), _ in suffixes._anchored(data, starts, sizes, starting, (400, 200)):
            own = np.searchsorted(starts, at, side="right") - 1
            for k, a, b in zip(own, first, last, strict=True):
                for w in range(a, b + 1):
                    place = keys[k][0], keys[k][2] + w - int(starts[k])
                    assert place not in seen[which]
                    seen[which].add(place)
    assert all(seen[which] == {(k, s) for k, t in enumerate(texts) for s in range(len(t.encode()) - n + 1)} for which, n in ((0, 400), (1, 200)))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.binary(max_size=6).map(lambda b: bytes(x % 3 for x in b)), max_size=12), max_size=6))
def test_loser_tree_merges_and_tracks_prefixes(runs):
    runs = [sorted(r) for r in runs]
    prefixes = [[0] + [suffixes.common_prefix(a, b) for a, b in zip(r, r[1:], strict=False)] for r in runs]
    got = [(runs[r][i], n) for r, i, n in suffixes.LoserTree(runs, [p[: len(r)] for p, r in zip(prefixes, runs, strict=True)])]
    assert [s for s, _ in got] == sorted(s for r in runs for s in r)
    assert all(n == suffixes.common_prefix(a, b) for (a, _), (b, n) in zip(got, got[1:], strict=False))


def test_segments_come_back():
    entries = [(b"abc", b"x", {(1, 2, 3)}, False), (b"abd", b"", {(4, 5, 6), (-7, 8, 9)}, True)]
    suffix, prefix, before, count, members, twice = suffixes._unpacked(suffixes._packed(entries))
    assert suffix == [b"abc", b"abd"] and prefix == [0, 2] and before == [b"x", b""] and count.tolist() == [1, 2] and len(members) == 3 and twice.tolist() == [0, 1]


def test_dedup_of_odd_tables(odd_docs, no_docs):
    assert suffixes.dedup(no_docs).count() == 0
    out = suffixes.dedup(odd_docs)
    assert out.count() == odd_docs.count()
    got = {(r.doc_id, r.source): r for r in out.collect()}
    assert got[1, None].text is None and got[1, None].n_bytes == 0
    assert got[5, "s1"].text == "" and got[5, "s1"].n_removed == got[5, "s1"].n_bytes  # a copy elsewhere
    assert got[4, "s2"].n_removed == 0 and got[4, "s2"].label == "xlabel"


# n-gram Jaccard ----------------------------------------------------------------------------------------------------------


def brute_components(rows):
    sets = []
    for _, t in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    own = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = own[a], own[b]
                own = [min(x, y) if o in (x, y) else o for o in own]
    low = defaultdict(lambda: None)
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[own[k]] = i if low[own[k]] is None else min(low[own[k]], i)
    return sorted(((i if i is not None else -1), len(sets[k]), (low[own[k]] if low[own[k]] is not None else -1) if sets[k] else (i if i is not None else -1)) for k, (i, _) in enumerate(rows))


def near(seed, edits, n=60):
    words = prose(seed, n).split()
    for k in edits:
        words[k] = f"edit{k}{len(edits)}"
    return " ".join(words)


def rows_of_groups():
    draw, rows, k = random.Random(7), [], 0
    for seed in range(8):
        for _ in range(14):
            rows.append((k, near(seed, draw.sample(range(60), draw.choice([0, 0, 1, 1, 2, 3])))))
            k += 1
    common = prose(99, 30)
    rows += [(k + j, prose(200 + j, 40) + " " + common) for j in range(20)]  # a shared passage is no link
    return rows + [(500, None), (501, ""), (502, "a b"), (503, "A  b\n"), (504, "a b c"), (None, "a b c"), (505, near(0, [])), (505, near(0, []))]


def test_components_against_brute_force(spark):
    rows = rows_of_groups()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = jaccard.component_ids(docs, []).collect()
    assert sorted(((r.doc_id if r.doc_id is not None else -1), r.n_shingles, (r.component_id if r.component_id is not None else -1)) for r in got) == brute_components(rows)


def test_blocks_of_a_community_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 280)
    rows = rows_of_groups()[:60]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.component_ids(docs, []).collect()) == brute_components(rows)


def test_search_against_all_pairs():
    draw = np.random.default_rng(2)
    base = np.sort(draw.integers(0, 2**60, 80).astype(np.uint64))
    sets = [np.unique(np.concatenate([draw.choice(base, draw.integers(60, 80), replace=False), draw.integers(0, 2**60, draw.integers(0, 12)).astype(np.uint64)])) for _ in range(40)]
    index = jaccard.Inverted(sets)
    for s in sets:
        want = [k for k, o in enumerate(sets) if 100 * len(np.intersect1d(s, o)) >= 80 * len(np.union1d(s, o))]
        assert index.search(s).tolist() == want


def test_one_of_each(spark, odd_docs, no_docs):
    assert jaccard.one_of_each(no_docs).count() == 0
    kept = sorted((r.doc_id if r.doc_id is not None else -1) for r in jaccard.one_of_each(odd_docs).collect())
    assert kept == [-1, 1, 2, 3, 4, 5, 7, 9]  # copies 5, 6 and 7, 8 leave one each; texts without words stay


def test_graph(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (5, 5), (3, 1), (8, 7), (20, 1)], "a long, b long")
    assert {r.node: r.component for r in components(edges).collect()} == {1: 1, 2: 1, 3: 1, 20: 1, 7: 7, 8: 7, 9: 7}
    assert components(edges.limit(0)).count() == 0


def test_colliding_tags_keep_the_lower_requirement():
    """Tag 5 stands for a set that needs 3 and shares 3, and for one that needs 50: both go on, whichever comes first."""
    for order in ([0, 1], [1, 0]):
        blobs, others = [], []
        for k in order:
            h = np.arange(3, dtype=np.uint64) + np.uint64(10) if k == 0 else np.arange(3, dtype=np.uint64) + np.uint64(90)
            blobs.append(jaccard._pack(h, np.full(3, 5, np.uint64), np.full(3, 3 if k == 0 else 50, np.uint8)))
            others.append(jaccard._pack(h, np.full(3, 6, np.uint64), np.full(3, 3, np.uint8)))
        group = pd.DataFrame({"bucket": 0, "kind": 0, "blob": [blobs[0], others[order.index(0)], blobs[1]]})
        shared = jaccard._shared(1)(group)
        assert sorted(jaccard._enough(shared)["tag"]) == [5, 6]


def test_what_one_task_shares_counts_as_shared():
    """A hash that several sets of a task hold leaves it as one mark, and still counts for a set of another task."""
    mark = jaccard._pack(np.array([7], np.uint64), np.array([jaccard.MARK], np.uint64), np.array([255], np.uint8))
    one = jaccard._pack(np.array([7, 8], np.uint64), np.array([3, 4], np.uint64), np.array([1, 1], np.uint8))
    assert jaccard._enough(jaccard._shared(1)(pd.DataFrame({"bucket": 0, "kind": 0, "blob": [mark, one]})))["tag"].tolist() == [3]


def test_hot_shingles_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "HOT_SEEN", 3)
    rows = rows_of_groups()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = jaccard.component_ids(docs, []).collect()
    assert sorted(((r.doc_id if r.doc_id is not None else -1), r.n_shingles, (r.component_id if r.component_id is not None else -1)) for r in got) == brute_components(rows)
