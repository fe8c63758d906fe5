"""op8, op10 and the pipeline against plain versions that share no step with them but numerical fits and hashes."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from lagweave.llm import language, toxicity
from lagweave.llm.common import stored

LETTERS = {"aa": "abcde", "bb": "defgh", "cc": "ghiab"}


def text_of(seed, lang, n):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice(LETTERS[lang]) for _ in range(draw.randrange(3, 7))) for _ in range(n))


def out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def words_of(text):
    """The buckets of each word: around every letter a trigram in which all else is a blank."""
    points = [ord(c) if c.isalpha() else 0 for c in text.lower()]
    words, now = [], []
    for k, p in enumerate(points):
        if p:
            a, c = points[k - 1] if k else 0, points[k + 1] if k + 1 < len(points) else 0
            x = ((a * 0x9E3779B97F4A7C15) ^ (p * 0xC2B2AE3D27D4EB4F) ^ (c * 0x165667B19E3779F9)) % 2**64
            now.append((((x ^ (x >> 29)) * 0xBF58476D1CE4E5B9) % 2**64) >> 48)
        elif now:
            words.append(now)
            now = []
    return words + ([now] if now else [])


def em(like, chosen):
    share = {k: 1 / len(chosen) for k in chosen}
    for _ in range(language.ROUNDS):
        now = dict.fromkeys(chosen, 0.0)
        for row in like:
            top = max(row[k] for k in chosen)
            part = {k: share[k] * math.exp(row[k] - top) for k in chosen}
            for k in chosen:
                now[k] += part[k] / sum(part.values()) / len(like)
        move = max(abs(now[k] - share[k]) for k in chosen)
        share = now
        if move < min(1e-4, 0.1 / len(chosen)):
            break
    return share, sum(math.log(sum(share[k] * math.exp(row[k] - max(row[j] for j in chosen)) for k in chosen) + 1e-300) + max(row[j] for j in chosen) for row in like)


def language_by_hand(rows):
    counts = defaultdict(Counter)
    for i, text, lang in rows:
        if not out(i) and text is not None and lang is not None:
            counts[lang].update(b for w in words_of(text) for b in w)
    names = sorted(counts)
    found = {}
    for i, text, _ in rows:
        words = words_of(text or "")
        if not words:
            found[i] = ("und", 0.0)
            continue
        like = [{k: sum(math.log((counts[k][b] + language.PRIOR) / (sum(counts[k].values()) + language.PRIOR * language.BUCKETS)) for b in w) for k in names} for w in words]
        chosen = names
        share, fit = em(like, chosen)
        while len(chosen) > 1:
            drop = [k for k in chosen if share[k] < max(1e-3, 0.5 / len(words))]
            if not drop or len(drop) == len(chosen):
                drop = [min(chosen, key=lambda k: share[k])]
            rest = [k for k in chosen if k not in drop]
            less, less_fit = em(like, rest)
            if less_fit + 0.5 * math.log(max(2, len(words))) * len(drop) < fit:
                break
            chosen, share, fit = rest, less, less_fit
        best = max(chosen, key=lambda k: share[k])
        found[i] = (best, share[best])
    return found


def test_language_query_by_hand(spark, tmp_path):
    draw = random.Random(5)
    rows = [(k, text_of(k, draw.choice(list(LETTERS)), 12), None) for k in range(90)]
    rows = [(k, t, max(LETTERS, key=lambda a: sum(c in LETTERS[a] for c in t))) for k, t, _ in rows]
    rows += [(100 + k, f"{text_of(k, 'aa', 6)} {text_of(k, 'bb', 3 + k)}", None) for k in range(12)]
    rows += [(200, None, "aa"), (201, "", "bb"), (202, "1 2 3 !", "cc"), (203, text_of(9, "bb", 400), "bb"), (204, "x", None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in language.op8_language_mixture(spark, str(tmp_path)).collect()}
    want = language_by_hand(rows)
    assert got.keys() == want.keys()
    for k, (lang, share) in want.items():
        assert got[k].lang_pred == lang and got[k].score == pytest.approx(share, abs=2e-3) and got[k].held_out == out(k), k


def tokens_of(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def buckets_of(token):
    return [xxhash.xxh64_intdigest(token) % toxicity.BUCKETS] + [xxhash.xxh64_intdigest(token[:k], seed=k) % toxicity.BUCKETS for k in (4, 5, 6, 7) if len(token) > k]


def segments_by_hand(scores, low=0):
    """The best segment (shortest, then first of equals), then those left and right of it."""
    best = max(((sum(scores[a:b]), a - b, -a) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), default=(0, 0, 0))
    if best[0] <= 1e-9:
        return []
    a = -best[2]
    b = a - best[1]
    return segments_by_hand(scores[:a], low) + [(low + a, low + b, best[0])] + segments_by_hand(scores[b:], low + b)


def toxicity_by_hand(rows, labels):
    known = {}
    for i, toxic in labels:
        if toxic in (0, 1):
            known[i] = max(toxic, known.get(i, 0))
    held = {0: Counter(), 1: Counter()}
    size = Counter()
    train = [(i, t) for i, t in rows if not out(i) and i in known]
    for i, t in train:
        size[known[i]] += 1
        held[known[i]].update({b for w in tokens_of(t) for b in buckets_of(w)})

    def weight(b):
        x, y = held[0][b], held[1][b]
        if y < 3:
            return toxicity.DRIFT
        alpha = 0.5 + toxicity.PRIOR * (x + y) / max(1, size[0] + size[1])
        odds = lambda n, all_: math.log((n + alpha) / (all_ + toxicity.PRIOR + 1 - n - alpha + 0.5))
        delta = odds(y, size[1]) - odds(x, size[0])
        return min(delta, toxicity.CEILING) if delta / math.sqrt(1 / (y + alpha) + 1 / (x + alpha)) >= toxicity.LEAST_Z else toxicity.DRIFT

    def seen(text):
        scores = [max(weight(b) for b in buckets_of(w)) for w in tokens_of(text)]
        return len(scores), segments_by_hand(scores)

    found = [(known[i], *seen(t)) for i, t in train]
    y, n, best = np.array([f[0] for f in found], float), np.array([f[1] for f in found], float), np.array([max((s for *_, s in f[2]), default=0.0) for f in found])
    law = toxicity.extreme_value(best[y == 0], n[y == 0])
    sure = lambda n, segs: [(a, b, s) for a, b, s in segs if 1 - math.exp(-math.exp(min(50, max(-80, law[1] + math.log(max(n, 1)) - law[0] * s)))) <= toxicity.MOST_P]
    row = lambda n, segs: (n, max((s for *_, s in segs), default=0.0), sum(s for *_, s in segs), sum(s for *_, s in sure(n, segs)))
    w = toxicity.logistic(toxicity.features(*map(np.array, zip(*[row(n, segs) for _, n, segs in found], strict=True)), law), y)
    result = {}
    for i, t in rows:
        n, segs = seen(t)
        z = float((toxicity.features(*[np.array([v]) for v in row(n, segs)], law) @ w)[0])
        result[i] = (1 / (1 + math.exp(-z)), sure(n, segs))
    return result


def test_toxicity_query_by_hand(spark, tmp_path):
    draw = random.Random(3)
    bad = ["gruk", "snarfle", "blotchen", "vexing"]
    rows, labels = [], []
    for k in range(260):
        toxic = k % 4 == 0
        words = text_of(k, draw.choice(list(LETTERS)), draw.randrange(5, 30)).split()
        for _ in range(draw.randrange(2, 5) if toxic else draw.random() < 0.04):
            words.insert(draw.randrange(len(words)), draw.choice(bad) + draw.choice(["", "s", "ing"]))
        rows.append((k, " ".join(words)))
        if k % 10:
            labels.append((k, int(toxic)))
    rows += [(300, None), (301, ""), (302, "Gruk! SNARFLE, vexing blotchens")]
    labels += [(4, 0), (None, 1), (1, None), (2, 7)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id: r for r in toxicity.op10_toxic_segments(spark, str(tmp_path)).collect()}
    want = toxicity_by_hand(rows, labels)
    assert got.keys() == want.keys() and any(r.segments for r in got.values())
    for k, (p, segs) in want.items():
        assert got[k].score == pytest.approx(p, abs=2e-4) and got[k].predicted == int(got[k].score >= 0.5) and got[k].held_out == out(k), k
        assert [s.score for s in got[k].segments] == pytest.approx([s for *_, s in segs], abs=1e-4), k


def repeated_bytes(datas, n):
    seen = Counter(d[s : s + n] for d in datas for s in range(len(d) - n + 1))
    cover = []
    for d in datas:
        own = bytearray(len(d))
        for s in range(len(d) - n + 1):
            if seen[d[s : s + n]] > 1:
                own[s : s + n] = b"\1" * n
        cover.append(own)
    return cover


def test_first_stages_by_hand(spark):
    """Quality rules, Jaccard join and suffix dedup, each on what the one before kept, with nulls and passages of over fifty words."""
    def prose(seed, n):
        draw = random.Random(seed)
        return " ".join("".join(draw.choice("abcdefghijklmnop") for _ in range(draw.randrange(2, 9))) for _ in range(n))

    passage, near = prose(1000, 52), prose(2000, 120).split()
    rows = [(k, f"{prose(k, 70)} {passage if k < 6 else ''} {prose(500 + k, 40)}") for k in range(14)]
    rows += [(20, " ".join(near)), (21, " ".join([*near[:60], "other", *near[61:]])), (22, " ".join(near)), (30, None), (31, ""), (32, "too short"), (33, "same words here " * 60), (None, prose(77, 90))]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(2)
    stages = dict(corpus_pipeline.STAGES)
    kept = stored(stages["quality rules"](spark, docs, ""), "t")
    assert {r.doc_id: r.text for r in kept.collect()} == {i: t for i, t in rows if i in {*range(14), 20, 21, 22, None}}  # the others have under 50 words or repeat
    one = stored(stages["n-gram Jaccard join"](spark, kept, ""), "t")
    after = {r.doc_id: r.text for r in one.collect()}
    assert after.keys() == {*range(14), 20, None} and all(dict(rows)[i] == t for i, t in after.items())
    cut = {r.doc_id: r for r in stages["suffix-array dedup"](spark, one, "").collect()}
    order = list(after)
    datas = [after[i].encode() for i in order]
    for i, d, cover in zip(order, datas, repeated_bytes(datas, 200), strict=True):
        assert cut[i].text.encode() == bytes(b for b, c in zip(d, cover, strict=True) if not c) and cut[i].n_chars == len(cut[i].text)
    assert all((passage in cut[i].text) == (passage in after[i] and i >= 6) for i in order) and passage not in "".join(r.text for r in cut.values())
