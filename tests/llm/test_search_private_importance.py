"""op11 to op13 against plain versions, and odd inputs."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lagweave.llm import importance, lexical, private

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms(text):
    return re.findall(TERM, (text or "").translate(LOWER))


def best_by_hand(docs, items, top=10):
    counts = [(d, Counter(terms(t))) for d, t in docs if terms(t)]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, asked in items.items():
        found = []
        for d, c in counts:
            m = 10 + 90 * sum(c.values()) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m)) for t in asked if t in c)
            if s > 0:
                found.append((-s, d is None, d or 0))
        out += [(item, k + 1, None if null else d, -s) for k, (s, null, d) in enumerate(sorted(found)[:top])]
    return sorted(out, key=str)


def test_search_by_hand(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = {r.item_id: set(terms(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    got = sorted((tuple(r) for r in lexical.op11_ranked_search(spark, SF).select("item_id", "rank", "doc_id", "score").collect()), key=str)
    assert got == best_by_hand(docs, items)


@pytest.mark.parametrize("seed", range(6))
def test_lists_find_all_that_reach_the_bound(seed):
    draw = random.Random(seed)
    n, n_terms = 200, 8
    lists = [sorted(draw.sample(range(n), draw.randrange(1, 120))) for _ in range(n_terms)]
    row = {"block": 3, "doc_ids": list(range(n)), "lengths": [draw.randrange(5, 60) for _ in range(n)], "terms": list(range(n_terms)), "sizes": [len(x) for x in lists], "at": [d for x in lists for d in x], "tf": [draw.randrange(1, 5) for x in lists for _ in x]}
    own = lexical.Lists(row, np.array([draw.randrange(0, 9000) for _ in lists]), n, 6000)
    total = np.bincount(own.at, own.part.astype(float), n)
    for least in (1, int(np.sort(total)[-10]), int(total.max()), int(total.max()) + 1):
        where, score = own.search(list(range(n_terms)), least)
        assert dict(zip(where.tolist(), score.tolist(), strict=True)) == {d: int(s) for d, s in enumerate(total) if s >= least}


def test_search_of_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(None, "one two"), (1, None), (2, "--"), (3, "THREE ù"), (3, "one"), (4, "one")], "item_id long, text string")
    docs = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    want = best_by_hand(docs, {None: {"one", "two"}, 3: {"three", "ù", "one"}, 4: {"one"}})
    assert sorted((tuple(r) for r in lexical.ranked_search(odd_docs, items).collect()), key=str) == want
    assert lexical.ranked_search(no_docs, items).count() == 0
    assert lexical.ranked_search(odd_docs, items.limit(0)).count() == 0


def importance_by_hand(docs, target):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    hashed = [(d, [zlib.crc32(w.encode()) % 10000 for w in words(t)]) for d, t in docs]
    s, t = Counter(b for _, x in hashed for b in x), Counter(zlib.crc32(w.encode()) % 10000 for x in target for w in words(x))
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (n_s + 10000) / ((s[b] + 1) * (n_t + 10000))))
    out = []
    for d, x in hashed:
        weight = sum(map(gain, x)) // len(x) if x else 0
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append((d, len(x), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = able[: len(able) // 10]
    return sorted([(*r, k + 1) for k, r in enumerate(drawn)] + [(*r, None) for r in able[len(drawn) :]] + [(*r, None) for r in out if r[1] < 20], key=str)


def test_importance_by_hand(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert sorted(map(tuple, importance.op13_importance_resampling(spark, SF).collect()), key=str) == importance_by_hand(docs, target)


def test_importance_of_odd_rows(spark, odd_docs, no_docs):
    target = spark.createDataFrame([(1, "one two"), (2, None)], "item_id long, text string")
    docs = odd_docs.union(odd_docs).union(odd_docs)
    want = importance_by_hand([tuple(r) for r in docs.select("doc_id", "text").collect()], ["one two", None])
    assert sorted(map(tuple, importance.resample(docs, target).collect()), key=str) == want
    assert importance.resample(no_docs, target).count() == 0
    assert importance.resample(docs, target.limit(0)).count() == docs.count()


def test_runs_of_two_words(spark):
    from pyspark.sql import functions as F

    got = spark.createDataFrame([("A b c",), ("x",), (None,)], "text string").select(importance.bucket_array(F.col("text"), 2, 1000)).collect()
    of = lambda *x: [zlib.crc32(w.encode()) % 1000 for w in x]
    assert [r[0] for r in got] == [of("a", "b", "c", "a b", "b c"), of("x"), []]


def base_by_hand(text):
    """The patterns as they stand, by plain search."""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group() if c.isdigit()][::-1]
        if 12 <= len(d) <= 19 and (sum(d[::2]) + sum(x * 2 - 9 * (x > 4) for x in d[1::2])) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= sum(c.isdigit() for c in m.group()) <= 15]
    return [(private.KINDS[k], a, b) for a, k, b in sorted(out)]


def test_patterns_by_plain_search():
    draw = random.Random(5)
    for _ in range(3000):
        text = "".join(draw.choice(["a", "b", "@", "@", ".", ".", "-", "+", " ", "é", "1", "4", "25", "300", "(", ")", "4111111111111111", "x.y@z.com", "1.2.3.4"]) for _ in range(draw.randrange(25)))
        assert private.base_spans(text) == base_by_hand(text), text


def test_gradient_and_posteriors():
    draw = np.random.default_rng(0)
    model = private.Model(*(x.astype(np.float64) for x in private.new_model(draw)))
    ids, tags = draw.integers(0, 131, (2, 6)), np.array([[0, 1, 2, 0, 3, 4]] * 2)
    grad = private.gradient(model, ids, tags)[1]
    for x, g in zip(model, grad, strict=True):
        k = np.unravel_index(np.abs(g).argmax(), g.shape)
        was, sides = x[k], []
        for step in (1e-3, -1e-3):
            x[k] = was + step
            sides.append(private.gradient(model, ids, tags)[0])
        x[k] = was
        assert (sides[0] - sides[1]) / 2e-3 == pytest.approx(g[k], rel=1e-2)
    scores = private.run_lstm(model, ids)[0] @ model.o + model.b
    assert np.allclose(private.marginals(model, scores)[0].sum(2), 1)


def test_held_out_windows(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect() if r.text]
    model = private.train([t[max(0, a - 32) : a + 128] for t in texts[::2] for a, _ in private.regions(t)])
    draw, right, spans, wrong, clean = np.random.default_rng(99), 0, 0, 0, 0
    for _ in range(400):
        text, true = private.planted(texts[1 + 2 * int(draw.integers(len(texts) // 2))], draw)
        got = {x[1:4] for x in private.decoded(model, [text], [(0, 0, len(text))])[0]}
        spans, clean = spans + len(true), clean + (not true)
        right, wrong = right + (bool(true) and true[0] in got), wrong + (not true and bool(got))
    assert right >= 0.85 * spans and wrong <= 0.05 * clean


def test_reconciled():
    text = "x" * 10 + "12345678901234567890" + "x" * 30
    found = [(5.0, "card", 10, 20, True), (6.0, "card", 16, 30, True), (3.0, "phone", 12, 15, False), (9.0, "ip", 31, 40, False)]
    assert private.reconciled(found, [], text) == [("card", 10, 30)]
    assert private.reconciled(found, [("card", 11, 12)], text) == [("phone", 12, 15)]


def test_private_of_odd_rows(spark, odd_docs, no_docs):
    from pyspark.sql import functions as F

    docs = odd_docs.withColumn("text", F.when(F.col("doc_id") == 4, F.concat("text", F.lit(" Mail a.b@c.de, +1 (017) 555-7713"))).otherwise(F.col("text")))
    rows = {r.doc_id: r for r in private.find(docs, None).collect()}
    assert (rows[4].n_email, rows[4].n_phone, rows[1].base, len(rows)) == (1, 1, [], len({r.doc_id for r in docs.collect()}))
    assert private.find(no_docs, None).count() == 0 and private.fit(no_docs) is None


def test_personal_data_query(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in private.op12_personal_data(spark, SF).collect():
        base = base_by_hand(docs[r.doc_id])
        text = [f"{k}:{a}:{b}" for k, a, b in base]
        assert r.base_sha256 == hashlib.sha256(",".join(text).encode()).hexdigest()
        assert [getattr(r, f"n_{k}") for k in private.KINDS] == [sum(s[0] == k for s in base) for k in private.KINDS]
        assert set(text) <= set(r.spans.split(",")) | {""}
