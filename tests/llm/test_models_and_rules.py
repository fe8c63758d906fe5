import random
import re
import zlib

import numpy as np
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from lagweave.llm import ann, chat, language, mixing, quality, toxicity


def prose(seed, n):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefgh") for _ in range(draw.randrange(2, 8))) for _ in range(n))


# quality -------------------------------------------------------------------------------------------------------------------


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, seen, dup = text.split("\n"), set(), 0
    for x in lines:
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    hit = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(hit)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab é#|\n\t\x0b <", max_size=60))
def test_counts(text):
    assert quality.counts(text) == brute_counts(text)


def test_bands():
    z = zstandard.ZstdCompressor(level=3)
    good, same = prose(1, 900), "spam " * 900
    draw = random.Random(1)
    noise = "".join(draw.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/") for _ in range(9000))
    verdict = lambda t: quality.passes(len(t.encode()), *quality.bands(t, z))
    assert verdict(good) and not verdict(same)
    assert quality.bands(noise, z)[0] < quality.bands(good, z)[0]


def test_judge_odd_tables(odd_docs, no_docs):
    assert quality.judge(no_docs).count() == 0 and quality.keep(no_docs).count() == 0
    got = {r.doc_id: r for r in quality.judge(odd_docs).collect()}
    assert got[1].n_words == 0 and got[1].base_failed and not got[1].kept and not got[2].kept
    kept = quality.keep(odd_docs)
    assert kept.columns == odd_docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}


# mixing --------------------------------------------------------------------------------------------------------------------


def test_targets_water_filling():
    t = mixing.targets([100, 100, 100])
    assert t == pytest.approx([200, 166.6666667, 83.3333333])
    assert mixing.targets([]) == [] and mixing.targets([0, 0]) == [0, 0]
    t = mixing.targets([1000, 10, 10, 500])
    assert sum(t) == pytest.approx(1.5 * 1520) and all(x <= 2 * s + 1e-9 for x, s in zip(t, [1000, 10, 10, 500], strict=True))


def test_tree_partitions_exactly():
    blocks = np.array([37, 0, 5, 120])
    parts = [mixing.quotas(blocks, 11, s, 3) for s in range(11)]
    at = np.zeros(4, int)
    for before, have in parts:
        assert (before == at).all()
        at += have
    assert (at == blocks).all() and max(h.sum() for _, h in parts) - min(h.sum() for _, h in parts) <= 4


def test_mix_comes_near_its_targets(spark):
    rows = [(k, prose(k, 20 + k % 50), None if k % 11 == 0 else f"s{k % 3}") for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    runs = [{r.doc_id: r for r in mixing.mix(docs)[1].collect()} for _ in range(2)]
    assert {k: r.taken for k, r in runs[0].items()} == {k: r.taken for k, r in runs[1].items()}
    by = {}
    for k, t, s in rows:
        r = runs[0][k]
        assert r.size == len(t.split()) and 0 <= r.taken <= 2 * r.size
        by.setdefault(s, [0, r.target])[0] += r.taken
    assert all(abs(a - b) <= 1 for a, b in by.values())


def test_mix_odd_tables(spark, odd_docs, no_docs):
    assert mixing.mix(no_docs)[1].count() == 0
    plan = mixing.mix(odd_docs)[1].collect()
    assert len(plan) == odd_docs.count() and all(r.taken == 0 for r in plan if r.size == 0)
    mixed = mixing.mixed(odd_docs)
    assert mixed.columns == odd_docs.columns
    assert sum(len((r.text or "").split()) for r in mixed.collect()) == sum(r.taken for r in plan)


def test_mixed_numbers_rows_once(spark):
    """docs whose rows come in another order at each read, as when executors come and go between plans."""
    from pyspark.sql import functions as F

    rows = [(k, " ".join(f"{w}{k}" for w in prose(k, 5 + k % 40).split()), f"s{k % 3}") for k in range(300)]
    table_ = spark.createDataFrame(rows, "doc_id long, text string, source string")
    turn = F.udf(lambda k: random.SystemRandom().random(), "double").asNondeterministic()
    got = mixing.mixed(table_.withColumn("turn", turn("doc_id")).repartitionByRange(4, "turn").sortWithinPartitions("turn").drop("turn")).collect()
    text, by = {k: t for k, t, _ in rows}, {}
    for r in got:
        assert text[r.doc_id].startswith(r.text.rstrip()) and r.text
        by[r.source] = by.get(r.source, 0) + len(r.text.split())
    cut = sum(r.text != text[r.doc_id] for r in got)
    sizes = [sum(len(t.split()) for _, t, s in rows if s == f"s{k}") for k in range(3)]
    assert cut <= 3 and [by[f"s{k}"] for k in range(3)] == pytest.approx(mixing.targets(sizes), abs=1)


def test_taken_against_a_plain_pass(spark, monkeypatch):
    """taken by sorting each source by its two hashes and giving words until its target; shards by the tree's quotas."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(mixing, "BLOCK_WORDS", 90)
    monkeypatch.setattr(mixing, "SHARD_BLOCKS", 5)
    monkeypatch.setattr(mixing, "GROUPED", 7)
    long = "same start " * 60  # rows that differ after their first 256 characters only
    rows = [(k, long + prose(k, 3) if k % 9 == 0 else prose(k, 20 + k % 50), None if k % 11 == 0 else f"s{k % 3}") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    draws, plan, n_shards = mixing.mix(docs)
    plan = {r.doc_id: r for r in plan.collect()}
    content = F.xxhash64(F.col("doc_id").cast("string"), F.coalesce("source", F.lit("")), "text")
    hashed = {salt: {r.doc_id: r.h for r in docs.select("doc_id", (F.pmod(F.xxhash64(F.lit(17), F.lit(salt), content), F.lit(1 << 40)) / float(1 << 40)).alias("h")).collect()} for salt in (1, 2)}
    taken, blocks, met = dict.fromkeys(plan, 0), {}, set()
    for no in {r.source_no for r in plan.values()}:
        own = [k for k, r in plan.items() if r.source_no == no]
        size, left = plan[own[0]].source_size, round(plan[own[0]].target)
        for lap in (0, 1):
            for k in sorted(own, key=lambda k: hashed[lap + 1][k]):
                got = min(left, plan[k].size)
                taken[k] += got
                left -= got
                if got:
                    met.add((no, lap, int(hashed[lap + 1][k] * -(-size // 90))))
    assert {k: r.taken for k, r in plan.items()} == taken
    by_row = {r.row_id: r for r in plan.values()}
    for d in draws.collect():
        r = by_row[d.row_id]
        assert (d.shard, d.place) in set(zip(r.shards, r.places, strict=True))
        blocks.setdefault((r.source_no, d.lap, int(hashed[d.lap + 1][r.doc_id] * -(-r.source_size // 90))), set()).add(d.shard)
    assert set(blocks) == met and all(len(v) == 1 for v in blocks.values()) and n_shards > 5
    have = np.array([sum(b[0] == no for b in blocks) for no in range(len({b[0] for b in blocks}))])
    for shard in range(n_shards):
        assert [sum(b[0] == no and v == {shard} for b, v in blocks.items()) for no in range(len(have))] == mixing.quotas(have, n_shards, shard, 17)[1].tolist()


def test_grain_follows_the_input():
    assert mixing.grain(0) == mixing.grain(1000) == mixing.LEAST_WORDS and mixing.grain(1e12) == mixing.BLOCK_WORDS
    assert mixing.grain(3_000_000) == 3_000_000 // 1024


def test_query_walks_the_tree(spark):
    """Shards of the query on sf0.01: dozens, alike in words, and each source's words go to them near its share."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "source", "text")
    draws, plan, n_shards = mixing.mix(docs)
    got = draws.join(plan.select("row_id", "source_no", "target"), "row_id").groupBy("shard", "source_no", "target").sum("words").collect()
    words, source = np.zeros(n_shards), {}
    for shard, no, target, n in got:
        words[shard] += n
        source.setdefault((no, target), np.zeros(n_shards))[shard] += n
    assert n_shards >= 32 and words.min() > 0 and words.std() < 0.35 * words.mean()  # sixteen blocks of a few documents each
    for (_, target), have in source.items():
        assert have.sum() == pytest.approx(target, abs=1)
        # a shard's words of a source lie within five deviations of a draw of whole blocks without replacement
        share, block = target / words.sum(), mixing.grain(words.sum())
        limit = 5 * np.sqrt(mixing.LEAST_BLOCKS * share * (1 - share) + 1) * 2 * block
        assert np.abs(have - have.mean()).max() < limit
    assert sum((v > 0).sum() for v in source.values()) > 200  # most sources reach many shards


def test_first_words_keep_every_character(spark):
    from pyspark.sql import functions as F

    for text in ("a b c", "  a\t\tb \n c ", "\ue000\ue001 x\ue000\ue001y z", "é ü 😀 w", "one"):
        for n in range(1, len(re.findall(r"[^\x20\x09-\x0D]+", text)) + 1):
            got = spark.createDataFrame([(text, n)], "text string, n long").select(mixing.first_words(F.col("text"), F.col("n")).alias("t")).first().t
            assert got == re.match(r"[\x20\x09-\x0D]*(?:[^\x20\x09-\x0D]+[\x20\x09-\x0D]*?){%d}(?=[\x20\x09-\x0D]|$)" % n, text).group()


# neighbours ----------------------------------------------------------------------------------------------------------------


def test_neighbours_against_brute_force(spark):
    draw = np.random.default_rng(0)
    x = draw.normal(size=(900, 16))
    x[100:140] = x[100]  # one vector many times
    rows = [(k, [float(np.float32(v)) for v in r]) for k, r in enumerate(x)] + [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (None, [1.0] * 16), (950, [1.0, 2.0]), (1, rows0 := [float(np.float32(v)) for v in x[1]])]
    vectors = ann.usable(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    from pyspark.sql import functions as F

    got = {}
    for r in ann.search(vectors, vectors.filter(F.col("vec_id") % 50 == 0)).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    unit = x.astype(np.float32).astype(float)
    unit /= np.sqrt((unit * unit).sum(1, keepdims=True))
    hit = 0
    for q, found in got.items():
        s = (unit * unit[q]).sum(1)
        want = [k for k in np.lexsort((np.arange(900), -s)) if k != q][:5]
        found = sorted(found)
        assert [f[0] for f in found] == [1, 2, 3, 4, 5]
        assert all(abs(f[2] - s[f[1]]) < 1e-12 for f in found)
        hit += len({f[1] for f in found} & set(want))
    assert len(got) == 18 and hit >= 0.9 * 90
    assert [f[1] for f in sorted(got[100])] == [101, 102, 103, 104, 105]  # ties to the smaller id
    assert ann.search(vectors.limit(0), vectors.limit(0)).count() == 0


def test_recall_where_few_are_scored_exactly(spark, monkeypatch):
    """Candidates are 4 % of the vectors, over several index and query blocks; cluster-free vectors, the hard case."""
    monkeypatch.setattr(ann, "BLOCK", 500)
    monkeypatch.setattr(ann, "TOGETHER", 2)
    monkeypatch.setattr(ann, "QUERIES", 30)
    monkeypatch.setattr(ann, "EXACT", 17)
    from pyspark.sql import functions as F

    x = ann.unit(np.random.default_rng(4).normal(size=(3000, 24)))
    vectors = spark.createDataFrame([(k, [float(v) for v in r]) for k, r in enumerate(x)], "vec_id long, v array<double>")
    runs = [ann.search(vectors.repartition(p), vectors.filter(F.col("vec_id") % 50 == 0), rerank=120).collect() for p in (2, 3)]
    assert sorted(map(tuple, runs[0])) == sorted(map(tuple, runs[1]))  # the sample does not depend on the partitions
    got = {}
    for r in runs[0]:
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hit = sum(len(found & set([j for j in np.argsort(-(x @ x[q]), kind="stable") if j != q][:5])) for q, found in got.items())
    assert len(got) == 60 and hit >= 0.9 * 300


@pytest.mark.parametrize("kind", ["tight", "wide", "scales", "far"])
def test_neighbours_where_codes_tell_little(spark, monkeypatch, kind):
    """The truly nearest, in order, where the codes' own order does not have them among its first: a tight group among spread vectors,
    wide vectors, distances of many scales, and components whose squares leave the range of doubles; over several slices and groups of queries."""
    monkeypatch.setattr(ann, "BLOCK", 500)
    monkeypatch.setattr(ann, "TOGETHER", 3)
    monkeypatch.setattr(ann, "QUERIES", 30)
    monkeypatch.setattr(ann, "SAMPLE", 1000)
    from pyspark.sql import functions as F

    draw = np.random.default_rng(8)
    n, dim = (2500, 160) if kind == "wide" else (4000, 40)
    x, centres = draw.normal(size=(n, dim)), draw.normal(size=(8, dim))
    if kind == "tight":
        x[::2] = centres[0] + 1e-3 * x[::2]
    if kind == "scales":
        x = centres[draw.integers(0, 8, n)] + 10.0 ** draw.uniform(-5, 0, size=(n, 1)) * x
    times = 2.0 ** draw.choice([-700, 0, 700], size=(n, 1)) if kind == "far" else np.ones((n, 1))
    vectors = spark.createDataFrame([(k, r) for k, r in enumerate((x * times).tolist())], "vec_id long, embedding array<double>")
    vectors = ann.usable(vectors)
    got = ann.search(vectors, vectors.filter(F.col("vec_id") % 50 == 0), rerank=20).collect()
    u, want = x / np.sqrt((x * x).sum(1, keepdims=True)), []
    for q in range(0, n, 50):
        s = (u * u[q]).sum(1)
        want += [(q, rank, j) for rank, j in enumerate([j for j in np.lexsort((np.arange(n), -s)) if j != q][:5], 1)]
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == want
    assert all(abs(r.score - (u[r.query_id] * u[r.vec_id]).sum()) < 1e-12 for r in got)


def test_codes_bound_scores():
    """No vector outscores what its code allows, and codes tell enough of vectors without groups to leave most of them out."""
    x = ann.unit(np.random.default_rng(2).normal(size=(4000, 32)))
    books = ann.fit(x[:2000], books=16)
    codes, norms, products = ann.encode(x, books)
    decoded = books[np.arange(16), codes.astype(int)].sum(1)
    assert np.allclose((decoded**2).sum(1), norms) and np.allclose((decoded * x).sum(1), products)
    ids = np.arange(4000)
    row = {"ids": ids.astype("<i8").tobytes(), "vectors": ann._packed(x), "codes": codes.tobytes(), "norms": norms.tobytes(), "products": products.tobytes()}
    together, scored, plain = ann._Slice([row], books), [], ann._nearest_exactly
    for q in range(0, 4000, 100):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(ann, "_nearest_exactly", lambda x, ids, q, at, k: (scored.append(len(at)), plain(x, ids, q, at, k))[1])
            at, _ = together.nearest(q, x[q], 5, 20)
        assert at.tolist() == [j for j in np.lexsort((ids, -(x * x[q]).sum(1))) if j != q][:5]
    assert np.median(scored[1::2]) < 1000


def test_vectors_of_other_types_and_names(spark):
    from pyspark.sql import functions as F

    rows = [(k, [k + 1, 3, 1]) for k in range(60)]
    table_ = spark.createDataFrame(rows, "vec_id int, embedding array<int>").withColumns({c: F.lit("x") for c in ("v", "dim", "block", "rank", "score", "query_id", "asked", "label")})
    vectors = ann.usable(table_)
    got = ann.search(vectors, vectors.filter("vec_id % 50 = 0")).collect()
    assert {r.query_id for r in got} == {0, 50} and len(got) == 10 and all(-1 <= r.score <= 1 + 1e-12 for r in got)


def test_few_candidates(spark):
    vectors = ann.usable(spark.createDataFrame([(50, [1.0, 0.0]), (51, [0.0, 1.0])], "vec_id long, embedding array<float>"))
    assert [(r.query_id, r["rank"], r.vec_id) for r in ann.search(vectors, vectors.filter("vec_id % 50 = 0")).collect()] == [(50, 1, 51)]


def test_beam_is_no_worse_than_greedy():
    x = ann.unit(np.random.default_rng(1).normal(size=(300, 12)))
    books = ann.fit(x, books=3, words=16)
    error = lambda beam: ((x - books[np.arange(3), ann.encode(x, books, beam)[0].astype(int)].sum(1)) ** 2).sum()
    assert error(8) <= error(1) < (x * x).sum()


# chat ----------------------------------------------------------------------------------------------------------------------


def test_preferences(spark):
    chosen = [(1, 0, "user", "q"), (1, 1, "assistant", "good"), (2, 0, "user", "q"), (3, 0, "user", None), (4, 0, "user", "only"), (1, 1, "assistant", "good"), (None, 0, "user", "x"), (1, None, "user", "x")]
    rejected = [(1, 0, "user", "q"), (1, 1, "assistant", "bad"), (1, 2, "user", "?"), (2, 0, "user", "q"), (3, 0, None, "")]
    make = lambda r: chat.distinct_turns(spark.createDataFrame(r, "conv_id long, turn long, role string, text string"))
    got = sorted((r.conv_id, r.part, r.turn, r.loss) for r in chat.preferences(make(chosen), make(rejected)).collect())
    assert got == [(1, "chosen", 1, True), (1, "prompt", 0, False), (1, "rejected", 1, True), (1, "rejected", 2, False), (2, "prompt", 0, False), (3, "chosen", 0, False), (3, "rejected", 0, False)]
    assert chat.preferences(make([]), make([])).count() == 0


def test_conversations_without_a_neighbour_and_odd_ones(spark, tmp_path):
    """Against the SQL: missing neighbours, very long turns, nulls, repeated rows, and columns of clashing names."""
    import duckdb
    from pyspark.sql import functions as F

    rows = [(0, 0, "user", "q"), (0, 1, "assistant", "a " * 200_000), (1, 0, "user", "q"), (1, 1, "assistant", "b"), (4, 0, "user", "alone"), (4, 1, "assistant", None), (7, 0, None, "x"), (7, 0, None, "x"), (7, 1, "user", ""), (None, 0, "user", "x")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit("z") for c in ("said", "part", "last", "other", "good", "x")}).write.parquet(f"{tmp_path}/conversations.parquet")
    got = sorted(map(tuple, chat.op4_preferences(spark, str(tmp_path)).select("conv_id", "part", "turn", "role", "rendered", "loss").collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    want = con.execute(f"SELECT conv_id, part, turn, role, rendered, loss FROM ({chat.OP4_SQL})").fetchall()
    assert got == sorted(want) and {r[0] for r in got} == {0, 1, 4, 7} and {r[1] for r in got if r[0] in (4, 7)} == {"prompt"}


def test_chat_is_native(spark):
    plan = chat.op4_preferences(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# language ------------------------------------------------------------------------------------------------------------------


def test_language_held_out(spark):
    got = language.op8_language_mixture(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "doc_id").filter("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in got) >= 0.95 * len(got)
    assert all((zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)


def test_mixture_finds_both_languages():
    like = np.log(np.array([[0.9, 0.05, 0.05]] * 60 + [[0.05, 0.9, 0.05]] * 40))
    share = language.infer(like)
    assert share[2] == 0 and abs(share[0] - 0.6) < 0.05


def test_language_odd_tables(spark, odd_docs, no_docs):
    from pyspark.sql import functions as F

    model = language.fit(odd_docs)
    got = {(r.doc_id, r.lang_pred) for r in language.identify(odd_docs.withColumn("held_out", F.lit(True)), model).collect()}
    assert (1, "und") in got and (2, "und") in got and (3, "und") in got
    nothing = language.fit(no_docs)
    assert {r.lang_pred for r in language.identify(odd_docs.withColumn("held_out", F.lit(True)), nothing).collect()} == {"und"}


def test_language_has_no_most_languages(spark):
    """Of 1010 languages those of the fewest trigrams are learned and predicted too."""
    from pyspark.sql import functions as F

    words = lambda k: [random.Random(1000 * k + j).choices("abcdefghijklmnopqrstuvwxyz", k=7) for j in range(3 if k < 20 else 5)]
    docs = [(k, " ".join("".join(w) for w in words(k)), f"l{k:04d}-Latn") for k in range(1010)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3)
    model = language.fit(df)
    assert len(model.names) == 1010
    got = {r.doc_id: r.lang_pred for r in language.identify(df.filter("doc_id < 30").withColumn("held_out", F.lit(True)), model).collect()}
    assert got == {k: lang for k, _, lang in docs[:30]}


def test_likelihoods_are_those_of_the_dense_table(spark, monkeypatch):
    """Also with a text that is looked at by runs, through a file and against slices of the model."""
    text = {"aa": prose(1, 300), "bb": prose(2, 500), "cc": "xyz zzz yxz " * 50}
    df = spark.createDataFrame([(t, k) for k, t in text.items()], "text string, lang string")
    count = np.full((language.BUCKETS, 3), language.PRIOR)
    for k, t in enumerate(text.values()):
        count[:, k] += np.bincount(language.trigrams(t)[0], minlength=language.BUCKETS)
    grams, word = language.trigrams(both := text["aa"] + " " + text["cc"] + " öß")
    want = np.add.reduceat(np.log(count / count.sum(axis=0))[grams], np.flatnonzero(np.diff(word, prepend=-1)), axis=0)
    share = language.infer(want)
    for cells, entries in ((language.CELLS, language.SLICE), (50, 100)):
        monkeypatch.setattr(language, "CELLS", cells)
        monkeypatch.setattr(language, "SLICE", entries)
        got = language.word_likelihoods(both, language.fit(df))
        assert isinstance(got, np.memmap) == (cells == 50)
        assert np.allclose(got, want, atol=1e-4) and np.allclose(language.infer(got), share, atol=1e-4)


# toxicity ------------------------------------------------------------------------------------------------------------------


def brute_segments(s):
    """Maximal segments by their definition: take the best (shortest, leftmost) one, then go on left and right of it."""
    def go(a, b):
        best = max(((round(sum(s[i:j]), 9), -(j - i), -i) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0,))
        if best[0] <= 0:
            return []
        i, j = -best[2], -best[2] - best[1]
        return go(a, i) + [(i, j)] + go(j, b)

    return go(0, len(s))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([1.0, 2.5, -1.25, -0.5, -3.0]), max_size=14))
def test_segments_against_their_definition(scores):
    got = toxicity.segments(np.array(scores))
    assert sum(s for *_, s in got) == pytest.approx(sum(sum(scores[a:b]) for a, b in brute_segments(scores)))
    assert max((s for *_, s in got), default=0) == pytest.approx(max((sum(scores[a:b]) for a, b in brute_segments(scores)), default=0))


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    got = toxicity.op10_toxic_segments(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").collect()
    bad = [r for r in got if r.toxic == 1]
    assert sum(r.predicted for r in bad) >= 0.85 * len(bad)
    assert sum(r.predicted for r in got if r.toxic == 0) <= 0.02 * len(got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    found = [r for r in got if r.predicted]
    assert sum(bool(r.segments) for r in found) >= 0.9 * len(found)  # nearly all have a significant passage
    assert sum(bool(r.segments) for r in got if r.toxic == 0) <= 0.01 * len(got)


def test_law_of_clean_texts_gives_honest_chances():
    """Texts of 30 to 300 tokens, most without one that scores: chances of their best segments are near uniform in the tail, in texts the law was not fitted to."""
    draw = np.random.default_rng(8)

    def bests(k):
        n = draw.integers(30, 300, k)
        got = []
        for m in n:
            tokens = np.where(draw.random(m) < 0.003, np.minimum(draw.exponential(1.2, m) + 0.3, 4.0), -0.35)
            got.append(max((s for *_, s in toxicity.segments(tokens)), default=0.0))
        return n.astype(float), np.array(got)

    n, best = bests(4000)
    law = toxicity.extreme_value(best, n)
    assert (best == 0).mean() > 0.5
    n, best = bests(4000)
    p = np.where(best > 0, toxicity.chance(n, best, law), 1.0)
    assert 0.05 < (p <= 0.1).mean() < 0.15 and 0.025 < (p <= 0.05).mean() < 0.08 and (p <= 0.01).mean() < 0.03
    assert toxicity.extreme_value(np.zeros(50), np.full(50, 9.0)) == (1.0, -4.0)


def test_toxicity_odd_tables(spark, odd_docs, no_docs):
    from pyspark.sql import functions as F

    labels = spark.createDataFrame([(4, 0), (5, 1), (5, 0), (None, 1), (9, None)], "doc_id long, toxic int")
    for train in (odd_docs, no_docs):
        model = toxicity.fit(train, labels)
        out = toxicity.score(odd_docs.withColumn("held_out", F.lit(False)), model).collect()
        assert len(out) == odd_docs.count() and all(0 <= r.score <= 1 for r in out)
    assert toxicity.score(no_docs.withColumn("held_out", F.lit(False)), model).count() == 0


def test_significant_passages_have_places(spark):
    """Two planted passages are found where they are, also after letters that grow in lower case; a single chance word is not."""
    from pyspark.sql import functions as F

    weight = np.full(toxicity.BUCKETS, toxicity.DRIFT, np.float32)
    for t in ("zorg", "blat"):
        weight[toxicity.xxhash.xxh64_intdigest(t) % toxicity.BUCKETS] = 3.0
    clean, law = prose(5, 60), (1.0, -4.0)
    passages = ["ZORG blat zorg blat", "blat, zorg; blat zorg zorg"]
    texts = [f"\u0130\u0130 {clean} {passages[0]} {clean}. {passages[1]} {clean}", f"{clean} zorg {clean}", None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("held_out", F.lit(False))
    got = {r.doc_id: r for r in toxicity.score(df, (weight, law, np.zeros(6))).collect()}
    assert [texts[0][s.start : s.end] for s in got[0].segments] == passages
    assert all(s.p <= toxicity.MOST_P for s in got[0].segments) and got[0].total == pytest.approx(sum(s.score for s in got[0].segments))
    assert got[1].best > 0 and not got[1].total and not any(got[k].segments for k in (1, 2, 3))
