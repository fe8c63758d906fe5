import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lagweave.llm.common import new_path
from lagweave.llm.packing import balanced, pack, pack_documents
from lagweave.llm.token_counts import count_tokens, op6_token_counts
from lagweave.llm.tokens import encoder

BPE = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=200))
def test_same_ids_as_the_library(text):
    assert list(encoder(BPE).ids(text)) == REFERENCE.encode(text, add_special_tokens=False).ids


REFERENCE = Tokenizer.from_file(BPE)


@pytest.mark.parametrize("text", ["", " ", "a  b\n\n c", "x<|endoftext|>y", "don't 12,300 ½ 　z\ttab", "\x00 ퟿"])
def test_same_ids_on_odd_texts(text):
    assert list(encoder(BPE).ids(text)) == REFERENCE.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_kinds_of_files(name):
    assert encoder(public_tokenizers.path(name)).ids("some words, and more")


def test_cache(spark, odd_docs):
    cache = new_path(spark, "cache")
    first = count_tokens(odd_docs, BPE, cache)
    got = {(r.doc_id, r.text): r.n_tokens for r in first.collect()}
    assert first.count() == odd_docs.count() and got[1, None] == 0 and got[2, ""] == 0
    assert all(n == len(REFERENCE.encode(t or "", add_special_tokens=False).ids) for (_, t), n in got.items())
    n = spark.read.parquet(cache).count()
    assert n == odd_docs.select("text").na.fill("").distinct().count()
    count_tokens(odd_docs, BPE, cache).count()
    assert spark.read.parquet(cache).count() == n  # nothing is encoded again
    count_tokens(odd_docs.limit(2), public_tokenizers.path("word_bpe_49k.json"), cache).count()
    assert spark.read.parquet(cache).count() > n  # another tokenizer has its own counts


def test_cache_of_nothing(spark, no_docs):
    assert count_tokens(no_docs, BPE, new_path(spark, "cache")).count() == 0


def test_query_against_the_library(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in op6_token_counts(spark, sf).collect():
        n = len(REFERENCE.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len(texts[r.doc_id].encode()), n > 512)


def test_pack_holds_every_token_once_without_padding():
    draw = random.Random(5)
    for _ in range(100):
        lengths = [draw.choice([1, 2, draw.randrange(1, 300), draw.randrange(1, 9000)]) for _ in range(draw.randrange(0, 50))]
        windows, seen = pack(lengths), {}
        for window, parts in windows:
            assert sum(p[2] for p in parts) == window and window & (window - 1) == 0 and window <= 2048
            for doc, start, n in parts:
                seen.setdefault(doc, []).append((start, n))
        for doc, n in enumerate(lengths):
            at = 0
            for start, k in sorted(seen[doc]):
                assert start == at
                at += k
            assert at == n


def test_step_groups_are_balanced():
    windows = pack([random.Random(k).randrange(1, 5000) for k in range(600)])
    group = balanced(windows, 1 << 16)
    size = np.bincount(group, weights=[w for w, _ in windows])
    assert size.min() > 0.85 * size.mean()


def test_pieces_hold_the_documents(spark, odd_docs):
    rows = pack_documents(odd_docs, BPE).collect()
    want = sorted(((r.doc_id if r.doc_id is not None else -1), tuple([*REFERENCE.encode(r.text or "", add_special_tokens=False).ids, 1])) for r in odd_docs.collect())
    total = sum(len(ids) for _, ids in want)
    assert sum(r.length for r in rows) == total
    for doc_id, ids in {w for w in want if sum(x[0] == w[0] for x in want) == 1}:
        parts = sorted((r.start, r.length, r.ids_crc32) for r in rows if (r.doc_id if r.doc_id is not None else -1) == doc_id)
        at = 0
        for start, n, crc in parts:
            assert start == at and crc == zlib.crc32(np.array(ids[start : start + n], "<u4").tobytes())
            at += n
        assert at == len(ids)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length, r.window))
    for parts in by.values():
        at = 0
        for offset, n, window in sorted(parts):
            assert offset == at
            at += n
        assert at == window


def test_packing_of_nothing(no_docs):
    assert pack_documents(no_docs, BPE).count() == 0
