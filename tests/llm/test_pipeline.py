import re

import corpus_pipeline
import public_tokenizers
from tokenizers import Tokenizer

from lagweave.llm.common import stored

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF), "test")
        assert docs.columns == columns, name
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] >= sizes[2] == sizes[3]
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sum(words(r.text) for r in docs.collect()) > 0
    bpe = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    total = sum(len(bpe.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in docs.collect())
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert sum(p.length for p in pieces) == total


def test_odd_and_empty_documents(spark, odd_docs, no_docs):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, SF).count() == 0, name
        stage(spark, odd_docs, SF).count()


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
