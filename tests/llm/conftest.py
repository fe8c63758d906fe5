import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    vocabulary = [f"{a}{b}{c}" for a in ("lo", "mi", "ra", "te", "vu", "sko") for b in ("ban", "del", "rin", "tos", "mul") for c in ("", "a", "is", "or")]
    return " ".join(draw.choice(vocabulary) for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns of clashing names."""
    long = prose(1, 20_000)
    rows = [
        (1, None, None, None, None), (None, prose(2, 120), "en", "s1", 3), (2, "", "en", "s1", 0), (3, " \n\t ", "de", None, 4),
        (4, long, "en", "s2", len(long)), (5, prose(3, 200), "en", "s1", 1), (5, prose(3, 200), "en", "s1", 1), (6, prose(3, 200), "fr", "s2", 1),
        (7, "one two three", "en", "s1", 1), (8, "One two  THREE", "en", "s3", 1), (9, prose(4, 300) + " é ü <|endoftext|> \x00 end", "en", "sé", 1),
    ]
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(rows, DOCS).coalesce(2)
    extra = {c: F.lit(f"x{c}") for c in ("label", "size", "sid", "part", "k1", "row_id_", "n_spans", "score", "content", "rank", "block", "h")}
    return docs.withColumns(extra)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
