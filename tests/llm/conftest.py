import random

import pytest
from pyspark.sql import functions as F

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def make_docs(spark, rows):
    """(doc_id, text[, source]) as a documents table."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOC)


def words(rng, n, size=400):
    return " ".join(f"w{rng.randrange(size)}x" for _ in range(n))


@pytest.fixture
def docs_of(spark):
    return lambda rows: make_docs(spark, rows)


@pytest.fixture
def odd_rows():
    """NULLs, empty, blank, one word, very long, ties and repeated rows."""
    rng = random.Random(7)
    long = words(rng, 30_000)
    same = words(rng, 60)
    return [
        (1, None, "b"), (2, "", "b"), (3, " \n\t ", None), (4, "one", None), (5, long, "a"), (6, same, "a"),
        (7, same, "a"), (8, same + " tail", "b"), (None, words(rng, 20), "a"), (None, None, None), (6, same, "a"),
        (9, "ÄÖ é ñ <|endoftext|>   漢字", "c"), (10, words(rng, 300), "c"),
    ]


@pytest.fixture
def odd_docs(docs_of, odd_rows):
    """The same with extra columns whose names operators also use."""
    extra = ["key", "size", "score", "digest", "print", "rank", "u", "v", "ident", "start", "tokens", "item", "shard", "n", "words",
             "row", "place", "found", "overlaps", "chunk", "cut", "col", "_own", "_digest", "_found", "_shard", "_cut", "_one", "_place", "_first"]
    df = docs_of(odd_rows)
    return df.select("*", *[F.lit("x").alias(c) for c in extra])


@pytest.fixture
def no_docs(docs_of):
    return docs_of([])
