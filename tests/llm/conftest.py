import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    def build(rows, extra=False):
        full = [(d, t, "en", "s", None if t is None else len(t)) for d, t in rows]
        df = spark.createDataFrame(full, SCHEMA)
        if extra:
            from pyspark.sql import functions as F

            for name in ("shard", "slot", "kept", "spans", "entities", "fp", "part", "key", "n_words", "sequence_id", "Score"):
                df = df.withColumn(name, F.lit("clash"))
        return df

    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and long texts, ties and repeated rows."""
    rng = random.Random(5)
    long = " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "ünï", "x"]) for _ in range(30_000))
    return [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "a b c"), (6, long), (7, "same text here"), (8, "same text here"), (8, "same text here"), (None, "no id"), (None, None), (9, "x" * 50_000), (10, "!!! ??? ###"), (11, "a " * 5_000)]


@pytest.fixture(scope="session")
def prose():
    """Made-up words; the same seed gives the same text."""

    def text(seed, n=120):
        rng = random.Random(seed)
        parts = ["ka", "lo", "mi", "ren", "tos", "vu", "shal", "der", "ing", "po", "qua", "zi"]
        return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n))

    return text
