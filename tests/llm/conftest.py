import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use for results of their own
        *[T.StructField(c, T.StringType()) for c in ("size", "shard", "fingerprint", "score", "key", "start", "target")],
    ]
)


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), "x", "y", None, "z", "k", "s", "t")


def prose(seed: int, n: int = 60) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice("alpha beta gamma delta épsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho".split()) for _ in range(n))


def awkward_rows():
    """Nulls in every column, empty, blank and very long texts, ties and repeated rows."""
    return [
        row(1, prose(1)),
        row(2, None),
        row(3, ""),
        row(4, " \t\n "),
        row(5, "12345 --- 678"),
        row(6, prose(2, 40_000), "en", "b"),
        row(7, prose(1), None, None),
        row(7, prose(1), None, None),
        row(8, prose(3), "fr", None),
        row(9, "one two", "en", "c"),
        row(10, "Éa, ü\u0085x 𝄞 é a.b", "de", "b"),
        (None, prose(4), None, None, None, *[None] * 7),
        (None, None, None, None, None, *[None] * 7),
        *[row(100 + k, "the same text over and over again", "en", "hot") for k in range(40)],
    ]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3, "source")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
