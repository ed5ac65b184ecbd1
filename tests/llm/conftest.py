from __future__ import annotations

import pytest
from pyspark.sql import functions as F

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed: int, n: int) -> str:
    """Plain text of ``n`` words that follow from ``seed``."""
    out, state = [], seed * 7919 + 13
    for _ in range(n):
        state = (state * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(state >> 8) % len(WORDS)] + "aeiou"[(state >> 16) % 5])
    return " ".join(out)


def odd_rows() -> list[tuple]:
    """(doc_id, text, source): nulls, empty and very long texts, ties and repeated rows."""
    base = prose(1, 120)
    return [
        (1, None, "b"), (2, "", "b"), (3, " \t\n ", None), (4, "one", "a"), (5, "one  two\nthree", "a"), (6, "one two three", "c"),
        (7, base, "a"), (8, base, "b"), (9, base.replace(" ", "\t", 3), "b"), (9, base.replace(" ", "\t", 3), "b"),
        (10, base + " more", "d"), (11, prose(2, 60000), "a"), (12, prose(3, 40), None), (13, prose(4, 90), "Ä"),
        (14, base[:-6], "a"), (15, "x" * 5000, "c"), (None, "no id", "a"), (None, "no id", "a"), (16, prose(2, 60000)[:150000], "e"),
        (17, "ÄÖ Übung <|im_end|> [INST]   \U0001f600", "e"), (18, "x" * 5000, "c"),
    ]


def with_clashes(df):
    """More columns, named like those that operators make."""
    for i, name in enumerate("h n rid key size row kept score mark sha spans copies component_id lang n_chars".split()):
        df = df.withColumn(name, F.lit(i))
    return df


@pytest.fixture(scope="session")
def odd(spark):
    return with_clashes(spark.createDataFrame(odd_rows(), "doc_id long, text string, source string"))


@pytest.fixture
def work(spark):
    from seriesmill.llm.work import Work

    return Work(spark, "test")


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string, lang string, n_chars long")
