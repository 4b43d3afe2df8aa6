from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from sparktab.session import ship_package

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def invented(rng: random.Random, n: int) -> str:
    parts = ["the", "an", "er", "ion", "sta", "lo", "mi", "ka", "ren", "du", "os", "pel"]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and long texts, ties, equal rows, equal ids, odd characters."""
    rng = random.Random(5)
    base = invented(rng, 120)
    rows = [
        (1, base, "en", "s0", 1), (2, base.replace(" ", "  \t"), "en", "s1", 1), (3, base, None, None, None),
        (4, None, "en", "s0", None), (5, "", "en", "s2", 0), (6, " \n\t ", None, "s2", 4), (7, "x", "de", "s1", 1),
        (8, "y" * 30_000, "de", "s1", 1), (9, invented(rng, 20_000), "en", "s0", 1),
        (10, base + " tail", "en", "s0", 1), (10, base + " tail", "en", "s0", 1), (11, "same id", "en", "s0", 1),
        (11, "other text", "en", "s3", 1), (None, base, "en", "s0", 1), (None, None, None, None, None),
        (12, "A▁B \u0000 \U0001f389é <s> </s> <|endoftext|>", "en", "és", 1),
    ]
    rows += [(100 + i, invented(rng, rng.randint(1, 80)), rng.choice(["en", "fr"]), f"s{i % 5}", 1) for i in range(60)]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The odd rows with extra columns whose names are used inside the operators."""
    d = spark.createDataFrame(odd_rows, SCHEMA)
    for name in ("id", "kept", "text_hash", "r_", "fp", "h", "k_id", "start", "a.b", "rejected", "repetitions"):
        d = d.withColumn(name, F.lit("clash"))
    return d.repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (7, 0, 1), (7, 1, 0), (None, 1, 1), (9, 1, None)]
                                 + [(100 + i, int(i % 7 > 0), int(i % 5 == 0)) for i in range(60)],
                                 "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
