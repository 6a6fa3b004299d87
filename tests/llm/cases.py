"""Awkward documents that every operator is tried on."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = "an en on tion the re ver lich der und la que de os ar ión é ü ß".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    made = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n)]
    return " ".join(w + ("\n" if rng.random() < 0.05 else "") for w in made)


def awkward() -> list[tuple]:
    long = prose(1, 6000)
    some = prose(2, 120)
    rows = [
        (5, some, "en", "a", len(some)),
        (5, some, "en", "a", len(some)),  # a repeated row
        (5, prose(3, 60), "fr", "b", 1),  # the same id, another text
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, "   \n\t ", "de", None, 6),
        (4, long, None, "a", len(long)),
        (9, "one", "en", "b", 3),
        (8, some + " tail", "en", "b", 1),
        (7, some.upper(), "de", "b", 1),
        (None, prose(4, 90), "es", "a", 1),
        (None, None, "es", None, 1),
        (10, "x" * 5000, "en", "a", 5000),
        (11, "日本語 テキスト 🙂 " * 40, "en", "a", 1),
    ]
    return rows


def frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
