import random

import pytest
from pyspark.sql import DataFrame, SparkSession

# the columns of documents, and some whose names operators use inside
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, kept string, key string,"
    " size string, high string, leaf string, c0 string, vid string, block string, was_null string, sha string"
)
EXTRA = ["x"] * 11


def table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Documents from ``doc_id, text[, lang]`` rows, with columns whose names clash."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src0", len(r[1] or ""), *EXTRA) for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    parts = ["an", "er", "tion", "the", "in", "re", "ou", "st", "nd", "ble"]
    return " ".join("".join(draw.choice(parts) for _ in range(draw.randint(1, 3))) for _ in range(words))


@pytest.fixture(scope="session")
def odd_rows() -> list[tuple]:
    """Nulls, empty and long texts, ties, repeated rows, odd characters."""
    long = prose(1, 30_000)
    return [
        (1, None), (2, ""), (3, ""), (None, "no id"), (None, "no id"), (None, None), (4, " \t\n\x0b"), (5, long), (6, long),
        (7, "same text here"), (7, "same text here"), (8, "same text here"), (9, "a"), (10, "Zoë  über x y 漢字 🙂▁<|endoftext|> </s>"),
        (11, "x" * 5000), (12, "\n\nline\nline\n\nLINE\n line"), (13, "#*$ | <b> & 100%"), (14, "ſK İ ß"), (15, "12 34 !!"),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return table(spark, odd_rows)


@pytest.fixture(scope="session")
def empty(spark):
    return table(spark, [])


def edited_copies(text: str, count: int) -> list[str]:
    """Copies of a text with one word in another place replaced in each."""
    words = text.split(" ")
    return [" ".join([*words[: 4 * i], f"other{i}", *words[4 * i + 1 :]]) for i in range(count)]
