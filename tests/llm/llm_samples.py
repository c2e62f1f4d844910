"""Small frames for the tests of the operators."""

import random

from pyspark.sql import DataFrame, SparkSession

EXTRA = ("fp", "score", "_found", "shard", "ids", "kept", "component_id", "_row", "k", "part", "_h")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{c}` string" for c in EXTRA)


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Documents from (doc_id, text[, lang]), with extra columns whose names clash."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", None, *EXTRA) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    random.seed(seed)
    return " ".join(f"w{random.randrange(vocabulary)}" for _ in range(words))


#: Nulls, empty and blank texts, repeated rows, ties and one very long text.
ODD = [
    (None, None), (None, "no name here"), (1, None), (2, ""), (3, "   \n\t "), (4, "one"),
    (5, "one two"), (6, "A b C d"), (6, "A b C d"), (7, "a B c D"), (8, "#*$%&|<> !!!"),
    (9, "é漢字 😀 ▁ naïve"), (10, "line\nline\n\nother\nline"), (11, prose(1, 30_000)),
]
