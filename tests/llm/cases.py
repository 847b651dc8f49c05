"""Small tables for the tests of the llm operators."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use inside; they must not get in the way.
CLASH = ["score", "node", "n", "a", "b", "shard", "_doc", "_hits", "_found", "salt", "component", "_gone",
         "text_crc32", "curve", "_key", "host", "kind", "n_lines"]

VOCABULARY = [f"w{i}" for i in range(60)] + ["Élan", "straße", "naïve", "日本"]


def prose(rng: random.Random, words: int) -> str:
    return " ".join(rng.choice(VOCABULARY) + rng.choice(["", "", "", ".", ","]) for _ in range(words))


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and long texts, ties and repeated rows."""
    long_text = "\n".join(f"line {i} of a long text with several words" for i in range(4000))
    same = "one two three four five six seven eight nine ten"
    return [
        (1, None, None, None, None), (2, "", "en", "s", 0), (3, " \t\n ", "en", "s", 4),
        (4, same, "en", None, len(same)), (5, same, None, "s", len(same)), (6, same.upper(), "de", "t", None),
        (7, long_text, "en", "s", len(long_text)), (8, "word", "en", "s", 4), (8, "word", "en", "s", 4),
        (None, "text of a row without id, long enough for shingles", "en", "s", 50),
        (None, None, None, None, None), (9, "日本 Élan naïve straße   x\x0by", "ja", "u", 20),
        (10, "a\r\nb\n\nc\n", "en", "s", 7), (-3, "negative id", "en", "s", 11),
    ]


def documents(spark: SparkSession, rows: list[tuple] | None = None, clash: bool = True) -> DataFrame:
    from pyspark.sql import functions as F
    df = spark.createDataFrame(odd_rows() if rows is None else rows, SCHEMA)
    return df.select("*", *[F.lit("extra").alias(c) for c in CLASH]) if clash else df
