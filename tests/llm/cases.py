"""Shared fixtures: awkward documents, with extra columns named like the operators' own."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession

EXTRA = ("size", "shard", "part", "start", "score", "kept", "n", "id", "bands", "key", "terms", "before_size", "_at")
SCHEMA = "doc_id long, text string, " + ", ".join(f"{c} string" for c in EXTRA)

LONG = " ".join(f"w{i % 977}x{i}" for i in range(60_000))
TEXTS: list[tuple[int | None, str | None]] = [
    (1, None), (2, ""), (3, "one"), (3, "one"), (4, " \t\n"), (5, "the cat sat on the mat again"),
    (6, "the cat sat on the mat again"), (None, "a text that has no number of its own"), (None, None), (7, LONG),
    (8, LONG + " end"), (9, "émoji 😀 and ünïcode text"), (10, "x" * 50_000),
]


def frame(spark: SparkSession, rows=TEXTS) -> DataFrame:
    return spark.createDataFrame([(*r, *["z"] * len(EXTRA)) for r in rows], SCHEMA)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^ \t-\r]+", text or "")


def babble(rng: np.random.Generator, n: int, vocabulary: int = 400) -> list[str]:
    return [f"{'abcdefghij'[int(k) % 10]}{int(k)}" for k in rng.integers(0, vocabulary, n)]
