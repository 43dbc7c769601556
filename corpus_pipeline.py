"""The corpus pipeline: toxicity, near duplicates, benchmark decontamination, personal data, packing.

Each stage takes (spark, docs, sf_dir), works on every row that the stage before it kept, and returns the columns of
``documents``; the last returns the packed pieces. `run` writes each stage's result to the shared scratch folder as
Parquet and reads it again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm import decontaminate, near_dedup, packing, pii, toxicity
from eventmart.llm.common import drop, prepare, table, written
from eventmart.llm.queries import tokenizer_path

#: Similarity, in hundredths, from which documents are near duplicates.
NEAR_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10; the lexicon is learned from all labelled documents of the input."""
    prepare(spark)
    return toxicity.keep(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7; the document with the smallest doc_id of each component stays."""
    prepare(spark)
    found = near_dedup.near_duplicates(docs.select("doc_id", "text"), percent=NEAR_PERCENT)
    return docs.join(found.where(~F.col("kept")).select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2; documents that hold a benchmark item go."""
    prepare(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4; every span is replaced by its kind."""
    prepare(spark)
    return pii.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6; every piece with its sequence and offset."""
    prepare(spark)
    return packing.pack(docs.select("doc_id", "text"), tokenizer_path(), size=2048, end_id=0)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", mask_personal_data),
    ("packing", pack_sequences),
]

#: No stage but the first filters can be told in SQL; the tests hold `run` against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs, path = written(stage(spark, docs, sf_dir), f"stage-{name}")
        if before:
            drop(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
