r"""Operator 12: lines that many documents share, by levelled sorted runs of line hashes, with DataFrame functions only.

A line's key is the line without white space at its ends, A-Z lower-cased; it counts from ``min_chars`` code points. A
key held by at least ``min_docs`` documents loses all its lines but those of the largest doc_id that holds it.

The runs are tables of (hash, documents, largest doc_id), bucketed and sorted by hash, each hash in one run only
(`LineRuns`). Documents come in ``batches`` from the largest doc_ids to the smallest. A batch is reduced to its hashes,
which are the only rows that it shuffles; a merge join with each run, without exchange or sort of the run, tells
the hashes that no run holds (the batch's own new run) from those seen before (kept aside with their counts). Two runs
of one level are merged into one of the next, so there are never more runs than the logarithm of the batches.

Hashes are the first 128 bits of SHA-256. A key of any number of documents is counted by partial sums; the verdicts
come back through joins that AQE splits, as (doc_id, line number) of dropped lines only.

Edge cases: a null or empty text is one empty line; a null doc_id counts as one document, smaller than all others;
rows that repeat a doc_id are one document, and each gets its own result; a document all of whose lines go has the
empty text; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm.common import drop, written
from eventmart.session import scratch_dir

WHITE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ONE_FILE_SORTED = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(WHITE)), UPPER, UPPER.lower())


@contextlib.contextmanager
def _sorted_buckets(spark: SparkSession) -> Iterator[None]:
    """Within this, a bucket that is one file counts as sorted, as `LineRuns` writes it."""
    before = spark.conf.get(ONE_FILE_SORTED)
    spark.conf.set(ONE_FILE_SORTED, "true")
    try:
        yield
    finally:
        spark.conf.set(ONE_FILE_SORTED, before)


class LineRuns:
    """Sorted runs of line hashes by level; a hash stands in the run of the first batch that held it.

    Batches may come in any order and one at a time, but all rows of a doc_id belong to one batch.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.tables: dict[str, str] = {}

    def _store(self, rows: DataFrame) -> str:
        """Rows (h, ..., seen) as a bucketed table; a task holds one bucket, so a bucket is one sorted file."""
        name, path = f"line_run_{uuid.uuid4().hex[:12]}", scratch_dir(self.spark, "line-run")
        (rows.write.partitionBy("seen").bucketBy(self.buckets, "h").sortBy("h").option("path", path)
         .saveAsTable(name))
        self.tables[name] = path
        return name

    def _run(self, name: str) -> DataFrame:
        return self.spark.table(name).where("not seen").select("h", "n", "last")

    def runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def add(self, batch: DataFrame) -> None:
        """Merge-join ``batch`` (h, doc_id; any repeats) with every run, and add what none of them holds as a run."""
        own = (batch.select("h", "doc_id").distinct().groupBy("h")
               .agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("last")))
        with _sorted_buckets(self.spark):
            self._compact()
            earlier = []
            for k, name in enumerate(self.runs()):
                run = self._run(name).select("h", F.col("n").alias(f"n{k}"), F.col("last").alias(f"last{k}"))
                own = own.join(run.hint("merge"), "h", "left")
                earlier.append(k)
            found = lambda c: F.coalesce(*[F.col(f"{c}{k}") for k in earlier], F.lit(None).cast("long"))
            name = self._store(own.select("h", "n", "last", found("n").alias("n_before"),
                                          found("last").alias("last_before"), found("n").isNotNull().alias("seen")))
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(name)

    def _compact(self) -> None:
        """Merge two runs of a level into one of the next; they share no hash, so the full merge join is their union."""
        level = 0
        while level < len(self.levels):
            if len(self.levels[level]) == 2:
                one, two = (self._run(name) for name in self.levels[level])
                two = two.select("h", F.col("n").alias("n2"), F.col("last").alias("last2"))
                both = one.join(two.hint("merge"), "h", "full")
                merged = self._store(both.select(
                    "h", F.coalesce("n", "n2").alias("n"), F.coalesce("last", "last2").alias("last"),
                    F.lit(None).cast("long").alias("n_before"), F.lit(None).cast("long").alias("last_before"),
                    F.lit(False).alias("seen")))
                self.levels[level] = []
                if level + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[level + 1].append(merged)
            level += 1

    def shared(self, min_docs: int) -> DataFrame:
        """(h, last): hashes of at least ``min_docs`` documents and the largest doc_id that holds each."""
        first = [self._run(name).where("n > 1").select("h", F.lit(0).cast("long").alias("n"), F.col("n").alias("n_before"),
                                                       "last") for name in self.runs()]
        again = [self.spark.table(name).where("seen").select("h", "n", "n_before", F.greatest("last", "last_before").alias("last"))
                 for name in self.tables]
        counted = reduce(DataFrame.unionByName, first + again).groupBy("h").agg(
            (F.sum("n") + F.max("n_before")).alias("n"), F.max("last").alias("last"))
        return counted.where(F.col("n") >= min_docs).select("h", "last")

    def drop(self) -> None:
        for name, path in self.tables.items():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            drop(self.spark, path)
        self.tables, self.levels = {}, []


def _batch(docs: DataFrame, batches: int) -> Column:
    """Batch 0 has the largest doc_ids; the cuts are approximate quantiles, so that the batches are near equal."""
    cuts = docs.agg(F.percentile_approx("doc_id", [k / batches for k in range(1, batches)], 10_000).alias("c")).first()["c"]
    after = [F.when(F.col("doc_id") > cut, 0).otherwise(1) for cut in cuts or []]
    return sum(after, F.lit(0)).alias("batch")


def dropped_lines(docs: DataFrame, min_chars: int, min_docs: int, batches: int) -> DataFrame:
    """(doc_id, x, dropped): numbers of the dropped lines, ascending, of each text (x: its hash) that loses any."""
    spark = docs.sparkSession
    # Hashed before the lines are taken apart, so that no line carries its text along.
    lines = (docs.select(_batch(docs, batches), "doc_id", F.xxhash64("text").alias("x"),
                         F.split("text", "\n", -1).alias("lines"))
             .select("batch", "doc_id", "x", F.posexplode("lines").alias("at", "line"))
             .withColumn("key", line_key(F.col("line"))).where(F.length("key") >= min_chars)
             .select("batch", F.unhex(F.substring(F.sha2("key", 256), 1, 32)).alias("h"), "doc_id", "x", "at"))
    path = scratch_dir(spark, "line-hashes")
    lines.write.partitionBy("batch").parquet(path)
    schema = "h binary, doc_id long, x long, at int, batch int"
    lines = spark.read.schema(schema).parquet(path)

    runs = LineRuns(spark)
    for batch in range(batches):
        runs.add(lines.where(F.col("batch") == batch))
    shared, shared_path = written(runs.shared(min_docs), "shared-lines")
    runs.drop()
    found = (lines.drop("batch").join(shared, "h").where(F.col("doc_id").isNull() | (F.col("doc_id") < F.col("last")))
             .groupBy("doc_id", "x").agg(F.sort_array(F.collect_set("at")).alias("dropped")))
    found, _ = written(found, "dropped-lines")
    drop(spark, path, shared_path)
    return found


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, batches: int = 8) -> DataFrame:
    """doc_id, text without the lines that are dropped, n_lines before that, and n_dropped, one row for each of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    found = dropped_lines(docs, min_chars, min_docs, batches).select(
        F.col("doc_id").alias("found_id"), F.col("x").alias("found_x"), "dropped")
    rows = (docs.join(found, F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.xxhash64("text") == F.col("found_x")), "left")
            .select("doc_id", "text", "dropped", F.split("text", "\n", -1).alias("lines")))
    rows = rows.select("doc_id", "text", "dropped", "lines", F.size("lines").cast("long").alias("n_lines"), F.concat(
        F.array(F.lit(-1)), "dropped", F.array(F.size("lines"))).alias("stops"))
    # What stays are the stretches between two stops.
    stretch = lambda i: F.slice("lines", F.get("stops", i) + 2, F.get("stops", i + 1) - F.get("stops", i) - 1)
    kept = F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size("dropped")), stretch)), "\n")
    return rows.select("doc_id", F.when(F.col("dropped").isNull(), F.col("text")).otherwise(kept).alias("text"), "n_lines",
                       F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"))
