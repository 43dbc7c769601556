"""Helpers shared by the operators: table access, scratch tables, ordered prefix sums, components."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventmart.session import scratch_dir, state_root

#: Rows of one Arrow batch; bounds a Python worker's memory when documents are long.
ARROW_ROWS = 512
#: Rows of one block of `prefix_sums` are 2 ** this.
BLOCK_BITS = 8
_ROW_BITS = 33  # bits that monotonically_increasing_id() keeps for the row


def prepare(spark: SparkSession) -> None:
    """Session settings of the operators: the shared folder, the batch size, and where workers find the package.

    The path helps workers that see the same files; a cluster gets the package by ``--py-files`` or an installation.
    """
    state_root(spark)
    home = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if home not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [home, env.get("PYTHONPATH", "")]))
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet in the shared scratch folder and read it back: cut lineage that survives executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop(spark: SparkSession, *paths: str) -> None:
    """Delete scratch tables that no later plan reads."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """doc_id, text and the other columns of ``labels`` for at most ``rows`` labelled documents, by a hash of doc_id.

    One row for each doc_id, however often it stands in either table: the least labels, and the text with the least
    hash. The rows are chosen without their texts, and as there are at most ``rows`` of them, they can be broadcast.
    """
    marks = [c for c in labels.columns if c != "doc_id"]
    one = labels.groupBy("doc_id").agg(F.min(F.struct(*marks)).alias("_marks")).select("doc_id", "_marks.*")
    there = one.join(docs.select("doc_id"), "doc_id", "left_semi")
    chosen = there.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return (found.groupBy("doc_id", *marks).agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
            .select("doc_id", "text", *marks))


def place(df: DataFrame, *order: str, tag: str) -> tuple[DataFrame, str]:
    """Sort globally by ``order`` and number the rows with ``_at`` (partition, row), fixed by writing the table.

    Range partitions split a key of any size as long as the order columns tell its rows apart.
    """
    numbered = (df.repartitionByRange(*order).sortWithinPartitions(*order)
                .withColumn("_at", F.monotonically_increasing_id()))
    return written(numbered, tag)


def prefix_sums(placed: DataFrame, *measures: str) -> DataFrame:
    """Add ``before_<m>`` (sum over all rows with a smaller ``_at``) and ``total_<m>`` for each measure.

    Three levels: rows within a block of 256, blocks within a partition, and one row per partition. Only the
    last level meets in a single task, and it has one row for each partition of the sort.
    """
    rows = placed.withColumn("_block", F.shiftright("_at", BLOCK_BITS))
    sums = [F.sum(m).alias(m) for m in measures]
    earlier = lambda part, by: (Window.partitionBy(*part).orderBy(by)
                                .rowsBetween(Window.unboundedPreceding, -1))
    ahead = lambda m, w: F.coalesce(F.sum(m).over(w), F.lit(0))

    blocks = (rows.groupBy("_block").agg(*sums)
              .withColumn("_part", F.shiftright("_block", _ROW_BITS - BLOCK_BITS)))
    parts = blocks.groupBy("_part").agg(*sums)
    everything = Window.partitionBy()
    parts = parts.select("_part", *[ahead(m, earlier((), "_part")).alias(f"_p_{m}") for m in measures],
                         *[F.sum(m).over(everything).alias(f"total_{m}") for m in measures])
    blocks = (blocks.select("_part", "_block", *[ahead(m, earlier(("_part",), "_block")).alias(f"_b_{m}")
                                                 for m in measures])
              .join(parts, "_part"))
    blocks = blocks.select("_block", *[(F.col(f"_b_{m}") + F.col(f"_p_{m}")).alias(f"_b_{m}") for m in measures],
                           *[f"total_{m}" for m in measures])
    rows = rows.select("*", *[ahead(m, earlier(("_block",), "_at")).alias(f"_r_{m}") for m in measures])
    rows = rows.join(blocks, "_block")
    for m in measures:
        rows = rows.withColumn(f"before_{m}", F.col(f"_r_{m}") + F.col(f"_b_{m}"))
    return rows.drop("_block", *[f"_{x}_{m}" for m in measures for x in "rb"])


def components(edges: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """Connected components of edges (a, b): one row (node, comp) per node, comp its smallest reachable node.

    Alternating large-star and small-star rounds; each round is written to the shared scratch folder. A node's
    edges meet only in aggregates with map-side combining and in joins that AQE can split.
    """
    spark = edges.sparkSession
    pairs, path = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                          .where("u <> v").distinct(), f"{tag}-edges")
    state = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = (joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        after, new_path = written(small, f"{tag}-edges")
        drop(spark, path)
        pairs, path = after, new_path
        seen = pairs.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if (seen["n"], seen["h"]) == state:
            break
        state = (seen["n"], seen["h"])
    nodes = pairs.select(F.col("u").alias("node"), F.col("v").alias("comp"))
    return nodes.unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()), path


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Cut a stream of batches, sorted by ``keys``, into one table per key; a group may span batches."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        part = pa.Table.from_batches([batch])
        values = list(zip(*(part.column(k).to_pylist() for k in keys), strict=True))
        start = 0
        for i, value in enumerate(values):
            if value != last:
                if i > start:
                    held.append(part.slice(start, i - start))
                if held:
                    yield pa.concat_tables(held)
                held, start, last = [], i, value
        held.append(part.slice(start))
    if held:
        yield pa.concat_tables(held)
