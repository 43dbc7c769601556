"""Which days hold an event id, without reading the table: 64-bit fingerprints of ids by day.

The index of a table is a table of its own, ``<table>_ids``, partitioned by ``event_date`` like it, with one sorted
fingerprint for each id of a day: eight bytes an event instead of the id and time columns of all history. A batch's
fingerprints are looked up there; only days with a hit are opened, and there the ids are compared exactly.

It may hold more than the table (ids that moved to another day, a write that did not finish), which costs an opened
day, but never less: entries are written before the rows, and days of the table that the index lacks are read
into it first. One writer is assumed, as for the table.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.sources.tables import balanced, distinct_dates, drop_partitions, read_dates, table_exists


def index_name(fqn: str) -> str:
    return f"{fqn}_ids"


def fingerprint(event_id: Column) -> Column:
    return F.xxhash64(event_id)


def _entries(rows: DataFrame) -> DataFrame:
    return rows.select(fingerprint(F.col("event_id")).alias("fp"), "event_date")


def days_of(spark: SparkSession, fqn: str) -> set[date]:
    """Days that have a partition, from the catalog alone."""
    found = (r[0].rpartition("=")[2] for r in spark.sql(f"SHOW PARTITIONS {fqn}").collect())
    return {date.fromisoformat(d) for d in found if d != "__HIVE_DEFAULT_PARTITION__"}


def ensure_index(spark: SparkSession, fqn: str) -> list[date]:
    """Create the index, or read into it the days of the table that it lacks; those days."""
    name = index_name(fqn)
    if not table_exists(spark, name):
        spark.sql(f"CREATE TABLE {name} (fp BIGINT, event_date DATE) USING parquet PARTITIONED BY (event_date)")
    missing = sorted(days_of(spark, fqn) - days_of(spark, name))
    if missing:
        add_entries(spark, fqn, read_dates(spark, fqn, missing), missing)
    return missing


def add_entries(spark: SparkSession, fqn: str, rows: DataFrame, days: Sequence[date]) -> None:
    """Enter ``rows`` (event_id, event_date), all of them in ``days``; these days of the index are rewritten, sorted."""
    name = index_name(fqn)
    held = read_dates(spark, name, days).select("fp", "event_date")
    whole = held.unionByName(_entries(rows)).distinct()
    # REBALANCE sizes the files, as for the table; the sort keeps a file's fingerprints close, which packs them.
    (balanced(whole, ("event_date",)).sortWithinPartitions("event_date", "fp").select("fp", "event_date")
     .write.insertInto(name, overwrite=True))
    spark.catalog.refreshTable(name)


def days_with(spark: SparkSession, fqn: str, batch: DataFrame) -> list[date]:
    """Days of the table that may hold an id of ``batch``; reads the index only."""
    index = spark.read.table(index_name(fqn))
    wanted = batch.select(fingerprint(F.col("event_id")).alias("fp")).distinct()
    return distinct_dates(index.join(wanted, "fp", "left_semi"))  # one row a day


def drop_days(spark: SparkSession, fqn: str, days: Sequence[date]) -> None:
    drop_partitions(spark, index_name(fqn), days)


def bytes_of(spark: SparkSession, fqn: str, days: Sequence[date] | None = None) -> int:
    """Bytes of the files of a table, or of some of its days, by the file system."""
    df = spark.read.table(fqn) if days is None else read_dates(spark, fqn, days) if days else None
    total = 0
    for file in df.inputFiles() if df is not None else ():
        at = spark._jvm.org.apache.hadoop.fs.Path(file)
        total += at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).getLen()
    return total
