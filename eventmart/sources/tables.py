"""Catalog tables (S7-S11, S14) and partition-scoped rewrites.

Tables are Parquet, partitioned by ``event_date``.  Rewrites go through
``insertInto(overwrite=True)`` with dynamic partition overwrite, so only the
partitions present in the written frame are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.config import MartConfig
from eventmart.session import configure, materialize  # noqa: F401  (re-exported)


def table_exists(spark: SparkSession, fqn: str) -> bool:
    """S9."""
    return spark.catalog.tableExists(fqn)


def create_databases(spark: SparkSession, cfg: MartConfig, location_root: str | None = None) -> None:
    """The three namespaces; optionally placed under one shared folder."""
    for db in (cfg.bronze_db, cfg.silver_db, cfg.gold_db):
        where = f" LOCATION '{location_root.rstrip('/')}/{db}.db'" if location_root else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {cfg.namespace(db)}{where}")


def drop_databases(spark: SparkSession, cfg: MartConfig) -> None:
    """Drop the three namespaces with their tables and files."""
    for db in (cfg.bronze_db, cfg.silver_db, cfg.gold_db):
        spark.sql(f"DROP DATABASE IF EXISTS {cfg.namespace(db)} CASCADE")


def balanced(df: DataFrame, partition_cols: Sequence[str] = ("event_date",)) -> DataFrame:
    """REBALANCE on the partition columns before a partitioned write.

    AQE then sizes the write tasks from runtime statistics: small days are
    merged into few files and a skewed day is split over several tasks, so one
    hot day never lands on a single writer.
    """
    return df.hint("rebalance", *partition_cols) if partition_cols else df


def create_table(df: DataFrame, fqn: str, partition_cols: Sequence[str] = ("event_date",)) -> None:
    """First write of a table, partitioned."""
    writer = balanced(df, partition_cols).write.format("parquet").mode("overwrite")
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.saveAsTable(fqn)


def as_dates(values: Iterable) -> list[date | None]:
    return [v if v is None or isinstance(v, date) else date.fromisoformat(str(v)) for v in values]


def read_dates(spark: SparkSession, fqn: str, dates: Iterable | None = None,
               date_col: str = "event_date") -> DataFrame:
    """A table, optionally limited to ``date_col IN dates`` (partition pruning); None is the NULL day."""
    df = spark.read.table(fqn)
    ds = as_dates(dates or [])
    if not ds:
        return df
    wanted = F.col(date_col).isin([d for d in ds if d is not None])
    return df.where(wanted | F.col(date_col).isNull() if None in ds else wanted)


def distinct_dates(df: DataFrame, col: str = "event_date") -> list[date | None]:
    """Distinct partition values, the NULL day last; one row per day, so safe to bring to the driver."""
    return sorted((r[0] for r in df.select(col).distinct().collect()), key=lambda d: (d is None, d or date.min))


def overwrite_partitions(spark: SparkSession, df: DataFrame, fqn: str, *, date_col: str = "event_date") -> None:
    """Replace exactly the partitions present in ``df`` (dynamic overwrite).

    ``insertInto`` is positional, so columns are put in the table's order
    (partition columns last).
    """
    configure(spark)
    cols = spark.read.table(fqn).columns
    balanced(df.select(*cols), (date_col,)).write.insertInto(fqn, overwrite=True)


def drop_partitions(spark: SparkSession, fqn: str, dates: Iterable, date_col: str = "event_date") -> None:
    for d in filter(None, as_dates(dates)):
        spark.sql(f"ALTER TABLE {fqn} DROP IF EXISTS PARTITION ({date_col} = DATE '{d.isoformat()}')")


def sql_type(kind: T.DataType) -> str:
    """A type in DDL with its field names quoted, whatever characters they hold."""
    if isinstance(kind, T.StructType):
        return "struct<" + ", ".join(f"{quoted(f.name)}: {sql_type(f.dataType)}" for f in kind.fields) + ">"
    if isinstance(kind, T.ArrayType):
        return f"array<{sql_type(kind.elementType)}>"
    if isinstance(kind, T.MapType):
        return f"map<{sql_type(kind.keyType)}, {sql_type(kind.valueType)}>"
    return kind.simpleString()


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def add_missing_columns(spark: SparkSession, fqn: str, schema: T.StructType) -> list[str]:
    """``ALTER TABLE ADD COLUMNS`` for top-level fields the table lacks.

    Existing columns keep their type (additive evolution only).
    """
    have = {f.name.lower() for f in spark.read.table(fqn).schema.fields}
    new = [f for f in schema.fields if f.name.lower() not in have]
    if new:
        cols = ", ".join(f"{quoted(f.name)} {sql_type(f.dataType)}" for f in new)
        spark.sql(f"ALTER TABLE {fqn} ADD COLUMNS ({cols})")
        spark.catalog.refreshTable(fqn)
    return [f.name for f in new]
