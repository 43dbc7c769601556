"""Latest-per-key deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns that differ from run to run.
AUDIT_COLUMNS = ("_silver_updated_at", "_gold_updated_at")


def dedup_latest(df: DataFrame, key: str = "event_id", time_col: str = "occurred_at_utc",
                 first_seen_col: str | None = "_ingested_at") -> DataFrame:
    """Keep one row per ``key``: latest ``time_col``; on a tie the earliest
    ``first_seen_col`` (when present); then the payload columns themselves, so
    reruns pick the same row.

    ``row_number() ... = 1`` lets Spark insert a partial WindowGroupLimit before
    the shuffle, so a hot key is cut to one row per map task before it is
    exchanged.
    """
    order: list[Column] = [F.col(time_col).desc_nulls_last()]
    if first_seen_col and first_seen_col in df.columns:
        order.append(F.col(first_seen_col).asc_nulls_last())
    for f in df.schema.fields:
        if f.name not in AUDIT_COLUMNS:
            plain = not isinstance(f.dataType, (T.MapType, T.StructType, T.ArrayType, T.VariantType))
            order.append((F.col(f.name) if plain else F.to_json(F.col(f.name))).asc_nulls_first())
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
