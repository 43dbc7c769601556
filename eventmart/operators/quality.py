"""Data-quality checks, quarantine and ingestion monitoring."""

from __future__ import annotations

import functools
import operator
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.functions.metrics import safe_ratio
from eventmart.functions.timestamps import event_time
from eventmart.operators.bronze import with_rescued_fields
from eventmart.operators.silver import first_present


def _rules(df: DataFrame) -> dict[str, Column]:
    """Rule name -> rejecting condition, for raw-layer rows (same validity as silver P7).

    An unreadable line counts when the canonical layer rejects its row; one whose readable fields make a valid row
    is a type conflict (`_type_conflict`), reported but not rejected.
    """
    raw_time = F.col("occurred_at").cast("string") if "occurred_at" in df.columns else F.lit(None)
    parsed = event_time(df)
    site = first_present(df, "event_site_id", "site_id")
    event_id = F.col("event_id") if "event_id" in df.columns else F.lit(None)
    rules = {
        "missing_event_id": event_id.isNull(),
        "missing_occurred_at": raw_time.isNull() & parsed.isNull(),
        "unparseable_occurred_at": raw_time.isNotNull() & parsed.isNull(),
        "missing_site_id": site.isNull(),
    }
    if "_corrupt_record" in df.columns:
        rules["corrupt_record"] = F.col("_corrupt_record").isNotNull() & _any(rules)
    return rules


def _any(rules: dict[str, Column]) -> Column:
    return functools.reduce(operator.or_, rules.values())


def _type_conflict(df: DataFrame, rules: dict[str, Column]) -> dict[str, Column]:
    if "_corrupt_record" not in df.columns:
        return {}
    return {"type_conflicts": F.col("_corrupt_record").isNotNull() & ~_any(rules)}


def _ingest_date(df: DataFrame) -> Column:
    return F.to_date("_ingested_at") if "_ingested_at" in df.columns else F.lit(None).cast("date")


def dq_checks(bronze: DataFrame) -> DataFrame:
    """Per ingest date, row count, failing rows per rule and type conflicts, in one pass."""
    bronze = with_rescued_fields(bronze)
    rules = _rules(bronze)
    return (bronze.groupBy(_ingest_date(bronze).alias("ingest_date"))
            .agg(F.count(F.lit(1)).alias("rows"),
                 *[F.count_if(cond).alias(name) for name, cond in (rules | _type_conflict(bronze, rules)).items()],
                 F.count_if(_any(rules)).alias("invalid_rows")))


def quarantine(bronze: DataFrame) -> DataFrame:
    """Rows the canonical layer rejects, with the comma-separated failed rules."""
    rules = _rules(bronze)
    reasons = F.concat_ws(",", *[F.when(cond, F.lit(name)) for name, cond in rules.items()])
    return (bronze.select(
                F.col("event_id").cast("string").alias("event_id") if "event_id" in bronze.columns
                else F.lit(None).cast("string").alias("event_id"),
                first_present(bronze, "event_site_id", "site_id").alias("site_id"),
                event_time(bronze).alias("event_time"),
                _ingest_date(bronze).alias("ingest_date"),
                reasons.alias("reasons"))
            .where(F.col("reasons") != ""))


def source_of(path: Column) -> Column:
    """The site partition of a raw file path, '' when the path has none."""
    return F.regexp_extract(path, r"site_id=([^/]+)", 1)


def ingest_lag(bronze: DataFrame) -> DataFrame:
    """Per ingest date and source: rows, bad rows and lag (whole seconds) from event to ingest."""
    parsed = event_time(bronze)
    lag = F.unix_timestamp("_ingested_at") - F.unix_timestamp(parsed)
    bad = _any(_rules(bronze))
    return (bronze.groupBy(_ingest_date(bronze).alias("ingest_date"),
                           source_of(F.col("_source_file")).alias("source"))
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.count_if(bad).alias("bad_rows"),
                 F.avg(lag).alias("avg_lag_seconds"),
                 F.max(lag).alias("max_lag_seconds")))


def lag_parts(bronze: DataFrame, seen_until: datetime | None, allowed_seconds: int) -> DataFrame:
    """R11 in flight: mergeable parts of `ingest_lag` over some rows, with a sketch of the lags and late rows apart.

    A row is late if its event lies more than ``allowed_seconds`` before ``seen_until``, the newest event of earlier rows.
    """
    bronze = with_rescued_fields(bronze)
    parsed = event_time(bronze)
    lag = F.unix_timestamp("_ingested_at") - F.unix_timestamp(parsed)
    late = (F.lit(False) if seen_until is None
            else F.coalesce(F.unix_timestamp(parsed) < F.unix_timestamp(F.lit(seen_until)) - allowed_seconds, F.lit(False)))
    return (bronze.groupBy(_ingest_date(bronze).alias("ingest_date"), source_of(F.col("_source_file")).alias("source"))
            .agg(F.count(F.lit(1)).alias("rows"), F.count_if(_any(_rules(bronze))).alias("bad_rows"),
                 F.count_if(late).alias("late_rows"), F.count(lag).alias("lags"), F.sum(lag).alias("lag_sum"),
                 F.max(lag).alias("lag_max"), F.max(parsed).alias("newest_event"), F.kll_sketch_agg_bigint(lag).alias("lag_sketch")))


def lag_totals(parts: DataFrame) -> DataFrame:
    """The columns of `ingest_lag` from stored parts, with late rows and approximate lag quantiles (KLL sketches, merged)."""
    sketch = F.kll_merge_agg_bigint("lag_sketch")
    at = lambda q: F.when(F.col("_lags") > 0, F.kll_sketch_get_quantile_bigint("_sketch", F.lit(q)))
    return (parts.groupBy("ingest_date", "source")
            .agg(F.sum("rows").alias("rows"), F.sum("bad_rows").alias("bad_rows"), F.sum("late_rows").alias("late_rows"),
                 F.sum("lags").alias("_lags"), F.sum("lag_sum").alias("_sum"), F.max("lag_max").alias("max_lag_seconds"),
                 sketch.alias("_sketch"))
            .select("ingest_date", "source", "rows", "bad_rows", safe_ratio(F.col("_sum"), F.col("_lags")).alias("avg_lag_seconds"),
                    "max_lag_seconds", "late_rows", at(0.5).alias("p50_lag_seconds"), at(0.95).alias("p95_lag_seconds")))


def quarantine_records(bronze: DataFrame) -> DataFrame:
    """R10 rows for storage: reasons, source file, the raw row as JSON text, its hash and its number among equal rows."""
    payload = [c for c in bronze.columns if c not in ("_ingested_at", "event_date", "occurred_at_ts")]
    # The record is the row as it is stored; it is judged with the fields that `_rescued` holds, and written as text only
    # if it is rejected.
    bronze = with_rescued_fields(bronze.withColumn("_raw_record", F.struct(*[F.col(c) for c in payload])))
    rules = _rules(bronze)
    reasons = F.concat_ws(",", *[F.when(cond, F.lit(name)) for name, cond in rules.items()])
    source = F.col("_source_file") if "_source_file" in bronze.columns else F.lit(None).cast("string")
    event_id = F.col("event_id").cast("string") if "event_id" in bronze.columns else F.lit(None).cast("string")
    rows = (bronze.where(_any(rules))
            .select(event_id.alias("event_id"), reasons.alias("reasons"), source.alias("source_file"),
                    F.to_json("_raw_record").alias("raw_record"), _ingest_date(bronze).alias("ingest_date"))
            .withColumn("_row_hash", F.sha2("raw_record", 256)).where(F.col("reasons") != ""))
    # Equal rows of one file are numbered; a file is ingested once, so the numbers are the same in every slice.
    equal = Window.partitionBy("ingest_date", "_row_hash", "source_file").orderBy("raw_record")
    return rows.withColumn("_copy", F.row_number().over(equal))
