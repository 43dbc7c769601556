"""Dashboard queries over gold and silver.

Each sort adds the metric key as a tie-break so equal metric values give the
same rows on every run.  ``orderBy(...).limit(n)`` plans as
TakeOrderedAndProject: a per-partition top-n, then one merge of n rows each.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _site_day(df: DataFrame, site_id: str, day: date | str) -> DataFrame:
    return df.where((F.col("site_id") == site_id) & (F.col("event_date") == F.lit(day).cast("date")))


def top_searches(search_metrics: DataFrame, site_id: str, day: date | str, limit: int = 50) -> DataFrame:
    """K1: top searches of one site and day."""
    return (_site_day(search_metrics, site_id, day)
            .select("search_query", "search_count", "zero_result_searches")
            .orderBy(F.col("search_count").desc(), F.col("search_query").asc_nulls_last())
            .limit(limit))


def top_products(product_metrics: DataFrame, site_id: str, day: date | str, limit: int = 100) -> DataFrame:
    """K2: product funnel snapshot of one site and day."""
    return (_site_day(product_metrics, site_id, day)
            .select("product_id", "product_views", "add_to_cart_events", "purchase_events",
                    "purchase_conversion_rate")
            .orderBy(F.col("product_views").desc(), F.col("product_id").asc_nulls_last())
            .limit(limit))


def session_quality(session_metrics: DataFrame, since: date | str) -> DataFrame:
    """K3: session quality from a date on, newest first."""
    return (session_metrics.where(F.col("event_date") >= F.lit(since).cast("date"))
            .select("site_id", "event_date", "sessions", "avg_duration_seconds", "bounce_rate")
            .orderBy(F.col("event_date").desc(), F.col("site_id").asc()))


def silver_sample(silver: DataFrame, site_id: str, day: date | str, limit: int = 100) -> DataFrame:
    """K4: a sample of canonical events of one site and day (first ids, for repeatability)."""
    return (_site_day(silver, site_id, day)
            .select("event_id", "occurred_at_utc", "event_type", "search_query", "product_id")
            .orderBy("event_id")
            .limit(limit))
