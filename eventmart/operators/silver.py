"""Canonical event projection."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.functions.props import PropertyReader
from eventmart.functions.text import clean_url, normalized_event_type
from eventmart.functions.timestamps import event_time, parse_timestamp_text
from eventmart.functions.urls import url_query_param

# Canonical table layout, in order.
SILVER_COLUMNS = [  # fixed values
    "event_id", "occurred_at_utc", "site_id", "event_type", "session_id", "user_id",
    "event_date", "event_hour", "search_query", "product_id", "category_id", "zero_results",
    "page_url", "referrer", "utm_source", "utm_medium", "utm_campaign", "_silver_updated_at",
]
SILVER_DATA_COLUMNS = [c for c in SILVER_COLUMNS if c != "_silver_updated_at"]

UTM_FIELDS = ("utm_source", "utm_medium", "utm_campaign")
PROPERTY_FIELDS = ["query", "search_query", "product_id", "category_id",
                   "zero_results", "zero_result", *UTM_FIELDS]
# Flag texts that mean "true" for zero_results.
TRUE_FLAGS = ("true", "1", "yes")


def first_present(df: DataFrame, *names: str, default: Column | None = None) -> Column:
    """The first non-null of the named columns as string; absent columns count as NULL."""
    cols = [F.col(n).cast("string") for n in names if n in df.columns]
    if default is not None:
        cols.append(default)
    if not cols:
        return F.lit(None).cast("string")
    return cols[0] if len(cols) == 1 else F.coalesce(*cols)


def normalize_silver_events(df: DataFrame, *, utm_from_url: bool = False,
                            carry: tuple[str, ...] = ()) -> DataFrame:
    """Raw/bronze rows -> canonical silver rows (``SILVER_COLUMNS`` order).

    Rows without event_id, site or a parseable event time are dropped (P7).
    Optional inputs (session_id, occurred_at_ts, url variants, properties, ...)
    may be absent.  ``utm_from_url`` enables the URL query-string fallback for
    UTM fields (R1).  ``carry`` appends extra input columns (e.g. ``_ingested_at``
    for dedup tie-breaks) after the canonical ones.
    """
    props = PropertyReader(df, PROPERTY_FIELDS)
    src = props.with_parsed(df)

    occurred = event_time(df)
    url = clean_url(first_present(df, "pageUrl", "url", "page_url", default=F.lit("")))
    zero_flag = F.lower(props.first("zero_results", "zero_result"))

    def utm(name: str) -> Column:
        value = props.get(name)
        return F.coalesce(value, url_query_param(url, name)) if utm_from_url else value

    out = src.select(
        first_present(df, "event_id").alias("event_id"),
        occurred.alias("occurred_at_utc"),
        first_present(df, "event_site_id", "site_id").alias("site_id"),
        normalized_event_type(first_present(df, "event_type")).alias("event_type"),
        first_present(df, "session_id").alias("session_id"),
        first_present(df, "user_id", "anonymous_id").alias("user_id"),
        F.to_date(occurred).alias("event_date"),
        F.hour(occurred).alias("event_hour"),
        props.first("query", "search_query").alias("search_query"),
        props.get("product_id").alias("product_id"),
        props.get("category_id").alias("category_id"),
        F.coalesce(zero_flag.isin(*TRUE_FLAGS), F.lit(False)).alias("zero_results"),
        url.alias("page_url"),
        first_present(df, "referrer").alias("referrer"),
        *[utm(u).alias(u) for u in UTM_FIELDS],
        F.current_timestamp().alias("_silver_updated_at"),
        *[F.col(c) for c in carry if c in df.columns],
    )
    return out.where(F.col("event_id").isNotNull() & F.col("site_id").isNotNull()
                     & F.col("occurred_at_utc").isNotNull())


def _mark(value: datetime | str) -> Column:
    """A receive or ingest mark; datetimes without a zone are UTC, whatever the host's zone is."""
    if isinstance(value, datetime):
        value = value.astimezone(timezone.utc) if value.tzinfo else value
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f+00:00")
    return F.lit(value).cast("timestamp")


def incremental_slice(bronze: DataFrame, *, since_ingested_at: datetime | str | None = None,
                      since_received_at: datetime | str | None = None) -> DataFrame:
    """Bronze rows ingested (and, if the column exists, received) strictly after the marks."""
    out = bronze
    if since_ingested_at is not None:
        out = out.where(F.col("_ingested_at") > _mark(since_ingested_at))
    if since_received_at is not None and "received_at" in bronze.columns:
        rtype = bronze.schema["received_at"].dataType
        received = (F.col("received_at") if isinstance(rtype, T.TimestampType)
                    else parse_timestamp_text(F.col("received_at").cast("string")))
        out = out.where(received > _mark(since_received_at))
    return out
