"""Daily metric builders.

Each builder takes canonical silver rows and returns one row per metric key.
Distinct counts are exact.  Spark plans a single ``count_distinct`` as two
aggregation levels (exchange on key+value, then on key), both with map-side
partial aggregation, so a hot key is collapsed before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.functions.metrics import safe_ratio
from eventmart.functions.text import not_blank
from eventmart.functions.timestamps import whole_seconds_between

# Event types counted by the product metrics.
PRODUCT_VIEW_TYPES = ("product_view",)
ADD_TO_CART_TYPES = ("add_to_cart", "addtocart", "cart_add")
PURCHASE_TYPES = ("purchase", "order_complete", "checkout_complete")

# Merge keys of each gold table (J3-J7); all but site/date compare NULL-safely.
GOLD_KEYS = {
    "search_metrics": ["site_id", "event_date", "search_query"],
    "product_metrics": ["site_id", "event_date", "product_id"],
    "session_metrics": ["site_id", "event_date"],
    "page_metrics": ["site_id", "event_date", "page_url"],
    "funnel_metrics": ["site_id", "event_date", "funnel_step"],
}


def _stamp(df: DataFrame, audit: bool) -> DataFrame:
    return df.withColumn("_gold_updated_at", F.current_timestamp()) if audit else df


def search_metrics(silver: DataFrame, *, audit: bool = True) -> DataFrame:
    """A1: searches per (site, date, raw query text)."""
    e = silver.where(not_blank(F.col("search_query")))
    out = e.groupBy("site_id", "event_date", "search_query").agg(
        F.count(F.lit(1)).alias("search_count"),
        F.count_if(F.coalesce(F.col("zero_results"), F.lit(False))).alias("zero_result_searches"),
        F.count_distinct("session_id").alias("distinct_sessions"),
    )
    return _stamp(out, audit)


def product_metrics(silver: DataFrame, *, audit: bool = True) -> DataFrame:
    """A2: views, add-to-carts, purchases and the two rates per product."""
    et = F.col("event_type")
    out = (silver.where(F.col("product_id").isNotNull())
           .groupBy("site_id", "event_date", "product_id")
           .agg(F.count_if(et.isin(*PRODUCT_VIEW_TYPES)).alias("product_views"),
                F.count_if(et.isin(*ADD_TO_CART_TYPES)).alias("add_to_cart_events"),
                F.count_if(et.isin(*PURCHASE_TYPES)).alias("purchase_events"))
           .withColumn("add_to_cart_rate", safe_ratio(F.col("add_to_cart_events"), F.col("product_views")))
           .withColumn("purchase_conversion_rate", safe_ratio(F.col("purchase_events"), F.col("product_views"))))
    return _stamp(out, audit)


def per_session(silver: DataFrame) -> DataFrame:
    """A3: duration in whole seconds and bounce flag of each (site, date, session).

    A session bounces with one event or one distinct page. Sessions are cut at
    midnight because ``event_date`` is part of the key.
    """
    seconds = whole_seconds_between(F.min("occurred_at_utc"), F.max("occurred_at_utc"))
    bounces = (F.count(F.lit(1)) == 1) | (F.count_distinct("page_url") == 1)
    return (silver.where(F.col("session_id").isNotNull())
            .groupBy("site_id", "event_date", "session_id")
            .agg(seconds.alias("duration_seconds"), bounces.alias("is_bounce")))


def session_metrics(silver: DataFrame, *, audit: bool = True) -> DataFrame:
    """A4: sessions, average duration, bounces and bounce rate per (site, date)."""
    out = (per_session(silver)
           .groupBy("site_id", "event_date")
           .agg(F.count(F.lit(1)).alias("sessions"),
                F.avg("duration_seconds").alias("avg_duration_seconds"),
                F.count_if("is_bounce").alias("bounce_sessions"))
           .withColumn("bounce_rate", safe_ratio(F.col("bounce_sessions"), F.col("sessions"))))
    return _stamp(out, audit)


def page_metrics(silver: DataFrame, *, audit: bool = True) -> DataFrame:
    """A5: views, distinct sessions and distinct users per non-blank page URL.

    Rows are first collapsed to (site, date, url, session, user) with a view
    count, so the two distinct counts work on the reduced set.
    """
    keys = ["site_id", "event_date", "page_url"]
    reduced = (silver.where(not_blank(F.col("page_url")))
               .groupBy(*keys, "session_id", "user_id")
               .agg(F.count(F.lit(1)).alias("_views")))
    out = reduced.groupBy(*keys).agg(
        F.sum("_views").alias("page_views"),
        F.count_distinct("session_id").alias("distinct_sessions"),
        F.count_distinct("user_id").alias("distinct_users"),
    )
    return _stamp(out, audit)


def funnel_metrics(silver: DataFrame, *, audit: bool = True) -> DataFrame:
    """Events and distinct sessions per (site, date, event type as funnel step)."""
    out = (silver.groupBy("site_id", "event_date", F.col("event_type").alias("funnel_step"))
           .agg(F.count(F.lit(1)).alias("event_count"),
                F.count_distinct("session_id").alias("distinct_sessions")))
    return _stamp(out, audit)


BUILDERS = {
    "search_metrics": search_metrics,
    "product_metrics": product_metrics,
    "session_metrics": session_metrics,
    "page_metrics": page_metrics,
    "funnel_metrics": funnel_metrics,
}


def for_dates(silver: DataFrame, dates) -> DataFrame:
    """Restrict to ``event_date IN dates``; None or empty means all dates.

    On a table partitioned by event_date this becomes a partition filter.
    """
    if not dates:
        return silver
    return silver.where(F.col("event_date").isin(*[F.lit(d).cast("date") for d in dates]))
