"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

All of them derive their input from the driver's tables (``events``,
``pages``) through ``sources.fixtures`` and run over the whole table.  Audit
timestamps (``_silver_updated_at``, ``_gold_updated_at``) are left out of the
results because they differ on every run.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.functions.urls import url_query_param
from eventmart.operators import bi, features, gold, quality
from eventmart.plans import table_flows
from eventmart.operators.bronze import rename_sdk_fields
from eventmart.operators.dedup import dedup_latest
from eventmart.operators.silver import SILVER_DATA_COLUMNS, incremental_slice, normalize_silver_events
from eventmart.operators.upsert import merge_replace, upsert_latest
from eventmart.session import configure, materialize
from eventmart.sources.fixtures import bronze_like, raw_events, read_table

Query = Callable[[SparkSession, str], DataFrame]

# Fixed query parameters (dashboard site/day, recompute windows, watermarks).
BI_SITE = "site_1"
BI_DAY = "2024-01-16"
QUALITY_SINCE = "2024-01-20"
RECOMPUTE_DATES = ["2024-01-03", "2024-01-17"]
RECENT_FROM = "2024-01-20"
SINCE_INGESTED = "2024-01-15 00:00:00"
SINCE_RECEIVED = "2024-01-10 00:00:00"


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return normalize_silver_events(raw_events(spark, sf_dir)).select(*SILVER_DATA_COLUMNS)


def _with_ingest(df: DataFrame) -> DataFrame:
    return normalize_silver_events(df, carry=("_ingested_at",)).drop("_silver_updated_at")


def silver_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    rows = _with_ingest(raw_events(spark, sf_dir, with_copies=True))
    return dedup_latest(rows).select(*SILVER_DATA_COLUMNS)


def stored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The canonical rows as a stored target: derived once per run and checkpointed,
    so the upsert's key scan and rewrite read it instead of re-deriving it."""
    return materialize(silver(spark, sf_dir))


def upserted_silver(spark: SparkSession, sf_dir: str, target: DataFrame | None = None) -> DataFrame:
    target = stored_silver(spark, sf_dir) if target is None else target
    incoming = _with_ingest(raw_events(spark, sf_dir, copies_only=True))
    return upsert_latest(target, incoming)


def silver_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    sliced = incremental_slice(bronze_like(spark, sf_dir), since_ingested_at=SINCE_INGESTED,
                               since_received_at=SINCE_RECEIVED)
    return normalize_silver_events(sliced).select(*SILVER_DATA_COLUMNS)


def _gold(builder) -> Query:
    return lambda spark, sf: builder(silver(spark, sf), audit=False)


def gold_for_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.session_metrics(gold.for_dates(silver(spark, sf_dir), RECOMPUTE_DATES), audit=False)


def gold_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = stored_silver(spark, sf_dir)
    target = gold.product_metrics(base, audit=False)
    recent = upserted_silver(spark, sf_dir, base).where(F.col("event_date") >= F.lit(RECENT_FROM).cast("date"))
    incoming = gold.product_metrics(recent, audit=False)
    return merge_replace(target, incoming, gold.GOLD_KEYS["product_metrics"])


def silver_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P9, P10 with datetime marks: one without a zone (UTC), one with an offset; equal to the text marks."""
    configure(spark)
    sliced = incremental_slice(bronze_like(spark, sf_dir),
                               since_ingested_at=datetime.fromisoformat(SINCE_INGESTED),
                               since_received_at=datetime.fromisoformat("2024-01-10 05:30:00+05:30"))
    return normalize_silver_events(sliced).select(*SILVER_DATA_COLUMNS)


# Raw-layer names of fields that the canonical layer does not have, under SDK names.
CLIENT_FIELDS = {"userAgent": "user_agent", "deviceType": "device_type", "browserLanguage": "browser_language",
                 "sdkVersion": "sdk_version"}


def silver_sdk_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 with all SDK names, ``pageUrl`` and a map payload: the canonical rows stay the same."""
    configure(spark)
    raw = raw_events(spark, sf_dir)
    raw = raw.withColumn("event_site_id", F.coalesce("event_site_id", "site_id")).drop("site_id")
    old = {"event_id": "eventId", "event_type": "eventType", "occurred_at": "occurredAt", "received_at": "receivedAt",
           "session_id": "sessionId", "anonymous_id": "anonymousId", "event_site_id": "siteId", "url": "pageUrl"}
    sdk = raw.withColumnsRenamed(old).select(
        "*", *[F.concat(F.lit(f"{dst}-"), F.col("_path_site")).alias(src) for src, dst in CLIENT_FIELDS.items()])
    sdk = sdk.withColumn("properties", F.from_json("properties", "map<string,string>"))
    client = tuple(CLIENT_FIELDS.values())
    return normalize_silver_events(rename_sdk_fields(sdk), carry=client).select(*SILVER_DATA_COLUMNS, *client)


def gold_product_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2, C3 with every spelling of cart and purchase events, and a struct payload."""
    configure(spark)
    fields = "struct<query:string,search_query:string,product_id:string,category_id:string,zero_results:string,zero_result:string>"
    raw = raw_events(spark, sf_dir).withColumn("properties", F.from_json("properties", fields))
    kind = F.trim(F.lower("event_type"))
    turn = F.pmod(F.xxhash64("event_id", "occurred_at"), F.lit(3)) + 1
    for types in (gold.ADD_TO_CART_TYPES, gold.PURCHASE_TYPES):
        spelled = F.element_at(F.array(*[F.lit(t) for t in types]), turn.cast("int"))
        raw = raw.withColumn("event_type", F.when(kind == types[0], F.concat(F.lit(" "), F.initcap(spelled)))
                             .otherwise(F.col("event_type")))
    return gold.product_metrics(normalize_silver_events(raw), audit=False)


def silver_utm_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1 within the canonical layer: the payload's campaign first, then the URL's."""
    configure(spark)
    raw = raw_events(spark, sf_dir)
    tagged = F.concat(F.rtrim(F.regexp_replace("url", "\t", "")), F.lit("?utm_source=a|b&utm_medium=m%20"), F.col("_path_site"),
                      F.lit("&utm_campaign=#utm_campaign=x"))
    raw = raw.withColumn("url", F.when(F.trim("url") != "", tagged))
    return normalize_silver_events(raw, utm_from_url=True).select("event_id", "utm_source", "utm_medium", "utm_campaign")


def dq_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R9 with every rule at work: searches without a time, unreadable lines among the sign-ups."""
    configure(spark)
    kind = F.trim(F.lower("event_type"))
    rows = bronze_like(spark, sf_dir).withColumn(
        "occurred_at", F.when(kind != "search", F.col("occurred_at"))).withColumn(
        "_corrupt_record", F.when(kind == "page_view", F.lit("{broken")))
    return quality.dq_checks(rows)


def utm_from_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return pages.select("page_id", "url",
                        *[url_query_param(F.col("url"), k).alias(k)
                          for k in ("utm_source", "utm_medium", "utm_campaign")])


def _bronze(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return fn(bronze_like(spark, sf_dir))
    return run


def queries() -> dict[str, Query]:
    search = lambda s, d: gold.search_metrics(silver(s, d), audit=False)
    product = lambda s, d: gold.product_metrics(silver(s, d), audit=False)
    session = lambda s, d: gold.session_metrics(silver(s, d), audit=False)
    return {
        "silver_normalize": silver,
        "silver_dedup": silver_dedup,
        "silver_upsert": upserted_silver,
        "silver_incremental": silver_incremental,
        "gold_search": search,
        "gold_product": product,
        "gold_session": session,
        "gold_page": _gold(gold.page_metrics),
        "gold_funnel": _gold(gold.funnel_metrics),
        "gold_for_dates": gold_for_dates,
        "gold_merge": gold_merge,
        "bi_top_searches": lambda s, d: bi.top_searches(search(s, d), BI_SITE, BI_DAY),
        "bi_top_products": lambda s, d: bi.top_products(product(s, d), BI_SITE, BI_DAY),
        "bi_session_quality": lambda s, d: bi.session_quality(session(s, d), QUALITY_SINCE),
        "bi_silver_sample": lambda s, d: bi.silver_sample(silver(s, d), BI_SITE, BI_DAY),
        "bi_top_searches_5": lambda s, d: bi.top_searches(search(s, d), BI_SITE, BI_DAY, 5),
        "bi_top_products_10": lambda s, d: bi.top_products(product(s, d), BI_SITE, BI_DAY, 10),
        "bi_silver_sample_20": lambda s, d: bi.silver_sample(silver(s, d), BI_SITE, BI_DAY, 20),
        "silver_marks": silver_marks,
        "silver_sdk_names": silver_sdk_names,
        "silver_utm_fallback": silver_utm_fallback,
        "gold_product_spellings": gold_product_spellings,
        "dq_faults": dq_faults,
        "searches_per_day": lambda s, d: features.searches_per_day(search(s, d)),
        "top_queries": lambda s, d: features.top_queries(search(s, d), 10),
        "query_ctr": lambda s, d: features.query_ctr(silver(s, d), 30),
        "viewed_together": lambda s, d: features.viewed_together(silver(s, d), 2),
        "viewed_together_1": lambda s, d: features.viewed_together(silver(s, d), 1),
        "co_viewed": lambda s, d: features.co_viewed(silver(s, d), 2),
        "searched_then_purchased": lambda s, d: features.searched_then_purchased(silver(s, d)),
        "autocomplete": lambda s, d: features.autocomplete(silver(s, d), 5),
        "dq_checks": _bronze(quality.dq_checks),
        "quarantine": _bronze(quality.quarantine),
        "ingest_lag": _bronze(quality.ingest_lag),
        "utm_from_url": utm_from_url,
        "bronze_ingest": table_flows.bronze_ingest,
        "bronze_evolve": table_flows.bronze_evolve,
        "bronze_any_line": table_flows.bronze_any_line,
        "quarantine_table": table_flows.quarantine_table,
        "silver_merge_table": table_flows.silver_merge_table,
        "silver_stream": table_flows.silver_stream,
        "silver_replay": table_flows.silver_replay,
        "ingest_lag_stream": table_flows.ingest_lag_stream,
        "cli_run": table_flows.cli_run,
        "gold_refresh": table_flows.gold_refresh,
    }
