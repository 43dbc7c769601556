"""Raw-shaped behavioural events derived from the driver's ``events`` table.

The driver tables carry a generic event stream (event_id, ts, user_id,
event_type, value, props).  These rules turn every row into a raw event as
producers would send it - mixed SDK/snake_case names, padded and upper-case
types, several time formats, URLs with blanks, flags as text, a JSON
``properties`` payload and a few broken rows - so the full normaliser runs on
data that grows with the table.  ``oracle.py`` states the canonical result of
the same rules in SQL.

Rules (``k`` = props.k, ``m`` = mapped type):
  type map      view->product_view, click->add_to_cart, error->search,
                signup->page_view, purchase->purchase
  site          'site_' || user_id % 4, in event_site_id (even id) or site_id (odd id)
  user          user_id (id % 3 != 0) or anonymous_id (id % 3 == 0)
  session       NULL when user_id % 37 == 0, else user_id || '-' || floor(epoch(ts) / 129600)
  type text     upper(m) when id % 5 == 0, padded with spaces when id % 7 == 0
  time text     ISO with 'T' and 'Z' (even id) or space and '+00:00' (odd id)
  url           'https://shop.example/' || k % 50, with blanks/tab inside when id % 4 == 0;
                k % 50 == 0 -> NULL (even id) or '' (odd id)
  query         search events: '  ' when k % 15 == 0, else 'q' || k % 15;
                key 'search_query' when id % 8 == 0, else 'query'
  product       'p' || k for view/click/purchase;  category 'c' || k % 10
  zero flag     k < 20, written as true/TRUE/1/yes or false/no/0/FALSE by id % 4,
                key 'zero_result' when id % 6 == 0, else 'zero_results'
  utm           source 'newsletter' and medium 'email' when k % 9 == 0, campaign 'spring' when k % 18 == 0
  referrer      NULL when user_id % 5 == 0, else 'https://ref.example/' || user_id % 5
  broken rows   k == 97: no event_id; k == 98: no site; k == 99: occurred_at 'not-a-time'
  ingest time   ts + (60 + id % 600) s (+ 1 day for copies); received_at ts + id % 30 s
Copies (``with_copies``): purchases again 1 h later (a correction), sign-ups again
1 h earlier (stale), views again at the same time (re-delivery).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Driver event type -> behavioural event type.
TYPE_MAP = {"view": "product_view", "click": "add_to_cart", "error": "search",
            "signup": "page_view", "purchase": "purchase"}
PRODUCT_SOURCE_TYPES = ("view", "click", "purchase")
TRUE_TEXTS = ("true", "TRUE", "1", "yes")
FALSE_TEXTS = ("false", "no", "0", "FALSE")
SESSION_SECONDS = 129600
COPY_NONE, COPY_NEWER, COPY_OLDER, COPY_SAME = 0, 1, 2, 3


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _sql_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


_TYPE_CASE = "CASE _et " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in TYPE_MAP.items()) + " ELSE _et END"


def _json_object_sql(fields: dict[str, str]) -> str:
    """SQL for JSON object text of string fields, NULL fields left out.

    Built with string functions (values here never need escaping) rather than
    ``to_json``: the optimizer fuses ``to_json`` with the normaliser's
    ``from_json`` into an expression that disables whole-stage codegen.
    """
    members = ", ".join(f"""CASE WHEN ({v}) IS NOT NULL THEN concat('"{k}":"', {v}, '"') END"""
                        for k, v in fields.items())
    return f"concat('{{', concat_ws(',', {members}), '}}')"


def spread(df: DataFrame) -> DataFrame:
    """Deal the source rows to all cores, at every size alike.

    The driver's files are single row groups (one task). ``observe`` records
    the rows read and keeps later filters on derived columns above the
    exchange, so the per-row derivation runs on all cores. Rows are dealt by
    their hash: dealing in turn would first sort them all within the one task.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *df.columns).observe(f"rows_read_{uuid.uuid4().hex[:10]}", F.count(F.lit(1)).alias("rows"))


def base_events(spark: SparkSession, sf_dir: str, *, with_copies: bool = False,
                copies_only: bool = False) -> DataFrame:
    """Columns _id, _t, _t0, _uid, _et, _k, _copy (one scan of ``events``)."""
    ev = spread(read_table(spark, sf_dir, "events"))
    base = ev.selectExpr("event_id AS _id", "CAST(ts AS TIMESTAMP) AS _t0", "user_id AS _uid",
                         "event_type AS _et", "CAST(get_json_object(props, '$.k') AS INT) AS _k")
    if not (with_copies or copies_only):
        return base.selectExpr("*", "_t0 AS _t", f"{COPY_NONE} AS _copy")
    kind = (f"CASE _et WHEN 'purchase' THEN {COPY_NEWER} WHEN 'signup' THEN {COPY_OLDER} "
            f"WHEN 'view' THEN {COPY_SAME} END")
    kinds = f"array({kind})" if copies_only else f"array({COPY_NONE}, {kind})"
    return base.selectExpr("*", f"explode({kinds}) AS _copy").where("_copy IS NOT NULL").selectExpr(
        "*", f"""CASE _copy WHEN {COPY_NEWER} THEN _t0 + INTERVAL 1 HOUR
                 WHEN {COPY_OLDER} THEN _t0 - INTERVAL 1 HOUR ELSE _t0 END AS _t""")


def raw_events(spark: SparkSession, sf_dir: str, *, with_copies: bool = False,
               copies_only: bool = False, camel_case: bool = False) -> DataFrame:
    """Raw events (bronze payload + ingestion columns) following the module rules.

    ``camel_case`` writes event id, type and time under SDK names for even ids
    (used when the rows are written out as JSON files).
    """
    b = base_events(spark, sf_dir, with_copies=with_copies, copies_only=copies_only)
    site = "concat('site_', CAST(_uid % 4 AS STRING))"
    typed = f"CASE WHEN _id % 5 = 0 THEN upper({_TYPE_CASE}) ELSE {_TYPE_CASE} END"
    query = ("CASE WHEN _et = 'error' THEN CASE WHEN _k % 15 = 0 THEN '  ' "
             "ELSE concat('q', CAST(_k % 15 AS STRING)) END END")
    flag = (f"CASE WHEN _k < 20 THEN element_at(array({_sql_list(TRUE_TEXTS)}), CAST(_id % 4 + 1 AS INT)) "
            f"ELSE element_at(array({_sql_list(FALSE_TEXTS)}), CAST(_id % 4 + 1 AS INT)) END")
    props = _json_object_sql({
        "query": f"CASE WHEN _id % 8 <> 0 THEN {query} END",
        "search_query": f"CASE WHEN _id % 8 = 0 THEN {query} END",
        "product_id": f"CASE WHEN _et IN ({_sql_list(PRODUCT_SOURCE_TYPES)}) THEN concat('p', CAST(_k AS STRING)) END",
        "category_id": "concat('c', CAST(_k % 10 AS STRING))",
        "zero_results": f"CASE WHEN _id % 6 <> 0 THEN {flag} END",
        "zero_result": f"CASE WHEN _id % 6 = 0 THEN {flag} END",
        "utm_source": "CASE WHEN _k % 9 = 0 THEN 'newsletter' END",
        "utm_medium": "CASE WHEN _k % 9 = 0 THEN 'email' END",
        "utm_campaign": "CASE WHEN _k % 18 = 0 THEN 'spring' END",
    })
    exprs = {
        "event_id": "CASE WHEN _k <> 97 THEN CAST(_id AS STRING) END",
        "occurred_at": """CASE WHEN _k = 99 THEN 'not-a-time'
            WHEN _id % 2 = 0 THEN date_format(_t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
            ELSE concat(date_format(_t, 'yyyy-MM-dd HH:mm:ss.SSSSSS'), '+00:00') END""",
        "event_site_id": f"CASE WHEN _k <> 98 AND _id % 2 = 0 THEN {site} END",
        "site_id": f"CASE WHEN _k <> 98 AND _id % 2 <> 0 THEN {site} END",
        "event_type": f"CASE WHEN _id % 7 = 0 THEN concat('  ', {typed}, ' ') ELSE {typed} END",
        "session_id": (f"CASE WHEN _uid % 37 <> 0 THEN concat(CAST(_uid AS STRING), '-', "
                       f"CAST(floor(unix_timestamp(_t) / {SESSION_SECONDS}) AS STRING)) END"),
        "user_id": "CASE WHEN _id % 3 <> 0 THEN CAST(_uid AS STRING) END",
        "anonymous_id": "CASE WHEN _id % 3 = 0 THEN CAST(_uid AS STRING) END",
        "url": """CASE WHEN _k % 50 = 0 THEN CASE WHEN _id % 2 = 0 THEN NULL ELSE '' END
            WHEN _id % 4 = 0 THEN concat(' https://shop.example/ ', CAST(_k % 50 AS STRING), '\t')
            ELSE concat('https://shop.example/', CAST(_k % 50 AS STRING)) END""",
        "referrer": "CASE WHEN _uid % 5 <> 0 THEN concat('https://ref.example/', CAST(_uid % 5 AS STRING)) END",
        "properties": props,
        "received_at": """date_format(timestamp_seconds(unix_timestamp(_t) + _id % 30), "yyyy-MM-dd'T'HH:mm:ss'Z'")""",
        "_ingested_at": ("timestamp_micros(unix_micros(_t0) + "
                         "(60 + _id % 600 + CASE WHEN _copy > 0 THEN 86400 ELSE 0 END) * 1000000)"),
        "_copy": "_copy",
        "_path_site": site,
        "_path_date": "to_date(_t0)",
    }
    if camel_case:
        exprs["_even"] = "_id % 2 = 0"
    out = b.selectExpr(*[f"{e} AS {n}" for n, e in exprs.items()])
    return _camel(out) if camel_case else out


def _camel(out: DataFrame) -> DataFrame:
    """Even ids carry SDK names (eventId, eventType, occurredAt, siteId), odd ids snake_case."""
    sdk = {"event_id": "eventId", "event_type": "eventType", "occurred_at": "occurredAt",
           "event_site_id": "siteId"}
    keep = [c for c in out.columns if c not in sdk and c != "_even"]
    return out.selectExpr(*keep, *[f"CASE WHEN _even THEN {src} END AS {dst}" for src, dst in sdk.items()],
                          *[f"CASE WHEN NOT _even THEN {src} END AS {src}" for src in sdk if src != "event_site_id"])


def bronze_like(spark: SparkSession, sf_dir: str, **kwargs) -> DataFrame:
    """Raw events as the raw layer stores them (payload + ingestion metadata)."""
    raw = raw_events(spark, sf_dir, **kwargs)
    return raw.withColumn("_source_file", F.concat(
        F.lit("raw/events/site_id="), F.col("_path_site"), F.lit("/date="),
        F.col("_path_date").cast("string"), F.lit("/events.jsonl"))).drop("_path_site", "_path_date", "_copy")
