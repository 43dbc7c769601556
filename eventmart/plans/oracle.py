"""Reference SQL (DuckDB dialect) for every registered query.

Written straight from the fixture rules in ``sources.fixtures`` (not from the
Spark code): the canonical rows are stated directly instead of being parsed
back from raw text.  The driver runs these against the same parquet tables.
"""

from __future__ import annotations

_BASE = """_base AS (
  SELECT event_id AS _id, CAST(ts AS TIMESTAMP) AS _t0, user_id AS _uid, event_type AS _et,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS _k
  FROM events)"""

_PLAIN = """_src AS (SELECT *, 0 AS _copy, _t0 AS _t FROM _base)"""

_WITH_COPIES = """_src AS (
  SELECT *, 0 AS _copy, _t0 AS _t FROM _base
  UNION ALL SELECT *, 1 AS _copy, _t0 + INTERVAL 1 HOUR AS _t FROM _base WHERE _et = 'purchase'
  UNION ALL SELECT *, 2 AS _copy, _t0 - INTERVAL 1 HOUR AS _t FROM _base WHERE _et = 'signup'
  UNION ALL SELECT *, 3 AS _copy, _t0 AS _t FROM _base WHERE _et = 'view')"""

_SILVER_COLS = """CAST(_id AS VARCHAR) AS event_id,
    _t AS occurred_at_utc,
    'site_' || CAST(_uid % 4 AS VARCHAR) AS site_id,
    CASE _et WHEN 'view' THEN 'product_view' WHEN 'click' THEN 'add_to_cart'
             WHEN 'error' THEN 'search' WHEN 'signup' THEN 'page_view' ELSE _et END AS event_type,
    CASE WHEN _uid % 37 <> 0
         THEN CAST(_uid AS VARCHAR) || '-' || CAST(CAST(floor(epoch(_t) / 129600) AS BIGINT) AS VARCHAR) END
      AS session_id,
    CAST(_uid AS VARCHAR) AS user_id,
    CAST(_t AS DATE) AS event_date,
    CAST(hour(_t) AS INTEGER) AS event_hour,
    CASE WHEN _et = 'error' THEN CASE WHEN _k % 15 = 0 THEN '  ' ELSE 'q' || CAST(_k % 15 AS VARCHAR) END END
      AS search_query,
    CASE WHEN _et IN ('view', 'click', 'purchase') THEN 'p' || CAST(_k AS VARCHAR) END AS product_id,
    'c' || CAST(_k % 10 AS VARCHAR) AS category_id,
    _k < 20 AS zero_results,
    CASE WHEN _k % 50 = 0 THEN '' ELSE 'https://shop.example/' || CAST(_k % 50 AS VARCHAR) END AS page_url,
    CASE WHEN _uid % 5 <> 0 THEN 'https://ref.example/' || CAST(_uid % 5 AS VARCHAR) END AS referrer,
    CASE WHEN _k % 9 = 0 THEN 'newsletter' END AS utm_source,
    CASE WHEN _k % 9 = 0 THEN 'email' END AS utm_medium,
    CASE WHEN _k % 18 = 0 THEN 'spring' END AS utm_campaign"""

_TYPE_SQL = ("CASE _et WHEN 'view' THEN 'product_view' WHEN 'click' THEN 'add_to_cart' "
             "WHEN 'error' THEN 'search' WHEN 'signup' THEN 'page_view' ELSE _et END")

SILVER_OUT = ("event_id, occurred_at_utc, site_id, event_type, session_id, user_id, event_date, event_hour, "
              "search_query, product_id, category_id, zero_results, page_url, referrer, "
              "utm_source, utm_medium, utm_campaign")

_EXTRA = """_t0 + to_seconds(60 + _id % 600 + CASE WHEN _copy > 0 THEN 86400 ELSE 0 END) AS _ingested_at,
    date_trunc('second', _t) + to_seconds(_id % 30) AS _received_at,
    _copy"""


def _silver_cte(name: str = "silver", rejected: str = "97, 98, 99") -> str:
    return f"""{name} AS (
  SELECT {_SILVER_COLS},
    {_EXTRA}
  FROM _src WHERE _k NOT IN ({rejected}))"""


def with_silver(body: str, *, copies: bool = False, extra: str = "", from_folders: bool = False) -> str:
    """``from_folders``: an event without a site (_k 98) takes the one that its folder names."""
    ctes = [_BASE, _WITH_COPIES if copies else _PLAIN, _silver_cte(rejected="97, 99" if from_folders else "97, 98, 99")]
    if extra:
        ctes.append(extra)
    return "WITH " + ",\n".join(ctes) + "\n" + body


_RAW_CTE = """raw AS (
  SELECT _src.*,
    CASE WHEN _k <> 97 THEN CAST(_id AS VARCHAR) END AS event_id,
    CASE WHEN _k <> 98 THEN 'site_' || CAST(_uid % 4 AS VARCHAR) END AS site_id,
    CASE WHEN _k <> 99 THEN _t END AS event_time,
    _t0 + to_seconds(60 + _id % 600) AS _ingested_at,
    'site_' || CAST(_uid % 4 AS VARCHAR) AS source
  FROM _src)"""


def with_raw(body: str) -> str:
    return "WITH " + ",\n".join([_BASE, _PLAIN, _RAW_CTE]) + "\n" + body


SEARCH_METRICS = """search_m AS (
  SELECT site_id, event_date, search_query, count(*) AS search_count,
         count(*) FILTER (WHERE zero_results) AS zero_result_searches,
         count(DISTINCT session_id) AS distinct_sessions
  FROM silver WHERE search_query IS NOT NULL AND length(trim(search_query)) > 0
  GROUP BY 1, 2, 3)"""


def product_metrics_sql(src: str) -> str:
    return f"""SELECT site_id, event_date, product_id,
         count(*) FILTER (WHERE event_type = 'product_view') AS product_views,
         count(*) FILTER (WHERE event_type IN ('add_to_cart', 'addtocart', 'cart_add')) AS add_to_cart_events,
         count(*) FILTER (WHERE event_type IN ('purchase', 'order_complete', 'checkout_complete')) AS purchase_events,
         CASE WHEN count(*) FILTER (WHERE event_type = 'product_view') > 0
              THEN CAST(count(*) FILTER (WHERE event_type IN ('add_to_cart', 'addtocart', 'cart_add')) AS DOUBLE)
                   / count(*) FILTER (WHERE event_type = 'product_view') END AS add_to_cart_rate,
         CASE WHEN count(*) FILTER (WHERE event_type = 'product_view') > 0
              THEN CAST(count(*) FILTER (WHERE event_type IN ('purchase', 'order_complete', 'checkout_complete')) AS DOUBLE)
                   / count(*) FILTER (WHERE event_type = 'product_view') END AS purchase_conversion_rate
  FROM {src} WHERE product_id IS NOT NULL GROUP BY 1, 2, 3"""


def session_metrics_sql(src: str) -> str:
    return f"""SELECT site_id, event_date, count(*) AS sessions,
         avg(CAST(floor(epoch(s_end)) AS BIGINT) - CAST(floor(epoch(s_start)) AS BIGINT)) AS avg_duration_seconds,
         count(*) FILTER (WHERE n = 1 OR pages = 1) AS bounce_sessions,
         CAST(count(*) FILTER (WHERE n = 1 OR pages = 1) AS DOUBLE) / count(*) AS bounce_rate
  FROM (SELECT site_id, event_date, session_id, min(occurred_at_utc) AS s_start, max(occurred_at_utc) AS s_end,
               count(*) AS n, count(DISTINCT page_url) AS pages
        FROM {src} WHERE session_id IS NOT NULL GROUP BY 1, 2, 3) s
  GROUP BY 1, 2"""


PAGE_METRICS = """SELECT site_id, event_date, page_url, count(*) AS page_views,
       count(DISTINCT session_id) AS distinct_sessions, count(DISTINCT user_id) AS distinct_users
FROM silver WHERE page_url IS NOT NULL AND length(trim(page_url)) > 0 GROUP BY 1, 2, 3"""

FUNNEL_METRICS = """SELECT site_id, event_date, event_type AS funnel_step, count(*) AS event_count,
       count(DISTINCT session_id) AS distinct_sessions
FROM silver GROUP BY 1, 2, 3"""

UPSERTED = """upserted AS (
  SELECT * FROM silver
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY occurred_at_utc DESC, _copy) = 1)"""


RECENT_UPSERTED = "(SELECT * FROM upserted WHERE event_date >= DATE '2024-01-20')"


def _pairs_sql(group_col: str, min_support: int) -> str:
    return f"""m AS (SELECT DISTINCT site_id, {group_col} AS g, product_id FROM silver
       WHERE {group_col} IS NOT NULL AND product_id IS NOT NULL AND event_type = 'product_view'),
sup AS (SELECT site_id, product_id, count(*) AS n FROM m GROUP BY 1, 2),
pairs AS (
  SELECT a.site_id, a.product_id AS product_a, b.product_id AS product_b, count(*) AS together
  FROM m a JOIN m b ON a.site_id = b.site_id AND a.g = b.g AND a.product_id < b.product_id
  GROUP BY 1, 2, 3 HAVING count(*) >= {min_support})"""


def _ctr_sql(window_minutes: int) -> str:
    return f"""s AS (SELECT site_id, session_id, event_date, search_query, occurred_at_utc AS ts FROM silver
       WHERE session_id IS NOT NULL AND event_type IS DISTINCT FROM 'product_view' AND search_query IS NOT NULL AND length(trim(search_query)) > 0),
nx AS (SELECT s.*, (SELECT min(s2.ts) FROM s s2 WHERE s2.site_id = s.site_id AND s2.session_id = s.session_id
                     AND s2.ts > s.ts) AS next_ts FROM s),
v AS (SELECT site_id, session_id, occurred_at_utc AS ts FROM silver
      WHERE session_id IS NOT NULL AND event_type = 'product_view'),
f AS (SELECT nx.*, EXISTS (SELECT 1 FROM v WHERE v.site_id = nx.site_id AND v.session_id = nx.session_id
                            AND v.ts >= nx.ts AND v.ts <= nx.ts + INTERVAL {window_minutes} MINUTE
                            AND (nx.next_ts IS NULL OR v.ts < nx.next_ts)) AS clicked FROM nx)"""


# Third key and measures of each gold table.
_GOLD = {
    "search_metrics": ("search_query", ("search_count", "zero_result_searches", "distinct_sessions")),
    "product_metrics": ("product_id", ("product_views", "add_to_cart_events", "purchase_events", "add_to_cart_rate",
                                       "purchase_conversion_rate")),
    "session_metrics": (None, ("sessions", "avg_duration_seconds", "bounce_sessions", "bounce_rate")),
    "page_metrics": ("page_url", ("page_views", "distinct_sessions", "distinct_users")),
    "funnel_metrics": ("funnel_step", ("event_count", "distinct_sessions")),
}


def _refresh_sql() -> str:
    """Metrics of the base events, replaced by key where two days were recomputed after the corrections."""
    bodies = {"search_metrics": SEARCH_METRICS.split("(", 1)[1].rsplit(")", 1)[0], "page_metrics": PAGE_METRICS,
              "funnel_metrics": FUNNEL_METRICS, "product_metrics": product_metrics_sql("silver"),
              "session_metrics": session_metrics_sql("silver")}
    old = "(SELECT * FROM silver WHERE _copy = 0) s"
    new = "(SELECT * FROM upserted WHERE event_date IN (DATE '2024-01-03', DATE '2024-01-17')) s"
    ctes, parts = [UPSERTED], []
    for name, (key, measures) in _GOLD.items():
        ctes += [f"{name}_old AS ({bodies[name].replace('FROM silver', f'FROM {old}')})",
                 f"{name}_new AS ({bodies[name].replace('FROM silver', f'FROM {new}')})"]
        same = f"AND n.{key} IS NOT DISTINCT FROM o.{key}" if key else ""
        ctes.append(f"""{name}_all AS (SELECT * FROM {name}_new UNION ALL SELECT * FROM {name}_old o WHERE NOT EXISTS (
          SELECT 1 FROM {name}_new n WHERE n.site_id = o.site_id AND n.event_date = o.event_date {same}))""")
        parts += [f"SELECT '{name}' AS metric_table, site_id, event_date, {key or 'CAST(NULL AS VARCHAR)'} AS metric_key, "
                  f"'{m}' AS measure, CAST({m} AS DOUBLE) AS value FROM {name}_all" for m in measures]
    return with_silver("\nUNION ALL ".join(parts), copies=True, extra=",\n".join(ctes))


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["silver_normalize"] = with_silver(f"SELECT {SILVER_OUT} FROM silver")
    q["silver_dedup"] = with_silver(
        f"SELECT {SILVER_OUT} FROM silver QUALIFY row_number() OVER "
        "(PARTITION BY event_id ORDER BY occurred_at_utc DESC, _ingested_at ASC) = 1", copies=True)
    q["silver_upsert"] = with_silver(f"SELECT {SILVER_OUT} FROM upserted", copies=True, extra=UPSERTED)
    q["silver_incremental"] = with_silver(
        f"SELECT {SILVER_OUT} FROM silver WHERE _ingested_at > TIMESTAMP '2024-01-15 00:00:00' "
        "AND _received_at > TIMESTAMP '2024-01-10 00:00:00'")
    q["gold_search"] = with_silver("SELECT * FROM search_m", extra=SEARCH_METRICS)
    q["gold_product"] = with_silver(product_metrics_sql("silver"))
    q["gold_session"] = with_silver(session_metrics_sql("silver"))
    q["gold_page"] = with_silver(PAGE_METRICS)
    q["gold_funnel"] = with_silver(FUNNEL_METRICS)
    q["gold_for_dates"] = with_silver(session_metrics_sql(
        "(SELECT * FROM silver WHERE event_date IN (DATE '2024-01-03', DATE '2024-01-17'))"))
    q["gold_merge"] = with_silver(
        """SELECT * FROM tgt t WHERE NOT EXISTS (
             SELECT 1 FROM inc i WHERE i.site_id = t.site_id AND i.event_date = t.event_date
               AND i.product_id IS NOT DISTINCT FROM t.product_id)
           UNION ALL SELECT * FROM inc""",
        copies=True,
        extra=UPSERTED + ",\n"
        + f"tgt AS ({product_metrics_sql('(SELECT * FROM silver WHERE _copy = 0)')}),\n"
        + f"inc AS ({product_metrics_sql(RECENT_UPSERTED)})")
    q["bi_top_searches"] = with_silver(
        "SELECT search_query, search_count, zero_result_searches FROM search_m "
        "WHERE site_id = 'site_1' AND event_date = DATE '2024-01-16' "
        "ORDER BY search_count DESC, search_query LIMIT 50", extra=SEARCH_METRICS)
    q["bi_top_products"] = with_silver(
        "SELECT product_id, product_views, add_to_cart_events, purchase_events, purchase_conversion_rate "
        f"FROM ({product_metrics_sql('silver')}) p WHERE site_id = 'site_1' AND event_date = DATE '2024-01-16' "
        "ORDER BY product_views DESC, product_id LIMIT 100")
    q["bi_session_quality"] = with_silver(
        "SELECT site_id, event_date, sessions, avg_duration_seconds, bounce_rate "
        f"FROM ({session_metrics_sql('silver')}) s WHERE event_date >= DATE '2024-01-20' "
        "ORDER BY event_date DESC, site_id")
    q["bi_silver_sample"] = with_silver(
        "SELECT event_id, occurred_at_utc, event_type, search_query, product_id FROM silver "
        "WHERE site_id = 'site_1' AND event_date = DATE '2024-01-16' ORDER BY event_id LIMIT 100")
    q["searches_per_day"] = with_silver(
        "SELECT site_id, event_date, CAST(sum(search_count) AS BIGINT) AS searches, "
        "CAST(sum(zero_result_searches) AS BIGINT) AS zero_result_searches, count(*) AS distinct_queries "
        "FROM search_m GROUP BY 1, 2", extra=SEARCH_METRICS)
    q["top_queries"] = with_silver(
        "SELECT site_id, event_date, search_query, search_count, query_rank FROM ("
        "SELECT *, CAST(row_number() OVER (PARTITION BY site_id, event_date "
        "ORDER BY search_count DESC, search_query) AS INTEGER) AS query_rank FROM search_m) WHERE query_rank <= 10",
        extra=SEARCH_METRICS)
    q["query_ctr"] = with_silver(
        "SELECT site_id, event_date, search_query, count(*) AS searches, "
        "count(*) FILTER (WHERE clicked) AS clicked_searches, "
        "CAST(count(*) FILTER (WHERE clicked) AS DOUBLE) / count(*) AS ctr FROM f GROUP BY 1, 2, 3",
        extra=_ctr_sql(30))
    for name, support in (("viewed_together", 2), ("viewed_together_1", 1)):
        q[name] = with_silver("SELECT site_id, product_a, product_b, together AS sessions FROM pairs",
                              extra=_pairs_sql("session_id", support))
    q["co_viewed"] = with_silver(
        """SELECT p.site_id, p.product_a, p.product_b, p.together AS users_ab, sa.n AS users_a, sb.n AS users_b,
                  CAST(p.together AS DOUBLE) / (sa.n + sb.n - p.together) AS jaccard,
                  CAST(p.together * u.viewers AS DOUBLE) / CAST(sa.n * sb.n AS DOUBLE) AS lift
           FROM pairs p
           JOIN sup sa ON sa.site_id = p.site_id AND sa.product_id = p.product_a
           JOIN sup sb ON sb.site_id = p.site_id AND sb.product_id = p.product_b
           JOIN (SELECT site_id, count(DISTINCT g) AS viewers FROM m GROUP BY 1) u ON u.site_id = p.site_id""",
        extra=_pairs_sql("user_id", 2))
    q["searched_then_purchased"] = with_silver(
        """SELECT s.site_id, s.search_query, p.product_id, count(*) AS sessions
           FROM (SELECT site_id, session_id, search_query, min(occurred_at_utc) AS t FROM silver
                 WHERE session_id IS NOT NULL AND search_query IS NOT NULL AND length(trim(search_query)) > 0
                 GROUP BY 1, 2, 3) s
           JOIN (SELECT site_id, session_id, product_id, max(occurred_at_utc) AS t FROM silver
                 WHERE session_id IS NOT NULL AND event_type IN ('purchase', 'order_complete', 'checkout_complete') AND product_id IS NOT NULL
                 GROUP BY 1, 2, 3) p
             ON s.site_id = p.site_id AND s.session_id = p.session_id AND s.t < p.t
           GROUP BY 1, 2, 3""")
    q["autocomplete"] = with_silver(
        """SELECT site_id, prefix, query, frequency, suggestion_rank FROM (
             SELECT site_id, prefix, query, frequency,
                    CAST(row_number() OVER (PARTITION BY site_id, prefix ORDER BY frequency DESC, query)
                         AS INTEGER) AS suggestion_rank
             FROM (SELECT site_id, query, frequency, substring(query, 1, CAST(n AS INTEGER)) AS prefix
                   FROM (SELECT site_id, lower(trim(regexp_replace(search_query, '\\s+', ' ', 'g'))) AS query,
                                count(*) AS frequency
                         FROM silver WHERE search_query IS NOT NULL AND length(trim(search_query)) > 0
                         GROUP BY 1, 2) f,
                        range(2, least(length(query), 10) + 1) r(n)
                   WHERE length(query) >= 2) x) y
           WHERE suggestion_rank <= 5""")
    q["dq_checks"] = with_raw(
        """SELECT CAST(_ingested_at AS DATE) AS ingest_date, count(*) AS rows,
                  count(*) FILTER (WHERE event_id IS NULL) AS missing_event_id,
                  CAST(0 AS BIGINT) AS missing_occurred_at,
                  count(*) FILTER (WHERE event_time IS NULL) AS unparseable_occurred_at,
                  count(*) FILTER (WHERE site_id IS NULL) AS missing_site_id,
                  count(*) FILTER (WHERE event_id IS NULL OR event_time IS NULL OR site_id IS NULL) AS invalid_rows
           FROM raw GROUP BY 1""")
    q["quarantine"] = with_raw(
        """SELECT event_id, site_id, event_time, CAST(_ingested_at AS DATE) AS ingest_date,
                  concat_ws(',', CASE WHEN event_id IS NULL THEN 'missing_event_id' END,
                                 CASE WHEN event_time IS NULL THEN 'unparseable_occurred_at' END,
                                 CASE WHEN site_id IS NULL THEN 'missing_site_id' END) AS reasons
           FROM raw WHERE event_id IS NULL OR event_time IS NULL OR site_id IS NULL""")
    q["ingest_lag"] = with_raw(
        """SELECT CAST(_ingested_at AS DATE) AS ingest_date, source, count(*) AS rows,
                  count(*) FILTER (WHERE event_id IS NULL OR event_time IS NULL OR site_id IS NULL) AS bad_rows,
                  avg(CAST(floor(epoch(_ingested_at)) AS BIGINT) - CAST(floor(epoch(event_time)) AS BIGINT))
                    AS avg_lag_seconds,
                  max(CAST(floor(epoch(_ingested_at)) AS BIGINT) - CAST(floor(epoch(event_time)) AS BIGINT))
                    AS max_lag_seconds
           FROM raw GROUP BY 1, 2""")
    q["ingest_lag_stream"] = q["ingest_lag"]
    known = "CASE WHEN event_date NOT IN (DATE '2024-01-05', DATE '2024-01-20') THEN {0} END AS {0}"
    q["silver_replay"] = with_silver(
        "SELECT event_id, site_id, event_date, " + ", ".join(
            known.format(c) for c in ("session_id", "search_query", "product_id", "utm_source")) + " FROM silver",
        from_folders=True)
    q["cli_run"] = with_silver(FUNNEL_METRICS, from_folders=True)
    q["silver_merge_table"] = q["silver_stream"] = q["silver_upsert"]
    q["gold_refresh"] = _refresh_sql()
    for name, n in (("bi_top_searches", 5), ("bi_top_products", 10), ("bi_silver_sample", 20)):
        q[f"{name}_{n}"] = f"SELECT * FROM ({q[name]}) LIMIT {n}"
    q["silver_marks"] = q["silver_incremental"]
    q["silver_sdk_names"] = with_silver(
        f"SELECT {SILVER_OUT}, 'user_agent-' || site_id AS user_agent, 'device_type-' || site_id AS device_type, "
        "'browser_language-' || site_id AS browser_language, 'sdk_version-' || site_id AS sdk_version FROM silver")
    q["gold_product_spellings"] = q["gold_product"]
    q["silver_utm_fallback"] = with_silver(
        "SELECT event_id, coalesce(utm_source, CASE WHEN page_url <> '' THEN 'a|b' END) AS utm_source, "
        "coalesce(utm_medium, CASE WHEN page_url <> '' THEN 'm ' || site_id END) AS utm_medium, utm_campaign FROM silver")
    q["dq_faults"] = with_raw(
        """SELECT ingest_date, count(*) AS rows, count(*) FILTER (WHERE no_id) AS missing_event_id,
                  count(*) FILTER (WHERE no_time) AS missing_occurred_at,
                  count(*) FILTER (WHERE bad_time) AS unparseable_occurred_at,
                  count(*) FILTER (WHERE no_site) AS missing_site_id,
                  count(*) FILTER (WHERE misread AND (no_id OR no_time OR bad_time OR no_site)) AS corrupt_record,
                  count(*) FILTER (WHERE misread AND NOT (no_id OR no_time OR bad_time OR no_site)) AS type_conflicts,
                  count(*) FILTER (WHERE no_id OR no_time OR bad_time OR no_site) AS invalid_rows
           FROM (SELECT CAST(_ingested_at AS DATE) AS ingest_date, event_id IS NULL AS no_id, _et = 'error' AS no_time,
                        _et <> 'error' AND event_time IS NULL AS bad_time, site_id IS NULL AS no_site,
                        _et = 'signup' AS misread FROM raw) GROUP BY 1""")
    q["bronze_evolve"] = with_raw(
        """SELECT CAST(_id AS VARCHAR) AS event_id,
                  CASE _et WHEN 'view' THEN 'first' WHEN 'click' THEN 'second' ELSE 'third' END AS "drop",
                  CASE WHEN _et IN ('view', 'click') THEN CAST(_k AS BIGINT) END AS size,
                  CASE WHEN _et = 'click' THEN 'c' || CAST(_k % 2 AS VARCHAR) END AS channel,
                  CASE WHEN _et IN ('view', 'click') THEN 'o' || CAST(_k % 3 AS VARCHAR) END AS os,
                  CASE WHEN _et = 'click' THEN CAST(_k % 5 AS VARCHAR) END AS rescued_ver,
                  CASE WHEN _et NOT IN ('view', 'click') THEN 'wide' END AS misfit_size
           FROM raw""")
    q["bronze_any_line"] = with_raw(
        """SELECT CASE _et WHEN 'view' THEN '' ELSE 'e' END || CAST(_id AS VARCHAR) AS event_id,
                  CASE _et WHEN 'view' THEN 'first' WHEN 'click' THEN 'second' ELSE 'third' END AS "drop",
                  CAST(_t AS DATE) AS event_date,
                  CASE WHEN _et = 'view' THEN CAST(_k + 1 AS BIGINT) END AS k,
                  CAST(CASE WHEN _et = 'view' THEN 2 WHEN _et = 'click' OR _id % 3 <> 0 THEN 0 END AS BIGINT) AS k_kept,
                  CASE WHEN _et = 'view' THEN CAST(_k AS BIGINT) END AS size,
                  CASE WHEN _et = 'click' THEN 'wide' END AS misfit_size,
                  CASE WHEN _et = 'click' THEN 'c' || CAST(_k % 2 AS VARCHAR) END AS channel,
                  CASE WHEN _et = 'click' THEN 'C' || CAST(_k % 3 AS VARCHAR) END AS twin,
                  CASE WHEN _et NOT IN ('view', 'click') AND _id % 3 <> 0 THEN 'late' END AS late_twin,
                  CASE WHEN _et = 'click' THEN 'own' END AS own_rescued,
                  CASE WHEN _et = 'view' THEN CAST(_k AS BIGINT) WHEN _et = 'click' THEN CAST(1 AS BIGINT) END AS quoted_x,
                  CASE WHEN _et = 'click' THEN CAST(_k AS VARCHAR) END AS quoted_y,
                  _et NOT IN ('view', 'click') AND _id % 3 = 0 AS kept_whole
           FROM raw""")
    q["quarantine_table"] = with_raw(
        """SELECT event_id, CASE _k WHEN 97 THEN 'missing_event_id' WHEN 98 THEN 'missing_site_id'
                                 ELSE 'unparseable_occurred_at' END AS reasons,
                  CAST(_ingested_at AS DATE) AS ingest_date, CAST(copy AS INTEGER) AS copy, late
           FROM raw, (VALUES (1, false), (2, false), (1, true)) c(copy, late)
           WHERE (_k IN (97, 98, 99) AND copy = 1 AND NOT late) OR (_k = 98 AND copy = 2)
              OR (_k = 99 AND late AND _ingested_at > TIMESTAMP '2024-01-10 00:00:00')""")
    typed = (f"CASE WHEN _id % 5 = 0 THEN upper({_TYPE_SQL}) ELSE {_TYPE_SQL} END")
    q["bronze_ingest"] = with_raw(
        f"""SELECT event_id, source AS site_id,
                  CASE WHEN _k <> 98 AND _id % 2 = 0 THEN source END AS event_site_id,
                  CASE WHEN _id % 7 = 0 THEN '  ' || {typed} || ' ' ELSE {typed} END AS event_type,
                  event_time AS occurred_at_ts, CAST(event_time AS DATE) AS event_date,
                  'site_id=' || source || '/date=' || CAST(CAST(_t0 AS DATE) AS VARCHAR) AS source_folder
           FROM raw""")
    q["utm_from_url"] = r"""SELECT page_id, url,
        nullif(regexp_extract(regexp_replace(url, '#.*$', ''), '[?&]utm_source=([^&]*)', 1), '') AS utm_source,
        nullif(regexp_extract(regexp_replace(url, '#.*$', ''), '[?&]utm_medium=([^&]*)', 1), '') AS utm_medium,
        nullif(regexp_extract(regexp_replace(url, '#.*$', ''), '[?&]utm_campaign=([^&]*)', 1), '') AS utm_campaign
      FROM pages"""
    return q
