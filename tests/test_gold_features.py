"""Gold builders and feature tables against brute force on small fixtures."""

import datetime as dt
import itertools
from collections import defaultdict

from eventmart.operators import features, gold
from eventmart.operators.silver import normalize_silver_events
from eventmart.plans import registry
from tests.conftest import SF_SMALL

SILVER = ("event_id string, occurred_at_utc timestamp, site_id string, event_type string, session_id string, "
          "user_id string, event_date date, search_query string, product_id string, zero_results boolean, "
          "page_url string")


def ev(i, minute, etype, session="s1", query=None, product=None, url="u", user="u1", day=1, zero=False):
    t = dt.datetime(2026, 1, day, 10, 0) + dt.timedelta(minutes=minute)
    return (str(i), t, "site", etype, session, user, t.date(), query, product, zero, url)


def test_session_metrics_duration_and_bounce(spark):
    rows = [ev(1, 0, "page_view", "a", url="x"), ev(2, 5, "page_view", "a", url="x"),   # same page -> bounce
            ev(3, 0, "page_view", "b", url="x"), ev(4, 10, "page_view", "b", url="y"),  # 600 s, no bounce
            ev(5, 0, "page_view", "c"), ev(6, 1, "page_view", None)]                    # single event; no session
    row = gold.session_metrics(spark.createDataFrame(rows, SILVER), audit=False).collect()[0]
    assert row["sessions"] == 3 and row["bounce_sessions"] == 2
    assert abs(row["avg_duration_seconds"] - 300.0) < 1e-9 and abs(row["bounce_rate"] - 2 / 3) < 1e-12


def test_product_rates_null_without_views(spark):
    rows = [ev(1, 0, "purchase", product="p"), ev(2, 1, "add_to_cart", product="q"), ev(3, 2, "product_view", product="q")]
    got = {r["product_id"]: r for r in gold.product_metrics(spark.createDataFrame(rows, SILVER), audit=False).collect()}
    assert got["p"]["purchase_conversion_rate"] is None and got["q"]["add_to_cart_rate"] == 1.0


def test_search_metrics_skip_blank_queries(spark):
    rows = [ev(1, 0, "search", query="  "), ev(2, 1, "search", query="shoes", zero=True), ev(3, 2, "search", query="shoes")]
    got = gold.search_metrics(spark.createDataFrame(rows, SILVER), audit=False).collect()
    assert [(r["search_query"], r["search_count"], r["zero_result_searches"]) for r in got] == [("shoes", 2, 1)]


def _brute_ctr(rows, window=30):
    by_session = defaultdict(list)
    for r in rows:
        if r[4] is not None:
            by_session[(r[2], r[4])].append(r)
    clicked, total = defaultdict(int), defaultdict(int)
    for evs in by_session.values():
        searches = sorted(r for r in evs if r[7] and r[7].strip())
        for s in searches:
            later = [x[1] for x in searches if x[1] > s[1]]
            nxt = min(later) if later else None
            hit = any(v[3] == "product_view" and s[1] <= v[1] <= s[1] + dt.timedelta(minutes=window)
                      and (nxt is None or v[1] < nxt) for v in evs)
            key = (s[2], s[6], s[7])
            total[key] += 1
            clicked[key] += hit
    return {k: (total[k], clicked[k]) for k in total}


def test_query_ctr_matches_brute_force(spark):
    rows = [ev(1, 0, "search", query="a"), ev(2, 10, "product_view"), ev(3, 20, "search", query="b"),
            ev(4, 20, "product_view"), ev(5, 55, "search", query="a"), ev(6, 90, "product_view"),
            ev(7, 100, "search", query="a"), ev(8, 100, "search", query="c"), ev(9, 129, "product_view"),
            ev(10, 0, "search", "s2", query="a"), ev(11, 31, "product_view", "s2"),
            ev(12, 5, "search", None, query="a")]
    got = {(r["site_id"], r["event_date"], r["search_query"]): (r["searches"], r["clicked_searches"])
           for r in features.query_ctr(spark.createDataFrame(rows, SILVER), 30).collect()}
    assert got == _brute_ctr(rows)


def test_viewed_together_matches_brute_force(spark):
    silver = registry.silver(spark, SF_SMALL)
    got = {(r["site_id"], r["product_a"], r["product_b"]): r["sessions"]
           for r in features.viewed_together(silver, 1).collect()}
    members = defaultdict(set)
    for r in silver.where("event_type = 'product_view' AND session_id IS NOT NULL AND product_id IS NOT NULL").collect():
        members[(r["site_id"], r["session_id"])].add(r["product_id"])
    want = defaultdict(int)
    for (site, _), prods in members.items():
        for a, b in itertools.combinations(sorted(prods), 2):
            want[(site, a, b)] += 1
    assert got == dict(want)


def test_autocomplete_prefixes(spark):
    rows = [ev(i, i, "search", query=q) for i, q in enumerate(["Shoes", "shoes ", "shirt", "sh  irt", "x", "shoes"])]
    got = features.autocomplete(spark.createDataFrame(rows, SILVER), n=2).collect()
    by_prefix = defaultdict(list)
    for r in got:
        by_prefix[r["prefix"]].append((r["suggestion_rank"], r["query"], r["frequency"]))
    assert sorted(by_prefix["sh"]) == [(1, "shoes", 3), (2, "sh irt", 1)]
    assert "x" not in by_prefix and max(len(p) for p in by_prefix) <= 10


def test_normalizer_feeds_gold_end_to_end(spark):
    rows = [("e1", "2026-01-01T10:00:00Z", "s", "SEARCH", "sess", '{"query": "q", "zero_results": "1"}')]
    df = spark.createDataFrame(rows, "event_id string, occurred_at string, site_id string, event_type string, "
                                     "session_id string, properties string")
    row = gold.search_metrics(normalize_silver_events(df), audit=False).collect()[0]
    assert (row["search_count"], row["zero_result_searches"], row["distinct_sessions"]) == (1, 1, 1)
