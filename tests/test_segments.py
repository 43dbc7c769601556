"""One session with most events: spread over partitions, with the same rows as a plain scan."""

import datetime as dt
import random

from pyspark.sql import functions as F

from eventmart.operators import features

SCHEMA = ("site_id string, session_id string, user_id string, event_type string, search_query string, product_id string, "
          "occurred_at_utc timestamp, event_date date")
DAY = dt.date(2026, 4, 2)
START = dt.datetime(2026, 4, 2, tzinfo=dt.timezone.utc)


def plain(rows, width=30 * 60):
    out = {}
    for site, session, _, kind, query, _, t, _ in rows:
        if session is None or kind == "product_view" or not (query or "").strip():
            continue
        same = [r for r in rows if r[0] == site and r[1] == session]
        views = [r[6] for r in same if r[3] == "product_view" and r[6] >= t]
        later = [r[6] for r in same if r[3] != "product_view" and (r[4] or "").strip() and r[6] > t]
        hit = bool(views) and (min(views) - t).total_seconds() <= width and (not later or min(views) < min(later))
        n, c = out.get((site, query), (0, 0))
        out[site, query] = n + 1, c + hit
    return out


def rows_of(n, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        session = "hot" if rng.random() < 0.7 else rng.choice(["a", "b", None, "c"])
        at = START + dt.timedelta(seconds=rng.randrange(0, 20_000) // 40 * 40)
        rows.append((rng.choice(["s", "s", "s", None]), session, "u", rng.choice(["product_view", "search", "page_view", None]),
                     rng.choice(["q1", "q2", " ", None]), "p", at, DAY))
    return rows


def test_a_hot_session_is_cut_and_gives_the_same_rows(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        for seed in (1, 2):
            rows = rows_of(500, seed)
            silver = spark.createDataFrame(rows, SCHEMA)
            got = {(r["site_id"], r["search_query"]): (r["searches"], r["clicked_searches"])
                   for r in features.query_ctr(silver).collect()}
            assert got == plain(rows)
        laid = features._segments(silver.where("session_id is not null").select(
            "site_id", "session_id", F.unix_micros("occurred_at_utc").alias("_us")))
        assert laid.where("session_id = 'hot'").select("_part").distinct().count() >= 5
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_suggestions_after_any_number_of_characters(spark):
    rows = [("s", "1", "u", "search", q, None, START, DAY) for q in ["red running shoes", "red running shoes", "red running socks", "x"]]
    got = features.autocomplete(spark.createDataFrame(rows, SCHEMA), n=1, max_len=None).collect()
    by_prefix = {r["prefix"]: (r["query"], r["frequency"]) for r in got}
    assert by_prefix["red running s"] == ("red running shoes", 2) and by_prefix["red running so"] == ("red running socks", 1)
    assert by_prefix["red running shoes"] == ("red running shoes", 2) and "x" not in by_prefix
    assert len(features.autocomplete(spark.createDataFrame(rows, SCHEMA), n=1).where("length(prefix) > 10").collect()) == 0
