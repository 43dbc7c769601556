import datetime as dt
import uuid

from eventmart.operators.dedup import dedup_latest
from eventmart.operators.silver import SILVER_COLUMNS, normalize_silver_events
from eventmart.operators.upsert import merge_replace, upsert_latest
from eventmart.plans import jobs
from eventmart.sources.tables import create_databases
from eventmart.config import MartConfig

RAW = "event_id string, occurred_at string, site_id string, event_type string, _ingested_at timestamp"
T0 = dt.datetime(2026, 1, 1)


def raw(spark, rows):
    return normalize_silver_events(spark.createDataFrame(rows, RAW), carry=("_ingested_at",))


def test_dedup_latest_then_earliest_ingest(spark):
    rows = [("e1", "2026-01-01T10:00:00Z", "s", "a", T0), ("e1", "2026-01-01T11:00:00Z", "s", "b", T0),
            ("e2", "2026-01-01T10:00:00Z", "s", "late", T0 + dt.timedelta(days=1)),
            ("e2", "2026-01-01T10:00:00Z", "s", "first", T0)]
    got = {r["event_id"]: r["event_type"] for r in dedup_latest(raw(spark, rows)).collect()}
    assert got == {"e1": "b", "e2": "first"}


def test_upsert_latest_semantics(spark):
    target = raw(spark, [("a", "2026-01-01T10:00:00Z", "s", "old", T0), ("b", "2026-01-01T10:00:00Z", "s", "keep", T0),
                         ("c", "2026-01-01T10:00:00Z", "s", "tie", T0)]).drop("_ingested_at")
    incoming = raw(spark, [("a", "2026-01-02T10:00:00Z", "s", "new", T0), ("b", "2025-12-31T10:00:00Z", "s", "older", T0),
                           ("c", "2026-01-01T10:00:00Z", "s", "tie2", T0), ("d", "2026-01-01T10:00:00Z", "s", "ins", T0),
                           ("d", "2026-01-01T09:00:00Z", "s", "ins-old", T0)])
    got = {r["event_id"]: r["event_type"] for r in upsert_latest(target, incoming).collect()}
    assert got == {"a": "new", "b": "keep", "c": "tie", "d": "ins"}


def test_merge_replace_null_safe(spark):
    schema = "site_id string, event_date date, search_query string, n long"
    d = dt.date(2026, 1, 1)
    target = spark.createDataFrame([("s", d, None, 1), ("s", d, "q", 1), ("s", d, "gone", 1)], schema)
    incoming = spark.createDataFrame([("s", d, None, 5), ("s", d, "q", 6), ("s", d, "new", 7)], schema)
    got = {r["search_query"]: r["n"] for r in merge_replace(target, incoming, ["site_id", "event_date", "search_query"]).collect()}
    assert got == {None: 5, "q": 6, "gone": 1, "new": 7}


def _cfg(spark, workdir):
    s = uuid.uuid4().hex[:8]
    cfg = MartConfig(bronze_db=f"b{s}", silver_db=f"s{s}", gold_db=f"g{s}")
    create_databases(spark, cfg, location_root=workdir)
    return cfg


def _state(spark, fqn):
    return {r["event_id"]: (r["event_type"], r["event_date"]) for r in spark.read.table(fqn).collect()}


def test_table_upsert_moves_dates_drops_empty_partition_and_is_idempotent(spark, workdir):
    cfg = _cfg(spark, workdir)
    fqn = cfg.silver_fqn
    first = raw(spark, [("a", "2026-01-01T10:00:00Z", "s", "v1", T0), ("a", "2026-01-01T09:00:00Z", "s", "v0", T0),
                        ("b", "2026-01-02T10:00:00Z", "s", "b1", T0)])
    assert jobs.upsert_silver_rows(spark, fqn, first)["created"]
    assert _state(spark, fqn) == {"a": ("v1", dt.date(2026, 1, 1)), "b": ("b1", dt.date(2026, 1, 2))}
    batch = raw(spark, [("a", "2026-01-03T10:00:00Z", "s", "v2", T0),      # newer, moves a to 01-03
                        ("b", "2026-01-01T10:00:00Z", "s", "b-old", T0),   # older: ignored
                        ("c", "2026-01-02T11:00:00Z", "s", "c1", T0)])     # new
    info = jobs.upsert_silver_rows(spark, fqn, batch)
    assert dt.date(2026, 1, 1) in info["dropped"]
    expected = {"a": ("v2", dt.date(2026, 1, 3)), "b": ("b1", dt.date(2026, 1, 2)), "c": ("c1", dt.date(2026, 1, 2))}
    assert _state(spark, fqn) == expected
    assert spark.read.table(fqn).columns[-1] == "event_date"
    assert sorted(spark.read.table(fqn).select(*SILVER_COLUMNS).columns) == sorted(SILVER_COLUMNS)
    again = jobs.upsert_silver_rows(spark, fqn, batch)
    assert again["accepted"] == 0 and _state(spark, fqn) == expected
    parts = {r[0] for r in spark.sql(f"SHOW PARTITIONS {fqn}").collect()}
    assert parts == {"event_date=2026-01-02", "event_date=2026-01-03"}


def test_gold_merge_keeps_vanished_groups_replace_drops_them(spark, workdir):
    cfg = _cfg(spark, workdir)
    schema = "site_id string, event_date date, funnel_step string, event_count long"
    d1, d2 = dt.date(2026, 1, 1), dt.date(2026, 1, 2)
    first = spark.createDataFrame([("s", d1, "a", 1), ("s", d1, "b", 1), ("s", d2, "a", 1)], schema)
    keys = ["site_id", "event_date", "funnel_step"]
    fqn = cfg.gold_fqn("funnel_metrics")
    jobs.upsert_gold(spark, fqn, first, keys)
    jobs.upsert_gold(spark, fqn, spark.createDataFrame([("s", d1, "a", 9)], schema), keys, mode="merge")
    got = sorted((r["event_date"], r["funnel_step"], r["event_count"]) for r in spark.read.table(fqn).collect())
    assert got == [(d1, "a", 9), (d1, "b", 1), (d2, "a", 1)]
    jobs.upsert_gold(spark, fqn, spark.createDataFrame([("s", d1, "a", 7)], schema), keys, mode="replace_dates")
    got = sorted((r["event_date"], r["funnel_step"], r["event_count"]) for r in spark.read.table(fqn).collect())
    assert got == [(d1, "a", 7), (d2, "a", 1)]


def test_accepted_changes_heals_duplicate_copies(spark):
    from eventmart.operators.upsert import accepted_changes
    target = raw(spark, [("a", "2026-01-01T10:00:00Z", "s", "x", T0), ("a", "2026-01-02T10:00:00Z", "s", "y", T0),
                         ("b", "2026-01-01T10:00:00Z", "s", "z", T0)]).drop("_ingested_at")
    incoming = raw(spark, [("a", "2026-01-02T10:00:00Z", "s", "y", T0), ("b", "2026-01-01T10:00:00Z", "s", "z", T0)])
    got = {r["event_id"]: sorted(r["_old_dates"]) for r in accepted_changes(target, incoming).collect()}
    assert got == {"a": [dt.date(2026, 1, 1), dt.date(2026, 1, 2)]}


def test_correction_of_an_old_event_replaces_it(spark, workdir):
    cfg = _cfg(spark, workdir)
    fqn = cfg.silver_fqn
    jobs.upsert_silver_rows(spark, fqn, raw(spark, [("a", "2026-01-01T10:00:00Z", "s", "v1", T0),
                                                    ("b", "2026-01-05T10:00:00Z", "s", "b1", T0)]))
    jobs.upsert_silver_rows(spark, fqn, raw(spark, [("a", "2026-03-06T10:00:00Z", "s", "a2", T0)]))
    assert _state(spark, fqn) == {"a": ("a2", dt.date(2026, 3, 6)), "b": ("b1", dt.date(2026, 1, 5))}


def test_null_days_are_merged_like_others(spark, workdir):
    cfg = _cfg(spark, workdir)
    fqn = cfg.gold_fqn("t")
    rows = lambda *r: spark.createDataFrame(list(r), "k string, v int, event_date date")
    day = dt.date(2026, 1, 1)
    jobs.upsert_gold(spark, fqn, rows(("a", 1, None), ("b", 1, None), ("c", 1, day)), ["k", "event_date"])
    assert jobs.upsert_gold(spark, fqn, rows(("b", 2, None), ("d", 2, None)), ["k", "event_date"]) == [None]
    got = {(r["k"], r["v"], r["event_date"]) for r in spark.read.table(fqn).collect()}
    assert got == {("a", 1, None), ("b", 2, None), ("d", 2, None), ("c", 1, day)}
