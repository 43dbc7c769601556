"""Rows and fields that must not get lost, and results that must not depend on the host."""

import datetime as dt
import json
import os
import subprocess
import sys
import time
import uuid
from pathlib import Path

from pyspark.sql import functions as F

from eventmart.config import MartConfig
from eventmart.functions.urls import url_query_param
from eventmart.operators import features, quality
from eventmart.operators.dedup import dedup_latest
from eventmart.plans import jobs
from eventmart.sources.tables import create_databases
from eventmart.streaming.bronze_stream import start_bronze_stream


def config(spark, workdir):
    s = uuid.uuid4().hex[:8]
    cfg = MartConfig(bronze_db=f"b{s}", silver_db=f"s{s}", gold_db=f"g{s}", raw_events_path=f"{workdir}/raw",
                     state_dir=f"{workdir}/state")
    create_databases(spark, cfg, location_root=f"{workdir}/wh")
    return cfg


def put(workdir, name, rows, days_old=0):
    path = Path(workdir, "raw", name)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(json.dumps(r) + "\n" for r in rows))
    then = time.time() - 86400 * days_old
    os.utime(path, (then, then))


def event(k, **more):
    return {"event_id": f"e{k}", "occurred_at": "2026-01-05T10:00:00Z", "site_id": "s", "event_type": "search"} | more


def test_late_files_and_their_fields_are_ingested(spark, workdir):
    cfg = config(spark, workdir)
    put(workdir, "a.json", [event(1)])
    start_bronze_stream(spark, cfg)
    put(workdir, "b.json", [event(2)], days_old=10)
    put(workdir, "c.json", [event(3, late_field="kept")], days_old=400)
    start_bronze_stream(spark, cfg)
    start_bronze_stream(spark, cfg)
    rows = spark.read.table(cfg.bronze_fqn).select("event_id", "late_field").collect()
    assert sorted((r["event_id"], r["late_field"]) for r in rows) == [("e1", None), ("e2", None), ("e3", "kept")]


def test_quarantine_grows_and_reruns_add_nothing(spark, workdir):
    cfg = config(spark, workdir)
    put(workdir, "a.json", [event(1, site_id=None)] * 3 + [event(2)])
    start_bronze_stream(spark, cfg)
    jobs.run_quarantine(spark, cfg)
    put(workdir, "b.json", [event(1, site_id=None)])
    start_bronze_stream(spark, cfg)
    for _ in range(2):
        jobs.run_quarantine(spark, cfg)
        rows = spark.read.table(cfg.quarantine_fqn).collect()
        assert sorted((r["event_id"], Path(r["source_file"]).name, r["_copy"]) for r in rows) == [
            ("e1", "a.json", 1), ("e1", "a.json", 2), ("e1", "a.json", 3), ("e1", "b.json", 1)]


def test_marks_are_utc_on_any_host():
    code = ("import datetime as d; from eventmart.plans.jobs import last_hours; "
            "from eventmart.session import build_session; from eventmart.operators.silver import _mark; "
            "s = build_session('local[1]'); m = d.datetime(2026, 1, 1, 12); "
            "print('GOT', *[r for r in s.range(1).select(_mark(m).cast('string'), "
            "_mark(m.replace(tzinfo=d.timezone.utc)).cast('string'), "
            "(_mark(last_hours(1)) < __import__('pyspark').sql.functions.current_timestamp()).cast('string')).first()])")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120,
                         cwd=Path(__file__).resolve().parents[1],
                         env=os.environ | {"TZ": "America/New_York", "SPARK_LOCAL_IP": "127.0.0.1"}).stdout
    assert "GOT 2026-01-01 12:00:00 2026-01-01 12:00:00 true" in out


def silver(spark, rows):
    return spark.createDataFrame(rows, "site_id string, session_id string, user_id string, event_type string, "
                                 "search_query string, product_id string, occurred_at_utc timestamp, event_date date")


def at(minute, second=0):
    return dt.datetime(2026, 1, 5, 10, tzinfo=dt.timezone.utc) + dt.timedelta(minutes=minute, seconds=second)


DAY = dt.date(2026, 1, 5)


def test_a_view_that_carries_its_query_is_a_click(spark):
    rows = [("s", "1", "u", "search", "q", None, at(0), DAY), ("s", "1", "u", "product_view", "q", "p", at(5), DAY),
            ("s", "1", "u", "search", "q", None, at(6), DAY), ("s", "1", "u", "search", "r", None, at(7), DAY),
            ("s", "1", "u", "product_view", None, "p", at(37, 1), DAY), ("s", "2", "u", "search", "q", None, at(0), DAY),
            ("s", "2", "u", "product_view", None, "p", at(0), DAY)]
    got = {r["search_query"]: (r["searches"], r["clicked_searches"]) for r in features.query_ctr(silver(spark, rows)).collect()}
    assert got == {"q": (3, 2), "r": (1, 0)}


def test_one_long_session_is_linear(spark):
    n = 100_000
    s = spark.range(n).selectExpr(
        "'s' AS site_id", "'1' AS session_id", "if(id % 3 = 0, 'search', 'product_view') AS event_type",
        "if(id % 3 = 0, concat('q', id % 7), null) AS search_query",
        "timestamp_micros(1767607200000000 + id * 10000) AS occurred_at_utc", "date'2026-01-05' AS event_date")
    got = features.query_ctr(s).agg(F.sum("searches"), F.sum("clicked_searches")).first()
    assert tuple(got) == ((n + 2) // 3, n // 3)


def test_blocks_of_pairs_change_nothing(spark, monkeypatch):
    rows = [("s", f"{k % 5}", f"u{k % 4}", ("product_view", "search", "order_complete")[k % 3], f"q{k % 4}" if k % 3 == 1 else None,
             f"p{k % 17}", at(k), DAY) for k in range(400)]
    df = silver(spark, rows)
    run = lambda: [sorted(map(tuple, f(df).collect())) for f in (
        features.viewed_together, features.co_viewed, features.searched_then_purchased)]
    whole = run()
    monkeypatch.setattr(features, "PAIR_BLOCK", 3)
    assert run() == whole and all(whole)


def test_campaign_urls_keep_their_parameters(spark):
    urls = ["https://x.example/?utm_source=a|b&y={1}", "https://x.example/?q=%zz&utm_source=ok", "https://x/?utm_source=a%20b#utm_source=c",
            "https://x/?utm_source=", "https://x/", None]
    df = spark.createDataFrame([(u,) for u in urls], "url string").select(url_query_param(F.col("url"), "utm_source").alias("v"))
    assert [r["v"] for r in df.collect()] == ["a|b", "ok", "a b", None, None, None]


def test_ties_do_not_depend_on_audit_columns(spark):
    rows = [("e", 1, None, "a", k) for k in (5, 6)] + [("e", 1, "a", None, k) for k in (1, 9)]
    df = spark.createDataFrame(rows, "event_id string, t int, x string, y string, _silver_updated_at int")
    for frame in (df, df.withColumn("_silver_updated_at", -F.col("_silver_updated_at"))):
        got = dedup_latest(frame, time_col="t").first()
        assert (got["x"], got["y"]) == (None, "a")


def test_rules_do_not_overlap(spark):
    df = spark.createDataFrame([("e", None, "s"), ("f", "soon", "s")], "event_id string, occurred_at string, site_id string")
    got = {r["event_id"]: r["reasons"] for r in quality.quarantine(df).collect()}
    assert got == {"e": "missing_occurred_at", "f": "unparseable_occurred_at"}


def test_no_field_is_lost(spark, workdir):
    cfg = config(spark, workdir)
    put(workdir, "a.json", [event(1, device={"os": "x"}, size=1)])
    query = start_bronze_stream(spark, cfg, trigger_once=False, await_termination=False)
    try:
        query.processAllAvailable()
        put(workdir, "b.json", [event(2, device={"os": "y", "ver": 7}, fresh=[1, {"a": 2}]), event(3, size="wide")])
        query.processAllAvailable()
    finally:
        query.stop()
    put(workdir, "c.json", [event(4, fresh=[3], device={"ver": 8})])
    start_bronze_stream(spark, cfg)
    rows = {r["event_id"]: r for r in spark.read.table(cfg.bronze_fqn).collect() if r["event_id"]}
    kept = {k: r["_rescued"] and json.loads(r["_rescued"]) for k, r in rows.items()}
    assert kept["e1"] is None and {k: json.loads(v) for k, v in kept["e2"].items()} == {
        "device": {"os": "y", "ver": 7}, "fresh": [1, {"a": 2}]}
    assert rows["e2"]["device"]["os"] == "y" and json.loads(kept["e4"]["device"]) == {"ver": 8}
    assert rows["e4"]["fresh"] is not None
    corrupt = [r["_corrupt_record"] for r in spark.read.table(cfg.bronze_fqn).where("_corrupt_record is not null").collect()]
    assert len(corrupt) == 1 and json.loads(corrupt[0])["size"] == "wide"
    # The row whose one value does not fit is valid: it reaches silver, and is a type conflict, not a rejected row.
    jobs.run_silver_upsert(spark, cfg)
    assert {r["event_id"] for r in spark.read.table(cfg.silver_fqn).collect()} == {"e1", "e2", "e3", "e4"}
    bronze = spark.read.table(cfg.bronze_fqn)
    assert quality.quarantine(bronze).count() == 0 and quality.quarantine_records(bronze).count() == 0
    checks = quality.dq_checks(bronze).first()
    assert (checks["type_conflicts"], checks["corrupt_record"], checks["invalid_rows"]) == (1, 0, 0)


def test_archived_files_stay_ingested_once(spark, workdir):
    cfg = config(spark, workdir)
    os.makedirs(f"{workdir}/raw")
    assert start_bronze_stream(spark, cfg, archive_dir=f"{workdir}/archive") is None
    for k in range(3):
        put(workdir, f"{k}.json", [event(k)])
        start_bronze_stream(spark, cfg, archive_dir=f"{workdir}/archive")
    assert sorted(r["event_id"] for r in spark.read.table(cfg.bronze_fqn).collect()) == ["e0", "e1", "e2"]


def test_keys_within_arrays_are_not_lost(spark, workdir):
    cfg = config(spark, workdir)
    deep = lambda **more: {"rows": [[{"at": [{"x": 1} | more]}], []]}
    put(workdir, "a.json", [event(1, items=[{"id": 1}, None], cart=deep(), tags=["t"])])
    start_bronze_stream(spark, cfg)
    put(workdir, "b.json", [event(2, items=[{"id": 2}, {"id": 3, "qty": 4}]), event(3, cart=deep(y=5)),
                            event(4, items=[], cart=deep(), tags=["u", "{\"v\": 1}"])])
    start_bronze_stream(spark, cfg)
    rows = spark.read.table(cfg.bronze_fqn).collect()
    kept = {r["event_id"]: r["_rescued"] and {k: json.loads(v) for k, v in json.loads(r["_rescued"]).items()} for r in rows}
    assert kept == {"e1": None, "e2": {"items": [{"id": 2}, {"id": 3, "qty": 4}]}, "e3": {"cart": deep(y=5)}, "e4": None}
    assert [[i["id"] for i in r["items"]] for r in rows if r["event_id"] == "e2"] == [[2, 3]]
    assert all(r["_corrupt_record"] is None for r in rows)
