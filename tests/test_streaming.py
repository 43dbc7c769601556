import json
import os
import uuid

from eventmart.config import MartConfig
from eventmart.operators.silver import normalize_silver_events
from eventmart.sources.tables import create_databases
from eventmart.streaming import schema_store
from eventmart.streaming.bronze_stream import start_bronze_stream


def _write(root, site, date, name, lines):
    d = os.path.join(root, f"site_id={site}", f"date={date}", "hour=10")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_bronze_stream_once_evolves_and_quarantines(spark, workdir):
    s = uuid.uuid4().hex[:8]
    raw = os.path.join(workdir, "raw")
    cfg = MartConfig(bronze_db=f"b{s}", silver_db=f"s{s}", gold_db=f"g{s}", raw_events_path=raw,
                     state_dir=os.path.join(workdir, "state"))
    create_databases(spark, cfg, location_root=os.path.join(workdir, "wh"))
    _write(raw, "site_1", "2026-05-16", "a.jsonl", [
        json.dumps({"eventId": "e1", "occurredAt": "2026-05-16T23:05:01.000Z", "siteId": "payload",
                    "eventType": "search", "properties": {"query": "teapot"}}),
        json.dumps({"event_id": "e2", "occurred_at": "2026-05-16T23:06:01Z", "site_id": "payload_loses",
                    "event_type": "page_view"}),
        '{"event_id": "broken", ',
    ])
    start_bronze_stream(spark, cfg, trigger_once=True)
    bronze = spark.read.table(cfg.bronze_fqn)
    rows = {r["event_id"]: r for r in bronze.collect()}
    assert rows["e1"]["event_site_id"] == "payload" and rows["e2"]["site_id"] == "site_1"
    assert rows["e1"]["_source_file"].endswith("a.jsonl")
    assert sum(1 for r in rows.values() if r["_corrupt_record"]) == 1
    assert rows["e1"]["event_date"].isoformat() == "2026-05-16"

    start_bronze_stream(spark, cfg, trigger_once=True)       # nothing new -> no rows
    assert spark.read.table(cfg.bronze_fqn).count() == 3

    _write(raw, "site_2", "2026-05-17", "b.jsonl", [
        json.dumps({"event_id": "e3", "occurred_at": "2026-05-17T01:00:00Z", "event_type": "purchase",
                    "campaign": "spring", "properties": {"query": "x", "product_id": "p9"}})])
    start_bronze_stream(spark, cfg, trigger_once=True)
    bronze = spark.read.table(cfg.bronze_fqn)
    assert "campaign" in bronze.columns and bronze.count() == 4
    got = {r["event_id"]: r["campaign"] for r in bronze.collect()}
    assert got["e3"] == "spring" and got["e1"] is None
    saved = schema_store.load_schema(spark, cfg.schema_store_path(cfg.state_dir))
    assert saved["properties"].dataType.simpleString() == "string"

    silver = {r["event_id"]: r for r in normalize_silver_events(bronze).collect()}
    assert set(silver) == {"e1", "e2", "e3"}
    assert silver["e1"]["site_id"] == "payload" and silver["e1"]["search_query"] == "teapot"
    assert silver["e3"]["product_id"] == "p9"


def test_merge_schemas_keeps_saved_types():
    from pyspark.sql import types as T
    saved = T.StructType([T.StructField("a", T.LongType()), T.StructField("p", T.StructType([T.StructField("x", T.StringType())]))])
    seen = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType()),
                         T.StructField("p", T.StructType([T.StructField("y", T.LongType())]))])
    merged = schema_store.merge_schemas(saved, seen)
    assert merged["a"].dataType == T.LongType() and merged.fieldNames() == ["a", "p", "b"]
    assert merged["p"].dataType.fieldNames() == ["x"]  # new nested keys are rescued


def test_continuous_trigger_and_batch_metrics(spark, workdir):
    s = uuid.uuid4().hex[:8]
    raw = os.path.join(workdir, "raw")
    cfg = MartConfig(bronze_db=f"b{s}", silver_db=f"s{s}", gold_db=f"g{s}", raw_events_path=raw,
                     state_dir=os.path.join(workdir, "state"))
    create_databases(spark, cfg, location_root=os.path.join(workdir, "wh"))
    _write(raw, "site_1", "2026-05-16", "a.jsonl", [
        json.dumps({"event_id": "e1", "occurred_at": "2026-05-16T10:00:00Z", "event_type": "x"}),
        json.dumps({"event_id": "e2", "occurred_at": "nope", "event_type": "x"}),
        "{broken"])
    query = start_bronze_stream(spark, cfg, trigger_once=False, await_termination=False)
    try:
        query.processAllAvailable()
        metrics = [p["observedMetrics"]["bronze_batch"] for p in query.recentProgress
                   if p.get("observedMetrics", {}).get("bronze_batch")]
    finally:
        query.stop()
    assert sum(m["rows"] for m in metrics) == 3
    assert sum(m["corrupt_rows"] for m in metrics) == 1
    assert sum(m["undated_rows"] for m in metrics) == 2
    assert spark.read.table(cfg.bronze_fqn).count() == 3
