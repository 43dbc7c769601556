"""Raw lines of any shape: none may stop ingestion, and no value may be lost."""

import json
import uuid
from pathlib import Path

from eventmart.config import MartConfig
from eventmart.plans import jobs
from eventmart.sources.tables import create_databases
from eventmart.streaming import schema_store
from eventmart.streaming.bronze_stream import start_bronze_stream


def config(spark, workdir):
    s = uuid.uuid4().hex[:8]
    cfg = MartConfig(bronze_db=f"b{s}", silver_db=f"s{s}", gold_db=f"g{s}", raw_events_path=f"{workdir}/raw",
                     state_dir=f"{workdir}/state")
    create_databases(spark, cfg, location_root=f"{workdir}/wh")
    return cfg


def put(workdir, name, *lines):
    path = Path(workdir, "raw", name)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(line + "\n" for line in lines))


def line(k, more=""):
    return f'{{"event_id":"e{k}","occurred_at":"2026-03-01T08:00:0{k % 10}Z","site_id":"north"{"," + more if more else ""}}}'


def rows_of(spark, cfg):
    return {r["event_id"]: r for r in spark.read.table(cfg.bronze_fqn).collect()}


def rescued(row):
    return row["_rescued"] and json.loads(row["_rescued"])


def test_repeated_keys_and_case_twins_land(spark, workdir):
    cfg = config(spark, workdir)
    put(workdir, "a.json", line(1, '"k":1,"k":2'), line(2, '"channel":"a","Channel":"b"'), line(3, '"d":{"x":1,"x":2,"X":3}'))
    start_bronze_stream(spark, cfg)
    put(workdir, "b.json", line(4, '"CHANNEL":"c","d":{"x":5}'), line(5, '"k":7'))
    start_bronze_stream(spark, cfg)
    got = rows_of(spark, cfg)
    assert set(got) == {"e1", "e2", "e3", "e4", "e5"}
    assert got["e1"]["k"] == 2 and got["e1"]["_rescued"] == '{"k":"1","k":"2"}' and got["e5"]["k"] == 7
    assert got["e2"]["channel"] == "a" and rescued(got["e2"]) == {"Channel": "b"}
    assert got["e3"]["d"]["x"] == 2 and rescued(got["e3"]) == {"d": '{"x":1,"x":2,"X":3}'}
    assert rescued(got["e4"]) == {"CHANNEL": "c"} and got["e4"]["d"]["x"] == 5
    assert all(r["_corrupt_record"] is None for r in got.values())


def test_names_of_added_columns_and_odd_names_are_kept(spark, workdir):
    cfg = config(spark, workdir)
    put(workdir, "day=1/a.json", line(1, '"_rescued":"r","_corrupt_record":5,"Event_Date":"x","_ingested_at":1,"Day":9'),
        line(2, '"it\'s":{"x":1},"b.c":{"q`q":1},"a b":1,"value":"v"'))
    start_bronze_stream(spark, cfg)
    put(workdir, "day=1/b.json", line(3, '"it\'s":{"x":1,"y":7},"b.c":{"q`q":1,"z":2}'), line(4, '"p,q":{"r;s":[{"t u":1}]}'))
    start_bronze_stream(spark, cfg)
    put(workdir, "day=2/c.json", line(5, '"p,q":{"r;s":[{"t u":1,"w":2}]}'))
    start_bronze_stream(spark, cfg)
    got = rows_of(spark, cfg)
    assert rescued(got["e1"]) == {"_rescued": "r", "_corrupt_record": "5", "Event_Date": "x", "_ingested_at": "1", "Day": "9"}
    assert got["e2"]["it's"]["x"] == 1 and got["e2"]["b.c"]["q`q"] == 1 and got["e2"]["a b"] == 1 and got["e2"]["value"] == "v"
    assert {k: json.loads(v) for k, v in rescued(got["e3"]).items()} == {"it's": {"x": 1, "y": 7}, "b.c": {"q`q": 1, "z": 2}}
    assert got["e4"]["p,q"]["r;s"][0]["t u"] == 1 and rescued(got["e4"]) is None
    assert json.loads(rescued(got["e5"])["p,q"]) == {"r;s": [{"t u": 1, "w": 2}]} and got["e5"]["day"] == 2


def test_keys_stay_text_and_misfits_are_kept(spark, workdir):
    cfg = config(spark, workdir)
    put(workdir, "a.json", '{"event_id":1,"occurred_at":"2026-03-01T08:00:00Z","site_id":7,"user_id":5,"size":1,"flag":true}')
    start_bronze_stream(spark, cfg)
    put(workdir, "b.json", line(2, '"size":"wide","flag":"maybe","user_id":"u"'), line(3, '"size":2.5,"flag":{"a":1}'), line(4, '"size":3'))
    start_bronze_stream(spark, cfg)
    got = rows_of(spark, cfg)
    assert set(got) == {"1", "e2", "e3", "e4"} and got["1"]["site_id"] == "7" and got["e2"]["user_id"] == "u"
    assert rescued(got["e2"]) == {"size": "wide", "flag": "maybe"} and rescued(got["e3"]) == {"size": "2.5", "flag": '{"a":1}'}
    assert got["e4"]["size"] == 3 and rescued(got["e4"]) is None and got["e2"]["_corrupt_record"]
    jobs.run_silver_upsert(spark, cfg)
    assert {r["event_id"] for r in spark.read.table(cfg.silver_fqn).collect()} == {"1", "e2", "e3", "e4"}


def test_lines_that_are_no_single_object_stay_whole(spark, workdir):
    cfg = config(spark, workdir)
    odd = ["{broken", "[1,2]", '"text"', "17", "null", line(1) + " tail", line(2) + line(3), "[" + line(4) + "]", "{}"]
    put(workdir, "a.json", *odd, "", "   ", line(5))
    start_bronze_stream(spark, cfg)
    got = [r["_corrupt_record"] for r in spark.read.table(cfg.bronze_fqn).collect()]
    assert sorted(x for x in got if x) == sorted(odd[:-1]) and len(got) == len(odd) + 1


def test_inference_reads_each_file_once(spark, workdir, monkeypatch):
    cfg = config(spark, workdir)
    monkeypatch.setattr(schema_store, "LEDGER_PIECES", 3)
    names = ["a.json", "odd [1] {x}*.json", "späße %20.json", "d.json", "e.json", "f.json"]
    for k, name in enumerate(names):
        put(workdir, name, line(k, f'"f{k}":1'))
        start_bronze_stream(spark, cfg)
        put(workdir, name, line(k, f'"ghost{k}":1'))  # would be seen if the file were inferred again
        assert schema_store.new_files(spark, cfg.schema_store_path(cfg.state_dir), cfg.raw_events_path) == []
    start_bronze_stream(spark, cfg)
    columns = spark.read.table(cfg.bronze_fqn).columns
    assert {f"f{k}" for k in range(6)} <= set(columns) and not any(c.startswith("ghost") for c in columns)
    assert len(rows_of(spark, cfg)) == 6


def test_sdk_spellings_in_any_case(spark, workdir):
    cfg = config(spark, workdir)
    put(workdir, "a.json", '{"eventId":"e1","EVENTID":"x","Event_Id":"y","occurredAt":"2026-03-01T08:00:00Z","siteId":"s"}',
        '{"event_id":"e2","occurred_at":"2026-03-01T08:00:00Z","siteId":"s"}')
    start_bronze_stream(spark, cfg)
    got = rows_of(spark, cfg)
    assert set(got) == {"e1", "e2"} and rescued(got["e1"]) == {"EVENTID": "x", "Event_Id": "y"}


def test_fields_first_seen_in_a_running_stream_reach_silver(spark, workdir):
    cfg = config(spark, workdir)
    put(workdir, "a.json", '{"event_id":"e1","occurred_at":"2026-03-01T08:00:00Z","site_id":"north"}')
    query = start_bronze_stream(spark, cfg, trigger_once=False, await_termination=False, interval="1 second")
    try:
        query.processAllAvailable()
        put(workdir, "b.json", '{"eventId":"e2","occurredAt":"2026-03-02T08:00:00Z","siteId":"south","sessionId":"s2",'
            '"properties":{"product_id":"p2"}}', '{"occurred_at":"never"}', line(3, '"user_id":"u3"'))
        query.processAllAvailable()
    finally:
        query.stop()
    spark.catalog.refreshTable(cfg.bronze_fqn)
    jobs.run_silver_upsert(spark, cfg)
    rows = {r["event_id"]: r for r in spark.read.table(cfg.silver_fqn).collect()}
    assert set(rows) == {"e1", "e2", "e3"} and rows["e3"]["user_id"] == "u3"
    assert (rows["e2"]["site_id"], rows["e2"]["session_id"], rows["e2"]["product_id"]) == ("south", "s2", "p2")
    jobs.run_quarantine(spark, cfg)
    assert [r["reasons"] for r in spark.read.table(cfg.quarantine_fqn).collect()] == [
        "missing_event_id,unparseable_occurred_at,missing_site_id"]


def test_replay_empties_the_quarantine_of_rows_that_are_valid_now(spark, workdir, monkeypatch):
    cfg = config(spark, workdir)
    put(workdir, "a.json", line(1), '{"event_id":"e2","site_id":"north"}')
    start_bronze_stream(spark, cfg)
    jobs.run_silver_upsert(spark, cfg)
    jobs.run_quarantine(spark, cfg)
    assert spark.read.table(cfg.quarantine_fqn).count() == 1
    rules = jobs.quality._rules
    monkeypatch.setattr(jobs.quality, "_rules", lambda df: {k: v & False for k, v in rules(df).items()})
    assert jobs.replay(spark, cfg)["rejected"] == 0
    assert spark.read.table(cfg.quarantine_fqn).count() == 0
    monkeypatch.undo()
    assert jobs.replay(spark, cfg)["rejected"] == 1 and spark.read.table(cfg.quarantine_fqn).count() == 1
