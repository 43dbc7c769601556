"""The fingerprint index beside silver, and silver as a stream."""

import datetime as dt
import uuid

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from eventmart.config import MartConfig
from eventmart.operators.silver import SILVER_DATA_COLUMNS, normalize_silver_events
from eventmart.plans import jobs
from eventmart.sources import id_index
from eventmart.sources.tables import create_databases, create_table

RAW = "event_id string, occurred_at string, site_id string, event_type string, _ingested_at timestamp"
T0 = dt.datetime(2026, 2, 1)


def config(spark, workdir):
    s = uuid.uuid4().hex[:8]
    cfg = MartConfig(bronze_db=f"b{s}", silver_db=f"s{s}", gold_db=f"g{s}", state_dir=f"{workdir}/state")
    create_databases(spark, cfg, location_root=f"{workdir}/wh")
    return cfg


def raw(spark, rows):
    return spark.createDataFrame([(e, f"2026-02-{d:02d}T{h:02d}:00:00Z", "s", t, T0) for e, d, h, t in rows], RAW)


def upsert(spark, cfg, rows):
    return jobs.upsert_silver_rows(spark, cfg.silver_fqn, normalize_silver_events(raw(spark, rows), carry=("_ingested_at",)))


def state(spark, cfg):
    return {r["event_id"]: (r["event_date"].day, r["event_type"]) for r in spark.read.table(cfg.silver_fqn).collect()}


def in_step(spark, cfg):
    """Every id of every day is in the index."""
    want = spark.read.table(cfg.silver_fqn).select(F.xxhash64("event_id").alias("fp"), "event_date")
    return want.join(spark.read.table(id_index.index_name(cfg.silver_fqn)), ["fp", "event_date"], "left_anti").count() == 0


def test_only_days_with_hits_are_opened(spark, workdir):
    cfg = config(spark, workdir)
    upsert(spark, cfg, [(f"e{d}-{k}", d, 5, "a") for d in range(1, 8) for k in range(20)])
    done = upsert(spark, cfg, [("new1", 3, 5, "b"), ("new2", 20, 5, "b")])
    assert done["opened"] == [] and done["accepted"] == 2 and done["opened_bytes"] == 0 and done["index_bytes"] > 0
    done = upsert(spark, cfg, [("e2-1", 2, 6, "c"), ("e5-1", 9, 1, "moved"), ("e6-1", 6, 4, "older"), ("new3", 7, 1, "b")])
    assert [d.day for d in done["opened"]] == [2, 5, 6] and done["accepted"] == 3
    got = state(spark, cfg)
    assert got["e2-1"] == (2, "c") and got["e5-1"] == (9, "moved") and got["e6-1"] == (6, "a") and len(got) == 143
    assert in_step(spark, cfg)
    # The moved id is still entered for its old day: that day is opened, and nothing is taken from it.
    done = upsert(spark, cfg, [("e5-1", 10, 1, "again")])
    assert {9, 5} >= {d.day for d in done["opened"]} and state(spark, cfg)["e5-1"] == (10, "again") and in_step(spark, cfg)


def test_an_index_that_lacks_days_is_filled_first(spark, workdir):
    cfg = config(spark, workdir)
    upsert(spark, cfg, [(f"e{d}", d, 5, "a") for d in range(1, 6)])
    spark.sql(f"ALTER TABLE {id_index.index_name(cfg.silver_fqn)} DROP PARTITION (event_date = DATE '2026-02-03')")
    upsert(spark, cfg, [("e3", 4, 1, "moved")])
    assert state(spark, cfg)["e3"] == (4, "moved") and len(state(spark, cfg)) == 5 and in_step(spark, cfg)
    spark.sql(f"DROP TABLE {id_index.index_name(cfg.silver_fqn)}")
    assert upsert(spark, cfg, [("e4", 4, 5, "tie")])["accepted"] == 0
    assert in_step(spark, cfg)


def test_an_unfinished_write_costs_an_opened_day_only(spark, workdir):
    cfg = config(spark, workdir)
    upsert(spark, cfg, [("a", 1, 5, "a"), ("b", 2, 5, "a")])
    ghost = spark.createDataFrame([("ghost", dt.date(2026, 2, 1))], "event_id string, event_date date")
    id_index.add_entries(spark, cfg.silver_fqn, ghost, [dt.date(2026, 2, 1)])
    done = upsert(spark, cfg, [("ghost", 2, 7, "real")])
    assert [d.day for d in done["opened"]] == [1] and state(spark, cfg)["ghost"] == (2, "real") and in_step(spark, cfg)


def test_emptied_days_leave_the_index(spark, workdir):
    cfg = config(spark, workdir)
    upsert(spark, cfg, [("a", 1, 5, "a"), ("b", 2, 5, "a")])
    upsert(spark, cfg, [("a", 3, 5, "a")])
    assert {d.day for d in id_index.days_of(spark, id_index.index_name(cfg.silver_fqn))} == {2, 3}


@pytest.mark.parametrize("when", ["after", "within"])
def test_a_replayed_micro_batch_changes_nothing(spark, workdir, monkeypatch, when):
    cfg = config(spark, workdir)
    day = lambda df: df.withColumn("event_date", F.to_date(F.substring("occurred_at", 1, 10)))
    create_table(day(raw(spark, [("a", 1, 5, "v1"), ("a", 1, 4, "v0"), ("b", 2, 5, "b1")])), cfg.bronze_fqn)
    calls, write = [], jobs.upsert_silver_rows

    def broken(*args, **kwargs):
        calls.append(write(*args, **kwargs))
        raise RuntimeError("ended within the write")

    if when == "within":
        monkeypatch.setattr(jobs, "upsert_silver_rows", broken)
    with pytest.raises(StreamingQueryException):
        jobs.stream_silver(spark, cfg, after_batch=lambda b: 1 / 0)
    monkeypatch.setattr(jobs, "upsert_silver_rows", lambda *a, **k: calls.append(write(*a, **k)))
    first = {tuple(r) for r in spark.read.table(cfg.silver_fqn).select(*SILVER_DATA_COLUMNS).collect()}
    jobs.stream_silver(spark, cfg)
    assert len(calls) == (2 if when == "within" else 0)  # recorded: passed over; not recorded: upserted again
    assert {tuple(r) for r in spark.read.table(cfg.silver_fqn).select(*SILVER_DATA_COLUMNS).collect()} == first
    day(raw(spark, [("a", 3, 1, "v2"), ("c", 1, 1, "c1")])).select(*spark.read.table(cfg.bronze_fqn).columns).write.insertInto(cfg.bronze_fqn)
    jobs.stream_silver(spark, cfg)
    assert state(spark, cfg) == {"a": (3, "v2"), "b": (2, "b1"), "c": (1, "c1")}
