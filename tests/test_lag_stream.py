"""Lag figures kept by a stream: late rows apart, replays without doubles, quantiles close."""

import datetime as dt
import uuid

import pytest
from pyspark.errors import StreamingQueryException

from eventmart.config import MartConfig
from eventmart.operators import quality
from eventmart.plans import jobs
from eventmart.sources.tables import create_databases, create_table

SCHEMA = ("event_id string, occurred_at string, site_id string, _ingested_at timestamp, _source_file string, event_date date")
START = dt.datetime(2026, 5, 4, 12)


def rows_of(spark, lags, site="a"):
    """An event for each lag in seconds, ingested at noon."""
    out = []
    for k, lag in enumerate(lags):
        event = None if lag is None else START - dt.timedelta(seconds=lag)
        out.append((f"{site}{k}", event and event.isoformat() + "Z", site, START, f"raw/site_id={site}/x.json", event and event.date()))
    return spark.createDataFrame(out, SCHEMA)


def totals(spark, cfg):
    return {r["source"]: r.asDict() for r in quality.lag_totals(spark.read.table(cfg.lag_fqn)).collect()}


def test_late_rows_and_replays(spark, workdir):
    s = uuid.uuid4().hex[:8]
    cfg = MartConfig(bronze_db=f"b{s}", silver_db=f"s{s}", gold_db=f"g{s}", state_dir=f"{workdir}/state")
    create_databases(spark, cfg, location_root=f"{workdir}/wh")
    create_table(rows_of(spark, [*range(1000), None, 200_000]), cfg.bronze_fqn)
    with pytest.raises(StreamingQueryException):
        jobs.stream_lag(spark, cfg, after_batch=lambda b: 1 / 0)
    jobs.stream_lag(spark, cfg)
    got = totals(spark, cfg)["a"]
    assert (got["rows"], got["bad_rows"], got["late_rows"], got["max_lag_seconds"]) == (1002, 1, 0, 200_000)
    assert abs(got["p50_lag_seconds"] - 500) < 40 and abs(got["p95_lag_seconds"] - 950) < 40
    more = rows_of(spark, [10, 90_000, 86_000, 300_000], "b").unionByName(rows_of(spark, [None], "c"))
    more.select(*spark.read.table(cfg.bronze_fqn).columns).write.insertInto(cfg.bronze_fqn)
    jobs.stream_lag(spark, cfg)
    jobs.stream_lag(spark, cfg)
    got = totals(spark, cfg)
    assert got["a"]["rows"] == 1002 and (got["b"]["rows"], got["b"]["late_rows"]) == (4, 2)
    assert (got["c"]["rows"], got["c"]["bad_rows"], got["c"]["avg_lag_seconds"], got["c"]["p50_lag_seconds"]) == (1, 1, None, None)
    same = {r["source"]: r for r in quality.ingest_lag(spark.read.table(cfg.bronze_fqn)).collect()}
    for source, r in same.items():
        assert all(r[c] == got[source][c] for c in ("rows", "bad_rows", "avg_lag_seconds", "max_lag_seconds"))
