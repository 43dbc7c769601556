"""Plan shape: pruning, pushdown, no Python UDFs, no cartesian products."""

import datetime as dt
import uuid

import pytest

from eventmart.config import MartConfig
from eventmart.operators.silver import normalize_silver_events
from eventmart.plans import jobs, registry
from eventmart.sources import fixtures
from eventmart.sources.tables import create_databases, read_dates
from tests.conftest import SF_SMALL

BANNED = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [k for k in registry.queries() if k not in
                                  ("bronze_ingest", "silver_merge_table", "gold_refresh")])
def test_no_python_or_cartesian(spark, name):
    text = plan(registry.queries()[name](spark, SF_SMALL))
    assert not [b for b in BANNED if b in text], name


def test_gold_read_prunes_partitions_and_columns(spark, workdir):
    s = uuid.uuid4().hex[:8]
    cfg = MartConfig(bronze_db=f"b{s}", silver_db=f"s{s}", gold_db=f"g{s}")
    create_databases(spark, cfg, location_root=workdir)
    jobs.upsert_silver_rows(spark, cfg.silver_fqn,
                            normalize_silver_events(fixtures.bronze_like(spark, SF_SMALL), carry=("_ingested_at",)))
    df = read_dates(spark, cfg.silver_fqn, ["2024-01-03"]).select("site_id", "event_type")
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in text and "2024-01-03" in text
    assert "ReadSchema: struct<site_id:string,event_type:string>" in text


def test_incremental_slice_pushes_to_parquet(spark, workdir):
    path = f"{workdir}/bronze"
    fixtures.bronze_like(spark, SF_SMALL).write.parquet(path)
    from eventmart.operators.silver import incremental_slice
    df = incremental_slice(spark.read.parquet(path), since_ingested_at=dt.datetime(2024, 1, 15))
    assert "PushedFilters: [IsNotNull(_ingested_at), GreaterThan(_ingested_at" in plan(df)


def test_dedup_cuts_groups_before_shuffle(spark):
    df = registry.silver_dedup(spark, SF_SMALL)
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in text
