import uuid
from collections import Counter

from pyspark.sql import functions as F

from eventmart.config import MartConfig
from eventmart.operators.silver import SILVER_DATA_COLUMNS, normalize_silver_events
from eventmart.sources import fixtures
from eventmart.sources.tables import add_missing_columns, create_databases
from tests.conftest import SF_SMALL


def test_add_missing_columns_is_additive(spark, workdir):
    s = uuid.uuid4().hex[:8]
    cfg = MartConfig(bronze_db=f"b{s}", silver_db=f"s{s}", gold_db=f"g{s}")
    create_databases(spark, cfg, location_root=workdir)
    fqn = cfg.gold_fqn("t")
    spark.createDataFrame([(1, "2026-01-01")], "a long, event_date string").selectExpr(
        "a", "CAST(event_date AS DATE) AS event_date").write.partitionBy("event_date").saveAsTable(fqn)
    wider = spark.createDataFrame([], "a string, b string, event_date date").schema
    assert add_missing_columns(spark, fqn, wider) == ["b"]
    assert dict(spark.read.table(fqn).dtypes) == {"a": "bigint", "b": "string", "event_date": "date"}
