import datetime as dt
import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.operators.bronze import rename_sdk_fields
from eventmart.operators.silver import SILVER_COLUMNS, incremental_slice, normalize_silver_events

BASE = "event_id string, occurred_at string, site_id string, event_type string"


def _one(spark, rows, schema=BASE, **kw):
    return normalize_silver_events(spark.createDataFrame(rows, schema), **kw).collect()


def test_output_order_and_types(spark):
    out = normalize_silver_events(spark.createDataFrame([("layout-7", "2031-08-19T06:45:10Z", "harbour", "scroll")], BASE))
    assert out.columns == SILVER_COLUMNS
    types = dict(out.dtypes)
    assert types["occurred_at_utc"] == "timestamp" and types["event_date"] == "date"
    assert types["event_hour"] == "int" and types["zero_results"] == "boolean"


def test_time_formats_and_bad_text(spark):
    rows = [("a", "2026-05-16T23:05:01Z", "s", "x"), ("b", "2026-05-16T23:05:01.123Z", "s", "x"),
            ("c", "2026-05-16 23:05:01.123456+00:00", "s", "x"), ("d", "2026-05-17T01:05:01+02:00", "s", "x"),
            ("e", "bad", "s", "x"), ("f", None, "s", "x")]
    got = {r["event_id"]: r["occurred_at_utc"] for r in _one(spark, rows)}
    assert set(got) == {"a", "b", "c", "d"}
    assert got["a"] == dt.datetime(2026, 5, 16, 23, 5, 1)
    assert got["c"] == dt.datetime(2026, 5, 16, 23, 5, 1, 123456)
    assert got["d"] == dt.datetime(2026, 5, 16, 23, 5, 1)


def test_parsed_time_column_used_when_text_missing(spark):
    schema = "event_id string, occurred_at string, occurred_at_ts timestamp, site_id string, event_type string"
    rows = [("a", None, dt.datetime(2026, 1, 2, 3, 4, 5), "s", "x")]
    assert _one(spark, rows, schema)[0]["event_hour"] == 3


def test_url_cleanup_type_and_defaults(spark):
    schema = BASE + ", url string, pageUrl string"
    rows = [("a", "2026-01-01T00:00:00Z", "s", "  Page_View ", " https://x.com/ a\tb ", None),
            ("b", "2026-01-01T00:00:00Z", "s", None, None, None),
            ("c", "2026-01-01T00:00:00Z", "s", "x", "https://u", "https://page")]
    got = {r["event_id"]: r for r in _one(spark, rows, schema)}
    assert got["a"]["page_url"] == "https://x.com/ab" and got["a"]["event_type"] == "page_view"
    assert got["b"]["page_url"] == "" and got["b"]["event_type"] == ""
    assert got["c"]["page_url"] == "https://page"


def _props_expect(row):
    assert row["search_query"] == "teapot"
    assert row["product_id"] == "p1"
    assert row["zero_results"] is True


def test_properties_as_json_text(spark):
    props = json.dumps({"search_query": "teapot", "product_id": "p1", "zero_result": "YES"})
    _props_expect(_one(spark, [("a", "2026-01-01T00:00:00Z", "s", "x", props)], BASE + ", properties string")[0])


def test_properties_as_struct(spark):
    schema = T.StructType([*spark.createDataFrame([], BASE).schema.fields, T.StructField("properties", T.StructType([
        T.StructField("query", T.StringType()), T.StructField("product_id", T.StringType()),
        T.StructField("zero_results", T.BooleanType()), T.StructField("n", T.DoubleType())]))])
    row = _one(spark, [("a", "2026-01-01T00:00:00Z", "s", "x", ("teapot", "p1", True, 1.5))], schema)[0]
    _props_expect(row)


def test_properties_malformed_or_absent(spark):
    rows = [("a", "2026-01-01T00:00:00Z", "s", "x", "{not json"), ("b", "2026-01-01T00:00:00Z", "s", "x", None)]
    for r in _one(spark, rows, BASE + ", properties string"):
        assert r["search_query"] is None and r["zero_results"] is False
    r = _one(spark, [("c", "2026-01-01T00:00:00Z", "s", "x")])[0]
    assert r["utm_source"] is None and r["zero_results"] is False


def test_zero_result_flag_texts(spark):
    flags = {"t1": "true", "t2": "TRUE", "t3": "1", "t4": "yes", "f1": "no", "f2": "0", "f3": "false"}
    rows = [(k, "2026-01-01T00:00:00Z", "s", "x", json.dumps({"zero_results": v})) for k, v in flags.items()]
    got = {r["event_id"]: r["zero_results"] for r in _one(spark, rows, BASE + ", properties string")}
    assert got == {k: k.startswith("t") for k in flags}


def test_utm_from_url_is_opt_in(spark):
    schema = BASE + ", url string, properties string"
    rows = [("a", "2026-01-01T00:00:00Z", "s", "x", "https://e.com/p?q=1&utm_source=email#top",
             json.dumps({"utm_medium": "cpc"}))]
    plain = _one(spark, rows, schema)[0]
    assert plain["utm_source"] is None and plain["utm_medium"] == "cpc"
    rich = _one(spark, rows, schema, utm_from_url=True)[0]
    assert rich["utm_source"] == "email" and rich["utm_medium"] == "cpc"


def test_sdk_renames_merge_mixed_producers(spark):
    df = spark.createDataFrame([("a", None, "2026-01-01T00:00:00Z", "s"), (None, "b", "2026-01-01T00:00:00Z", "s")],
                               "event_id string, eventId string, occurredAt string, siteId string")
    out = rename_sdk_fields(df)
    assert sorted(out.columns) == ["event_id", "event_site_id", "occurred_at"]
    assert sorted(r["event_id"] for r in out.collect()) == ["a", "b"]


def test_incremental_slice_is_strict_and_optional(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2026, 1, 1), "2026-01-01T00:00:00Z"), (dt.datetime(2026, 1, 2), "2026-01-03T00:00:00Z")],
        "_ingested_at timestamp, received_at string")
    assert incremental_slice(df, since_ingested_at=dt.datetime(2026, 1, 1)).count() == 1
    assert incremental_slice(df, since_received_at=dt.datetime(2026, 1, 2)).count() == 1
    assert incremental_slice(df.drop("received_at"), since_received_at=dt.datetime(2030, 1, 1)).count() == 2
    assert incremental_slice(df).count() == 2
