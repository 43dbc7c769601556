"""Work per line and row that does not depend on the rows' values: what is parsed, written as text and dealt out."""

import types

from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.operators import quality
from eventmart.session import HUGE_METHODS, REQUIRED_CONF, configure
from eventmart.sources import fixtures
from eventmart.streaming.bronze_stream import parse_lines

TEXTS = T.StructType([T.StructField(n, T.StringType()) for n in ("event_id", "url", "properties")])
# line -> event_id, url, properties, whole line kept, rescued text
LINES = {
    '{"event_id":"a","url":null,"properties":{ "x" : 1.0, "y":[1, 2] }}': ("a", None, '{"x":1.0,"y":[1,2]}', False, None),
    '{"event_id":1e5,"url":true}': ("100000.0", "true", None, False, None),
    '{"event_id":"a","event_id":null}': (None, None, None, False, True),
    '{"event_id":"a","event_id":"b"}': ("b", None, None, False, True),
    '{"event_id":"a","new":1,"url":"u"}': ("a", "u", None, False, True),
    '{"event_id":"a"} tail': ("a", None, None, True, None),
    '{"event_id":"a"},{"event_id":"b"}': ("a", None, None, True, None),
    '{"event_id": "broken", ': (None, None, None, True, None),
    '{}': (None, None, None, False, None),
    '{"event_id":"a","site":"q"}': ("a", None, None, False, None),
}


def _lines(spark, lines):
    return spark.createDataFrame([(line, "s") for line in lines], "value string, site string")


def test_lines_of_text_columns(spark):
    rows = parse_lines(_lines(spark, LINES), TEXTS, ["site"]).collect()
    got = [(r["event_id"], r["url"], r["properties"], r["_corrupt_record"] is not None, r["_rescued"] and True) for r in rows]
    assert got == list(LINES.values())
    assert [r["_corrupt_record"] for r in rows if r["_corrupt_record"]] == [x for x, kept in LINES.items() if kept[3]]


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_line_of_text_columns_is_parsed_once(spark):
    generators = [x for x in _plan(parse_lines(_lines(spark, LINES), TEXTS, ["site"])).splitlines() if "Generate" in x]
    # The second parse, with the schema, stands in a branch for lines that the first one does not settle.
    assert "from_json(StructField" not in generators[-1]
    assert all("CASE WHEN" in x[:x.index("from_json(StructField")] for x in generators if "from_json(StructField" in x)


def test_only_rejected_rows_are_written_as_text(spark):
    rows = spark.createDataFrame([("a", "s", "2026-05-16T10:00:00Z", None), (None, "s", "never", '{"url":"u"}')],
                                 "event_id string, site_id string, occurred_at string, _rescued string")
    bad = quality.quarantine_records(rows.withColumn("_ingested_at", F.lit("2026-05-17 00:00:00").cast("timestamp")))
    plan = _plan(bad)
    assert plan.index("StructsToJsonEvaluator") < plan.index("Generate explode")
    assert [r["raw_record"] for r in bad.collect()] == ['{"site_id":"s","occurred_at":"never","_rescued":"{\\"url\\":\\"u\\"}"}']


def test_rows_are_dealt_without_a_sort(spark):
    plan = fixtures.spread(spark.range(10).selectExpr("id", "id % 2 AS k"))._jdf.queryExecution().toString()
    assert "RoundRobinPartitioning" not in plan and "hashpartitioning" in plan


class _Session:
    def __init__(self, master, options):
        self.sparkContext = types.SimpleNamespace(master=master)
        self.conf = self
        self.kept = dict(options)

    def get(self, key, default=None):
        return self.kept.get(key, default)

    def set(self, key, value):
        self.kept[key] = value


def test_long_methods_are_split_where_the_jvm_would_not_compile_them():
    limit = "spark.sql.codegen.hugeMethodLimit"
    plain = configure(_Session("local[4]", {"spark.executor.extraJavaOptions": HUGE_METHODS})).kept
    assert plain[limit] == "8000" and REQUIRED_CONF.items() <= plain.items()
    assert configure(_Session("spark://x:1", {})).kept[limit] == "8000"
    assert limit not in configure(_Session("local[4]", {"spark.driver.extraJavaOptions": f"-Xss4m {HUGE_METHODS}"})).kept
    assert limit not in configure(_Session("spark://x:1", {"spark.executor.extraJavaOptions": HUGE_METHODS})).kept
