"""Registered queries that run the table and stream paths end to end.

Each run works in a fresh folder under the shared checkpoint folder
(``session.scratch_dir``) with its own databases, derives its input from the
driver's ``events`` table, and returns the resulting table's rows. These are
checkpointed, and the databases and the folder are dropped.
"""

from __future__ import annotations

import os
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from eventmart.config import MartConfig
from eventmart.functions.timestamps import event_time
from eventmart.operators import gold, quality
from eventmart.operators.silver import SILVER_DATA_COLUMNS, normalize_silver_events
from eventmart.plans import jobs
from eventmart.session import configure, materialize, scratch_dir
from eventmart.sources import fixtures
from eventmart.sources.tables import create_databases, create_table, drop_databases
from eventmart.streaming.bronze_stream import start_bronze_stream

BRONZE_OUT = ["event_id", "site_id", "event_site_id", "event_type", "occurred_at_ts", "event_date"]
# Days whose raw files come in the second drain, with the age in days that their files are given.
LATE_DAYS = {"2024-01-05": 10, "2024-01-20": 400}
# Days that the second gold refresh recomputes.
REFRESHED_DAYS = ["2024-01-03", "2024-01-17"]
QUARANTINE_SINCE = "2024-01-10 00:00:00"


def fresh_config(spark: SparkSession, tag: str) -> tuple[MartConfig, str]:
    configure(spark)
    root = scratch_dir(spark, tag)
    suffix = uuid.uuid4().hex[:10]
    cfg = MartConfig(bronze_db=f"bronze_{suffix}", silver_db=f"silver_{suffix}", gold_db=f"gold_{suffix}",
                     raw_events_path=f"{root}/raw/events", state_dir=f"{root}/state")
    create_databases(spark, cfg, location_root=f"{root}/warehouse")
    return cfg, root


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def finished(spark: SparkSession, cfg: MartConfig, root: str, rows: DataFrame) -> DataFrame:
    """The rows, kept in a checkpoint, after the run's databases and folder are dropped."""
    kept = materialize(rows)
    drop_databases(spark, cfg)
    fs, at = _fs(spark, root)
    fs.delete(at, True)
    return kept


def write_raw_files(spark: SparkSession, sf_dir: str, path: str, days: str = "true", without: tuple[str, ...] = ()) -> None:
    """Raw events as JSON lines in ``site_id=…/date=…`` folders (SDK names on even ids), for days that meet a condition and
    without some of the fields."""
    raw = fixtures.raw_events(spark, sf_dir, camel_case=True)
    payload = [c for c in raw.columns if not c.startswith("_") and c != "site_id" and c not in without]
    (raw.selectExpr(*payload, "_path_site AS site_id", "_path_date AS date").where(days)
        .hint("rebalance", "site_id", "date")
        .write.mode("append").partitionBy("site_id", "date").json(path))


def age_files(spark: SparkSession, path: str, days: dict[str, int]) -> None:
    """Date the files of a few days back, as a late copy that keeps its time would be."""
    fs, _ = _fs(spark, path)
    for day, age in days.items():
        then = int((time.time() - 86400 * age) * 1000)
        for status in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/*/date={day}/*.json")):
            fs.setTimes(status.getPath(), then, -1)


def bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1-S6, ST3: most days, then two days in old files, then nothing new."""
    cfg, root = fresh_config(spark, "bronze-ingest")
    late = "date IN ({})".format(", ".join(f"DATE'{d}'" for d in LATE_DAYS))
    write_raw_files(spark, sf_dir, cfg.raw_events_path, f"NOT ({late})")
    start_bronze_stream(spark, cfg, trigger_once=True)
    write_raw_files(spark, sf_dir, cfg.raw_events_path, late)
    age_files(spark, cfg.raw_events_path, LATE_DAYS)
    start_bronze_stream(spark, cfg, trigger_once=True)
    start_bronze_stream(spark, cfg, trigger_once=True)
    folder = F.regexp_extract("_source_file", "(site_id=[^/]+/date=[^/]+)/[^/]+$", 1)
    return finished(spark, cfg, root, spark.read.table(cfg.bronze_fqn).select(
        *BRONZE_OUT, folder.alias("source_folder")))


def bronze_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three drops; the second adds a field and nested ones, the third changes a type.

    Drop 1 (views): device.os, items of an id and a numeric size. Drop 2 (clicks): also ``channel``, device.ver and the
    items' qty, which equals it. Drop 3 (all others): size is a text. Returned are the values that the table holds, and
    those kept in ``_rescued`` (device.ver only if the item's qty was kept too).
    """
    cfg, root = fresh_config(spark, "bronze-evolve")
    base = fixtures.base_events(spark, sf_dir).selectExpr(
        "*", "concat('{\"event_id\":\"', _id, '\",\"occurred_at\":\"', date_format(_t, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\"), "
        "'\",\"site_id\":\"s', _uid % 4, '\"') AS start")
    drops = {
        "first": ("_et = 'view'", "concat(start, ',\"device\":{\"os\":\"o', _k % 3, '\"},"
                                  "\"items\":[{\"id\":1},{\"id\":2}],\"size\":', _k, '}')"),
        "second": ("_et = 'click'", "concat(start, ',\"device\":{\"os\":\"o', _k % 3, '\",\"ver\":', _k % 5, "
                                    "'},\"items\":[{\"id\":1},{\"id\":2,\"qty\":', _k % 5, "
                                    "'}],\"size\":', _k, ',\"channel\":\"c', _k % 2, '\"}')"),
        "third": ("_et NOT IN ('view', 'click')", "concat(start, ',\"size\":\"wide\"}')"),
    }
    for name, (which, line) in drops.items():
        base.where(which).selectExpr(f"{line} AS value").write.text(f"{cfg.raw_events_path}/drop={name}")
        start_bronze_stream(spark, cfg, trigger_once=True)
    corrupt = F.get_json_object("_corrupt_record", "$.size")
    rescued = F.get_json_object(F.get_json_object("_rescued", "$.device"), "$.ver")
    qty = F.get_json_object(F.get_json_object("_rescued", "$.items"), "$[1].qty")
    return finished(spark, cfg, root, spark.read.table(cfg.bronze_fqn).select(
        F.coalesce("event_id", F.get_json_object("_corrupt_record", "$.event_id")).alias("event_id"), "drop", "size",
        "channel", F.col("device.os").alias("os"), F.when(rescued == qty, rescued).alias("rescued_ver"),
        corrupt.alias("misfit_size")))


def bronze_any_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that a strict reader stops at or loses fields of, in three drops; every value is accounted for.

    Drop 1 (views): a numeric event_id, the key k twice, a name with a quote. Drop 2 (clicks): a text event_id, channel in two
    spellings, a field named _rescued, a size of another type, a new key under the quoted name. Drop 3 (all
    others): a third spelling, and text behind the object in every third line.
    """
    cfg, root = fresh_config(spark, "bronze-any-line")
    base = fixtures.base_events(spark, sf_dir).selectExpr(
        "*", "concat(',\"occurred_at\":\"', date_format(_t, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\"), "
        "'\",\"site_id\":\"s', _uid % 4, '\"') AS start")
    drops = {
        "first": ("_et = 'view'", "concat('{\"event_id\":', _id, start, ',\"k\":', _k, ',\"k\":', _k + 1, ',\"size\":', _k, "
                                  "',\"it\\'s\":{\"x\":', _k, '}}')"),
        "second": ("_et = 'click'", "concat('{\"event_id\":\"e', _id, '\"', start, ',\"channel\":\"c', _k % 2, "
                                    "'\",\"Channel\":\"C', _k % 3, '\",\"_rescued\":\"own\",\"size\":\"wide\","
                                    "\"it\\'s\":{\"x\":1,\"y\":', _k, '}}')"),
        "third": ("_et NOT IN ('view', 'click')", "concat('{\"event_id\":\"e', _id, '\"', start, ',\"CHANNEL\":\"late\"}', "
                                                  "if(_id % 3 = 0, ' tail', ''))"),
    }
    for name, (which, line) in drops.items():
        base.where(which).selectExpr(f"{line} AS value").write.text(f"{cfg.raw_events_path}/drop={name}")
        start_bronze_stream(spark, cfg, trigger_once=True)
    kept = F.from_json("_rescued", "map<string,string>")
    value = lambda key: F.try_element_at(kept, F.lit(key))
    return finished(spark, cfg, root, spark.read.table(cfg.bronze_fqn).select(
        "event_id", "drop", "event_date", "k", F.regexp_count("_rescued", F.lit('"k":')).cast("long").alias("k_kept"), "size",
        value("size").alias("misfit_size"), "channel", value("Channel").alias("twin"), value("CHANNEL").alias("late_twin"),
        value("_rescued").alias("own_rescued"), F.col("`it's`.x").alias("quoted_x"),
        F.get_json_object(value("it's"), "$.y").alias("quoted_y"),
        F.coalesce(F.endswith("_corrupt_record", F.lit(" tail")), F.lit(False)).alias("kept_whole")))


def quarantine_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R10 as a job: rows without a site come twice; the first run reads all days, then more rows come and the second
    run reads an overlapping slice."""
    cfg, root = fresh_config(spark, "quarantine")
    rows = fixtures.bronze_like(spark, sf_dir)
    rows = rows.withColumn("event_date", F.to_date(event_time(rows)))
    twice = rows.where("site_id IS NULL AND event_site_id IS NULL")
    late = rows.withColumn("_source_file", F.concat(F.lit("late/"), "_source_file")).where("occurred_at = 'not-a-time'")
    create_table(rows.unionByName(twice), cfg.bronze_fqn)
    jobs.run_quarantine(spark, cfg)
    late.select(*spark.read.table(cfg.bronze_fqn).columns).write.insertInto(cfg.bronze_fqn)
    for _ in range(2):
        jobs.run_quarantine(spark, cfg, since_ingested_at=QUARANTINE_SINCE)
    return finished(spark, cfg, root, spark.read.table(cfg.quarantine_fqn).select(
        "event_id", "reasons", "ingest_date", F.col("_copy").cast("int").alias("copy"),
        F.col("source_file").startswith("late/").alias("late")))


def _silver_table(spark: SparkSession, sf_dir: str, tag: str) -> tuple[MartConfig, str]:
    cfg, root = fresh_config(spark, tag)
    base = fixtures.bronze_like(spark, sf_dir)
    jobs.upsert_silver_rows(spark, cfg.silver_fqn, normalize_silver_events(base, carry=("_ingested_at",)))
    return cfg, root


def _correct(spark: SparkSession, sf_dir: str, cfg: MartConfig) -> None:
    incoming = normalize_silver_events(fixtures.bronze_like(spark, sf_dir, copies_only=True), carry=("_ingested_at",))
    jobs.upsert_silver_rows(spark, cfg.silver_fqn, incoming)


def silver_merge_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 on a table: create from the base events, then upsert the corrections."""
    cfg, root = _silver_table(spark, sf_dir, "silver-merge")
    _correct(spark, sf_dir, cfg)
    return finished(spark, cfg, root, spark.read.table(cfg.silver_fqn).select(*SILVER_DATA_COLUMNS))


def silver_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST2, S3: a running stream meets sessions and payloads only in its second files; silver gets them from ``_rescued``."""
    cfg, root = fresh_config(spark, "silver-replay")
    late = "date IN ({})".format(", ".join(f"DATE'{d}'" for d in LATE_DAYS))
    write_raw_files(spark, sf_dir, cfg.raw_events_path, late, without=("sessionId", "session_id", "properties"))
    query = start_bronze_stream(spark, cfg, trigger_once=False, await_termination=False, interval="1 second")
    try:
        query.processAllAvailable()
        write_raw_files(spark, sf_dir, cfg.raw_events_path, f"NOT ({late})")
        query.processAllAvailable()
    finally:
        query.stop()
    spark.catalog.refreshTable(cfg.bronze_fqn)
    jobs.replay(spark, cfg)
    return finished(spark, cfg, root, spark.read.table(cfg.silver_fqn).select(
        "event_id", "site_id", "event_date", "session_id", "search_query", "product_id", "utm_source"))


def cli_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST5, ST6, ST8, ST9, S15: the command line over two drops, configured by environment variables, with all three parts of
    the table names; the second run takes a lookback and bronze first. Returned is the funnel table."""
    cfg, root = fresh_config(spark, "cli")
    late = "date IN ({})".format(", ".join(f"DATE'{d}'" for d in LATE_DAYS))
    wanted = {"CATALOG": "spark_catalog", "BRONZE_DB": cfg.bronze_db, "SILVER_DB": cfg.silver_db, "GOLD_DB": cfg.gold_db,
              "RAW_EVENTS_PATH": cfg.raw_events_path, "STATE_DIR": cfg.state_dir}
    wanted = {f"EVENTMART_{k}": v for k, v in wanted.items()}
    before = {k: os.environ.get(k) for k in wanted}
    os.environ.update(wanted)
    try:
        write_raw_files(spark, sf_dir, cfg.raw_events_path, f"NOT ({late})")
        jobs.main(["--bronze"])
        write_raw_files(spark, sf_dir, cfg.raw_events_path, late)
        jobs.main(["--bronze", "--since-hours", "24"])
        jobs.main(["--tasks", "gold", "--gold", "funnel_metrics", "--dates", *LATE_DAYS])
    finally:
        for k, v in before.items():
            os.environ.pop(k)
            if v is not None:
                os.environ[k] = v
    return finished(spark, cfg, root, spark.read.table(cfg.gold_fqn("funnel_metrics")).drop("_gold_updated_at"))


class _Ended(Exception):
    """Stands for a run that ends between a batch's write and the stream's commit."""


def silver_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST5, W1, J1 as a stream: bronze files upserted as they come. The first run ends after its write and before its commit,
    the second gets the same micro-batch again; then the corrections come."""
    cfg, root = fresh_config(spark, "silver-stream")

    def end(batch_id: int) -> None:
        raise _Ended(batch_id)

    rows = fixtures.bronze_like(spark, sf_dir)
    create_table(rows.withColumn("event_date", F.to_date(event_time(rows))), cfg.bronze_fqn)
    try:
        jobs.stream_silver(spark, cfg, after_batch=end)
        raise RuntimeError("the first run was to end")
    except StreamingQueryException:
        pass
    jobs.stream_silver(spark, cfg)
    rows = fixtures.bronze_like(spark, sf_dir, copies_only=True)
    rows = rows.withColumn("event_date", F.to_date(event_time(rows)))
    rows.select(*spark.read.table(cfg.bronze_fqn).columns).write.insertInto(cfg.bronze_fqn)
    jobs.stream_silver(spark, cfg)
    return finished(spark, cfg, root, spark.read.table(cfg.silver_fqn).select(*SILVER_DATA_COLUMNS))


def ingest_lag_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R11 in flight: two drops of bronze rows, the second run ending before its commit; the figures of `ingest_lag`."""
    cfg, root = fresh_config(spark, "lag-stream")

    def end(batch_id: int) -> None:
        raise _Ended(batch_id)

    rows = fixtures.bronze_like(spark, sf_dir)
    rows = rows.withColumn("event_date", F.to_date(event_time(rows)))
    second = F.col("_ingested_at") >= F.lit(QUARANTINE_SINCE).cast("timestamp")
    create_table(rows.where(~second), cfg.bronze_fqn)
    jobs.stream_lag(spark, cfg)
    rows.where(second).select(*spark.read.table(cfg.bronze_fqn).columns).write.insertInto(cfg.bronze_fqn)
    try:
        jobs.stream_lag(spark, cfg, after_batch=end)
        raise RuntimeError("the second run was to end")
    except StreamingQueryException:
        pass
    jobs.stream_lag(spark, cfg)
    return finished(spark, cfg, root, quality.lag_totals(spark.read.table(cfg.lag_fqn)).select(
        "ingest_date", "source", "rows", "bad_rows", "avg_lag_seconds", "max_lag_seconds"))


def gold_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST7: create the five gold tables, correct silver, refresh two days; all five tables, one row per measure."""
    cfg, root = _silver_table(spark, sf_dir, "gold-refresh")
    jobs.task_gold_all(spark, cfg)
    _correct(spark, sf_dir, cfg)
    jobs.task_gold_all(spark, cfg, for_event_dates=REFRESHED_DAYS)
    result = None
    for name, keys in gold.GOLD_KEYS.items():
        table = spark.read.table(cfg.gold_fqn(name)).drop("_gold_updated_at")
        key = F.col(keys[2]) if len(keys) > 2 else F.lit(None).cast("string")
        measures = [c for c in table.columns if c not in keys]
        long = table.select(F.lit(name).alias("metric_table"), "site_id", "event_date", key.alias("metric_key"),
                            *[F.col(m).cast("double").alias(m) for m in measures]).unpivot(
            ["metric_table", "site_id", "event_date", "metric_key"], measures, "measure", "value")
        result = long if result is None else result.unionByName(long)
    return finished(spark, cfg, root, result)
