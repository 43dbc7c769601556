"""Jobs over catalog tables (J1/J2 table level, ST5-ST9).

``run_silver_upsert`` replaces the reference's MERGE on event_id and
``upsert_gold`` its MERGE on composite null-safe keys; both rewrite only the
partitions (days) they touch.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventmart.config import MartConfig
from eventmart.operators import gold, quality
from eventmart.operators.bronze import with_rescued_fields
from eventmart.operators.dedup import dedup_latest
from eventmart.operators.silver import SILVER_COLUMNS, incremental_slice, normalize_silver_events
from eventmart.operators.upsert import accepted_changes, merge_replace
from eventmart.session import configure
from eventmart.sources import id_index
from eventmart.sources.tables import (as_dates, create_databases, create_table, distinct_dates, drop_partitions, materialize,
                                      overwrite_partitions, read_dates, table_exists)
from eventmart.streaming.bronze_stream import ANY_AGE, CONTINUOUS_TRIGGER, resolve_state_dir, start_bronze_stream
from eventmart.streaming.schema_store import read_text, write_text


def silver_incoming(spark: SparkSession, cfg: MartConfig, *, since_ingested_at: datetime | None = None,
                    since_received_at: datetime | str | None = None) -> DataFrame:
    bronze = spark.read.table(cfg.bronze_fqn)
    sliced = incremental_slice(bronze, since_ingested_at=since_ingested_at, since_received_at=since_received_at)
    return normalize_silver_events(with_rescued_fields(sliced), carry=("_ingested_at",))


def upsert_silver_rows(spark: SparkSession, fqn: str, incoming: DataFrame) -> dict:
    """J1 at table level (latest occurred_at_utc wins, ties keep the stored row).

    1. dedup the batch; 2. look its ids up in the fingerprint index (`sources.id_index`), which tells the days that
    may hold one; 3. classify the batch against (event_id, occurred_at_utc, event_date) of those days only;
    4. collect the touched days (new day of each accepted row plus the
    days its older copies live in; one value per day); 5. enter the accepted ids in the index, rebuild those days as
    stored rows minus replaced ids plus accepted rows and overwrite just those
    partitions, in one job; 6. drop partitions the rebuild left empty.

    The outcome names the days opened for the comparison, and the bytes of the index and of those days.
    """
    configure(spark)
    if not table_exists(spark, fqn):
        create_table(dedup_latest(incoming).select(*SILVER_COLUMNS), fqn)
        id_index.ensure_index(spark, fqn)
        return {"created": True}
    id_index.ensure_index(spark, fqn)
    # The deduplicated batch is read three times (its ids twice, then the classify join): checkpoint it once.
    batch = materialize(dedup_latest(incoming))
    opened = [d for d in id_index.days_with(spark, fqn, batch) if d is not None]
    target = read_dates(spark, fqn, opened) if opened else spark.read.table(fqn).where(F.lit(False))
    accepted = materialize(accepted_changes(target.select("event_id", "occurred_at_utc", "event_date"), batch,
                                            deduplicated=True))
    touched = distinct_dates(accepted.select(F.explode(F.array_union(
        F.array(F.col("event_date")), F.coalesce(F.col("_old_dates"), F.array().cast("array<date>"))))
        .alias("event_date")))
    read = {"opened": opened, "index_bytes": id_index.bytes_of(spark, id_index.index_name(fqn)),
            "opened_bytes": id_index.bytes_of(spark, fqn, opened)}
    if not touched:
        return {"created": False, "accepted": 0, "dates": [], **read}
    rows = accepted.select(*SILVER_COLUMNS)
    # Entered before the rows are written: an id that is entered in vain costs an opened day, a missing one a second copy.
    id_index.add_entries(spark, fqn, rows, distinct_dates(rows.select("event_date")))
    stored = read_dates(spark, fqn, touched)
    stays = stored.join(rows.select("event_id"), "event_id", "left_anti").select(*SILVER_COLUMNS)
    filled = distinct_dates(stays.select("event_date").unionByName(rows.select("event_date")))  # reads two columns
    # Dynamic overwrite swaps partitions only when the job commits, so the rows
    # that stay are read from the partitions being replaced and written once.
    overwrite_partitions(spark, stays.unionByName(rows), fqn)
    emptied = sorted(set(touched) - set(filled) - {None})
    drop_partitions(spark, fqn, emptied)
    id_index.drop_days(spark, fqn, emptied)
    spark.catalog.refreshTable(fqn)
    return {"created": False, "accepted": rows.count(), "dates": touched, "dropped": emptied, **read}


def run_silver_upsert(spark: SparkSession, cfg: MartConfig | None = None, *,
                      since_ingested_at: datetime | None = None,
                      since_received_at: datetime | str | None = None) -> dict:
    """ST5: bronze slice -> canonical rows -> silver upsert."""
    cfg = cfg or MartConfig.from_env()
    incoming = silver_incoming(spark, cfg, since_ingested_at=since_ingested_at,
                               since_received_at=since_received_at)
    return upsert_silver_rows(spark, cfg.silver_fqn, incoming)


def stream_silver(spark: SparkSession, cfg: MartConfig | None = None, *, trigger_once: bool = True,
                  await_termination: bool = True, after_batch: Callable[[int], None] | None = None) -> StreamingQuery:
    """ST5 as a stream: each new bronze file is upserted once, in micro-batches.

    The id of the last finished micro-batch is kept beside the stream's checkpoint. A batch that comes again, because the
    run ended after its write and before the stream's commit, is passed over; one that ended within its write is
    upserted again, to the same rows. ``after_batch`` is called with the id when a batch is written and recorded.
    """
    cfg = cfg or MartConfig.from_env()
    configure(spark)
    state = f"{resolve_state_dir(spark, cfg)}/silver-stream"
    bronze = spark.readStream.option("maxFileAge", ANY_AGE).table(cfg.bronze_fqn)

    def write(rows: DataFrame, batch_id: int) -> None:
        done = read_text(spark, f"{state}/done")
        if done is not None and batch_id <= int(done):
            return
        upsert_silver_rows(spark, cfg.silver_fqn, normalize_silver_events(with_rescued_fields(rows), carry=("_ingested_at",)))
        write_text(spark, f"{state}/done", str(batch_id))
        if after_batch:
            after_batch(batch_id)

    writer = bronze.writeStream.foreachBatch(write).option("checkpointLocation", f"{state}/checkpoint")
    writer = writer.trigger(availableNow=True) if trigger_once else writer.trigger(processingTime=CONTINUOUS_TRIGGER)
    query = writer.start()
    if await_termination:
        query.awaitTermination()
    return query


def stream_lag(spark: SparkSession, cfg: MartConfig | None = None, *, allowed_seconds: int = 86_400, trigger_once: bool = True,
               await_termination: bool = True, after_batch: Callable[[int], None] | None = None) -> StreamingQuery:
    """R11 in flight: lag figures of each micro-batch of bronze, kept in ``<bronze_db>.ingest_lag`` (see `quality.lag_totals`).

    The table is partitioned by micro-batch, so a batch that comes again replaces its own rows. Late rows are
    counted against the newest event of the batches before.
    """
    cfg = cfg or MartConfig.from_env()
    configure(spark)
    state = f"{resolve_state_dir(spark, cfg)}/lag-stream"
    bronze = spark.readStream.option("maxFileAge", ANY_AGE).table(cfg.bronze_fqn)

    def write(rows: DataFrame, batch_id: int) -> None:
        there = table_exists(spark, cfg.lag_fqn)
        seen = (spark.read.table(cfg.lag_fqn).where(F.col("batch_id") < batch_id).agg(F.max("newest_event")).first()[0]
                if there else None)
        parts = quality.lag_parts(rows, seen, allowed_seconds).withColumn("batch_id", F.lit(batch_id).cast("long"))
        if there:
            overwrite_partitions(spark, parts, cfg.lag_fqn, date_col="batch_id")
        else:
            create_table(parts, cfg.lag_fqn, ("batch_id",))
        spark.catalog.refreshTable(cfg.lag_fqn)
        if after_batch:
            after_batch(batch_id)

    writer = bronze.writeStream.foreachBatch(write).option("checkpointLocation", f"{state}/checkpoint")
    writer = writer.trigger(availableNow=True) if trigger_once else writer.trigger(processingTime=CONTINUOUS_TRIGGER)
    query = writer.start()
    if await_termination:
        query.awaitTermination()
    return query


def upsert_gold(spark: SparkSession, fqn: str, incoming: DataFrame, keys: Sequence[str], *,
                mode: str = "merge", days: Sequence[date] | None = None,
                date_col: str = "event_date") -> list[date]:
    """J2 at table level for the days present in ``incoming``.

    ``merge`` (default): stored rows whose key matches (NULL-safe) are
    replaced, new keys inserted, others kept - groups that vanished on
    recompute stay.  ``replace_dates``: the recomputed days are replaced whole.
    ``days`` (when the caller knows them, e.g. from the source slice) bounds the
    stored rows read; otherwise ``incoming`` is checkpointed once and its days
    collected.
    """
    configure(spark)
    if not table_exists(spark, fqn):
        create_table(incoming, fqn, (date_col,))
        return list(days) if days is not None else distinct_dates(spark.read.table(fqn), date_col)
    if days is None:
        inc = materialize(incoming)
        days = distinct_dates(inc, date_col)
    else:
        inc = incoming
    if not days:
        return []
    if mode == "merge":
        out = merge_replace(read_dates(spark, fqn, days, date_col), inc, keys)
    elif mode == "replace_dates":
        out = inc
    else:
        raise ValueError(f"unknown mode {mode!r}")
    # Dynamic overwrite stages the new files and swaps partitions only at job
    # commit, so reading the old rows of those partitions in the same job is safe.
    overwrite_partitions(spark, out, fqn, date_col=date_col)
    spark.catalog.refreshTable(fqn)
    return days


QUARANTINE_KEYS = ["ingest_date", "_row_hash", "source_file", "_copy"]


def run_quarantine(spark: SparkSession, cfg: MartConfig | None = None, *,
                   since_ingested_at: datetime | None = None,
                   since_received_at: datetime | str | None = None) -> list[date]:
    """R10 as a job: bronze rows the canonical layer rejects, with their reasons,
    merged into ``<bronze_db>.quarantine`` (partitioned by ingest day).

    Rows are keyed by a SHA-256 of the whole raw row, its file and its number
    among equal rows of the file, so overlapping slices and reruns neither
    duplicate nor drop them.
    """
    cfg = cfg or MartConfig.from_env()
    bronze = spark.read.table(cfg.bronze_fqn)
    sliced = incremental_slice(bronze, since_ingested_at=since_ingested_at, since_received_at=since_received_at)
    bad = quality.quarantine_records(sliced)
    return upsert_gold(spark, cfg.quarantine_fqn, bad, QUARANTINE_KEYS, date_col="ingest_date")


def replay(spark: SparkSession, cfg: MartConfig | None = None, *, since_ingested_at: datetime | None = None) -> dict:
    """Judge bronze again, all of it or the days from the mark on, after rules or the schema changed.

    Rows that are valid now, also by fields that wait in ``_rescued``, are upserted into silver, and the
    quarantine of these ingest days is replaced by the rows that are still rejected.
    """
    cfg = cfg or MartConfig.from_env()
    bronze = spark.read.table(cfg.bronze_fqn)
    days = distinct_dates(incremental_slice(bronze, since_ingested_at=since_ingested_at)
                          .select(F.to_date("_ingested_at").alias("ingest_date")), "ingest_date")
    whole = bronze.where(F.to_date("_ingested_at").isin(days)) if days else bronze.limit(0)
    done = upsert_silver_rows(spark, cfg.silver_fqn, normalize_silver_events(with_rescued_fields(whole), carry=("_ingested_at",)))
    bad = materialize(quality.quarantine_records(whole))
    left = upsert_gold(spark, cfg.quarantine_fqn, bad, QUARANTINE_KEYS, mode="replace_dates", date_col="ingest_date")
    drop_partitions(spark, cfg.quarantine_fqn, set(days) - set(left), "ingest_date")
    spark.catalog.refreshTable(cfg.quarantine_fqn)
    return {**done, "rejected": bad.count()}


def run_gold(spark: SparkSession, name: str, cfg: MartConfig | None = None, *,
             for_event_dates: Sequence | None = None, silver: DataFrame | None = None,
             mode: str = "merge", days: Sequence[date] | None = None) -> list[date]:
    """Recompute one gold table for the given days (all days when None/empty)."""
    cfg = cfg or MartConfig.from_env()
    src = silver if silver is not None else read_dates(spark, cfg.silver_fqn, for_event_dates)
    metrics = gold.BUILDERS[name](src)
    return upsert_gold(spark, cfg.gold_fqn(name), metrics, gold.GOLD_KEYS[name], mode=mode, days=days)


def task_gold_all(spark: SparkSession, cfg: MartConfig | None = None, *,
                  for_event_dates: Sequence | None = None, mode: str = "merge",
                  names: Sequence[str] | None = None) -> dict:
    """ST7: the five gold tables (or those in ``names``), each from its own scan of the silver days.

    Each scan reads only the columns and partitions that its metrics need; nothing is held on the executors.
    """
    cfg = cfg or MartConfig.from_env()
    # A day whose rows all fail one builder's filter is rewritten with its
    # stored rows unchanged (merge) - harmless.
    days = as_dates(for_event_dates) if for_event_dates else distinct_dates(spark.read.table(cfg.silver_fqn))
    return {name: run_gold(spark, name, cfg, for_event_dates=for_event_dates, mode=mode, days=days)
            for name in names or gold.BUILDERS}


def task_bronze(spark: SparkSession, cfg: MartConfig | None = None, *, trigger_once: bool = True):
    """ST6."""
    return start_bronze_stream(spark, cfg or MartConfig.from_env(), trigger_once=trigger_once)


def last_hours(hours: int = 24) -> datetime:
    """ST9: ingest watermark for 'the last N hours'."""
    return datetime.now(timezone.utc) - timedelta(hours=hours)


TASKS = ("bronze", "silver", "quarantine", "gold")


def main(argv: Sequence[str] | None = None) -> None:
    """ST8: silver upsert, quarantine, then all gold tables; ``--tasks`` and ``--gold`` run parts of it."""
    p = argparse.ArgumentParser(prog="eventmart")
    p.add_argument("--since-hours", type=int, default=None, help="only bronze rows ingested in the last N hours")
    p.add_argument("--since-received", default=None, help="only bronze rows received after this time (UTC unless it has an offset)")
    p.add_argument("--dates", nargs="*", default=None, help="gold days to recompute (default: the days that the upsert touched)")
    p.add_argument("--bronze", action="store_true", help="drain new raw files into bronze first")
    p.add_argument("--tasks", nargs="+", choices=TASKS, default=None, help="run only these tasks (gold alone: --dates or all days)")
    p.add_argument("--gold", nargs="+", choices=tuple(gold.BUILDERS), default=None, help="only these gold tables")
    args = p.parse_args(argv)
    tasks = set(args.tasks or TASKS[1:]) | ({"bronze"} if args.bronze else set())
    spark = SparkSession.builder.getOrCreate()
    configure(spark)
    cfg = MartConfig.from_env()
    create_databases(spark, cfg)                                  # S11, IF NOT EXISTS
    if "bronze" in tasks:
        task_bronze(spark, cfg, trigger_once=True)
    marks = {"since_ingested_at": last_hours(args.since_hours) if args.since_hours else None,
             "since_received_at": args.since_received}
    dates = args.dates
    changed = True
    if "silver" in tasks:
        done = run_silver_upsert(spark, cfg, **marks)
        dates = dates or done.get("dates")
        changed = bool(done["created"] or dates)
    if "quarantine" in tasks:
        run_quarantine(spark, cfg, **marks)
    if "gold" in tasks and changed:
        task_gold_all(spark, cfg, for_event_dates=dates, names=args.gold)


if __name__ == "__main__":
    main()
