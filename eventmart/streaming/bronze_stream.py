"""Raw JSONL files -> append-only bronze table (S1, S4-S6, ST1-ST3).

Each file is read exactly once: the stream's checkpoint records processed
files, so a rerun with nothing new adds no rows.  ``availableNow`` drains what
is there in as many micro-batches as needed and stops; the continuous mode
polls on a processing-time trigger.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from eventmart.config import MartConfig
from eventmart.operators.bronze import RESCUED_COLUMN, with_bronze_columns
from eventmart.session import configure, state_root
from eventmart.sources.tables import add_missing_columns, table_exists
from eventmart.streaming import schema_store

CONTINUOUS_TRIGGER = "1 minute"
# The file source skips files older than this behind the newest one; every raw file counts, however late it comes.
ANY_AGE = "36500d"


def resolve_state_dir(spark: SparkSession, cfg: MartConfig) -> str:
    return cfg.state_dir or f"{state_root(spark).rstrip('/')}/eventmart-state"


_TEXTS = T.MapType(T.StringType(), T.StringType())


def _repeats(names: Column) -> Column:
    return F.size(names) != F.size(F.array_distinct(names))


def _unknown_key(text: Column, kind: T.DataType) -> Column | None:
    """Whether a JSON value holds, at any depth, a key that ``kind`` does not, or one twice; None if ``kind`` has no keys."""
    if isinstance(kind, T.ArrayType):
        if _unknown_key(text, kind.elementType) is None:
            return None
        elements = F.from_json(text, T.ArrayType(T.StringType()))
        return F.coalesce(F.exists(elements, lambda e: _unknown_key(e, kind.elementType)), F.lit(False))
    if not isinstance(kind, T.StructType):
        return None
    fields = F.from_json(text, _TEXTS)
    names = F.coalesce(F.map_keys(fields), F.array().cast("array<string>"))
    found = _repeats(names) | (F.size(F.array_except(names, F.array(*[F.lit(n) for n in kind.fieldNames()]))) > 0)
    for f in kind.fields:
        # By key, not by path: a name may hold quotes and dots.
        inner = _unknown_key(F.try_element_at(fields, F.lit(f.name)), f.dataType)
        found = found if inner is None else found | inner
    return found


def _not_held(fields: Column, parsed: Column, payload: T.StructType, known: list[str]) -> Column:
    """Top-level names of a JSON object that ``payload`` does not hold in full: unknown or repeated ones, those with such a
    key within, and those whose value does not fit the column."""
    none = F.array().cast("array<string>")
    names = F.coalesce(F.map_keys(fields), none)
    found = [F.array_except(names, F.array(*[F.lit(n) for n in known])),
             F.when(_repeats(names), F.filter(F.array_distinct(names), lambda n: F.size(F.filter(names, lambda m: m == n)) > 1))
             .otherwise(none)]
    for f in payload.fields:
        text = F.try_element_at(fields, F.lit(f.name))
        more = _unknown_key(text, f.dataType)
        if not isinstance(f.dataType, T.StringType):
            misfit = text.isNotNull() & parsed.getField(f.name).isNull()
            more = misfit if more is None else misfit | more
        if more is not None:
            found.append(F.when(more, F.array(F.lit(f.name))).otherwise(none))
    return F.concat(*found)


def parse_lines(lines: DataFrame, payload: T.StructType, path_columns: list[str]) -> DataFrame:
    """JSON lines (``value`` and path columns) -> payload and path columns, ``_corrupt_record`` and ``_rescued``.

    ``_rescued`` keeps, as JSON text, every field of a line that the schema does not hold, so a field first seen
    while a stream runs, a new key within a known object or array of objects, a second spelling or a repetition of a
    key (with all its values) or a value of another type is never lost. A line that is not one JSON object, or
    has a value that does not fit, stays whole in ``_corrupt_record`` besides the fields that can be read.
    """
    schema = schema_store.with_corrupt_column(payload)
    corrupt = schema_store.CORRUPT_COLUMN
    parsed = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}).alias("parsed")
    # As a list of objects: text after the first object makes it unreadable or longer than one.
    objects = F.from_json(F.concat(F.lit("["), F.col("value"), F.lit("]")), T.ArrayType(_TEXTS)).alias("objects")
    texts = all(isinstance(f.dataType, T.StringType) for f in payload.fields)
    # The generators keep the optimizer from parsing the line once for every field that is read from it.
    once = F.explode(F.array(F.struct(*([objects] if texts else [parsed, objects])))).alias("_once")
    rows = lines.where(F.trim("value") != "").select("value", *path_columns, once)
    fields = F.get("_once.objects", F.lit(0))
    unknown = _not_held(fields, F.col("_once.parsed"), payload, [*payload.fieldNames(), *path_columns])
    found = F.struct(unknown.alias("names"), fields.alias("fields"), *([parsed] if texts else []))
    if texts:
        # With as many keys as columns found, every key is a column and none is repeated: the texts found are the row, and
        # a second parse with the schema would give the same. Any other line is parsed and looked through.
        at = {n: f"_text_{i}" for i, n in enumerate(payload.fieldNames())}
        rows = rows.select("*", *[F.try_element_at(fields, F.lit(n)).alias(c) for n, c in at.items()])
        held = sum((F.col(c).isNotNull().cast("int") for c in at.values()), F.lit(0))
        found = F.when(fields.isNull() | (F.size(fields) != held), found)
    rows = rows.select("*", F.explode(F.array(F.struct(found.alias("line")))).alias("_found"))
    rows = rows.withColumn("_unknown", F.col("_found.line"))
    rescued = F.when(F.size("_unknown.names") > 0, F.to_json(
        F.map_filter("_unknown.fields", lambda k, _: F.array_contains("_unknown.names", k))))
    whole = F.when(F.coalesce(F.size("_once.objects"), F.lit(0)) != 1, F.col("value"))
    typed = F.col("_unknown.parsed" if texts else "_once.parsed")

    def value(name: str) -> Column:
        return F.when(F.col("_unknown").isNull(), F.col(at[name])).otherwise(typed[name]) if texts else typed[name]

    return rows.select(*[value(n).alias(n) for n in payload.fieldNames()],
                       F.coalesce(typed.getField(corrupt), whole).alias(corrupt),
                       *path_columns, rescued.alias(RESCUED_COLUMN))


def build_bronze_stream(spark: SparkSession, cfg: MartConfig, schema: T.StructType, *,
                        max_files_per_trigger: int | None = None, archive_dir: str | None = None) -> DataFrame:
    """Streaming read of raw JSON lines with a fixed schema; Hive-style path
    folders (``site_id=…/date=…/hour=…``) become columns and win over payload
    fields of the same name.  Unparseable lines keep their text in
    ``_corrupt_record``, fields beyond the schema in ``_rescued``.  With
    ``archive_dir``, files of finished batches move there, which bounds the folder listing."""
    in_path = [T.StructField(f.name, f.dataType) for f in schema.fields if schema_store.is_in_path(f)]
    payload = T.StructType([f for f in schema.fields if not schema_store.is_in_path(f)])
    reader = (spark.readStream.schema(T.StructType([T.StructField("value", T.StringType()), *in_path]))
              .option("maxFileAge", ANY_AGE))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return parse_lines(reader.text(cfg.raw_events_path), payload, [f.name for f in in_path])


BATCH_METRICS = "bronze_batch"


def observe_batches(stream: DataFrame) -> DataFrame:
    """R11 in flight: per micro-batch row, corrupt-line and undated-row counts.

    Read them from ``query.lastProgress["observedMetrics"]["bronze_batch"]``.
    """
    return stream.observe(
        BATCH_METRICS,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(schema_store.CORRUPT_COLUMN).isNotNull()).alias("corrupt_rows"),
        F.count_if(F.col("event_date").isNull()).alias("undated_rows"),
        F.max("occurred_at_ts").alias("max_event_time"),
    )


def start_bronze_stream(spark: SparkSession, cfg: MartConfig | None = None, *, trigger_once: bool = True,
                        await_termination: bool = True, sampling_ratio: float = 1.0,
                        max_files_per_trigger: int | None = None, archive_dir: str | None = None,
                        interval: str = CONTINUOUS_TRIGGER) -> StreamingQuery | None:
    """S6 + ST1-ST3: evolve the schema, then append to the bronze table; once, or every ``interval``.

    Returns None when there are no raw files yet.
    """
    cfg = cfg or MartConfig.from_env()
    configure(spark)
    if archive_dir and not schema_store.has_files(spark, cfg.raw_events_path):
        return None  # all files archived: the path columns could not be told from the folder
    state = resolve_state_dir(spark, cfg)
    schema = schema_store.evolve(spark, cfg.schema_store_path(state), cfg.raw_events_path,
                                 sampling_ratio=sampling_ratio)
    if schema is None:
        return None
    stream = with_bronze_columns(build_bronze_stream(spark, cfg, schema,
                                                     max_files_per_trigger=max_files_per_trigger,
                                                     archive_dir=archive_dir))
    stream = observe_batches(stream)
    if table_exists(spark, cfg.bronze_fqn):
        # New payload fields are written to the files but stay hidden until the
        # table learns them; old files read the new columns as NULL.
        add_missing_columns(spark, cfg.bronze_fqn, stream.schema)
    writer = (stream.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", cfg.checkpoint_path(state))
              .partitionBy("event_date"))
    writer = writer.trigger(availableNow=True) if trigger_once else writer.trigger(processingTime=interval)
    query = writer.toTable(cfg.bronze_fqn)
    if await_termination:
        query.awaitTermination()
        spark.catalog.refreshTable(cfg.bronze_fqn)
    return query
