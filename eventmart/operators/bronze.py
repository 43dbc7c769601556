"""Raw-layer enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.functions.timestamps import parse_timestamp_text

# SDK (camelCase) field name -> raw-layer column name.
SDK_RENAMES = {
    "eventId": "event_id",
    "eventType": "event_type",
    "occurredAt": "occurred_at",
    "receivedAt": "received_at",
    "sessionId": "session_id",
    "anonymousId": "anonymous_id",
    "siteId": "event_site_id",
    "userAgent": "user_agent",
    "deviceType": "device_type",
    "browserLanguage": "browser_language",
    "sdkVersion": "sdk_version",
}

# Columns that ingestion adds; a payload field of such a name stays in ``_rescued``.
RESCUED_COLUMN = "_rescued"
ADDED_COLUMNS = (RESCUED_COLUMN, "_ingested_at", "_source_file", "_metadata", "occurred_at_ts", "event_date")


def rename_sdk_fields(df: DataFrame) -> DataFrame:
    """camelCase SDK names -> snake_case; absent names are skipped.

    When both spellings exist (mixed producers) they are merged with the
    snake_case value first, so no ambiguous duplicate column is created.
    """
    present = set(df.columns)
    both = {src: dst for src, dst in SDK_RENAMES.items() if src in present and dst in present}
    if both:
        df = df.withColumns({dst: F.coalesce(F.col(dst), F.col(src).cast(df.schema[dst].dataType))
                             for src, dst in both.items()}).drop(*both)
    only = {src: dst for src, dst in SDK_RENAMES.items() if src in present and dst not in present}
    return df.withColumnsRenamed(only) if only else df


def with_bronze_columns(df: DataFrame, *, source_file: bool = True) -> DataFrame:
    """Add ingestion metadata and the ``event_date`` partition key.

    ``_source_file`` comes from the hidden ``_metadata`` column, which exists for
    file sources (batch and streaming); pass ``source_file=False`` otherwise.
    """
    df = rename_sdk_fields(df)
    occurred = (parse_timestamp_text(F.col("occurred_at").cast("string"))
                if "occurred_at" in df.columns else F.lit(None).cast("timestamp"))
    cols = {"_ingested_at": F.current_timestamp()}
    if source_file:
        cols["_source_file"] = F.col("_metadata.file_path")
    df = df.withColumns(cols)
    return df.withColumn("occurred_at_ts", occurred).withColumn("event_date", F.to_date("occurred_at_ts"))


#: Fields of the canonical layer that may wait in ``_rescued``, with the spellings that they are sent in.
RESTORED = {**{new: (new, old) for old, new in SDK_RENAMES.items()},
            **{n: (n,) for n in ("user_id", "url", "page_url", "pageUrl", "referrer", "properties")}}


def with_rescued_fields(df: DataFrame) -> DataFrame:
    """Bronze rows with the canonical fields that are NULL taken from ``_rescued``, as text.

    A field first seen while a stream ran, or a value that did not fit an older column type, is kept there until the
    schema knows it; this brings it back, so rows can be replayed without reading the raw files again.
    """
    if RESCUED_COLUMN not in df.columns:
        return df
    texts = F.from_json(RESCUED_COLUMN, "map<string,string>")
    rows = df.select("*", F.explode(F.array(F.struct(texts.alias("fields")))).alias("_kept"))  # one parse a row
    restored = {}
    for name, spellings in RESTORED.items():
        kept = [F.try_element_at("_kept.fields", F.lit(s)) for s in spellings]
        if name not in df.columns:
            restored[name] = kept[0] if len(kept) == 1 else F.coalesce(*kept)
        elif not isinstance(df.schema[name].dataType, (T.StructType, T.MapType, T.ArrayType)):
            restored[name] = F.coalesce(F.col(name).cast("string"), *kept)
    return rows.withColumns(restored).drop("_kept")
