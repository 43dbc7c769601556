"""Operator 9: contiguous shards of near equal byte size by global prefix sums, with DataFrame functions only.

Documents are sorted by doc_id over range partitions; per-partition totals give every document the bytes before
it, and the cuts lie at equal targets of the total. A document goes where its middle byte falls, so a shard is
off its target by at most the two documents at its cuts.

Edge cases: a null text has 0 bytes and the crc of no bytes; null doc_ids come first; equal doc_ids are ordered
by size and crc; an empty table gives no rows; one document larger than a shard's target leaves later shards
empty; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import place, prefix_sums

#: Bytes that each row needs besides its text.
ROW_BYTES = 16


def byte_shards(docs: DataFrame, shards: int = 40, row_bytes: int = ROW_BYTES) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (place within the shard) of ``docs`` (doc_id, text)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = docs.select("doc_id", (F.octet_length(text) + row_bytes).cast("long").alias("size"),
                        F.crc32(text.cast("binary")).alias("text_crc32"))
    placed, _ = place(sized, "doc_id", "size", "text_crc32", tag="shard-sizes")
    rows = prefix_sums(placed.withColumn("one", F.lit(1).cast("long")), "size", "one")
    rows = rows.withColumn("shard", F.expr(f"cast((2 * before_size + size) * {shards} div (2 * total_size) as int)"))
    first = rows.groupBy("shard").agg(F.min("before_one").alias("first"))  # at most one row for each shard
    return rows.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("before_one") - F.col("first")).alias("slot"))
