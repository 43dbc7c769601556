"""Operator 3: chat formatting after collapsing cumulative snapshots, with DataFrame functions only.

Logged conversations are often cumulative: a later log repeats an earlier one and goes on. Every turn gets two
64-bit hashes of (place, role, text); their running sums over a conversation (decimals, so that no sum overflows) are
the rolling hash of each turn prefix. A conversation whose whole hash equals a shorter prefix of another goes (anti
join), and of equal conversations the one with the smallest conv_id stays. What stays is rendered turn by turn.

No conversation is gathered in one task: turns are placed by one global sort and all running sums come from
`prefix_sums`. Concatenating ``rendered`` by ``start`` gives a conversation's text.

Edge cases: repeated identical rows count once; turns are ordered by (turn, role, text), nulls first; a null role
renders as ``unknown`` and a null text as an empty one, but both differ from the spelled-out values when
conversations are compared; rows without conv_id form one conversation of id null; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import place, prefix_sums, written

OPEN, MIDDLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"
_HASHES = ("h1", "h2")


def _hash(*columns) -> Column:
    return F.xxhash64(*columns)


def _contents(seed: int) -> Column:
    return _hash(F.lit(seed), F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text"))


def placed_turns(conversations: DataFrame) -> DataFrame:
    """Every distinct turn, rendered, with two hashes of its contents and its place in the global order ``_at``."""
    rendered = F.concat(F.lit(OPEN), F.coalesce("role", F.lit("unknown")), F.lit(MIDDLE),
                        F.coalesce("text", F.lit("")), F.lit(CLOSE))
    turns = conversations.select("conv_id", "turn", "role", "text").distinct()
    placed, _ = place(turns, "conv_id", "turn", "role", "text", tag="chat-turns")
    return placed.select("_at", "conv_id", "role", _contents(11).alias("c1"), _contents(97).alias("c2"),
                         rendered.alias("rendered"), F.length(rendered).cast("long").alias("chars"))


def turn_prefixes(placed: DataFrame) -> DataFrame:
    """_at, conv_id, place, n_turns, start (characters before the turn) and the prefix hash up to each turn.

    Only numbers are shuffled; the texts stay where they were placed.
    """
    turns = placed.select("_at", "conv_id", "c1", "c2", "chars", F.lit(1).cast("long").alias("one"))
    rows = prefix_sums(turns, "one").withColumnRenamed("before_one", "row").drop("total_one")
    rows, _ = written(rows, "chat-rows")
    spans = rows.groupBy(F.col("conv_id").alias("c")).agg(F.min("row").alias("first"), F.count("*").alias("n_turns"))
    numbered = rows.join(spans, rows["conv_id"].eqNullSafe(spans["c"])).withColumn("place", F.col("row") - F.col("first"))
    numbered, _ = written(numbered.select(
        "_at", "conv_id", "place", "n_turns", "chars",
        *[_hash(F.col("place"), F.col(c)).cast("decimal(20,0)").alias(h)
          for c, h in zip(("c1", "c2"), _HASHES, strict=True)]), "chat-places")
    sums, _ = written(prefix_sums(numbered, *_HASHES, "chars"), "chat-sums")
    keep = [*[f"before_{h}" for h in _HASHES], "before_chars"]
    base = sums.where("place = 0").select(F.col("conv_id").alias("c"), *[F.col(k).alias(f"_{k}") for k in keep])
    return sums.join(base, sums["conv_id"].eqNullSafe(base["c"])).select(
        "_at", "conv_id", "place", "n_turns", (F.col("before_chars") - F.col("_before_chars")).alias("start"),
        *[(F.col(f"before_{h}") - F.col(f"_before_{h}") + F.col(h)).alias(h) for h in _HASHES])


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """conv_id of every conversation that no other one continues; of equal ones the smallest id."""
    key = ["size", *_HASHES]
    keyed = turns.withColumn("size", F.col("place") + 1)
    whole = keyed.where("size = n_turns").groupBy(*key).agg(F.min("conv_id").alias("conv_id"))
    longer = keyed.where("size < n_turns").select(*key).distinct()
    return whole.join(longer, key, "left_anti").select("conv_id")


def chat_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place, n_turns, role, rendered and start (characters of the conversation before the turn)."""
    placed = placed_turns(conversations)
    turns, _ = written(turn_prefixes(placed), "chat-prefixes")
    kept = maximal_conversations(turns).withColumnRenamed("conv_id", "c")
    stays = turns.join(kept, turns["conv_id"].eqNullSafe(kept["c"]), "left_semi").select("_at", "place", "n_turns", "start")
    return placed.join(stays, "_at").select("conv_id", "place", "n_turns", "role", "start", "rendered")
