"""Search analytics and recommendation feature tables.

Pair features (R5, R6) are exact: no cap on products per session or user.
Their cost is bounded by first reducing events to distinct (group, product)
memberships and by dropping products that cannot reach the minimum support
(a pair never has more support than either of its products).  The self-join
runs on (site, group, block, block): a group's products are dealt to blocks of
bounded size, so a hot group spreads over several tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.functions.metrics import safe_ratio
from eventmart.functions.text import not_blank
from eventmart.operators.gold import PURCHASE_TYPES
from eventmart.session import materialize


def searches_per_day(search_metrics: DataFrame) -> DataFrame:
    """R2: searches, zero-result searches and distinct query texts per (site, date)."""
    return search_metrics.groupBy("site_id", "event_date").agg(
        F.sum("search_count").alias("searches"),
        F.sum("zero_result_searches").alias("zero_result_searches"),
        F.count(F.lit(1)).alias("distinct_queries"),
    )


def top_queries(search_metrics: DataFrame, n: int = 10) -> DataFrame:
    """The n most frequent queries per (site, date); query text breaks ties.

    ``row_number() <= n`` lets Spark cut each group to n rows on the map side
    (WindowGroupLimit) before the exchange.
    """
    w = Window.partitionBy("site_id", "event_date").orderBy(F.col("search_count").desc(),
                                                            F.col("search_query").asc())
    return (search_metrics.select("site_id", "event_date", "search_query", "search_count")
            .withColumn("query_rank", F.row_number().over(w))
            .where(F.col("query_rank") <= n))


def query_ctr(silver: DataFrame, window_minutes: int = 30) -> DataFrame:
    """Share of searches followed by a product view.

    A view is a ``product_view``, also one that carries the query it came from; a search is any other row with a
    non-blank query. A search at time s counts as clicked when a view of the same (site, session) happens in
    [s, s + window] and before the session's next search (a later timestamp).

    Within a session ordered from late to early both are running minimums: the earliest view at or after s and the
    earliest search after s, so the cost is linear in the session's events. The rows lie in range partitions by (site,
    session, time), so a session of any size is cut into segments; each segment is scanned alone, and a session
    that goes over several partitions carries the minimums of its later segments into the earlier ones.
    """
    width = window_minutes * 60 * 1_000_000
    is_view = F.col("event_type") == "product_view"
    is_search = ~F.coalesce(is_view, F.lit(False)) & not_blank(F.col("search_query"))
    rows = _segments(silver.where(F.col("session_id").isNotNull()).where(is_search | is_view)
                     .select("site_id", "session_id", "event_date", "search_query",
                             F.unix_micros("occurred_at_utc").alias("_us"), is_search.alias("_is_search")))
    view, search = F.when(~F.col("_is_search"), F.col("_us")), F.when(F.col("_is_search"), F.col("_us"))
    late_first = Window.partitionBy("_part", "site_id", "session_id").orderBy(F.col("_us").desc())
    rows = (rows.withColumn("_view", F.min(view).over(late_first.rangeBetween(Window.unboundedPreceding, Window.currentRow)))
            .withColumn("_search", F.min(search).over(late_first.rangeBetween(Window.unboundedPreceding, -1)))
            .join(F.broadcast(_carried(rows, view, search)),
                  F.col("site_id").eqNullSafe(F.col("_site")) & (F.col("session_id") == F.col("_session"))
                  & (F.col("_part") == F.col("_at")), "left"))
    next_view, next_search = F.least("_view", "_later_view"), F.least("_search", "_later_search")
    clicked = F.coalesce((next_view <= F.col("_us") + width)
                         & (next_search.isNull() | (next_view < next_search)), F.lit(False))
    return (rows.withColumn("_clicked", clicked).where("_is_search")
            .groupBy("site_id", "event_date", "search_query")
            .agg(F.count(F.lit(1)).alias("searches"),
                 F.count_if("_clicked").alias("clicked_searches"))
            .withColumn("ctr", safe_ratio(F.col("clicked_searches"), F.col("searches"))))


def _segments(rows: DataFrame) -> DataFrame:
    """Rows in range partitions by (site, session, time from late to early) with the partition's number as ``_part``.

    Checkpointed, as the numbers must be the same in every branch. Equal times of a session lie in one partition.
    """
    laid = rows.repartitionByRange("site_id", "session_id", F.col("_us").desc())
    return materialize(laid.withColumn("_part", F.spark_partition_id()))


def _carried(rows: DataFrame, view: Column, search: Column) -> DataFrame:
    """For each later partition of a session that goes over several: the earliest view and search of those before it.

    At most one row for each partition, as only one session can go on from the partition before; so it can be broadcast.
    """
    keys = ["site_id", "session_id"]
    wide = (rows.groupBy(*keys).agg(F.min("_part").alias("_first"), F.max("_part").alias("_last"))
            .where("_first < _last").select(F.col("site_id").alias("_site"), F.col("session_id").alias("_session")))
    parts = (rows.join(F.broadcast(wide), F.col("site_id").eqNullSafe(F.col("_site")) & (F.col("session_id") == F.col("_session")))
             .groupBy("_site", "_session", F.col("_part").alias("_at"))
             .agg(F.min(view).alias("_v"), F.min(search).alias("_s")))
    before = Window.partitionBy("_site", "_session").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    return (parts.select("_site", "_session", "_at", F.min("_v").over(before).alias("_later_view"),
                         F.min("_s").over(before).alias("_later_search"))
            .where("_later_view IS NOT NULL OR _later_search IS NOT NULL"))


#: Products (or queries) of one group that meet in one block.
PAIR_BLOCK = 512


def _blocked(df: DataFrame, keys: list[str], item: str, own: str) -> DataFrame:
    """Add ``own``: the block of ``item`` among the ceil(n / PAIR_BLOCK) blocks of its group, and their number."""
    sizes = df.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / PAIR_BLOCK).cast("int").alias(f"{own}_n"))
    return df.join(sizes, keys).withColumn(own, F.pmod(F.xxhash64(item), F.col(f"{own}_n")).cast("int"))


def _memberships(silver: DataFrame, group_col: str, event_types: tuple[str, ...]) -> DataFrame:
    """Distinct (site, group, product), checkpointed once.

    Every later branch (support, both join sides, viewer counts) reads this
    small relation instead of scanning silver again; the reliable checkpoint
    in the shared folder also keeps a lost executor during the self-join from
    sending the job back to the silver scan.
    """
    members = (silver.where(F.col(group_col).isNotNull() & F.col("product_id").isNotNull()
                            & F.col("event_type").isin(*event_types))
               .select("site_id", group_col, "product_id").distinct())
    return materialize(members)


def _pairs(members: DataFrame, group_col: str, min_support: int) -> tuple[DataFrame, DataFrame]:
    """(pair counts, per-product counts) for products sharing a group."""
    support = members.groupBy("site_id", "product_id").agg(F.count(F.lit(1)).alias("_support"))
    frequent = support.where(F.col("_support") >= min_support)
    kept = members.join(frequent.select("site_id", "product_id"), ["site_id", "product_id"], "left_semi")
    # Each pair of blocks is one join key, so a task meets at most PAIR_BLOCK ** 2 pairs of a group.
    dealt = _blocked(kept, ["site_id", group_col], "product_id", "block")
    others = F.explode(F.sequence(F.lit(0), F.col("block_n") - 1))
    a = dealt.select("site_id", group_col, F.col("product_id").alias("product_a"), F.col("block").alias("block_a"),
                     others.alias("block_b"))
    b = dealt.select("site_id", group_col, F.col("product_id").alias("product_b"), F.col("block").alias("block_b"),
                     others.alias("block_a"))
    pairs = (a.join(b, ["site_id", group_col, "block_a", "block_b"])
             .where(F.col("product_a") < F.col("product_b"))
             .groupBy("site_id", "product_a", "product_b")
             .agg(F.count(F.lit(1)).alias("_together"))
             .where(F.col("_together") >= min_support))
    return pairs, support


def viewed_together(silver: DataFrame, min_support: int = 2) -> DataFrame:
    """Unordered product pairs viewed in the same session, with session counts."""
    members = _memberships(silver, "session_id", ("product_view",))
    pairs, _ = _pairs(members, "session_id", min_support)
    return pairs.withColumnRenamed("_together", "sessions")


def co_viewed(silver: DataFrame, min_support: int = 2) -> DataFrame:
    """Product pairs viewed by the same user, with Jaccard similarity and lift."""
    members = _memberships(silver, "user_id", ("product_view",))
    pairs, support = _pairs(members, "user_id", min_support)
    viewers = members.groupBy("site_id").agg(F.count_distinct("user_id").alias("_viewers"))
    sa = support.select("site_id", F.col("product_id").alias("product_a"), F.col("_support").alias("users_a"))
    sb = support.select("site_id", F.col("product_id").alias("product_b"), F.col("_support").alias("users_b"))
    out = (pairs.join(sa, ["site_id", "product_a"]).join(sb, ["site_id", "product_b"])
           .join(viewers, "site_id")
           .withColumnRenamed("_together", "users_ab"))
    union = F.col("users_a") + F.col("users_b") - F.col("users_ab")
    lift = ((F.col("users_ab") * F.col("_viewers")).cast("double")
            / (F.col("users_a") * F.col("users_b")).cast("double"))
    return out.select("site_id", "product_a", "product_b", "users_ab", "users_a", "users_b",
                      safe_ratio(F.col("users_ab"), union).alias("jaccard"), lift.alias("lift"))


def searched_then_purchased(silver: DataFrame) -> DataFrame:
    """(query, product) pairs where a purchase follows the search in one session.

    Searches collapse to their first time per (session, query) and purchases to
    their last time per (session, product) before the join: "some search before
    some purchase" holds exactly when first search < last purchase.
    """
    s = silver.where(F.col("session_id").isNotNull())
    first_search = (s.where(not_blank(F.col("search_query")))
                    .groupBy("site_id", "session_id", "search_query")
                    .agg(F.min("occurred_at_utc").alias("_first_search")))
    last_buy = (s.where(F.col("event_type").isin(*PURCHASE_TYPES) & F.col("product_id").isNotNull())
                .groupBy("site_id", "session_id", "product_id")
                .agg(F.max("occurred_at_utc").alias("_last_buy")))
    keys = ["site_id", "session_id"]
    asked = _blocked(first_search, keys, "search_query", "block_q")
    bought = _blocked(last_buy, keys, "product_id", "block_p")
    # Both sides are copied to the other's blocks, whose number the other side's sizes tell.
    of_p = bought.select(*keys, "block_p_n").distinct()
    of_q = asked.select(*keys, "block_q_n").distinct()
    asked = asked.join(of_p, keys).withColumn("block_p", F.explode(F.sequence(F.lit(0), F.col("block_p_n") - 1)))
    bought = bought.join(of_q, keys).withColumn("block_q", F.explode(F.sequence(F.lit(0), F.col("block_q_n") - 1)))
    return (asked.drop("block_p_n", "block_q_n").join(bought.drop("block_p_n", "block_q_n"), [*keys, "block_p", "block_q"])
            .where(F.col("_first_search") < F.col("_last_buy"))
            .groupBy("site_id", "search_query", "product_id")
            .agg(F.count(F.lit(1)).alias("sessions")))


def normalized_query(col: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(col, r"\s+", " ")))


def autocomplete(silver: DataFrame, n: int = 5, min_len: int = 2, max_len: int | None = 10) -> DataFrame:
    """For every prefix (min_len..max_len chars) of normalised queries, the n most searched.

    ``max_len=None`` gives suggestions after any number of typed characters, whole queries included; the table then has
    a row for each prefix of each query at least.
    """
    q = normalized_query(F.col("search_query"))
    freq = (silver.where(not_blank(F.col("search_query")))
            .groupBy("site_id", q.alias("query"))
            .agg(F.count(F.lit(1)).alias("frequency"))
            .where(F.length("query") >= min_len))
    longest = F.length("query") if max_len is None else F.least(F.length("query"), F.lit(max_len))
    lengths = F.sequence(F.lit(min_len), longest)
    prefixes = freq.withColumn("prefix", F.explode(F.transform(lengths, lambda i: F.substring("query", 1, i))))
    w = Window.partitionBy("site_id", "prefix").orderBy(F.col("frequency").desc(), F.col("query").asc())
    return (prefixes.withColumn("suggestion_rank", F.row_number().over(w))
            .where(F.col("suggestion_rank") <= n)
            .select("site_id", "prefix", "query", "frequency", "suggestion_rank"))
