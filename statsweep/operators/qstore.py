"""Query-store family: window-aligned wait attribution and plan inventory.

AG-09, JN-04, WN-03, PRJ-11, PRJ-16, AG-28, JN-12 (waits); AG-10, JN-10, AG-26 (plans).
Inputs carry ``start_time, end_time`` window bounds; keys always start with ``server_id``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statsweep.functions.scalars import PLAN_FLAGS, classify_wait, plan_features
from statsweep.operators.activity import topk

WINDOW = ("server_id", "start_time", "end_time")
RUNTIME_KEYS = (*WINDOW, "user_id", "db_id", "query_id")

# Text limits of the reference (query text 6,000, plan text 10,000 characters).
QUERY_TEXT_LIMIT = 6000
PLAN_TEXT_LIMIT = 10000
TOP_PLANS = 200


def runtime_by_window(runtime: DataFrame) -> DataFrame:
    """AG-09: per window and query: sums, maxima, any-system flag and call-weighted mean time."""
    g = runtime.groupBy(*RUNTIME_KEYS).agg(
        F.max("query_sql_text").alias("query_sql_text"),
        F.bool_or("is_system_query").alias("is_system_query"),
        F.sum("calls").alias("runtime_calls"),
        F.sum("total_time").alias("total_exec_time_ms"),
        F.max("max_time").alias("max_exec_time_ms"),
        F.sum("shared_blks_hit").alias("shared_blks_hit"),
        F.sum("shared_blks_read").alias("shared_blks_read"),
        F.sum("blk_read_time").alias("blk_read_time_ms"),
        F.sum("blk_write_time").alias("blk_write_time_ms"),
    )
    return g.withColumn("mean_exec_time_ms",
                        F.when(F.col("runtime_calls") > 0, F.col("total_exec_time_ms") / F.col("runtime_calls")))


def attach_runtime(waits: DataFrame, runtime_agg: DataFrame) -> DataFrame:
    """JN-04: waits left join window runtime on start, end, user, database and query (plus server)."""
    return waits.join(runtime_agg, list(RUNTIME_KEYS), "left")


def share_over(df: DataFrame, value: str, partition: Sequence[str], out: str) -> DataFrame:
    """WN-03: the total of ``value`` over ``partition`` attached to each row.

    A grouped sum joined back (rather than a window) so a very large partition is
    pre-aggregated map-side and, under AQE skew-join, split across tasks.
    """
    tot = df.groupBy(*partition).agg(F.sum(value).alias(out))
    return df.join(tot, list(partition), "left")


def window_waits(waits: DataFrame, runtime: DataFrame, period_ms: float) -> DataFrame:
    """Window wait attribution: JN-04 + WN-03 + PRJ-11 + PRJ-16 over one read of both sources."""
    w = waits.select(*RUNTIME_KEYS, "event_type", "event", F.col("calls").alias("wait_sample_count"),
                     (F.col("calls") * F.lit(period_ms)).alias("estimated_sampled_wait_ms"))
    j = attach_runtime(w, runtime_by_window(runtime))
    # The join leaves the rows hash-partitioned by the query-window keys, so this total is a
    # window with no exchange (its group is one query's wait events in one window, bounded).
    j = j.withColumn("query_window_wait_samples",
                     F.sum("wait_sample_count").over(Window.partitionBy(*RUNTIME_KEYS)))
    # A whole window of a server can be large: grouped total joined back (skew-splittable).
    j = share_over(j, "wait_sample_count", WINDOW, "all_window_wait_samples")
    n = F.col("wait_sample_count")
    calls = F.col("runtime_calls")
    return j.select(
        *RUNTIME_KEYS, "event_type", "event",
        classify_wait("event_type", "event").alias("wait_classification"),
        "wait_sample_count", "estimated_sampled_wait_ms",
        F.round(F.when(F.col("all_window_wait_samples") != 0,
                       F.lit(100.0) * n / F.col("all_window_wait_samples")), 2)
        .alias("event_share_of_all_window_wait_percent"),
        F.round(F.when(F.col("query_window_wait_samples") != 0,
                       F.lit(100.0) * n / F.col("query_window_wait_samples")), 2)
        .alias("event_share_within_query_percent"),
        F.when(calls > 0, F.round(n / calls, 4)).alias("wait_samples_per_runtime_call"),
        F.when(calls > 0, F.round(F.col("estimated_sampled_wait_ms") / calls, 2))
        .alias("estimated_wait_ms_per_runtime_call"),
        "runtime_calls", "total_exec_time_ms", "mean_exec_time_ms", "max_exec_time_ms",
        "shared_blks_hit", "shared_blks_read", "blk_read_time_ms", "blk_write_time_ms", "is_system_query",
        F.left(F.col("query_sql_text"), F.lit(QUERY_TEXT_LIMIT)).alias("query_sql_text"),
    )


def unmatched_share(joined: DataFrame) -> DataFrame:
    """AG-28: share of wait samples per window without a runtime match."""
    n = F.col("wait_sample_count")
    return joined.groupBy(*WINDOW).agg(
        F.sum(n).alias("wait_samples"),
        F.sum(F.when(F.col("runtime_calls").isNull(), n).otherwise(0)).alias("unmatched_wait_samples"),
    ).withColumn("unmatched_percent", F.round(
        F.when(F.col("wait_samples") != 0, F.lit(100.0) * F.col("unmatched_wait_samples") / F.col("wait_samples")),
        2))


def unmapped_waits(waits: DataFrame, dictionary: DataFrame, samples: str = "calls",
                   keys: Sequence[str] = ("server_id",)) -> DataFrame:
    """JN-12: wait (type, event) pairs missing from the wait dictionary and their share of samples."""
    k = list(keys)
    pairs = waits.groupBy(*k, "event_type", "event").agg(F.sum(samples).alias("wait_samples"))
    dict_pairs = dictionary.select(F.col("wait_event_type").alias("event_type"),
                                   F.col("wait_event").alias("event")).distinct()
    missing = pairs.join(dict_pairs, ["event_type", "event"], "left_anti")
    total = waits.groupBy(*k).agg(F.sum(samples).alias("all_wait_samples"))
    return missing.join(total, k, "inner").withColumn(
        "share_percent", F.round(F.lit(100.0) * F.col("wait_samples") / F.col("all_wait_samples"), 2))


def runtime_by_plan(runtime: DataFrame, start, end, keys: Sequence[str] = ("server_id",)) -> DataFrame:
    """AG-10: sums per plan over windows overlapping ``[start, end)``, system queries excluded."""
    r = runtime.where((F.col("end_time") > F.lit(start)) & (F.col("start_time") < F.lit(end))
                      & ~F.col("is_system_query"))
    g = r.groupBy(*keys, "db_id", "query_id", "plan_id").agg(
        F.min("start_time").alias("first_window_start"),
        F.max("end_time").alias("last_window_end"),
        F.sum("calls").alias("query_store_calls"),
        F.sum("total_time").alias("total_exec_time_ms"),
        F.max("max_time").alias("max_time_ms"),
        F.max("query_sql_text").alias("query_sql_text"))
    return g.withColumn("mean_time_ms", F.when(F.col("query_store_calls") > 0,
                                               F.col("total_exec_time_ms") / F.col("query_store_calls")))


def plan_inventory(runtime_plans: DataFrame, plans: DataFrame, k: int | None = TOP_PLANS,
                   keys: Sequence[str] = ("server_id",)) -> DataFrame:
    """JN-10: plan runtime inner join plan text, parallel plans only, top ``k`` by total time then calls.

    ``has_gather`` also holds for Gather Merge plans, so the filter needs no separate
    Gather Merge term. ``k`` ranks within each of ``keys`` (one inventory per server).
    """
    p = plan_features(plans, "plan_text")
    j = runtime_plans.join(p.drop("server_id") if "server_id" not in keys else p,
                           [*keys, "db_id", "query_id", "plan_id"], "inner")
    parallel = F.lit(False)
    for name, _ in PLAN_FLAGS:
        if name != "has_gather_merge":
            parallel = parallel | F.col(name)
    j = j.where(parallel).withColumn("plan_text", F.left(F.col("plan_text"), F.lit(PLAN_TEXT_LIMIT))) \
         .withColumn("query_sql_text", F.left(F.col("query_sql_text"), F.lit(QUERY_TEXT_LIMIT)))
    order: list[Column] = [F.col("total_exec_time_ms").desc(), F.col("query_store_calls").desc(),
                           F.col("db_id"), F.col("query_id"), F.col("plan_id")]
    return topk(j, keys, order, k)


def plan_variability(inventory: DataFrame, keys: Sequence[str] = ("server_id",)) -> DataFrame:
    """AG-26: queries with several plans; ratio of the slowest to the fastest plan mean."""
    g = inventory.groupBy(*keys, "db_id", "query_id").agg(
        F.count_distinct("plan_id").alias("plan_count"),
        F.max("mean_time_ms").alias("slowest_mean_ms"),
        F.min("mean_time_ms").alias("fastest_mean_ms"))
    return g.where(F.col("plan_count") > 1).withColumn(
        "slowest_to_fastest_ratio",
        F.when(F.col("fastest_mean_ms") > 0, F.col("slowest_mean_ms") / F.col("fastest_mean_ms")))
