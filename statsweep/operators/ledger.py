"""Collector run ledger analytics (SNK-02, AG-27, JN-20)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statsweep.operators.deltas import epoch_micros, running, seconds_between, with_previous

# Run duration limits (warning, high), seconds.
SLOW_RUN_S = 2.0
VERY_SLOW_RUN_S = 5.0


def run_ledger(samples: DataFrame, run_keys: Sequence[str] = ("run_id", "server_id", "query_id")) -> DataFrame:
    """SNK-02: one row per run: started, completed, status, row count, duration, note.

    ``duration_ms = max(0, completed - started)`` from the source and receive clocks.
    """
    g = samples.groupBy(*run_keys).agg(
        F.min("source_collected_at").alias("started_at"),
        F.max("collector_received_at").alias("completed_at"),
        F.max("status").alias("status"),
        F.count(F.lit(1)).alias("row_count"),
        F.max("note").alias("note"))
    ms = F.timestamp_diff("MILLISECOND", F.col("started_at"), F.col("completed_at"))
    return g.withColumn("duration_ms", F.greatest(F.lit(0), ms))


def overlapping_runs(ledger: DataFrame, keys: Sequence[str] = ("server_id", "query_id"),
                     start: str = "started_at", end: str = "completed_at", tiebreak: str = "run_id") -> DataFrame:
    """JN-20: runs that start before an earlier run of the same query and target has completed.

    The latest completion among all earlier runs is the running maximum at the run before; both are taken over
    (key, day), so a query's history is spread over tasks.
    """
    x = running(ledger, keys, [start, tiebreak], start, maxima={"_latest": F.col(end)})
    x = with_previous(x, keys, [start, tiebreak], ["_latest"], start, "_before")
    x = x.withColumn("previous_completed_at", F.col("_before._latest")).drop("_before", "_latest")
    return x.where(F.col("previous_completed_at") > F.col(start))


def collector_health(ledger: DataFrame, cadence: Mapping[str, int], keys: Sequence[str] = ("server_id", "query_id"),
                     scale: int = 6) -> DataFrame:
    """AG-27: run duration P50/P95 (exact, distributed), share of runs over 2 s and 5 s, missed ticks.

    Missed ticks between consecutive runs = ``max(0, round(gap / cadence) - 1)``.
    """
    cad = F.create_map(*[x for k, v in cadence.items() for x in (F.lit(k), F.lit(v))])
    x = with_previous(ledger, keys, ["started_at", "run_id"], ["started_at"], "started_at", "_before")
    x = x.withColumn("_cad", cad[F.col("query_id")]).withColumn("_gap", seconds_between(F.col("started_at"), F.col("_before.started_at")))
    missed = F.greatest(F.lit(0), F.round(F.col("_gap") / F.col("_cad")).cast("long") - 1)
    x = x.withColumn("_missed", missed)
    d = F.col("duration_ms") / 1000.0
    g = x.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(d > SLOW_RUN_S).alias("runs_over_2s"),
        F.count_if(d > VERY_SLOW_RUN_S).alias("runs_over_5s"),
        F.sum("_missed").alias("missed_ticks"))
    from statsweep.functions.quantiles import exact_percentiles

    pct = exact_percentiles(ledger, keys, "duration_ms", [0.5, 0.95], ["duration_ms_p50", "duration_ms_p95"])
    g = g.join(pct, list(keys), "left")
    return g.select(*keys, "runs", F.round("duration_ms_p50", scale).alias("duration_ms_p50"),
                    F.round("duration_ms_p95", scale).alias("duration_ms_p95"), "runs_over_2s", "runs_over_5s",
                    "missed_ticks",
                    F.round(F.lit(100.0) * F.col("runs_over_2s") / F.col("runs"), 2).alias("over_2s_percent"),
                    F.round(F.lit(100.0) * F.col("runs_over_5s") / F.col("runs"), 2).alias("over_5s_percent"))


def expected_samples(runs: DataFrame, cadence_s: int, keys: Sequence[str] = ("server_id",), time_col: str = "started_at",
                     out: str = "source_collected_at") -> DataFrame:
    """JN-07: the samples a collector owes: per key, the end of every tick from that of its first run to that of its last.

    Ticks are made per (key, day), so one key's years are spread over tasks; runs without a time are left out.
    """
    per_day = max(1, 86_400 // cadence_s)
    tick = F.floor(epoch_micros(time_col) / F.lit(cadence_s * 1_000_000))
    ends = runs.where(F.col(time_col).isNotNull()).groupBy(*keys).agg(F.min(tick).alias("_lo"), F.max(tick).alias("_hi"))
    days = ends.withColumn("_day", F.explode(F.sequence(F.floor(F.col("_lo") / per_day), F.floor(F.col("_hi") / per_day))))
    ticks = days.repartition(*keys, "_day").withColumn("_tick", F.explode(F.sequence(
        F.greatest("_lo", F.col("_day") * per_day), F.least("_hi", (F.col("_day") + 1) * per_day - 1))))
    seconds = ((F.col("_tick") + 1) * cadence_s).cast("decimal(18,6)")
    return ticks.select(*keys, (F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(secs=seconds)).alias(out))
