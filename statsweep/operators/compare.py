"""Cross-source and before/after metrics (AG-22 to AG-25; uses JN-15 and JN-17).

All inputs are already-reduced datasets (per-sample summaries, per-day load
results), so each operator is one or two grouped aggregations and equi joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statsweep.functions.scalars import safe_percent

# Interpretation bands of the parallelism benefit test (percent).
RPS_GAIN_PCT = 5.0
P99_GAIN_PCT = 10.0
SATURATED_PCT = 95.0
HEADROOM_POINTS = 5.0  # own choice: "not materially worse" names no number
# Pooler outcome bands.
MIN_CONNECTION_REDUCTION_PCT = 50.0
MIN_QUEUE_FREE_PCT = 99.0
MAX_POOL_WAIT_P99_S = 1.0
MAX_LATENCY_REGRESSION_PCT = 10.0


def writer_share(io_delta: DataFrame, keys: Sequence[str], writes: str = "writes_delta") -> DataFrame:
    """AG-22: client-backend share of all backend writes per interval group."""
    w = F.col(writes)
    g = io_delta.groupBy(*keys).agg(
        F.sum(F.when(F.col("backend_type") == "client backend", w).otherwise(0)).alias("client_backend_writes"),
        F.sum(w).alias("all_backend_writes"))
    return g.withColumn("client_backend_write_share",
                        F.when(F.col("all_backend_writes") > 0,
                               F.col("client_backend_writes") / F.col("all_backend_writes")))


def running_demand(activity: DataFrame, vcores: str = "provisioned_vcores") -> DataFrame:
    """AG-24 input: running demand per vCore per sample (activity summary with capacity attached)."""
    return activity.withColumn("running_demand_per_vcore",
                               F.when(F.col(vcores) > 0, F.col("active_cpu_or_running_sessions") / F.col(vcores)))


def phase_summary(demand: DataFrame, keys: Sequence[str], scale: int = 6) -> DataFrame:
    """AG-24: per phase: mean and peak demand per vCore, mean worker-pool utilisation, samples."""
    return demand.groupBy(*keys).agg(
        F.round(F.avg("running_demand_per_vcore"), scale).alias("avg_running_demand_per_vcore"),
        F.max("running_demand_per_vcore").alias("max_running_demand_per_vcore"),
        F.round(F.avg("parallel_worker_pool_utilization_percent"), scale).alias("avg_worker_pool_utilization_percent"),
        F.count(F.lit(1)).alias("samples"))


def parallelism_benefit(compared: DataFrame, rps: str = "successful_rps", p99: str = "p99_ms",
                        errors: str = "error_rate", workers: str | None = None, cpu: str | None = None) -> DataFrame:
    """AG-25: positive / neutral / negative label from throughput, P99 and error-rate changes.

    ``compared`` is JN-17 output (``baseline_*``, ``after_*``, ``*_change_percent``). With ``workers`` (peak use of the
    worker pool in percent) a pool that saturates only afterwards is negative; with ``cpu`` (mean CPU in percent) a
    result is positive only if the headroom shrinks by no more than ``HEADROOM_POINTS``. Unknown values decide nothing.
    """
    rps_chg, p99_chg = F.col(f"{rps}_change_percent"), F.col(f"{p99}_change_percent")
    err_up = F.col(f"after_{errors}") > F.col(f"baseline_{errors}")
    negative = (p99_chg >= P99_GAIN_PCT) | (rps_chg <= -RPS_GAIN_PCT) | err_up
    positive = ((rps_chg >= RPS_GAIN_PCT) | (p99_chg <= -P99_GAIN_PCT)) & ~err_up
    if workers is not None:
        full = lambda side: F.coalesce(F.col(f"{side}_{workers}") >= SATURATED_PCT, F.lit(False))
        negative |= full("after") & ~full("baseline")
    if cpu is not None:
        positive &= F.coalesce(F.col(f"after_{cpu}") - F.col(f"baseline_{cpu}") <= HEADROOM_POINTS, F.lit(True))
    return compared.withColumn("parallelism_benefit", F.when(negative, "negative").when(positive, "positive")
                               .otherwise("neutral"))


def pool_effectiveness(activity: DataFrame, pools: DataFrame, load: DataFrame, split_at, keys: Sequence[str] = (
        "server_id",), scale: int = 6) -> DataFrame:
    """AG-23: pooler before/after effectiveness per server.

    ``activity`` (AG-01 rows) and ``pools`` (PRJ-18 rows) are split at ``split_at``:
    earlier samples are the direct baseline, later ones the pooled run. ``load`` has
    per-request latency ``latency_ms`` and ``test_run_id`` in ('baseline', 'after'). All
    percentiles are distributed exact ones: no server's samples are held in one buffer.
    """
    from statsweep.functions.quantiles import exact_percentiles

    k = list(keys)
    before = F.col("source_collected_at") < F.lit(split_at)
    per_sample = pools.where(~before).groupBy(*k, "source_collected_at").agg(
        F.sum("pgbouncer_client_connections").alias("cl"), F.sum("pgbouncer_server_connections").alias("sv"))

    def measured(df: DataFrame, **columns: Column) -> DataFrame:
        return df.select(*k, F.explode(F.array(*[F.struct(F.lit(name).alias("measure"), c.cast("double").alias("value")) for name, c in columns.items()])).alias("m")
                         ).select(*k, "m.measure", "m.value")

    values = (measured(activity, before=F.when(before, F.col("client_connections")), after=F.when(~before, F.col("client_connections")))
              .unionByName(measured(per_sample, cl=F.col("cl"), sv=F.col("sv")))
              .unionByName(measured(pools.where(~before), wait=F.col("oldest_client_wait_seconds"))))
    p = exact_percentiles(values, [*k, "measure"], "value", [0.95, 0.99])
    pick = lambda name, col: F.max(F.when(F.col("measure") == name, F.col(col)))
    p = p.groupBy(*k).agg(pick("before", "p95").alias("baseline_p95"), pick("after", "p95").alias("after_p95"), pick("cl", "p95").alias("pgb_client_p95"),
                          pick("sv", "p95").alias("pgb_server_p95"), pick("wait", "p99").alias("pool_wait_p99_seconds"))
    conn = activity.select(*k).distinct()
    q = pools.where(~before).groupBy(*k).agg(
        (F.lit(100.0) * F.count_if(F.col("cl_waiting") == 0) / F.count(F.lit(1))).alias("queue_free_sample_percent"))
    # the two runs side by side
    p99 = exact_percentiles(load, ["test_run_id"], "latency_ms", [0.99], ["p99"])
    lat = p99.agg(F.max(F.when(F.col("test_run_id") == "baseline", F.col("p99"))).alias("baseline_latency_p99"),
                  F.max(F.when(F.col("test_run_id") == "after", F.col("p99"))).alias("after_latency_p99"))
    j = (conn.join(p, k, "left").join(q, k, "left").withColumn("_one", F.lit(1))
         .join(F.broadcast(lat.withColumn("_one", F.lit(1))), "_one", "left").drop("_one"))
    red = F.when(F.col("baseline_p95") != 0,
                 F.lit(100.0) * (F.col("baseline_p95") - F.col("after_p95")) / F.col("baseline_p95"))
    reg = F.when(F.col("baseline_latency_p99") != 0,
                 F.lit(100.0) * (F.col("after_latency_p99") - F.col("baseline_latency_p99")) / F.col("baseline_latency_p99"))
    j = j.select(*k, red.alias("reduction"), reg.alias("regression"),
                 F.when(F.col("pgb_server_p95") != 0, F.col("pgb_client_p95") / F.col("pgb_server_p95"))
                 .alias("mux"), "queue_free_sample_percent", "pool_wait_p99_seconds")
    eff = F.col("reduction") - F.greatest(F.lit(0.0), F.col("regression"))
    positive = ((F.col("reduction") >= MIN_CONNECTION_REDUCTION_PCT)
                & (F.col("queue_free_sample_percent") >= MIN_QUEUE_FREE_PCT)
                & (F.col("pool_wait_p99_seconds") <= MAX_POOL_WAIT_P99_S)
                & (F.col("regression") <= MAX_LATENCY_REGRESSION_PCT))
    negative = ((F.col("queue_free_sample_percent") < MIN_QUEUE_FREE_PCT)
                | (F.col("regression") > MAX_LATENCY_REGRESSION_PCT))
    return j.select(
        *k,
        F.round("reduction", scale).alias("postgres_backend_connection_reduction_percent"),
        F.round("mux", scale).alias("pgbouncer_multiplexing_ratio"),
        F.round("queue_free_sample_percent", scale).alias("queue_free_sample_percent"),
        F.round("pool_wait_p99_seconds", scale).alias("pool_wait_p99_seconds"),
        F.round("regression", scale).alias("pgbouncer_latency_regression_percent"),
        F.round(eff, scale).alias("connection_shielding_efficiency"),
        F.when(positive, "positive").when(negative, "negative").otherwise("neutral").alias("outcome"))


def efficiency(load_per_phase: DataFrame, cpu_per_phase: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AG-24 efficiency: successful requests per second per CPU percent."""
    j = load_per_phase.join(cpu_per_phase, list(keys), "inner")
    return j.withColumn("successful_rps_per_cpu_percent",
                        F.when(F.col("cpu_percent") > 0, F.col("successful_rps") / F.col("cpu_percent")))


__all__ = ["writer_share", "running_demand", "phase_summary", "parallelism_benefit", "pool_effectiveness",
           "efficiency", "safe_percent"]


def query_phase_shares(query_deltas: DataFrame, keys: Sequence[str], scale: int = 6) -> DataFrame:
    """AG-24: per phase, JIT share of execution time and planning share of plan + execution time.

    ``query_deltas`` is IV-02 output (``*_delta`` columns) with a phase attached; only
    intervals with deltas count (first and reset samples contribute nothing).
    """
    jit = (F.col("jit_generation_time_delta") + F.col("jit_inlining_time_delta")
           + F.col("jit_optimization_time_delta") + F.col("jit_emission_time_delta")
           + F.col("jit_deform_time_delta"))
    g = query_deltas.groupBy(*keys).agg(
        F.sum("total_exec_time_delta").alias("exec_ms"), F.sum("total_plan_time_delta").alias("plan_ms"),
        F.sum(jit).alias("jit_ms"), F.sum("calls_delta").alias("calls"))
    return g.select(
        *keys, "calls", F.round("exec_ms", scale).alias("exec_ms"), F.round("plan_ms", scale).alias("plan_ms"),
        F.round("jit_ms", scale).alias("jit_ms"),
        F.round(F.when(F.col("exec_ms") > 0, F.lit(100.0) * F.col("jit_ms") / F.col("exec_ms")), 2)
        .alias("jit_share_percent"),
        F.round(F.when(F.col("plan_ms") + F.col("exec_ms") > 0,
                       F.lit(100.0) * F.col("plan_ms") / (F.col("plan_ms") + F.col("exec_ms"))), 2)
        .alias("planning_share_percent"))
