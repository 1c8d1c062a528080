"""Rule evaluation (RL-01 to RL-27).

A rule is a value expression plus severity thresholds, an optional guard and an
optional "n samples in a row" (``consecutive``) or "held for D seconds" (``sustain_s``)
requirement; the highest severity that holds wins. A level is held for D seconds
at a sample when every sample since the first one of the current run at or above
that level qualifies and that first sample is at least D seconds old.
A value may also be the average over a trailing range (``average_s``), which counts
only when every sample of the range is there.
``evaluate`` computes every rule of a pack in one pass over the input: each row
gets an array of ``(rule_id, value, level, limits)`` structs, of which those that
fire are exploded, so N rules cost one scan, not N. Runs of all consecutive and
sustained rules come from one set of windows over time buckets of an entity.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statsweep.operators.deltas import running, seconds_between
from statsweep.operators.series import trailing_averages

# Severity ranks (highest wins).
SEVERITIES = ("warning", "high", "critical")
RANK = {s: i + 1 for i, s in enumerate(SEVERITIES)}
AVERAGE_SCALE = 6  # averages are compared and shown at this many places, whatever order they were summed in


@dataclass(frozen=True)
class Rule:
    rule_id: str
    value: str  # SQL expression over the input's columns
    levels: tuple[tuple[str, float], ...]  # (severity, threshold)
    op: str = ">"
    guard: str | None = None
    consecutive: int = 1
    sustain_s: float | None = None  # level must have held this long (time-based, needs a time column)
    average_s: float | None = None  # the value is averaged over this range, which must be fully covered (needs a cadence)


@dataclass(frozen=True)
class Pack:
    pack_id: str
    source: str  # name of the input query
    keys: tuple[str, ...]
    time_col: str | None
    rules: tuple[Rule, ...]
    tiebreak: tuple[str, ...] = field(default=())
    cadence_s: int | None = None  # time between samples, for rules on trailing averages


def _cmp(v: Column, op: str, t: float) -> Column:
    lit = F.lit(float(t))
    return {">": v > lit, ">=": v >= lit, "<": v < lit, "<=": v <= lit}[op]


def level_expr(rule: Rule, value: Column, guard: Column | None = None) -> Column:
    """Numeric level (0 none, 1 warning, 2 high, 3 critical) of one rule on one row."""
    chain = None
    for sev, thr in sorted(rule.levels, key=lambda x: -RANK[x[0]]):
        cond = _cmp(value, rule.op, thr)
        chain = F.when(cond, F.lit(RANK[sev])) if chain is None else chain.when(cond, F.lit(RANK[sev]))
    lvl = F.coalesce(chain.otherwise(F.lit(0)), F.lit(0))
    return lvl if guard is None else F.when(guard, lvl).otherwise(F.lit(0))


def _limits(rule: Rule) -> Column:
    thr = dict(rule.levels)
    return F.array(*[F.lit(thr.get(s)).cast("double") for s in SEVERITIES])


def evaluate(df: DataFrame, rules: Sequence[Rule], keys: Sequence[str], time_col: str | None = None,
             tiebreak: Sequence[str] = (), cadence_s: int | None = None) -> DataFrame:
    """Rule hits ``(keys, time, rule_id, severity, value, threshold)``, one row per row and rule that fires.

    The input is read once, whatever kinds of rules the pack has: all trailing averages share one shuffle, and so do
    all runs that consecutive and sustained rules need.
    """
    keys = list(keys)
    base_cols = [*keys, *([time_col] if time_col else []), *tiebreak]
    timed = [i for i, r in enumerate(rules) if r.consecutive > 1 or r.sustain_s is not None]
    averaged = [i for i, r in enumerate(rules) if r.average_s is not None]
    if (timed or averaged) and time_col is None:
        raise ValueError("rules over several samples need a time column")
    if averaged and cadence_s is None:
        raise ValueError("rules on trailing averages need the cadence of the samples")
    x = df.select(*base_cols, *[F.expr(r.value).cast("double").alias(f"_v{i}") for i, r in enumerate(rules)],
                  *[F.coalesce(F.expr(r.guard), F.lit(False)).alias(f"_g{i}") for i, r in enumerate(rules) if r.guard])
    if averaged:
        x = trailing_averages(x, {f"_a{i}": (f"_v{i}", int(rules[i].average_s)) for i in averaged}, cadence_s, keys, time_col)
        x = x.withColumns({f"_v{i}": F.round(f"_a{i}", AVERAGE_SCALE) for i in averaged})
    x = x.select(*base_cols, *[f"_v{i}" for i in range(len(rules))],
                 *[level_expr(r, F.col(f"_v{i}"), F.col(f"_g{i}") if r.guard else None).alias(f"_l{i}") for i, r in enumerate(rules)])
    ranks = {i: sorted(RANK[s] for s, _ in rules[i].levels) for i in timed}
    if timed:
        at_least = {(i, L): F.col(f"_l{i}") >= L for i in timed for L in ranks[i]}
        x = running(x, keys, [time_col, *tiebreak], time_col,
                    runs={f"_r{i}_{L}": c for (i, L), c in at_least.items() if rules[i].consecutive > 1},
                    starts={f"_s{i}_{L}": c for (i, L), c in at_least.items() if rules[i].sustain_s is not None})

    def level(i: int, r: Rule) -> Column:
        out = F.col(f"_l{i}") if i not in ranks else F.lit(0)
        for L in ranks.get(i, ()):
            holds = F.lit(True)
            if r.consecutive > 1:
                holds &= F.col(f"_r{i}_{L}") >= r.consecutive
            if r.sustain_s is not None:
                holds &= seconds_between(time_col, f"_s{i}_{L}") >= F.lit(float(r.sustain_s))
            out = F.when(holds, F.lit(L)).otherwise(out)
        return out

    structs = [F.struct(F.lit(r.rule_id).alias("rule_id"), F.col(f"_v{i}").alias("value"), level(i, r).alias("lvl"),
                        _limits(r).alias("limits")) for i, r in enumerate(rules)]
    # only the rules that fire are exploded
    out = x.select(*base_cols, F.inline(F.filter(F.array(*structs), lambda s: s["lvl"] > 0)))
    sev = F.element_at(F.array(*[F.lit(s) for s in SEVERITIES]), F.col("lvl"))
    return out.select(*keys, *([time_col] if time_col else []), "rule_id", sev.alias("severity"), "value",
                      F.element_at("limits", F.col("lvl")).alias("threshold")).drop(*tiebreak)


def run_pack(df: DataFrame, pack: Pack) -> DataFrame:
    return evaluate(df, pack.rules, pack.keys, pack.time_col, pack.tiebreak, pack.cadence_s)


def _pct(n: str, d: str) -> str:
    return f"CASE WHEN {d} > 0 THEN CAST(100 AS DOUBLE) * {n} / {d} END"


# Packs registered by the query catalog over its derived inputs (appended there).
EXTRA_PACKS: list[Pack] = []

TICK_S = 3600  # one hour of the stand-in series stands for a minute of the specified one
MB = 1024 * 1024
GB = 1024 * MB

# The rule packs, thresholds as stated in the reference specification.
PACKS: tuple[Pack, ...] = (
    Pack("RL-01", "override_ratio", ("server_id", "setting_scope", "database_name", "role_name", "parameter_name",
                                     "parameter_value"), None, (
        Rule("override_vs_default", "override_ratio", (("warning", 2.0), ("high", 4.0))),)),
    Pack("RL-02", "activity_summary", ("server_id",), "source_collected_at", (
        Rule("lock_wait_share", _pct("active_lock_waiting_sessions", "active_client_connections"),
             (("warning", 5.0), ("high", 15.0))),
        Rule("io_wait_share", _pct("active_io_waiting_sessions", "active_client_connections"),
             (("warning", 20.0), ("high", 40.0))),
        Rule("connection_utilization", "connection_utilization_percent",
             (("warning", 70.0), ("high", 85.0), ("critical", 95.0)), ">=", sustain_s=300),
        Rule("worker_pool_utilization", "parallel_worker_pool_utilization_percent",
             (("warning", 70.0), ("high", 85.0)), ">=", sustain_s=300),
        Rule("worker_pool_saturated", "parallel_worker_pool_utilization_percent", (("critical", 95.0),), ">=",
             consecutive=2),
        Rule("wait_group_volume", "wait_query_group_count", (("warning", 500.0),)),
        Rule("lwlock_share", _pct("active_lwlock_waiting_sessions", "active_client_connections"), (("warning", 20.0),)),
        Rule("bufferpin_repeated", "active_bufferpin_waiting_sessions", (("warning", 0.0),), consecutive=2),
        Rule("bufferpin_share", _pct("active_bufferpin_waiting_sessions", "active_client_connections"), (("high", 5.0),)),
        Rule("worker_wait_share", _pct("parallel_workers_waiting", "active_parallel_workers"), (("warning", 20.0),),
             consecutive=2),
    )),
    Pack("RL-03", "blocking_pairs", ("server_id", "blocked_pid", "blocking_pid"), "source_collected_at", (
        Rule("lock_wait", "actual_lock_wait_seconds", (("warning", 5.0), ("high", 30.0), ("critical", 60.0)),
             guard="waitstart IS NOT NULL"),
        Rule("chain_depth", "maximum_chain_depth", (("high", 3.0), ("critical", 5.0)), ">="),
        Rule("fan_in", "direct_blocker_count", (("warning", 1.0),)),
    )),
    Pack("RL-04", "database_interval", ("server_id", "datid"), "source_collected_at", (
        Rule("deadlock", "deadlock_count", (("critical", 0.0),)),
        Rule("cache_hit", "cache_hit_percent", (("warning", 99.0), ("high", 97.0), ("critical", 95.0)), "<", sustain_s=900),
        Rule("temp_spill_per_minute", "temp_bytes_per_second * 60", (("warning", 100.0 * MB), ("high", 1.0 * GB))),
        Rule("rollback", "rollback_percent", (("warning", 1.0), ("high", 5.0))),
    ), ("event_id",)),
    Pack("RL-05", "query_interval", ("server_id", "dbid", "userid", "queryid", "toplevel"), "source_collected_at", (
        Rule("planning_share", "planning_share_percent", (("warning", 10.0),), guard="plan_time_interval >= 1000"),
        Rule("planning_share_large", "planning_share_percent", (("high", 25.0),)),
        Rule("jit_overhead", "jit_overhead_percent", (("warning", 10.0),), guard="jit_time_interval > 1000"),
        Rule("jit_overhead_large", "jit_overhead_percent", (("high", 25.0),)),
        Rule("worker_launch_fulfillment", "worker_launch_fulfillment_percent", (("warning", 80.0),), "<",
             guard="workers_to_launch_interval >= 20", consecutive=2),
        Rule("worker_launch_shortage", "worker_launch_fulfillment_percent", (("high", 50.0),), "<",
             guard="workers_to_launch_interval >= 20"),
    ), ("event_id",)),
    Pack("RL-06", "statement_store_interval", ("server_id",), "source_collected_at", (
        Rule("dealloc", "deallocations", (("warning", 0.0),)),
        Rule("dealloc_repeated", "deallocations", (("high", 0.0),), consecutive=2),
    ), ("event_id",)),
    Pack("RL-07", "io_eviction_baseline", ("server_id", "backend_type", "object", "context"), "source_collected_at", (
        Rule("eviction_vs_baseline", "eviction_vs_baseline", (("warning", 2.0),), sustain_s=900),
    ), ("event_id",)),
    Pack("RL-08", "checkpoint_interval", ("server_id", "source_view"), "source_collected_at", (
        Rule("requested_checkpoints", "requested_checkpoint_percent", (("warning", 20.0),), sustain_s=900),
        Rule("mostly_requested_checkpoints", "requested_checkpoint_percent", (("high", 50.0),)),
    ), ("event_id",)),
    Pack("RL-09", "table_interval", ("server_id", "database_name", "relid"), "source_collected_at", (
        Rule("dead_tuples", "dead_tuple_percent", (("warning", 10.0), ("high", 20.0))),
        Rule("rows_per_seq_scan", "rows_read_per_seq_scan", (("warning", 100000.0),)),
    ), ("event_id",)),
    Pack("RL-10", "index_stats", ("server_id", "indexrelid"), "source_collected_at", (
        Rule("unused_large_index", "CASE WHEN idx_scan = 0 AND index_size_bytes > 104857600 AND NOT indisunique "
             "AND NOT indisprimary THEN 1 ELSE 0 END", (("warning", 1.0),), ">="),
        Rule("invalid_index", "CASE WHEN NOT indisvalid OR NOT indisready THEN 1 ELSE 0 END", (("high", 1.0),), ">="),
    )),
    Pack("RL-11", "window_waits", ("server_id", "start_time", "end_time", "user_id", "db_id", "query_id", "event_type",
                                   "event"), None, (
        Rule("wait_concentration", "event_share_of_all_window_wait_percent", (("warning", 20.0), ("high", 40.0))),)),
    Pack("RL-11u", "unmatched_share", ("server_id", "start_time", "end_time"), None, (
        Rule("unmatched_waits", "unmatched_percent", (("high", 5.0),)),)),
    Pack("RL-12", "maintenance_progress", ("server_id", "operation_type", "pid"), "source_collected_at", (
        Rule("long_maintenance", "operation_age_seconds", (("warning", 1800.0),)),)),
    Pack("RL-13", "buffer_summary", ("server_id",), "source_collected_at", (
        Rule("dirty_buffers", "dirty_buffer_percent_of_used", (("warning", 10.0),), sustain_s=600),
        Rule("dirty_buffers_large", "dirty_buffer_percent_of_used", (("high", 20.0),)),
        Rule("pinned_buffers", "pinned_buffer_percent_of_used", (("warning", 1.0),), consecutive=2),
        Rule("pinned_buffers_large", "pinned_buffer_percent_of_used", (("high", 5.0),)),
    )),
    Pack("RL-14", "relation_cache", ("server_id", "relation_oid"), "source_collected_at", (
        Rule("cache_concentration", "share_of_current_database_cached_buffers_percent",
             (("warning", 30.0), ("high", 50.0))),
        Rule("cached_over_size", "relation_cached_percent", (("warning", 100.0),)),
    )),
    Pack("RL-15", "allocation_shares", ("server_id", "allocation_name", "off"), "source_collected_at", (
        Rule("allocation_share", "allocation_share_percent", (("warning", 10.0), ("high", 20.0))),)),
    Pack("RL-16", "slru_interval", ("server_id", "name"), "source_collected_at", (
        Rule("slru_hit", "slru_hit_percent", (("warning", 95.0), ("high", 90.0)), "<", guard="slru_accesses >= 1000",
             sustain_s=900),
    ), ("event_id",)),
    Pack("RL-17", "lock_logging_config", ("server_id", "name"), None, (
        Rule("lock_waits_not_logged", "CASE WHEN name = 'log_lock_waits' AND setting = 'off' THEN 1 ELSE 0 END",
             (("critical", 1.0),), ">="),
        Rule("deadlock_timeout_ms", "TRY_CAST(setting AS DOUBLE)", (("warning", 1000.0), ("high", 5000.0)),
             guard="name = 'deadlock_timeout'"),
        Rule("error_statements_not_logged", "CASE WHEN name = 'log_min_error_statement' AND setting IN ('log', 'fatal', "
             "'panic') THEN 1 ELSE 0 END", (("critical", 1.0),), ">="),
        Rule("terse_error_logs", "CASE WHEN name = 'log_error_verbosity' AND setting = 'terse' THEN 1 ELSE 0 END",
             (("warning", 1.0),), ">="),
        Rule("settings_pending_restart", "CASE WHEN pending_restart THEN 1 ELSE 0 END", (("warning", 1.0),), ">="),
    )),
    Pack("RL-18", "unmapped_waits", ("server_id", "event_type", "event"), None, (
        Rule("unmapped_wait_event", "1", (("warning", 1.0),), ">="),
        Rule("unmapped_wait_events", "share_percent", (("high", 1.0),)),)),
    Pack("RL-19", "plan_inventory", ("server_id", "db_id", "query_id", "plan_id"), None, (
        Rule("many_planned_workers", "workers_planned_from_plan", (("warning", 4.0),), ">="),
        Rule("short_frequent_parallel", "CASE WHEN mean_time_ms < 50 AND query_store_calls > 1000 THEN 1 ELSE 0 END",
             (("warning", 1.0),), ">="),
    )),
    Pack("RL-20", "pool_totals", ("server_id",), "source_collected_at", (
        Rule("pool_budget_vs_max_connections", "pgbouncer_server_connections", (("high", 100.0),),
             guard="grouping_level = 7"),)),
    Pack("RL-21", "pool_derived", ("server_id", "database", "user"), "source_collected_at", (
        Rule("clients_waiting", "cl_waiting", (("warning", 0.0),), consecutive=2),
        Rule("clients_waiting_long", "cl_waiting", (("high", 0.0),), sustain_s=300),
        Rule("no_idle_server", "CASE WHEN cl_waiting > 0 AND sv_idle = 0 THEN 1 ELSE 0 END", (("high", 1.0),), ">="),
        Rule("max_wait", "oldest_client_wait_seconds", (("warning", 1.0), ("high", 5.0), ("critical", 30.0))),
        Rule("pool_busy", "server_pool_not_immediately_idle_percent", (("warning", 80.0), ("high", 90.0)), ">=",
             sustain_s=300),
        Rule("pool_exhausted", "CASE WHEN cl_waiting > 0 THEN server_pool_not_immediately_idle_percent END",
             (("critical", 95.0),), ">="),
    )),
    Pack("RL-22", "pooler_interval", ("server_id", "pb_command", "database"), "source_collected_at", (
        Rule("avg_wait_ms", "wait_ms_per_assigned_client", (("warning", 5.0), ("high", 20.0)), sustain_s=300),
        Rule("avg_wait_ms_extreme", "wait_ms_per_assigned_client", (("critical", 100.0),)),
    ), ("event_id",)),
    Pack("RL-23", "client_diagnostics", ("server_id", "application_name", "addr"), "source_collected_at", (
        Rule("empty_application_name", "CASE WHEN grouping_level = 1 AND application_name = '' THEN client_count "
             "ELSE 0 END", (("warning", 0.0),)),
        Rule("client_wait", "max_client_wait_seconds", (("warning", 1.0), ("high", 5.0), ("critical", 30.0))),
    )),
    Pack("RL-24", "pivot_lists", ("server_id",), "source_collected_at", (
        Rule("used_client_objects", "used_client_object_percent", (("warning", 85.0), ("high", 95.0)), ">="),
        Rule("used_server_objects", "used_server_object_percent", (("warning", 85.0), ("high", 95.0)), ">="),
    )),
    Pack("RL-25", "assign_phase", ("resource_id", "metric_id", "dimension_key"), "time_utc", (
        Rule("cpu_average_15", "value", (("warning", 70.0), ("high", 80.0)), ">=", average_s=15 * TICK_S),
        Rule("cpu_average_5", "value", (("critical", 90.0),), ">=", average_s=5 * TICK_S),
        Rule("cpu_continuous_15", "value", (("critical", 90.0),), ">=", consecutive=15),
    ), cadence_s=TICK_S),
    Pack("RL-25s", "trend_slope", ("resource_id", "metric_id", "dimension_key", "phase_name"), None, (
        Rule("growth_slope", "slope_per_hour", (("warning", 2.0), ("high", 5.0))),)),
    Pack("RL-26", "assign_capacity", ("server_id",), "source_collected_at", (
        Rule("demand_per_vcore", "running_demand_per_vcore", (("warning", 0.7), ("high", 1.0), ("critical", 1.5)),
             ">="),)),
    Pack("RL-27", "run_ledger", ("server_id", "query_id", "run_id"), "started_at", (
        Rule("slow_run", "duration_ms", (("warning", 2000.0), ("high", 5000.0))),)),
    Pack("RL-27o", "overlapping_runs", ("server_id", "query_id", "run_id"), "started_at", (
        Rule("overlapping_run", "1", (("warning", 1.0),), ">="),)),
)
