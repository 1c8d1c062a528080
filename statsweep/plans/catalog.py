"""

Each builder reads the test tables, reshapes them into a monitoring dataset with
``statsweep.sources.bindings`` and runs one library operator on it. The DuckDB
oracle for the same name is in ``statsweep.plans.oracle``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statsweep.operators import deltas
from statsweep.plans.registry import query
from statsweep.sources import bindings as B


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return B.table(spark, sf, name)


# ----------------------------------------------------------------- WN-01
@query("counter_delta")
def q_counter_delta(spark, sf):
    """WN-01: per-user counter deltas and rates with reset detection (first / reset / delta)."""
    s = B.counter_samples(_t(spark, sf, "events"))
    d = deltas.counter_delta(
        s, ["server_id", "user_id"], ["counter"], tiebreak=["event_id"]
    )
    return d.select(
        "server_id", "user_id", "event_id", "source_collected_at", "stats_reset", "counter",
        "counter_kind", "counter_delta", "counter_rate", "elapsed_seconds",
    )


@query("counter_rate_daily")
def q_counter_rate_daily(spark, sf):
    """Flagship: per server, user and day, counted units and rates not crossing resets."""
    d = q_counter_delta(spark, sf)
    return (
        d.groupBy("server_id", "user_id", B.trunc("day", "source_collected_at").alias("day"))
        .agg(
            F.count(F.lit(1)).alias("samples"),
            F.count_if(F.col("counter_kind") == "reset").alias("resets"),
            F.sum("counter_delta").alias("units"),
            F.max("counter_rate").alias("max_rate"),
            F.sum("elapsed_seconds").alias("covered_seconds_raw"),
        )
        .withColumn("covered_seconds", F.round("covered_seconds_raw", 3))
        .drop("covered_seconds_raw")
    )


# ----------------------------------------------------------------- IV-01..IV-09
from statsweep.operators import interval as IV  # noqa: E402
from statsweep.sources import readers as R  # noqa: E402
from statsweep.sources.marks import MarkStore  # noqa: E402

CHECKPOINT_FIELDS = {"num_timed": "long", "num_requested": "long", "write_time": "double",
                     "sync_time": "double", "wal_bytes": "long"}


def _interval_query(name: str):
    p = IV.PRESETS[name]

    def build(spark, sf):
        ev = _t(spark, sf, "events")
        if name == "checkpoint":
            src = R.unpack_payload(B.checkpoint_samples(ev), "payload", CHECKPOINT_FIELDS)
        else:
            src = B.b1_dataset(ev, name)
        out = IV.interval_metrics(src, p, tiebreak=["event_id"])
        metric_cols = list(p.metrics(lambda c: F.col(c), F.col("elapsed_seconds")).keys())
        extra = ["is_reset"] if name == "statement_store" else []
        if name == "statement_store":
            out = out.withColumn("is_reset", F.col("dealloc_kind") == "reset")
        return out.select(*p.keys, "event_id", "source_collected_at", "elapsed_seconds", *metric_cols, *extra)

    build.__name__ = f"q_{name}_interval"
    build.__doc__ = f"IV preset '{name}': counter deltas per {', '.join(p.keys)} and derived metrics."
    query(f"{name}_interval")(build)


for _n in IV.PRESETS:
    _interval_query(_n)


@query("writer_views_interval")
def q_writer_views_interval(spark, sf):
    """IV-05: all eight counters of the background writer, checkpointer and WAL views, each from its own view's payload."""
    p = IV.WRITER_VIEWS
    src = R.unpack_payload(B.writer_view_samples(_t(spark, sf, "events")), "payload", {c: "long" for c in p.counters})
    out = IV.interval_metrics(src, p, tiebreak=["event_id"])
    metrics = p.metrics(lambda c: F.col(c), F.col("elapsed_seconds"))
    return out.select(*p.keys, "event_id", "source_collected_at", "elapsed_seconds", *metrics)


# ----------------------------------------------------------------- activity (B2)
from statsweep.functions import scalars as S  # noqa: E402
from statsweep.operators import activity as A  # noqa: E402

COLLECTOR_APP = "collector"


def _sessions(spark, sf):
    """B2 sessions without the collector's own, with ages at the sample time."""
    raw = B.sessions(_t(spark, sf, "events"))
    s = S.exclude_self(raw, COLLECTOR_APP)
    s = S.truncate_text(s, {"query": 2000})
    return S.session_ages(s, "source_collected_at"), B.server_settings(raw)


@query("session_ages")
def q_session_ages(spark, sf):
    """PRJ-06/07/08: per-session ages after excluding the collector, query text cut at 2,000."""
    s, _ = _sessions(spark, sf)
    return s.select("server_id", "source_collected_at", "pid", "active_query_age_seconds",
                    "transaction_age_seconds", "idle_in_transaction_age_seconds",
                    F.col("query").alias("query_text"))


@query("activity_summary")
def q_activity_summary(spark, sf):
    """AG-01 + JN-07: one row per sample (spine from settings), conditional counts and maxima."""
    s, settings = _sessions(spark, sf)
    return A.activity_summary(s, settings)


@query("sessions_by_state")
def q_sessions_by_state(spark, sf):
    """AG-02: client sessions by state as a map per sample, compared as exploded rows."""
    s, _ = _sessions(spark, sf)
    m = A.count_map(s, "state", where=A.CLIENT())
    return m.select(*A.SAMPLE, F.explode("state_counts").alias("state", "session_count"))


@query("sessions_by_backend_type")
def q_sessions_by_backend_type(spark, sf):
    """AG-02: all sessions by backend type as a map per sample, compared as exploded rows."""
    s, _ = _sessions(spark, sf)
    m = A.count_map(s, "backend_type")
    return m.select(*A.SAMPLE, F.explode("backend_type_counts").alias("backend_type", "session_count"))


@query("wait_type_counts")
def q_wait_type_counts(spark, sf):
    """AG-03: active client sessions per wait type (null type as CPU_or_not_waiting)."""
    s, _ = _sessions(spark, sf)
    return A.wait_type_counts(s)


@query("wait_event_counts")
def q_wait_event_counts(spark, sf):
    """AG-04: active waiting client sessions per wait type and event with the longest query age."""
    s, _ = _sessions(spark, sf)
    return A.wait_event_counts(s)


@query("waits_by_query")
def q_waits_by_query(spark, sf):
    """AG-05 + WN-11: top 500 wait groups per sample with the group count."""
    s, _ = _sessions(spark, sf)
    return A.waits_by_query(s)


@query("system_backend_waits")
def q_system_backend_waits(spark, sf):
    """AG-06: waits of non-client processes per backend type and event."""
    s, _ = _sessions(spark, sf)
    return A.system_backend_waits(s)


@query("worker_groups")
def q_worker_groups(spark, sf):
    """AG-07: per leader counts; the ordered worker list rendered as a pid list."""
    s, _ = _sessions(spark, sf)
    g = A.worker_groups(s)
    return g.withColumn("worker_pids", F.array_join(F.transform("workers", lambda x: x["worker_pid"].cast("string")),
                                                    ",")).drop("workers")


@query("parallel_groups")
def q_parallel_groups(spark, sf):
    """JN-08: worker groups joined to the leader session."""
    s, _ = _sessions(spark, sf)
    g = A.parallel_groups(s)
    return g.drop("workers")


@query("interesting_sessions")
def q_interesting_sessions(spark, sf):
    """WN-12 + AG-08: top-200 interesting sessions per sample as an ordered list, exploded back."""
    s, settings = _sessions(spark, sf)
    cand = A.interesting_sessions(s, k=None).drop("rank")
    age = F.coalesce("active_query_age_seconds", "transaction_age_seconds", F.lit(0.0))
    lists = A.ordered_structs(cand, A.SAMPLE, [age.desc(), F.col("pid").asc()],
                              ["pid", "backend_type", "state", "wait_event_type"], k=A.TOP_SESSIONS,
                              out="interesting_sessions", spine=settings)
    return lists.select(*A.SAMPLE, F.posexplode_outer("interesting_sessions").alias("position", "s")).select(
        *A.SAMPLE, "position", F.col("s.pid").alias("pid"), F.col("s.backend_type").alias("backend_type"),
        F.col("s.state").alias("state"), F.col("s.wait_event_type").alias("wait_event_type"))


@query("wait_shares")
def q_wait_shares(spark, sf):
    """AG-29: wait-type shares of active sessions and sampled occupancy per sample."""
    s, settings = _sessions(spark, sf)
    summary = A.activity_summary(s, settings)
    return A.wait_shares(summary, A.wait_type_counts(s))


@query("wait_event_shares")
def q_wait_event_shares(spark, sf):
    """AG-29: wait-event shares of active sessions, of their type and of all waits, and sampled occupancy per sample."""
    s, settings = _sessions(spark, sf)
    return A.wait_event_shares(A.activity_summary(s, settings), A.wait_event_counts(s))


@query("waiting_with_totals")
def q_waiting_with_totals(spark, sf):
    """JN-06: waiting client sessions with their sample's totals attached."""
    s, settings = _sessions(spark, sf)
    totals = A.activity_summary(s, settings).select(*A.SAMPLE, "client_connections", "active_client_connections")
    w = s.where(A.CLIENT() & A.ACTIVE() & F.col("wait_event_type").isNotNull())
    return A.attach_scalars(w, totals).select(
        *A.SAMPLE, "pid", "wait_event_type", "client_connections", "active_client_connections")


# ----------------------------------------------------------------- blocking
from statsweep.operators import blocking as BL  # noqa: E402

CURRENT_DATID = 1


@query("wait_edges")
def q_wait_edges(spark, sf):
    """RC-01: waiting locks' blocker lists as edges."""
    return BL.wait_edges(B.locks(_t(spark, sf, "customer")))


@query("blocker_summary")
def q_blocker_summary(spark, sf):
    """AG-14: direct blockers per blocked pid (sorted list rendered as text)."""
    s = BL.blocker_summary(BL.wait_edges(B.locks(_t(spark, sf, "customer"))))
    return s.withColumn("direct_blocker_pids", F.array_join(F.col("direct_blocker_pids").cast("array<string>"), ","))


@query("chain_depth")
def q_chain_depth(spark, sf):
    """RC-02: maximum blocking chain depth per blocked pid (simple paths, depth <= 32)."""
    return BL.chain_depth(BL.wait_edges(B.locks(_t(spark, sf, "customer"))))


@query("root_blockers")
def q_root_blockers(spark, sf):
    """RC-03: blockers not blocked themselves, with direct and transitive waiters."""
    return BL.root_blockers(BL.wait_edges(B.locks(_t(spark, sf, "customer"))))


@query("blocking_pairs")
def q_blocking_pairs(spark, sf):
    """JN-09 (+PRJ-13): each waiting lock with each direct blocker, sessions, relation and chain depth."""
    c = _t(spark, sf, "customer")
    out = BL.blocking_pairs(B.locks(c), B.lock_sessions(c), B.relations(_t(spark, sf, "nation")), CURRENT_DATID)
    return out.withColumn("direct_blocker_pids",
                          F.array_join(F.col("direct_blocker_pids").cast("array<string>"), ","))


# ------------------------------------------------------------- query store
from statsweep.operators import qstore as QS  # noqa: E402

WAIT_PERIOD_MS = 100.0
PLAN_INTERVAL = ("1996-01-01 00:00:00", "1999-01-01 00:00:00")


def _waits(spark, sf):
    ev = _t(spark, sf, "events")
    return B.window_waits_input(spark, ev), B.window_runtime_input(spark, ev)


@query("runtime_by_window")
def q_runtime_by_window(spark, sf):
    """AG-09: window runtime per query."""
    _, rt = _waits(spark, sf)
    return QS.runtime_by_window(rt)


@query("window_waits")
def q_window_waits(spark, sf):
    """JN-04 + WN-03 + PRJ-11 + PRJ-16: waits attributed to window runtime with shares."""
    w, rt = _waits(spark, sf)
    return QS.window_waits(w, rt, WAIT_PERIOD_MS)


@query("unmatched_share")
def q_unmatched_share(spark, sf):
    """AG-28: share of wait samples per window with no runtime row."""
    w, rt = _waits(spark, sf)
    return QS.unmatched_share(QS.window_waits(w, rt, WAIT_PERIOD_MS))


@query("unmapped_waits")
def q_unmapped_waits(spark, sf):
    """JN-12: waits missing from the wait dictionary and their share."""
    ev = _t(spark, sf, "events")
    return QS.unmapped_waits(B.window_waits_input(spark, ev), B.wait_dictionary(spark, ev))


@query("incremental_read")
def q_incremental_read(spark, sf):
    """SRC-06: wait rows after a high-water mark up to now - 2 min."""
    w, _ = _waits(spark, sf)
    return R.read_incremental(w, F.lit("2024-01-08 00:00:00").cast("timestamp_ntz"),
                              F.lit("2024-01-25 00:01:00").cast("timestamp_ntz"))


READ_TIMES = ("2024-01-02 00:10:00", "2024-01-12 00:30:00", "2024-02-02 00:00:00")


@query("high_water_reads")
def q_high_water_reads(spark, sf):
    """SRC-06, SM-03: three reads with stored marks, the first 17 minutes back, the second tried twice."""
    w, _ = _waits(spark, sf)
    store = MarkStore(spark, scratch_path(spark, "marks"), w)
    for n, now in enumerate(READ_TIMES, 1):
        for _ in range(1 + (n == 2)):
            store.read(n, w, now)
    return store.rows()


@query("plan_features")
def q_plan_features(spark, sf):
    """PRJ-12: plan flags and planned workers from plan text."""
    return S.plan_features(B.plans(_t(spark, sf, "part"))).drop("plan_text")


def _plan_runtime(spark, sf):
    return QS.runtime_by_plan(B.plan_runtime(_t(spark, sf, "lineitem")),
                              F.lit(PLAN_INTERVAL[0]).cast("timestamp_ntz"),
                              F.lit(PLAN_INTERVAL[1]).cast("timestamp_ntz"))


@query("runtime_by_plan")
def q_runtime_by_plan(spark, sf):
    """AG-10: per-plan sums over windows overlapping an interval."""
    return _plan_runtime(spark, sf)


@query("plan_inventory")
def q_plan_inventory(spark, sf):
    """JN-10: top-200 parallel plans by total time (a top-k report)."""
    return QS.plan_inventory(_plan_runtime(spark, sf), B.plans(_t(spark, sf, "part")))


@query("plan_variability")
def q_plan_variability(spark, sf):
    """AG-26: queries with several parallel plans and their slowest/fastest mean ratio."""
    inv = QS.plan_inventory(_plan_runtime(spark, sf), B.plans(_t(spark, sf, "part")), k=None)
    return QS.plan_variability(inv)


# ------------------------------------------------------------- series and phases
from statsweep.operators import joins as J  # noqa: E402
from statsweep.operators import series as SE  # noqa: E402

CADENCE_S = 3600


def _series(spark, sf):
    return B.metric_series(spark, _t(spark, sf, "events"))


def _phases(spark, sf):
    return R.phase_intervals(B.phase_markers(spark, _t(spark, sf, "events")))


def _phased(spark, sf):
    return SE.assign_phase(_series(spark, sf), _phases(spark, sf).drop("test_run_id"), "time_utc")


@query("phase_intervals")
def q_phase_intervals(spark, sf):
    """SRC-08: week markers to half-open phases, last one open."""
    return _phases(spark, sf)


@query("assign_phase")
def q_assign_phase(spark, sf):
    """JN-14: each series sample with the phase containing it (start included, end excluded)."""
    return _phased(spark, sf).select(*SE.SERIES, "time_utc", "value", "phase_name", "user_load")


@query("series_summary")
def q_series_summary(spark, sf):
    """AG-19: min/max/avg/P50/P90/P95/P99/count per series and phase (exact percentiles)."""
    return SE.summarize_series(_phased(spark, sf), [*SE.SERIES, "phase_name"])


@query("breach_runs")
def q_breach_runs(spark, sf):
    """WN-06: runs of consecutive hours at or above 90; a missing hour ends a run."""
    return SE.breach_runs(_series(spark, sf), F.col("value") >= 90, CADENCE_S)


@query("breach_summary")
def q_breach_summary(spark, sf):
    """AG-20: minutes at or above 70/80/90, first/last breach, longest breach per series and phase."""
    return SE.breach_summary(_phased(spark, sf), [*SE.SERIES, "phase_name"], CADENCE_S)


@query("trend_slope")
def q_trend_slope(spark, sf):
    """AG-21: value slope per hour per series and phase."""
    return SE.trend_slope(_phased(spark, sf), [*SE.SERIES, "phase_name"])


@query("consecutive_high")
def q_consecutive_high(spark, sf):
    """WN-04: samples ending 3 consecutive samples at or above 90."""
    out = SE.consecutive(_series(spark, sf), F.col("value") >= 90, 3)
    return out.where("consecutive").select(*SE.SERIES, "time_utc", "value")


@query("sustained_high")
def q_sustained_high(spark, sf):
    """WN-05: 3-hour trailing average at or above 80 with full coverage."""
    out = SE.sustained(_series(spark, sf), "value", 3 * 3600, CADENCE_S, 80.0)
    return out.select(*SE.SERIES, "time_utc", F.round("sustained_value", 6).alias("avg_value"),
                      "sustained_samples", "sustained")


@query("increasing_series")
def q_increasing_series(spark, sf):
    """WN-07: samples ending a strictly rising run of 3 samples."""
    out = SE.increasing(_series(spark, sf), "value", 3)
    return out.where("increasing").select(*SE.SERIES, "time_utc", "value")


@query("vs_baseline")
def q_vs_baseline(spark, sf):
    """WN-08: samples over 1.1x the series' week-1 average for 2 samples in a row."""
    ph = _phased(spark, sf)
    base = ph.where(F.col("phase_name") == "week-1").groupBy(*SE.SERIES).agg(
        F.avg("value").alias("baseline_value"))
    out = SE.vs_baseline(ph, base, "value", 1.1, 2)
    return out.where("above_baseline").select(*SE.SERIES, "time_utc", "value")


@query("stalled_series")
def q_stalled_series(spark, sf):
    """WN-09: value unchanged for at least 2 hours (e.g. capped at 100)."""
    out = SE.stalled(_series(spark, sf), "value", 2 * 3600, list(SE.SERIES), "time_utc")
    return out.select(*SE.SERIES, "time_utc", "value", "last_change_at", "unchanged_seconds", "stalled")


@query("value_changes")
def q_value_changes(spark, sf):
    """WN-10: samples whose value changed by 25 % or more against the previous sample."""
    out = SE.changes(_series(spark, sf), "value", list(SE.SERIES), "time_utc", min_pct=25.0)
    return out.where("changed").select(*SE.SERIES, "time_utc", "value", "previous_value",
                                       F.round("change_percent", 6).alias("change_percent"))


@query("align_asof")
def q_align_asof(spark, sf):
    """JN-16: each click with the user's latest view at or before it (as-of join)."""
    ev = _t(spark, sf, "events")
    clicks = ev.where(F.col("event_type") == "click").select("user_id", "event_id", "ts")
    views = ev.where(F.col("event_type") == "view").select(
        "user_id", F.col("ts").alias("view_ts"), F.col("event_id").alias("view_event_id"),
        F.col("value").alias("view_value"))
    out = J.align_asof(clicks, views, ["user_id"], "ts", "view_ts", ["view_event_id", "view_value"])
    return out.drop("matched_view_ts")


@query("supplier_labels")
def q_supplier_labels(spark, sf):
    """JN-01: suppliers labelled with nation and region names (size-checked broadcast)."""
    s = _t(spark, sf, "supplier")
    n = _t(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name", "n_regionkey")
    r = _t(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return J.label(J.label(s, n, "s_nationkey"), r, "n_regionkey").select(
        "s_suppkey", "s_name", "n_name", "r_name")


# ------------------------------------------------------------- configuration
from statsweep.operators import config as CF  # noqa: E402


def _cfg(spark, sf):
    part = _t(spark, sf, "part")
    return (B.setting_overrides(_t(spark, sf, "orders")), B.effective_settings(spark, part),
            B.routine_settings(part))


@query("explode_settings")
def q_explode_settings(spark, sf):
    """PRJ-02: override arrays to (name, value) rows split at the first '='."""
    ov, _, _ = _cfg(spark, sf)
    return S.explode_settings(ov, "setconfig")


@query("override_scope")
def q_override_scope(spark, sf):
    """PRJ-01: scope labels of database/role overrides."""
    ov, _, _ = _cfg(spark, sf)
    x = S.override_scope(S.explode_settings(ov, "setconfig"))
    return x.select("server_id", "setting_scope", "database_name", "role_name", "parameter_name", "parameter_value")


@query("select_parameters")
def q_select_parameters(spark, sf):
    """PRJ-03: effective settings restricted to the 53-name allow-list."""
    _, st, _ = _cfg(spark, sf)
    return CF.select_parameters(st, CF.CONFIG_PARAMETERS).select("server_id", "name", "setting")


@query("lock_logging_config")
def q_lock_logging_config(spark, sf):
    """PRJ-03 (lock logging list): the six lock/error logging settings."""
    _, st, _ = _cfg(spark, sf)
    return CF.select_parameters(st, CF.LOCK_LOGGING_PARAMETERS).select("server_id", "name", "setting",
                                                                        "pending_restart")


def _unified(spark, sf):
    ov, st, rt = _cfg(spark, sf)
    return (CF.effective_configuration(st), CF.override_configuration(ov, st), CF.routine_configuration(rt, st))


@query("unified_configuration")
def q_unified_configuration(spark, sf):
    """PRJ-04 (+PRJ-14): effective, override and routine settings in one 10-column dataset."""
    return CF.unify_configuration(*_unified(spark, sf))


@query("capability_flags")
def q_capability_flags(spark, sf):
    """PRJ-05: per-server object presence flags and the version gate."""
    return CF.capability_flags(B.catalog_objects(_t(spark, sf, "supplier")))


@query("missing_parameters")
def q_missing_parameters(spark, sf):
    """JN-13: allow-list names a server did not report."""
    _, st, _ = _cfg(spark, sf)
    return CF.missing_parameters(st)


@query("override_ratio")
def q_override_ratio(spark, sf):
    """JN-19: override values over the server's effective value."""
    eff, ovr, _ = _unified(spark, sf)
    return CF.override_ratio(ovr, eff).select("server_id", "setting_scope", "database_name", "role_name",
                                              "parameter_name", "parameter_value", "server_value", "override_ratio")


# ------------------------------------------------------------- cache and memory
from statsweep.operators import cache as CA  # noqa: E402

CURRENT_DB_OID = 1
DEFAULT_TABLESPACE = 1663


def _relcache(spark, sf):
    c = CA.cache_by_relation(B.buffers(_t(spark, sf, "lineitem")), CURRENT_DB_OID)
    return CA.map_relations(c, B.buffer_catalog(_t(spark, sf, "part")), DEFAULT_TABLESPACE)


@query("cache_by_relation")
def q_cache_by_relation(spark, sf):
    """AG-11: cached/dirty/pinned buffers per relation file of the current database."""
    out = CA.cache_by_relation(B.buffers(_t(spark, sf, "lineitem")), CURRENT_DB_OID)
    return out.withColumn("avg_usagecount", F.round("avg_usagecount", 6))


@query("relation_cache")
def q_relation_cache(spark, sf):
    """JN-05 + WN-03 + WN-11: cache mapped to relations, shares, top 100 per sample."""
    out = CA.relation_cache_report(_relcache(spark, sf))
    return out.withColumn("avg_usagecount", F.round("avg_usagecount", 6))


@query("buffer_summary")
def q_buffer_summary(spark, sf):
    """AG-12: buffer usage summary per sample."""
    out = CA.buffer_summary(B.buffers(_t(spark, sf, "lineitem")))
    return out.withColumn("usagecount_avg", F.round("usagecount_avg", 6))


@query("usage_counts")
def q_usage_counts(spark, sf):
    """AG-12/AG-08: usage-count distribution list per sample, exploded."""
    u = CA.usage_counts(B.buffers(_t(spark, sf, "lineitem")))
    return u.select(*CA.SAMPLE, F.inline("usage_counts"))


@query("allocation_shares")
def q_allocation_shares(spark, sf):
    """AG-13: shared memory allocation shares per sample."""
    return CA.allocation_shares(B.allocations(_t(spark, sf, "orders")))


@query("table_stats")
def q_table_stats(spark, sf):
    """JN-02: table counters with I/O counters (left join)."""
    return CA.table_stats(B.table_counter_rows(_t(spark, sf, "part")),
                          B.relation_io(spark, _t(spark, sf, "lineitem"), "relid"))


@query("index_stats")
def q_index_stats(spark, sf):
    """JN-03: index usage with I/O (left) and definition (inner)."""
    part = _t(spark, sf, "part")
    return CA.index_stats(B.index_usage_rows(part), B.relation_io(spark, _t(spark, sf, "lineitem"), "indexrelid"),
                          B.index_definitions(spark, part))


# ------------------------------------------------------------- pooler
from statsweep.operators import pooler as PL  # noqa: E402


@query("pool_derived")
def q_pool_derived(spark, sf):
    """PRJ-18: derived pool metrics per pool and sample."""
    return PL.pool_derived(B.pool_snapshot(spark, _t(spark, sf, "events")))


@query("pool_totals")
def q_pool_totals(spark, sf):
    """AG-15: per-pool and all-pool aggregates per sample (grouping sets)."""
    return PL.pool_totals(B.pool_snapshot(spark, _t(spark, sf, "events")))


@query("client_diagnostics")
def q_client_diagnostics(spark, sf):
    """AG-16: client counts by state per sample, application and address."""
    return PL.client_diagnostics(B.pool_clients(_t(spark, sf, "events")))


@query("server_diagnostics")
def q_server_diagnostics(spark, sf):
    """AG-17: server counts by state, database/user and application."""
    return PL.server_diagnostics(B.pool_servers(_t(spark, sf, "events")))


@query("pivot_lists")
def q_pivot_lists(spark, sf):
    """AG-18: SHOW LISTS rows pivoted to columns with used-object percentages."""
    return PL.pivot_lists(B.pool_lists(spark, _t(spark, sf, "events")))


@query("reconcile_pool_backends")
def q_reconcile_pool_backends(spark, sf):
    """JN-18: pooler server connections against client backends by pid."""
    ev = _t(spark, sf, "events")
    return PL.reconcile_pool_backends(B.pool_servers(ev), B.sessions(ev))


# ------------------------------------------------------------- comparison (B13, B14 + B1, B2, B11)
from statsweep.operators import compare as CP  # noqa: E402

SPLIT_AT = "2024-01-16 00:00:00"


@query("writer_share")
def q_writer_share(spark, sf):
    """AG-22: client-backend share of backend writes per server and hour (IV-04 deltas)."""
    io = IV.interval_metrics(B.b1_dataset(_t(spark, sf, "events"), "io"), "io", tiebreak=["event_id"])
    io = io.withColumn("hour", B.trunc("hour", "source_collected_at"))
    return CP.writer_share(io, ["server_id", "hour"])


def _demand(spark, sf, divide: int = 1):
    s, settings = _sessions(spark, sf)
    act = A.activity_summary(s, settings)
    cap = B.capacity_history(spark, _t(spark, sf, "events")).withColumn(
        "provisioned_vcores", (F.col("provisioned_vcores") / divide).cast("int"))
    return CP.running_demand(J.assign_capacity(act, cap, "source_collected_at"))


@query("assign_capacity")
def q_assign_capacity(spark, sf):
    """JN-15: vCores in force at each activity sample and running demand per vCore."""
    return _demand(spark, sf).select("server_id", "source_collected_at", "active_cpu_or_running_sessions",
                                     "provisioned_vcores", "sku", "running_demand_per_vcore")


@query("phase_summary")
def q_phase_summary(spark, sf):
    """AG-24: per server and phase: demand per vCore and worker-pool utilisation."""
    d = SE.assign_phase(_demand(spark, sf).drop("effective_from", "effective_to"),
                        _phases(spark, sf).drop("test_run_id"), "source_collected_at")
    return CP.phase_summary(d, ["server_id", "phase_name"])


@query("load_summary")
def q_load_summary(spark, sf):
    """AG-19 on load results: per run, min/max/avg/P50..P99 latency of each day's requests."""
    r = B.load_requests(_t(spark, sf, "events")).withColumn("day", B.trunc("day", "ts"))
    return SE.summarize_series(r, ["test_run_id", "day"], value="latency_ms")


def _compared(spark, sf):
    daily = B.load_daily(spark, _t(spark, sf, "events"))
    metrics = ["successful_rps", "error_rate", "p99_ms"]
    return J.compare_runs(daily.where("test_run_id = 'baseline'"), daily.where("test_run_id = 'after'"),
                          ["phase_name", "day_index"], metrics)


@query("compare_runs")
def q_compare_runs(spark, sf):
    """JN-17: baseline vs after per phase and day of run, with % change."""
    return _compared(spark, sf)


@query("parallelism_benefit")
def q_parallelism_benefit(spark, sf):
    """AG-25: positive/neutral/negative label per matched day, with the worker pool's daily peak and mean CPU."""
    ev = _t(spark, sf, "events")
    s, settings = _sessions(spark, sf)
    peak = A.activity_summary(s, settings).groupBy(B.trunc("day", "source_collected_at").alias("ts")).agg(
        F.max("parallel_worker_pool_utilization_percent").alias("worker_pool_percent"))
    daily = B.load_daily(spark, ev).join(peak, "ts", "left").join(_daily_cpu(spark, ev), "ts", "left")
    c = J.compare_runs(daily.where("test_run_id = 'baseline'"), daily.where("test_run_id = 'after'"), ["phase_name", "day_index"],
                       ["successful_rps", "error_rate", "p99_ms", "worker_pool_percent", "cpu_percent"])
    return CP.parallelism_benefit(c, workers="worker_pool_percent", cpu="cpu_percent").select(
        "phase_name", "day_index", "baseline_worker_pool_percent", "after_worker_pool_percent", "baseline_cpu_percent",
        "after_cpu_percent", "parallelism_benefit")


@query("pool_effectiveness")
def q_pool_effectiveness(spark, sf):
    """AG-23: pooler before/after effectiveness per server."""
    ev = _t(spark, sf, "events")
    s, settings = _sessions(spark, sf)
    act = A.activity_summary(s, settings)
    pools = PL.pool_derived(B.pool_snapshot(spark, ev))
    split = F.lit(SPLIT_AT).cast("timestamp_ntz")
    return CP.pool_effectiveness(act, pools, B.load_requests(ev), split)


# ------------------------------------------------------------- payloads, projections, progress
from statsweep.operators import views as V  # noqa: E402


@query("payload_fields")
def q_payload_fields(spark, sf):
    """SRC-05: typed field ``k`` out of each event's JSON props, summarised per event type."""
    p = R.unpack_payload(B.payload_rows(_t(spark, sf, "events")), "props", {"k": "long"})
    return p.groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"), F.sum("k").alias("sum_k"),
                                       F.count("k").alias("rows_with_k"))


@query("versioned_fields")
def q_versioned_fields(spark, sf):
    """PRJ-09: version-tolerant fields (first non-empty candidate, typed, default 0)."""
    p = V.versioned_fields(B.payload_rows(_t(spark, sf, "events")))
    return p.select("event_id", *[f[0] for f in V.VERSIONED_FIELDS])


@query("total_jit_time")
def q_total_jit_time(spark, sf):
    """PRJ-10: sum of the five JIT timing columns per statement sample."""
    q = V.with_total_jit_time(B.b1_dataset(_t(spark, sf, "events"), "query"))
    return q.select("server_id", "dbid", "userid", "queryid", "toplevel", "event_id", "jit_total_time")


@query("database_counters")
def q_database_counters(spark, sf):
    """PRJ-17: database counter rows without template databases."""
    d = B.b1_dataset(_t(spark, sf, "events"), "database").withColumn(
        "datname", F.when(F.col("datistemplate"), F.lit("template1")).otherwise(F.col("datname")))
    return V.database_counters(d, ["server_id", "source_collected_at", "datid", "datname", "xact_commit",
                                   "xact_rollback", "blks_read", "blks_hit", "stats_reset"])


@query("maintenance_progress")
def q_maintenance_progress(spark, sf):
    """JN-11: vacuum/analyze progress stacked and joined to sessions."""
    ev = _t(spark, sf, "events")
    prog = {"vacuum": B.progress_rows(ev, "purchase"), "analyze": B.progress_rows(ev, "signup")}
    out = V.maintenance_progress(prog, B.sessions(ev), {"k": "long"})
    return out.select("server_id", "source_collected_at", "operation_type", "pid", F.col("k").alias("heap_blks"),
                      "datname", "usename", "application_name", "wait_event_type", "wait_event",
                      "operation_age_seconds")


@query("union_databases")
def q_union_databases(spark, sf):
    """SRC-02: per-database scans stacked with database_name; names trimmed and de-duplicated ignoring case."""
    t = B.b1_dataset(_t(spark, sf, "events"), "table").drop("database_name")
    frames = {"db0": t.where("relid % 3 = 0"), " DB0 ": t.where("relid % 3 = 0"),
              "db1": t.where("relid % 3 = 1"), "db2 ": t.where("relid % 3 = 2")}
    u = R.union_databases(frames)
    return u.select("database_name", "relid", "event_id", "seq_scan", "n_dead_tup")


@query("union_tagged")
def q_union_tagged(spark, sf):
    """SRC-03: differently shaped pooler outputs stacked with a ``pb_command`` discriminator."""
    ev = _t(spark, sf, "events")
    pools = B.pool_snapshot(spark, ev).select("server_id", "source_collected_at", "database", "cl_active",
                                              "cl_waiting")
    lists = B.pool_lists(spark, ev)
    return R.union_tagged({"SHOW POOLS": pools, "SHOW LISTS": lists}, "pb_command")


# ------------------------------------------------------------- landing, sinks, ledger
from statsweep.operators import ledger as LG  # noqa: E402
from statsweep.session import scratch_path  # noqa: E402
from statsweep.sinks import tables as SK  # noqa: E402

QUERY_CADENCE = {"Q00": 15, "Q01": 30, "Q02": 60, "Q03": 300, "Q04": 900}


@query("run_ledger")
def q_run_ledger(spark, sf):
    """SNK-02: one ledger row per run from its landed rows."""
    return LG.run_ledger(B.landed_rows(_t(spark, sf, "events")))


@query("overlapping_runs")
def q_overlapping_runs(spark, sf):
    """JN-20: runs of the same query and server that start before an earlier one completed."""
    return LG.overlapping_runs(B.runs(_t(spark, sf, "events"))).select(
        "server_id", "query_id", "run_id", "started_at", "completed_at", "previous_completed_at")


@query("collector_health")
def q_collector_health(spark, sf):
    """AG-27: run duration percentiles, slow-run shares and missed ticks per server and query."""
    return LG.collector_health(B.runs(_t(spark, sf, "events")), QUERY_CADENCE)


@query("dedupe_natural_key")
def q_dedupe_natural_key(spark, sf):
    """SNK-05: re-delivered runs collapse to the latest delivery per run id."""
    r = B.runs(_t(spark, sf, "events"))
    again = r.where("event_id % 4 = 0").withColumn("completed_at", F.col("completed_at") + F.expr("INTERVAL 1 MINUTE")
                                                     ).withColumn("status", F.lit("replayed"))
    d = SK.dedupe_natural_key(r.unionByName(again), ["run_id"], [F.col("completed_at").desc()])
    return d.select("run_id", "query_id", "server_id", "started_at", "completed_at", "status")


@query("upsert_dictionary")
def q_upsert_dictionary(spark, sf):
    """SNK-06: query dictionary from a first-half snapshot merged with second-half sightings."""
    r = B.runs(_t(spark, sf, "events"))
    split = F.lit(SPLIT_AT).cast("timestamp_ntz")
    seen = r.where(F.col("started_at") < split).groupBy("query_id").agg(
        F.max_by("query_text", "started_at").alias("query_text"), F.min("started_at").alias("first_seen"),
        F.max("started_at").alias("last_seen"))
    cur = r.where(F.col("started_at") >= split).select("query_id", "query_text", "started_at")
    return SK.upsert_dictionary(seen, cur, ["query_id"], "query_text", "started_at")


@query("normalize_columns")
def q_normalize_columns(spark, sf):
    """SNK-03: dataset column names made safe; clashes and envelope names suffixed."""
    ev = _t(spark, sf, "events")
    raw = ev.select(F.col("event_id").alias("Event ID"), F.col("value").alias("1st value"),
                    F.col("user_id").alias("User-Id"), (F.col("user_id") * 2).alias("user_id"),
                    F.lit("x").alias("SERVER_ID"), F.col("ts").alias("Source_Collected_At"))
    return SK.normalize_columns(raw)


@query("flatten_to_text")
def q_flatten_to_text(spark, sf):
    """SNK-03 export: typed columns rendered as text (ISO timestamps)."""
    ev = _t(spark, sf, "events")
    return SK.flatten_to_text(ev.select("event_id", "ts", "value", (F.col("event_type") == "click").alias("is_click")))


@query("append_and_read")
def q_append_and_read(spark, sf):
    """SNK-01 + SRC-01: two appends (the second adds a column), re-read with merged schema and a date range."""
    path = scratch_path(spark, "runs")
    r = B.runs(_t(spark, sf, "events")).withColumn("source_collected_at", F.col("started_at"))
    base = ["run_id", "event_id", "query_id", "server_id", "source_collected_at", "status"]
    SK.append_dataset(r.where("event_id % 2 = 0").select(*base), path)
    SK.append_dataset(r.where("event_id % 2 = 1").select(*base, "row_count"), path)
    back = R.read_samples(spark, path, dates=("2024-01-05", "2024-01-20"))
    return back.select(*base, "row_count", "date")


@query("replay_buffer")
def q_replay_buffer(spark, sf):
    """SNK-04 + SRC-04: samples spilled as JSON lines, replayed to rows, already-stored samples dropped."""
    rows = B.landed_rows(_t(spark, sf, "events")).withColumn(
        "received_at", F.col("sample_at") + F.expr("INTERVAL 1 MINUTE"))
    samples = SK.nest_samples(rows, {"QueryId": "query_id", "ServerId": "server_id", "SourceCollectedAt": "sample_at",
                                     "CollectorReceivedAt": "received_at"}, "event_id",
                              ["event_id", "event_type", "value"])
    root = scratch_path(spark, "buffer")
    SK.spill_jsonl(samples, root)
    stored = rows.where("query_id = 'Q00' AND server_id = 'srv-0'").select(
        "query_id", "server_id", F.col("sample_at").cast("timestamp").alias("source_collected_at"))
    back = R.replay_buffer(spark, root, stored)
    return back.select("query_id", "server_id", F.col("source_collected_at").cast("timestamp_ntz")
                       .alias("source_collected_at"), "row_ordinal",
                       F.col("row")["event_id"].cast("long").alias("event_id"),
                       F.col("row")["event_type"].alias("event_type"))


@query("read_minute_metrics")
def q_read_minute_metrics(spark, sf):
    """SRC-07: a series landed twice (re-delivered hours) reads back one row per key, latest delivery."""
    s = _series(spark, sf)
    path = scratch_path(spark, "minute")
    first = s.withColumn("ingested_at", F.col("time_utc") + F.expr("INTERVAL 5 MINUTES"))
    again = s.where("hour(time_utc) % 3 = 0").withColumn("value", F.col("value") + 1).withColumn(
        "ingested_at", F.col("time_utc") + F.expr("INTERVAL 2 HOURS"))
    first.unionByName(again).write.mode("append").parquet(path)
    return R.read_minute_metrics(spark, path).drop("ingested_at")


# ------------------------------------------------------------- rule packs (RL-01..RL-27)
from statsweep.plans import rules as RL  # noqa: E402
from statsweep.plans.registry import QUERIES as _Q  # noqa: E402


@query("io_eviction_baseline")
def q_io_eviction_baseline(spark, sf):
    """WN-08 input for RL-07: eviction rate over the key's week-1 average eviction rate."""
    io = IV.interval_metrics(B.b1_dataset(_t(spark, sf, "events"), "io"), "io", tiebreak=["event_id"])
    keys = list(IV.PRESETS["io"].keys)
    base = io.where(F.col("source_collected_at") < F.lit("2024-01-08").cast("timestamp_ntz")).groupBy(*keys).agg(
        F.avg("evictions_per_second").alias("baseline_evictions_per_second"))
    j = io.join(base, keys, "left")
    return j.select(*keys, "event_id", "source_collected_at", "evictions_per_second", "baseline_evictions_per_second",
                    F.when(F.col("baseline_evictions_per_second") > 0,
                           F.col("evictions_per_second") / F.col("baseline_evictions_per_second"))
                    .alias("eviction_vs_baseline"))


# inputs whose own query is a top-k report: rules see every row
UNCUT = {
    "relation_cache": lambda spark, sf: CA.relation_cache_report(_relcache(spark, sf), k=None),
    "plan_inventory": lambda spark, sf: QS.plan_inventory(_plan_runtime(spark, sf), B.plans(_t(spark, sf, "part")),
                                                          k=None),
}


def _rules_query(pack: RL.Pack):
    def build(spark, sf):
        return RL.run_pack(UNCUT.get(pack.source, _Q[pack.source])(spark, sf), pack)

    build.__name__ = f"q_rules_{pack.source}"
    build.__doc__ = f"{pack.pack_id}: rule pack over '{pack.source}' ({', '.join(r.rule_id for r in pack.rules)})."
    query(f"rules_{pack.source}")(build)


for _p in RL.PACKS:
    _rules_query(_p)


# ------------------------------------------------------------- streaming (SM-01..SM-09)
from statsweep.streaming import reorder as SO  # noqa: E402
from statsweep.streaming import state as ST  # noqa: E402
from statsweep.streaming.runner import StreamJob  # noqa: E402


def _two_landings(df: DataFrame, time_col: str, split: str = SPLIT_AT):
    """Two landed slices of a stand-in stream: rows before ``split`` and rows from it on."""
    cut = F.col(time_col) < F.lit(split).cast("timestamp_ntz")
    return df.where(cut), df.where(~cut)


@query("stream_counter_delta")
def q_stream_counter_delta(spark, sf):
    """SM-01: counter deltas on a stream; landed in two slices, the second run resumes from checkpointed state.

    The idle-key TTL (30 days) is longer than any gap in this history, so the result equals batch WN-01."""
    s = B.counter_samples(_t(spark, sf, "events"))
    job = StreamJob(spark, "counter-delta")
    first, second = _two_landings(s, "source_collected_at")
    for part in (first, second):
        job.land(part)
        stream = job.source(s.schema)
        job.run(ST.stream_counter_delta(stream, ["server_id", "user_id"], "counter", idle_ttl="30 days"))
    return job.result().select(
        "server_id", "user_id", "event_id", "source_collected_at", "stats_reset", "counter",
        "counter_kind", "counter_delta", "counter_rate", "elapsed_seconds")


@query("stream_counter_delta_reordered")
def q_stream_counter_delta_reordered(spark, sf):
    """SM-01, samples out of order: every fifth sample of the 8 days before the split lands after it; the reorder buffer puts them
    back, so the deltas equal batch WN-01. A last sample of no server far ahead moves event time past all of them."""
    s = B.counter_samples(_t(spark, sf, "events"))
    job = StreamJob(spark, "counter-reorder")
    split = F.lit(SPLIT_AT).cast("timestamp_ntz")
    late = (F.col("source_collected_at") >= split - F.expr("INTERVAL 8 DAYS")) & (F.col("event_id") % 5 == 0)
    first = (F.col("source_collected_at") < split) & ~late
    end = s.agg((F.max("source_collected_at") + F.expr("INTERVAL 60 DAYS")).alias("source_collected_at"))
    writer = SW.write_multi(SO.late_and_deltas(), job.sink)
    for part in (s.where(first), s.where(~first).unionByName(end, allowMissingColumns=True)):
        job.land(part)
        job.run(SO.stream_counter_delta_reordered(job.source(s.schema, max_files=64), ["server_id", "user_id"], "counter", hold="9 days",
                                                  idle_ttl="400 days", watermark="30 days"), foreach_batch=writer, rocksdb=True)
    deltas = SW.read_committed(spark, job.sink, "deltas", SO.delta_schema(s.schema, ["counter"]))
    return deltas.select(
        "server_id", "user_id", "event_id", "source_collected_at", "stats_reset", "counter",
        "counter_kind", "counter_delta", "counter_rate", "elapsed_seconds")


@query("fire_triggers")
def q_fire_triggers(spark, sf):
    """SM-02 batch form: conditional follow-up events with per-target cooldown from the last fired event."""
    cand = ST.trigger_candidates(B.trigger_samples(spark, _t(spark, sf, "events")))
    return ST.fire_triggers(cand)


@query("stream_fire_triggers")
def q_stream_fire_triggers(spark, sf):
    """SM-02 stream form: same events from two landed slices, last fired time kept in state."""
    samples = B.trigger_samples(spark, _t(spark, sf, "events"))
    job = StreamJob(spark, "triggers")
    first, second = _two_landings(samples, "ts")
    for part in (first, second):
        job.land(part)
        job.run(ST.stream_fire_triggers(ST.trigger_candidates(job.source(samples.schema))))
    return job.result(ST.FIRED_SCHEMA)


from statsweep.streaming import windows as SW  # noqa: E402


def _hourly_aggs():
    return [F.count(F.lit(1)).alias("events"), F.sum(F.round(F.col("value") * 100).cast("long")).alias("cents"),
            F.max("value").alias("max_value")]


def _stream_hourly(spark, sf, name):
    ev = _t(spark, sf, "events").withColumn("server_id", F.concat(F.lit("srv-"), (F.col("user_id") % 2).cast("string")))
    return ev, StreamJob(spark, name)


@query("stream_incremental")
def q_stream_incremental(spark, sf):
    """SM-03: window wait rows read exactly once across two runs (checkpointed progress), joined to runtime."""
    w, rt = _waits(spark, sf)
    job = StreamJob(spark, "incremental")
    ragg = QS.runtime_by_window(rt).select(*QS.RUNTIME_KEYS, "runtime_calls")
    first, second = _two_landings(w, "end_time")
    for part in (first, second):
        job.land(part)
        job.run(job.source(w.schema).join(ragg, list(QS.RUNTIME_KEYS), "left"))
    return job.result()


@query("tumbling_summary")
def q_tumbling_summary(spark, sf):
    """SM-04: hourly tumbling summaries per server over the event stream (two landed slices)."""
    ev, job = _stream_hourly(spark, sf, "tumbling")
    first, second = _two_landings(ev, "ts")
    sink = os.path.join(job.sink, "summary")
    for part in (first, second):
        job.land(part)
        job.run(SW.tumbling_summary(job.source(ev.schema), "ts", ["server_id"], "1 hour", _hourly_aggs()),
                "update", SW.batch_appender(sink))
    return SW.latest_per_key(spark, sink, ["server_id", "window_start"])


@query("sliding_threshold")
def q_sliding_threshold(spark, sf):
    """SM-05: 3-hour windows sliding by 1 hour over the metric series; average at or above 80 with all three hours there."""
    s = _series(spark, sf)
    job = StreamJob(spark, "sliding")
    sink = os.path.join(job.sink, "sliding")
    first, second = _two_landings(s, "time_utc")
    for part in (first, second):
        job.land(part)
        job.run(SW.sliding_threshold(job.source(s.schema), "time_utc", list(SE.SERIES), "value", "3 hours",
                                     "1 hour", 80.0, 3, CADENCE_S), "update", SW.batch_appender(sink))
    out = SW.latest_per_key(spark, sink, [*SE.SERIES, "window_start"])
    return out.withColumn("avg_value", F.round("avg_value", 6))


@query("blocking_episodes")
def q_blocking_episodes(spark, sf):
    """SM-06: lock-wait episodes per session (purchases as lock waits), ending after a 12-hour gap."""
    ev = _t(spark, sf, "events").where(F.col("event_type") == "purchase").select(
        F.concat(F.lit("srv-"), (F.col("user_id") % 2).cast("string")).alias("server_id"),
        F.col("user_id").alias("pid"), "ts", F.col("value").alias("wait_seconds"))
    job = StreamJob(spark, "episodes")
    first, second = _two_landings(ev, "ts")
    # later samples with nothing blocked: the sampling goes on and moves event time forward
    quiet = ev.groupBy("server_id").agg((F.max("ts") + F.expr("INTERVAL 2 DAYS")).alias("ts")).select(
        "server_id", F.lit(None).cast("long").alias("pid"), "ts", F.lit(None).cast("double").alias("wait_seconds"))
    for part in (first, second, quiet, quiet.withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 DAY"))):
        job.land(part)
        job.run(SW.blocking_episodes(job.source(ev.schema), "ts", ["server_id", "pid"], "wait_seconds", "12 hours"))
    return job.result()


@query("stream_dedupe")
def q_stream_dedupe(spark, sf):
    """SM-07: runs landed with re-delivered copies come out once per run id."""
    r = B.runs(_t(spark, sf, "events"))
    job = StreamJob(spark, "dedupe")
    first, second = _two_landings(r, "started_at")
    job.land(first.unionByName(first.where("event_id % 4 = 0")))
    job.run(SW.stream_dedupe(job.source(r.schema), ["run_id"], "started_at"))
    job.land(second.unionByName(second.where("event_id % 3 = 0")))
    job.run(SW.stream_dedupe(job.source(r.schema), ["run_id"], "started_at"))
    return job.result().select("run_id", "query_id", "server_id", "started_at", "completed_at", "status")


@query("late_backfill")
def q_late_backfill(spark, sf):
    """SM-08: hourly summaries; rows landed after the 2-hour watermark are dropped by the stream and
    their windows are recomputed in batch, giving the complete summary."""
    ev, job = _stream_hourly(spark, sf, "backfill")
    split = F.lit(SPLIT_AT).cast("timestamp_ntz")
    held = (F.col("event_id") % 10 == 0) & (F.col("ts") < split)
    landed = ev.withColumn("arrived_at", F.when(held, F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))
                           .otherwise(F.col("ts")))
    sink = os.path.join(job.sink, "summary")
    for part in (landed.where(~held & (F.col("ts") < split)), landed.where(F.col("ts") >= split),
                 landed.where(held)):
        job.land(part)
        job.run(SW.tumbling_summary(job.source(landed.schema), "ts", ["server_id"], "1 hour", _hourly_aggs(),
                                    watermark="2 hours"), "update", SW.batch_appender(sink))
    summary = SW.latest_per_key(spark, sink, ["server_id", "window_start"])
    all_landed = spark.read.schema(landed.schema).option("recursiveFileLookup", "true").parquet(job.landing)
    late = SW.late_rows(all_landed, "ts", "arrived_at", 2 * 3600)

    def recompute(rows):
        return rows.groupBy("server_id", "window_start").agg(*_hourly_aggs()).withColumn(
            "window_end", F.col("window_start") + F.expr("INTERVAL 1 HOUR"))

    return SW.late_backfill(summary, all_landed, late, "ts", lambda c: B.trunc("hour", c), ["server_id"], recompute)


@query("write_multi")
def q_write_multi(spark, sf):
    """SM-09: each micro-batch of landed rows to a rows dataset and a run ledger, all or nothing: the first batch fails
    between the two and is replayed."""
    rows = B.landed_rows(_t(spark, sf, "events"))
    job = StreamJob(spark, "multi")
    targets = {"rows": lambda df: df, "ledger": LG.run_ledger}
    fallback = os.path.join(job.sink, "kept")
    down = iter([True])

    def failing(df):  # the second dataset is down for the first batch
        if next(down, False):
            raise RuntimeError("dataset down")
        return LG.run_ledger(df)

    writer = SW.write_multi({**targets, "ledger": failing}, job.sink, fallback=fallback)
    early = F.col("query_id").isin("Q00", "Q01", "Q02")
    for part in (rows.where(early), rows.where(~early)):
        job.land(part)
        job.run(job.source(rows.schema), foreach_batch=writer)
    SW.replay_fallback(spark, targets, job.sink, fallback, rows.schema)
    return SW.read_committed(spark, job.sink, "ledger", LG.run_ledger(rows).schema).drop("batch_id")


def _daily_cpu(spark, ev):
    """Daily mean CPU % of the metric series, summed in integer hundredths (order-independent)."""
    cents = F.round(F.col("value") * 100).cast("long")
    return B.metric_series(spark, ev).groupBy(B.trunc("day", "time_utc").alias("ts")).agg(
        (F.sum(cents) / F.count("value") / 100).alias("cpu_percent"))


@query("cpu_efficiency")
def q_cpu_efficiency(spark, sf):
    """AG-24 efficiency: successful requests per second per CPU percent, per run day."""
    ev = _t(spark, sf, "events")
    daily = B.load_daily(spark, ev).select("test_run_id", "ts", "successful_rps")
    cpu = _daily_cpu(spark, ev)
    return CP.efficiency(daily, cpu, ["ts"])


@query("wait_dictionary")
def q_wait_dictionary(spark, sf):
    """PRJ-17: wait event dictionary rows, one per version, type and event."""
    return V.wait_dictionary_rows(B.wait_dictionary(spark, _t(spark, sf, "events")))


@query("parallel_group_share")
def q_parallel_group_share(spark, sf):
    """RL-02 input: each parallel query's share of the sample's active parallel workers (JN-06 + JN-08)."""
    s, settings = _sessions(spark, sf)
    totals = A.activity_summary(s, settings).select(*A.SAMPLE, "active_parallel_workers")
    g = A.attach_scalars(A.parallel_groups(s).drop("workers"), totals)
    return g.select(*A.SAMPLE, "leader_pid", "query_id", "launched_worker_count", "active_parallel_workers",
                    S.safe_percent("launched_worker_count", "active_parallel_workers").alias("worker_pool_share_percent"))


@query("allocation_changes")
def q_allocation_changes(spark, sf):
    """WN-10 input for RL-15: each allocation's total size against its previous sample."""
    a = CA.allocation_shares(B.allocations(_t(spark, sf, "orders")))
    keys = ["server_id", "allocation_name"]
    tot = a.groupBy(*keys, "source_collected_at").agg(F.sum("allocated_size").alias("allocated_size"))
    out = SE.changes(tot, "allocated_size", keys, "source_collected_at", min_pct=0.0)
    return out.where(F.col("previous_value").isNotNull()).select(
        *keys, "source_collected_at", "allocated_size", "previous_value",
        F.round("change_percent", 6).alias("change_percent"))


@query("maintenance_stalled")
def q_maintenance_stalled(spark, sf):
    """WN-09 input for RL-12: maintenance progress unchanged for 5 minutes while running."""
    m = q_maintenance_progress(spark, sf)
    out = SE.stalled(m, "heap_blks", 300, ["server_id", "operation_type", "pid"], "source_collected_at")
    return out.select("server_id", "operation_type", "pid", "source_collected_at", "heap_blks", "unchanged_seconds",
                      "stalled")


for _p in (
    RL.Pack("RL-01p", "unified_configuration", ("server_id", "setting_scope", "database_name", "role_name",
                                                "parameter_name"), None, (
        RL.Rule("pending_restart", "CASE WHEN pending_restart THEN 1 ELSE 0 END", (("high", 1.0),), ">="),)),
    RL.Pack("RL-02g", "parallel_group_share", ("server_id", "leader_pid"), "source_collected_at", (
        RL.Rule("one_query_worker_share", "worker_pool_share_percent", (("warning", 50.0), ("high", 75.0)), ">="),)),
    RL.Pack("RL-12s", "maintenance_stalled", ("server_id", "operation_type", "pid"), "source_collected_at", (
        RL.Rule("maintenance_stalled", "CASE WHEN stalled THEN 1 ELSE 0 END", (("high", 1.0),), ">="),)),
    RL.Pack("RL-15c", "allocation_changes", ("server_id", "allocation_name"), "source_collected_at", (
        RL.Rule("allocation_change", "abs(change_percent)", (("warning", 5.0), ("high", 10.0))),)),
    RL.Pack("RL-19v", "plan_variability", ("server_id", "db_id", "query_id"), None, (
        RL.Rule("several_plans", "plan_count", (("warning", 1.0),)),
        RL.Rule("plan_mean_spread", "slowest_to_fastest_ratio", (("high", 2.0),)),)),
):
    RL.EXTRA_PACKS.append(_p)
    _rules_query(_p)


@query("io_rows")
def q_io_rows(spark, sf):
    """PRJ-17: typed cluster I/O rows."""
    return V.io_rows(B.b1_dataset(_t(spark, sf, "events"), "io"))


@query("slru_rows")
def q_slru_rows(spark, sf):
    """PRJ-17: SLRU cache rows."""
    return V.slru_rows(B.b1_dataset(_t(spark, sf, "events"), "slru"))


@query("pgss_health")
def q_pgss_health(spark, sf):
    """PRJ-17: statement-store health rows (deallocations, reset time)."""
    return V.pgss_health(B.b1_dataset(_t(spark, sf, "events"), "statement_store"))


@query("stream_database_interval")
def q_stream_database_interval(spark, sf):
    """SM-01 over IV-01: all database counters' deltas on a stream (two landed slices), then the IV-01 metrics."""
    src = B.b1_dataset(_t(spark, sf, "events"), "database")
    p = IV.PRESETS["database"]
    job = StreamJob(spark, "database-interval")
    first, second = _two_landings(src, "source_collected_at")
    for part in (first, second):
        job.land(part)
        job.run(ST.stream_counter_delta(job.source(src.schema), p.keys, p.counters, idle_ttl="30 days"))
    d = job.result()
    metrics = p.metrics(lambda c: F.col(f"{c}_delta"), F.col("elapsed_seconds"))
    return d.select(*p.keys, "event_id", "source_collected_at", "elapsed_seconds",
                    *[v.alias(k) for k, v in metrics.items()])


@query("efficiency_change")
def q_efficiency_change(spark, sf):
    """RL-26 input: successful RPS per CPU % per run day, after vs baseline on the same day of the run (JN-17)."""
    ev = _t(spark, sf, "events")
    daily = B.load_daily(spark, ev).select("test_run_id", "phase_name", "ts", "day_index", "successful_rps")
    cpu = _daily_cpu(spark, ev)
    eff = CP.efficiency(daily, cpu, ["ts"]).withColumnRenamed("successful_rps_per_cpu_percent", "rps_per_cpu")
    return J.compare_runs(eff.where("test_run_id = 'baseline'"), eff.where("test_run_id = 'after'"),
                          ["phase_name", "day_index"], ["rps_per_cpu"])


@query("worker_limits")
def q_worker_limits(spark, sf):
    """RL-01 input: per server, the three worker limits side by side (pivot of effective settings)."""
    _, st, _ = _cfg(spark, sf)
    names = ["max_worker_processes", "max_parallel_workers", "max_parallel_workers_per_gather"]
    return (CF.select_parameters(st, names).groupBy("server_id").pivot("name", names)
            .agg(F.first(F.col("setting").try_cast("long"))))


@query("new_server_age")
def q_new_server_age(spark, sf):
    """RL-23 input: pooler server connections in state 'new' and their age at the sample."""
    s = B.pool_servers(_t(spark, sf, "events"))
    from statsweep.operators.deltas import seconds_between

    return s.where(F.col("state") == "new").select(
        "server_id", "source_collected_at", "database", "user", "remote_pid",
        seconds_between("source_collected_at", "connect_time").alias("new_state_seconds"))


for _p in (
    RL.Pack("RL-26e", "efficiency_change", ("phase_name", "day_index"), None, (
        RL.Rule("efficiency_decline", "rps_per_cpu_change_percent", (("warning", -10.0), ("high", -20.0)), "<"),)),
    RL.Pack("RL-01w", "worker_limits", ("server_id",), None, (
        RL.Rule("worker_limits_inconsistent", "CASE WHEN max_parallel_workers > max_worker_processes THEN 2 "
                "WHEN max_parallel_workers_per_gather > max_parallel_workers THEN 1 ELSE 0 END",
                (("warning", 1.0), ("high", 2.0)), ">="),)),
    RL.Pack("RL-23n", "new_server_age", ("server_id", "database", "user", "remote_pid"), "source_collected_at", (
        RL.Rule("server_stuck_new", "new_state_seconds", (("warning", 30.0), ("high", 300.0))),)),
):
    RL.EXTRA_PACKS.append(_p)
    _rules_query(_p)


@query("query_phase_shares")
def q_query_phase_shares(spark, sf):
    """AG-24: JIT and planning shares per phase from IV-02 statement deltas (JN-14 phases)."""
    q = IV.interval_metrics(B.b1_dataset(_t(spark, sf, "events"), "query"), "query", tiebreak=["event_id"])
    d = SE.assign_phase(q, _phases(spark, sf).drop("test_run_id"), "source_collected_at")
    return CP.query_phase_shares(d, ["phase_name"])


# ----------------------------------------------------------- expected samples, rules over two aligned sources
@query("activity_summary_expected")
def q_activity_summary_expected(spark, sf):
    """JN-07: activity summary over every sample the run ledger owes; settings are the latest known, samples without sessions are zero rows."""
    ev = _t(spark, sf, "events")
    s, settings = _sessions(spark, sf)
    spine = LG.expected_samples(B.runs(ev), CADENCE_S)
    names = [c for c in settings.columns if c not in A.SAMPLE]
    known = J.align_asof(spine, settings, ["server_id"], "source_collected_at", "source_collected_at", names)
    return A.activity_summary(s, known.select(*A.SAMPLE, *names))


@query("demand_with_cpu")
def q_demand_with_cpu(spark, sf):
    """RL-26 input: running demand per vCore with the server's CPU of the same hour (JN-16, one hour of tolerance; resource n is server n, a sixteenth of B14's vCores)."""
    cpu = _series(spark, sf).select(F.concat(F.lit("srv-"), F.substring("resource_id", 4, 9)).alias("server_id"),
                                    (F.col("time_utc") + F.expr("INTERVAL 1 HOUR")).alias("known_at"), F.col("value").alias("cpu_percent"))
    demand = _demand(spark, sf, divide=16).select("server_id", "source_collected_at", "running_demand_per_vcore")
    return J.align_asof(demand, cpu, ["server_id"], "source_collected_at", "known_at", ["cpu_percent"], 3600).select(
        *demand.columns, "cpu_percent")


@query("pool_budget")
def q_pool_budget(spark, sf):
    """RL-20 input: a server's pooler connections against the connection limit in force there (JN-16), one connection reserved."""
    ev = _t(spark, sf, "events")
    totals = PL.pool_totals(B.pool_snapshot(spark, ev)).where("grouping_level = 7").select(
        "server_id", "source_collected_at", "pgbouncer_server_connections")
    j = J.align_asof(totals, B.connection_limits(spark, ev), ["server_id"], "source_collected_at", "effective_at", ["max_connections"])
    return j.select(*totals.columns, "max_connections", S.safe_percent(
        "pgbouncer_server_connections", F.col("max_connections") - 1).alias("budget_percent"))


@query("cache_hit_with_disk")
def q_cache_hit_with_disk(spark, sf):
    """RL-04 input: cache hit ratio of database intervals with the disk use known at the time (JN-16, two hours of tolerance)."""
    d = _Q["database_interval"](spark, sf).select("server_id", "datid", "event_id", "source_collected_at", "cache_hit_percent")
    return J.align_asof(d, B.disk_use(spark, _t(spark, sf, "events")), ["server_id"], "source_collected_at", "known_at",
                        ["disk_percent"], 7200).select(*d.columns, "disk_percent")


for _p in (
    RL.Pack("RL-26c", "demand_with_cpu", ("server_id",), "source_collected_at", (
        RL.Rule("demand_and_cpu", "running_demand_per_vcore", (("warning", 0.7),), ">=", guard="cpu_percent >= 70", sustain_s=300),
        RL.Rule("demand_and_cpu_large", "running_demand_per_vcore", (("high", 1.0),), ">=", guard="cpu_percent >= 80", sustain_s=300),
        RL.Rule("demand_saturated", "running_demand_per_vcore", (("critical", 1.5),), ">=", guard="cpu_percent >= 90"),)),
    RL.Pack("RL-20b", "pool_budget", ("server_id",), "source_collected_at", (
        RL.Rule("pool_over_budget", "budget_percent", (("critical", 100.0),)),)),
    RL.Pack("RL-04d", "cache_hit_with_disk", ("server_id", "datid"), "source_collected_at", (
        RL.Rule("cache_hit_and_disk", "cache_hit_percent", (("critical", 95.0),), "<", guard="disk_percent >= 80", sustain_s=900),),
            ("event_id",)),
):
    RL.EXTRA_PACKS.append(_p)
    _rules_query(_p)
