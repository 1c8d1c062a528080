"""Interval metrics (IV-01 to IV-09): WN-01 deltas of all listed counters, then ratios.

Each preset names the natural key of its dataset, its cumulative counters, its
reset column and the derived metrics. A ratio is null unless its denominator
is positive; a rate is null unless time elapsed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statsweep.operators.deltas import counter_delta

D = Callable[[str], Column]


def per_second(x: Column, elapsed: Column) -> Column:
    return F.when(elapsed > 0, x / elapsed)


def pct(num: Column, den: Column) -> Column:
    return F.when(den > 0, F.lit(100.0) * num / den)


def ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den)


@dataclass(frozen=True)
class Preset:
    name: str
    keys: tuple[str, ...]
    counters: tuple[str, ...]
    reset_col: str | None
    metrics: Callable[[D, Column], dict[str, Column]]


def _database(d: D, el: Column) -> dict[str, Column]:
    xacts = d("xact_commit") + d("xact_rollback")
    accesses = d("blks_hit") + d("blks_read")
    return {
        "tps": per_second(xacts, el),
        "rollback_percent": pct(d("xact_rollback"), xacts),
        "cache_hit_percent": F.when(accesses >= 10000, pct(d("blks_hit"), accesses)),
        "temp_bytes_per_second": per_second(d("temp_bytes"), el),
        "deadlock_count": d("deadlocks"),
        "read_io_time_ms_per_second": per_second(d("blk_read_time"), el),
        "write_io_time_ms_per_second": per_second(d("blk_write_time"), el),
    }


JIT_PARTS = ("jit_generation_time", "jit_inlining_time", "jit_optimization_time",
             "jit_emission_time", "jit_deform_time")


def _query(d: D, el: Column) -> dict[str, Column]:
    jit = d(JIT_PARTS[0])
    for p in JIT_PARTS[1:]:
        jit = jit + d(p)
    return {
        "calls_per_second": per_second(d("calls"), el),
        "avg_exec_ms_interval": ratio(d("total_exec_time"), d("calls")),
        "avg_plan_ms_interval": ratio(d("total_plan_time"), d("plans")),
        "plan_to_call_ratio": ratio(d("plans"), d("calls")),
        "planning_share_percent": pct(d("total_plan_time"), d("total_plan_time") + d("total_exec_time")),
        "jit_time_interval": jit,
        "jit_overhead_percent": pct(jit, d("total_exec_time")),
        "jit_ms_per_call": ratio(jit, d("calls")),
        "worker_launch_fulfillment_percent": pct(d("parallel_workers_launched"), d("parallel_workers_to_launch")),
        "plan_time_interval": d("total_plan_time"),
        "workers_to_launch_interval": d("parallel_workers_to_launch"),
    }


def _statement_store(d: D, el: Column) -> dict[str, Column]:
    return {"deallocations": d("dealloc")}


def _io(d: D, el: Column) -> dict[str, Column]:
    return {
        "read_bytes_per_second": per_second(d("read_bytes"), el),
        "write_bytes_per_second": per_second(d("write_bytes"), el),
        "extend_bytes_per_second": per_second(d("extend_bytes"), el),
        "io_hit_percent": pct(d("hits"), d("hits") + d("reads")),
        "evictions_per_second": per_second(d("evictions"), el),
    }


def _checkpoint(d: D, el: Column) -> dict[str, Column]:
    return {
        "requested_checkpoint_percent": pct(d("num_requested"), d("num_requested") + d("num_timed")),
        "checkpoint_busy_percent": pct(d("write_time") + d("sync_time"), el * 1000),
        "wal_bytes_per_second": per_second(d("wal_bytes"), el),
    }


def _writer_views(d: D, el: Column) -> dict[str, Column]:
    return {
        **_checkpoint(d, el),
        "cleaned_buffers_per_second": per_second(d("buffers_clean"), el),
        "backend_buffers_per_second": per_second(d("buffers_backend"), el),
        "backend_write_percent": pct(d("buffers_backend"), d("buffers_backend") + d("buffers_clean")),
        "wal_buffers_full_per_second": per_second(d("wal_buffers_full"), el),
    }


def _table(d: D, el: Column) -> dict[str, Column]:
    return {
        "rows_read_per_seq_scan": ratio(d("seq_tup_read"), d("seq_scan")),
        "hot_update_percent": pct(d("n_tup_hot_upd"), d("n_tup_upd")),
        "dead_tuple_percent": pct(F.col("n_dead_tup"), F.col("n_live_tup") + F.col("n_dead_tup")),
        "heap_hit_percent": pct(d("heap_blks_hit"), d("heap_blks_hit") + d("heap_blks_read")),
        "index_hit_percent": pct(d("idx_blks_hit"), d("idx_blks_hit") + d("idx_blks_read")),
    }


def _index(d: D, el: Column) -> dict[str, Column]:
    return {
        "idx_scans": d("idx_scan"),
        "index_hit_percent": pct(d("idx_blks_hit"), d("idx_blks_hit") + d("idx_blks_read")),
    }


def _slru(d: D, el: Column) -> dict[str, Column]:
    acc = d("blks_hit") + d("blks_read")
    return {
        "slru_accesses": acc,
        "slru_hit_percent": pct(d("blks_hit"), acc),
        "slru_reads_per_second": per_second(d("blks_read"), el),
        "slru_writes_per_second": per_second(d("blks_written"), el),
        "slru_flushes_per_second": per_second(d("flushes"), el),
    }


def _pooler(d: D, el: Column) -> dict[str, Column]:
    return {
        "xact_per_second": per_second(d("total_xact_count"), el),
        "query_per_second": per_second(d("total_query_count"), el),
        "server_assignment_per_second": per_second(d("total_server_assignment_count"), el),
        "received_bytes_per_second": per_second(d("total_received"), el),
        "sent_bytes_per_second": per_second(d("total_sent"), el),
        "wait_ms_per_assigned_client": ratio(d("total_wait_time") / 1000.0, d("total_server_assignment_count")),
        "query_ms_per_query": ratio(d("total_query_time") / 1000.0, d("total_query_count")),
        "xact_ms_per_xact": ratio(d("total_xact_time") / 1000.0, d("total_xact_count")),
        "server_assignment_per_xact": ratio(d("total_server_assignment_count"), d("total_xact_count")),
    }


PRESETS: dict[str, Preset] = {
    p.name: p
    for p in [
        Preset("database", ("server_id", "datid"),
               ("xact_commit", "xact_rollback", "blks_hit", "blks_read", "temp_bytes", "deadlocks",
                "blk_read_time", "blk_write_time"), "stats_reset", _database),
        Preset("query", ("server_id", "dbid", "userid", "queryid", "toplevel"),
               ("calls", "plans", "total_exec_time", "total_plan_time", *JIT_PARTS,
                "parallel_workers_to_launch", "parallel_workers_launched"), "stats_since", _query),
        Preset("statement_store", ("server_id",), ("dealloc",), "stats_reset", _statement_store),
        Preset("io", ("server_id", "backend_type", "object", "context"),
               ("reads", "read_bytes", "writes", "write_bytes", "extends", "extend_bytes", "hits", "evictions"),
               "stats_reset", _io),
        Preset("checkpoint", ("server_id", "source_view"),
               ("num_timed", "num_requested", "write_time", "sync_time", "wal_bytes"), "stats_reset", _checkpoint),
        Preset("table", ("server_id", "database_name", "relid"),
               ("seq_scan", "seq_tup_read", "n_tup_upd", "n_tup_hot_upd", "heap_blks_hit", "heap_blks_read",
                "idx_blks_hit", "idx_blks_read"), None, _table),
        Preset("index", ("server_id", "database_name", "indexrelid"),
               ("idx_scan", "idx_blks_hit", "idx_blks_read"), None, _index),
        Preset("slru", ("server_id", "name"),
               ("blks_hit", "blks_read", "blks_written", "flushes"), "stats_reset", _slru),
        Preset("pooler", ("server_id", "pb_command", "database"),
               ("total_xact_count", "total_query_count", "total_server_assignment_count", "total_received",
                "total_sent", "total_xact_time", "total_query_time", "total_wait_time"), None, _pooler),
    ]
}

# IV-05 over the three views apart: a row has the counters of its own view, the others are null and so are their metrics
WRITER_VIEWS = Preset("writer_views", ("server_id", "source_view"),
                      ("buffers_clean", "buffers_backend", "num_timed", "num_requested", "write_time", "sync_time", "wal_bytes",
                       "wal_buffers_full"), "stats_reset", _writer_views)


def interval_metrics(
    df: DataFrame,
    preset: str | Preset,
    time_col: str = "source_collected_at",
    tiebreak: Sequence[str] = (),
    keep_deltas: bool = True,
    **delta_kw,
) -> DataFrame:
    """Deltas of the preset's counters per natural key, then its derived metrics."""
    p = PRESETS[preset] if isinstance(preset, str) else preset
    out = counter_delta(df, p.keys, p.counters, time_col=time_col, reset_col=p.reset_col,
                        tiebreak=tiebreak, **delta_kw)
    el = F.col("elapsed_seconds")
    metrics = p.metrics(lambda c: F.col(f"{c}_delta"), el)
    out = out.select("*", *[v.alias(k) for k, v in metrics.items()])
    if not keep_deltas:
        out = out.drop(*[f"{c}_{s}" for c in p.counters for s in ("kind", "rate")])
    return out


def database_interval(df: DataFrame, **kw) -> DataFrame:
    return interval_metrics(df, "database", **kw)


def query_interval(df: DataFrame, **kw) -> DataFrame:
    return interval_metrics(df, "query", **kw)


def statement_store_interval(df: DataFrame, **kw) -> DataFrame:
    out = interval_metrics(df, "statement_store", **kw)
    return out.withColumn("is_reset", F.col("dealloc_kind") == "reset")


def io_interval(df: DataFrame, **kw) -> DataFrame:
    return interval_metrics(df, "io", **kw)


def checkpoint_interval(df: DataFrame, **kw) -> DataFrame:
    return interval_metrics(df, "checkpoint", **kw)


def table_interval(df: DataFrame, **kw) -> DataFrame:
    return interval_metrics(df, "table", **kw)


def index_interval(df: DataFrame, **kw) -> DataFrame:
    return interval_metrics(df, "index", **kw)


def slru_interval(df: DataFrame, **kw) -> DataFrame:
    return interval_metrics(df, "slru", **kw)


def pooler_interval(df: DataFrame, **kw) -> DataFrame:
    return interval_metrics(df, "pooler", **kw)
