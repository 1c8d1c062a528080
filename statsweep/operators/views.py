"""Single-view projections and maintenance progress (PRJ-09, PRJ-10, PRJ-17, JN-11).

Each is a typed ``select`` + ``filter`` that Catalyst pushes into the scan, plus
one tagged union with a left join for maintenance progress.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statsweep.functions.scalars import coalesce_versions, total_jit_time
from statsweep.operators.deltas import seconds_between
from statsweep.sources.readers import union_tagged, unpack_payload

SAMPLE = ("server_id", "source_collected_at")

# Template databases left out of database counters.
TEMPLATE_DATABASES = ("template0", "template1")

# Version-tolerant statement-statistics fields: (output, candidate JSON fields, type, default).
VERSIONED_FIELDS = (
    ("shared_or_legacy_blk_read_time", ("blk_read_time", "shared_blk_read_time"), "double", 0.0),
    ("shared_or_legacy_blk_write_time", ("blk_write_time", "shared_blk_write_time"), "double", 0.0),
    ("temp_blk_read_time", ("temp_blk_read_time",), "double", 0.0),
    ("temp_blk_write_time", ("temp_blk_write_time",), "double", 0.0),
    ("wal_buffers_full", ("wal_buffers_full",), "bigint", 0),
    ("jit_functions", ("jit_functions",), "bigint", 0),
    ("jit_generation_time", ("jit_generation_time",), "double", 0.0),
    ("jit_inlining_count", ("jit_inlining_count",), "bigint", 0),
    ("jit_inlining_time", ("jit_inlining_time",), "double", 0.0),
    ("jit_optimization_count", ("jit_optimization_count",), "bigint", 0),
    ("jit_optimization_time", ("jit_optimization_time",), "double", 0.0),
    ("jit_emission_count", ("jit_emission_count",), "bigint", 0),
    ("jit_emission_time", ("jit_emission_time",), "double", 0.0),
    ("jit_deform_count", ("jit_deform_count",), "bigint", 0),
    ("jit_deform_time", ("jit_deform_time",), "double", 0.0),
    ("parallel_workers_to_launch", ("parallel_workers_to_launch",), "bigint", None),
    ("parallel_workers_launched", ("parallel_workers_launched",), "bigint", None),
    ("stats_since", ("stats_since",), "timestamp_ntz", None),
    ("minmax_stats_since", ("minmax_stats_since",), "timestamp_ntz", None),
)


def database_counters(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """PRJ-17: database counters without null or template database names."""
    out = df.where(F.col("datname").isNotNull() & ~F.col("datname").isin(*TEMPLATE_DATABASES))
    return out.select(*cols) if cols else out


def io_rows(df: DataFrame) -> DataFrame:
    """PRJ-17: cluster I/O rows with their counters, typed."""
    return df.select(*SAMPLE, "backend_type", "object", "context",
                     *[F.col(c).cast("long").alias(c) for c in
                       ("reads", "read_bytes", "writes", "write_bytes", "extends", "extend_bytes", "hits",
                        "evictions")], "stats_reset")


def slru_rows(df: DataFrame) -> DataFrame:
    """PRJ-17: SLRU cache rows."""
    return df.select(*SAMPLE, "name", *[F.col(c).cast("long").alias(c) for c in
                                        ("blks_hit", "blks_read", "blks_written", "flushes")], "stats_reset")


def pgss_health(df: DataFrame) -> DataFrame:
    """PRJ-17: statement-store health: deallocations and reset time."""
    return df.select(*SAMPLE, F.col("dealloc").cast("long").alias("dealloc"), "stats_reset")


def wait_dictionary_rows(df: DataFrame) -> DataFrame:
    """PRJ-17: wait event dictionary, one row per version, type and event."""
    return df.select("server_version_num", "wait_event_type", "wait_event", "description").dropDuplicates(
        ["server_version_num", "wait_event_type", "wait_event"])


def versioned_fields(df: DataFrame, payload: str = "payload",
                     fields: Sequence[tuple] = VERSIONED_FIELDS) -> DataFrame:
    """PRJ-09: version-tolerant columns from a JSON payload: first non-empty candidate, typed, default."""
    return df.select("*", *[coalesce_versions(payload, cands, t, d).alias(name) for name, cands, t, d in fields])


def with_total_jit_time(df: DataFrame, out: str = "jit_total_time") -> DataFrame:
    """PRJ-10: sum of the five JIT timing columns."""
    return df.withColumn(out, total_jit_time())


def maintenance_progress(progress: Mapping[str, DataFrame], sessions: DataFrame,
                         fields: Mapping[str, str] | None = None) -> DataFrame:
    """JN-11: vacuum and analyze progress rows stacked with ``operation_type``, left join to sessions.

    ``progress`` maps operation type to rows ``(server_id, source_collected_at, pid, progress)``
    with ``progress`` the JSON of the progress view row; ``fields`` are typed out of it.
    """
    u = union_tagged(progress, "operation_type")
    if fields:
        u = unpack_payload(u, "progress", fields)
    s = sessions.select(*SAMPLE, "pid", "datname", "usename", "application_name", "wait_event_type", "wait_event",
                        "query_start")
    j = u.join(s, [*SAMPLE, "pid"], "left")
    return j.withColumn("operation_age_seconds", seconds_between("source_collected_at", "query_start")) \
        .drop("query_start")
