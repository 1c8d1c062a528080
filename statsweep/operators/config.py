"""Configuration family (PRJ-03 to PRJ-05, JN-13, JN-19).

Inputs: effective settings (``server_id, name, setting, unit, source, context,
pending_restart``), database/role overrides (``setdatabase, setrole, setconfig``),
routine settings (``proconfig``) and catalog objects. The allow-lists are fixed
values of the reference, held as small literal frames (bounded size, broadcast).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statsweep.functions.scalars import explode_settings, override_scope

# Parameters collected as memory/parallelism/statistics configuration.
CONFIG_PARAMETERS = (
    "track_activities", "track_counts", "track_io_timing", "track_wal_io_timing", "track_activity_query_size",
    "compute_query_id", "pg_stat_statements.max", "pg_stat_statements.track", "pg_stat_statements.track_planning",
    "pg_stat_statements.save", "pg_qs.query_capture_mode", "pg_qs.interval_length_minutes",
    "pg_qs.max_captured_queries", "pgms_wait_sampling.query_capture_mode", "pgms_wait_sampling.history_period",
    "metrics.collector_database_activity", "metrics.autovacuum_diagnostics", "max_connections", "shared_buffers",
    "effective_cache_size", "work_mem", "hash_mem_multiplier", "temp_buffers", "maintenance_work_mem",
    "autovacuum_work_mem", "logical_decoding_work_mem", "temp_file_limit", "log_temp_files", "max_worker_processes",
    "max_parallel_workers", "max_parallel_workers_per_gather", "max_parallel_maintenance_workers",
    "autovacuum_max_workers", "max_prepared_transactions", "huge_pages", "huge_page_size",
    "parallel_leader_participation", "parallel_setup_cost", "parallel_tuple_cost", "min_parallel_table_scan_size",
    "min_parallel_index_scan_size", "cpu_tuple_cost", "cpu_index_tuple_cost", "cpu_operator_cost", "seq_page_cost",
    "random_page_cost", "jit", "jit_above_cost", "jit_inline_above_cost", "jit_optimize_above_cost",
    "enable_gathermerge", "enable_parallel_append", "enable_parallel_hash",
)

# Lock and error logging parameters.
LOCK_LOGGING_PARAMETERS = (
    "deadlock_timeout", "log_lock_waits", "log_min_messages", "log_min_error_statement", "log_error_verbosity",
    "log_line_prefix",
)

# Catalog objects whose presence gates collection, and the version gate.
CAPABILITY_OBJECTS = (
    ("has_pg_stat_statements_extension", "extension", "pg_stat_statements"),
    ("has_pg_stat_statements_view", "view", "pg_stat_statements"),
    ("has_pg_stat_statements_info_view", "view", "pg_stat_statements_info"),
    ("has_pg_stat_io", "view", "pg_stat_io"),
    ("has_pg_stat_checkpointer", "view", "pg_stat_checkpointer"),
)
VERSION_GATE = 180000

UNIFIED_COLUMNS = ("server_id", "setting_scope", "database_name", "role_name", "object_identity", "parameter_name",
                   "parameter_value", "unit", "source", "context", "pending_restart")


def names_frame(spark: SparkSession, names: Sequence[str], col: str = "parameter_name") -> DataFrame:
    return spark.createDataFrame([(n,) for n in names], f"{col} string")


def select_parameters(df: DataFrame, names: Sequence[str], col: str = "name") -> DataFrame:
    """PRJ-03: keep an allow-list of parameter names (broadcast left semi join of a fixed list)."""
    allow = F.broadcast(names_frame(df.sparkSession, names, col))
    return df.join(allow, col, "left_semi")


def effective_configuration(settings: DataFrame, names: Sequence[str] = CONFIG_PARAMETERS) -> DataFrame:
    """Effective server settings in the unified shape (scope 'server_effective_for_collector')."""
    s = select_parameters(settings, names, "name")
    return s.select(
        "server_id", F.lit("server_effective_for_collector").alias("setting_scope"),
        F.col("database_name"), F.col("role_name"), F.lit(None).cast("string").alias("object_identity"),
        F.col("name").alias("parameter_name"), F.col("setting").alias("parameter_value"),
        "unit", "source", "context", "pending_restart")


def override_configuration(overrides: DataFrame, settings: DataFrame,
                           names: Sequence[str] = CONFIG_PARAMETERS) -> DataFrame:
    """Database/role overrides in the unified shape: explode, scope, allow-list, unit/context from settings."""
    x = explode_settings(overrides, "setconfig")
    x = override_scope(x)
    x = select_parameters(x, names, "parameter_name")
    meta = settings.select("server_id", F.col("name").alias("parameter_name"), "unit", "context")
    x = x.join(meta, ["server_id", "parameter_name"], "left")
    return x.select(
        "server_id", "setting_scope", "database_name", "role_name",
        F.lit(None).cast("string").alias("object_identity"), "parameter_name", "parameter_value", "unit",
        F.lit("pg_db_role_setting").alias("source"), "context", F.lit(None).cast("boolean").alias("pending_restart"))


def routine_configuration(routines: DataFrame, settings: DataFrame,
                          names: Sequence[str] = CONFIG_PARAMETERS) -> DataFrame:
    """Routine-local settings (``proconfig``) outside system schemas, in the unified shape."""
    from statsweep.functions.scalars import exclude_system

    r = exclude_system(routines.where(F.col("proconfig").isNotNull()), "schema")
    x = explode_settings(r, "proconfig")
    x = select_parameters(x, names, "parameter_name")
    meta = settings.select("server_id", F.col("name").alias("parameter_name"), "unit", "context")
    x = x.join(meta, ["server_id", "parameter_name"], "left")
    return x.select(
        "server_id", F.lit("routine_local_setting").alias("setting_scope"), "database_name",
        F.col("owner").alias("role_name"), F.col("signature").alias("object_identity"), "parameter_name",
        "parameter_value", "unit", F.lit("pg_proc.proconfig").alias("source"), "context",
        F.lit(None).cast("boolean").alias("pending_restart"))


def unify_configuration(effective: DataFrame, overrides: DataFrame, routine: DataFrame) -> DataFrame:
    """PRJ-04: one configuration dataset from the three sources."""
    return (effective.select(*UNIFIED_COLUMNS).unionByName(overrides.select(*UNIFIED_COLUMNS))
            .unionByName(routine.select(*UNIFIED_COLUMNS)))


def capability_flags(objects: DataFrame, keys: Sequence[str] = ("server_id",)) -> DataFrame:
    """PRJ-05: per server, presence of each expected object and the version gate (>= 180000)."""
    flags = [F.bool_or((F.col("kind") == k) & (F.col("name") == n)).alias(alias) for alias, k, n in CAPABILITY_OBJECTS]
    return objects.groupBy(*keys).agg(
        F.max("server_version_num").alias("server_version_num"), *flags,
    ).withColumn("meets_version_gate", F.col("server_version_num") >= VERSION_GATE)


def missing_parameters(settings: DataFrame, names: Sequence[str] = CONFIG_PARAMETERS,
                       keys: Sequence[str] = ("server_id",)) -> DataFrame:
    """JN-13: expected parameter names a server did not report.

    Each server row is expanded by the fixed name list (an ``explode`` of a literal
    array, bounded by the list length), then anti-joined with what was reported.
    """
    servers = settings.select(*keys).distinct()
    expected = servers.select(*keys, F.explode(F.array(*[F.lit(n) for n in names])).alias("name"))
    return expected.join(settings.select(*keys, "name"), [*keys, "name"], "left_anti")


def override_ratio(overrides: DataFrame, effective: DataFrame) -> DataFrame:
    """JN-19: override value over the server default of the same parameter (numeric only)."""
    e = effective.select("server_id", "parameter_name", F.col("parameter_value").alias("server_value"))
    j = overrides.join(e, ["server_id", "parameter_name"], "inner")
    return j.withColumn("override_ratio", F.try_divide(F.col("parameter_value").try_cast("double"),
                                                       F.col("server_value").try_cast("double")))
