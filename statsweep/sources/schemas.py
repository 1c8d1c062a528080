"""Declared schemas and natural keys of the monitoring datasets.

Every dataset carries the envelope columns; a sample is the rows sharing
``(server_id, query_id, source_collected_at)``. Use with ``readers.read_samples``
so landed files are read with types, never inferred; ``dedupe_natural_key`` takes
the keys below.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

ENVELOPE = ("server_id string, source_collected_at timestamp_ntz, collector_received_at timestamp_ntz, "
            "run_id string, row_ordinal int")

DATASETS: dict[str, str] = {
    "sessions": "datid long, datname string, pid int, leader_pid int, usename string, application_name string, "
                "client_addr string, backend_type string, state string, wait_event_type string, wait_event string, "
                "query_id long, backend_start timestamp_ntz, xact_start timestamp_ntz, query_start timestamp_ntz, "
                "state_change timestamp_ntz, query string",
    "server_settings": "max_connections int, max_worker_processes int, max_parallel_workers int, "
                       "max_parallel_workers_per_gather int",
    "locks": "pid int, locktype string, mode string, database long, relation long, page int, tuple int, "
             "virtualxid string, transactionid string, granted boolean, waitstart timestamp_ntz, "
             "blocking_pids array<int>",
    "relations": "oid long, schemaname string, relname string, relkind string, relfilenode long, "
                 "reltablespace long, main_fork_bytes long",
    "database_counters": "datid long, datname string, numbackends int, xact_commit long, xact_rollback long, "
                         "blks_read long, blks_hit long, temp_bytes long, deadlocks long, blk_read_time double, "
                         "blk_write_time double, stats_reset timestamp_ntz",
    "query_counters": "dbid long, userid long, queryid long, toplevel boolean, database_name string, "
                      "role_name string, calls long, plans long, total_exec_time double, total_plan_time double, "
                      "jit_generation_time double, jit_inlining_time double, jit_optimization_time double, "
                      "jit_emission_time double, jit_deform_time double, parallel_workers_to_launch long, "
                      "parallel_workers_launched long, stats_since timestamp_ntz, payload string, query string",
    "statement_store": "dealloc long, stats_reset timestamp_ntz",
    "io_counters": "backend_type string, object string, context string, reads long, read_bytes long, writes long, "
                   "write_bytes long, writebacks long, extends long, extend_bytes long, hits long, evictions long, "
                   "reuses long, fsyncs long, stats_reset timestamp_ntz",
    "writer_wal": "source_view string, payload string",
    "table_counters": "database_name string, relid long, schemaname string, relname string, seq_scan long, "
                      "seq_tup_read long, n_tup_upd long, n_tup_hot_upd long, n_live_tup long, n_dead_tup long, "
                      "heap_blks_read long, heap_blks_hit long, idx_blks_read long, idx_blks_hit long",
    "index_counters": "database_name string, relid long, indexrelid long, indexrelname string, idx_scan long, "
                      "idx_tup_read long, idx_tup_fetch long, idx_blks_read long, idx_blks_hit long, "
                      "index_size_bytes long, indisprimary boolean, indisunique boolean, indisvalid boolean, "
                      "indisready boolean",
    "window_waits": "start_time timestamp_ntz, end_time timestamp_ntz, user_id long, db_id long, query_id long, "
                    "event_type string, event string, calls long",
    "window_runtime": "start_time timestamp_ntz, end_time timestamp_ntz, user_id long, db_id long, query_id long, "
                      "plan_id long, query_sql_text string, is_system_query boolean, calls long, total_time double, "
                      "max_time double, shared_blks_hit long, shared_blks_read long, blk_read_time double, "
                      "blk_write_time double",
    "plans": "plan_id long, db_id long, query_id long, plan_text string",
    "maintenance": "operation_type string, pid int, progress string",
    "buffers": "reldatabase long, reltablespace long, relfilenode long, relforknumber int, isdirty boolean, "
               "usagecount int, pinning_backends int",
    "allocations": "name string, off long, size long, allocated_size long",
    "slru_counters": "name string, blks_zeroed long, blks_hit long, blks_read long, blks_written long, "
                     "blks_exists long, flushes long, truncates long, stats_reset timestamp_ntz",
    "settings": "name string, setting string, unit string, source string, context string, pending_restart boolean",
    "setting_overrides": "setdatabase long, setrole long, setconfig array<string>",
    "routine_settings": "oid long, signature string, schema string, owner string, proconfig array<string>",
    "objects": "kind string, name string, server_version_num int",
    "wait_dictionary": "server_version_num int, wait_event_type string, wait_event string, description string",
    "pool_snapshot": "database string, user string, pool_mode string, cl_active long, cl_waiting long, "
                     "cl_active_cancel_req long, cl_waiting_cancel_req long, sv_active long, sv_active_cancel long, "
                     "sv_being_canceled long, sv_idle long, sv_used long, sv_tested long, sv_login long, "
                     "maxwait long, maxwait_us long",
    "pool_stats": "pb_command string, database string, total_xact_count long, total_query_count long, "
                  "total_server_assignment_count long, total_received long, total_sent long, total_xact_time long, "
                  "total_query_time long, total_wait_time long",
    "pool_clients": "state string, application_name string, addr string, database string, user string, wait long, "
                    "wait_us long",
    "pool_servers": "state string, application_name string, addr string, database string, user string, "
                    "remote_pid int, close_needed int, connect_time timestamp_ntz",
    "pool_lists": "pb_command string, list string, items string",
    "minute_metrics": "resource_id string, metric_id string, dimension_key string, time_utc timestamp_ntz, "
                      "value double",
    "phase_markers": "test_run_id string, phase_name string, start_time timestamp_ntz, end_time timestamp_ntz, "
                     "user_load int",
    "capacity_history": "effective_from timestamp_ntz, effective_to timestamp_ntz, provisioned_vcores int, "
                        "memory long, sku string, scale_event_id string",
    "load_results": "test_run_id string, phase_name string, ts timestamp_ntz, successful_rps double, "
                    "error_rate double, p90_ms double, p99_ms double",
    "collector_run": "query_id string, status string, error string, note string, scheduled_at timestamp_ntz, "
                     "started_at timestamp_ntz, completed_at timestamp_ntz, row_count int, duration_ms long",
}

# Datasets whose rows are not samples of a server (no envelope).
NO_ENVELOPE = {"phase_markers", "load_results", "minute_metrics", "wait_dictionary"}

NATURAL_KEYS: dict[str, tuple[str, ...]] = {
    "sessions": ("server_id", "source_collected_at", "pid"),
    "server_settings": ("server_id", "source_collected_at"),
    "locks": ("server_id", "source_collected_at", "pid", "locktype", "relation", "transactionid"),
    "relations": ("server_id", "source_collected_at", "oid"),
    "database_counters": ("server_id", "source_collected_at", "datid"),
    "query_counters": ("server_id", "source_collected_at", "dbid", "userid", "queryid", "toplevel"),
    "statement_store": ("server_id", "source_collected_at"),
    "io_counters": ("server_id", "source_collected_at", "backend_type", "object", "context"),
    "writer_wal": ("server_id", "source_collected_at", "source_view"),
    "table_counters": ("server_id", "source_collected_at", "database_name", "relid"),
    "index_counters": ("server_id", "source_collected_at", "database_name", "indexrelid"),
    "window_waits": ("server_id", "start_time", "end_time", "user_id", "db_id", "query_id", "event_type", "event"),
    "window_runtime": ("server_id", "start_time", "end_time", "user_id", "db_id", "query_id", "plan_id"),
    "plans": ("server_id", "db_id", "query_id", "plan_id"),
    "maintenance": ("server_id", "source_collected_at", "operation_type", "pid"),
    "allocations": ("server_id", "source_collected_at", "name", "off"),
    "slru_counters": ("server_id", "source_collected_at", "name"),
    "settings": ("server_id", "source_collected_at", "name"),
    "setting_overrides": ("server_id", "source_collected_at", "setdatabase", "setrole"),
    "routine_settings": ("server_id", "source_collected_at", "oid"),
    "objects": ("server_id", "source_collected_at", "kind", "name"),
    "wait_dictionary": ("server_version_num", "wait_event_type", "wait_event"),
    "pool_snapshot": ("server_id", "source_collected_at", "database", "user"),
    "pool_stats": ("server_id", "source_collected_at", "pb_command", "database"),
    "pool_lists": ("server_id", "source_collected_at", "pb_command", "list"),
    "minute_metrics": ("resource_id", "metric_id", "dimension_key", "time_utc"),
    "phase_markers": ("test_run_id", "phase_name"),
    "capacity_history": ("server_id", "effective_from"),
    "load_results": ("test_run_id", "ts"),
    "collector_run": ("run_id",),
}


def schema(dataset: str, envelope: bool = True) -> StructType:
    """The declared ``StructType`` of a dataset (envelope columns first unless the dataset has none)."""
    body = DATASETS[dataset]
    ddl = f"{ENVELOPE}, {body}" if envelope and dataset not in NO_ENVELOPE else body
    return StructType.fromDDL(ddl)
