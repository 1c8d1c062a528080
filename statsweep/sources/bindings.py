"""Stand-in monitoring datasets built from the driver's test tables (FIXTURES.md B1-B15).

These functions only reshape test rows into the schemas the operators expect
(``FIXTURES.md`` part 1); they do none of an operator's work. Each has a twin
in ``statsweep.plans.oracle`` written in DuckDB SQL. All timestamps stay
TIMESTAMP_NTZ so results do not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ntz(c: Column) -> Column:
    return c.cast("timestamp_ntz")


def trunc(unit: str, c: str | Column) -> Column:
    return ntz(F.date_trunc(unit, F.col(c) if isinstance(c, str) else c))


def srv(mod_col: str, n: int) -> Column:
    return F.concat(F.lit("srv-"), (F.col(mod_col) % n).cast("string"))


# ---------------------------------------------------------------- B1 counters
def counter_samples(events: DataFrame) -> DataFrame:
    """B1: cumulative counters per user with a weekly ``stats_reset`` mark.

    ``counter`` is the running sum of value cents within (user, week), modulo
    50,000, so it also falls without a reset mark; ``n_rows``/``n_clicks``/
    ``n_errors`` are running counts within (user, week).
    """
    w = (
        Window.partitionBy("user_id", "stats_reset")
        .orderBy("ts", "event_id")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    base = events.select(
        srv("user_id", 4).alias("server_id"),
        "user_id",
        "event_id",
        "ts",
        "event_type",
        trunc("week", "ts").alias("stats_reset"),
        F.round(F.col("value") * 100).cast("long").alias("cents"),
    )
    return base.select(
        "server_id",
        "user_id",
        "event_id",
        F.col("ts").alias("source_collected_at"),
        "stats_reset",
        "cents",
        (F.sum("cents").over(w) % 50000).alias("counter"),
        F.count(F.lit(1)).over(w).alias("n_rows"),
        F.sum((F.col("event_type") == "click").cast("long")).over(w).alias("n_clicks"),
        F.sum((F.col("event_type") == "error").cast("long")).over(w).alias("n_errors"),
    )


# Per-dataset column maps over B1 (SQL expressions valid in Spark SQL and DuckDB).
# Keys are one-to-one with user_id (except where a dataset key adds a split, such as
# ``toplevel``), so each key is one counter series with weekly resets.
B1_DATASETS: dict[str, dict[str, str]] = {
    "database": {
        "server_id": "server_id", "datid": "user_id", "datname": "'db' || CAST(user_id AS STRING)",
        "xact_commit": "n_rows", "xact_rollback": "n_errors", "blks_hit": "counter",
        "blks_read": "n_clicks * 5000", "temp_bytes": "counter * 1024", "deadlocks": "n_errors",
        "blk_read_time": "CAST(counter AS DOUBLE) / 100", "blk_write_time": "CAST(n_clicks AS DOUBLE) * 1.5",
        "stats_reset": "stats_reset",
        "datistemplate": "(user_id % 50 = 0)",
    },
    "query": {
        "server_id": "server_id", "dbid": "user_id % 3", "userid": "user_id % 5", "queryid": "user_id",
        "toplevel": "(event_id % 2 = 0)", "calls": "n_rows", "plans": "n_clicks",
        "total_exec_time": "CAST(counter AS DOUBLE) / 10", "total_plan_time": "CAST(cents AS DOUBLE) / 10",
        "jit_generation_time": "CAST(n_errors AS DOUBLE)", "jit_inlining_time": "CAST(n_clicks AS DOUBLE) / 2",
        "jit_optimization_time": "CAST(n_rows AS DOUBLE) / 4", "jit_emission_time": "CAST(n_errors AS DOUBLE) / 8",
        "jit_deform_time": "CAST(n_clicks AS DOUBLE) / 16", "parallel_workers_to_launch": "n_rows * 2",
        "parallel_workers_launched": "n_rows + n_clicks", "stats_since": "stats_reset",
    },
    "statement_store": {
        "server_id": "'srv-u' || CAST(user_id AS STRING)", "dealloc": "n_errors", "stats_reset": "stats_reset",
    },
    "io": {
        "server_id": "server_id",
        "backend_type": "CASE WHEN user_id % 3 = 0 THEN 'client backend' WHEN user_id % 3 = 1 "
                        "THEN 'checkpointer' ELSE 'background writer' END",
        "object": "'relation'", "context": "'ctx' || CAST(user_id AS STRING)",
        "reads": "n_clicks", "read_bytes": "n_clicks * 8192", "writes": "n_errors", "write_bytes": "n_errors * 8192",
        "extends": "n_rows", "extend_bytes": "n_rows * 8192", "hits": "counter", "evictions": "n_errors",
        "stats_reset": "stats_reset",
    },
    "checkpoint": {
        "server_id": "server_id", "source_view": "'checkpointer-' || CAST(user_id AS STRING)",
        "num_timed": "n_rows", "num_requested": "n_clicks", "write_time": "CAST(counter AS DOUBLE) / 10",
        "sync_time": "CAST(n_errors AS DOUBLE)", "wal_bytes": "counter * 16", "stats_reset": "stats_reset",
    },
    "table": {
        "server_id": "server_id", "database_name": "'db' || CAST(user_id % 3 AS STRING)", "relid": "user_id",
        "seq_scan": "n_rows", "seq_tup_read": "counter", "n_tup_upd": "n_clicks", "n_tup_hot_upd": "n_errors",
        "heap_blks_hit": "counter", "heap_blks_read": "n_rows", "idx_blks_hit": "n_clicks * 10",
        "idx_blks_read": "n_errors", "n_live_tup": "cents", "n_dead_tup": "n_errors",
    },
    "index": {
        "server_id": "server_id", "database_name": "'db' || CAST(user_id % 3 AS STRING)",
        "indexrelid": "user_id", "relid": "user_id % 10", "idx_scan": "n_clicks", "idx_blks_hit": "counter",
        "idx_blks_read": "n_rows",
    },
    "slru": {
        "server_id": "server_id", "name": "'slru' || CAST(user_id AS STRING)", "blks_hit": "counter",
        "blks_read": "n_rows", "blks_written": "n_clicks", "flushes": "n_errors", "stats_reset": "stats_reset",
    },
    "pooler": {
        "server_id": "server_id",
        "pb_command": "CASE WHEN event_id % 2 = 0 THEN 'STATS' ELSE 'STATS_TOTALS' END",
        "database": "'db' || CAST(user_id AS STRING)", "total_xact_count": "n_rows",
        "total_query_count": "n_rows * 3", "total_server_assignment_count": "n_clicks",
        "total_received": "counter", "total_sent": "counter * 2", "total_xact_time": "counter * 100",
        "total_query_time": "counter * 50", "total_wait_time": "n_errors * 1000",
    },
}


def b1_dataset(events: DataFrame, name: str) -> DataFrame:
    """One monitoring dataset of B1_DATASETS, with ``source_collected_at`` and ``event_id`` kept."""
    m = B1_DATASETS[name]
    s = counter_samples(events)
    return s.select("event_id", "source_collected_at", *[F.expr(e).alias(c) for c, e in m.items()])


def checkpoint_samples(events: DataFrame) -> DataFrame:
    """IV-05 input: ``source_view`` plus a JSON ``payload`` as the server returns it."""
    m = B1_DATASETS["checkpoint"]
    s = counter_samples(events)
    fields = ["num_timed", "num_requested", "write_time", "sync_time", "wal_bytes"]
    return s.select(
        "event_id", "source_collected_at", F.expr(m["server_id"]).alias("server_id"),
        F.expr(m["source_view"]).alias("source_view"), F.col("stats_reset"),
        F.to_json(F.struct(*[F.expr(m[f]).alias(f) for f in fields])).alias("payload"),
    )


WRITER_VIEWS = {  # counters of each of the three views, as expressions over counter samples
    "pg_stat_bgwriter": {"buffers_clean": "counter", "buffers_backend": "n_rows"},
    "pg_stat_checkpointer": {"num_timed": "n_rows", "num_requested": "n_clicks", "write_time": "counter", "sync_time": "n_errors"},
    "pg_stat_wal": {"wal_bytes": "counter * 16", "wal_buffers_full": "n_clicks"},
}


def writer_view_samples(events: DataFrame) -> DataFrame:
    """IV-05 input: one row per user's view (the user's remainder by 3 picks it) with that view's counters as JSON."""
    payload = F.coalesce(*[F.when(F.col("user_id") % 3 == i, F.to_json(F.struct(*[F.expr(e).alias(c) for c, e in m.items()])))
                           for i, m in enumerate(WRITER_VIEWS.values())])
    return counter_samples(events).select(
        "event_id", "source_collected_at", F.concat_ws("-", "server_id", "user_id").alias("server_id"),
        F.element_at(F.array(*[F.lit(v) for v in WRITER_VIEWS]), (F.col("user_id") % 3 + 1).cast("int")).alias("source_view"),
        "stats_reset", payload.alias("payload"))


# ------------------------------------------------------- dialect-neutral bindings
def _dialect(expr: str, dialect: str) -> str:
    """Fill ``{secs:x}`` (interval of x seconds) and ``{hour:c}`` / ``{day:c}`` / ``{week:c}``
    (truncation, as TIMESTAMP_NTZ) for Spark SQL or DuckDB."""

    def secs(m):
        x = m.group(1)
        if dialect == "spark":
            return f"make_dt_interval(0, 0, 0, CAST(({x}) AS DECIMAL(18,6)))"
        return f"to_microseconds(CAST(round(({x}) * 1000000) AS BIGINT))"

    def tr(m):
        unit, x = m.group(1), m.group(2)
        if dialect == "spark":
            return f"CAST(date_trunc('{unit}', {x}) AS TIMESTAMP_NTZ)"
        return f"date_trunc('{unit}', {x})"

    import re

    expr = re.sub(r"\{secs:([^}]*)\}", secs, expr)
    expr = re.sub(r"\{(hour|day|week|minute|month|year):([^}]*)\}", tr, expr)
    return expr


def exprs(mapping: dict[str, str], dialect: str) -> list[str]:
    return [f"{_dialect(e, dialect)} AS {c}" for c, e in mapping.items()]


def select_mapped(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.selectExpr(*exprs(mapping, "spark"))


# ---------------------------------------------------------------- B2 sessions
_WORKER = "(user_id % 3 = 0 AND event_id % 4 <> 0)"
B2_SESSIONS: dict[str, str] = {
    "server_id": "'srv-' || CAST(user_id % 2 AS STRING)",
    "source_collected_at": "{hour:ts} + INTERVAL 1 HOUR",
    "datid": "user_id % 3",
    "datname": "'db' || CAST(user_id % 3 AS STRING)",
    "pid": "CAST(event_id AS INT)",
    "leader_pid": f"CASE WHEN {_WORKER} THEN CAST(event_id - event_id % 4 AS INT) END",
    "usename": "'u' || CAST(user_id % 7 AS STRING)",
    "application_name": "CASE WHEN user_id % 13 = 0 THEN 'collector' WHEN user_id % 5 = 0 THEN NULL "
                        "ELSE 'app' || CAST(user_id % 5 AS STRING) END",
    "client_addr": "'10.0.0.' || CAST(user_id % 200 AS STRING)",
    "backend_type": f"CASE WHEN {_WORKER} THEN 'parallel worker' WHEN user_id % 11 = 0 THEN 'autovacuum worker' "
                    "WHEN user_id % 11 = 1 THEN 'checkpointer' ELSE 'client backend' END",
    "state": "CASE WHEN event_type IN ('click', 'signup') THEN 'active' WHEN event_type = 'view' THEN 'idle' "
             "WHEN event_type = 'purchase' THEN 'idle in transaction' END",
    "wait_event_type": "CASE WHEN event_type = 'view' THEN 'Client' WHEN event_type = 'purchase' THEN 'Lock' "
                       "WHEN event_type = 'signup' AND value >= 50 THEN 'IO' WHEN event_type = 'signup' THEN 'LWLock' "
                       "WHEN event_type = 'click' AND value >= 80 THEN 'BufferPin' "
                       "WHEN event_type = 'error' THEN 'IPC' END",
    "wait_event": "CASE WHEN event_type = 'view' THEN 'ClientRead' WHEN event_type = 'purchase' THEN 'relation' "
                  "WHEN event_type = 'signup' AND value >= 50 THEN 'DataFileRead' "
                  "WHEN event_type = 'signup' THEN 'BufferMapping' "
                  "WHEN event_type = 'click' AND value >= 80 THEN 'BufferPin' "
                  "WHEN event_type = 'error' THEN 'ParallelFinish' END",
    "query_id": "user_id % 20",
    "query": "'select ' || event_type || ' from t' || CAST(user_id % 20 AS STRING)",
    "query_start": "ts - {secs:value}",
    "xact_start": "CASE WHEN event_type IN ('view', 'error') THEN NULL ELSE ts - {secs:value * 2} END",
    "state_change": "ts",
    "backend_start": "ts - INTERVAL 1 HOUR",
}
# Per-sample server settings: the sample spine (one row per server and sample).
B2_SETTINGS = (
    "SELECT DISTINCT server_id, source_collected_at, 100 AS max_connections, 16 AS max_worker_processes, "
    "8 AS max_parallel_workers, 2 AS max_parallel_workers_per_gather FROM sessions"
)


def sessions(events: DataFrame) -> DataFrame:
    """B2: backends per hourly sample (pid = event id, every 4th pid leads a parallel group)."""
    return select_mapped(events, B2_SESSIONS)


def server_settings(sessions_df: DataFrame) -> DataFrame:
    """B2 spine: one settings row per (server_id, source_collected_at) seen in ``sessions``."""
    return sessions_df.select("server_id", "source_collected_at").distinct().select(
        "server_id", "source_collected_at",
        F.lit(100).alias("max_connections"), F.lit(16).alias("max_worker_processes"),
        F.lit(8).alias("max_parallel_workers"), F.lit(2).alias("max_parallel_workers_per_gather"))


# ---------------------------------------------------------------- B3 blocking
_B3_T0 = {"spark": "TIMESTAMP_NTZ '2024-01-01 00:00:00'", "duckdb": "TIMESTAMP '2024-01-01 00:00:00'"}


def b3_locks(dialect: str) -> list[str]:
    """B3 locks: blocked = c_custkey, blocker = floor(c_custkey / 3), a second blocker c_custkey - 1
    when c_custkey % 50 = 0; one sample; every 97th lock is granted."""
    t0 = _B3_T0[dialect]
    arr = ("array(CAST(floor(c_custkey / 3) AS INT), CAST(c_custkey - 1 AS INT))" if dialect == "spark"
           else "[CAST(floor(c_custkey / 3) AS INT), CAST(c_custkey - 1 AS INT)]")
    one = ("array(CAST(floor(c_custkey / 3) AS INT))" if dialect == "spark"
           else "[CAST(floor(c_custkey / 3) AS INT)]")
    m = {
        "server_id": "'srv-0'",
        "source_collected_at": t0,
        "pid": "CAST(c_custkey AS INT)",
        "locktype": "CASE WHEN c_custkey % 2 = 0 THEN 'relation' ELSE 'transactionid' END",
        "mode": "CASE WHEN c_custkey % 3 = 0 THEN 'AccessExclusiveLock' ELSE 'ShareLock' END",
        "database": "CAST(c_nationkey % 3 AS BIGINT)",
        "relation": "CASE WHEN c_custkey % 2 = 0 THEN CAST(c_nationkey AS BIGINT) END",
        "page": "CAST(NULL AS INT)",
        "tuple": "CAST(NULL AS INT)",
        "virtualxid": "CAST(NULL AS STRING)",
        "transactionid": "CASE WHEN c_custkey % 2 = 1 THEN CAST(c_custkey AS STRING) END",
        "granted": "(c_custkey % 97 = 0)",
        "waitstart": f"CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE {t0} - {{secs:c_custkey % 90}} END",
        "blocking_pids": f"CASE WHEN c_custkey % 50 = 0 THEN {arr} ELSE {one} END",
    }
    return exprs(m, dialect)


def b3_sessions(dialect: str) -> list[str]:
    t0 = _B3_T0[dialect]
    m = {
        "server_id": "'srv-0'",
        "source_collected_at": t0,
        "pid": "CAST(c_custkey AS INT)",
        "datname": "'db' || CAST(c_nationkey % 3 AS STRING)",
        "usename": "c_name",
        "application_name": "c_mktsegment",
        "client_addr": "'10.1.0.' || CAST(c_custkey % 250 AS STRING)",
        "state": "CASE WHEN c_acctbal < 0 THEN 'idle in transaction' ELSE 'active' END",
        "wait_event_type": "'Lock'",
        "wait_event": "'relation'",
        "query_id": "CAST(c_nationkey AS BIGINT)",
        "query_start": f"{t0} - {{secs:c_custkey % 120}}",
        "xact_start": f"{t0} - {{secs:c_custkey % 240}}",
        "query": "'update accounts set bal = bal where id = ' || CAST(c_custkey AS STRING)",
    }
    return exprs(m, dialect)


def b3_relations(dialect: str) -> list[str]:
    m = {
        "server_id": "'srv-0'",
        "source_collected_at": _B3_T0[dialect],
        "oid": "CAST(n_nationkey AS BIGINT)",
        "schemaname": "CASE WHEN n_regionkey = 1 THEN 'Sales Data' ELSE 'public' END",
        "relname": "CASE WHEN n_regionkey = 2 THEN n_name ELSE lower(n_name) END",
        "relkind": "'r'",
    }
    return exprs(m, dialect)


def locks(customer: DataFrame) -> DataFrame:
    return customer.selectExpr(*b3_locks("spark"))


def lock_sessions(customer: DataFrame) -> DataFrame:
    return customer.selectExpr(*b3_sessions("spark"))


def relations(nation: DataFrame) -> DataFrame:
    return nation.selectExpr(*b3_relations("spark"))


# ------------------------------------------------------- B4 window waits / runtime
# Fixed mapping of event types to (wait_event_type, wait_event) pairs of the wait dictionary.
_W_TYPE = ("CASE event_type WHEN 'view' THEN 'Client' WHEN 'click' THEN 'Client' WHEN 'purchase' THEN 'Lock' "
           "WHEN 'signup' THEN 'IO' ELSE 'Activity' END")
_W_EVENT = ("CASE event_type WHEN 'view' THEN 'ClientRead' WHEN 'click' THEN 'ClientWrite' "
            "WHEN 'purchase' THEN 'relation' WHEN 'signup' THEN 'DataFileRead' ELSE 'WalWriterMain' END")


def b4_waits_sql(dialect: str) -> str:
    """B4 wait-sampling rows: day windows, query = user, calls = sampled events."""
    return _dialect(
        "SELECT 'srv-' || CAST(user_id % 2 AS STRING) AS server_id, {day:ts} AS start_time, "
        "{day:ts} + INTERVAL 1 DAY AS end_time, user_id % 7 AS user_id, user_id % 3 AS db_id, user_id AS query_id, "
        f"{_W_TYPE} AS event_type, {_W_EVENT} AS event, COUNT(*) AS calls "
        "FROM events GROUP BY 1, 2, 3, 4, 5, 6, 7, 8", dialect)


def b4_runtime_sql(dialect: str) -> str:
    """B4 runtime rows per plan; none for user_id % 10 = 0 so some waits have no runtime."""
    return _dialect(
        "SELECT 'srv-' || CAST(user_id % 2 AS STRING) AS server_id, {day:ts} AS start_time, "
        "{day:ts} + INTERVAL 1 DAY AS end_time, user_id % 7 AS user_id, user_id % 3 AS db_id, user_id AS query_id, "
        "user_id * 10 + event_id % 3 AS plan_id, 'select * from t' || CAST(user_id AS STRING) AS query_sql_text, "
        "(user_id % 17 = 0) AS is_system_query, COUNT(*) AS calls, "
        "CAST(SUM(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) AS total_time, MAX(value) AS max_time, "
        "CAST(SUM(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS shared_blks_hit, COUNT(*) * 2 AS shared_blks_read, "
        "CAST(SUM(event_id % 100) AS DOUBLE) AS blk_read_time, CAST(COUNT(*) AS DOUBLE) AS blk_write_time "
        "FROM events WHERE user_id % 10 <> 0 GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9", dialect)


def b15_dictionary_sql(dialect: str) -> str:
    """B15 wait dictionary: the pairs of every event type except 'error'."""
    return (f"SELECT DISTINCT 170000 AS server_version_num, {_W_TYPE} AS wait_event_type, {_W_EVENT} AS wait_event, "
            "'mapped' AS description FROM events WHERE event_type <> 'error'")


def _sql_over(spark: SparkSession, events: DataFrame, text: str) -> DataFrame:
    """Run a binding's SELECT over ``events`` (a session-scoped temp view of the given frame)."""
    name = f"events_{abs(hash(text)) % 10**8}"
    events.createOrReplaceTempView(name)
    return spark.sql(text.replace("FROM events", f"FROM {name}"))


def window_waits_input(spark: SparkSession, events: DataFrame) -> DataFrame:
    return _sql_over(spark, events, b4_waits_sql("spark"))


def window_runtime_input(spark: SparkSession, events: DataFrame) -> DataFrame:
    return _sql_over(spark, events, b4_runtime_sql("spark"))


def wait_dictionary(spark: SparkSession, events: DataFrame) -> DataFrame:
    return _sql_over(spark, events, b15_dictionary_sql("spark"))


# ----------------------------------------------------------- B10 plans / runtime
def b10_plans(dialect: str) -> list[str]:
    m = {
        "server_id": "'srv-0'",
        "plan_id": "p_partkey",
        "db_id": "p_partkey % 3",
        "query_id": "p_partkey % 200",
        "plan_text": "(CASE WHEN p_size % 2 = 0 THEN 'Gather Merge -> Parallel Hash Join' "
                     "WHEN p_size % 5 = 0 THEN 'Gather -> Parallel Seq Scan on ' || p_type "
                     "WHEN p_size % 7 = 0 THEN 'Gather -> Parallel Index Only Scan' "
                     "ELSE 'Seq Scan on ' || p_type END) || "
                     "CASE WHEN p_size % 3 = 0 THEN ' Workers Planned: ' || CAST(p_size % 8 AS STRING) ELSE '' END",
    }
    return exprs(m, dialect)


def b10_runtime(dialect: str) -> list[str]:
    m = {
        "server_id": "'srv-0'",
        "start_time": "{day:l_shipdate}",
        "end_time": "{day:l_shipdate} + INTERVAL 1 DAY",
        "db_id": "l_partkey % 3",
        "query_id": "l_partkey % 200",
        "plan_id": "l_partkey",
        "calls": "CAST(l_linenumber AS BIGINT)",
        "total_time": "l_quantity",
        "max_time": "l_extendedprice",
        "is_system_query": "(l_suppkey % 13 = 0)",
        "query_sql_text": "'select part ' || CAST(l_partkey % 200 AS STRING)",
    }
    return exprs(m, dialect)


def plans(part: DataFrame) -> DataFrame:
    return part.selectExpr(*b10_plans("spark"))


def plan_runtime(lineitem: DataFrame) -> DataFrame:
    return lineitem.selectExpr(*b10_runtime("spark"))


# ------------------------------------------------------------ B5 series, B6 phases
def b5_series_sql(dialect: str) -> str:
    """Hourly metric per resource (user_id % 5): least(100, sum of cents / 100); empty hours are gaps."""
    return _dialect(
        "SELECT 'res' || CAST(user_id % 5 AS STRING) AS resource_id, 'cpu_percent' AS metric_id, "
        "'' AS dimension_key, {hour:ts} AS time_utc, "
        "least(CAST(100 AS DOUBLE), CAST(SUM(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / 100) AS value "
        "FROM events GROUP BY 1, 2, 3, 4", dialect)


def b6_markers_sql(dialect: str) -> str:
    """One phase marker per distinct week of events (run 'run-1'); load 100 x week number."""
    return _dialect(
        "SELECT 'run-1' AS test_run_id, 'week-' || CAST(rn AS STRING) AS phase_name, start_time, "
        "CAST(NULL AS TIMESTAMP) AS end_time, CAST(100 * rn AS INT) AS user_load FROM ("
        "SELECT start_time, ROW_NUMBER() OVER (ORDER BY start_time) AS rn FROM ("
        "SELECT DISTINCT {week:ts} AS start_time FROM events) w) r", dialect).replace(
        "CAST(NULL AS TIMESTAMP)", "CAST(NULL AS TIMESTAMP_NTZ)" if dialect == "spark" else "CAST(NULL AS TIMESTAMP)")


def metric_series(spark: SparkSession, events: DataFrame) -> DataFrame:
    return _sql_over(spark, events, b5_series_sql("spark"))


def phase_markers(spark: SparkSession, events: DataFrame) -> DataFrame:
    return _sql_over(spark, events, b6_markers_sql("spark"))


# ------------------------------------------------------------- B7 configuration
def _arr(items: list[str], dialect: str) -> str:
    return ("array(" if dialect == "spark" else "[") + ", ".join(items) + (")" if dialect == "spark" else "]")


def b7_overrides(dialect: str) -> list[str]:
    """B7 overrides: ``work_mem=<o_orderkey % 64>``, ``jit=on=<status>`` (second '='), priority (no '=')."""
    m = {
        "server_id": "'srv-' || CAST(o_custkey % 3 AS STRING)",
        "setdatabase": "o_orderkey % 4",
        "setrole": "o_custkey % 5",
        "datname": "'db' || CAST(o_orderkey % 4 AS STRING)",
        "rolname": "'role' || CAST(o_custkey % 5 AS STRING)",
        "setconfig": _arr(["'work_mem=' || CAST(o_orderkey % 64 AS STRING)", "'jit=on=' || o_orderstatus",
                           "o_orderpriority"], dialect),
    }
    return exprs(m, dialect)


def b7_settings_sql(dialect: str) -> str:
    """B7 effective settings: one row per (server, name); name picked by p_size from the known lists."""
    from statsweep.operators.config import CONFIG_PARAMETERS, LOCK_LOGGING_PARAMETERS

    names = [*CONFIG_PARAMETERS, *LOCK_LOGGING_PARAMETERS, "unrelated_a", "unrelated_b", "unrelated_c"]
    arr = _arr([f"'{n}'" for n in names], dialect)
    return (
        "SELECT server_id, name, CAST(MAX(p_partkey % 97) AS STRING) AS setting, 'kB' AS unit, "
        "'configuration file' AS source, 'user' AS context, (MAX(p_partkey) % 2 = 0) AS pending_restart, "
        "'postgres' AS database_name, 'collector' AS role_name FROM ("
        "SELECT 'srv-' || CAST(p_partkey % 3 AS STRING) AS server_id, "
        f"element_at({arr}, CAST(p_size + (p_partkey % 3) * 5 AS INT)) AS name, p_partkey FROM part) x "
        "GROUP BY server_id, name") if dialect == "spark" else (
        "SELECT server_id, name, CAST(MAX(p_partkey % 97) AS VARCHAR) AS setting, 'kB' AS unit, "
        "'configuration file' AS source, 'user' AS context, (MAX(p_partkey) % 2 = 0) AS pending_restart, "
        "'postgres' AS database_name, 'collector' AS role_name FROM ("
        "SELECT 'srv-' || CAST(p_partkey % 3 AS VARCHAR) AS server_id, "
        f"{arr}[CAST(p_size + (p_partkey % 3) * 5 AS INT)] AS name, p_partkey FROM part) x "
        "GROUP BY server_id, name")


def b7_routines(dialect: str) -> list[str]:
    m = {
        "server_id": "'srv-' || CAST(p_partkey % 3 AS STRING)",
        "oid": "p_partkey",
        "signature": "'f' || CAST(p_partkey AS STRING) || '()'",
        "schema": "CASE p_partkey % 10 WHEN 0 THEN 'pg_catalog' WHEN 1 THEN 'pg_toast_99' WHEN 2 THEN 'pg_temp_3' "
                  "WHEN 3 THEN 'information_schema' ELSE 'app' END",
        "owner": "'owner' || CAST(p_partkey % 4 AS STRING)",
        "database_name": "'db' || CAST(p_partkey % 4 AS STRING)",
        "proconfig": "CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE "
                     + _arr(["'work_mem=' || CAST(p_size AS STRING) || 'MB'", "'search_path=app'", "'jit=off'"],
                            dialect) + " END",
    }
    return exprs(m, dialect)


def b7_objects(dialect: str) -> list[str]:
    """Catalog objects per server from ``supplier`` (one object row per supplier)."""
    m = {
        "server_id": "'srv-' || CAST(s_suppkey % 4 AS STRING)",
        "kind": "CASE WHEN s_suppkey % 6 = 5 THEN 'extension' ELSE 'view' END",
        "name": "CASE s_suppkey % 6 WHEN 0 THEN 'pg_stat_statements' WHEN 1 THEN 'pg_stat_statements_info' "
                "WHEN 2 THEN 'pg_stat_io' WHEN 3 THEN 'pg_stat_checkpointer' WHEN 4 THEN 'other_view' "
                "ELSE 'pg_stat_statements' END",
        "server_version_num": "160000 + (s_nationkey % 3) * 10000",
    }
    return exprs(m, dialect)


def setting_overrides(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(*b7_overrides("spark"))


def effective_settings(spark: SparkSession, part: DataFrame) -> DataFrame:
    name = f"part_{abs(hash('b7')) % 10**8}"
    part.createOrReplaceTempView(name)
    return spark.sql(b7_settings_sql("spark").replace("FROM part", f"FROM {name}"))


def routine_settings(part: DataFrame) -> DataFrame:
    return part.selectExpr(*b7_routines("spark"))


def catalog_objects(supplier: DataFrame) -> DataFrame:
    return supplier.selectExpr(*b7_objects("spark"))


# ------------------------------------------------------------- B9 buffers and catalog
def b9_buffers(dialect: str) -> list[str]:
    """One buffer per lineitem row; file node = l_partkey, sample = ship year."""
    m = {
        "server_id": "'srv-0'",
        "source_collected_at": "{year:l_shipdate}",
        "reldatabase": "CAST(CASE WHEN l_orderkey % 10 = 0 THEN 2 ELSE 1 END AS BIGINT)",
        "reltablespace": "CAST(CASE WHEN l_suppkey % 2 = 0 THEN 1663 ELSE 1700 END AS BIGINT)",
        "relfilenode": "CASE WHEN l_orderkey % 50 = 0 THEN NULL ELSE l_partkey END",
        "relforknumber": "CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END",
        "isdirty": "(l_returnflag = 'R')",
        "usagecount": "l_linenumber",
        "pinning_backends": "CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END",
    }
    return exprs(m, dialect)


def b9_catalog(dialect: str) -> list[str]:
    m = {
        "server_id": "'srv-0'",
        "oid": "p_partkey + 100000",
        "relfilenode": "p_partkey",
        "reltablespace": "CASE WHEN p_partkey % 5 = 0 THEN 1700 ELSE 0 END",
        "schemaname": "CASE WHEN p_partkey % 20 = 0 THEN 'pg_temp_1' ELSE 'public' END",
        "relname": "'part_' || CAST(p_partkey AS STRING)",
        "relkind": "'r'",
        "main_fork_bytes": "CAST(p_size AS BIGINT) * 8192 * 10",
    }
    return exprs(m, dialect)


def b9_allocations(dialect: str) -> list[str]:
    m = {
        "server_id": "'srv-0'",
        "source_collected_at": "{year:o_orderdate}",
        "name": "CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderpriority || '-' || o_orderstatus END",
        "off": "o_orderkey",
        "size": "CAST(floor(o_totalprice) AS BIGINT)",
        "allocated_size": "CAST(floor(o_totalprice) AS BIGINT) + 64",
    }
    return exprs(m, dialect)


def buffers(lineitem: DataFrame) -> DataFrame:
    return lineitem.selectExpr(*b9_buffers("spark"))


def buffer_catalog(part: DataFrame) -> DataFrame:
    return part.selectExpr(*b9_catalog("spark"))


def allocations(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(*b9_allocations("spark"))


# ------------------------------------------------- JN-02/JN-03 tables and indexes (part + lineitem)
_T0 = {"spark": "TIMESTAMP_NTZ '2024-01-01 00:00:00'", "duckdb": "TIMESTAMP '2024-01-01 00:00:00'"}


def rel_stats(dialect: str) -> list[str]:
    m = {"server_id": "'srv-0'", "source_collected_at": _T0[dialect], "relid": "p_partkey",
         "schemaname": "'public'", "relname": "'part_' || CAST(p_partkey AS STRING)",
         "seq_scan": "CAST(p_size AS BIGINT)", "seq_tup_read": "CAST(p_size AS BIGINT) * 100",
         "n_live_tup": "CAST(p_size AS BIGINT) * 1000", "n_dead_tup": "p_partkey % 17"}
    return exprs(m, dialect)


def rel_io_sql(dialect: str, key: str) -> str:
    """Per-part I/O counters from lineitem sums (``key`` is relid or indexrelid)."""
    return _dialect(
        f"SELECT 'srv-0' AS server_id, {_T0[dialect]} AS source_collected_at, l_partkey AS {key}, "
        "COUNT(*) AS blks_read, CAST(SUM(l_quantity) AS BIGINT) AS blks_hit FROM lineitem GROUP BY l_partkey",
        dialect)


def index_usage(dialect: str) -> list[str]:
    m = {"server_id": "'srv-0'", "source_collected_at": _T0[dialect], "indexrelid": "p_partkey",
         "relid": "p_partkey % 100", "indexrelname": "'ix_part_' || CAST(p_partkey AS STRING)",
         "idx_scan": "CAST(p_size AS BIGINT) % 7", "idx_tup_read": "CAST(p_size AS BIGINT) * 3"}
    return exprs(m, dialect)


def index_definitions_sql(dialect: str) -> str:
    return _dialect(
        f"SELECT 'srv-0' AS server_id, {_T0[dialect]} AS source_collected_at, p_partkey AS indexrelid, "
        "'CREATE INDEX ix ON part_' || CAST(p_partkey % 100 AS STRING) || ' (p_brand)' AS indexdef, "
        "CAST(p_retailprice * 1000000 AS BIGINT) AS index_size_bytes, (p_size % 2 = 0) AS indisunique, "
        "(p_size % 10 = 0) AS indisprimary, (p_partkey % 29 <> 0) AS indisvalid, TRUE AS indisready "
        "FROM part WHERE p_partkey % 7 <> 0", dialect)


def _over(spark: SparkSession, df: DataFrame, table_name: str, text: str) -> DataFrame:
    name = f"{table_name}_{abs(hash(text)) % 10**8}"
    df.createOrReplaceTempView(name)
    return spark.sql(text.replace(f"FROM {table_name}", f"FROM {name}"))


def table_counter_rows(part: DataFrame) -> DataFrame:
    return part.selectExpr(*rel_stats("spark"))


def relation_io(spark: SparkSession, lineitem: DataFrame, key: str) -> DataFrame:
    return _over(spark, lineitem, "lineitem", rel_io_sql("spark", key))


def index_usage_rows(part: DataFrame) -> DataFrame:
    return part.selectExpr(*index_usage("spark"))


def index_definitions(spark: SparkSession, part: DataFrame) -> DataFrame:
    return _over(spark, part, "part", index_definitions_sql("spark"))


# ------------------------------------------------------------- B11 pooler
_POOL_SRV = "'srv-' || CAST(user_id % 2 AS STRING)"
_HOUR_END = "{hour:ts} + INTERVAL 1 HOUR"


def b11_pools_sql(dialect: str) -> str:
    """B11 SHOW POOLS per hour and pool (user_id % 4): clicks active, errors waiting, views/purchases/signups servers."""
    return _dialect(
        f"SELECT {_POOL_SRV} AS server_id, {_HOUR_END} AS source_collected_at, "
        "'db' || CAST(user_id % 4 AS STRING) AS database, 'app' || CAST(user_id % 4 AS STRING) AS user, "
        "'transaction' AS pool_mode, "
        "SUM(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS cl_active, "
        "SUM(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS cl_waiting, "
        "CAST(0 AS BIGINT) AS cl_active_cancel_req, CAST(0 AS BIGINT) AS cl_waiting_cancel_req, "
        "SUM(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS sv_active, "
        "CAST(0 AS BIGINT) AS sv_active_cancel, CAST(0 AS BIGINT) AS sv_being_canceled, "
        "SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS sv_idle, "
        "SUM(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS sv_used, "
        "CAST(0 AS BIGINT) AS sv_tested, CAST(0 AS BIGINT) AS sv_login, "
        "COALESCE(MAX(CASE WHEN event_type = 'error' THEN CAST(floor(value) AS BIGINT) END), 0) AS maxwait, "
        "COALESCE(MAX(CASE WHEN event_type = 'error' THEN CAST(round(value * 100) AS BIGINT) % 100 * 10000 END), 0) "
        "AS maxwait_us FROM events GROUP BY 1, 2, 3, 4, 5", dialect).replace(
        "SUM(CASE", "CAST(SUM(CASE").replace("ELSE 0 END) AS", "ELSE 0 END) AS BIGINT) AS")


def b11_clients(dialect: str) -> list[str]:
    m = {
        "server_id": _POOL_SRV, "source_collected_at": _HOUR_END,
        "state": "CASE event_type WHEN 'error' THEN 'waiting' WHEN 'click' THEN 'active' ELSE 'idle' END",
        "application_name": "CASE WHEN user_id % 17 = 0 THEN '' ELSE 'app' || CAST(user_id % 6 AS STRING) END",
        "addr": "'10.2.0.' || CAST(user_id % 50 AS STRING)",
        "database": "'db' || CAST(user_id % 4 AS STRING)", "user": "'app' || CAST(user_id % 4 AS STRING)",
        "wait": "CASE WHEN event_type = 'error' THEN CAST(floor(value) AS BIGINT) ELSE 0 END",
        "wait_us": "CASE WHEN event_type = 'error' THEN CAST(round(value * 100) AS BIGINT) % 100 * 10000 ELSE 0 END",
    }
    return exprs(m, dialect)


def b11_servers(dialect: str) -> list[str]:
    m = {
        "server_id": _POOL_SRV, "source_collected_at": _HOUR_END,
        "state": "CASE event_type WHEN 'view' THEN 'active' WHEN 'purchase' THEN 'idle' WHEN 'signup' THEN 'used' "
                 "WHEN 'error' THEN 'new' ELSE 'tested' END",
        "application_name": "'app' || CAST(user_id % 6 AS STRING)",
        "database": "'db' || CAST(user_id % 3 AS STRING)", "user": "'u' || CAST(user_id % 7 AS STRING)",
        "remote_pid": "CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(event_id AS INT) END",
        "close_needed": "CASE WHEN value > 90 THEN 1 ELSE 0 END",
        "connect_time": "ts - {secs:value * 4}",
    }
    return exprs(m, dialect)


def b11_lists_sql(dialect: str) -> str:
    return _dialect(
        f"SELECT {_POOL_SRV} AS server_id, {_HOUR_END} AS source_collected_at, "
        "CASE event_type WHEN 'click' THEN 'used_clients' WHEN 'view' THEN 'free_clients' "
        "WHEN 'purchase' THEN 'used_servers' WHEN 'signup' THEN 'free_servers' ELSE 'login_clients' END AS list, "
        "CAST(COUNT(*) AS STRING) AS items FROM events GROUP BY 1, 2, 3", dialect)


def pool_snapshot(spark: SparkSession, events: DataFrame) -> DataFrame:
    return _over(spark, events, "events", b11_pools_sql("spark"))


def pool_clients(events: DataFrame) -> DataFrame:
    return events.selectExpr(*b11_clients("spark"))


def pool_servers(events: DataFrame) -> DataFrame:
    return events.selectExpr(*b11_servers("spark"))


def pool_lists(spark: SparkSession, events: DataFrame) -> DataFrame:
    return _over(spark, events, "events", b11_lists_sql("spark"))


# ------------------------------------------------------- B13 load results, B14 capacity
_SPLIT = {"spark": "TIMESTAMP_NTZ '2024-01-16 00:00:00'", "duckdb": "TIMESTAMP '2024-01-16 00:00:00'"}


def b13_requests(dialect: str) -> list[str]:
    """B13 per-request load-test rows: baseline run before 2024-01-16, 'after' from then on."""
    s = _SPLIT[dialect]
    m = {"test_run_id": f"CASE WHEN ts < {s} THEN 'baseline' ELSE 'after' END", "phase_name": "'steady'",
         "ts": "ts", "day_index": f"CAST(day(ts) - CASE WHEN ts < {s} THEN 0 ELSE 15 END AS INT)",
         "ok": "(event_type <> 'error')", "latency_ms": "value"}
    return exprs(m, dialect)


def b13_daily_sql(dialect: str) -> str:
    """B13 per-day results: successful RPS, error rate, P90/P99 latency (the load tool's summary)."""
    pct = ("percentile(latency_ms, {q})" if dialect == "spark" else "quantile_cont(latency_ms, {q})")
    return _dialect(
        "SELECT test_run_id, phase_name, {day:ts} AS ts, day_index, "
        "CAST(SUM(CASE WHEN ok THEN 1 ELSE 0 END) AS DOUBLE) / 86400 AS successful_rps, "
        "CAST(SUM(CASE WHEN ok THEN 0 ELSE 1 END) AS DOUBLE) / COUNT(*) AS error_rate, "
        f"round({pct.format(q=0.9)}, 6) AS p90_ms, round({pct.format(q=0.99)}, 6) AS p99_ms "
        f"FROM (SELECT {', '.join(b13_requests(dialect))} FROM events) r GROUP BY 1, 2, 3, 4", dialect)


def b14_capacity_sql(dialect: str) -> str:
    """Per server, one capacity row per distinct week; vCores = 16 x week number; last row open."""
    return _dialect(
        "SELECT server_id, week_start AS effective_from, "
        "LEAD(week_start) OVER (PARTITION BY server_id ORDER BY week_start) AS effective_to, "
        "CAST(16 * rn AS INT) AS provisioned_vcores, 'vcores-' || CAST(16 * rn AS STRING) AS sku FROM ("
        "SELECT server_id, week_start, ROW_NUMBER() OVER (PARTITION BY server_id ORDER BY week_start) AS rn FROM ("
        "SELECT DISTINCT 'srv-' || CAST(user_id % 2 AS STRING) AS server_id, {week:ts} AS week_start "
        "FROM events) w) r", dialect)


def b16_limits_sql(dialect: str) -> str:
    """Per server and day, the connection limit in force from that day on: 3 + day % 5."""
    return _dialect(f"SELECT DISTINCT {_POOL_SRV} AS server_id, {{day:ts}} AS effective_at, "
                    "CAST(3 + day(ts) % 5 AS INT) AS max_connections FROM events", dialect)


def b17_disks_sql(dialect: str) -> str:
    """Hourly disk use of two servers: the series of resources 2 and 3, known at the end of their hour."""
    return _dialect("SELECT CASE resource_id WHEN 'res2' THEN 'srv-0' ELSE 'srv-1' END AS server_id, "
                    "time_utc + INTERVAL 1 HOUR AS known_at, value AS disk_percent FROM series "
                    "WHERE resource_id IN ('res2', 'res3')", dialect)


def connection_limits(spark: SparkSession, events: DataFrame) -> DataFrame:
    return _over(spark, events, "events", b16_limits_sql("spark"))


def disk_use(spark: SparkSession, events: DataFrame) -> DataFrame:
    return _over(spark, metric_series(spark, events), "series", b17_disks_sql("spark"))


def load_requests(events: DataFrame) -> DataFrame:
    return events.selectExpr(*b13_requests("spark"))


def load_daily(spark: SparkSession, events: DataFrame) -> DataFrame:
    return _over(spark, events, "events", b13_daily_sql("spark"))


def capacity_history(spark: SparkSession, events: DataFrame) -> DataFrame:
    return _over(spark, events, "events", b14_capacity_sql("spark"))


# ------------------------------------------------------------- B8 payloads
def b8_payload(dialect: str) -> list[str]:
    """``events.props`` as the JSON payload, plus a statement-statistics payload whose field
    names change with the server version (every third row legacy, every fifth with an empty value)."""
    cents = "CAST(CAST(round(value * 100) AS BIGINT) AS STRING)"
    # newer servers' fields: every seventh row has none of them, every sixth no launch counters, every fourth empty ones
    number = lambda name, e: f"', \"{name}\": ' || CAST({e} AS STRING)"
    newer = " || ".join([
        number("temp_blk_write_time", "user_id"), number("jit_functions", "event_id % 50"), number("jit_generation_time", "event_id % 9"),
        number("jit_inlining_count", "event_id % 3"), number("jit_inlining_time", "event_id % 8"), number("jit_optimization_count", "event_id % 2"),
        number("jit_optimization_time", "event_id % 10"), number("jit_emission_count", "event_id % 12"), number("jit_emission_time", "event_id % 13"),
        number("jit_deform_count", "event_id % 15")])
    launch = number("parallel_workers_to_launch", "user_id % 5") + " || " + number("parallel_workers_launched", "user_id % 4")
    since = ("', \"stats_since\": \"' || CASE WHEN event_id % 4 = 0 THEN '' ELSE CAST(ts AS STRING) END || "
             "'\", \"minmax_stats_since\": \"' || CAST(ts AS STRING) || '\"'")
    more = (f"(CASE WHEN event_id % 7 = 0 THEN '' ELSE {newer} || {since} END || "
            f"CASE WHEN event_id % 6 = 0 THEN '' ELSE {launch} END)")
    m = {
        "event_id": "event_id", "event_type": "event_type", "props": "props",
        "payload": (f"CASE WHEN event_id % 5 = 0 THEN '{{\"blk_read_time\": \"\", \"shared_blk_read_time\": ' || "
                    f"{cents} || {more} || '}}' WHEN event_id % 3 = 0 THEN '{{\"blk_read_time\": ' || {cents} || "
                    f"', \"wal_buffers_full\": 7' || {more} || '}}' ELSE '{{\"shared_blk_read_time\": ' || {cents} || "
                    f"', \"blk_write_time\": ' || CAST(user_id AS STRING) || ', \"jit_deform_time\": 1.5, \"temp_blk_read_time\": 2' || "
                    f"{more} || '}}' END"),
    }
    return exprs(m, dialect)


def payload_rows(events: DataFrame) -> DataFrame:
    return events.selectExpr(*b8_payload("spark"))


def b8_progress(dialect: str) -> list[str]:
    """JN-11 progress rows: purchases as vacuum, signups as analyze; pid = event id, progress = props."""
    m = {"server_id": "'srv-' || CAST(user_id % 2 AS STRING)", "source_collected_at": _HOUR_END,
         "pid": "CAST(event_id AS INT)", "progress": "props"}
    return exprs(m, dialect)


def progress_rows(events: DataFrame, event_type: str) -> DataFrame:
    return events.where(F.col("event_type") == event_type).selectExpr(*b8_progress("spark"))


# ------------------------------------------------------------- B12 runs and landed rows
def b12_runs(dialect: str) -> list[str]:
    """One collector run per event: query = user_id % 5, start = ts, end = start + floor(value * 20) s."""
    m = {
        "run_id": "'run-' || CAST(event_id AS STRING)", "event_id": "event_id",
        "query_id": "'Q0' || CAST(user_id % 5 AS STRING)",
        "server_id": "'srv-' || CAST(user_id % 2 AS STRING)",
        "scheduled_at": "ts", "started_at": "ts", "completed_at": "ts + {secs:floor(value * 20)}",
        "status": "CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END",
        "row_count": "CAST(user_id % 50 AS INT)",
        "duration_ms": "CAST(floor(value * 20) AS BIGINT) * 1000",
        "query_text": "'select ' || event_type || ' from t' || CAST(user_id % 5 AS STRING)",
    }
    return exprs(m, dialect)


def b12_rows(dialect: str) -> list[str]:
    """B12 landed rows: the rows of hourly runs (query, server, hour); receive clock = end of the event's run."""
    m = {
        "run_id": "'Q0' || CAST(user_id % 5 AS STRING) || ':' || CAST(user_id % 2 AS STRING) || ':' "
                  "|| CAST(day(ts) AS STRING) || ':' || CAST(hour(ts) AS STRING)",
        "query_id": "'Q0' || CAST(user_id % 5 AS STRING)",
        "server_id": "'srv-' || CAST(user_id % 2 AS STRING)",
        "sample_at": "{hour:ts}",
        "source_collected_at": "ts", "collector_received_at": "ts + {secs:floor(value * 20)}",
        "status": "CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END",
        "note": "CASE WHEN event_type = 'error' THEN 'failed' END",
        "event_id": "event_id", "event_type": "event_type", "value": "value",
    }
    return exprs(m, dialect)


def runs(events: DataFrame) -> DataFrame:
    return events.selectExpr(*b12_runs("spark"))


def landed_rows(events: DataFrame) -> DataFrame:
    return events.selectExpr(*b12_rows("spark"))


# ------------------------------------------------------------- SM-02 trigger samples
def trigger_samples_sql(dialect: str) -> str:
    """Stand-in collector samples (one per event): the condition columns the trigger rules read."""
    return ("SELECT 'srv-' || CAST(user_id % 2 AS STRING) AS server_id, ts, event_id AS seq, "
            "CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS lock_waiters, "
            "CASE WHEN event_type = 'view' AND value > 60 THEN 1 ELSE 0 END AS autovacuum_workers, "
            "CASE WHEN event_type = 'signup' AND value > 50 THEN 2 ELSE 0 END AS parallel_workers, "
            "CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS cl_waiting, "
            "CASE WHEN event_type = 'error' AND value > 50 THEN CAST(floor(value) AS BIGINT) ELSE 0 END AS maxwait, "
            "CASE WHEN event_type = 'error' AND value > 80 THEN 0 ELSE 1 END AS sv_idle, "
            "CASE WHEN event_type = 'view' AND value > 90 THEN 1 ELSE 0 END AS sv_tested, 0 AS sv_login, "
            "CASE WHEN event_type = 'click' AND value > 70 THEN 1 ELSE 0 END AS checkpoint_delta FROM events"
            ).replace("AS STRING", "AS STRING" if dialect == "spark" else "AS VARCHAR")


def trigger_samples(spark: SparkSession, events: DataFrame) -> DataFrame:
    return _over(spark, events, "events", trigger_samples_sql("spark"))
