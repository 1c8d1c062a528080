"""Connection pooler family (PRJ-18, AG-15 to AG-18, JN-18).

Inputs are the pooler's SHOW POOLS / CLIENTS / SERVERS / LISTS rows per sample
``(server_id, source_collected_at)``. Several groupings of one input are one
``groupingSets`` aggregation (one scan, one shuffle), with a ``grouping`` bit level telling
the levels apart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statsweep.functions.scalars import safe_percent

SAMPLE = ("server_id", "source_collected_at")

# SHOW LISTS entries turned into columns.
LIST_NAMES = ("databases", "users", "pools", "free_clients", "used_clients", "login_clients", "free_servers",
              "used_servers", "dns_names", "dns_zones", "dns_queries", "dns_pending")


def _sum(cols: Sequence[str]) -> Column:
    out = F.coalesce(F.col(cols[0]), F.lit(0))
    for c in cols[1:]:
        out = out + F.coalesce(F.col(c), F.lit(0))
    return out


CLIENT_COLS = ("cl_active", "cl_waiting", "cl_active_cancel_req", "cl_waiting_cancel_req")
SERVER_COLS = ("sv_active", "sv_idle", "sv_used", "sv_tested", "sv_login", "sv_active_cancel", "sv_being_canceled")
BUSY_COLS = ("sv_active", "sv_used", "sv_tested", "sv_login", "sv_active_cancel", "sv_being_canceled")


def grouping_level(*cols: str) -> Column:
    """Bit vector of which ``cols`` are aggregated away (first column = most significant bit)."""
    n = len(cols)
    out = F.lit(0)
    for i, c in enumerate(cols):
        out = out + F.grouping(c).cast("long") * F.lit(1 << (n - 1 - i))
    return out


def pool_derived(pools: DataFrame) -> DataFrame:
    """PRJ-18: client/server/busy connections, not-immediately-idle %, oldest wait, pooling ratio."""
    p = pools.select("*", _sum(CLIENT_COLS).alias("pgbouncer_client_connections"),
                     _sum(SERVER_COLS).alias("pgbouncer_server_connections"),
                     _sum(BUSY_COLS).alias("pgbouncer_server_busy_connections"))
    return p.select(
        "*",
        safe_percent("pgbouncer_server_busy_connections", "pgbouncer_server_connections")
        .alias("server_pool_not_immediately_idle_percent"),
        (F.col("maxwait") + F.col("maxwait_us") / F.lit(1_000_000.0)).alias("oldest_client_wait_seconds"),
        F.col("cl_waiting").alias("pool_queue_depth"),
        F.when(F.col("pgbouncer_server_connections") != 0,
               F.col("pgbouncer_client_connections") / F.col("pgbouncer_server_connections"))
        .alias("client_to_server_pooling_ratio"))


def pool_totals(pools: DataFrame) -> DataFrame:
    """AG-15: per-pool rows and the all-pool aggregate per sample (grouping sets, ``grouping_level``)."""
    d = pool_derived(pools)
    keys = [*SAMPLE, "database", "user", "pool_mode"]
    sums = [F.sum(c).alias(c) for c in (*CLIENT_COLS, *SERVER_COLS, "pgbouncer_client_connections",
                                        "pgbouncer_server_connections", "pgbouncer_server_busy_connections")]
    g = d.groupingSets([keys, list(SAMPLE)], *keys).agg(
        *sums, F.max("oldest_client_wait_seconds").alias("oldest_client_wait_seconds"),
        grouping_level("database", "user", "pool_mode").alias("grouping_level"))
    return g.select("*", safe_percent("pgbouncer_server_busy_connections", "pgbouncer_server_connections")
                    .alias("server_pool_not_immediately_idle_percent"))


def client_diagnostics(clients: DataFrame) -> DataFrame:
    """AG-16: waiting/active/idle counts and max wait, per sample, by application and by address."""
    st = F.col("state")
    wait = F.col("wait") + F.col("wait_us") / F.lit(1_000_000.0)
    keys = [*SAMPLE, "application_name", "addr"]
    return clients.groupingSets([list(SAMPLE), [*SAMPLE, "application_name"], [*SAMPLE, "addr"]], *keys).agg(
        F.count(F.lit(1)).alias("client_count"),
        F.count_if(st == "waiting").alias("waiting_client_count"),
        F.count_if(st == "active").alias("active_client_count"),
        F.count_if(st == "idle").alias("idle_client_count"),
        F.max(wait).alias("max_client_wait_seconds"),
        grouping_level("application_name", "addr").alias("grouping_level"))


def server_diagnostics(servers: DataFrame) -> DataFrame:
    """AG-17: server counts by state, close-needed, by database and user, by application."""
    st = F.col("state")
    keys = [*SAMPLE, "state", "database", "user", "application_name"]
    sets = [list(SAMPLE), [*SAMPLE, "state"], [*SAMPLE, "database", "user"], [*SAMPLE, "application_name"]]
    return servers.groupingSets(sets, *keys).agg(
        F.count(F.lit(1)).alias("server_count"),
        F.count_if(st == "active").alias("server_active_count"),
        F.count_if(st == "idle").alias("server_idle_count"),
        F.count_if(st == "used").alias("server_used_count"),
        F.count_if(st == "new").alias("server_new_count"),
        F.count_if(F.col("close_needed") == 1).alias("server_close_needed_count"),
        grouping_level("state", "database", "user", "application_name").alias("grouping_level"))


def pivot_lists(lists: DataFrame, names: Sequence[str] = LIST_NAMES) -> DataFrame:
    """AG-18: SHOW LISTS name/value rows to columns (fixed value list, so no extra pass), with used-object %."""
    p = lists.groupBy(*SAMPLE).pivot("list", list(names)).agg(F.first(F.col("items").try_cast("long")))
    return p.select(
        "*",
        safe_percent("used_clients", F.col("used_clients") + F.col("free_clients")).alias("used_client_object_percent"),
        safe_percent("used_servers", F.col("used_servers") + F.col("free_servers")).alias("used_server_object_percent"))


def reconcile_pool_backends(pool_servers: DataFrame, sessions: DataFrame) -> DataFrame:
    """JN-18: pooler server connections against backends by pid (full outer join per sample).

    Per sample, database and user: matched, pooler-only and backend-only counts.
    Pooler rows without a remote pid cannot match and count as pooler-only.
    """
    ps = pool_servers.select(*SAMPLE, F.col("remote_pid").alias("pid"), F.lit(True).alias("_in_pool"),
                             F.col("database").alias("_p_db"), F.col("user").alias("_p_user"))
    be = sessions.where(F.col("backend_type") == "client backend").select(
        *SAMPLE, "pid", F.lit(True).alias("_in_backend"), F.col("datname").alias("_b_db"),
        F.col("usename").alias("_b_user"))
    j = ps.join(be, [*SAMPLE, "pid"], "full_outer")
    db = F.coalesce("_p_db", "_b_db").alias("database")
    user = F.coalesce("_p_user", "_b_user").alias("user")
    inp, inb = F.coalesce("_in_pool", F.lit(False)), F.coalesce("_in_backend", F.lit(False))
    return j.groupBy(*SAMPLE, db, user).agg(
        F.count_if(inp & inb).alias("matched_count"),
        F.count_if(inp & ~inb).alias("pooler_only_count"),
        F.count_if(~inp & inb).alias("backend_only_count"))
