"""Activity family (AG-01 to AG-08, AG-29, JN-06 to JN-08, WN-11, WN-12).

Input is the ``sessions`` dataset (one row per backend per sample) with ages from
``functions.scalars.session_ages``; a sample is ``(server_id, source_collected_at)``.
Every aggregate is a ``groupBy`` on the sample key (partial aggregation map-side),
never a collect of a whole sample; nested lists are bounded by a top-k.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statsweep.functions.scalars import safe_percent
from statsweep.operators.deltas import seconds_between, with_previous

SAMPLE = ("server_id", "source_collected_at")

def CLIENT() -> Column:  # noqa: N802
    return F.col("backend_type") == "client backend"


def ACTIVE() -> Column:  # noqa: N802
    return F.col("state") == "active"


def WORKER() -> Column:  # noqa: N802
    return F.col("backend_type") == "parallel worker"

# System backend types always kept among interesting sessions.
SYSTEM_BACKEND_TYPES = ("autovacuum worker", "parallel worker", "checkpointer", "background writer",
                        "walwriter", "startup")

# Top-k sizes of the reference's nested lists.
TOP_WAIT_GROUPS = 500
TOP_SESSIONS = 200


def topk(df: DataFrame, partition: Sequence[str], order: Sequence[Column], k: int | None,
         rank_col: str = "rank") -> DataFrame:
    """WN-11: first ``k`` rows per partition in ``order`` (``k=None`` keeps all, ranked).

    ``order`` must end in a unique tie-break for a deterministic result; Catalyst
    plans ``row_number() <= k`` as a per-group ``WindowGroupLimit`` before the shuffle.
    """
    w = Window.partitionBy(*partition).orderBy(*order)
    out = df.withColumn(rank_col, F.row_number().over(w))
    return out.where(F.col(rank_col) <= k) if k is not None else out


def attach_scalars(df: DataFrame, per_sample: DataFrame, keys: Sequence[str] = SAMPLE) -> DataFrame:
    """JN-06: per-sample constants (settings, totals) joined to every row of the sample."""
    return df.join(per_sample, list(keys), "left")


def activity_summary(sessions: DataFrame, settings: DataFrame) -> DataFrame:
    """AG-01 with JN-07: one row per sample, zero counts when a sample has no sessions.

    ``settings`` is the sample spine (one row per sample with max_connections and the
    worker limits). The aggregation runs on the sessions first, then the small result
    is joined to the spine.
    """
    s = sessions
    cnt = F.count_if
    wait_group = F.when(
        CLIENT() & ACTIVE() & F.col("wait_event_type").isNotNull(),
        F.struct("datid", "datname", "application_name", "query_id", "wait_event_type", "wait_event"),
    )
    agg = s.groupBy(*SAMPLE).agg(
        cnt(CLIENT()).alias("client_connections"),
        cnt(CLIENT() & ACTIVE()).alias("active_client_connections"),
        cnt(CLIENT() & (F.col("state") == "idle")).alias("idle_client_connections"),
        cnt(CLIENT() & F.col("state").startswith("idle in transaction")).alias("idle_in_transaction_connections"),
        cnt(CLIENT() & ACTIVE() & F.col("wait_event_type").isNotNull()).alias("active_waiting_sessions"),
        cnt(CLIENT() & ACTIVE() & (F.col("wait_event_type") == "Lock")).alias("active_lock_waiting_sessions"),
        cnt(CLIENT() & ACTIVE() & (F.col("wait_event_type") == "IO")).alias("active_io_waiting_sessions"),
        cnt(CLIENT() & ACTIVE() & (F.col("wait_event_type") == "LWLock")).alias("active_lwlock_waiting_sessions"),
        cnt(CLIENT() & ACTIVE() & (F.col("wait_event_type") == "BufferPin")).alias("active_bufferpin_waiting_sessions"),
        cnt(CLIENT() & ACTIVE() & F.col("wait_event_type").isNull()).alias("active_cpu_or_running_sessions"),
        F.max("active_query_age_seconds").alias("longest_active_query_seconds"),
        F.max("transaction_age_seconds").alias("longest_transaction_seconds"),
        F.max("idle_in_transaction_age_seconds").alias("longest_idle_in_transaction_seconds"),
        F.count_distinct(wait_group).alias("wait_query_group_count"),
        cnt(WORKER()).alias("active_parallel_workers"),
        cnt(WORKER() & F.col("wait_event_type").isNull()).alias("parallel_workers_running_or_not_waiting"),
        cnt(WORKER() & F.col("wait_event_type").isNotNull()).alias("parallel_workers_waiting"),
        F.count_distinct(F.when(WORKER(), F.col("leader_pid"))).alias("active_parallel_query_groups"),
    )
    zero_cols = [c for c in agg.columns if c not in SAMPLE and not c.startswith("longest_")]
    out = settings.join(agg, list(SAMPLE), "left").fillna(0, subset=zero_cols)
    return out.select(
        "*",
        safe_percent("client_connections", "max_connections").alias("connection_utilization_percent"),
        safe_percent("active_parallel_workers", "max_parallel_workers").alias(
            "parallel_worker_pool_utilization_percent"),
    )


def count_map(df: DataFrame, key: str, default: str = "unknown", where: Column | None = None,
              keys: Sequence[str] = SAMPLE) -> DataFrame:
    """AG-02: value counts per sample as a map (null value -> ``default``).

    The map is built from the grouped counts, so its size is the number of distinct
    values (a handful of states or backend types), not the number of rows.
    """
    src = df.where(where) if where is not None else df
    counts = src.groupBy(*keys, F.coalesce(F.col(key), F.lit(default)).alias("_k")).count()
    return counts.groupBy(*keys).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("_k", "count")))).alias(f"{key}_counts"))


def wait_type_counts(sessions: DataFrame) -> DataFrame:
    """AG-03: active client sessions per wait type; null type -> 'CPU_or_not_waiting'."""
    return (sessions.where(CLIENT() & ACTIVE())
            .groupBy(*SAMPLE, F.coalesce("wait_event_type", F.lit("CPU_or_not_waiting")).alias("wait_event_type"))
            .agg(F.count(F.lit(1)).alias("session_count")))


def wait_event_counts(sessions: DataFrame) -> DataFrame:
    """AG-04: active waiting client sessions per (type, event) with the longest query age."""
    return (sessions.where(CLIENT() & ACTIVE() & F.col("wait_event_type").isNotNull())
            .groupBy(*SAMPLE, "wait_event_type", "wait_event")
            .agg(F.count(F.lit(1)).alias("session_count"),
                 F.max("active_query_age_seconds").alias("longest_query_age_seconds")))


WAIT_QUERY_KEYS = ("datid", "datname", "application_name", "query_id", "wait_event_type", "wait_event")


def waits_by_query(sessions: DataFrame, k: int | None = TOP_WAIT_GROUPS) -> DataFrame:
    """AG-05: waits by database, application, query and event (null keys form groups).

    Adds the per-sample group count and keeps the top ``k`` groups by session count,
    then longest age (nulls last), then the keys.
    """
    g = (sessions.where(CLIENT() & ACTIVE() & F.col("wait_event_type").isNotNull())
         .groupBy(*SAMPLE, *WAIT_QUERY_KEYS)
         .agg(F.count(F.lit(1)).alias("session_count"),
              F.max("active_query_age_seconds").alias("longest_query_age_seconds")))
    g = g.withColumn("wait_query_group_count", F.count(F.lit(1)).over(Window.partitionBy(*SAMPLE)))
    order = [F.col("session_count").desc(), F.col("longest_query_age_seconds").desc_nulls_last(),
             *[F.col(c).asc_nulls_first() for c in WAIT_QUERY_KEYS]]
    return topk(g, SAMPLE, order, k)


def system_backend_waits(sessions: DataFrame) -> DataFrame:
    """AG-06: waits of non-client processes; ``<>`` drops rows with a null backend type."""
    return (sessions.where((F.col("backend_type") != "client backend") & F.col("wait_event_type").isNotNull())
            .groupBy(*SAMPLE, "backend_type", "wait_event_type", "wait_event")
            .agg(F.count(F.lit(1)).alias("process_count")))


def worker_groups(sessions: DataFrame) -> DataFrame:
    """AG-07: per leader: launched workers, running/waiting counts by wait type, ordered worker list.

    The list holds one group's workers (bounded by max_parallel_workers_per_gather).
    """
    wt = F.col("wait_event_type")
    return (sessions.where(WORKER() & F.col("leader_pid").isNotNull())
            .groupBy(*SAMPLE, "leader_pid")
            .agg(F.count(F.lit(1)).alias("launched_worker_count"),
                 F.count_if(wt.isNull()).alias("workers_running_or_not_waiting"),
                 F.count_if(wt.isNotNull()).alias("workers_waiting"),
                 F.count_if(wt == "IO").alias("workers_waiting_io"),
                 F.count_if(wt == "LWLock").alias("workers_waiting_lwlock"),
                 F.count_if(wt == "Lock").alias("workers_waiting_lock"),
                 F.count_if(wt == "IPC").alias("workers_waiting_ipc"),
                 F.sort_array(F.collect_list(F.struct(
                     F.col("pid").alias("worker_pid"), "state", "wait_event_type", "wait_event"))).alias("workers")))


def parallel_groups(sessions: DataFrame) -> DataFrame:
    """JN-08: worker groups joined to their leader's session (self equi join on sample and pid)."""
    g = worker_groups(sessions)
    leaders = sessions.select(
        *SAMPLE, F.col("pid").alias("leader_pid"), "datid", "datname", "usename", "application_name",
        F.col("state").alias("leader_state"), F.col("wait_event_type").alias("leader_wait_event_type"),
        F.col("wait_event").alias("leader_wait_event"), "query_id",
        seconds_between("source_collected_at", "query_start").alias("query_age_seconds"),
        F.col("query").alias("query_text"))
    return g.join(leaders, [*SAMPLE, "leader_pid"], "inner")


def ordered_structs(df: DataFrame, keys: Sequence[str], order: Sequence[Column], fields: Sequence[str],
                    k: int | None = None, out: str = "items", spine: DataFrame | None = None) -> DataFrame:
    """AG-08: ordered nested list per group (top ``k``), ``[]`` for groups of ``spine`` with no rows.

    Rows are ranked first (bounded by ``k``) and the list is sorted by rank, so the
    per-group list never exceeds ``k`` entries.
    """
    ranked = topk(df, keys, order, k, rank_col="_rank")
    lists = ranked.groupBy(*keys).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("_rank", *fields))),
                    lambda x: x.dropFields("_rank")).alias(out))
    if spine is not None:
        lists = spine.select(*keys).join(lists, list(keys), "left").withColumn(
            out, F.coalesce(F.col(out), F.array().cast(lists.schema[out].dataType)))
    return lists


def interesting_sessions(sessions: DataFrame, k: int | None = TOP_SESSIONS) -> DataFrame:
    """WN-12: idle-in-transaction, waiting or >= 2 s active clients and system processes, oldest first."""
    cond = (F.col("state").startswith("idle in transaction")
            | (CLIENT() & ACTIVE() & (F.col("wait_event_type").isNotNull() | (F.col("active_query_age_seconds") >= 2)))
            | F.col("backend_type").isin(*SYSTEM_BACKEND_TYPES))
    age = F.coalesce("active_query_age_seconds", "transaction_age_seconds", F.lit(0.0))
    return topk(sessions.where(cond), SAMPLE, [age.desc(), F.col("pid").asc()], k)


def _with_interval(summary: DataFrame, nominal_interval_ms: float) -> DataFrame:
    """``actual_sampling_interval_ms``: the time since the server's previous sample, the nominal cadence for its first."""
    x = with_previous(summary, ["server_id"], ["source_collected_at"], ["source_collected_at"], "source_collected_at", "_before")
    gap = F.timestamp_diff("MILLISECOND", F.col("_before.source_collected_at"), F.col("source_collected_at")).cast("double")
    return x.withColumn("actual_sampling_interval_ms", F.coalesce(gap, F.lit(nominal_interval_ms))).drop("_before")


def wait_event_shares(summary: DataFrame, by_event: DataFrame, nominal_interval_ms: float = 15000.0) -> DataFrame:
    """AG-29: share of each wait event among the sample's waiting active client sessions, its share among those of the same
    type and its sampled occupancy. ``by_event`` is AG-04's result; a sample's and a type's totals are grouped sums."""
    kind = [*SAMPLE, "wait_event_type"]
    s = _with_interval(summary, nominal_interval_ms).select(*SAMPLE, "active_client_connections", "actual_sampling_interval_ms")
    of_type = by_event.groupBy(*kind).agg(F.sum("session_count").alias("_type"))
    of_all = by_event.groupBy(*SAMPLE).agg(F.sum("session_count").alias("_all"))
    return by_event.join(s, list(SAMPLE)).join(of_type, kind).join(of_all, list(SAMPLE)).select(
        *kind, "wait_event", "session_count",
        safe_percent("session_count", "active_client_connections").alias("wait_event_share_percent"),
        safe_percent("session_count", "_type").alias("share_of_type_percent"),
        safe_percent("session_count", "_all").alias("share_of_waits_percent"),
        (F.col("session_count") * F.col("actual_sampling_interval_ms")).alias("sampled_wait_occupancy_ms"))


def wait_shares(summary: DataFrame, by_type: DataFrame, interval_col: str | None = None,
                nominal_interval_ms: float = 15000.0) -> DataFrame:
    """AG-29: wait-type share of active client sessions and sampled occupancy per sample.

    The actual sampling interval is the time since the server's previous sample
    (``lag``), falling back to the nominal cadence for a server's first sample.
    """
    timed = _with_interval(summary, nominal_interval_ms)
    s = timed.select(
        *SAMPLE, "active_client_connections", "active_parallel_workers", "parallel_workers_waiting", "actual_sampling_interval_ms",
        safe_percent("parallel_workers_waiting", "active_parallel_workers").alias(
            "parallel_worker_wait_share_percent"))
    return by_type.join(s, list(SAMPLE), "inner").select(
        *SAMPLE, "wait_event_type", "session_count",
        safe_percent("session_count", "active_client_connections").alias("wait_type_share_percent"),
        (F.col("session_count") * F.col("actual_sampling_interval_ms")).alias("sampled_wait_occupancy_ms"),
        "parallel_worker_wait_share_percent")
