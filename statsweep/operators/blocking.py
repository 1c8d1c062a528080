"""Blocking family (RC-01 to RC-03, AG-14, JN-09).

A lock sample is ``(server_id, source_collected_at)``; wait-for edges live inside
one sample and every join below is keyed by the sample plus a pid, so many
servers and a long history spread over the cluster by sample.

Chain depth is the longest chain of distinct pids that a blocked pid waits on, at most
32. No paths are kept: a level is the set of pids that start a chain of that length, and only
pids on a cycle are searched. Every few levels are written with a reliable ``checkpoint()``
(the session's ``spark.checkpoint.dir``), so lineage stays short and a lost executor
recomputes a few levels only.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statsweep.functions.scalars import quote_relation
from statsweep.operators.deltas import seconds_between
from statsweep.session import ensure_checkpoint_dir

SAMPLE = ("server_id", "source_collected_at")
MAX_DEPTH = 32
STRIDE = 4  # levels in one job


def wait_edges(locks: DataFrame, sample: Sequence[str] = SAMPLE) -> DataFrame:
    """RC-01: blocker lists of waiting (not granted) locks exploded to edges."""
    return locks.where(~F.col("granted")).select(
        *sample, F.col("pid").alias("blocked_pid"), F.explode("blocking_pids").alias("blocker_pid"))


def blocker_summary(edges: DataFrame, sample: Sequence[str] = SAMPLE) -> DataFrame:
    """AG-14: direct blocker count and sorted blocker list per blocked pid."""
    return edges.groupBy(*sample, "blocked_pid").agg(
        F.count(F.lit(1)).alias("direct_blocker_count"),
        F.sort_array(F.collect_list("blocker_pid")).alias("direct_blocker_pids"))


def _stable(df: DataFrame, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``df`` after ``step``, which only takes rows away, has been applied until nothing changes."""
    n = df.count()
    while n:
        for _ in range(STRIDE):
            df = step(df)
        df = df.checkpoint()
        before, n = n, df.count()
        if n == before:
            break
    return df


def longest_chains(succ: dict[int, list[int]], leave: dict[int, int], most: int) -> dict[int, int]:
    """Longest chain of distinct nodes from each node of a small cyclic graph, at most ``most``: steps along ``succ`` and, at
    the end, the ``leave`` steps of the last node that lead out of the graph."""
    out = {}
    for root in succ.keys() | leave.keys():
        best, stack = 0, [(root, 0, frozenset([root]))]
        while stack and best < most:
            node, steps, seen = stack.pop()
            best = max(best, steps + leave.get(node, 0))
            stack += [(n, steps + 1, seen | {n}) for n in succ.get(node, ()) if n not in seen]
        out[root] = min(best, most)
    return out


def chain_depth(edges: DataFrame, max_depth: int = MAX_DEPTH, sample: Sequence[str] = SAMPLE) -> DataFrame:
    """RC-02: greatest chain depth per blocked pid, at most ``max_depth``: the longest chain of distinct pids it waits on.

    Level d holds the pids that start a walk of d edges; each level is one equi join and a distinct, whatever the number of
    paths. Without cycles walks are chains, and a pid's depth is its last level. The pids with endless walks reach a cycle:
    those among them that also lie behind one (the core) are searched, each connected part of a sample's core in one
    group, and the pids that merely wait for the core add their steps to its depths. An edge from a pid to itself
    counts as one step and isn't followed.
    """
    sample = list(sample)
    node = [*sample, "pid"]
    ensure_checkpoint_dir(edges.sparkSession)
    every = edges.select(*sample, F.col("blocked_pid").alias("pid"), F.col("blocker_pid").alias("on")).distinct().checkpoint()
    e = every.where("pid <> on")

    def waiting(pids: DataFrame) -> DataFrame:
        """Pids that wait for one of ``pids``."""
        return e.join(pids.withColumnRenamed("pid", "on"), [*sample, "on"]).select(*node).distinct()

    level = every.select(*node).distinct()
    steps = [level.withColumn("depth", F.lit(1))]
    level = e.select(*node).distinct()
    for depth in range(2, max_depth + 1):
        level = waiting(level)
        if depth % STRIDE == 0:
            level = level.checkpoint()
            if level.isEmpty():
                break
        steps.append(level.withColumn("depth", F.lit(depth)))
    walks = steps[0]
    for more in steps[1:]:
        walks = walks.unionByName(more)
    walks = walks.groupBy(*node).agg(F.max("depth").alias("depth"))
    result = lambda d: d.select(*sample, F.col("pid").alias("root_blocked_pid"), F.col("depth").alias("maximum_chain_depth"))
    if level.isEmpty() or (endless := _stable(level, waiting)).isEmpty():
        return result(walks)
    walks = walks.checkpoint()

    # inside: edges between pids with endless walks; leave: the longest way out of each to pids without
    ends = endless.withColumnRenamed("pid", "on")
    inside = e.join(endless, node, "left_semi").join(ends, [*sample, "on"], "left_semi").checkpoint()
    known = walks.join(endless, node, "left_anti")
    out = (e.join(endless, node, "left_semi").join(ends, [*sample, "on"], "left_anti")
           .join(known.withColumnRenamed("pid", "on"), [*sample, "on"], "left")
           .groupBy(*node).agg(F.max(1 + F.coalesce("depth", F.lit(0))).alias("leave")))
    core = _stable(endless, lambda pids: inside.join(pids, node, "left_semi").select(*sample, F.col("on").alias("pid")).distinct())
    links = inside.join(core, node, "left_semi")
    # parts of the core: the smallest pid spreads along its edges
    both = links.unionByName(links.select(*sample, F.col("on").alias("pid"), F.col("pid").alias("on"))).checkpoint()
    part, last = core.withColumn("part", F.col("pid")).checkpoint(), None
    while last is None or not part.exceptAll(last).isEmpty():
        last = part
        for _ in range(STRIDE):
            near = both.join(part.withColumnRenamed("pid", "on"), [*sample, "on"]).select(*node, "part")
            part = part.unionByName(near).groupBy(*node).agg(F.min("part").alias("part"))
        part = part.checkpoint()
    rows = (part.join(out, node, "left").select(*node, "part", "leave", F.lit(None).cast("bigint").alias("on"))
            .unionByName(links.join(part, node).select(*node, "part", F.lit(None).cast("int").alias("leave"), F.col("on").cast("bigint"))))

    def search(group: pd.DataFrame) -> pd.DataFrame:
        succ, leave = defaultdict(list), {}
        for pid, on, gap in zip(group["pid"], group["on"], group["leave"]):
            if pd.notna(on):
                succ[pid].append(int(on))
            else:
                leave[pid] = 0 if pd.isna(gap) else int(gap)
        found = longest_chains(succ, leave, max_depth)
        head = {c: group[c].iloc[0] for c in sample}
        return pd.DataFrame([{**head, "pid": pid, "depth": d} for pid, d in found.items()], columns=[*node, "depth"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in core.schema) + ", depth int"
    searched = rows.groupBy(*sample, "part").applyInPandas(search, schema).checkpoint()
    # pids that wait for the core or for each other: after k rounds every chain with at most k of them is counted
    behind = endless.join(core, node, "left_anti").checkpoint()
    first = inside.join(searched.withColumnRenamed("pid", "on"), [*sample, "on"]).groupBy(*node).agg(F.max(F.col("depth") + 1).alias("reach"))
    depth = behind.join(out, node, "left").join(first, node, "left").select(
        *node, F.greatest(F.lit(1), F.coalesce("leave", F.lit(1)), F.coalesce("reach", F.lit(1))).alias("depth"))
    among, last = inside.join(behind, node, "left_semi").checkpoint(), None
    for k in range(1, max_depth):
        longer = among.join(depth.withColumnRenamed("pid", "on"), [*sample, "on"]).select(*node, (F.col("depth") + 1).alias("depth"))
        depth = depth.unionByName(longer).groupBy(*node).agg(F.max("depth").alias("depth"))
        if k % STRIDE == 0:
            depth = depth.checkpoint()
            if last is not None and depth.exceptAll(last).isEmpty():
                break
            last = depth
    depth = depth.withColumn("depth", F.least("depth", F.lit(max_depth)))
    return result(known.unionByName(searched).unionByName(depth))


def waits_on(edges: DataFrame, sample: Sequence[str] = SAMPLE) -> DataFrame:
    """Every distinct (root blocked pid, blocker pid) that a chain of any length connects, a pid itself left out.

    Breadth first: a level holds only the pairs not met before, so cycles end, fan-in does not multiply
    rows, and the pairs are bounded by the squared size of a sample's lock graph. Each level is written
    with a reliable ``checkpoint()``.
    """
    sample = list(sample)
    ensure_checkpoint_dir(edges.sparkSession)
    pair = [*sample, "root_blocked_pid", "blocker_pid"]
    e = edges.where(F.col("blocked_pid") != F.col("blocker_pid")).select(*sample, "blocked_pid", "blocker_pid").distinct().checkpoint()
    hop = e.select(*sample, F.col("blocked_pid").alias("_at"), F.col("blocker_pid").alias("_next"))
    seen = level = e.select(*sample, F.col("blocked_pid").alias("root_blocked_pid"), "blocker_pid")
    while True:
        step = level.withColumnRenamed("blocker_pid", "_at").join(hop, [*sample, "_at"]).where(
            F.col("_next") != F.col("root_blocked_pid")).select(*sample, "root_blocked_pid", F.col("_next").alias("blocker_pid"))
        level = step.distinct().join(seen, pair, "left_anti").checkpoint()
        if level.isEmpty():
            return seen
        seen = seen.unionByName(level)


def root_blockers(edges: DataFrame, sample: Sequence[str] = SAMPLE) -> DataFrame:
    """RC-03: blockers that are not blocked themselves, with direct and total (transitive) waiters."""
    sample = list(sample)
    r = waits_on(edges, sample)
    blocked = edges.select(*sample, F.col("blocked_pid").alias("blocker_pid")).distinct()
    roots = edges.select(*sample, "blocker_pid").distinct().join(blocked, [*sample, "blocker_pid"], "left_anti")
    direct = edges.groupBy(*sample, "blocker_pid").agg(F.count_distinct("blocked_pid").alias("direct_waiters"))
    total = r.groupBy(*sample, "blocker_pid").agg(F.count_distinct("root_blocked_pid").alias("total_waiters"))
    return roots.join(direct, [*sample, "blocker_pid"], "left").join(total, [*sample, "blocker_pid"], "left")


def _age(as_of: Column, c: str) -> Column:
    return seconds_between(as_of, F.col(c))


def blocking_pairs(locks: DataFrame, sessions: DataFrame, relations: DataFrame, current_datid: int,
                   max_depth: int = MAX_DEPTH, sample: Sequence[str] = SAMPLE,
                   text_limit: int = 2000) -> DataFrame:
    """JN-09: waiting lock x each direct blocker, with both sessions, relation name and chain summary.

    Blocked session: inner join; blocker session, relation, summaries: left joins; all
    keyed by the sample plus pid or relation oid. The relation name is given only for
    relations of ``current_datid`` or shared ones (database 0).
    """
    sample = list(sample)
    waiting = locks.where(~F.col("granted"))
    edges = wait_edges(locks, sample)
    summ = blocker_summary(edges, sample).withColumnRenamed("blocked_pid", "pid")
    depth = chain_depth(edges, max_depth, sample).withColumnRenamed("root_blocked_pid", "pid")
    counts = waiting.groupBy(*sample).agg(F.count(F.lit(1)).alias("waiting_lock_count"))
    as_of = F.col("source_collected_at")
    blocked = sessions.select(
        *sample, "pid", "datname", F.col("usename").alias("blocked_user"),
        F.col("application_name").alias("blocked_application_name"),
        F.col("client_addr").alias("blocked_client_addr"), F.col("query_id").alias("blocked_query_id"),
        F.col("wait_event_type").alias("blocked_wait_event_type"), F.col("wait_event").alias("blocked_wait_event"),
        F.col("query_start").alias("_b_qs"), F.col("xact_start").alias("_b_xs"),
        F.left(F.col("query"), F.lit(text_limit)).alias("blocked_query_text"))
    blocker = sessions.select(
        *sample, F.col("pid").alias("blocking_pid"), F.col("usename").alias("blocking_user"),
        F.col("application_name").alias("blocking_application_name"),
        F.col("client_addr").alias("blocking_client_addr"), F.col("state").alias("blocking_state"),
        F.col("query_id").alias("blocking_query_id"),
        F.col("query_start").alias("_k_qs"), F.col("xact_start").alias("_k_xs"),
        F.left(F.col("query"), F.lit(text_limit)).alias("blocking_query_text"))
    rel = relations.select(*sample, F.col("oid").alias("relation"),
                           quote_relation("schemaname", "relname").alias("_relname"))
    e2 = edges.select(*sample, F.col("blocked_pid").alias("pid"), F.col("blocker_pid").alias("blocking_pid"))
    j = (waiting.select(*sample, "pid", "locktype", F.col("mode").alias("requested_lock_mode"), "waitstart",
                        "database", "relation", "page", "tuple", "transactionid", "virtualxid")
         .join(blocked, [*sample, "pid"], "inner")
         .join(summ, [*sample, "pid"], "left")
         .join(depth, [*sample, "pid"], "left")
         .join(e2, [*sample, "pid"], "left")
         .join(blocker, [*sample, "blocking_pid"], "left")
         .join(rel, [*sample, "relation"], "left")
         .join(counts, sample, "left"))
    rel_visible = F.col("relation").isNotNull() & (
        (F.col("database") == F.lit(current_datid)) | (F.col("database") == 0))
    return j.select(
        *sample, "waiting_lock_count", F.col("pid").alias("blocked_pid"), "datname", "blocked_user",
        "blocked_application_name", "blocked_client_addr", "blocked_query_id", "blocked_wait_event_type",
        "blocked_wait_event", "locktype", "requested_lock_mode", "waitstart",
        _age(as_of, "waitstart").alias("actual_lock_wait_seconds"),
        _age(as_of, "_b_qs").alias("blocked_query_age_seconds"),
        _age(as_of, "_b_xs").alias("blocked_transaction_age_seconds"),
        F.when(rel_visible, F.col("_relname")).alias("locked_relation_name"),
        F.col("relation").alias("locked_relation_oid"), "page", "tuple", "transactionid", "virtualxid",
        "direct_blocker_count", "direct_blocker_pids",
        F.coalesce(F.col("maximum_chain_depth"), F.lit(0)).alias("maximum_chain_depth"),
        "blocking_pid", "blocking_user", "blocking_application_name", "blocking_client_addr", "blocking_state",
        "blocking_query_id",
        _age(as_of, "_k_qs").alias("blocking_query_age_seconds"),
        _age(as_of, "_k_xs").alias("blocking_transaction_age_seconds"),
        "blocked_query_text", "blocking_query_text")
