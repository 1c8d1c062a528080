"""Blocking chains: a cycle, a fan-in and a null wait start."""

import datetime as dt

from statsweep.operators.blocking import blocking_pairs, chain_depth, root_blockers, wait_edges

T0 = dt.datetime(2024, 1, 1)


def _locks(spark, rows):
    return spark.createDataFrame(
        [("s", T0, pid, "relation", "ShareLock", 1, 5, None, None, None, None, granted, ws, blockers)
         for pid, granted, ws, blockers in rows],
        "server_id string, source_collected_at timestamp_ntz, pid int, locktype string, mode string, database long, "
        "relation long, page int, tuple int, virtualxid string, transactionid string, granted boolean, "
        "waitstart timestamp_ntz, blocking_pids array<int>")


ROWS = [
    (1, False, T0 - dt.timedelta(seconds=40), [2]),   # 1 -> 2 -> 3 -> 1 is a cycle
    (2, False, T0 - dt.timedelta(seconds=30), [3]),
    (3, False, None, [1]),                            # null wait start
    (4, False, T0 - dt.timedelta(seconds=5), [5]),    # fan-in on 5
    (6, False, T0 - dt.timedelta(seconds=5), [5]),
    (7, False, T0 - dt.timedelta(seconds=5), [4, 6]),  # two blockers
    (8, True, None, [9]),                             # granted: not an edge
]


def test_chain_depth_with_cycle_and_fan_in(spark):
    e = wait_edges(_locks(spark, ROWS))
    d = {r.root_blocked_pid: r.maximum_chain_depth for r in chain_depth(e).collect()}
    assert d == {1: 2, 2: 2, 3: 2, 4: 1, 6: 1, 7: 2}
    roots = {r.blocker_pid: (r.direct_waiters, r.total_waiters) for r in root_blockers(e).collect()}
    assert roots == {5: (2, 3)}


def test_blocking_pairs_null_waitstart(spark):
    locks = _locks(spark, ROWS)
    sessions = spark.createDataFrame(
        [("s", T0, p, "db", "u", "app", "10.0.0.1", "active", "Lock", "relation", 1, T0, T0, "q") for p in range(1, 8)],
        "server_id string, source_collected_at timestamp_ntz, pid int, datname string, usename string, "
        "application_name string, client_addr string, state string, wait_event_type string, wait_event string, "
        "query_id long, query_start timestamp_ntz, xact_start timestamp_ntz, query string")
    rels = spark.createDataFrame([("s", T0, 5, "public", "Accounts", "r")],
                                 "server_id string, source_collected_at timestamp_ntz, oid long, schemaname string, "
                                 "relname string, relkind string")
    out = {(r.blocked_pid, r.blocking_pid): r for r in blocking_pairs(locks, sessions, rels, 1).collect()}
    assert len(out) == 7
    assert out[(3, 1)].actual_lock_wait_seconds is None
    assert out[(1, 2)].actual_lock_wait_seconds == 40.0
    assert out[(7, 4)].direct_blocker_count == 2 and list(out[(7, 4)].direct_blocker_pids) == [4, 6]
    assert out[(1, 2)].locked_relation_name == 'public."Accounts"'


def test_chain_depth_random_graphs_vs_dfs(spark):
    import random

    rnd = random.Random(9)
    locks, adj = [], {}
    for sample in range(3):
        n = 25
        for pid in range(1, n + 1):
            if rnd.random() < 0.8:
                blockers = sorted(rnd.sample(range(1, n + 1), rnd.choice([1, 1, 1, 2, 3])))
                blockers = [b for b in blockers if b != pid] or [pid % n + 1]
                adj[(sample, pid)] = blockers
                locks.append((sample, pid, blockers))

    def longest(sample, root):
        best = 0
        stack = [(root, 0, {root})]
        while stack:
            node, d, seen = stack.pop()
            best = max(best, d)
            if d >= 32:
                continue
            for b in adj.get((sample, node), []):
                if b not in seen:
                    stack.append((b, d + 1, seen | {b}))
        return best

    df = spark.createDataFrame(
        [("s", T0 + dt.timedelta(minutes=s), p, False, b) for s, p, b in locks],
        "server_id string, source_collected_at timestamp_ntz, pid int, granted boolean, blocking_pids array<int>")
    got = {(r.source_collected_at.minute, r.root_blocked_pid): r.maximum_chain_depth
           for r in chain_depth(wait_edges(df)).collect()}
    want = {(s, p): longest(s, p) for s, p, _ in locks}
    assert got == want


def _edges(spark, rows):
    return spark.createDataFrame([("s%d" % s, T0 + dt.timedelta(minutes=m), a, b) for s, m, a, b in rows],
                                 "server_id string, source_collected_at timestamp_ntz, blocked_pid int, blocker_pid int")


def test_chain_depth_of_a_queue_has_no_paths(spark):
    """200 waiters, each blocked by all ahead: 2^199 paths, one row per pid and level."""
    rows = [(0, 0, a, b) for a in range(2, 202) for b in range(1, a)]
    rows += [(1, 1, a + 1, a) for a in range(1, 60)]  # a plain queue past the limit
    got = {(r.server_id, r.root_blocked_pid): r.maximum_chain_depth for r in chain_depth(_edges(spark, rows)).collect()}
    assert got == {**{("s0", a): min(a - 1, 32) for a in range(2, 202)}, **{("s1", a + 1): min(a, 32) for a in range(1, 60)}}


def test_chain_depth_with_cycles_in_many_samples(spark):
    import random

    rnd = random.Random(3)
    rows = []
    for m in range(12):
        # a cycle that leads on to a chain, waiters behind it (some in long queues), a pid blocked by itself
        n = rnd.randint(2, 5)
        rows += [(m % 3, m, 10 + k, 10 + (k + 1) % n) for k in range(n)]
        rows += [(m % 3, m, 10, 50), (m % 3, m, 50, 51), (m % 3, m, 51, 52), (m % 3, m, 70, 70), (m % 3, m, 71, 70)]
        rows += [(m % 3, m, 100 + k, 10 + rnd.randrange(n) if k % 4 == 0 else 100 + rnd.randrange(max(0, k - 3), k)) for k in range(1 + 4 * m)]
        rows += [(m % 3, m, 20, 21), (m % 3, m, 21, 20), (m % 3, m, 21, 10)] * (m % 2)
    adj = {}
    for s, m, a, b in rows:
        adj.setdefault((s, m), {}).setdefault(a, set()).add(b)

    def longest(graph, node, seen):
        return max((1 + longest(graph, b, seen | {b}) for b in graph.get(node, ()) if b not in seen), default=0)

    got = {(int(r.server_id[1:]), r.source_collected_at.minute, r.root_blocked_pid): r.maximum_chain_depth for r in chain_depth(_edges(spark, rows)).collect()}
    assert got == {(*k, a): min(32, max(1, longest(g, a, {a}))) for k, g in adj.items() for a in g}
    assert chain_depth(_edges(spark, rows).where("false")).count() == 0
