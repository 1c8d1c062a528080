"""Stateful streaming operators (SM-01, SM-02).

Both keep a small per-key state (the last sample, or the last fired time) with
``applyInPandasWithState``; it spreads over the cluster by key and survives executor
loss through the checkpoint. Triggers have a group per key. Samples are many keys with
few rows each, so a group is a bucket of keys by hash: the work inside it is vectorised
pandas over the micro-batch's rows of all its keys, and a call costs the same for one
key or hundreds.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import IntegralType, StructType

BUCKETS = 1024  # of keys in a stream's state; fixed as long as a checkpoint lives
NULL_FLAG = "_null_"
FIRST = np.iinfo(np.int64).min  # a null tiebreak


def _micros(s: pd.Series) -> np.ndarray:
    return s.values.astype("datetime64[us]").astype(np.int64)


def _packed(pdf: pd.DataFrame) -> bytes:
    batch = pa.RecordBatch.from_pandas(pdf, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(data).read_pandas()


def bucketed(stream: DataFrame, keys: Sequence[str], time_col: str, watermark: str, buckets: int) -> tuple[DataFrame, list[str]]:
    """``stream`` in the form that its samples travel in, and its integer columns.

    ``_key`` (the key columns as one text), ``_et`` (event time), the columns, null flags, ``_bucket`` (the group).
    pandas turns a frame's integers into floats where one row has a null, keys included: integers travel without
    nulls, beside a flag.
    """
    fields = stream.schema
    integers = [f.name for f in fields if isinstance(f.dataType, IntegralType)]
    exact = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
             "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    timed = stream.withColumn("_et", F.col(time_col).cast("timestamp")).withWatermark("_et", watermark)
    plain = timed.select(
        F.to_json(F.struct(*keys), exact).alias("_key"), "_et",
        *[F.coalesce(c, F.lit(0).cast(fields[c].dataType)).alias(c) if c in integers else F.col(c) for c in fields.names],
        *[F.col(c).isNull().alias(NULL_FLAG + c) for c in integers])
    return plain.select("*", F.pmod(F.xxhash64("_key"), F.lit(buckets)).cast("int").alias("_bucket")), integers


def nullable(pdf: pd.DataFrame, integers: Sequence[str], columns: Sequence[str]) -> pd.DataFrame:
    """``columns`` of a frame that came through :func:`bucketed`, integers with their nulls again."""
    with_nulls = [c for c in integers if pdf[NULL_FLAG + c].any()]
    return pdf[list(columns)].assign(**{c: pdf[c].astype("Int64").mask(pdf[NULL_FLAG + c]) for c in with_nulls})


def no_samples(counters: Sequence[str], doubles: frozenset[str]) -> pd.DataFrame:
    """Last samples of no key: time (us), tiebreak, reset (us), their values, and what is null."""
    types = {"_key": object, "t": np.int64, "tb": np.int64, "r": np.int64, "rn": bool}
    for i, c in enumerate(counters):
        types |= {f"v{i}": np.float64 if c in doubles else np.int64, f"n{i}": bool}
    return pd.DataFrame({c: np.array([], dtype=d) for c, d in types.items()})


def _samples(pdf: pd.DataFrame, time_col: str, ties: np.ndarray, counters: Sequence[str], reset_col: str | None, doubles: frozenset[str]) -> pd.DataFrame:
    """The rows of ``pdf`` (with their ``_key``) in the form of :func:`no_samples`."""
    rn = pdf[reset_col].isna().to_numpy() if reset_col else np.ones(len(pdf), dtype=bool)
    cols: dict[str, object] = {"_key": pdf["_key"].to_numpy(), "t": _micros(pdf[time_col]), "tb": ties,
                               "r": np.where(rn, 0, _micros(pdf[reset_col])) if reset_col else np.zeros(len(pdf), dtype=np.int64), "rn": rn}
    for i, c in enumerate(counters):
        cols |= {f"v{i}": pdf[c].fillna(0).to_numpy(dtype=np.float64 if c in doubles else np.int64), f"n{i}": pdf[c].isna().to_numpy()}
    return pd.DataFrame(cols)


def newer_than(rows: pd.DataFrame, last: pd.DataFrame) -> np.ndarray:
    """Which samples come after their key's last one, or have none. ``last`` has a key once."""
    at = pd.Index(last["_key"]).get_indexer(rows["_key"])
    if not len(last):
        return np.ones(len(rows), dtype=bool)
    t, tb = rows["t"].to_numpy(), rows["tb"].to_numpy()
    lt, ltb = last["t"].to_numpy()[at], last["tb"].to_numpy()[at]
    return (at < 0) | (t > lt) | ((t == lt) & (tb > ltb))


def keyed_deltas(pdf: pd.DataFrame, rows: pd.DataFrame, last: pd.DataFrame, order: np.ndarray, counters: Sequence[str],
                 max_gap_us: int | None, doubles: frozenset[str]) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Vectorised WN-01 over the rows of many keys, each seeded by its last sample; and the last samples now.

    ``rows`` are the samples of ``pdf``, all newer than their key's in ``last``; of one key and time the smaller
    ``order`` comes first. A null value, or a null before it, gives kind 'delta' and no delta, as in the batch form.
    """
    held = len(last)
    x = pd.concat([last, rows], ignore_index=True) if held else rows
    code = pd.factorize(x["_key"])[0]
    new = np.arange(len(x)) >= held
    at = np.lexsort((np.r_[np.zeros(held, dtype=np.int64), order], x["t"].to_numpy(), new, code))
    code, new = code[at], new[at]
    same = code[1:] == code[:-1]
    has_prev = np.r_[False, same]
    t, r, rn = (x[c].to_numpy()[at] for c in ("t", "r", "rn"))
    pt, pr, prn = (np.roll(a, 1) for a in (t, r, rn))
    if max_gap_us is not None:
        has_prev &= (t - pt) <= max_gap_us  # a longer gap starts the series again
    reset_changed = (prn != rn) | (~rn & (pr != r))
    elapsed = (t - pt) / 1e6
    cols: dict[str, object] = {"elapsed_seconds": pd.arrays.FloatingArray(elapsed[new], ~has_prev[new])}
    for i, c in enumerate(counters):
        v, null = x[f"v{i}"].to_numpy()[at], x[f"n{i}"].to_numpy()[at]
        pv, pn = np.roll(v, 1), np.roll(null, 1)
        known = ~null & ~pn
        is_reset = has_prev & (reset_changed | (known & (v < pv)))
        is_delta = has_prev & ~is_reset
        kind = np.where(~has_prev, "first", np.where(is_reset, "reset", "delta")).astype(object)
        d = v - pv
        array = pd.arrays.FloatingArray if c in doubles else pd.arrays.IntegerArray
        rate = np.where(elapsed > 0, d / np.where(elapsed > 0, elapsed, 1.0), 0.0)
        cols |= {f"{c}_kind": kind[new], f"{c}_delta": array(np.where(is_delta, d, 0)[new], (~is_delta | ~known)[new]),
                 f"{c}_rate": pd.arrays.FloatingArray(rate[new], (~is_delta | (~known & (elapsed > 0)))[new])}
    out = pdf.iloc[at[new] - held].reset_index(drop=True).assign(**cols)
    return out, x.iloc[at[np.r_[~same, True]]].reset_index(drop=True)


def _delta_frame(pdf: pd.DataFrame, prev: tuple | None, time_col: str, tb_col: str, counters: Sequence[str],
                 reset_col: str | None, max_gap_us: int | None = None,
                 doubles: frozenset[str] = frozenset()) -> tuple[pd.DataFrame, tuple]:
    """:func:`keyed_deltas` over one key's rows in order, seeded by the previous sample ``prev``.

    ``prev`` / the returned state: (time us, tiebreak, reset us, reset is null, [long values],
    [double values], [value is null]); each counter's last value sits in the array of its
    declared type (``doubles`` names the double ones).
    """
    keyed = pdf.assign(_key="")
    rows = _samples(keyed, time_col, pdf[tb_col].to_numpy(dtype=np.int64), counters, reset_col, doubles)
    last = no_samples(counters, doubles)
    if prev is not None:
        values = {f"v{i}": prev[5 if c in doubles else 4][i] for i, c in enumerate(counters)} | {f"n{i}": prev[6][i] for i in range(len(counters))}
        last = pd.DataFrame([{"_key": "", "t": prev[0], "tb": prev[1], "r": prev[2], "rn": prev[3], **values}]).astype(last.dtypes.to_dict())
    out, last = keyed_deltas(keyed, rows, last, np.arange(len(pdf)), counters, max_gap_us, doubles)
    end = last.iloc[0]
    values = [end[f"v{i}"] for i in range(len(counters))]
    return out.drop(columns="_key"), (
        int(end.t), int(end.tb), int(end.r), bool(end.rn), [0 if c in doubles else int(v) for c, v in zip(counters, values)],
        [float(v) if c in doubles else 0.0 for c, v in zip(counters, values)], [bool(end[f"n{i}"]) for i in range(len(counters))])


def stream_counter_delta(stream: DataFrame, keys: Sequence[str], counters: Sequence[str] | str,
                         time_col: str = "source_collected_at", reset_col: str | None = "stats_reset",
                         tiebreak: str = "event_id", idle_ttl: str = "1 day", watermark: str = "1 hour", buckets: int = BUCKETS) -> DataFrame:
    """SM-01: WN-01 on a stream for one or more counters, the last sample kept per key in state.

    Rows of a key are ordered by ``(time, tiebreak)`` within the micro-batch; rows
    not newer than the state (late or replayed samples) are dropped. A gap longer
    than ``idle_ttl`` starts the series again (kind 'first', no delta), so results do
    not depend on micro-batch timing; and the key's state expires by event time once
    the watermark passes its last sample plus ``idle_ttl``, so state holds only the
    active series. With no gap that long this equals the batch ``counter_delta``.
    Output: the input columns, ``elapsed_seconds`` and per counter ``c_kind``,
    ``c_delta``, ``c_rate``, as in the batch ``counter_delta``.

    Keys are dealt over ``buckets`` by hash. A bucket's state is one table of its keys' last samples, and its rows of a
    micro-batch are one frame: raise ``buckets`` with the number of keys, before the checkpoint's first run only;
    ``maxFilesPerTrigger`` bounds a micro-batch.
    """
    keys = list(keys)
    counters = [counters] if isinstance(counters, str) else list(counters)
    ttl_ms = _interval_ms(idle_ttl)
    fields = stream.schema
    types = {f.name: f.dataType.simpleString() for f in fields}
    out_schema = StructType(list(fields)).add("elapsed_seconds", "double")
    for c in counters:
        dt = "double" if types[c] in ("double", "float") else "long"
        out_schema = out_schema.add(f"{c}_kind", "string").add(f"{c}_delta", dt).add(f"{c}_rate", "double")
    doubles = frozenset(c for c in counters if types[c] in ("double", "float"))
    columns, out_cols = fields.names, out_schema.names
    plain, integers = bucketed(stream, keys, time_col, watermark, buckets)

    def keep(last: pd.DataFrame, state: GroupState) -> None:
        """The last samples that a row to come may follow within ``idle_ttl``; the state's next look at the clock."""
        now, ends = state.getCurrentWatermarkMs(), last["t"].to_numpy() // 1000 + ttl_ms
        last, ends = last[ends >= now], ends[ends >= now]
        if len(last):
            state.update((_packed(last),))
            state.setTimeoutTimestamp(max(int(ends.min()), now + 1))
        elif state.exists:
            state.remove()

    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = _unpacked(bytes(state.get[0])) if state.exists else no_samples(counters, doubles)
        if state.hasTimedOut:
            keep(last, state)
            return
        arrived = pd.concat(list(pdfs), ignore_index=True)
        pdf = nullable(arrived, integers, ["_key", *columns])
        ties = pdf[tiebreak].fillna(FIRST).to_numpy(dtype=np.int64)
        rows = _samples(pdf, time_col, ties, counters, reset_col, doubles)
        newer = newer_than(rows, last)
        if not newer.any():
            return
        order = np.where(pdf[tiebreak].isna(), np.iinfo(np.int64).max, ties)
        out, last = keyed_deltas(pdf[newer], rows[newer], last, order[newer], counters, ttl_ms * 1000, doubles)
        keep(last, state)
        yield out[out_cols]

    return plain.groupBy("_bucket").applyInPandasWithState(fn, out_schema, "last binary", "append",
                                                           GroupStateTimeout.EventTimeTimeout)


def _interval_ms(text: str) -> int:
    """'30 seconds' / '15 minutes' / '1 day' as milliseconds."""
    n, unit = text.split()
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]
    return int(float(n) * mult * 1000)


# ------------------------------------------------------------------ SM-02 triggers
@dataclass(frozen=True)
class Trigger:
    rule: str
    target: str
    condition: str  # SQL boolean over the sample row
    cooldown_s: int


# Conditional follow-up collections and their cooldowns.
TRIGGERS: tuple[Trigger, ...] = (
    Trigger("lock_waiters", "Q03", "lock_waiters > 0", 15),
    Trigger("autovacuum_workers", "Q12", "autovacuum_workers > 0", 30),
    Trigger("parallel_workers", "Q19", "parallel_workers > 0", 900),
    Trigger("pool_waiting", "PB04", "cl_waiting > 0 OR maxwait > 0", 15),
    Trigger("no_idle_server_with_waiters", "PB05", "sv_idle = 0 AND cl_waiting > 0", 15),
    Trigger("servers_tested_or_login", "PB06", "sv_tested + sv_login > 0", 300),
    Trigger("checkpoint_delta", "Q05", "checkpoint_delta > 0", 60),
    Trigger("checkpoint_delta", "Q09", "checkpoint_delta > 0", 300),
    Trigger("checkpoint_delta", "Q10", "checkpoint_delta > 0", 900),
    Trigger("checkpoint_delta", "Q13", "checkpoint_delta > 0", 300),
    Trigger("checkpoint_delta", "Q14", "checkpoint_delta > 0", 900),
)

FIRED_SCHEMA = "server_id string, target string, rule string, fired_at timestamp_ntz, reason string"


def trigger_candidates(samples: DataFrame, triggers: Sequence[Trigger] = TRIGGERS, time_col: str = "ts",
                       seq_col: str = "seq") -> DataFrame:
    """Every (sample, target) whose condition holds: one pass, an array of candidate structs exploded."""
    structs = [F.when(F.expr(t.condition), F.struct(F.lit(t.target).alias("target"), F.lit(t.rule).alias("rule"),
                                                    F.lit(t.cooldown_s).alias("cooldown_s"))) for t in triggers]
    x = samples.select("server_id", F.col(time_col).cast("timestamp_ntz").alias("ts"), F.col(seq_col).alias("seq"),
                       F.explode(F.filter(F.array(*structs), lambda s: s.isNotNull())).alias("c"))
    return x.select("server_id", "c.target", "c.rule", "c.cooldown_s", "ts", "seq")


def _fold(pdf: pd.DataFrame, last_fired_us: int | None) -> tuple[pd.DataFrame, int | None]:
    """Sequential cooldown fold over one (server, target): fire when the cooldown since the last fire passed."""
    pdf = pdf.sort_values(["ts", "seq", "rule"], kind="stable")
    t = _micros(pdf["ts"])
    cd = pdf["cooldown_s"].to_numpy(dtype=np.int64) * 1_000_000
    hits, last, i = [], last_fired_us, 0
    one_cooldown = len(cd) > 0 and bool((cd == cd[0]).all())
    while i < len(t):  # one jump per fire, not per row
        if last is not None:
            if one_cooldown:
                i = max(i, int(np.searchsorted(t, last + cd[0])))
            else:
                due = np.flatnonzero(t[i:] - last >= cd[i:])
                i = i + int(due[0]) if len(due) else len(t)
            if i >= len(t):
                break
        hits.append(i)
        last, i = int(t[i]), i + 1
    out = pdf.iloc[hits]
    res = pd.DataFrame({"server_id": out["server_id"], "target": out["target"], "rule": out["rule"],
                        "fired_at": out["ts"], "reason": out["rule"] + " since cooldown " +
                        out["cooldown_s"].astype(str) + "s elapsed"})
    return res, last


DAY_US = 86_400_000_000


def _day_entries(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of one (server, target) and day: the candidates that can be the day's first to fire, whatever fired before the day,
    each with the time of the day's last fire if it is the first.

    Those within the longest cooldown of midnight may be held back by an earlier day's fire, the first one after that never.
    """
    pdf = pdf.sort_values(["_us", "seq", "rule"], kind="stable")
    t, cd = pdf["_us"].to_numpy(np.int64), pdf["cooldown_s"].to_numpy(np.int64) * 1_000_000
    n = len(t)
    if (cd == cd[0]).all():
        after = np.maximum(np.searchsorted(t, t + cd[0]), np.arange(1, n + 1))
    else:
        after = np.array([i + 1 + next(iter(np.flatnonzero(t[i + 1:] - t[i] >= cd[i + 1:])), n) for i in range(n)])
    last = np.arange(n)
    for i in range(n - 1, -1, -1):
        if after[i] < n:
            last[i] = last[after[i]]
    free = int(np.searchsorted(t, t[0] // DAY_US * DAY_US + cd.max()))
    out = pdf.iloc[:min(n, free + 1)]
    return out.assign(exit_us=t[last[:len(out)]])[["server_id", "target", "_us", "seq", "rule", "cooldown_s", "exit_us"]]


def _mirrored(us: Column) -> Column:
    """A time that falls as ``us`` rises: the first row at or after a time is the last one at or before its mirror."""
    return F.expr("TIMESTAMP_NTZ'2000-01-01 00:00:00'") - F.make_dt_interval(secs=(us.cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)"))


def fire_triggers(candidates: DataFrame) -> DataFrame:
    """SM-02 batch form: per (server, target), a candidate fires when its cooldown since the last fire has passed.

    The sequence of fires is followed by pointer doubling over days. In each (key, day) only the few candidates that
    can be the day's first fire matter (61 at a 15 s cadence and a cooldown of 15 minutes), with the time of the last fire that each
    leads to; an as-of lookup gives the first candidate of a later day that may fire after it. These jumps are composed
    with themselves, and from a key's first candidate all days' first fires are reached in a logarithmic number of joins.
    Then each (key, day) is folded from its first fire on. A group is one day of a key, however long a burst lasts.
    Candidates of one time are taken by ``seq``, then ``rule``.
    """
    from statsweep.operators.deltas import epoch_micros
    from statsweep.operators.joins import align_asof
    from statsweep.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(candidates.sparkSession)
    keys = ["server_id", "target"]
    node = lambda name: F.struct(F.col("_us"), F.col("seq"), F.col("rule")).alias(name)
    c = candidates.withColumn("_us", epoch_micros("ts")).withColumn("_day", F.floor(F.col("_us") / DAY_US))
    types = {f.name: f.dataType.simpleString() for f in c.schema.fields}
    schema = f"server_id {types['server_id']}, target {types['target']}, _us bigint, seq {types['seq']}, rule {types['rule']}, cooldown_s {types['cooldown_s']}, exit_us bigint"
    nodes = (c.select(*keys, "_us", "seq", "rule", "cooldown_s", "_day").groupBy(*keys, "_day").applyInPandas(_day_entries, schema)
             .dropDuplicates([*keys, "_us", "seq", "rule"]).checkpoint())
    # a key's cooldowns are few: one for each rule of its target
    asked = nodes.select(*keys, node("at"), "exit_us").join(nodes.select(*keys, "cooldown_s").distinct(), keys).withColumn(
        "_due", _mirrored(F.col("exit_us") + F.col("cooldown_s").cast("bigint") * 1_000_000))
    first = nodes.groupBy(*keys, "cooldown_s", "_us").agg(F.min(node("x")).alias("to")).withColumn("_when", _mirrored(F.col("_us")))
    jump = (align_asof(asked, first, [*keys, "cooldown_s"], "_due", "_when", ["to"]).where("to IS NOT NULL")
            .groupBy(*keys, "at").agg(F.min("to").alias("to")).checkpoint())
    jumps = []
    while not jump.isEmpty():
        jumps.append(jump)
        on = jump.select(*keys, F.col("at").alias("to"), F.col("to").alias("further"))
        jump = jump.join(on, [*keys, "to"]).select(*keys, "at", F.col("further").alias("to")).checkpoint()
    reached = nodes.groupBy(*keys).agg(F.min(node("x")).alias("at"))
    for jump in reversed(jumps):
        reached = reached.unionByName(reached.join(jump, [*keys, "at"]).select(*keys, F.col("to").alias("at"))).checkpoint()
    entry = reached.select(*keys, F.floor(F.col("at._us") / DAY_US).alias("_day"), "at")

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        return _fold(pdf, None)[0]

    due = c.join(entry, [*keys, "_day"]).where(node("x") >= F.col("at")).drop("at", "_us")
    return due.groupBy(*keys, "_day").applyInPandas(fold, FIRED_SCHEMA)


def stream_fire_triggers(candidates: DataFrame, watermark: str = "1 minute") -> DataFrame:
    """SM-02 stream form: the last fired time per (server, target) kept in state.

    The state matters only until the cooldown has passed (the next candidate fires
    anyway), so it expires by event time at ``last fired + cooldown``: state holds
    only targets inside a cooldown.
    """
    c = candidates.withColumn("_et", F.col("ts").cast("timestamp")).withWatermark("_et", watermark)

    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        pdf = pd.concat(list(pdfs), ignore_index=True).drop(columns=["_et"])
        last = state.get[0] if state.exists else None
        res, last = _fold(pdf, last)
        if last is not None:
            state.update((last,))
            state.setTimeoutTimestamp(int(last // 1000) + int(pdf["cooldown_s"].iloc[0]) * 1000)
        if len(res):
            yield res

    return c.groupBy("server_id", "target").applyInPandasWithState(
        fn, FIRED_SCHEMA, "last_fired_us long", "append", GroupStateTimeout.EventTimeTimeout)
