"""Scalar column functions and row-wise projections (PRJ-01 to PRJ-16).

All are built-in Spark expressions (whole-stage codegen); none is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statsweep.operators.deltas import seconds_between


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


# System schemas excluded by the reference queries (exact names, then prefixes).
SYSTEM_SCHEMAS = ("pg_catalog", "information_schema")
SYSTEM_SCHEMA_PREFIXES = ("pg_toast", "pg_temp_")

# Scope labels of database/role setting overrides.
SCOPE_ALL_ALL = "all_database_all_role"
SCOPE_ALL_DB = "all_database_specific_role"
SCOPE_ALL_ROLE = "specific_database_all_role"
SCOPE_SPECIFIC = "specific_database_specific_role"

# Plan-node substrings flagged in plan text (flag name, substring).
PLAN_FLAGS = (
    ("has_gather", "Gather"),
    ("has_gather_merge", "Gather Merge"),
    ("has_parallel_seq_scan", "Parallel Seq Scan"),
    ("has_parallel_index_scan", "Parallel Index Scan"),
    ("has_parallel_index_only_scan", "Parallel Index Only Scan"),
    ("has_parallel_hash", "Parallel Hash"),
    ("has_parallel_append", "Parallel Append"),
)
WORKERS_PLANNED_PATTERN = r"Workers Planned: ([0-9]+)"


def override_scope(df: DataFrame, db_col: str = "setdatabase", role_col: str = "setrole",
                   datname: str = "datname", rolname: str = "rolname") -> DataFrame:
    """PRJ-01: scope label from zero/non-zero database and role ids, with 'ALL ...' labels."""
    db0 = F.col(db_col) == 0
    r0 = F.col(role_col) == 0
    scope = (F.when(db0 & r0, SCOPE_ALL_ALL).when(db0, SCOPE_ALL_DB).when(r0, SCOPE_ALL_ROLE)
             .otherwise(SCOPE_SPECIFIC))
    return df.select(
        "*",
        scope.alias("setting_scope"),
        F.when(db0, F.lit("ALL DATABASES")).otherwise(F.col(datname)).alias("database_name"),
        F.when(r0, F.lit("ALL ROLES")).otherwise(F.col(rolname)).alias("role_name"),
    )


def explode_settings(df: DataFrame, array_col: str, keep: Sequence[str] | None = None) -> DataFrame:
    """PRJ-02: ``name=value`` array entries to rows, split at the first '='; entries without '=' dropped."""
    cols = keep if keep is not None else [c for c in df.columns if c != array_col]
    x = df.select(*cols, F.explode(array_col).alias("_cfg"))
    return x.where(F.instr("_cfg", "=") > 0).select(
        *cols,
        F.split_part(F.col("_cfg"), F.lit("="), F.lit(1)).alias("parameter_name"),
        F.expr("substring(_cfg, instr(_cfg, '=') + 1)").alias("parameter_value"),
    )


def session_ages(df: DataFrame, as_of: str | Column = "source_collected_at") -> DataFrame:
    """PRJ-06: active-query, transaction and idle-in-transaction ages in seconds at ``as_of``.

    Each is null unless its state applies. One ``as_of`` per sample, not a moving clock.
    """
    t = _c(as_of)
    return df.select(
        "*",
        F.when((F.col("state") == "active") & F.col("query_start").isNotNull(),
               seconds_between(t, "query_start")).alias("active_query_age_seconds"),
        F.when(F.col("xact_start").isNotNull(), seconds_between(t, "xact_start")).alias("transaction_age_seconds"),
        F.when(F.col("state").startswith("idle in transaction") & F.col("state_change").isNotNull(),
               seconds_between(t, "state_change")).alias("idle_in_transaction_age_seconds"),
    )


def exclude_self(df: DataFrame, app_name: str, app_col: str = "application_name",
                 pid_col: str | None = None, own_pid: int | None = None) -> DataFrame:
    """PRJ-07: drop the collector's own sessions (null-safe on the application name) and own pid."""
    cond = ~F.col(app_col).eqNullSafe(F.lit(app_name))
    if pid_col is not None and own_pid is not None:
        cond = cond & ~F.col(pid_col).eqNullSafe(F.lit(own_pid))
    return df.where(cond)


def truncate_text(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """PRJ-08: cut text columns at a character limit (2,000 / 6,000 / 10,000 in the reference)."""
    return df.withColumns({c: F.left(F.col(c), F.lit(n)) for c, n in limits.items()})


def coalesce_versions(payload: str | Column, candidates: Sequence[str], dtype: str, default=None) -> Column:
    """PRJ-09: first non-empty of several JSON fields (version-tolerant), typed, else ``default``."""
    p = _c(payload)
    vals = [F.nullif(F.get_json_object(p, f"$.{f}"), F.lit("")).try_cast(dtype) for f in candidates]
    if default is not None:
        vals.append(F.lit(default).cast(dtype))
    return F.coalesce(*vals)


JIT_COLUMNS = ("jit_generation_time", "jit_inlining_time", "jit_optimization_time",
               "jit_emission_time", "jit_deform_time")


def total_jit_time(cols: Sequence[str] = JIT_COLUMNS) -> Column:
    """PRJ-10: sum of the five JIT timing columns."""
    out = F.col(cols[0])
    for c in cols[1:]:
        out = out + F.col(c)
    return out


def classify_wait(event_type: str | Column = "event_type", event: str | Column = "event") -> Column:
    """PRJ-11: idle/background, client think time, client back-pressure or database resource wait."""
    t, e = _c(event_type), _c(event)
    return (F.when(t == "Activity", "background_or_idle_activity")
            .when((t == "Client") & (e == "ClientRead"), "client_idle_or_think_time")
            .when(t == "Client", "client_or_network_backpressure")
            .otherwise("database_resource_wait"))


def plan_features(df: DataFrame, text_col: str = "plan_text") -> DataFrame:
    """PRJ-12: plan-node flags by substring and planned worker count by regex."""
    t = F.col(text_col)
    flags = [t.contains(sub).alias(name) for name, sub in PLAN_FLAGS]
    workers = F.nullif(F.regexp_extract(t, WORKERS_PLANNED_PATTERN, 1), F.lit("")).try_cast("int")
    return df.select("*", *flags, workers.alias("workers_planned_from_plan"))


# SQL key words that an identifier can't be without quotes (reserved, type or function, column name).
QUOTED_WORDS = """
    all analyse analyze and any array as asc asymmetric both case cast check collate column constraint
    create current_catalog current_date current_role current_time current_timestamp current_user default
    deferrable desc distinct do else end except false fetch for foreign from grant group having in initially
    intersect into lateral leading limit localtime localtimestamp not null offset on only or order placing
    primary references returning select session_user some symmetric system_user table then to trailing true
    union unique user using variadic when where window with authorization binary collation concurrently
    cross current_schema freeze full ilike inner is isnull join left like natural notnull outer overlaps
    right similar tablesample verbose between bigint bit boolean char character coalesce dec decimal exists
    extract float greatest grouping inout int integer interval least national nchar none normalize nullif
    numeric out overlay position precision real row setof smallint substring time timestamp treat trim
    values varchar xmlattributes xmlconcat xmlelement xmlexists xmlforest xmlnamespaces xmlparse xmlpi
    xmlroot xmlserialize xmltable
""".split()


def quote_ident(c: str | Column) -> Column:
    """Double-quote an identifier only when needed (a key word, or not lower-case simple), doubling inner quotes."""
    x = _c(c)
    return F.when(x.rlike(r"^[a-z_][a-z0-9_]*$") & ~x.isin(*QUOTED_WORDS), x).otherwise(
        F.concat(F.lit('"'), F.replace(x, F.lit('"'), F.lit('""')), F.lit('"')))


def quote_relation(schema: str | Column, rel: str | Column) -> Column:
    """PRJ-13: ``schema.relation`` with each part quoted only when needed."""
    return F.concat(quote_ident(schema), F.lit("."), quote_ident(rel))


def exclude_system(df: DataFrame, schema_col: str | None = "schemaname",
                   template_col: str | None = None) -> DataFrame:
    """PRJ-14: drop system schemas (exact and prefix) and template databases."""
    cond = F.lit(True)
    if schema_col:
        s = F.col(schema_col)
        cond = cond & ~s.isin(*SYSTEM_SCHEMAS)
        for p in SYSTEM_SCHEMA_PREFIXES:
            cond = cond & ~s.startswith(p)
    if template_col:
        cond = cond & ~F.coalesce(F.col(template_col), F.lit(False))
    return df.where(cond)


def safe_percent(num: str | Column, den: str | Column, scale: int | None = 2) -> Column:
    """PRJ-15: ``round(100 * num / den, scale)`` as double; null when the denominator is 0 or null."""
    n, d = _c(num), _c(den)
    v = F.when(d != 0, F.lit(100.0) * n / d)
    return F.round(v, scale) if scale is not None else v


def sampled_wait(df: DataFrame, period_ms: int = 10, samples: str = "wait_sample_count",
                 calls: str = "calls") -> DataFrame:
    """PRJ-16: estimated wait ms = samples x sampling period; per-call forms only when calls > 0."""
    est = F.col(samples) * F.lit(period_ms)
    return df.select(
        "*",
        est.alias("estimated_sampled_wait_ms"),
        F.when(F.col(calls) > 0, est / F.col(calls)).alias("estimated_wait_ms_per_call"),
    )
