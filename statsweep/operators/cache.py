"""Buffer cache, shared memory and relation statistics (AG-11 to AG-13, JN-02, JN-03, JN-05).

A sample is ``(server_id, source_collected_at)``. Per-sample totals are grouped
sums joined back (pre-aggregated map-side), never a window over a whole sample.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statsweep.functions.scalars import safe_percent
from statsweep.operators.activity import ordered_structs, topk

SAMPLE = ("server_id", "source_collected_at")
BLOCK_SIZE = 8192
TOP_RELATIONS = 100


def cache_by_relation(buffers: DataFrame, database_oid: int, sample: Sequence[str] = SAMPLE) -> DataFrame:
    """AG-11: cached, dirty and pinned buffers and mean usage count per relation file, main fork only."""
    b = buffers.where(F.col("relfilenode").isNotNull() & (F.col("relforknumber") == 0)
                      & (F.col("reldatabase") == F.lit(database_oid)))
    return b.groupBy(*sample, "reldatabase", "reltablespace", "relfilenode", "relforknumber").agg(
        F.count(F.lit(1)).alias("cached_buffers"),
        F.count_if(F.col("isdirty")).alias("dirty_buffers"),
        F.count_if(F.col("pinning_backends") > 0).alias("pinned_buffers"),
        F.avg("usagecount").alias("avg_usagecount"))


def map_relations(cache: DataFrame, catalog: DataFrame, default_tablespace: int,
                  block_size: int = BLOCK_SIZE) -> DataFrame:
    """JN-05: cache rows to relations on file node and tablespace (0 = database default); no temp schemas."""
    cat = catalog.where(~F.col("schemaname").startswith("pg_temp_")).select(
        "server_id", F.col("oid").alias("relation_oid"), "schemaname", "relname", "relkind",
        F.col("relfilenode"),
        F.coalesce(F.nullif(F.col("reltablespace"), F.lit(0)), F.lit(default_tablespace)).alias("reltablespace"),
        F.col("main_fork_bytes").alias("relation_main_fork_size_bytes"))
    j = cache.join(cat, ["server_id", "relfilenode", "reltablespace"], "inner")
    return j.withColumn("cached_bytes", F.col("cached_buffers") * F.lit(block_size))


def relation_cache_report(mapped: DataFrame, k: int | None = TOP_RELATIONS,
                          sample: Sequence[str] = SAMPLE) -> DataFrame:
    """Top relations by cached buffers with cached % of the relation and share of the sample's cache (WN-03)."""
    tot = mapped.groupBy(*sample).agg(F.sum("cached_buffers").alias("_total_cached"))
    j = mapped.join(tot, list(sample), "left")
    out = j.select(
        *sample, "relation_oid", "schemaname", "relname", "relkind", "cached_buffers", "cached_bytes",
        "relation_main_fork_size_bytes",
        safe_percent("cached_bytes", "relation_main_fork_size_bytes").alias("relation_cached_percent"),
        safe_percent("cached_buffers", "_total_cached").alias("share_of_current_database_cached_buffers_percent"),
        "dirty_buffers", "pinned_buffers", "avg_usagecount")
    return topk(out, sample, [F.col("cached_buffers").desc(), F.col("relation_oid")], k)


def buffer_summary(buffers: DataFrame, sample: Sequence[str] = SAMPLE) -> DataFrame:
    """AG-12: used/unused/dirty/pinned buffers per sample and their percentages."""
    used = F.col("relfilenode").isNotNull()
    s = buffers.groupBy(*sample).agg(
        F.count_if(used).alias("buffers_used"), F.count_if(~used).alias("buffers_unused"),
        F.count_if(used & F.col("isdirty")).alias("buffers_dirty"),
        F.count_if(used & (F.col("pinning_backends") > 0)).alias("buffers_pinned"),
        F.avg(F.when(used, F.col("usagecount"))).alias("usagecount_avg"))
    return s.select(
        "*",
        safe_percent("buffers_used", F.col("buffers_used") + F.col("buffers_unused")).alias("buffer_used_percent"),
        safe_percent("buffers_dirty", "buffers_used").alias("dirty_buffer_percent_of_used"),
        safe_percent("buffers_pinned", "buffers_used").alias("pinned_buffer_percent_of_used"))


def usage_counts(buffers: DataFrame, sample: Sequence[str] = SAMPLE) -> DataFrame:
    """AG-12 distribution: per sample, buffers/dirty/pinned by usage count as an ordered list (AG-08)."""
    g = buffers.where(F.col("relfilenode").isNotNull()).groupBy(*sample, F.col("usagecount").alias("usage_count")).agg(
        F.count(F.lit(1)).alias("buffers"), F.count_if(F.col("isdirty")).alias("dirty"),
        F.count_if(F.col("pinning_backends") > 0).alias("pinned"))
    return ordered_structs(g, sample, [F.col("usage_count")], ["usage_count", "buffers", "dirty", "pinned"],
                           out="usage_counts")


def allocation_shares(allocations: DataFrame, sample: Sequence[str] = SAMPLE) -> DataFrame:
    """AG-13: named/unused totals per sample and each allocation's share (null name -> '<unused>')."""
    a = allocations.withColumn("allocation_name", F.coalesce(F.col("name"), F.lit("<unused>")))
    unused = F.col("allocation_name") == "<unused>"
    tot = a.groupBy(*sample).agg(
        F.sum("allocated_size").alias("total_main_shared_memory_bytes"),
        F.sum(F.when(~unused, F.col("allocated_size"))).alias("allocated_named_and_anonymous_bytes"),
        F.sum(F.when(unused, F.col("allocated_size"))).alias("unused_main_shared_memory_bytes"))
    j = a.join(tot, list(sample), "left")
    return j.select(
        *sample, "allocation_name", "off", "size", "allocated_size", "total_main_shared_memory_bytes",
        "allocated_named_and_anonymous_bytes", "unused_main_shared_memory_bytes",
        safe_percent("allocated_named_and_anonymous_bytes", "total_main_shared_memory_bytes")
        .alias("main_shared_memory_allocated_percent"),
        safe_percent("allocated_size", "total_main_shared_memory_bytes", 4).alias("allocation_share_percent"))


def table_stats(stats: DataFrame, io: DataFrame, sample: Sequence[str] = SAMPLE) -> DataFrame:
    """JN-02: table counters left join table I/O counters on sample and relid."""
    return stats.join(io, [*sample, "relid"], "left")


def index_stats(usage: DataFrame, io: DataFrame, definitions: DataFrame, sample: Sequence[str] = SAMPLE
                ) -> DataFrame:
    """JN-03: index usage left join index I/O, inner join index definitions (no definition -> dropped)."""
    return usage.join(io, [*sample, "indexrelid"], "left").join(definitions, [*sample, "indexrelid"], "inner")
