"""Helpers shared by the training-data operators: shared-folder tables, worker caches, components."""

from __future__ import annotations

import ctypes
import functools
import gc
import inspect
import sys
import types
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statsweep.session import ensure_checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder named by ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*saved: DataFrame) -> None:
    """Delete tables written by :func:`save` once everything that reads them has been written itself."""
    for df in saved:
        spark = df.sparkSession
        jvm = spark.sparkContext._jvm
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            p = jvm.org.apache.hadoop.fs.Path(folder)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def worker_cache(name: str) -> dict:
    """A dict shared by the tasks that a Python worker process runs. A worker keeps the dict of the operator that it
    served last; another operator's is dropped, its memory goes back to the system before the next one grows, so that
    their sizes don't add up over a pipeline."""
    held = sys.modules.setdefault("_statsweep_worker", types.ModuleType("_statsweep_worker")).__dict__
    if name not in held:
        others = [k for k in held if not k.startswith("__")]
        for other in others:
            del held[other]
        if others:
            gc.collect()  # caches and their fill functions hold each other
            _give_back()
        held[name] = {}
    return held[name]


class Parts(dict):
    """Encoded ids (little-endian 32 bit) of a text part, by the part; computed when missing. When it is full, what
    was used longest ago goes: a part stays as long as each of two halves sees it."""

    def __init__(self, fill, entries: int = 350_000):
        super().__init__()
        self.fill, self.entries, self.older = fill, entries, {}

    def __missing__(self, part):
        out = self.older.get(part)
        if out is None:
            out = self.fill(part)
        if len(part) <= 64:
            if len(self) >= self.entries:
                self.older = dict(self)
                self.clear()
            self[part] = out
        return out


def _give_back() -> None:
    """Return freed memory to the system. An idle worker would keep it beside the executor's next stage."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)


def lean(fn):
    """``fn`` (over record batches, or over the table of a group) that gives its freed memory back at its end."""
    if inspect.isgeneratorfunction(fn):
        @functools.wraps(fn)
        def over_batches(batches):
            yield from fn(batches)
            _give_back()

        return over_batches

    def over_table(table: pa.Table) -> pa.Table:
        out = fn(table)
        _give_back()
        return out

    return over_table


def ascii_lower(col):
    """Lower-case A-Z only."""
    return F.translate(col, UPPER, UPPER.lower())


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of ``edges(a, b)`` (bigint): returns ``(node, component)``, component the smallest node.

    Large-star / small-star rounds: every node re-links its neighbours to the smallest one it knows, so the number
    of rounds grows with the logarithm of the longest chain. Each round is one aggregation and one join, written to
    the shared folder; no neighbour list is ever collected into one task. Nodes without an edge, and edges with a
    null end, don't appear. Repeated edges and loops are allowed.
    """
    e = edges.select(F.col("a").cast("bigint"), F.col("b").cast("bigint")).where("a <> b")
    e = save(e.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), name)
    while True:
        # large star: neighbours larger than the node link to the smallest neighbour (or the node itself)
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("m").alias("a"), "b").where("a <> b")
        # small star: the smaller neighbours of a node, and the node, link to the smallest of them
        down = large.select(F.col("b").alias("u"), F.col("a").alias("v")).distinct()
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        step = down.join(low, "u")
        small = step.select(F.col("m").alias("a"), F.col("v").alias("b")).where("a <> b").union(
            step.select(F.col("m").alias("a"), F.col("u").alias("b")))
        new = save(small.distinct(), name)
        changed = new.join(e, ["a", "b"], "left_anti").limit(1).count() + e.join(new, ["a", "b"], "left_anti").limit(1).count()
        discard(e)
        e = new
        if not changed:
            break
    roots = e.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return e.select(F.col("b").alias("node"), F.col("a").alias("component")).union(roots)
