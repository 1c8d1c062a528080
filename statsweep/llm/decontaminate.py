"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

Documents are partitioned by the number of their distinct shingles, ``p = ceil(log2(size))``. A document's signature is
a one-permutation MinHash: the hash space is cut into ``2 ** (p + extra)`` bins and each bin keeps its smallest shingle
hash. Bins grow with the partition's size bound, so a short item contained in a long document meets the signature as
surely as in a short one; ``extra`` is tuned to the smallest item so that a contained item is missed with a chance of
at most ``MISS``. Candidates are verified on the words themselves. DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import save

WORDS = 5
THRESHOLD = 0.8
MISS = 1e-6
BROADCAST_ROWS = 500_000  # rows of two or three numbers: below this a side is broadcast, above it the join shuffles


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _grams(w: Column, sizes: list[int], make) -> Column:
    """``make(size, values)`` for every run of each size."""
    def of(g: int) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.size(w) - g), lambda i: make(g, [F.get(w, i + k) for k in range(g)]))
        return F.when(F.size(w) >= g, runs).otherwise(F.slice(F.transform(F.array(F.lit(0)), lambda i: make(g, [F.get(w, i)] * g)), 1, 0))
    return F.concat(*[of(g) for g in sizes])


def hashes(text, sizes: list[int]) -> Column:
    """Sorted distinct 64-bit hashes of the text's shingles of the given sizes (in words)."""
    make = lambda g, v: F.xxhash64(F.lit(g), *v)
    return let(F.transform(words(text), lambda x: F.xxhash64(x)), lambda h: F.sort_array(F.array_distinct(_grams(h, sizes, make))))


def strings(text, sizes: list[int]) -> Column:
    """Distinct shingles of the given sizes, as text."""
    return let(words(text), lambda w: F.array_distinct(_grams(w, sizes, lambda g, v: F.concat_ws(" ", *v))))


def _hash_of(g: int):
    return lambda h: F.xxhash64(F.lit(g), *[F.get(h, F.lit(k)) for k in range(g)])


def extra_bits(smallest: int, threshold: float) -> int:
    """Bins per shingle, as a power of two, for a miss chance of at most ``MISS`` when ``threshold`` of ``smallest``
    shingles are contained: at a load of ``x`` shingles per bin a shingle is its bin's minimum with a chance of at
    least ``1 - x / 2``."""
    load = min(1.0, 2 * MISS ** (1 / max(1, math.ceil(threshold * smallest - 1e-9))))
    return max(0, math.ceil(-math.log2(load)))


def _small(df: DataFrame) -> DataFrame:
    """``df`` marked for a broadcast if its size is proven small; else as it is, and the join shuffles both sides."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def find_leaks(docs: DataFrame, items: DataFrame, n: int = WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs of an item and a document that holds at least ``threshold`` of the item's distinct ``n``-word shingles.

    ``docs(doc_id, text, ...)``, ``items(item_id, text, ...)``; returns ``item_id, doc_id, n_shingles, n_shared,
    containment``. An item with fewer than ``n`` words is one shingle of all its words; one without words matches
    nothing. Rows that repeat an id count as one text with all their shingles; rows without an id are left out. Null
    texts are empty. Empty tables give an empty result.
    """
    src = docs.select("doc_id", "text").where("doc_id IS NOT NULL")
    item = items.select("item_id", "text").where("item_id IS NOT NULL").withColumn("g", F.least(F.size(words(F.col("text"))), F.lit(n))).where("g > 0")
    sizes = sorted(r.g for r in item.select("g").distinct().collect()) or [n]  # at most n numbers
    grams = None
    for g in sizes:
        one = item.where(F.col("g") == g).select("item_id", F.explode(strings(F.col("text"), [g])).alias("s"))
        grams = one if grams is None else grams.union(one)
    grams = save(grams.distinct(), "item-shingles")
    sized = save(grams.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_shingles")), "item-sizes")
    smallest = sized.agg(F.min("n_shingles")).first()[0] or 1
    extra = extra_bits(smallest, threshold)
    # the same hash that hashes() gives: of the number of words and the words' hashes
    parts = F.transform(F.split("s", " "), lambda x: F.xxhash64(x))
    by_size = F.lit(None).cast("bigint")
    for g in sizes:
        by_size = F.when(F.size(parts) == g, let(parts, _hash_of(g))).otherwise(by_size)
    probe = grams.select("item_id", by_size.alias("h")).join(_small(sized), "item_id")

    def signature(s: Column) -> Column:
        p = F.ceil(F.log2(F.size(s))).cast("int")
        shift = F.greatest(F.lit(0), 64 - p - extra)
        bin_of = lambda x: F.call_function("shiftright", x, shift)
        low = F.filter(s, lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(s, i - 1))))
        return F.struct(p.alias("p"), low.alias("low"))

    signed = src.select("doc_id", let(hashes(F.col("text"), sizes), signature).alias("sig")).where(F.size("sig.low") > 0)
    entries = signed.select("doc_id", F.col("sig.p").alias("p"), F.explode("sig.low").alias("h"))
    # a partition whose size bound is below what the item must share can't contain it
    fits = F.pow(F.lit(2.0), F.col("p")) >= threshold * F.col("n_shingles") - 1e-9
    found = save(entries.join(_small(probe), "h").where(fits).select("doc_id").distinct(), "leak-candidates")
    text = src.join(_small(found), "doc_id").select("doc_id", F.explode(strings(F.col("text"), sizes)).alias("s"))
    shared = text.join(_small(grams), "s").groupBy("doc_id", "item_id").agg(F.countDistinct("s").alias("n_shared"))
    return shared.join(_small(sized), "item_id").withColumn("containment", F.col("n_shared") / F.col("n_shingles")).where(
        F.col("n_shared") >= F.ceil(threshold * F.col("n_shingles") - 1e-9)).select("item_id", "doc_id", "n_shingles", "n_shared", "containment")


def drop_ids(docs: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose ``key`` is a ``doc_id`` of ``ids``; rows without a key stay."""
    return docs.join(_small(ids.select(F.col("doc_id").alias(key)).distinct()), key, "left_anti").select(*docs.columns)


def decontaminate(docs: DataFrame, items: DataFrame, n: int = WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that contain an item."""
    return drop_ids(docs, save(find_leaks(docs, items, n, threshold).select("doc_id").distinct(), "leaks"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents
), i AS (
  SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark
), ig AS (
  SELECT DISTINCT item_id, least(5, len(w)) AS g, array_to_string(w[k : k + least(5, len(w)) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS k FROM i WHERE len(w) > 0)
), sized AS (SELECT item_id, count(*) AS n_shingles FROM ig GROUP BY item_id
), sizes AS (SELECT DISTINCT g FROM ig
), dg AS (
  SELECT DISTINCT doc_id, g, array_to_string(w[k : k + g - 1], ' ') AS s
  FROM (SELECT doc_id, w, g, unnest(range(1, len(w) - g + 2)) AS k FROM d, sizes WHERE len(w) >= g)
)
SELECT item_id, doc_id, n_shingles, count(*) AS n_shared, CAST(count(*) AS DOUBLE) / n_shingles AS containment
FROM ig JOIN dg USING (g, s) JOIN sized USING (item_id)
GROUP BY item_id, doc_id, n_shingles
HAVING count(*) >= ceil(0.8 * n_shingles - 1e-9)
"""
