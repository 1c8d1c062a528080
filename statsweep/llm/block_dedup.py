"""Exact dedup by deterministic block naming.

Every text is cut into blocks of a fixed number of bytes. The distinct blocks are sorted into integer names; then
adjacent names are paired and the distinct pairs sorted into names again, until each document is left with one name.
Equal (level, name) means equal bytes: a name stands for one content, never for a hash value alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, save

# a run of white space that isn't already a single space
SPACE_RUN = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def _key(block, salt: int):
    return F.xxhash64(F.lit(salt), block)


def _name(distinct: DataFrame, cols: list[str], label: str) -> DataFrame:
    """Integer names for distinct rows, rising with the sort order inside each partition; written once."""
    return save(distinct.sortWithinPartitions(*cols).withColumn("name", F.monotonically_increasing_id()).drop("block"), label)


def block_names(docs: DataFrame, block_bytes: int = 1024, key=_key) -> DataFrame:
    """One identity per row of ``docs(doc_id, text)``: ``doc_id, text_sha256, n_blocks, name``.

    Rows have equal ``(n_blocks, name)`` exactly if their normalised texts have equal bytes. ``text``: null counts
    as empty; each run of white space becomes one space. Rows with a repeated or null ``doc_id`` keep their own row.
    Blocks are named over their contents. Join keys between a block and its name are two hash values; that no two
    contents share a key is checked, and other hash values are taken if they do.
    """
    norm = docs.select("doc_id", F.regexp_replace(F.coalesce("text", F.lit("")), SPACE_RUN, " ").cast("binary").alias("t"))
    nb = F.greatest(F.lit(1), F.ceil(F.length("t") / block_bytes)).cast("int")
    block = lambda i: F.substring(F.col("t"), i * block_bytes + 1, F.lit(block_bytes))
    cut = norm.withColumn("n_blocks", nb).withColumn("i", F.sequence(F.lit(0), nb - 1))
    salt = 0
    while True:
        blocks = cut.select(F.explode(F.transform("i", block)).alias("block"))
        keyed = blocks.select(key(F.col("block"), salt).alias("h1"), key(F.col("block"), salt + 1).alias("h2"), "block")
        names = _name(keyed.distinct(), ["block"], "block-names")
        if names.groupBy("h1", "h2").count().where("count > 1").isEmpty():
            break
        discard(names)
        salt += 2
    pair = lambda b: F.struct(key(b, salt).alias("h1"), key(b, salt + 1).alias("h2"))
    rows = save(cut.select(F.monotonically_increasing_id().alias("rid"), "doc_id", F.sha2("t", 256).alias("text_sha256"), "n_blocks",
                           F.transform("i", lambda i: pair(block(i))).alias("h")), "block-rows")
    at = rows.select("rid", "n_blocks", F.posexplode("h").alias("pos", "h")).select("rid", "n_blocks", "pos", "h.h1", "h.h2")
    level = save(at.join(names, ["h1", "h2"]).select("rid", "n_blocks", "pos", "name"), "block-level")
    discard(names)
    done = []
    longest = rows.agg(F.max("n_blocks")).first()[0] or 1
    left = longest
    width = 1
    while True:
        done.append(level.where(F.col("n_blocks") <= width).select("rid", "name"))
        if left <= 1:
            break
        # adjacent names (the last may lack its right one) become one name
        even = F.when(F.col("pos") % 2 == 0, F.col("name"))
        odd = F.when(F.col("pos") % 2 == 1, F.col("name"))
        pairs = (level.where(F.col("n_blocks") > width)
                 .groupBy("rid", "n_blocks", F.floor(F.col("pos") / 2).alias("pos"))
                 .agg(F.max(even).alias("a"), F.coalesce(F.max(odd), F.lit(-1)).alias("b")))
        names = _name(pairs.select("a", "b").distinct(), ["a", "b"], "pair-names")
        nxt = save(pairs.join(names, ["a", "b"]).select("rid", "n_blocks", "pos", "name"), "block-level")
        discard(names)
        level, left, width = nxt, (left + 1) // 2, width * 2
    named = done[0]
    for d in done[1:]:
        named = named.unionByName(d)
    return rows.drop("h").join(named, "rid").drop("rid")


def block_dedup(docs: DataFrame, block_bytes: int = 1024, key=_key) -> DataFrame:
    """Per row of ``docs(doc_id, text, ...)``: ``doc_id, keep_id, group_size, kept, text_sha256, n_blocks``.

    Of equal normalised texts the row with the smallest ``doc_id`` stays. A null ``doc_id`` stays only in a group
    without any other id; rows that repeat the kept ``doc_id`` with the same text all count as kept. An empty table
    gives an empty result; other columns aren't read.
    """
    named = save(block_names(docs, block_bytes, key), "block-identity")
    groups = named.groupBy("n_blocks", "name").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return named.join(groups, ["n_blocks", "name"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256", "n_blocks")


ORACLE = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
), g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256,
       CAST(greatest(1, ceil(strlen(norm) / 1024.0)) AS INTEGER) AS n_blocks
FROM t JOIN g USING (norm)
"""
