"""Prefix trie of conversations by van Emde Boas recursion over the depth.

Sequences are cut at half depth, and so are the halves, until single turns are left. Going up, aligned blocks of turns get
names from the names of their halves. Going down, the prefix that ends at a cut gets its name from the prefix at the cut
above and the block between the two: the upper trie and all lower forests of a level in one join, so that the number of
rounds is the logarithm of the longest conversation. A node is a depth and a prefix name.

Subtree totals are grafted upward: every node adds its value to the cut node above it at each level in whose lower half it
lies, and each cut node's total then goes to its ancestors in the upper half. Each pair of a node and an ancestor is
split by exactly one cut, so each value reaches each ancestor once, in two aggregations whatever the depth.

Names are SHA-256 digests of what they name, so no member has to be joined to its node by a key that many share.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, lean, save

ROOT = b""
BUCKET_BITS = 16  # ids that share their higher bits are listed together: at most 65,536 of them
HOT_SHARE = 1000  # a key is hot with more than one of so many rows, so there are at most so many hot keys


def digest(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def order_turns(conversations: DataFrame) -> DataFrame:
    """Turns in order: ``conv_id, part, at, place, turns, key, words`` from ``conversations(conv_id, turn, role, text, ...)``.

    ``place`` counts from 0 in the order of turn (null first); turns with equal numbers are ordered by role, then by the
    digest of role and text. ``turns`` is the conversation's length. Null role or text counts as empty; rows without a
    conv_id are left out. One sort deals all rows evenly; places within a conversation come from the partitions' counts,
    so that a conversation may span partitions.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    slim = save(conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"),
        digest(F.length(role).cast("string"), F.lit(":"), role, text).alias("key"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("words")), "trie-turns")
    ordered = save(slim.orderBy("conv_id", F.col("turn").asc_nulls_first(), "role", "key")
                   .select("conv_id", F.monotonically_increasing_id().alias("at"), "key", "words")
                   .withColumn("part", F.shiftright("at", 33)), "trie-order")
    discard(slim)
    # a row per conversation and partition that it spans
    parts = ordered.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("conv_id")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("conv_id", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
                         F.sum("n").over(whole).alias("turns"))
    return save(ordered.join(parts, ["conv_id", "part"]).select(
        "conv_id", (F.col("at") + F.col("shift")).alias("place"), "turns", "part", "key", "words"), "trie-places")


def graft_heads(turns: DataFrame, group: int = 20) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are those of their group's first conversation.

    With h the CRC-32 of the id's text modulo 4, conversation c is the first h turns of conversation c - c % ``group`` (all if
    it has fewer, none if it is absent) and its own turns from the h-th on. ``turns`` is the result of :func:`order_turns`.
    Returns ``(turns(conv_id, depth, key, words), conversations(conv_id, n_turns))``; depths count from 1.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).alias("h")
    convs = turns.groupBy("conv_id").agg(F.max("turns").alias("own")).select("conv_id", "own", h, (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
    bases = convs.where("conv_id = base").select("base", F.col("own").alias("base_own"))
    convs = save(convs.join(bases, "base", "left").select(
        "conv_id", "base", "h", "own", F.least("h", F.coalesce("base_own", F.lit(0))).alias("taken")), "trie-convs")
    # at most three turns of a base and at most 2 * group conversations to each
    heads = turns.where(f"place < 3 AND conv_id % {group} = 0").select(F.col("conv_id").alias("base"), "place", "key", "words")
    head = convs.where("taken > 0").join(heads, "base").where("place < taken").select("conv_id", (F.col("place") + 1).alias("depth"), "key", "words")
    # the join to the conversations is by conversation and partition, which spreads a long one
    spans = turns.select("conv_id", "part").distinct().join(convs.select("conv_id", "h", "taken"), "conv_id")
    tail = turns.join(spans, ["conv_id", "part"]).where("place >= h").select("conv_id", (F.col("place") - F.col("h") + F.col("taken") + 1).alias("depth"), "key", "words")
    lengths = convs.select("conv_id", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n_turns"))
    return head.unionByName(tail), lengths


def name_prefixes(turns: DataFrame, levels: int) -> DataFrame:
    """``conv_id, depth, name`` of every prefix of one turn or more; ``levels`` halvings reach every depth."""
    blocks = [turns.select("conv_id", (F.col("depth") - 1).alias("block"), "key")]
    for _ in range(1, levels):
        even = F.col("block") % 2 == 0
        pairs = blocks[-1].groupBy("conv_id", F.shiftright("block", 1).alias("block")).agg(
            F.max(F.when(even, F.col("key"))).alias("a"), F.max(F.when(~even, F.col("key"))).alias("b"))
        blocks.append(save(pairs.where("a IS NOT NULL AND b IS NOT NULL").select("conv_id", "block", digest(F.col("a"), F.col("b")).alias("key")), "trie-blocks"))
    done: list[DataFrame] = []
    for k in reversed(range(levels)):
        lower = blocks[k].where("block % 2 = 0").select("conv_id", (F.col("block") * (1 << k)).alias("cut"), "key")
        depth = (F.col("cut") + (1 << k)).alias("depth")
        named = lower.where("cut = 0").select("conv_id", depth, F.col("key").alias("name"))
        if done:
            upper = done[0]
            for more in done[1:]:
                upper = upper.unionByName(more)
            under = lower.where("cut > 0").join(upper.withColumnRenamed("depth", "cut"), ["conv_id", "cut"])
            named = named.unionByName(under.select("conv_id", depth, digest(F.col("name"), F.col("key")).alias("name")))
        done.append(save(named, "trie-prefixes"))
    discard(*blocks[1:])
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def list_digests(members: DataFrame) -> DataFrame:
    """Per node of ``members(depth, name, conv_id)`` (distinct ids): ``depth, name, ends_sha256``, the SHA-256 of the decimal
    ids in numerical order, joined by commas. Ids are listed in buckets of at most 65,536; a node's buckets pass through its
    digest one after the other, so no list is ever held whole."""
    buckets = members.groupBy("depth", "name", F.shiftright("conv_id", BUCKET_BITS).alias("bucket")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))

    @lean
    def run(batches):
        held, sha = None, None
        for batch in batches:
            out = []
            for depth, name, ids in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if held != (depth, name):
                    if held is not None:
                        out.append((*held, sha.hexdigest()))
                    held, sha = (depth, name), hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            yield made(out)
        if held is not None:
            yield made([(*held, sha.hexdigest())])

    def made(rows):
        cols = list(zip(*rows)) if rows else [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.binary(), pa.string()))], names=["depth", "name", "ends_sha256"])

    dealt = buckets.repartition("depth", "name").sortWithinPartitions("depth", "name", "bucket")
    return dealt.select("depth", "name", "ids").mapInArrow(run, "depth bigint, name binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """Nodes of the trie of ``turns(conv_id, depth, key, words)`` (depths from 1, without gaps; ``key`` a binary identity of the
    turn) of ``conversations(conv_id, n_turns)`` (distinct ids; turnless ones are members of the root).

    Per node: ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs`` (members), ``n_children, n_leaves`` (childless
    nodes in the subtree, itself included), ``saved_tokens`` (sum over the subtree of (members - 1) * words of the last turn)
    and ``ends_sha256`` (digest of the ids that end there, see :func:`list_digests`). Without conversations there is no node.
    """
    convs = save(conversations, "trie-lengths")
    every = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("n_turns").alias("longest"))
    levels = int(every.first().longest or 0).bit_length()
    turns = save(turns, "trie-seq")
    root = convs.where("n_turns = 0").select(F.lit(0).cast("bigint").alias("depth"), F.lit(ROOT).alias("name"), "conv_id")
    empty_sha = F.lit(hashlib.sha256(b"").hexdigest())
    if not levels:
        return every.where("n_convs > 0").select("conv_id", F.lit(0).cast("bigint").alias("depth"), F.lit(None).cast("bigint").alias("parent_conv_id"), "n_convs",
                                                 F.lit(0).cast("bigint").alias("n_children"), F.lit(1).cast("bigint").alias("n_leaves"),
                                                 F.lit(0).cast("bigint").alias("saved_tokens")).join(list_digests(root).select("ends_sha256"))
    prefixes = name_prefixes(turns, levels)
    nodes = save(prefixes.groupBy("depth", "name").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")), "trie-nodes")
    above = prefixes.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"))
    nodes = save(nodes.join(turns.select("conv_id", "depth", "words"), ["conv_id", "depth"]).join(above, ["conv_id", "depth"], "left").select(
        "depth", "name", "conv_id", "n_convs", ((F.col("n_convs") - 1) * F.col("words")).alias("saved"), "parent"), "trie-nodes")
    children = nodes.where("depth > 1").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("name")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = save(nodes.join(children, ["depth", "name"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
                 .withColumn("leaf", (F.col("n_children") == 0).cast("bigint")), "trie-nodes")

    # to the cut above, at each level in whose lower half the node lies; then to the cut's ancestors in the upper half
    lies = F.filter(F.array(*[F.lit(k) for k in range(levels)]), lambda k: F.getbit(F.col("depth") - 1, k) == 1)
    size = F.expr("shiftleft(1L, level)")
    lower = (nodes.select("conv_id", "depth", "leaf", "saved", F.explode(lies).alias("level"))
             .select("conv_id", "level", (F.expr("shiftleft(shiftright(depth - 1, level + 1), level + 1)") + size).alias("depth"), "leaf", "saved")
             .groupBy("conv_id", "level", "depth").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved")))
    cuts = save(lower.join(prefixes, ["conv_id", "depth"]).groupBy("level", "depth", "name").agg(
        F.min("conv_id").alias("conv_id"), F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved")), "trie-cuts")
    grafts = cuts.select("conv_id", F.explode(F.sequence(F.col("depth") - size + 1, F.col("depth"))).alias("depth"), "leaf", "saved")
    totals = grafts.join(prefixes, ["conv_id", "depth"]).groupBy("depth", "name").agg(F.sum("leaf").alias("below_leaf"), F.sum("saved").alias("below_saved"))
    ends = list_digests(root.unionByName(convs.where("n_turns > 0").select("conv_id", F.col("n_turns").alias("depth")).join(
        prefixes, ["conv_id", "depth"]).select("depth", "name", "conv_id")))
    ends = save(ends, "trie-ends")

    # parents: few are hot (their children are distinct nodes), the others join by key
    total = nodes.agg(F.count(F.lit(1)).alias("n"), F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"), F.sum((F.col("depth") == 1).cast("bigint")).alias("children")).first()
    parent = nodes.select((F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    is_hot = F.col("n_children") * HOT_SHARE > total.n
    hot = F.broadcast(parent.where(is_hot).drop("n_children"))  # at most HOT_SHARE rows
    up = nodes.where("depth > 1")
    tops = nodes.where("depth = 1").withColumn("parent_conv_id", F.lit(every.first().conv_id))
    linked = tops.unionByName(up.join(hot, ["depth", "parent"])).unionByName(
        up.join(hot.select("depth", "parent"), ["depth", "parent"], "left_anti").join(parent.where(~is_hot).drop("n_children"), ["depth", "parent"]))
    zero = F.lit(0).cast("bigint")
    inner = (linked.join(totals, ["depth", "name"], "left").join(ends, ["depth", "name"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", (F.col("leaf") + F.coalesce("below_leaf", zero)).alias("n_leaves"),
        (F.col("saved") + F.coalesce("below_saved", zero)).alias("saved_tokens"), F.coalesce("ends_sha256", empty_sha).alias("ends_sha256")))
    top = every.select("conv_id", F.lit(0).cast("bigint").alias("depth"), F.lit(None).cast("bigint").alias("parent_conv_id"), "n_convs",
                       F.lit(total.children).cast("bigint").alias("n_children"), F.lit(total.leaf).cast("bigint").alias("n_leaves"),
                       F.lit(total.saved).cast("bigint").alias("saved_tokens"))
    top = top.join(ends.where("depth = 0").select("depth", "ends_sha256"), "depth", "left").select(
        *top.columns, F.coalesce("ends_sha256", empty_sha).alias("ends_sha256"))
    return top.unionByName(inner)


# CRC-32 of the id's text, bit by bit
_CRC = ("xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], [ascii(ch)::BIGINT for ch in string_split(conv_id::VARCHAR, '')]), "
        "lambda a, b: list_reduce(list_concat([xor(a, b)], [0::BIGINT for _ in range(8)]), lambda y, z: xor(y >> 1, (y & 1) * 3988292384))))")

ORACLE = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, role, text) AS turns FROM t GROUP BY conv_id
), h AS (SELECT conv_id, {_CRC} % 4 AS h FROM own),
c AS (
  SELECT o.conv_id, list_concat(coalesce(b.turns, [])[1:h.h], o.turns[h.h + 1:]) AS turns
  FROM own o JOIN h USING (conv_id) LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20
), p AS (
  SELECT conv_id, turns, d::BIGINT AS depth, turns[1:d] AS prefix FROM (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS d FROM c)
), n AS (
  SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
         string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(turns) = depth) AS ends,
         (count(*) - 1) * CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(prefix[depth].text, '[^\x20\x09-\x0D]+')) END AS saved
  FROM p GROUP BY depth, prefix
), kids AS (SELECT depth - 1 AS depth, prefix[1:depth - 1] AS prefix, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (depth, prefix)),
up AS (SELECT unnest(range(depth + 1))::BIGINT AS depth, prefix AS whole, saved, n_children FROM m),
s AS (SELECT depth, whole[1:depth] AS prefix, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM up GROUP BY ALL)
SELECT m.conv_id, m.depth, q.conv_id AS parent_conv_id, m.n_convs, m.n_children, s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(m.ends, '')) AS ends_sha256
FROM m JOIN s USING (depth, prefix) LEFT JOIN n q ON q.depth = m.depth - 1 AND q.prefix = m.prefix[1:m.depth - 1]
"""
