"""N-gram Jaccard join by vertical partitioning.

Each document is the set of its distinct word shingles, as 64-bit hashes. The shingles have one global order: rarest
first, by the number of different sets that hold them, then by hash. The join runs in these steps:

1. Equal sets form one class. Classes are the nodes from here on.
2. Every shingle goes to a bucket by hash, where its count is taken; only shingles of at least two classes come back.
   A partner must share ``ceil(t * n)`` shingles, so a class with fewer shared ones has no link and is done.
3. Prefix filter: two linked sets share a shingle among the first ``n - ceil(t * n) + 1`` of each in the global order.
   Classes that share a prefix shingle are candidates, if the shingles that each shares with any other suffice for a link.
   Each class is first paired with one class of each of its prefix shingles only, the one with the least share of shingles
   of its own, so that a large group of near copies gives one pair per member, not all pairs.
4. The global order is cut into fragments. A pair's overlap is counted in each fragment by itself, and summed.
5. What the hubs don't connect is compared exhaustively: classes connected by prefix shingles form a cluster; its
   members are dealt into tiles, and each pair of tiles that shares a prefix shingle (not within one component) counts the
   overlaps of all its pairs in each fragment as one matrix, of the classes that have a candidate of another component
   there. The matrices are summed over the fragments, and only the links that connect leave.

Components of the links are the result: no link between different sets is lost, and copies are never expanded.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, discard, lean, save, worker_cache

WORDS = 4
LINK = 85  # percent of the union that two linked sets share
BUCKET_TOKENS = 2_000_000  # shingles in a bucket of step 2, on average
FRAGMENTS = 4
TILE = 128  # members of a tile, on average
BATCH = 1_000  # documents whose shingles are sent together
HOT = 1_000  # shingles of more than 1 / HOT of the documents need no bucket: they are shared anyway
CACHE_ENTRIES = 100_000
LOW48 = np.uint64((1 << 48) - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    """Final mixing of a 64-bit hash."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    def __init__(self, seed):
        super().__init__()
        self.seed = seed

    def __missing__(self, word):
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word, self.seed)
        return h


def shingle_hashes(text: str | None, n: int = WORDS, seed: int = 0) -> np.ndarray:
    """Sorted distinct hashes of the text's ``n``-word shingles (A-Z lower-cased); fewer words are one shingle."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < n:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed + 1)], np.uint64)
    held = worker_cache("shingle-words")
    table = held.get(seed) or held.setdefault(seed, _Words(seed))
    h = np.fromiter(map(table.__getitem__, words), np.uint64, len(words))
    out = h[:len(h) - n + 1].copy()
    for k in range(1, n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[k:len(h) - n + 1 + k]
    return np.unique(_mix(out))


def _signature(tokens: np.ndarray, seed: int) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes(), seed)


def _sets(docs: DataFrame, n: int, seed: int) -> DataFrame:
    """Per row: ``doc_id, n_shingles, c, c2`` (128-bit name of the set), and on the first row of a batch the shingles
    that are frequent in that batch, with their counts (``hot``, ``hot_n``)."""

    @lean
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                sets = [shingle_hashes(t, n, seed) for t in part.column(1).to_pylist()]
                sigs = np.frombuffer(b"".join(_signature(s, seed) for s in sets), np.int64).reshape(-1, 2)
                first = np.unique(sigs[:, 0], return_index=True)[1]
                tok, num = np.unique(np.concatenate([sets[i] for i in first]), return_counts=True)
                often = num >= max(8, len(first) // 200)
                rest = [None] * (part.num_rows - 1)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(sigs[:, 0]), pa.array(sigs[:, 1]),
                    pa.array([tok[often].view(np.int64).tolist(), *rest], pa.list_(pa.int64())),
                    pa.array([num[often].tolist(), *rest], pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "c", "c2", "hot", "hot_n"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        run, "doc_id bigint, n_shingles bigint, c bigint, c2 bigint, hot array<bigint>, hot_n array<bigint>")


def _flat(column: pa.ChunkedArray, dtype) -> np.ndarray:
    """The bytes of all rows of a binary column, one after the other, as items of ``dtype``."""
    out = [np.zeros(0, np.uint8)]
    for a in column.chunks:
        if len(a):
            ends = np.frombuffer(a.buffers()[1], np.int32, len(a) + 1, 4 * a.offset)
            out.append(np.frombuffer(a.buffers()[2], np.uint8, int(ends[-1] - ends[0]), int(ends[0])) if ends[-1] > ends[0] else out[0])
    return np.concatenate(out).view(dtype)


def _binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """A binary column over the bytes of ``data``, with rows of so many bytes."""
    ends = np.r_[0, np.cumsum(sizes)]
    if ends[-1] >= 1 << 31:
        raise ValueError("the rows of a batch hold more than 2 GB of shingles")
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data).view(np.uint8))])


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys begins."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = False
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _spans(first: np.ndarray, num: np.ndarray) -> np.ndarray:
    """The places ``first[k], first[k] + 1, ...``, ``num[k]`` of them, for each k in turn."""
    return np.repeat(first - np.r_[0, np.cumsum(num)[:-1]], num) + np.arange(int(num.sum())) if len(num) else np.zeros(0, np.int64)


WHO = np.dtype([("c", "<i8"), ("n", "<u4"), ("num", "<u4")])  # a class, its shingles, and how many of them follow


def _who(c, n, num) -> np.ndarray:
    out = np.empty(len(c), WHO)
    out["c"], out["n"], out["num"] = c, n, num
    return out


def _send(texts: list, n: int, seed: int, buckets: int, hots: np.ndarray) -> list[pa.Array]:
    """``bucket, who, tok``: the shingles of each bucket, by class; those of one text after those of another. There are
    as many rows as buckets that the texts reach, and no step is taken row by row."""
    sets = {}
    for t in texts:
        s = shingle_hashes(t, n, seed)
        if len(s):
            sets.setdefault(int.from_bytes(_signature(s, seed)[:8], "little", signed=True), s)
    if not sets:
        return [pa.array([], pa.int32()), pa.array([], pa.binary()), pa.array([], pa.binary())]
    cs, ns = np.array(list(sets), np.int64), np.array([len(s) for s in sets.values()], np.uint32)
    tok, row = np.concatenate(list(sets.values())), np.repeat(np.arange(len(cs), dtype=np.uint32), ns)
    dest = ((tok >> np.uint64(48)) % np.uint64(buckets)).astype(np.uint16)
    if len(hots):
        is_hot = hots[np.minimum(np.searchsorted(hots, tok), len(hots) - 1)] == tok
        dest[is_hot] = buckets + (cs.view(np.uint64) % np.uint64(buckets)).astype(np.uint16)[row[is_hot]]
    order = np.argsort(dest, kind="stable")  # rows stay in order within a bucket
    tok, row, dest = tok[order], row[order], dest[order]
    runs = _starts(dest, row)
    num = np.diff(np.r_[runs, len(tok)])
    at = _starts(dest[runs])  # the first run of each bucket
    bucket = dest[runs[at]].astype(np.int32)
    cut = int(np.searchsorted(dest, buckets))  # hot ones come last, whole; of the others the bucket is known
    six = np.ascontiguousarray((tok[:cut] & LOW48).view(np.uint8).reshape(-1, 8)[:, :6]).ravel()
    size = np.add.reduceat(num, at) * np.where(bucket < buckets, 6, 8)
    return [pa.array(bucket), _binary(_who(cs[row[runs]], ns[row[runs]], num), np.diff(np.r_[at, len(runs)]) * WHO.itemsize),
            _binary(np.concatenate([six, tok[cut:].view(np.uint8)]), size)]


def _count(bucket: int, who: np.ndarray, tok: np.ndarray, buckets: int, parts: int) -> pa.Table:
    """``part, who, tok, df`` of a bucket's shingles that at least two classes hold: one row for each part that gets any."""
    # a class that comes in several batches has the same shingles each time: the first one stays
    first = np.zeros(len(who), bool)
    first[np.unique(who["c"], return_index=True)[1]] = True
    if not first.all():
        tok, who = tok[np.repeat(first, who["num"])], who[first]
    row = np.repeat(np.arange(len(who)), who["num"])
    if bucket >= buckets:
        tok, df = tok & np.uint64((1 << 63) - 1), np.full(len(tok), 65535, np.uint16)
        fresh = np.ones(len(tok), bool)
        order = np.lexsort((tok, row))
        fresh[order[1:]] = (row[order[1:]] != row[order[:-1]]) | (tok[order[1:]] != tok[order[:-1]])
    else:
        order = np.argsort(tok, kind="stable")
        t, r = tok[order], row[order]
        one = np.ones(len(t), bool)
        one[1:] = (t[1:] != t[:-1]) | (r[1:] != r[:-1])  # of names that two shingles of a class share one stays
        order, t = order[one], t[one]
        at = _starts(t)
        size = np.diff(np.r_[at, len(t)])
        df = np.zeros(len(tok), np.uint16)
        df[order] = np.repeat(np.minimum(size, 65534), size)
        fresh = df > 1
        tok = tok | (np.uint64(bucket) << np.uint64(48))
    # one row per destination: classes meet again by the remainder of their name
    left = np.bincount(row[fresh], minlength=len(who))
    begin, tok, df = np.r_[0, np.cumsum(left)[:-1]], tok[fresh], df[fresh]
    runs = np.flatnonzero(left)
    part = (who["c"][runs].view(np.uint64) % np.uint64(parts)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    runs, part = runs[order], part[order]
    num, at = left[runs], _starts(part)
    place = _spans(begin[runs], num)
    size = np.add.reduceat(num, at) if len(at) else np.zeros(0, np.int64)
    return pa.table([pa.array(part[at], pa.int32()), _binary(_who(who["c"][runs], who["n"][runs], num), np.diff(np.r_[at, len(runs)]) * WHO.itemsize),
                     _binary(tok[place], 8 * size), _binary(df[place], 2 * size)], names=["part", "who", "tok", "df"])


def _shared(docs: DataFrame, n: int, seed: int, buckets: int, hot: np.ndarray) -> DataFrame:
    """Step 2: ``part, who, tok, df`` per bucket: the shingles that at least two classes hold, and their counts (int64 and
    uint16, 65535 at most), packed by the part that the class belongs to. The hot shingles are dealt by class, all
    others by shingle."""
    parts = 4 * buckets
    hot_list = docs.sparkSession.sparkContext.broadcast(np.sort(hot))  # at most HOT times the mean set size

    @lean
    def send(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                yield pa.RecordBatch.from_arrays(_send(batch.slice(at, BATCH).column(0).to_pylist(), n, seed, buckets, hot_list.value), names=["bucket", "who", "tok"])

    @lean
    def count(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        if bucket >= buckets:
            tok = _flat(table.column("tok"), np.uint64)
        else:
            six = _flat(table.column("tok"), np.uint8).reshape(-1, 6)
            wide = np.zeros((len(six), 8), np.uint8)
            wide[:, :6] = six
            tok = wide.view(np.uint64).ravel()
        return _count(bucket, _flat(table.column("who"), WHO), tok, buckets, parts)

    sent = docs.select("text").mapInArrow(send, "bucket int, who binary, tok binary")
    return sent.groupBy("bucket").applyInArrow(count, "part int, who binary, tok binary, df binary")


def need(n, link: int = LINK):
    """Shingles that a set of ``n`` must share with a linked set: ``ceil(link / 100 * n)``."""
    return -(-link * n // 100)


def _survivors(shared: DataFrame, link: int) -> DataFrame:
    """``c, n, tok, df, prefix``: the shared shingles of every class that may have a link, in the global order, and
    how many of them belong to the prefix."""

    @lean
    def merge(table: pa.Table) -> pa.Table:
        who, tok, df = _flat(table.column("who"), WHO), _flat(table.column("tok"), np.int64), _flat(table.column("df"), np.uint16)
        kinds, first, row = np.unique(who["c"], return_index=True, return_inverse=True)
        size, row = who["n"][first].astype(np.int64), np.repeat(row, who["num"])
        s = np.bincount(row, minlength=len(kinds))
        keep = s * 100 >= size * link
        # shingles of one class alone come before all shared ones
        prefix = size - need(size, link) + 1 - (size - s)
        mine = keep[row]
        row, tok, df = row[mine], tok[mine], df[mine]
        order = np.lexsort((tok, df, row))
        offsets = pa.array(np.r_[0, np.cumsum(s[keep])].astype(np.int32))
        return pa.table([pa.array(kinds[keep]), pa.array(size[keep]), pa.ListArray.from_arrays(offsets, pa.array(tok[order])),
                         pa.ListArray.from_arrays(offsets, pa.array(df[order].astype(np.int32))), pa.array(prefix[keep].astype(np.int32))],
                        names=["c", "n", "tok", "df", "prefix"])

    return shared.groupBy("part").applyInArrow(merge, "c bigint, n bigint, tok array<bigint>, df array<int>, prefix int")


def _pivots(kept: DataFrame, fragments: int) -> list[tuple[int, int]]:
    """Cuts ``(df, tok)`` of the global order into fragments of about equal numbers of shingles. Counts per ``df``
    (65536 values at most) come to the driver; within one ``df`` the shingles are taken as evenly spread hashes."""
    rows = kept.select(F.explode("df").alias("df")).groupBy("df").count().orderBy("df").collect()
    total, seen, cuts = sum(r["count"] for r in rows), 0, []
    for r in rows:
        while len(cuts) < fragments - 1 and seen + r["count"] > (len(cuts) + 1) * total / fragments:
            share = ((len(cuts) + 1) * total / fragments - seen) / r["count"]
            cuts.append((r["df"], int(share * (1 << 62))))
        seen += r["count"]
    return cuts


def _segments(kept: DataFrame, cuts: list[tuple[int, int]]) -> DataFrame:
    """``c, n, f, seg``: the shingles of each class in each fragment (empty segments too)."""

    @lean
    def run(batches):
        k = len(cuts) + 1
        for batch in batches:
            tok, df = (batch.column(i).flatten().to_numpy() for i in (2, 3))
            row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(batch.column(2)).to_numpy())
            part = np.zeros(len(tok), np.int64)
            for cut_df, cut_tok in cuts:
                part += (df > cut_df) | ((df == cut_df) & (tok >= cut_tok))
            cell = row * k + part
            order = np.lexsort((tok, cell))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(np.repeat(batch.column(i).to_numpy(), k)) for i in (0, 1)), pa.array(np.tile(np.arange(k, dtype=np.int32), batch.num_rows)),
                 _binary(tok[order], 8 * np.bincount(cell, minlength=k * batch.num_rows))], names=["c", "n", "f", "seg"])

    return kept.select("c", "n", "tok", "df").mapInArrow(run, "c bigint, n bigint, f int, seg binary")


def _verify(pairs: DataFrame, segments: DataFrame, link: int) -> DataFrame:
    """The pairs ``a, b`` that are linked: partial overlaps by fragment, summed per pair."""
    left = segments.select(F.col("c").alias("a"), F.col("n").alias("na"), "f", F.col("seg").alias("sa"))
    right = segments.select(F.col("c").alias("b"), F.col("n").alias("nb"), "f", F.col("seg").alias("sb"))
    both = pairs.join(left, "a").join(right, ["b", "f"])

    @lean
    def run(batches):
        for batch in batches:
            sa, sb = batch.column(4), batch.column(5)
            part = [len(np.intersect1d(np.frombuffer(x.as_buffer(), np.int64), np.frombuffer(y.as_buffer(), np.int64), assume_unique=True))
                    for x, y in zip(sa, sb)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), pa.array(part, pa.int64())], names=["a", "b", "na", "nb", "part"])

    partial = both.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(run, "a bigint, b bigint, na bigint, nb bigint, part bigint")
    total = partial.groupBy("a", "b", "na", "nb").agg(F.sum("part").alias("o"))
    return total.where(F.col("o") * 100 >= link * (F.col("na") + F.col("nb") - F.col("o"))).select("a", "b")


def _tiles(members: DataFrame) -> DataFrame:
    """``cluster, c, comp, tile, single, n, s``: members of a cluster with more than one component, dealt into tiles of about
    ``TILE``; a component of more than a tile gets tiles of its own (``single`` is then the component)."""
    sizes = members.groupBy("cluster", "comp").agg(F.count(F.lit(1)).alias("size"))
    small = F.when(F.col("size") <= TILE, F.col("size")).otherwise(0)
    bins = sizes.groupBy("cluster").agg(F.ceil(F.sum(small) / TILE).alias("bins"), F.count(F.lit(1)).alias("comps")).where("comps > 1")
    dealt = members.join(sizes, ["cluster", "comp"]).join(bins, "cluster")
    own = F.col("size") > TILE
    tile = F.when(own, F.xxhash64("comp", F.pmod(F.xxhash64("c"), F.ceil(F.col("size") / TILE)))).otherwise(
        F.pmod(F.xxhash64("comp"), F.greatest(F.col("bins"), F.lit(1))))
    return dealt.select("cluster", "c", "comp", tile.alias("tile"), F.when(own, F.col("comp")).alias("single"), "n", "s")


def _can_link(a: str, b: str, link: int):
    """Whether two classes, structs or prefixes ``a`` and ``b`` with ``n`` and ``s``, may be linked: they share at most ``s`` shingles,
    all that the class shares with any other. (The lengths alone are judged with it, as ``s <= n``.)"""
    return (100 + link) * F.least(F.col(f"{a}.s"), F.col(f"{b}.s")) >= link * (F.col(f"{a}.n") + F.col(f"{b}.n"))


def _tile_pairs(tiles: DataFrame, posts: DataFrame) -> DataFrame:
    """``cluster, i, j``: the pairs of tiles, ``i <= j``, in which two classes of different components may share a prefix
    shingle. Shingles held by the same tiles count once."""
    held = posts.select("c", "t").join(tiles, "c").groupBy("cluster", "t").agg(
        F.sort_array(F.collect_set(F.struct("tile", "single"))).alias("held"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    sets = held.where("lo <> hi").select("cluster", "held").distinct()
    pairs = sets.select("cluster", "held", F.explode("held").alias("x")).select("cluster", "x", F.explode("held").alias("y"))
    return pairs.where("x.tile <= y.tile AND NOT (x.single IS NOT NULL AND y.single IS NOT NULL AND x.single = y.single)").select(
        "cluster", F.col("x.tile").alias("i"), F.col("y.tile").alias("j")).distinct()


def _tile_links(tiles: DataFrame, posts: DataFrame, segments: DataFrame, link: int) -> DataFrame:
    """Links ``a, b`` that connect components, from the pairs of tiles of a cluster that share a prefix shingle; a spanning
    set per tile pair. Of a tile only the classes come that may be linked with one of another component in the other."""
    pairs = _tile_pairs(tiles, posts)
    sides = pairs.select("cluster", "i", "j", F.col("i").alias("tile"), F.col("j").alias("other"), F.lit(0).alias("side")).union(
        pairs.where("i <> j").select("cluster", "i", "j", F.col("j").alias("tile"), F.col("i").alias("other"), F.lit(1).alias("side")))
    mine = sides.join(tiles.drop("single"), ["cluster", "tile"]).alias("x")
    theirs = tiles.select("cluster", "tile", "comp", "n", "s").alias("y")
    rows = mine.join(theirs, (F.col("x.cluster") == F.col("y.cluster")) & (F.col("x.other") == F.col("y.tile"))
                     & (F.col("x.comp") != F.col("y.comp")) & _can_link("x", "y", link), "left_semi")
    rows = rows.drop("n").join(segments, "c").select("cluster", "i", "j", "f", "side", "c", "n", "comp", "seg")

    @lean
    def overlap(table: pa.Table) -> pa.Table:
        sides = []
        for s in (0, 1):
            part = table.filter(pc.equal(table.column("side"), s)).sort_by("c")
            sides.append((part, [np.frombuffer(x.as_buffer(), np.int64) for x in part.column("seg")]))
        if not len(sides[1][0]):
            sides[1] = sides[0]
        (ta, a), (tb, b) = sides
        flat = [(np.concatenate(x) if x else np.zeros(0, np.int64), np.repeat(np.arange(len(x)), [len(y) for y in x])) for x in (a, b)]
        both = np.intersect1d(flat[0][0], flat[1][0])
        out = np.zeros((len(a), len(b)), np.float32)
        for at in range(0, len(both), 8192):  # columns at a time: bounded memory for any text length
            vocab = both[at:at + 8192]
            m = []
            for (tok, row), x in zip(flat, (a, b)):
                col = np.searchsorted(vocab, tok)
                hit = (col < len(vocab)) & (vocab[np.minimum(col, len(vocab) - 1)] == tok)
                d = np.zeros((len(x), len(vocab)), np.float32)
                d[row[hit], col[hit]] = 1
                m.append(d)
            out += m[0] @ m[1].T
        meta = np.concatenate([np.array([len(a), len(b)], np.int64), *(np.asarray(t.column(k), dtype=np.int64) for t in (ta, tb) for k in ("c", "n", "comp"))])
        first = table.slice(0, 1)
        return pa.table({"cluster": first.column("cluster"), "i": first.column("i"), "j": first.column("j"),
                         "meta": pa.array([meta.tobytes()], pa.binary()), "part": pa.array([out.astype(np.int32).tobytes()], pa.binary())})

    @lean
    def total(table: pa.Table) -> pa.Table:
        meta = np.frombuffer(table.column("meta")[0].as_buffer(), np.int64)
        na, nb = meta[:2]
        o = sum(np.frombuffer(x.as_buffer(), np.int32).astype(np.int64) for x in table.column("part")).reshape(na, nb)
        ca, sa, pa_, cb, sb, pb = np.split(meta[2:], np.cumsum([na, na, na, nb, nb]))
        linked = (o * 100 >= link * (sa[:, None] + sb[None, :] - o)) & (pa_[:, None] != pb[None, :])
        root: dict[int, int] = {}

        def find(x):
            while (y := root.get(x, x)) != x:
                root[x] = x = root.get(y, y)
            return x

        out = []
        for x, y in zip(*np.nonzero(linked)):
            p, q = find(int(pa_[x])), find(int(pb[y]))
            if p != q:
                root[p] = q
                out.append((int(ca[x]), int(cb[y])))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    partial = rows.groupBy("cluster", "i", "j", "f").applyInArrow(overlap, "cluster bigint, i bigint, j bigint, meta binary, part binary")
    return partial.groupBy("cluster", "i", "j").applyInArrow(total, "a bigint, b bigint")


def _hot(info: DataFrame, docs: int) -> np.ndarray:
    """Shingles found in more than 1 / HOT of the documents, as far as frequent in a batch; at most HOT times the mean
    number of shingles. They only save work: which ones they are changes no result."""
    pairs = info.where("hot IS NOT NULL").select(F.explode(F.arrays_zip("hot", "hot_n")).alias("z")).groupBy(F.col("z.hot").alias("t")).agg(
        F.sum("z.hot_n").alias("m")).where(F.col("m") * HOT > docs).select("t")
    return np.array([r.t for r in pairs.collect()], np.int64).view(np.uint64)


def link_classes(spark: SparkSession, docs: DataFrame, n: int = WORDS, link: int = LINK, fragments: int = FRAGMENTS):
    """``(info, roots)``: the set of every row, and for each class with a link ``c, root`` (one root per component)."""
    seed = 0
    while True:
        info = save(_sets(docs, n, seed), "shingle-sets")
        # a class is named by half of its 128-bit signature: no two may share it
        if info.groupBy("c").agg(F.min("c2").alias("x"), F.max("c2").alias("y")).where("x <> y").isEmpty():
            break
        discard(info)
        seed += 2
    size = info.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n_shingles"), F.lit(0)).alias("tokens")).first()
    buckets = min(1 << 14, 1 << max(4, math.ceil(math.log2(max(1, size.tokens / BUCKET_TOKENS)))))
    kept = save(_survivors(_shared(docs, n, seed, buckets, _hot(info, size.docs)), link), "shared-shingles")
    posts = kept.select("c", "n", F.size("tok").alias("s"), F.explode(F.slice("tok", F.lit(1), F.col("prefix"))).alias("t"))
    # the hub of a shingle is the class with the least of its own: what others have changed counts against each of two near copies
    hubs = posts.groupBy("t").agg(F.min(F.struct((1 - F.col("s") / F.col("n")).alias("own"), "c", "n", "s")).alias("hub"), F.count(F.lit(1)).alias("m")).where("m > 1").select("t", "hub")
    met = posts.alias("post").join(hubs, "t").where("c <> hub.c").select(F.col("hub.c").alias("a"), F.col("c").alias("b"), _can_link("hub", "post", link).alias("fit"))
    near = save(met.distinct(), "hub-pairs")
    segments = save(_segments(kept, _pivots(kept, fragments)), "segments")
    links = save(_verify(near.where("fit").select("a", "b"), segments, link), "hub-links")
    cluster = save(components(near), "clusters")
    comp = components(links)
    members = cluster.select(F.col("node").alias("c"), F.col("component").alias("cluster")).join(
        comp.select(F.col("node").alias("c"), F.col("component").alias("comp")), "c", "left").withColumn("comp", F.coalesce("comp", "c")).join(kept.select("c", "n", F.size("tok").alias("s")), "c")
    tiles = save(_tiles(members), "tiles")
    more = save(_tile_links(tiles, posts, segments, link), "tile-links")
    roots = components(links.union(more)).select(F.col("node").alias("c"), F.col("component").alias("root"))
    return info, roots


def jaccard_components(docs: DataFrame, n: int = WORDS, link: int = LINK) -> DataFrame:
    """Per row of ``docs(doc_id, text, ...)``: ``doc_id, n_shingles, component_id``.

    Two rows are linked when their sets of distinct ``n``-word shingles share at least ``link`` percent of the union;
    ``component_id`` is the smallest ``doc_id`` reachable by links, the row's own included. Texts with fewer than ``n``
    words are one shingle; null or blank texts have none and are linked with nothing. Rows that repeat a ``doc_id`` are
    judged each by its text; a null ``doc_id`` never names a component unless no member has an id.
    """
    info, roots = link_classes(docs.sparkSession, docs, n, link)
    full = info.where("n_shingles > 0").select("doc_id", "n_shingles", "c").join(roots, "c", "left").withColumn("root", F.coalesce("root", "c"))
    low = full.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    out = full.join(low, "root").select("doc_id", "n_shingles", "component_id")
    return out.unionByName(info.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
