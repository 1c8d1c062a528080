"""Periodic runs in word sequences, by recompression.

The words of a block of texts, with a mark of its own between any two texts, are compressed level by level: block
compression names each stretch of one repeated symbol, pair compression splits the symbols into left and right ones and names
each left one followed by a right one. Every level is a run-length grammar of the one below. Whether a place bounds a
symbol depends on its two neighbours only, so equal stretches are cut alike but for their ends, and the longest
common extension of two places takes at most one step per level on the way up and one on the way down.

A run of period q and at least four periods holds four places of the grid 0, q, 2q, ... with the same word. Such grid places are
the candidates, and extensions of (g, g + q) to both sides are the exact bounds of their run.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean

BLOCK_WORDS = 200_000  # words of the texts that are compressed together; a longer text is a block of its own
PERIODS = 4  # a run has at least so many periods
SHORTEST = 6  # and so many words
QUERIES = 1 << 18  # extensions asked at one time


class Grammar:
    """Levels of a sequence of non-negative integers whose first and last symbol occur once."""

    def __init__(self, symbols: np.ndarray):
        self.levels = []  # per level: symbols, whether it is cut into blocks, starts of the next level's symbols, next symbol of each place
        sym, fresh, seed = symbols.astype(np.int64), int(symbols.max(initial=0)) + 1, 0
        while len(sym) > 1:
            sym, fresh = self._blocks(sym, fresh)
            while len(sym) > 1:
                seed += 1
                # a fixed mixing of the symbol and the round decides left or right
                mixed = (sym + seed) * np.int64(-7046029254386353131)
                left = (mixed ^ mixed >> 29) >> 33 & 1 == 1
                a, b = left[:-1] & ~left[1:], ~left[:-1] & left[1:]
                pair = a if a.sum() >= b.sum() else b
                if pair.any():
                    sym, fresh = self._pairs(sym, pair, fresh)
                    break

    def _push(self, sym: np.ndarray, blocks: bool, start: np.ndarray) -> np.ndarray:
        """Keep a level; ``start`` marks the places where the next level's symbols begin. Returns those places."""
        first = np.flatnonzero(start)
        above = np.empty(len(sym) + 1, np.int64)
        above[:-1] = np.cumsum(start) - 1
        above[-1] = len(first)
        self.levels.append((sym, blocks, np.append(start, True), np.append(first, len(sym)), above))
        return first

    def _blocks(self, sym: np.ndarray, fresh: int):
        start = np.ones(len(sym), bool)
        np.not_equal(sym[1:], sym[:-1], out=start[1:])
        first = self._push(sym, True, start)
        size = np.diff(np.append(first, len(sym)))
        out = sym[first]
        long = np.flatnonzero(size > 1)
        if len(long):
            names, at = np.unique(np.stack([out[long], size[long]]), axis=1, return_inverse=True)
            out[long] = fresh + at.ravel()
            fresh += names.shape[1]
        return out, fresh

    def _pairs(self, sym: np.ndarray, pair: np.ndarray, fresh: int):
        start = np.ones(len(sym), bool)
        start[1:] = ~pair
        first = self._push(sym, False, start)
        out = sym[first]
        at = np.flatnonzero(pair)
        # symbols are below fresh, far less than 2^31 for any block that fits in memory
        names, which = np.unique(sym[at] * np.int64(fresh) + sym[at + 1], return_inverse=True)
        out[self.levels[-1][4][at]] = fresh + which
        return out, fresh + len(names)

    def extend(self, i: np.ndarray, j: np.ndarray, back: bool = False) -> np.ndarray:
        """How far the sequence reads alike from the bounds ``i`` and ``j`` (i <> j) on, or with ``back`` before them."""
        u, v = i.astype(np.int64), j.astype(np.int64)
        stop = np.full(len(u), len(self.levels), np.int64)  # level at which the symbols beside the bounds differ
        live, step, side = np.arange(len(u)), -1 if back else 1, 1 if back else 0
        for t, (sym, blocks, start, first, above) in enumerate(self.levels):
            a, b = u[live], v[live]
            loose = np.flatnonzero(~(start[a] & start[b]))
            halt = np.zeros(len(live), bool)
            if len(loose):
                x, y = a[loose], b[loose]
                same = sym[x - side] == sym[y - side]
                halt[loose] = ~same
                if blocks:
                    m, k = self._reach(first, above, x, back), self._reach(first, above, y, back)
                    halt[loose] |= m != k
                    size = np.where(same, np.minimum(m, k), 0)
                else:
                    size = same.astype(np.int64)
                a[loose], b[loose] = x + step * size, y + step * size
            stop[live[halt]] = t
            u[live], v[live] = np.where(halt, a, above[a]), np.where(halt, b, above[b])
            live = live[~halt]
            if not len(live):
                break
        for t in range(len(self.levels) - 1, -1, -1):
            sym, blocks, _, first, above = self.levels[t]
            down = np.flatnonzero(stop > t)
            if not len(down):
                continue
            x, y = first[u[down]], first[v[down]]
            same = sym[x - side] == sym[y - side]
            if blocks:
                size = np.where(same, np.minimum(self._reach(first, above, x, back), self._reach(first, above, y, back)), 0)
            else:
                size = same.astype(np.int64)
            u[down], v[down] = x + step * size, y + step * size
        return np.abs(u - i)

    @staticmethod
    def _reach(first: np.ndarray, above: np.ndarray, x: np.ndarray, back: bool) -> np.ndarray:
        """Symbols from the bound ``x`` to the end of its block, or back to the beginning of the block before it."""
        return x - first[above[x - 1]] if back else first[above[x] + 1] - x


def find_runs(symbols: np.ndarray, longest: int | None = None) -> np.ndarray:
    """Runs of a sequence of non-negative integers: rows (start, length, period) by start, then period.

    A run is a stretch with smallest period q and at least ``max(SHORTEST, PERIODS * q)`` symbols that can't be made longer.
    ``longest``, if given, is the greatest length that a run can have.
    """
    top = int(symbols.max(initial=0)) + 1
    s = np.concatenate([[top], symbols, [top + 1]]).astype(np.int64)
    small = s.astype(np.int32)
    heads, tails = [], []
    for q in range(1, (len(symbols) if longest is None else longest) // PERIODS + 1):
        grid = small[::q]
        k = np.flatnonzero(grid[1:] == grid[:-1])
        if len(k) < PERIODS - 1:
            continue
        k = k[:2 - PERIODS][k[PERIODS - 2:] - k[:2 - PERIODS] == PERIODS - 2]
        if len(k):
            # the first place of each unbroken stretch of candidates, and the others with the number of their first
            head = np.append(True, np.diff(k) > 1)
            at = sum(map(len, heads))
            heads.append(np.stack([k[head] * q, np.full(int(head.sum()), q)], 1))
            tails.append(np.stack([k[~head] * q, np.full(int((~head).sum()), q), at + np.cumsum(head)[~head] - 1], 1))
    if not heads:
        return np.empty((0, 3), np.int64)
    grammar = Grammar(s)

    def bounds(place, period):
        out = []
        for at in range(0, len(place), QUERIES):
            g, q = place[at:at + QUERIES], period[at:at + QUERIES]
            out.append(np.stack([g - grammar.extend(g, g + q, back=True), g + q + grammar.extend(g, g + q), q], 1))
        return np.concatenate(out) if out else np.empty((0, 3), np.int64)

    head, tail = np.concatenate(heads), np.concatenate(tails)
    found = bounds(head[:, 0], head[:, 1])
    other = tail[tail[:, 0] + tail[:, 1] >= found[tail[:, 2], 1]]  # not inside the run of the first place of the stretch
    found = np.concatenate([found, bounds(other[:, 0], other[:, 1])])
    found = found[found[:, 1] - found[:, 0] >= np.maximum(SHORTEST, PERIODS * found[:, 2])]
    # a multiple of the smallest period has the same bounds
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    kept = np.ones(len(found), bool)
    kept[1:] = (found[1:, :2] != found[:-1, :2]).any(1)
    found = found[kept]
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    return np.stack([found[:, 0] - 1, found[:, 1] - found[:, 0], found[:, 2]], 1)


def block_runs(texts: list[list[bytes]]) -> list[np.ndarray]:
    """Runs (start, length, period) of each sequence of words, found in one grammar."""
    names: dict[bytes, int] = defaultdict(count(len(texts)).__next__)  # the first numbers are the marks between texts
    s = np.empty(sum(map(len, texts)) + len(texts), np.int64)
    starts, at = [], 0
    for i, words in enumerate(texts):
        starts.append(at)
        s[at:at + len(words)] = list(map(names.__getitem__, words))
        at += len(words)
        s[at] = i
        at += 1
    found = find_runs(s, max(map(len, texts), default=0))
    cuts = np.searchsorted(found[:, 0], [*starts, at])
    return [found[a:b] - [start, 0, 0] for a, b, start in zip(cuts, cuts[1:], starts)]


def collapse(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words without those that a run contains after its first period."""
    if not len(runs):
        return words
    drop = np.zeros(len(words) + 1, np.int64)
    np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
    np.add.at(drop, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(drop[:-1]) == 0).tolist()]


def detect_runs(docs: DataFrame, edit: Callable[[object, list[bytes]], list[bytes]] | None = None, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per row of ``docs(doc_id, text, ...)``: ``doc_id, n_words, runs, collapsed``.

    Words are stretches without ASCII white space. ``edit(doc_id, words)``, if given, replaces the words of a text first.
    ``runs`` are the periodic runs (start, length, period; in words) by start, then period; ``collapsed`` is the text of the
    words outside the repeats, joined by one space. Null and blank texts have no words and no runs. Rows with repeated or
    null ids are each judged by themselves; other columns aren't read; an empty table gives an empty result.
    """
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words bigint, " \
        "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"

    def solve(ids, texts, kind):
        found = block_runs(texts)
        flat = np.concatenate(found)
        offsets = np.cumsum([0, *map(len, found)])
        runs = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(
            [pa.array(flat[:, c], pa.int64()) for c in range(3)], names=["start", "length", "period"]))
        plain = pa.array([b" ".join(collapse(w, r)) for w, r in zip(texts, found)], pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(list(map(len, texts)), pa.int64()), runs, plain],
                                          names=["doc_id", "n_words", "runs", "collapsed"])

    @lean
    def run(batches):
        ids, texts, held, kind = [], [], 0, None
        for batch in batches:
            kind = batch.schema.field(0).type
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    words = text.split()  # of bytes: ASCII white space only
                    if edit is not None:
                        words = edit(doc_id, words)
                    if texts and held + len(words) > block_words:
                        yield solve(ids, texts, kind)
                        ids, texts, held = [], [], 0
                    ids.append(doc_id)
                    texts.append(words)
                    held += len(words) + 1
        if texts:
            yield solve(ids, texts, kind)

    return docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text")).mapInArrow(run, schema)
