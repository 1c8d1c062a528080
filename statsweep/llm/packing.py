"""Packing of documents into sequences of a fixed length by minimum bin slack.

Every document is tokenised and cut into whole sequences; what remains of it joins a pool of lengths with counts. A window
starts with the longest length left, and a subset-sum dynamic programme over bitsets finds the multiset of lengths that comes
closest to its capacity; the counts are read back from the bitsets of the single lengths. The same multiset fills as many
windows as its counts allow. Slack that no multiset closes is filled with the front of one more document, whose rest goes
back to the pool, and what is left at the very end is cut into powers of two, which need no padding.

The pools are those of the input's partitions, so no row is shuffled. A task holds at most ``POOL`` remainders.
"""

from __future__ import annotations

import json
import re
from array import array
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, worker_cache

POOL = 4096  # remainders of documents that are packed together
KEEP = 512  # of those the ones kept for the next pool, so that it has many lengths to choose from
CACHE_ENTRIES = 300_000  # parts of texts whose ids a worker keeps
EMIT = 2048  # pieces in a batch of results
GAP = re.compile(r"\s \s|\s $")  # a space inside or at the end of white space: the parts are then not independent
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # fixed value: the byte-level pre-tokeniser's


def fill(lengths: Iterable[tuple[int, int]], room: int) -> dict[int, int]:
    """The multiset (length: copies) out of ``lengths`` (length, count) with the greatest sum of at most ``room``.

    Bit s of ``reach`` says that some multiset of the lengths seen so far sums to s. A length's copies enter in powers of
    two, so that every number of copies up to its count is tried with a logarithmic number of shifts.
    """
    mask, reach, before = (1 << room + 1) - 1, 1, []
    for n, count in lengths:
        if n > room:
            continue
        before.append((n, reach))
        left, step = min(count, room // n), 1
        while left:
            step = min(step, left)
            reach |= reach << step * n & mask
            left, step = left - step, step * 2
        if reach >> room & 1:
            break
    total, picked = reach.bit_length() - 1, {}
    for n, reached in reversed(before):
        while not reached >> total & 1:
            picked[n] = picked.get(n, 0) + 1
            total -= n
    return picked


class Pool:
    """Remainders ``(ids, row, start)`` by their length in ids; ``ids`` are packed bytes of 4 each."""

    def __init__(self, length: int):
        self.length, self.items, self.order, self.n = length, {}, [], 0  # order: the lengths at hand, rising

    def add(self, ids: bytes, row: tuple, start: int) -> None:
        n = len(ids) // 4
        if n not in self.items:
            self.items[n] = []
            insort(self.order, n)
        self.items[n].append((ids, row, start))
        self.n += 1

    def _take(self, n: int) -> tuple:
        held = self.items[n]
        item = held.pop()
        if not held:
            del self.items[n], self.order[bisect_left(self.order, n)]
        self.n -= 1
        return item

    def _choice(self, longest: int) -> Iterator[tuple[int, int]]:
        """Lengths and counts beside one remainder of the longest length. Those of which three fit come first, from the
        longest down: their sums soon cover the room, and the short ones are left for later windows."""
        room = self.length - longest
        some, last = bisect_right(self.order, room // 3), bisect_right(self.order, room)
        for n in (*reversed(self.order[:some]), *reversed(self.order[some:last])):
            count = len(self.items[n]) - (n == longest)
            if count:
                yield n, count

    def windows(self, keep: int) -> Iterator[list[tuple]]:
        """Windows filled to the brim, until at most ``keep`` remainders are left; for ``keep`` 0 then the rest."""
        while self.n > keep:
            longest = self.order[-1]
            need = fill(self._choice(longest), self.length - longest)
            need[longest] = need.get(longest, 0) + 1
            slack = self.length - sum(n * k for n, k in need.items())
            cut = 0
            if slack:
                # every remainder not taken is longer than the slack
                cut = next((n for n in reversed(self.order) if len(self.items[n]) > need.get(n, 0)), 0)
                if not cut:
                    if not keep:
                        yield from self._powers()
                    return
            all_need = need if not cut else {**need, cut: need.get(cut, 0) + 1}
            for _ in range(min(len(self.items[n]) // k for n, k in all_need.items())):
                window = [self._take(n) for n, k in need.items() for _ in range(k)]
                if cut:
                    ids, row, start = self._take(cut)
                    window.append((ids[:slack * 4], row, start))
                    self.add(ids[slack * 4:], row, start + slack)
                yield window

    def _powers(self) -> Iterator[list[tuple]]:
        """The last remainders, less than a sequence in all, in sequences whose lengths are powers of two."""
        rest = [self._take(n) for n in sorted(self.items, reverse=True) for _ in range(len(self.items[n]))]
        total = sum(len(ids) // 4 for ids, _, _ in rest)
        for bit in reversed(range(total.bit_length())):
            room, window = (total >> bit & 1) << bit, []
            while room:
                ids, row, start = rest.pop(0)
                n = min(room, len(ids) // 4)
                window.append((ids[:n * 4], row, start))
                if n * 4 < len(ids):
                    rest.insert(0, (ids[n * 4:], row, start + n))
                room -= n
            if window:
                yield window


class Encoder:
    """Byte-level BPE of a tokenizers file through its ranks; the parts of a text between single spaces are kept per worker.

    The merges of such a file stand in the order of their results' ids, so the ids serve as ranks; a file where they don't
    is refused. Strings of special tokens inside a text are ordinary text.
    """

    def __init__(self, tokenizer_file: str, end_id: int | None):
        import tiktoken

        with open(tokenizer_file, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] or model["type"] != "BPE":
            raise ValueError("only plain byte-level BPE files are supported")
        # a byte that prints stands for itself, the others for the characters from 256 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        special = {t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(map(byte.__getitem__, t)): i for t, i in model["vocab"].items() if i not in special}
        made = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if made != sorted(made):
            raise ValueError("the merges don't stand in the order of their ids")
        self.bpe = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.end = b"" if end_id is None else array("I", [end_id]).tobytes()
        self.parts: dict[str, bytes] = {}
        tab = self.plain("\t")
        self.tab = array("I", tab)[0] if len(tab) == 4 else None

    def plain(self, text: str) -> bytes:
        return array("I", self.bpe.encode_ordinary(text)).tobytes()

    def _learn(self, parts: set[str]) -> None:
        """Ids of each part after a space. They are encoded together, a tab after each: no pre-token joins a character
        and the white space after it, and a tab before a space is a pre-token of its own."""
        new = parts.difference(self.parts)
        if len(self.parts) + len(new) > CACHE_ENTRIES:
            self.parts.clear()
            new = parts
        clean = [p for p in new if p and p.strip() == p and "\t" not in p] if self.tab is not None else []
        for p in new.difference(clean):
            self.parts[p] = self.plain(" " + p)
        if clean:
            ids = np.array(self.bpe.encode_ordinary(" " + "\t ".join(clean) + "\t"), np.uint32)
            raw, at = ids.tobytes(), 0
            for p, tab in zip(clean, (np.flatnonzero(ids == self.tab) * 4).tolist(), strict=True):
                self.parts[p] = raw[at:tab]
                at = tab + 4

    def encode(self, texts: list[str]) -> list[bytes]:
        """All ids and the end id of each text, as little-endian unsigned 32-bit integers."""
        # no pre-token goes from a character into the white space after it
        split = [None if GAP.search(t) else t.split(" ") for t in texts]
        self._learn({p for parts in split if parts for p in parts[1:]})
        return [(self.plain(text) if parts is None else self.plain(parts[0]) + b"".join(map(self.parts.__getitem__, parts[1:]))) + self.end
                for text, parts in zip(texts, split)]


def _encoder(tokenizer_file: str, end_id: int | None) -> Encoder:
    held, key = worker_cache("packing"), (tokenizer_file, end_id)
    if key not in held:
        held[key] = Encoder(tokenizer_file, end_id)
    return held[key]


def pack(docs: DataFrame, tokenizer_file: str, length: int = 2048, end_id: int | None = 1, pool: int = POOL, keep: int = KEEP) -> DataFrame:
    """Pieces of the documents of ``docs(doc_id, text, ...)`` in sequences of at most ``length`` ids (a power of two).

    Returns per piece: ``doc_id, start`` (its document's ids before it), ``length, ids`` (little-endian unsigned 32-bit
    integers), ``doc_tokens`` (all ids of the document, with ``end_id``), ``sequence_id, offset`` (ids before it in its
    sequence). A sequence's pieces come in the order of their offsets. Every sequence is full or, a few at the end of an input
    partition, as long as a power of two. Null texts count as empty and have the end id alone; without an end id they have no
    piece. Rows with repeated or null ids are packed each by itself; other columns aren't read; an empty table has no pieces.
    The partition's number is part of ``sequence_id``, so give a scan or a written table, whose partitions stay the same when
    a task is run again.
    """
    if length < 1 or length & length - 1:
        raise ValueError("length must be a power of two")
    schema = "doc_id " + docs.schema["doc_id"].dataType.simpleString() + \
        ", start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"

    @lean
    def run(batches):
        encoder = _encoder(tokenizer_file, end_id)
        held, out = Pool(length), []
        task = TaskContext.get().partitionId() << 33
        number = 0
        kind = None

        def put(window):
            nonlocal number
            at = 0
            for ids, (doc_id, n), start in window:
                out.append((doc_id, start, len(ids) // 4, ids, n, task + number, at))
                at += len(ids) // 4
            number += 1

        def batch():
            cols = list(zip(*out)) if out else [()] * 7
            types = [kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                              names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
            out.clear()
            return made

        for rows in batches:
            kind = rows.schema.field(0).type
            for at in range(0, rows.num_rows, 200):
                part = rows.slice(at, 200)
                for doc_id, ids in zip(part.column(0).to_pylist(), encoder.encode(part.column(1).to_pylist())):
                    n = len(ids) // 4
                    whole = n - n % length
                    for start in range(0, whole, length):
                        put([(ids[start * 4:(start + length) * 4], (doc_id, n), start)])
                        if len(out) >= EMIT:
                            yield batch()
                    if whole < n:
                        held.add(ids[whole * 4:], (doc_id, n), whole)
                    if held.n >= pool:
                        for window in held.windows(keep):
                            put(window)
                            if len(out) >= EMIT:
                                yield batch()
        if kind is not None:
            for window in held.windows(0):
                put(window)
                if len(out) >= EMIT:
                    yield batch()
            yield batch()

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, schema)
