"""License scan: base phrases, and an exact set-similarity join of word windows with license templates.

A block is a window of consecutive words, whatever line breaks and comment marks stand between them; for a template of
n words it has 2n words, and every placement counts. A template's label belongs to a document if some window holds at
least ``threshold`` of the template's distinct tokens. Template tokens are ordered by their count over all documents,
rarest first. A window that meets the threshold must hold one of a template's first ``|T| - need + 1`` tokens (prefix
filter), the document must have ``need`` words (length filter), and enough template tokens must be left after the first
hit (positional filter). Only words within a window's reach of a hit are looked at, each once per template.
"""

from __future__ import annotations

import math
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# bytes of words: digits, a-z, A-Z (lower-cased) and everything outside ASCII; all other bytes become a space
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

# opening sentences of public license notices: (label, text)
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by-sa", "Licensed under the Creative Commons Attribution ShareAlike license"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)
THRESHOLD = 0.9
SPAN = 2  # words of a window for each word of the template


def words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) runs of digits, letters and characters outside ASCII, as UTF-8."""
    return (text or "").encode().translate(FOLD).split()


def token_counts(docs: DataFrame, vocabulary: list[bytes]) -> dict[bytes, int]:
    """How often each of the given tokens occurs over all documents. Summed in each batch before the shuffle."""
    vocab = frozenset(vocabulary)

    def count(batches):
        for batch in batches:
            n = dict.fromkeys(vocab, 0)
            for t in batch.column(0).to_pylist():
                for w in filter(vocab.__contains__, words(t)):
                    n[w] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(n)), pa.array(list(n.values()), pa.int64())], names=["w", "n"])

    rows = docs.select("text").mapInArrow(count, "w binary, n bigint").groupBy("w").agg(F.sum("n").alias("n")).collect()
    return dict.fromkeys(vocab, 0) | {bytes(r.w): r.n for r in rows}  # as many rows as the templates have tokens


class Index:
    """Prefix index over the templates, in the global token order."""

    def __init__(self, templates, counts: dict[bytes, int], threshold: float):
        self.sets, self.need, self.label, self.span, self.prefix = [], [], [], [], {}
        for label, text in templates:
            ws = words(text)
            tokens = sorted(set(ws), key=lambda w: (counts[w], w))
            if not tokens:
                continue
            need = max(1, math.ceil(threshold * len(tokens) - 1e-9))
            for pos, w in enumerate(tokens[:len(tokens) - need + 1]):
                self.prefix.setdefault(w, []).append((len(self.sets), pos))
            self.sets.append(tokens)
            self.need.append(need)
            self.label.append(label)
            self.span.append(SPAN * len(ws))
        self.keys = frozenset(self.prefix)

    def _reaches(self, t: int, hits):
        """(first word, end, smallest position in the global order) of the words within a window's reach of prefix hits."""
        start = end = first = None
        for i, pos in hits:
            lo, hi = i - self.span[t] + 1, i + self.span[t]
            if start is not None and lo <= end:
                end, first = hi, min(first, pos)
                continue
            if start is not None:
                yield start, end, first
            start, end, first = max(lo, 0), hi, pos
        yield start, end, first

    def match(self, ws: list[bytes]):
        """(label, containment) of every template that some window of the words meets; the largest containment."""
        hits: dict[int, list] = {}
        for i, w in enumerate(ws):
            if w in self.keys:
                for t, pos in self.prefix[w]:
                    hits.setdefault(t, []).append((i, pos))
        for t, places in hits.items():
            tokens, need, span, best = self.sets[t], self.need[t], self.span[t], 0
            if len(ws) < need:
                continue
            for start, end, first in self._reaches(t, places):
                if len(tokens) - first < need:
                    continue
                # a token is held by the window that ends here while its last place is inside
                last = dict.fromkeys(tokens[first:], -1)
                recent: deque[tuple[int, bytes]] = deque()
                held = 0
                for i in range(start, min(end, len(ws))):
                    while recent and recent[0][0] <= i - span:
                        at, w = recent.popleft()
                        held -= last[w] == at
                    w = ws[i]
                    if w in last:
                        held += last[w] < max(start, i - span + 1)
                        last[w] = i
                        recent.append((i, w))
                        best = max(best, held)
                if best == len(tokens):
                    break
            if best >= need:
                yield self.label[t], best / len(tokens)


def scan_licenses(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs(doc_id, text, ...)``: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``n_base``: all places where a phrase's words stand consecutively; ``first_word``, ``last_word``: their smallest
    and largest start (words from 0), null without one. ``labels``: the phrases' and the templates', distinct, sorted,
    comma-joined; empty strings where there is none. ``score``: 1 for a phrase, else the largest containment that met
    the threshold, else 0. A null text counts as empty. Rows with a repeated or null ``doc_id`` keep their own row.
    """
    vocab = sorted({w for _, t in templates for w in words(t)})
    index = Index(templates, token_counts(docs, vocab), threshold)
    # needles stand between single spaces; a cheap test on the folded text decides if a document is looked at closely
    needles = [(b" " + b" ".join(words(p)) + b" ", label) for p, label in phrases]

    def run(batches):
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                ws = words(text)
                n_places, first, last, base, labels, score = 0, None, None, set(), set(), 0.0
                joined = b" " + b" ".join(ws) + b" "
                for needle, label in needles:
                    at, seen, word = joined.find(needle), 0, 0
                    while at >= 0:
                        word += joined.count(b" ", seen, at)  # the words between this place and the one before
                        n_places, seen = n_places + 1, at
                        first, last = min(word, first if first is not None else word), max(word, last or 0)
                        base.add(label)
                        at = joined.find(needle, at + 1)
                if not index.keys.isdisjoint(ws):
                    for label, share in index.match(ws):
                        labels.add(label)
                        score = max(score, share)
                out.append((len(ws), n_places, first, last, ",".join(sorted(base)),
                            ",".join(sorted(base | labels)), 1.0 if base else score))
            n = list(zip(*out)) if out else [()] * 7
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(list(v), t) for v, t in zip(n, types))],
                                             names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        run, "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double")
