"""Toxicity: a linear-chain conditional random field tags toxic tokens; its marginals give scores and offsets.

Only documents are labelled, so token labels come first: word and prefix features that are frequent in toxic training
documents and all but absent from clean ones mark the tokens to tag. The field (two states; word, prefix, suffix and
shape features; transitions) is fitted to windows of those tokens by gradient ascent on the conditional likelihood.
Scoring runs forward-backward over every whole text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, worker_cache

MAX_PER_CLASS = 2500  # labelled documents of each class that the field is fitted on, the first by a hash of the id
MAX_CHARS = 24_000_000  # and their characters in all, so that the driver's share stays bounded
DIM = 1 << 20
MASK = DIM - 1
THRESHOLD = 0.3
CACHE_ENTRIES = 200_000
BATCH = 500  # documents whose texts are Python strings at one time
TOGETHER = 2_000_000  # characters of texts whose marginals are computed side by side
EDGE = re.compile(r"^\W+|\W+$")
PLAIN_EDGE = ".,;:!?\"'()[]"  # characters that EDGE takes away too
WORD_MARK, PREFIX_MARK, SUFFIX_MARK = (crc32(x) for x in (b"=", b"^", b"$"))
SHAPES = {(upper, n): crc32(f"#{'u' if upper else 'l'}{n}".encode()) % DIM for upper in (False, True) for n in range(10)}


def features(token: str) -> list[str]:
    """Features of a token: the word, its prefixes and suffix, its shape. No position and nothing of the document."""
    w = EDGE.sub("", token.lower())
    return ["=" + w, *("^" + w[:k] for k in (4, 5, 6)), "$" + w[-3:], "#" + ("u" if token.isupper() else "l") + str(min(len(w), 9))]


def hashed(token: str) -> list[int]:
    """The places of ``features(token)``, their CRC-32 modulo ``DIM``. It goes on from the CRC of each kind's mark, and
    only tokens with other than letters and digits inside or unusual ones at an edge meet the pattern."""
    w = token.lower().strip(PLAIN_EDGE)
    if not w.isalnum():
        w = EDGE.sub("", w)
    shape = SHAPES[token.isupper(), min(len(w), 9)]
    if w.isascii():
        b = w.encode()
        four, five, six, end = b[:4], b[4:5], b[5:6], b[-3:]
    else:
        b, four, five, six, end = (x.encode() for x in (w, w[:4], w[4:5], w[5:6], w[-3:]))
    p4 = crc32(four, PREFIX_MARK)
    p5 = crc32(five, p4)
    return [crc32(b, WORD_MARK) & MASK, p4 & MASK, p5 & MASK, crc32(six, p5) & MASK, crc32(end, SUFFIX_MARK) & MASK, shape]


def distinct_texts(texts: list[str]) -> list[str]:
    """The texts without near copies of earlier ones (the smallest word-trigram hash is equal in at least three of four
    classes, or in all that a short text has), so that copies of one document don't make all its words look frequent."""
    held: dict[tuple[int, int], list[int]] = {}
    known, out = set(), []
    for text in texts:
        t = text.lower().split()
        low: dict[int, int] = {}
        for h in {crc32(" ".join(t[i:i + 3]).encode()) for i in range(max(1, len(t) - 2))}:
            low[h % 4] = min(h, low.get(h % 4, h))
        mine = tuple(sorted(low.items()))
        if mine in known:
            continue
        agree = Counter(i for k in mine for i in held.get(k, ()))
        if max(agree.values(), default=0) < min(3, len(mine)):
            out.append(text)
        for k in mine:
            held.setdefault(k, []).append(len(known))
        known.add(mine)
    return out


def kinds(token: str) -> list[str]:
    """The features of a token that may mark it: its word and its prefixes."""
    return [f for f in features(token) if f[0] in "=^" and len(f) > 4]


def document_counts(documents: Iterable[set[str]]) -> tuple[Counter, int]:
    """In how many documents each feature occurs, and the number of documents. One document's features are held at a time."""
    counts, n = Counter(), 0
    for found in documents:
        counts.update(found)
        n += 1
    return counts, n


def marks(toxic: Iterable[set[str]], clean: Iterable[set[str]], share: float = 0.02, count: int = 5, false_share: float = 0.01) -> set[str]:
    """Features that mark toxic tokens: all but absent from clean documents, and either in at least ``share`` of the
    toxic ones or in at least ``count`` with a significant excess over the clean ones (binomial tail;
    Benjamini-Hochberg over all features of at least ``count`` documents, ``false_share`` of the found ones false)."""
    (nt, n_toxic), (nc, n_clean) = document_counts(toxic), document_counts(clean)
    scale = n_toxic / max(1, n_clean)
    rare = {f: n for f, n in nt.items() if n >= 3 and nc[f] * scale <= 0.02 * n}
    found = {f for f, n in rare.items() if n >= share * n_toxic}
    p = n_toxic / max(1, n_toxic + n_clean)
    # the chance of at most nc[f] clean documents among those that hold the feature, if it had nothing to do with the label
    tail = sorted((sum(math.comb(n + nc[f], k) * (1 - p) ** k * p ** (n + nc[f] - k) for k in range(nc[f] + 1)), f) for f, n in rare.items() if n >= count)
    tests = sum(n + nc[f] >= count for f, n in nt.items()) + sum(n >= count for f, n in nc.items() if f not in nt)
    last = max((i for i, (chance, _) in enumerate(tail, 1) if chance <= false_share * i / tests), default=0)
    return found | {f for _, f in tail[:last]}


def fit(toxic: list[str], clean: list[str], window: int = 5, epochs: int = 30, windows: int = 16_000, l2: float = 1e-5, seed: int = 7) -> dict:
    """Weights of the field: ``w`` (feature weights of the toxic state), ``a`` (log-potentials of the transitions)."""
    rng = np.random.default_rng(seed)
    toxic, clean = distinct_texts(toxic), distinct_texts(clean)
    found = marks(*(({f for t in set(d.split()) for f in kinds(t)} for d in texts) for texts in (toxic, clean)))
    if not found:
        return {"w": np.zeros(DIM), "bias": -12.0, "a": np.zeros((2, 2))}
    hit = {t for texts in (toxic, clean) for d in texts for t in set(d.split()) if not found.isdisjoint(kinds(t))}
    length, x, y = 2 * window + 1, [], []

    def take(tokens, at):
        part = tokens[max(0, at - window):at + window + 1]
        x.append(part + [None] * (length - len(part)))
        y.append([t in hit for t in part] + [False] * (length - len(part)))

    for d in toxic:
        tokens = d.split()
        places = [i for i, t in enumerate(tokens) if t in hit]
        for i in rng.permutation(places)[:3]:
            take(tokens, int(i))
    for d in [*clean, *toxic]:
        if tokens := d.split():
            for i in rng.integers(0, len(tokens), max(3, windows // (len(clean) + len(toxic)))):
                take(tokens, int(i))
    width = len(features("x"))
    ids = {t: hashed(t) for row in x for t in row if t is not None}
    fx = np.array([[ids[t] if t is not None else [DIM] * width for t in row] for row in x])  # windows, length, features
    mask = np.array([[t is not None for t in row] for row in x])
    gold = np.array(y)
    w, bias, a = np.zeros(DIM + 1), -3.0, np.zeros((2, 2))
    g2w, g2b, g2a = np.full(DIM + 1, 1e-6), 1e-6, np.full((2, 2), 1e-6)
    for _ in range(epochs):
        order = rng.permutation(len(fx))
        for rows in np.array_split(order, max(1, len(order) // 4000)):
            f, m, g = fx[rows], mask[rows], gold[rows]
            score = np.where(m, w[f].sum(2) + bias, -30.0)
            p, pair = posterior(score, a)
            diff = np.where(m, g - p, 0.0)
            gw = np.bincount(f.ravel(), np.repeat(diff.ravel(), width), DIM + 1) / len(rows) - l2 * w
            gb = diff.sum() / len(rows)
            real = m[:, 1:] & m[:, :-1]
            seen_pair = np.stack([[((g[:, :-1] == i) & (g[:, 1:] == j) & real).sum() for j in (0, 1)] for i in (0, 1)])
            ga = (seen_pair - (pair * real[:, :, None, None]).sum((0, 1))) / len(rows) - l2 * a
            for grad, total in ((gw, g2w), (ga, g2a)):
                total += grad * grad
            g2b += gb * gb
            w += 0.5 * gw / np.sqrt(g2w)
            w[DIM] = 0
            a += 0.1 * ga / np.sqrt(g2a)
            bias += 0.1 * gb / math.sqrt(g2b)
    return {"w": w[:DIM], "bias": float(bias), "a": a}


def posterior(score: np.ndarray, a: np.ndarray):
    """Marginals of the toxic state (rows x length) and of adjacent state pairs, by forward-backward."""
    n, length = score.shape
    t = np.exp(a)
    e = np.stack([np.ones_like(score), np.exp(np.clip(score, -30, 30))], 2)
    fwd, bwd = np.empty((n, length, 2)), np.empty((n, length, 2))
    v = e[:, 0]
    for i in range(length):
        if i:
            v = (v @ t) * e[:, i]
        v = v / v.sum(1, keepdims=True)
        fwd[:, i] = v
    v = np.full((n, 2), 0.5)
    bwd[:, -1] = v
    for i in range(length - 2, -1, -1):
        v = (e[:, i + 1] * v) @ t.T
        v = v / v.sum(1, keepdims=True)
        bwd[:, i] = v
    both = fwd * bwd
    pair = fwd[:, :-1, :, None] * t * (e[:, 1:] * bwd[:, 1:])[:, :, None, :]
    return both[:, :, 1] / both.sum(2), pair / pair.sum((2, 3), keepdims=True)


class Tagger:
    """The fitted field over whole texts; the odds of distinct tokens are kept per worker."""

    def __init__(self, model: dict):
        self.weights, self.bias = model["w"], model["bias"]
        self.t = np.exp(model["a"])
        # how far a state shifts the odds of later ones shrinks by at least this factor a token
        (a00, a01), (a10, a11) = model["a"]
        shrink = min(max(1e-9, math.tanh(abs(a00 + a11 - a01 - a10) / 4)), 1 - 1e-9)
        self.warm_up = 2 + math.ceil(math.log(1e-17) / math.log(shrink))
        self.odds: dict[str, float] = {}

    def look_up(self, texts: Iterable[list[str]]) -> None:
        """Take the odds of all tokens of the texts into the cache, the new ones together."""
        wanted = set().union(*texts)
        new = [t for t in wanted if t not in self.odds]
        if len(self.odds) + len(new) > CACHE_ENTRIES:
            self.odds.clear()
            new = list(wanted)
        for at in range(0, len(new), CACHE_ENTRIES):
            part = new[at:at + CACHE_ENTRIES]
            places = np.fromiter(chain.from_iterable(map(hashed, part)), np.int64).reshape(len(part), -1)
            score = self.weights[places].sum(1) + self.bias
            self.odds.update(zip(part, np.exp(np.clip(score, -30.0, 30.0)).tolist()))

    def lanes(self, values: np.ndarray, breaks: np.ndarray, step) -> np.ndarray:
        """``x[i] = step(values[i - 1], values[i], x[i - 1])``, and ``step`` without an ``x`` at breaks. The row is cut
        into pieces that advance side by side, each from ``warm_up`` tokens before it, by when its start has no say."""
        n = len(values)
        length = min(n, max(64, 4 * self.warm_up, math.isqrt(n)))
        pieces = -(-n // length)
        before = self.warm_up if pieces > 1 else 0
        pad = (before, pieces * length - n)
        v, cut = (np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(np.pad(x, pad, constant_values=1), before + length)[::length].T)
                  for x in (values, breaks))
        x, out = None, np.empty((length, pieces))
        for i in range(before + length):
            alone = step(None, v[i], None)
            x = alone if x is None else np.where(cut[i], alone, step(v[i - 1], v[i], x))
            if i >= before:
                out[i - before] = x
        return out.T.ravel()[:n]

    def all_marginals(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Marginals of the toxic state of all tokens of the texts, none of them empty, one after the other, and where each starts."""
        ends = np.cumsum([len(t) for t in texts])
        starts = np.r_[0, ends[:-1]]
        e = np.fromiter(map(self.odds.__getitem__, chain.from_iterable(texts)), float, int(ends[-1]))
        first, last = np.zeros(len(e), bool), np.zeros(len(e), bool)
        first[starts] = last[ends - 1] = True
        (t00, t01), (t10, t11) = self.t
        # odds of the toxic state from what stands to the left, own token included; and from what stands to the right
        left = self.lanes(e, first, lambda _, e, x: e if x is None else e * (t01 + t11 * x) / (t00 + t10 * x))

        def back(later, e, x):
            return np.ones_like(e) if x is None else (t10 + t11 * later * x) / (t00 + t01 * later * x)

        o = left * self.lanes(e[::-1], last[::-1], back)[::-1]
        return o / (1 + o), starts

    def marginals(self, tokens: list[str]) -> np.ndarray:
        return self.all_marginals([tokens])[0]

    def scores(self, texts: list[str | None], floor: float = 0.1) -> list[tuple[float, list]]:
        """Per text its score and the toxic spans ``(start, end, marginal)`` in characters: adjacent tokens of at least
        ``floor``. The score is the chance that one of the spans is toxic; without a span, the largest marginal."""
        out, at, held = [], 0, 0
        for i, t in enumerate(texts):  # texts of bounded length together; a longer one by itself
            if held and held + len(t or "") > TOGETHER:
                out += self._scores(texts[at:i], floor)
                at, held = i, 0
            held += len(t or "")
        return out + self._scores(texts[at:], floor)

    def _scores(self, texts: list[str | None], floor: float) -> list[tuple[float, list]]:
        tokens = [(t or "").split() for t in texts]
        self.look_up(tokens)
        out: list[tuple[float, list]] = [(0.0, [])] * len(texts)
        filled = [i for i, t in enumerate(tokens) if t]
        if filled:
            p, starts = self.all_marginals([tokens[i] for i in filled])
            for i, at, top in zip(filled, starts.tolist(), np.maximum.reduceat(p, starts).tolist()):
                spans = self.spans(texts[i], tokens[i], p[at:at + len(tokens[i])], floor) if top >= floor else []
                out[i] = (1 - math.prod(1 - s[2] for s in spans) if spans else top), spans
        return out

    @staticmethod
    def spans(text: str, tokens: list[str], p: np.ndarray, floor: float) -> list[tuple[int, int, float]]:
        spans, ends = [], [m.span() for m in re.finditer(r"\S+", text)]
        if len(ends) != len(tokens):  # control characters that split() counts as space
            ends, at = [], 0
            for t in tokens:
                at = text.index(t, at)
                ends.append((at, at + len(t)))
                at += len(t)
        for i in np.flatnonzero(p >= floor).tolist():
            if spans and spans[-1][3] == i - 1:
                s = spans[-1]
                spans[-1] = (s[0], ends[i][1], max(s[2], float(p[i])), i)
            else:
                spans.append((*ends[i], float(p[i]), i))
        return [s[:3] for s in spans]


def train(docs: DataFrame, labels: DataFrame, max_per_class: int = MAX_PER_CLASS, max_chars: int = MAX_CHARS) -> dict:
    """Fit the field on labelled documents: ``labels(doc_id, toxic)``, rows with a null of either are left out.

    At most ``max_per_class`` labelled documents of each class, the first by a hash of the id, and of those as many as
    ``max_chars`` characters allow in that order (a text is taken whole or not at all). Without both classes the
    model scores everything near 0.
    """
    lab = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    first = [lab.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_per_class) for c in (0, 1)]
    chosen = first[0].unionByName(first[1])
    # at most 2 * max_per_class ids: a proven bound
    sample = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    texts: tuple[list, list] = ([], [])
    left = [max_chars // 2] * 2
    for r in sample.orderBy(F.length("text") > max_chars // 50, F.xxhash64("doc_id"), "doc_id").toLocalIterator():
        if len(r.text) <= left[r.toxic]:
            left[r.toxic] -= len(r.text)
            texts[r.toxic].append(r.text)
    return fit(texts[1], texts[0])


def score_toxicity(docs: DataFrame, model: dict, keep: list[str] | None = None, spans: bool = True, threshold: float = THRESHOLD,
                   prefix: str = "") -> DataFrame:
    """Per row of ``docs``: the columns in ``keep`` (default ``doc_id``), ``score`` (0 to 1), ``predicted`` (1 from
    ``threshold`` on) and, with ``spans``, the offending ``spans`` (start, end in characters, marginal). Null and blank
    texts score 0. ``prefix`` goes before the new names, where ``keep`` has columns of those names."""
    keep = ["doc_id"] if keep is None else keep
    src = docs.select(*keep) if "text" in keep else docs.select(*keep, "text")
    text_at = src.columns.index("text")
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema[:len(keep)]] + [f"{prefix}score double", f"{prefix}predicted int"]
    schema += [f"{prefix}spans array<struct<start:int,stop:int,marginal:double>>"] * spans
    key = f"toxicity-{crc32(model['w'].tobytes() + model['a'].tobytes())}-{model['bias']}"
    shared = src.sparkSession.sparkContext.broadcast(model)  # DIM doubles: a fixed size

    @lean
    def run(batches):
        held = worker_cache("toxicity")
        if key not in held:
            held.clear()
            held[key] = Tagger(shared.value)
        tagger = held[key]
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                out = tagger.scores(part.column(text_at).to_pylist())
                cols = [part.column(i) for i in range(len(keep))]
                cols += [pa.array([s for s, _ in out], pa.float64()), pa.array([int(s >= threshold) for s, _ in out], pa.int32())]
                if spans:
                    cols.append(pa.array([[{"start": a, "stop": b, "marginal": p} for a, b, p in sp] for _, sp in out],
                                         pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("marginal", pa.float64())]))))
                yield pa.RecordBatch.from_arrays(cols, names=[*keep, f"{prefix}score", f"{prefix}predicted", *[f"{prefix}spans"] * spans])

    return src.mapInArrow(run, ", ".join(schema))
