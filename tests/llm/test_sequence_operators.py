"""Periodic runs, packing and the prefix trie against brute force and the library, and on awkward rows."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

from statsweep.llm import packing, prefix_trie, run_detection
from statsweep.llm.catalog import BYTES, QUERIES, repeat_words

from test_operators import LONG, ROWS, SF, documents, empty, table

TOKENIZER = public_tokenizers.path(BYTES)


# --- runs -----------------------------------------------------------------------------------------------------------

def brute_runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q) and j > i:
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_collapse(words, runs):
    return [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]


def periodic_texts(seed, rounds):
    rng = random.Random(seed)
    for _ in range(rounds):
        n, k = rng.choice([0, 1, 5, 6, 7, 12, 40, 150]), rng.choice([1, 2, 3, 20])
        words = [b"%d" % rng.randrange(k) for _ in range(n)]
        if n > 10 and rng.random() < 0.6:
            p, a = rng.randint(1, n // 4), rng.randrange(n // 2)
            words = words[:a] + [words[a + i % p] for i in range(n - a)]
        yield words


def test_runs_equal_brute_force():
    texts = list(periodic_texts(3, 900))
    for at in range(0, len(texts), 7):
        some = texts[at:at + 7]
        for words, runs in zip(some, run_detection.block_runs(some)):
            want = brute_runs(words)
            assert [tuple(r) for r in runs.tolist()] == want
            assert run_detection.collapse(words, runs) == brute_collapse(words, want)


def test_extensions_equal_comparison():
    rng = np.random.default_rng(5)
    for k in (1, 2, 3, 50):
        body = np.tile(rng.integers(0, k, rng.integers(1, 40)), 12)[:300]
        s = np.concatenate([[90], body, rng.integers(0, k, 100), [91]])
        g = run_detection.Grammar(s)
        i, j = np.sort(np.array([rng.choice(np.arange(1, len(s)), 2, replace=False) for _ in range(500)]), axis=1).T
        for a, b, fwd, bwd in zip(i, j, g.extend(i, j), g.extend(i, j, back=True)):
            n = next(n for n in range(len(s)) if s[a + n] != s[b + n])
            m = next(m for m in range(len(s)) if s[a - 1 - m] != s[b - 1 - m])
            assert (fwd, bwd) == (n, m)


def test_runs_query(spark):
    texts = [b" ".join(w).decode() for w in periodic_texts(8, 150)]
    rows = ROWS + [(50, "a " * 30_000), (51, "la la la la la la\nx y x y x y x y"), (51, "la la la la la la\nx y x y x y x y")]
    rows += [(100 + i, t) for i, t in enumerate(texts)] + [(5000 + d, t) for d, t in documents()[:40]]
    got = defaultdict(list)
    for r in run_detection.detect_runs(table(spark, rows), repeat_words, block_words=500).collect():
        got[r.doc_id].append((r.n_words, [tuple(x) for x in r.runs], r.collapsed))
    changed = 0
    for d, t in rows:
        plain = (t or "").encode().split()
        words = repeat_words(d, plain)
        changed += words != plain
        runs = brute_runs(words) if len(words) < 3000 else [tuple(r) for r in run_detection.block_runs([words])[0].tolist()]
        assert (len(words), runs, b" ".join(brute_collapse(words, runs) if len(runs) < 5 and len(words) < 40_000 else run_detection.collapse(words, np.array(runs))).decode()) in got[d]
    assert changed > 5 and got[50][0][1] == [(0, 30_000, 1)] and sum(map(len, got.values())) == len(rows)
    assert run_detection.detect_runs(empty(spark)).count() == 0


def test_op11_digests(spark):
    got = {r.doc_id: r for r in QUERIES["op11_run_detection"](spark, SF).collect()}
    hits = 0
    for d, t in documents():
        words = repeat_words(d, (t or "").encode().split())
        if len(words) > 1500:
            continue
        runs = brute_runs(words)
        r = got[d]
        top = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None,) * 3)
        lines = "".join("%d,%d,%d\n" % x for x in runs)
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *top)
        assert r.exponent_milli == (1000 * top[1] // top[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(b" ".join(brute_collapse(words, runs))).hexdigest()
        hits += bool(runs)
    assert hits > 3


def test_repeat_words_is_the_stated_rule():
    for d in range(300):
        words = [b"%d" % i for i in range(d % 37)]
        h, n = zlib.crc32(b"%d" % d), d % 37
        want = list(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            for i in range(a, n):
                want[i] = words[a + (i - a) % p]
        assert repeat_words(d, words) == want


# --- packing --------------------------------------------------------------------------------------------------------

def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(TOKENIZER)
    t.encode_special_tokens = True
    return t


def check_packing(rows, pieces, length=2048, end=(1,)):
    ids = {i: [*e.ids, *end] for i, e in enumerate(library().encode_batch([t or "" for _, t in rows], add_special_tokens=False))}
    left = defaultdict(int)
    for i, (d, _) in enumerate(rows):
        left[d, tuple(ids[i])] += 1
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p.length == len(p.ids) // 4 > 0
        by_doc[p.doc_id].append(p)
        by_seq[p.sequence_id].append(p)
    for d, part in by_doc.items():
        texts = [k for k in left if k[0] == d for _ in range(left[k])]
        assert sum(p.length for p in part) == sum(len(t) for _, t in texts)
        for p in part:
            assert any(p.doc_tokens == len(t) and list(t[p.start:p.start + p.length]) == np.frombuffer(p.ids, "<u4").tolist() for _, t in texts)
        assert sorted(i for p in part for i in range(p.start, p.start + p.length)) == sorted(i for _, t in texts for i in range(len(t)))
    assert set(by_doc) == {d for d, t in left if t}
    totals = []
    for part in by_seq.values():
        at = 0
        for p in sorted(part, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        totals.append(at)
    assert all(t <= length and (t == length or t & t - 1 == 0) for t in totals)
    return totals


def test_packing(spark):
    odd = ["a  b   c", " lead", "trail ", "trail  ", "a \n b", "\n\n  x", "it's we'll 'd", "<|endoftext|> x", "é è   x", "日本語 テキスト", " ", "  ", "\t \t", "a\x1c b", " \x1c "]
    rows = ROWS + [(300 + i, t) for i, t in enumerate(odd)] + [(400 + d, t) for d, t in documents()]
    check_packing(rows, packing.pack(table(spark, rows), TOKENIZER).collect())
    small = check_packing(rows, packing.pack(table(spark, rows).coalesce(1), TOKENIZER, length=64, pool=40, keep=5).collect(), 64)
    assert sum(t < 64 for t in small) <= 6  # what is left at the end of the one partition
    some = [r for r in rows if r[1]]
    check_packing(some, packing.pack(table(spark, some), TOKENIZER, end_id=None).collect(), end=())
    assert packing.pack(empty(spark), TOKENIZER).count() == 0
    assert packing.pack(table(spark, [(1, None), (1, "")]), TOKENIZER, end_id=None).count() == 0
    with pytest.raises(ValueError):
        packing.pack(empty(spark), TOKENIZER, length=100)


def test_packing_of_copies(spark):
    """Remainders of one length can't fill a window by themselves: one copy in some windows is cut."""
    rows = [(i, " ".join(["word"] * 1499)) for i in range(300)]
    totals = check_packing(rows, packing.pack(table(spark, rows).coalesce(1), TOKENIZER, pool=100, keep=20).collect())
    assert sum(t < 2048 for t in totals) <= 11


@pytest.mark.parametrize("seed", range(4))
def test_fill_is_the_closest_multiset(seed):
    rng = random.Random(seed)
    for _ in range(200):
        lengths = sorted(((n, rng.randint(0, 4)) for n in rng.sample(range(1, 30), rng.randint(0, 6))), reverse=True)
        room = rng.randint(0, 60)
        sums = {0}
        for n, c in lengths:
            sums = {s + n * k for s in sums for k in range(c + 1)}
        got = packing.fill(lengths, room)
        assert sum(n * k for n, k in got.items()) == max(s for s in sums if s <= room)
        assert all(k <= dict(lengths)[n] for n, k in got.items())


def test_long_texts_pack_in_linear_memory():
    encoder = packing.Encoder(TOKENIZER, 1)
    for text in ("x" * 200_000, " " * 200_000, "word " * 200_000, LONG):
        assert encoder.encode([text]) == [encoder.plain(text) + encoder.end]


# --- prefix trie ----------------------------------------------------------------------------------------------------

def brute_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn, role or "", text or ""))
    own = {c: [(r, x) for *_, r, x in sorted(t, key=lambda t: (t[0], t[1] or 0, t[2], hashlib.sha256(f"{len(t[2])}:{t[2]}{t[3]}".encode()).digest()))] for c, t in own.items()}
    seqs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        seqs[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p, cs in members.items():
        cost = (len(cs) - 1) * len(p[-1][1].encode().split()) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += cost
            leaves[p[:d]] += not kids[p]
    return sorted((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), kids[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(c for c in cs if len(seqs[c]) == len(p)))).encode()).hexdigest()) for p, cs in members.items())


def build_trie(spark, rows):
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "conv_id bigint, turn bigint, role string, text string, depth int, key string")
    out = prefix_trie.prefix_trie(*prefix_trie.graft_heads(prefix_trie.order_turns(df)))
    return sorted((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in out.collect())


def test_trie(spark):
    rng = random.Random(2)
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["a b", "c", "", None, "d e f"])) for c in range(130) if c not in (40, 41) for t in range(rng.randint(1, 5))]
    rows += [(c, t, "user", f"w{t} x") for c in (300, 301, 302) for t in range(37 + c % 3)]  # long and shared
    rows += [(7, None, "system", "first"), (8, None, "user", "x"), (8, None, "user", "x"), (None, 0, "user", "no id"), (-25, 0, "user", "minus"), (9, 2, "b", "tie"), (9, 2, "a", "tie")]
    assert build_trie(spark, rows) == brute_trie(rows)


def test_trie_of_copies_and_few_rows(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BUCKET_BITS", 3)
    monkeypatch.setattr(prefix_trie, "HOT_SHARE", 4)
    rows = [(c, t, "user", f"same {t}") for c in range(0, 2000, 20) for t in range(3)] + [(c, 0, "user", f"own {c}") for c in range(5000, 5200, 20)]
    assert build_trie(spark, rows) == brute_trie(rows)
    turnless = next(c for c in range(1, 99) if c % 20 and zlib.crc32(str(c).encode()) % 4)
    assert build_trie(spark, [(turnless, 0, "user", "x")]) == brute_trie([(turnless, 0, "user", "x")]) and build_trie(spark, []) == []
    assert build_trie(spark, [(20, 0, None, None)]) == brute_trie([(20, 0, None, None)])
