"""Training-data operators against brute force, round trips, held-out accuracy, and on awkward rows."""

import gzip
import hashlib
import os
import re
import struct
import sys
import textwrap
import zlib
from collections import defaultdict
from html import unescape
from types import SimpleNamespace

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from statsweep.llm import block_dedup, decontaminate, html_text, license_scan, ngram_join, quality, sentencepiece_bpe, toxicity, url_filter, warc
from statsweep.llm.catalog import ORACLE, QUERIES, responses

SF = os.environ.get("STATSWEEP_TEST_SF", "/root/testdata/sf0.001")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
BASE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"
LONG = " ".join(f"w{i}" for i in range(30_000))

# nulls, empty and blank texts, ties, repeated rows, a very long text, one word, odd characters
ROWS = [(1, None), (2, ""), (3, " \t\n"), (4, "word"), (5, "word"), (6, "A b\tC"), (6, "A b\tC"), (None, "a b c"), (None, None), (7, "a  b \n c"),
        (8, BASE), (9, BASE + " more"), (10, BASE.upper()), (11, LONG), (12, LONG + " tail"), (13, "x" * 50_000), (14, "  lead  and trail  "),
        (15, "é ü ﬁ 𝔘 \x00 ▁ ▁▁ end"), (16, "Released under the MIT License. cc by nc cc by nc"), (17, "\n\n  \n")]


def table(spark, rows=ROWS):
    """Rows with extra columns whose names clash with what the operators add."""
    return spark.createDataFrame([(i, t, "en", 0.5, 7, "z") for i, t in rows], "doc_id bigint, text string, lang string, score double, n int, kept string")


def empty(spark):
    return table(spark).where("false")


def words(text):
    return (text or "").encode().lower().split()


def documents():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()


def shingle_set(text, n):
    w = words(text)
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute_components(rows, n, link):
    """Smallest id reachable by links, over all pairs of rows."""
    sets, root = [shingle_set(t, n) for _, t in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= link * len(a | b):
                root[find(i)] = find(j)
    low = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        low[find(i)].append(d)
    name = {r: min((d for d in ds if d is not None), default=None) for r, ds in low.items()}
    return sorted(((d, len(s), name[find(i)] if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


@pytest.mark.parametrize("n,link", [(4, 85), (5, 80)])
def test_ngram_join(spark, n, link):
    near = [(100 + k, " ".join(w if j % 97 != k else f"edit{k}" for j, w in enumerate((BASE + " ").split() * 1 + [f"v{i}" for i in range(150)]))) for k in range(40)]
    for rows in (ROWS + near, documents()):
        got = sorted((tuple(r) for r in ngram_join.jaccard_components(table(spark, rows), n, link).collect()), key=str)
        assert got == brute_components(rows, n, link)
    assert ngram_join.jaccard_components(empty(spark)).count() == 0


def test_ngram_join_tiles(spark, monkeypatch):
    """Small tiles, fragments and buckets give the same links."""
    monkeypatch.setattr(ngram_join, "TILE", 3)
    monkeypatch.setattr(ngram_join, "BUCKET_TOKENS", 50)
    base = [f"b{i}" for i in range(60)]
    rows = [(k, " ".join(f"e{k}x{j}" if (j * 7 + k * 11) % 61 < 1 + k % 4 else w for j, w in enumerate(base))) for k in range(60)]
    got = sorted((tuple(r) for r in ngram_join.jaccard_components(table(spark, rows), 4, 60).collect()), key=str)
    assert got == brute_components(rows, 4, 60)


class Recorder:
    """Stands for a DataFrame and its session; keeps the functions of ``ngram_join._shared``."""

    def __init__(self):
        self.sparkSession = self.sparkContext = self

    def broadcast(self, value):
        return SimpleNamespace(value=value)

    def select(self, *_):
        return self

    groupBy = select

    def mapInArrow(self, fn, _):
        self.send = fn
        return self

    def applyInArrow(self, fn, _):
        self.count = fn
        return self


def calls(fn, *args):
    """Functions that ``fn`` calls, and what it returns."""
    seen = [0]

    def note(_, event, __):
        seen[0] += event in ("call", "c_call")

    sys.setprofile(note)
    try:
        out = fn(*args)
    finally:
        sys.setprofile(None)
    return seen[0], out


def test_ngram_join_work_of_a_bucket():
    """The steps of a batch don't grow with the buckets it goes to, nor those of a bucket with the parts that it goes to."""
    texts = [" ".join(f"w{k}x{j}" for j in range(60)) + (" more" if twin else "") for k in range(400) for twin in (0, 1)]
    sent, size = {}, {}
    for buckets in (16, 512):
        to = Recorder()
        ngram_join._shared(to, 4, 0, buckets, np.zeros(0, np.uint64))
        batch = pa.record_batch({"text": texts})
        list(to.send(iter([batch])))  # fills the cache of words
        size[buckets], out = calls(lambda: list(to.send(iter([batch]))))
        sent[buckets] = to, pa.Table.from_batches(out)
    assert size[512] < 1.2 * size[16]
    to, whole = sent[16]
    few = pa.Table.from_batches(list(to.send(iter([pa.record_batch({"text": texts[:4]})]))))
    for b in range(16):
        groups = [t.filter(pc.equal(t.column("bucket"), b)) for t in (few, whole)]
        (low, small), (high, large) = (calls(to.count, g) for g in groups)
        assert small.num_rows <= 4 and large.num_rows == 64 and high < 2 * low


def test_ngram_join_hubs_link_near_copies(spark, monkeypatch):
    """In a family of near copies the hubs find all links, whichever class has the smallest name, and none is left for the tiles."""
    saved, save = {}, ngram_join.save
    monkeypatch.setattr(ngram_join, "save", lambda df, name: saved.setdefault(name, save(df, name)))
    monkeypatch.setattr(ngram_join, "TILE", 16)
    base = [f"b{i}" for i in range(300)]
    rows = [(k, " ".join(f"e{k}x{j}" if (j * 7 + k * 11) % 301 < k % 13 else w for j, w in enumerate(base))) for k in range(150)]
    got = sorted((tuple(r) for r in ngram_join.jaccard_components(table(spark, rows)).collect()), key=str)
    assert got == brute_components(rows, 4, 85)
    assert 1 < len({c for *_, c in got}) < 150 and saved["hub-links"].count() and not saved["tile-links"].count()


def test_ngram_join_links_without_hub(spark, monkeypatch):
    """Sets that are linked, while the hub of all that they share is linked with neither."""
    saved, save = {}, ngram_join.save
    monkeypatch.setattr(ngram_join, "save", lambda df, name: saved.setdefault(name, save(df, name)))
    monkeypatch.setattr(ngram_join, "TILE", 2)
    whole = [f"b{i}" for i in range(103)]
    part = [[f"e{k}" if j == at else w for j, w in enumerate(whole[:75])] for k, at in enumerate((10, 30, 50))]
    rest = [[*whole[72:], f"x{k}"] for k in range(6)]  # makes the end of ``whole`` more frequent than its beginning
    rows = [(k, " ".join(w)) for k, w in enumerate([whole, [*whole, "more"], *part, *rest])]
    got = sorted((tuple(r) for r in ngram_join.jaccard_components(table(spark, rows), 4, 70).collect()), key=str)
    assert got == brute_components(rows, 4, 70) and {c for *_, c in got} == {0, 2, 5}
    assert saved["tile-links"].count()


def brute_copies(rows):
    groups = defaultdict(list)
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    for (d, _), t in zip(rows, norm):
        groups[t].append(d)
    keep = {t: min((d for d in ds if d is not None), default=None) for t, ds in groups.items()}
    return sorted(((d, keep[t], len(groups[t]), d == keep[t], hashlib.sha256(t.encode()).hexdigest()) for (d, _), t in zip(rows, norm)), key=str)


@pytest.mark.parametrize("size", [7, 1024])
def test_block_dedup(spark, size):
    rows = [(d, t if t is None or len(t) < 1000 else t[:1000]) for d, t in ROWS] if size == 7 else ROWS
    got = block_dedup.block_dedup(table(spark, rows), size).drop("n_blocks")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_copies(rows)
    assert block_dedup.block_dedup(empty(spark)).count() == 0


def test_block_dedup_when_hashes_collide(spark):
    """Names stand for contents: with a hash that collides for the first salts, the names are made again."""
    from pyspark.sql import functions as F

    weak = lambda b, salt: F.pmod(F.xxhash64(F.lit(salt), b), F.lit(2 if salt < 2 else 1 << 62))
    rows = [(k, f"text {k % 9}") for k in range(40)]
    got = block_dedup.block_dedup(table(spark, rows), 4, weak).drop("n_blocks")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_copies(rows)


def test_sentencepiece_equals_library(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = ROWS + [(1000 + d, t) for d, t in documents()]
    got = {}
    for r in sentencepiece_bpe.tokenize(table(spark, rows), MODEL, keep=["doc_id"], ids=True, text=True).collect():
        got.setdefault(r.doc_id, []).append(r)
    for d, t in rows:
        ids = sp.encode(t or "", add_bos=True, add_eos=True)
        plain = sp.decode(ids)
        want = (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(plain.encode()).hexdigest(), ids, plain)
        assert want in [(r.n_tokens, r.ids_sha256, r.decoded_sha256, list(r.ids), r.decoded) for r in got[d]]
    assert sentencepiece_bpe.tokenize(empty(spark), MODEL).count() == 0


def test_sentencepiece_decodes_any_ids():
    import random
    from array import array

    import sentencepiece

    sp, codec, rng = sentencepiece.SentencePieceProcessor(model_file=MODEL), sentencepiece_bpe.Codec(MODEL), random.Random(3)
    for _ in range(300):
        ids = [rng.choice([rng.randrange(3, 259), rng.randrange(259, 32000), rng.randrange(0, 3)]) for _ in range(rng.randrange(1, 12))]
        if 0 not in ids:
            assert codec.decode(array("I", ids).tobytes()) == sp.decode(ids), ids


def test_leaks_equal_sql_and_awkward_rows(spark):
    items = spark.createDataFrame([(1, BASE), (2, "word"), (3, None), (4, " "), (None, BASE), (5, "a b c"), (2, "word")], "item_id bigint, text string")
    got = {(r.item_id, r.doc_id): r.containment for r in decontaminate.find_leaks(table(spark), items).collect()}
    assert got == {(1, 8): 1.0, (1, 9): 1.0, (1, 10): 1.0, (2, 4): 1.0, (2, 5): 1.0, (5, 6): 1.0, (5, 7): 1.0}
    assert decontaminate.find_leaks(empty(spark), items).count() == 0
    assert decontaminate.find_leaks(table(spark), items.where("false")).count() == 0
    left = decontaminate.decontaminate(table(spark), items)
    assert left.columns == table(spark).columns and {r.doc_id for r in left.collect()} == {d for d, _ in ROWS} - {4, 5, 6, 7, 8, 9, 10}


def test_leak_joins_without_broadcast(spark, monkeypatch):
    items = spark.createDataFrame([(1, BASE)], "item_id bigint, text string")
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert {r.doc_id for r in decontaminate.find_leaks(table(spark), items).collect()} == {8, 9, 10}


def brute_license(text):
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places, base = [], set()
    for phrase, label in license_scan.PHRASES:
        p = phrase.split()
        for i in range(len(ws) - len(p) + 1):
            if ws[i:i + len(p)] == p:
                places.append(i)
                base.add(label)
    labels, best = set(base), 0.0
    for line in re.split("[\r\n]+", text or ""):
        block = set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), line)))
        for label, t in license_scan.TEMPLATES:
            tokens = {w.decode() for w in license_scan.words(t)}
            if len(block & tokens) >= license_scan.THRESHOLD * len(tokens) - 1e-9:
                labels.add(label)
                best = max(best, len(block & tokens) / len(tokens))
    return (len(ws), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), 1.0 if base else best)


def test_license_scan(spark):
    texts = ["x\nThis work is licensed under the GNU General Public License, version 3.\ny", "Licensed under CC BY-NC 4.0. cc by nc cc by nc",
             "licensed under the apache license version 2", "This program is free software you can redistribute it and/or modify it"]
    rows = ROWS + [(50 + i, t) for i, t in enumerate(texts)] + [(1000 + d, t) for d, t in documents()]
    got = sorted((tuple(r) for r in license_scan.scan_licenses(table(spark, rows)).collect()), key=str)
    assert got == sorted(((d, *brute_license(t)) for d, t in rows), key=str)
    assert license_scan.scan_licenses(empty(spark)).count() == 0


def brute_windows(text):
    """Labels and best containment over every window of every template, without any filter."""
    ws, labels, best = license_scan.words(text), set(), 0.0
    for label, t in license_scan.TEMPLATES:
        tokens, n = set(license_scan.words(t)), license_scan.SPAN * len(license_scan.words(t))
        for i in range(max(1, len(ws) - n + 1)):
            share = len(tokens & set(ws[i:i + n])) / len(tokens)
            if share >= license_scan.THRESHOLD - 1e-9:
                labels.add(label)
                best = max(best, share)
    return labels, best


def test_license_places_of_a_long_text(spark):
    """Ten million characters of phrases take seconds: the words before a place are counted once."""
    import time

    n = 1_100_000
    rows = [(1, "cc by nc " * n), (2, "x " + "under the mit license cc by nc " * 30 + "y"), (3, "cc by nc")]
    start = time.monotonic()
    got = {r.doc_id: r for r in license_scan.scan_licenses(table(spark, rows)).collect()}
    assert time.monotonic() - start < 60
    assert (got[1].n_words, got[1].n_base, got[1].first_word, got[1].last_word) == (3 * n, n, 0, 3 * (n - 1))
    assert tuple(got[2])[1:5] == brute_license(rows[1][1])[:4] and tuple(got[3])[1:5] == (3, 1, 0, 0)


def test_license_windows(spark):
    import random

    rng = random.Random(3)
    fill = lambda n: " ".join(f"w{rng.randrange(500)}" for _ in range(n))
    texts, want = [], []
    for label, t in license_scan.TEMPLATES:  # wrapped notices: bare lines, and with comment marks
        for mark, eol in (("", "\n"), (" * ", "\r\n"), ("# ", "\n"), ("dnl ", "\n")):
            lines = textwrap.wrap(t, 28)
            texts.append(fill(300) + eol + eol.join(mark + x for x in lines) + eol + fill(300))
            want.append({label})
        # one long line with the template's words scattered over it
        scattered = [w for x in t.split() for w in (x, fill(400))]
        texts.append(" ".join(scattered))
        want.append(set())
    # near misses, repeated words and dense mixtures of template words
    vocab = sorted({w.decode() for _, t in license_scan.TEMPLATES for w in license_scan.words(t)})
    for _ in range(300):
        ws = [w for _ in range(rng.randrange(1, 5)) for w in rng.choice(license_scan.TEMPLATES)[1].split() if rng.random() < 0.93]
        for _ in range(rng.randrange(40)):
            ws.insert(rng.randrange(len(ws) + 1), rng.choice(vocab) if rng.random() < 0.6 else "x")
        texts.append(rng.choice([" ", "\n"]).join(ws))
        want.append(None)
    got = {r.doc_id: r for r in license_scan.scan_licenses(table(spark, list(enumerate(texts)))).collect()}
    for i, (text, labels) in enumerate(zip(texts, want)):
        found, best = brute_windows(text)
        base = set(filter(None, got[i].base_labels.split(",")))
        assert set(filter(None, got[i].labels.split(","))) == found | base, text
        assert got[i].score == (1.0 if base else best), text
        assert labels is None or labels - base <= found and (labels or not found), text


def held_out(name, mod, rest):
    rows = duckdb.sql(f"SELECT doc_id, text, {name} FROM '/root/testdata/sf0.01/documents.parquet' JOIN '/root/testdata/sf0.01/labels.parquet' USING (doc_id)").fetchall()
    out = lambda d: zlib.crc32(str(d).encode()) % mod == rest
    return [r for r in rows if not out(r[0])], [r for r in rows if out(r[0])]


def auc(scored):
    pos, neg = [s for s, y in scored if y], [s for s, y in scored if not y]
    return sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))


def test_toxicity(spark):
    import random

    rng = random.Random(2)
    draw = lambda: [f"w{rng.randrange(400)}" for _ in range(30)]
    clean, toxic = [" ".join(draw()) for _ in range(40)], [" ".join([*draw(), "zzinsult", *draw()]) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(clean + toxic)]
    labels = spark.createDataFrame([(i, int(i >= len(clean))) for i, _ in rows] + [(None, 1), (3, None)], "doc_id bigint, toxic int")
    model = toxicity.train(table(spark, rows), labels)
    out = {r.doc_id: r for r in toxicity.score_toxicity(table(spark, ROWS + [(200, "w1 zzinsult w2"), (201, "w1 w3 w2")]), model).collect()}
    assert out[200].predicted == 1 and out[201].predicted == 0 and out[1].score == 0 and out[2].spans == []
    assert any("w1 zzinsult w2"[s.start:s.stop] == "zzinsult" for s in out[200].spans)
    assert toxicity.score_toxicity(empty(spark), model).count() == 0
    nothing = toxicity.train(empty(spark), labels)
    assert all(r.predicted == 0 for r in toxicity.score_toxicity(table(spark), nothing).collect())


def test_toxic_tail_is_marked():
    """Words that are each rarer than 2% of the toxic documents mark them; words as frequent in clean ones don't."""
    toxic = [{f"=bad{i % 80}", f"=own{i}", f"=any{i % 100}"} for i in range(2000)]
    clean = [{f"=fine{i}", f"=any{i % 100}"} for i in range(2000)]
    assert toxicity.marks(toxic, clean) == {f"=bad{i}" for i in range(80)}
    assert toxicity.marks(toxic[:150], []) == {f for f in ["=bad%d" % i for i in range(80)] + ["=any%d" % i for i in range(100)] if sum(f in d for d in toxic[:150]) >= 3}


def test_shared_passages_are_no_copies():
    import random

    rng = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(12))
    texts = [" ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(90)) + " " + passage for _ in range(60)]
    copies = [t + " more" for t in texts[:20]] + texts[:20] + ["short text", "short text", "a", "a"]
    assert toxicity.distinct_texts(texts + copies) == [*texts, "short text", "a"]


def test_marginals_equal_enumeration():
    import itertools

    import numpy as np

    rng = np.random.default_rng(1)
    score, a = rng.normal(size=6), rng.normal(size=(2, 2))
    total, one = 0.0, np.zeros(6)
    for y in itertools.product((0, 1), repeat=6):
        w = np.exp(sum(score[i] * y[i] for i in range(6)) + sum(a[y[i], y[i + 1]] for i in range(5)))
        total, one = total + w, one + w * np.array(y)
    assert np.allclose(toxicity.posterior(score[None], a)[0][0], one / total)
    tagger = toxicity.Tagger({"w": np.zeros(toxicity.DIM), "bias": 0.0, "a": a})
    tagger.odds.update({str(i): float(np.exp(score[i])) for i in range(6)})
    assert np.allclose(tagger.marginals([str(i) for i in range(6)]), one / total)


def test_quality_held_out(spark):
    train, test = held_out("quality", 5, 0)
    lab = spark.createDataFrame([(d, q) for d, _, q in train] + [(None, 1), (5, None)], "doc_id bigint, quality int")
    got = {r.doc_id: r for r in quality.classify_quality(table(spark, [(d, t) for d, t, _ in train + test] + [(-1, None), (-2, " ")]), lab).collect()}
    assert auc([(got[d].score, y) for d, _, y in test]) > 0.85
    assert 0 <= got[-1].score <= 1 and got[-1].score == pytest.approx(got[-2].score)
    assert quality.classify_quality(empty(spark), lab).count() == 0
    assert quality.classify_quality(table(spark), lab.where("false")).count() == len(ROWS)


def test_isotonic():
    assert quality.isotonic([0, 2, 0, 3], [1, 2, 1, 3]).tolist() == pytest.approx([0, 2 / 3, 2 / 3, 1])


def brute_url(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), h + p, v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[1:] if fits else (None, None)


def test_url_filter(spark):
    urls = ["http://WWW.Example.com/en/x?a=1#b", "https://a.example.com/en/", "http://example.com/de/", "http://x.net/es/1", "http://net/fr/2", "ftp://h", None, "no scheme",
            "http://?x", "http://x.example.com/en", "http://h/p#f?g", "", "http://x.net/es/1"] * 3
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id bigint, url string, verdict string")
    got = {r.page_id: r for r in url_filter.judge_urls(pages).collect()}
    for i, u in enumerate(urls):
        host, path, (rule, verdict) = brute_url(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule) and got[i].verdict in ("allow", "block")
        assert verdict is None or got[i].verdict == verdict
    assert url_filter.judge_urls(pages.where("false")).count() == 0
    assert {r.verdict for r in url_filter.judge_urls(pages.where("page_id < 1")).collect()} == {"allow"}


def test_url_trees_learn(spark):
    """Verdicts of URLs without a rule follow the labelled ones that look alike."""
    urls = [f"http://h{i}.net/{('es', 'en')[i % 2]}/{i}" for i in range(60)] + [f"http://h{i}.example.com/{('en', 'de')[i % 2]}/{i}" for i in range(60)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = url_filter.judge_urls(pages).collect()
    ruled = [r for r in got if r.rule]
    assert sum((r.score >= 0.5) == (r.verdict == "block") for r in ruled) / len(ruled) > 0.95


def test_url_rates_count_all_labelled_urls(spark):
    """Hosts that the fitting sample holds once or not at all still have their block rate."""
    rules = tuple((f"h{i}.net", "/p/", ("allow", "block")[i * 7 % 10 > 4]) for i in range(10, 50))
    urls = [f"http://h{i}.net/{'p' if j else 'q'}/{i * 31 % 97}{j}" for i in range(10, 50) for j in range(9)]
    got = url_filter.judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string"), rules, max_train=40).collect()
    verdict = {host: v for host, _, v in rules}
    free = [r for r in got if r.rule is None]
    assert len(free) == 40 and all(r.verdict == verdict[r.host] for r in free)


def test_url_sample_holds_rare_labels(spark):
    urls = [f"http://h{i * 37 % 90}.example.net/fr/{1000 + i * 113}" for i in range(8)] + [f"http://h{i % 90}.example.com/de/{1000 + i}" for i in range(2000)]
    got = url_filter.judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string"), max_train=40).collect()
    assert {r.verdict for r in got if r.page_id < 8} == {"block"} and len(got) == len(urls)
    assert min(r.score for r in got if r.page_id < 8) >= 0.5 > max(r.score for r in got if r.page_id >= 8)


@pytest.mark.parametrize("html,text", [
    (None, ""), ("", ""), ("plain  text\n here", "plain text here"), ("<p>a<p>b", "a\n\nb"), ("a<br>b<br/>c", "a\nb\nc"),
    ("<ul><li>x<li>y<ul><li>z</ul></ul>w", "- x\n- y\n  - z\n\nw"), ("<ol start=3><li>a<li value=7>b<li>c</ol>", "3. a\n7. b\n8. c"),
    ("<table><tr><th>name<th>n<tr><td>a<td>10<tr><td>longer<td>7</table>", "name    n\na       10\nlonger  7"),
    ("<table><tr><td colspan=2>wide cell<td>x<tr><td>a<td>b<td>c</table>", "wide cell  x\na  b  c".replace("a  b  c", "a  b  c")),
    ("x<script>if (a<b) '<p>'</script>y<style>p{}</style>z<!-- <p>no -->", "xyz"), ("<p hidden>no</p><p style='display: none'>no</p>yes", "yes"),
    ("<pre>a  b\n  c</pre>", "a  b\n  c"), ("<title>t</title><body>a &amp; b &lt;c&gt;", "a & b <c>"), ("<div>a</div><div>b</div>", "a\nb"),
    ("<details><summary>s</summary>no</details><details open><summary>s</summary>yes</details>", "s\ns\nyes"), ("a < b <3 c", "a < b <3 c"),
    ("<b><i>x</b>y</i>", "xy"), ("<a href='x>y'>l</a>", "l"), ("<p>unclosed <b", "unclosed")])
def test_html_text(html, text):
    assert html_text.render(html) == text


@pytest.mark.parametrize("html,text", [
    # a quote opens a value only after "="
    ("<img alt=Bob's>Hello, don't go<b>", "Hello, don't go"), ("<p class=x\">a \"b\" c</p>", 'a "b" c'), ("<a href='x' '>l's</a> m", "l's m"),
    ("<a title = \"a > b\" href=/x/>l</a>", "l"), ("<a b='c'd=\"e>\"f>l</a>", "l"), ("<a b=>l</a>", "l"), ("<i =x \">t</i>", "t"), ("<a b=\"c>t", "t"),
    ("<p title=it's hidden>no</p>yes", "yes"), ("<p title='hidden'>a</p>", "a"), ("<p title=x'hidden>a</p>", "a"), ("</p \"x>a'b", "a'b"),
    # svg, math, the fallback of object, and maps
    ("a<svg width=1><title>t</title><style>s{}</style><defs><text>d</text></defs>x<g><text>one <tspan>two</tspan></text><text>three</text></g></svg>b", "a one two three b"),
    ("<svg><title/><path d='M0'/><text>in</text></svg><p>out", "in\n\nout"), ("<svg><g><p>left the drawing</p>rest", "left the drawing\n\nrest"),
    ("<svg><foreignObject><div>html <b>here</b></div></foreignObject><text><![CDATA[a<b]]></text></svg>", "html here\na<b"),
    ("<p>x<svg><foreignObject><p>y</p></foreignObject></svg>z", "x\n\ny\n\nz"), ("<svg><text display=none>n</text><text visibility=hidden>n</text><text>y</text></svg>", "y"),
    ("<math><semantics><mrow><mi>a</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac></mrow><annotation>n</annotation></semantics></math>", "a = 1 2"),
    ("<object data=x><param name=a>instead</object> <map><p>m</p></map>", "instead\n\nm"),
    # visibility can be set anew by a child
    ("<div style='visibility:hidden'>no<p style='visibility: visible'>yes</p>no</div>", "yes"), ("<p style='backface-visibility:hidden'>a</p>", "a"),
    ("<ul style='visibility:hidden'><li>no<li style='visibility:visible'>yes</ul>", "- yes"), ("<p style='display:none'><b style='visibility:visible'>no</b></p>a", "a"),
    ("<table><tr style='visibility:hidden'><td>no<td style='visibility:visible'>yes<tr><td>a<td>b</table>", "   yes\na  b"),
    ("<div>" * 198 + "<svg><g><g><text>deep</text></g></g></svg>", "deep")])
def test_html_visible_text(html, text):
    assert html_text.render(html) == text


def test_html_keeps_all_words(spark):
    """Deep and long markup renders, and pages keep every word outside hidden elements, in order."""
    assert html_text.render("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    pages = duckdb.sql(f"SELECT page_id, html FROM '{SF}/pages.parquet'").fetchall()
    got = {r.page_id: r.text for r in html_text.extract_text(spark.createDataFrame(pages + [(-1, None)], "page_id bigint, html string")).collect()}
    for i, h in pages:
        bare = re.sub(r"<!--.*?-->|<(script|style|head)\b.*?</\1>", " ", h, flags=re.S)
        want = unescape(re.sub(r"<[!/?a-zA-Z][^>]*>", " ", bare)).split()
        assert [w for w in got[i].split() if w != "-"] == [w for w in want if w != "-"] or "".join(got[i].split()).replace("-", "") == "".join(want).replace("-", "")
    assert got[-1] == ""


def test_warc(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    src = {r.record_id: r for r in responses(pages).collect()}
    out = warc.build_derivatives(responses(pages)).collect()
    assert len(out) == 2 * len(src)
    by_id = {r.record_id: r for r in out}
    for r in out:
        fields, block = warc.parse_record(bytes(r.record))
        s = src[r.refers_to]
        payload = bytes(s.block).split(b"\r\n\r\n", 1)[1]
        assert fields["WARC-Refers-To"] == s.record_id and fields["WARC-Target-URI"] == s.target_uri and fields["WARC-Refers-To-Date"] == s.date
        assert fields["WARC-Block-Digest"] == warc.digest(block) == r.block_digest and r.source_payload_digest == warc.digest(payload)
        if r.record_type == "metadata":
            assert f"source-payload-digest: {warc.digest(payload)}" in block.decode() and "source-header: Server: archive" in block.decode()
            assert by_id[fields["WARC-Concurrent-To"]].refers_to == s.record_id
        else:
            assert b"<script" not in block and fields["Content-Type"].startswith("text/plain")
    odd = spark.createDataFrame([("<a>", None, None, None), (None, "u", "d", b"x"), ("<b>", "u", "d", b"HTTP/1.1 200 OK\r\nContent-Type: image/png\r\n\r\n\x00\xff")],
                                "record_id string, target_uri string, date string, block binary")
    got = {(r.refers_to, r.record_type) for r in warc.build_derivatives(odd).collect()}
    assert got == {("<a>", "conversion"), ("<a>", "metadata"), ("<b>", "metadata")}
    assert warc.build_derivatives(odd.where("false")).count() == 0


def test_warc_undoes_codings(spark):
    import gzip

    html = "<p>caf\u00e9 one</p><p>two</p>".encode() * 50
    chunk = lambda b, n=97: b"".join(b"%x;e=1\r\n%s\r\n" % (len(b[i:i + n]), b[i:i + n]) for i in range(0, len(b), n)) + b"0\r\n\r\n"
    raw = zlib.compressobj(wbits=-15)
    cases = [("", html), ("Transfer-Encoding: chunked", chunk(html)), ("Content-Encoding: gzip", gzip.compress(html)), ("content-encoding: x-gzip", gzip.compress(html[:600]) + gzip.compress(html[600:])),
             ("Content-Encoding: deflate", zlib.compress(html)), ("Content-Encoding: deflate", raw.compress(html) + raw.flush()), ("Content-Encoding: identity", html),
             ("Content-Encoding: deflate, gzip", gzip.compress(zlib.compress(html))), ("Content-Encoding: gzip\r\nTransfer-Encoding: chunked", chunk(gzip.compress(html), 11)),
             ("Transfer-Encoding: gzip, chunked", chunk(gzip.compress(html), 11)), ("Content-Encoding: gzip", html), ("Transfer-Encoding: chunked", html), ("Transfer-Encoding: chunked", chunk(html, 10**6)), ("Transfer-Encoding: chunked", chunk(html)[:-5])]
    assert warc.unchunk(b"5\r\nhello\r\nworld") == b"5\r\nhello\r\nworld" and warc.unchunk(b"5\r\nhel") == b"hel"
    lost = [("Content-Encoding: br", b"\x0b\x02\x80"), ("Content-Encoding: gzip", b"\x1f\x8b\xff\xff\xff"), ("Content-Encoding: deflate", b"\xff\xfe\xfd")]
    blocks = [f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{h}\r\n\r\n".replace("\r\n\r\n\r\n", "\r\n\r\n").encode() + b for h, b in cases + lost]
    src = spark.createDataFrame([(f"<{i}>", "u", "d", bytearray(b)) for i, b in enumerate(blocks)], "record_id string, target_uri string, date string, block binary")
    got = {(r.refers_to, r.record_type): r for r in warc.build_derivatives(src).collect()}
    assert len(got) == 2 * len(cases) + len(lost)
    want = "\n".join(["caf\u00e9 one", "two"] * 50).encode()
    for i, (h, b) in enumerate(cases + lost):
        assert got[f"<{i}>", "metadata"].source_payload_digest == warc.digest(b), h
        assert ((f"<{i}>", "conversion") in got) == (i < len(cases)), h
        assert i >= len(cases) or warc.parse_record(bytes(got[f"<{i}>", "conversion"].record))[1] == want, (i, h)


def test_oracles(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    for name, sql in ORACLE.items():
        df = QUERIES[name](spark, SF)
        cols = sorted(df.columns)
        want = con.execute(f"SELECT {', '.join(cols)} FROM ({sql})").fetchall()
        assert sorted(tuple(r) for r in df.select(cols).collect()) == sorted(want)


def test_pipeline_stages(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    kept = p.drop_copies(spark, docs, SF)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in brute_copies(rows) if r[3])
    near = p.drop_near_copies(spark, docs, SF)
    assert sorted(r.doc_id for r in near.collect()) == sorted(d for d, _, c in brute_components(rows, 5, 80) if d == c)
    clean = p.drop_toxic(spark, docs.withColumn("score", docs.doc_id), SF)
    assert clean.columns == [*docs.columns, "score"] and 0.7 * len(rows) < clean.count() <= len(rows)
    for name, stage in p.STAGES:
        assert stage(spark, docs.where("false"), SF).count() == 0, name
    out = p.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and 0 < out.count() <= kept.count()


def test_pipeline_judges_rows_by_their_own_text(spark):
    """Repeated and null ids: one row of each group of copies stays, and no row goes for another's text."""
    import corpus_pipeline as p

    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    near = c + " tail"
    rows = [(1, a), (2, a), (2, b), (3, c), (3, c), (None, c), (None, "only here"), (None, "only here"), (4, None), (None, "")]
    kept = lambda docs: sorted(((r.doc_id, r.text) for r in docs.collect()), key=str)
    want = [(1, a), (2, b), (3, c), (None, "only here"), (4, None)]
    assert kept(p.drop_copies(spark, table(spark, rows), SF)) == sorted(want, key=str)
    rows = [(1, a), (2, c), (2, b), (3, near), (3, a), (3, "other"), (None, near), (None, "only here"), (7, b), (7, b)]
    want = [(1, a), (2, c), (2, b), (3, "other"), (None, "only here")]
    assert kept(p.drop_near_copies(spark, table(spark, rows), SF)) == sorted(want, key=str)
    item = next(r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").collect() if r.text and len(r.text.split()) > 5)
    rows = [(1, item), (1, b), (None, "lead " + item), (None, c)]
    out = p.drop_leaks(spark, table(spark, rows), SF)
    assert kept(out) == sorted([(1, b), (None, c)], key=str) and out.columns == table(spark, rows).columns


def test_toxic_token_places_are_those_of_the_features():
    """Edges, case, signs inside, scripts, short and blank-edged words: the fast way gives the CRC-32 of each feature."""
    tokens = ["word", "Word.", "(WORD)", "a", "...", "don't", "x_y", "_x_", "ÄRGER!", "naïve", "日本語。", "éa", "№5", "--ab--", "“so”", "ABCdefghij", "1234567890123", "ß", "İ", "²"]
    for t in tokens:
        assert toxicity.hashed(t) == [zlib.crc32(f.encode()) % toxicity.DIM for f in toxicity.features(t)], t


def test_toxic_scores_do_not_depend_on_the_cache(monkeypatch):
    rng = np.random.default_rng(1)
    model = {"w": rng.normal(size=toxicity.DIM), "bias": -1.0, "a": np.array([[0.4, -0.2], [0.1, 0.3]])}
    texts = [" ".join(f"w{rng.integers(0, 400)}" for _ in range(rng.integers(0, 60))) for _ in range(80)] + [None, "", "  "]
    whole = toxicity.Tagger(model).scores(texts)
    monkeypatch.setattr(toxicity, "CACHE_ENTRIES", 50)
    monkeypatch.setattr(toxicity, "TOGETHER", 90)
    tagger = toxicity.Tagger(model)
    small = [s for i in range(0, len(texts), 7) for s in tagger.scores(texts[i:i + 7])]
    assert [(round(s, 12), [(a, b) for a, b, _ in sp]) for s, sp in small] == [(round(s, 12), [(a, b) for a, b, _ in sp]) for s, sp in whole]
    assert whole[-3:] == [(0.0, [])] * 3


def test_html_wide_cells_do_not_multiply_a_page():
    rows = "".join(f"<tr><td>{i}<td>b{i}</tr>" for i in range(800))
    wide = "w" * 50_000
    text = html_text.render(f"<table><tr><td>{wide}<td>end</tr>{rows}</table>")
    assert len(text) < 4 * (50_000 + 800 * 20)
    assert text.split("\n")[0] == wide + "  end" and text.split("\n")[1] == "0  b0" and text.count("\n") == 800
    spans = "".join(f"<tr><td colspan=1000>a{i}<td>z</tr>" for i in range(500))
    assert len(html_text.render(f"<table>{spans}</table>")) < 500 * 300
    deep = "<table><tr><td>a<td>" * 60 + "<br>".join("x" * 3 for _ in range(2000)) + "</table>" * 60
    text = html_text.render(deep)
    assert len(text) < 2000 * 500 and text.count("xxx") == 2000
    # nothing moves in an ordinary table
    assert html_text.render("<table><tr><td>ab<td>c<tr><td>d<td>ef</table>") == "ab  c\nd   ef"


def test_warc_inflates_no_more_than_its_limit():
    bomb = gzip.compress(b"a" * 3_000_000)
    assert warc.inflate(bomb, 31, 1 << 20) is None and len(warc.inflate(bomb, 31, 3_000_000)) == 3_000_000
    two = gzip.compress(b"x" * 600) + gzip.compress(b"y" * 600)
    assert warc.inflate(two, 31, 1200) == b"x" * 600 + b"y" * 600 and warc.inflate(two, 31, 1199) is None
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/plain\r\nContent-Encoding: gzip\r\n\r\n"
    big = head + gzip.compress(b"word " * (warc.MAX_INFLATED // 5 + 1))
    assert [r["record_type"] for r in warc.derive("<urn:uuid:0>", "http://a.example/", "2024-01-01T00:00:00Z", big)] == ["metadata"]
    assert [r["record_type"] for r in warc.derive("<urn:uuid:0>", "http://a.example/", "2024-01-01T00:00:00Z", head + gzip.compress(b"word"))] == ["conversion", "metadata"]


def test_toxic_marginals_side_by_side_equal_one_pass():
    """Texts of one to 3,000 tokens in one go, transitions weak and strong: as forward-backward over each text alone."""
    rng = np.random.default_rng(4)
    for a in (np.array([[0.2, -0.1], [0.0, 0.1]]), np.array([[2.5, -2.0], [-1.5, 2.0]]), np.zeros((2, 2)), np.array([[9.0, -9.0], [-9.0, 9.0]])):
        tagger = toxicity.Tagger({"w": np.zeros(toxicity.DIM), "bias": 0.0, "a": a})
        score = rng.normal(scale=4, size=300)
        tagger.odds.update({str(i): float(np.exp(s)) for i, s in enumerate(score)})
        texts = [[str(i) for i in rng.integers(0, 300, n)] for n in (1, 2, 3000, 1, 64, 65, 700, 5)]
        got, starts = tagger.all_marginals(texts)
        for t, at in zip(texts, starts):
            want = toxicity.posterior(score[[int(x) for x in t]][None], a)[0][0]
            assert np.allclose(got[at:at + len(t)], want, rtol=1e-10, atol=1e-14)
