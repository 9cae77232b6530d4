"""Operators that SQL cannot express (or not fast enough), against plain Python or the public libraries."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from workpulse.llm import bpe, decontaminate, lang_id, license_scan, line_dedup, ngram_join, pii, quality_rules, sharding, token_counts
from workpulse.llm.common import connected_components, shared_path
from workpulse.llm.queries import QUERIES

from tests.llm.conftest import LONG, PROSE, edge_documents

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()


def sha(b):
    return hashlib.sha256(b if isinstance(b, bytes) else b.encode()).hexdigest()


# -- sharding

def jump(key, n):
    b, j, key = -1, 0, key % 2**64
    while j < n:
        b, key = j, (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_sharding(spark, docs):
    rows = {r["doc_id"]: r for r in QUERIES["op2_jump_sharding"](spark, SF).collect()}
    slots = {}
    for d in docs:
        r = rows[d["doc_id"]]
        assert (r["shard"], r["grown_shard"]) == (jump(d["doc_id"], 8), jump(d["doc_id"], 9))
        assert r["size"] == len(d["text"].encode()) + 1 and r["text_crc32"] == zlib.crc32(d["text"].encode())
        assert r["grown_shard"] in (r["shard"], 8)
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_jump_hash_of_odd_keys():
    keys = np.array([0, 1, -1, 2**63 - 1, -2**63, 12345], dtype=np.int64)
    for n in (1, 2, 9, 1000):
        assert sharding.jump_hash(keys, n).tolist() == [jump(int(k), n) for k in keys]


def test_write_shards_round_trip(spark, tmp_path):
    df = spark.range(500).selectExpr("id AS doc_id", "concat('t', id) AS text")
    sharding.write_shards(df, "doc_id", str(tmp_path / "s"), shards=5)
    back = spark.read.parquet(str(tmp_path / "s")).collect()
    assert sorted((r["doc_id"], r["text"]) for r in back) == sorted((r["doc_id"], r["text"]) for r in df.collect())
    assert all(r["shard"] == jump(r["doc_id"], 5) for r in back)


# -- line dedup

def kept_lines(docs):
    key = lambda x: x.encode().strip(b" \t\n\x0b\x0c\r").lower().decode()
    first, last = {}, {}
    for i, t in docs:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 10:
                first[key(x)], last[key(x)] = min(first.get(key(x), i), i), max(last.get(key(x), i), i)
    return {i: "\n".join(x for x in (t or "").split("\n") if not (key(x) in first and first[key(x)] < last[key(x)] and first[key(x)] < i)) for i, t in docs}


def test_line_store_is_reversible(spark, docs):
    rows = [(d["doc_id"], d["text"]) for d in docs]
    frame = lambda keep: spark.createDataFrame([r for r in rows if keep(r[0])] or [], "doc_id long, text string")
    store = line_dedup.LineStore(spark, shared_path(spark, "test"))
    store.insert(frame(lambda i: i % 2))
    store.insert(frame(lambda i: i % 2 == 0))
    got = {r["doc_id"]: r["kept"] for r in store.resolve(frame(lambda i: True)).collect()}
    assert got == kept_lines(rows)
    store.delete(frame(lambda i: i < 100).select("doc_id"))
    got = {r["doc_id"]: r["kept"] for r in store.resolve(frame(lambda i: i >= 100)).collect()}
    assert got == kept_lines([r for r in rows if r[0] >= 100])
    store.insert(frame(lambda i: i < 100))
    got = {r["doc_id"]: r["kept"] for r in store.resolve(frame(lambda i: True)).collect()}
    assert got == kept_lines(rows)


def test_cuckoo_filter_counts_and_forgets():
    keys = np.random.default_rng(3).integers(-2**62, 2**62, 6000)
    f = line_dedup.CuckooFilter.empty(9000)
    assert f.add(keys) and f.add(keys[:3000])
    assert (f.copies(keys) >= 1).all() and (f.copies(keys[:3000]) >= 2).all()
    f.remove(keys[:3000])
    f.remove(keys[:3000])
    assert (f.slots != 0).sum() == 3000 and (f.copies(keys[3000:]) >= 1).all()
    assert not line_dedup.CuckooFilter.empty(8).add(keys)
    assert line_dedup.changed_filter(0, line_dedup.CuckooFilter.empty(8).slots.tobytes(), keys, np.ones(len(keys))) is None


def test_filters_that_outgrow_are_rebuilt(spark):
    store = line_dedup.LineStore(spark, shared_path(spark, "grow"))
    store.insert(spark.createDataFrame([(1, "only one line here")], "doc_id long, text string"))
    rows = [(i, f"line number {i} of many\nline number {i % 50} that some share") for i in range(2, 400)]
    store.insert(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r["doc_id"]: r["kept"] for r in store.resolve(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: t for i, t in kept_lines([(1, "only one line here"), *rows]).items() if i > 1}


def test_store_survives_failed_steps_and_reopens(spark, monkeypatch):
    """A step that fails in its filters or its manifest changes nothing and can be done again; another session goes on with the store."""
    rows = [(i, f"line number {i} of many\nline number {i % 7} that some share") for i in range(60)]
    frame = lambda part: spark.createDataFrame([r for r in rows if part(r[0])], "doc_id long, text string")
    kept = lambda st, part: {r["doc_id"]: r["kept"] for r in st.resolve(frame(part)).collect()}
    path = shared_path(spark, "retry")
    store = line_dedup.LineStore(spark, path)
    with pytest.raises(Exception):
        line_dedup.LineStore.open(spark, path)
    steps = [("insert", frame(lambda i: i < 30)), ("insert", frame(lambda i: i >= 30)), ("delete", frame(lambda i: i < 20).select("doc_id"))]
    live = [lambda i: i < 30, lambda i: True, lambda i: i >= 20]
    for (step, given), part in zip(steps, live):
        for broken in ("_changed", "_publish"):
            before = dict(store.state)
            with monkeypatch.context() as m:
                m.setattr(line_dedup.LineStore, broken, lambda *a, **k: 1 / 0)
                with pytest.raises(ZeroDivisionError):
                    getattr(store, step)(given)
            assert store.state == before
        getattr(store, step)(given)
        store = line_dedup.LineStore.open(spark.newSession(), path)
        assert kept(store, part) == kept_lines([r for r in rows if part(r[0])])
    assert store.state["version"] == 3 and store.postings().count() == 80


def test_shards_double_and_deletions_are_compacted(spark, monkeypatch):
    """A store begun with one document grows to many shards; after some deletions the postings hold live documents only."""
    monkeypatch.setattr(line_dedup, "KEYS_PER_SHARD", 64)
    store = line_dedup.LineStore(spark, shared_path(spark, "double"), min_chars=5)
    store.insert(spark.createDataFrame([(0, "only one line here")], "doc_id long, text string"))
    assert store.state["shards"] == 1
    rows = [(i, "\n".join(f"line {i % (40 + j)} {j}" for j in range(8))) for i in range(1, 300)]
    store.insert(spark.createDataFrame(rows, "doc_id long, text string"))
    keys = len({x for _, t in rows for x in t.split("\n")}) + 1
    assert store.state["shards"] >= keys / 64 and store.filters().count() > 4
    for k in range(line_dedup.COMPACT_AFTER):
        store.delete(spark.createDataFrame([(i,) for i in range(1, 300) if i % 10 == k], "doc_id long"))
    assert store.state["dead"] == [] and len(store.state["batches"]) == 1
    left = [r for r in rows if r[0] % 10 >= line_dedup.COMPACT_AFTER]
    store.insert(spark.createDataFrame([(500, rows[0][1])], "doc_id long, text string"))
    again = [*left, (500, rows[0][1])]
    got = {r["doc_id"]: r["kept"] for r in line_dedup.LineStore.open(spark, store.path).resolve(spark.createDataFrame(again, "doc_id long, text string")).collect()}
    want = {}
    first = {}
    for i, t in sorted(again):
        want[i] = "\n".join(x for x in t.split("\n") if first.setdefault(x, i) == i)
    assert got == want


# -- token counts

ODD = ["a" * 5000, " " * 3000, "ab  cd" * 900, "日本語テキスト" * 300, "<s> </s> " * 300, "▁▁ a" * 500, "\x00\n\t" * 800, "é̀🙂" * 500, "𓀀𓁀x" * 400, " 𓀀" * 700, "", LONG[:20_000]]


def test_resynchronised_counts_equal_whole_texts(docs):
    c = token_counts.Counter(public_tokenizers.path(token_counts.MODEL), chunk_chars=300, overlap=16)
    texts = [d["text"] for d in docs] + ODD
    assert c.local and c.counts(texts) == [len(x) for x in c.sp.encode(texts)]


def test_token_counts_query(spark, docs):
    sp = token_counts.Counter(public_tokenizers.path(token_counts.MODEL)).sp
    rows = {r["doc_id"]: r for r in QUERIES["op3_token_counts"](spark, SF).collect()}
    for d in docs:
        n, r = len(sp.encode(d["text"])), rows[d["doc_id"]]
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(d["text"].encode()), n, n > 4096)


# -- language

def test_gradients():
    m = lang_id.Model.start(["a", "b", "c"], 4)
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    x, y = np.random.default_rng(0).integers(0, 256, (7, 3)).astype(np.uint8), np.array([0, 2, 1])
    _, grad = m.loss_and_gradients(x, y)
    for k in m.p:
        at = (int(x[3, 1]), 2) if k[0] == "W" else tuple(n // 2 for n in m.p[k].shape)
        old, m.p[k][at] = m.p[k][at], m.p[k][at] + 1e-4
        up, _ = m.loss_and_gradients(x, y)
        m.p[k][at] = old - 1e-4
        down, _ = m.loss_and_gradients(x, y)
        m.p[k][at] = old
        assert grad[k][at] == pytest.approx((up - down) / 2e-4, rel=1e-2, abs=1e-5)


def test_held_out_accuracy(spark):
    rows = QUERIES["op4_lang_id"](spark, "/root/testdata/sf0.01").collect()
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1}
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_windows_cover_each_byte_once_and_spans_agree(spark):
    model = lang_id.fit([("aa", b"abc abd abe " * 8), ("bb", "ñó íú ñá éü ".encode() * 6)] * 40)
    for n in (0, 1, 255, 256, 257, 1000):
        own, first, counted = lang_id.windows(np.array([n]))
        assert counted.sum() == n and all(f >= 0 and f + min(256, n) <= n for f in first)
    text = "abc abd abe " * 30 + "ñó íú ñá éü " * 30
    p = model.documents([text.encode(), b"abc abd"])
    label = model.label(text.encode())
    assert p.sum(1) == pytest.approx([1, 1], abs=1e-3) and {0, 1} == set(label.tolist())
    got = lang_id.spans(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string"), model).collect()
    assert got[0]["start"] == 0 and got[-1]["end"] == len(text.encode()) and all(a["end"] == b["start"] for a, b in zip(got, got[1:]))


# -- licences

def test_licences_by_brute_force(spark):
    files = [("r/LICENSE", "Released under the MIT License."), ("r/a/x.txt", "prose"), ("r/a/b/COPYING", "x\nLicensed under CC BY-NC 4.0."),
             ("r/a/b/y.txt", "z\nLicensed under the Apache License, Version 2.0.\nz"), ("r/a/b/c/d/z.txt", None), ("q/x.txt", "no license at all here"),
             ("r/a/bb/x.txt", ""), (None, "Released under the MIT License."), ("LICENSE.md", "")]
    df = spark.createDataFrame([(i, *f) for i, f in enumerate(files)], "id long, p string, t string")
    got = {r["id"]: (r["license"], r["origin"], r["from_path"]) for r in license_scan.scan(df, "id", "p", "t").collect()}
    assert got == {0: ("MIT", "file", "r/LICENSE"), 1: ("MIT", "inherited", "r/LICENSE"), 2: ("CC-BY-NC-4.0", "file", "r/a/b/COPYING"),
                   3: ("Apache-2.0", "header", "r/a/b/y.txt"), 4: ("CC-BY-NC-4.0", "inherited", "r/a/b/COPYING"), 5: (None, None, None),
                   6: ("MIT", "inherited", "r/LICENSE"), 7: ("MIT", "header", None), 8: (None, None, None)}


def test_similarity_is_tf_idf_cosine(spark):
    units = [("licensed under the apache license version 2.0", 3), ("license of some kind", 1), ("released under the mit license", 1)]
    got = {r["unit"]: r for r in license_scan.score(spark.createDataFrame(units, "unit string, holders long"), 0.0).collect()}
    every = [(re.findall(license_scan.TERM, t.lower()), n) for t, n in [*units, *((t, 1) for _, t in license_scan.NOTICES)]]
    total = sum(n for _, n in every)
    idf = {w: math.log((total + 1) / (sum(n for ws, n in every if w in ws) + 1)) + 1 for ws, _ in every for w in ws}
    vec = lambda ws: {w: c * idf[w] for w, c in Counter(ws).items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    for (u, _), (ws, _) in zip(units, every):
        a = vec(ws)
        best = max(sum(a.get(w, 0) * x for w, x in vec(b).items()) / norm(a) / norm(vec(b)) for b, _ in every[len(units):])
        assert got[u]["similarity"] == pytest.approx(best, abs=1e-6)


# -- n-gram join

def brute_components(docs, width, percent):
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])
    sets = [(i, shingles(t)) for i, t in docs]
    comp = {i: i for i, _ in sets}
    links = Counter()

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x
    for a, (i, s) in enumerate(sets):
        for j, u in sets[:a]:
            if s and u and 100 * len(s & u) >= percent * len(s | u):
                links[i] += 1
                links[j] += 1
                x, y = sorted((root(i), root(j)))
                comp[y] = x
    return {i: (len(s), root(i), links[i]) for i, s in sets}


@pytest.mark.parametrize("block", [512, 7])
def test_near_copies_and_common_passages(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    r = np.random.default_rng(5)
    base = [f"w{x}" for x in r.integers(0, 5000, 120)]
    passage = " ".join(f"p{i}" for i in range(60))
    docs = []
    for i in range(60):  # near copies of one text, at all distances
        w = list(base)
        for at in r.integers(0, 120, int(r.integers(0, 6))):
            w[at] = f"n{i}x{at}"
        docs.append((i * 3 + 1, " ".join(w)))
    docs += [(500 + i, passage + " " + " ".join(f"o{x}" for x in r.integers(0, 10**6, 12 + i))) for i in range(40)]
    docs += [(600, "a b"), (601, "A  b"), (602, "b a"), (603, None), (604, " "), (605, docs[0][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"], x["n_links"]) for x in ngram_join.join(df, width=4, percent=85).collect()}
    assert got == brute_components(docs, 4, 85)


def test_divide_skip_equals_all_pairs():
    r = np.random.default_rng(9)
    base = np.unique(r.integers(0, 10**9, 80))
    sets = sorted((np.unique(np.concatenate([r.permutation(base)[:int(r.integers(50, 80))], r.integers(0, 10**9, int(r.integers(0, 9)))])) for _ in range(90)), key=len)
    for same, other in ((True, sets), (False, sets[::2])):
        got = {(q, int(c)) for q, cand in ngram_join.divide_skip(sets, other, 80, same) for c in cand}
        want = {(a, b) for a, x in enumerate(sets) for b, y in enumerate(other) if (b < a or not same)
                and 100 * len(np.intersect1d(x, y)) >= 80 * len(np.union1d(x, y))}
        assert got == want and want


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 150), (7, 7)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 150: 100, 200: 100}


# -- personal data

STRICT = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
          "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(s):
    d = [int(c) for c in reversed(s) if c in "0123456789"]
    return 12 <= len(d) <= 19 and sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(d)) % 10 == 0


def base_spans(text):
    ok = {"email": lambda s: True, "ip": lambda s: all(int(x) <= 255 for x in s.split(".")), "card": luhn,
          "phone": lambda s: 9 <= sum(c in "0123456789" for c in s) <= 15}
    return [f"{k}:{s}:{e}" for s, _, e, k in sorted((m.start(), list(STRICT).index(k), m.end(), k) for k, p in STRICT.items()
                                                    for m in re.finditer(p, text or "") if ok[k](m.group()))]


TRICKY = ["a@b.c._x@y.z é🙂 +1 (555) 555-1234, 1.2.3.4.5.6.7.8 4111 1111 1111 1111-", "@" * 50 + "a.b@c..d@e.f", "1" * 3000,
          "a" * 3000 + "@" + "b." * 3000 + "c", "+1 " * 3000, "0.0.0.0 256.1.1.1 001.002.003.0255 1.1.1.1", "1-1-1-1-1-1 1 1 1 1 1 1 1 1 +1-1",
          "+1.1.1.1.1.1.1.1.1)", "🙂+4 20 30 40 50", "call me: (743) 555-3824", "mail: joe (at) example (dot) com"]


def test_base_spans_and_added_ones(spark, docs, tmp_path):
    rows = [(d["doc_id"], d["text"]) for d in docs] + [(10_000 + i, t) for i, t in enumerate(TRICKY)] + [(None, "x@y.z"), (20_000, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in QUERIES["op7_pii"](spark, str(tmp_path)).collect()}
    for i, t in rows:
        want, r = base_spans(t), got[i]
        assert r["base_sha256"] == sha(",".join(want))
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(x.startswith(k) for x in want) for k in pii.KINDS]
        assert set(want) <= set(r["spans"].split(",")) | {""}
    assert "phone:9:23" in got[10_009]["spans"] and "email:6:" in got[10_010]["spans"]


def test_em_finds_the_unreliable_labeler():
    r = np.random.default_rng(2)
    counts = Counter()
    for _ in range(4000):
        y = r.random() < 0.4
        vote = lambda good: int(1 if (y if r.random() < good else not y) else -1)  # noqa: B023, E731
        counts[(vote(0.95), vote(0.9), vote(0.55), vote(0.9), 0)] += 1
    prior, table, _ = pii.reliabilities(sorted(counts.items()))
    assert prior == pytest.approx(0.4, abs=0.05)
    assert table[0][1][1] > 0.9 and table[2][1][1] < 0.65


# -- decontamination beyond the SQL test

def test_hits_of_short_repeated_and_absent_items(spark):
    docs = [(1, "x " + PROSE.upper() + " y"), (2, "one, TWO. one two three"), (3, None), (4, "nothing here at all"), (None, "one two")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(5, PROSE), (6, "one two"), (6, "one two"), (7, "..."), (8, None)], "item_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in decontaminate.hits(d, b).collect()}
    n = len(PROSE.split())
    assert got == {1: (n + 2, n, ["5"]), 2: (5, 4, ["6"]), None: (2, 2, ["6"])}
    assert decontaminate.hits(d, b.limit(0)).count() == 0


def test_shuffled_benchmark_gives_the_same(spark, monkeypatch):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    b = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = sorted(map(str, decontaminate.hits(d, b).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert sorted(map(str, decontaminate.hits(d, b).collect())) == want and want


# -- byte-level BPE

def test_bpe_equals_the_library(spark, docs):
    import random

    import tiktoken
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.vocabulary(public_tokenizers.path(bpe.RANKS)), special_tokens={})
    r = random.Random(5)
    texts = [d["text"] for d in docs] + ODD + ["".join(r.choice("abc") for _ in range(9000)), "ing" * 3000, "=" * 1777, "".join(chr(r.randrange(32, 0x2FFF)) for _ in range(6000))]
    e = bpe.Encoder(public_tokenizers.path(bpe.RANKS), public_tokenizers.PATTERN, kept_words=2000)
    at = 0
    for block in bpe.blocks(texts, 50_000):
        ids, n = e.encode(block)
        for t, part in zip(block, np.split(ids, np.cumsum(n)[:-1])):
            assert part.tolist() == enc.encode_ordinary(t)
        at += len(block)
    assert at == len(texts)
    got = {x["doc_id"]: x for x in QUERIES["op9_bpe"](spark, SF).collect()}
    for d in docs:
        ids = enc.encode_ordinary(d["text"])
        assert (got[d["doc_id"]]["n_tokens"], got[d["doc_id"]]["ids_sha256"]) == (len(ids), sha(" ".join(map(str, ids))))
        assert got[d["doc_id"]]["decoded_sha256"] == sha(d["text"])
    some = bpe.encode(spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string"))
    assert {r["doc_id"]: bytes(r["decoded"]) for r in bpe.decode(some).collect()} == {1: b"some words", 2: b""}


def test_replay_equals_one_merge_at_a_time():
    ranks = {bytes([i]): i for i in range(256)} | {b"bc": 256, b"abc": 257, b"aa": 258, b"ab": 259, b"aab": 260, b"ca": 261, b"abca": 262, b"bb": 263}
    m = bpe.MergeReplay(ranks)
    r = np.random.default_rng(1)
    words = [bytes(r.choice(list(b"abc"), int(r.integers(1, 30))).tolist()) for _ in range(400)]
    ids, n = m.replay(words)
    for w, part in zip(words, np.split(ids, np.cumsum(n)[:-1])):
        assert part.tolist() == ([ranks[w]] if w in ranks else m.one_by_one(w))


# -- quality rules

def counted(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    hit = {j for i in range(len(w) - 7) if grams[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


def test_statistics_by_brute_force(spark, docs):
    texts = [(d["doc_id"], d["text"]) for d in docs] + [(-1 - i, d[1]) for i, d in enumerate(edge_documents())]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    names = quality_rules.COUNTS[:5]
    got = {r["doc_id"]: tuple(r[c] for c in names) for r in quality_rules.statistics(df).collect()}
    assert got == {i: counted(t) for i, t in texts}


def test_rules_reject_junk_and_keep_the_rest(spark):
    sf = "/root/testdata/sf0.1"
    x, bad = quality_rules.labelled(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    half = len(x) // 2
    rules = quality_rules.learn(x[:half], bad[:half])
    rejected = np.zeros(len(x) - half, dtype=bool)
    for rule in rules:
        rejected |= quality_rules.covers(rule, x[half:])
    truth = bad[half:]
    assert rules and rejected[truth].mean() >= 0.95 and rejected[~truth].mean() <= 0.005
    shares = spark.createDataFrame([tuple(map(float, r)) for r in x[:200]], ", ".join(f"{n} double" for n, _, _ in quality_rules.SHARES))
    assert quality_rules.learn(x[:0], bad[:0]) == [] and shares.count() == min(200, len(x))


def test_wrapped_headers_are_found(spark):
    """Hard-wrapped headers with comment marks, owners and code around them, not copies of the notices; common cue lines weigh little."""
    gpl = """{0} frobnicate.c - turn knobs
{0} Copyright (C) 2011, 2014 Jane Doe
{0}
{0} This {1} is free software; you can redistribute it and/or modify it under
{0} the terms of the GNU {2} as published by the Free
{0} Software Foundation; either version {3} of the License, or (at your
{0} option) any later version.
{0}
{0} It is distributed in the hope that it will be useful, but WITHOUT ANY
{0} WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS
{0} FOR A PARTICULAR PURPOSE.  See the GNU {2} for more details.
x = {3}9
"""
    isc = "/*\n * Copyright (c) 2009 J. Doe\n *\n * Permission to use, copy, modify, and distribute this software for\n * any purpose with or without fee is hereby\n * granted, provided that the above notices appear.\n */\nint x;"
    mpl = "// This Source Code Form is subject to the terms of\n// the Mozilla Public License, v. 2.0. If a copy of\n// the MPL was not distributed with this file, You can\n// obtain one at http://mozilla.org/MPL/2.0/.\nint y;"
    mit = "# Permission is hereby\n# granted, free of charge, to any person obtaining a copy\n# of this software and associated documentation\n# files (the Software), to deal in it without restriction\nz = 1"
    want = [("GPL-2.0", gpl.format("#", "program", "General Public License", "2")), ("GPL-3.0", gpl.format("//", "program", "General Public License", "3")),
            ("LGPL-2.1", gpl.format(" *", "library", "Lesser General Public License", "2.1")), ("AGPL-3.0", gpl.format("--", "program", "Affero General Public License", "3")),
            ("MPL-2.0", mpl), ("ISC", isc), ("MIT", mit), (None, "# See the GNU General Public License for more details.\n"), (None, "# GNU GENERAL PUBLIC LICENSE\n")]
    lines = ["Licensed under the Apache License, Version 2.0."] * 160 + ["Released under the MIT License."] * 100 + ["All rights reserved."] * 70 + [
        "This work is licensed under the GNU General Public License, version 3."] * 90
    rows = [(i, f"{i}/x", t) for i, (_, t) in enumerate(want)] + [(i + 100, f"{i + 100}/x", t) for i, t in enumerate(lines)]
    got = {r["id"]: r["license"] for r in license_scan.scan(spark.createDataFrame(rows, "id long, p string, t string"), "id", "p", "t").collect()}
    assert [got[i] for i in range(len(want))] == [x for x, _ in want]


def test_whole_licence_files_and_tags(spark):
    """Whole texts and their titles, and SPDX tags listed or not, beside many copies of a few cue lines."""
    full = dict(license_scan.FULL)
    changed = lambda name: "Copyright 2020 Some Owner, see also the file AUTHORS\n\n" + full[name].replace("  ", " ").replace("Everyone", "Anyone")
    title = "\n          GNU GENERAL PUBLIC LICENSE\n             Version 2, June 1991\n"
    want = [(n, f"{n}/LICENSE", changed(n)) for n in sorted(full)]
    want += [(None, "t/COPYING", "GNU GENERAL PUBLIC LICENSE"), ("GPL-2.0-or-later", "a.c", "// SPDX-License-Identifier: GPL-2.0-or-later\nint x;"),
             ("LGPL-2.1-or-later", "b.c", "/* SPDX-License-Identifier: LGPL-2.1-or-later */"), ("BSD-2-Clause", "c.c", "# spdx-license-identifier: BSD-2-Clause"),
             ("MIT", "d.c", "# SPDX-License-Identifier: mit"), ("GPL-3.0", "e.c", "SPDX-License-Identifier: GPL-3.0-or-later"),
             ("(MIT OR Apache-2.0)", "f.c", "SPDX-License-Identifier: (MIT OR Apache-2.0)."), ("Zlib", "g.c", "SPDX-License-Identifier: Zlib and more"),
             ("GPL-2.0", "u/COPYING", title + full["GPL-2.0"][300:])]
    lines = ["Licensed under the Apache License, Version 2.0."] * 160 + ["Released under the MIT License."] * 100 + ["All rights reserved."] * 70 + [
        "This work is licensed under the GNU General Public License, version 3."] * 90
    rows = [(i, p, t) for i, (_, p, t) in enumerate(want)] + [(i + 100, f"{i + 100}/x", t) for i, t in enumerate(lines)]
    got = {r["id"]: r["license"] for r in license_scan.scan(spark.createDataFrame(rows, "id long, p string, t string"), "id", "p", "t").collect()}
    assert [got[i] for i in range(len(want))] == [x[0] for x in want]


def test_related_licences_are_told_apart(spark):
    """Each family's headers beside each other: names and numbers are bound, unknown versions have no licence."""
    def grant(name, version):
        return (f"This program is free software; you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation; "
                f"either version {version} of the License, or (at your option) any later version.")
    general, lesser, library, affero = "General Public License", "Lesser General Public License", "Library General Public License", "Affero General Public License"
    full = {n: t for n, t in license_scan.NOTICES}
    cc = "This work is licensed under a Creative Commons Attribution{} {} International License."
    bsd2, bsd3 = full["BSD-2-Clause"], full["BSD-3-Clause"]
    want = [("GPL-1.0", grant(general, "1")), ("GPL-2.0", grant(general, "2")), ("GPL-3.0", grant(general, "3")), (None, grant(general, "4")), (None, grant(general, "2.1")),
            ("LGPL-2.0", grant(library, "2")), ("LGPL-2.1", grant(lesser, "2.1")), ("LGPL-3.0", grant(lesser, "3")), ("AGPL-3.0", grant(affero, "3")), (None, grant(affero, "1")),
            ("GPL-1.0", grant(general, "1") + " Report within 2 days."), ("GPL-2.0", grant(general, "2") + " Library version 3 is not free."),
            ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of version 2 of the GNU General Public License as published by the Free Software Foundation."),
            ("Apache-2.0", license_scan.APACHE_GRANT), (None, license_scan.APACHE_GRANT.replace("2.0", "1.1") + " Chapter 2."),
            ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
            (None, "This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1. Part 2."),
            ("BSD-2-Clause", "BSD License\n" + bsd2), ("BSD-3-Clause", "BSD License\n" + bsd3), ("BSD-2-Clause", "BSD 2-Clause License\n" + bsd2),
            ("CC-BY-4.0", cc.format("", "4.0")), ("CC-BY-SA-4.0", cc.format("-ShareAlike", "4.0")), ("CC-BY-NC-4.0", cc.format("-NonCommercial", "4.0")),
            ("CC-BY-ND-4.0", cc.format("-NoDerivatives", "4.0")), ("CC-BY-NC-SA-4.0", cc.format("-NonCommercial-ShareAlike", "4.0")),
            ("CC-BY-NC-ND-4.0", cc.format("-NonCommercial-NoDerivatives", "4.0")), (None, cc.format("", "3.0")), (None, cc.format("-NonCommercial", "2.5")),
            ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0, with CC BY 3.0 parts."), ("CC-BY-ND-4.0", cc.format("-NoDerivatives", "4.0") + " Attribution 4.0")]
    rows = [(i, f"{i}/x", t) for i, (_, t) in enumerate(want)]
    got = {r["id"]: r["license"] for r in license_scan.scan(spark.createDataFrame(rows, "id long, p string, t string"), "id", "p", "t").collect()}
    assert [(i, got[i]) for i in range(len(want))] == [(i, x) for i, (x, _) in enumerate(want)]
    names = {n for n, _ in license_scan.NOTICES}
    assert names == set(license_scan.MUST)
    guards = {n: re.compile("(?s)" + g.replace("*+", "*").replace("}+", "}")) for n, g in license_scan.MUST.items()}
    for name, text in license_scan.NOTICES:  # a notice's own licence, and no other one of a family by versions
        if len(text) < 3000 and "-style" not in text and text != license_scan.BSD_GRANT:
            said = {n for n, g in guards.items() if g.match(text.lower())} - {"MIT", "ISC"}
            assert said <= {name} and (said or name in ("MIT", "ISC")), (name, said, text)


def test_unrecognised_licence_file_is_the_nearest(spark):
    """Files under a licence file of unknown terms do not take the licence of a farther one; blank ones and sources are no licence files."""
    files = [("r/LICENSE", "Released under the MIT License."), ("r/a/LICENSE", "Our own terms: ask us first."), ("r/a/x.txt", "prose"), ("r/a/b/y.txt", None),
             ("r/a/COPYING", "More terms of our own."), ("r/c/LICENSE", " \n"), ("r/c/z.txt", "prose"), ("r/d/license.py", "import this"), ("r/d/w.txt", "prose"),
             ("r/a/b/h.txt", "Released under the MIT License."), ("r/NOTICE", "We thank all."), ("r/a/c/LICENSE", "Released under the MIT License."), ("r/a/c/v.txt", "")]
    df = spark.createDataFrame([(i, *f) for i, f in enumerate(files)], "id long, p string, t string")
    got = {r["id"]: (r["license"], r["origin"], r["from_path"]) for r in license_scan.scan(df, "id", "p", "t").collect()}
    near, far = "r/a/COPYING", ("MIT", "inherited", "r/LICENSE")
    assert got == {0: ("MIT", "file", "r/LICENSE"), 1: (None, "file", "r/a/LICENSE"), 2: (None, "inherited", near), 3: (None, "inherited", near), 4: (None, "file", near),
                   5: far, 6: far, 7: far, 8: far, 9: ("MIT", "header", "r/a/b/h.txt"), 10: far, 11: ("MIT", "file", "r/a/c/LICENSE"), 12: ("MIT", "inherited", "r/a/c/LICENSE")}


def test_repeated_and_missing_ids_keep_their_links(spark):
    """Two texts of one id with equally many shingles each link with their own near copy, and a chain runs through a row without id."""
    def near(tag, *changed):
        return " ".join(f"{tag}{'x' if i in changed else ''}{i}" for i in range(60))
    docs = [(5, near("a")), (5, near("b")), (7, near("a", 59)), (8, near("b", 59)),
            (21, near("c")), (None, near("c", 59)), (23, near("c", 0, 1, 59)), (None, near("d"))]
    got = [(x["doc_id"], x["component_id"], x["n_links"]) for x in ngram_join.join(
        spark.createDataFrame(docs, "doc_id long, text string"), width=4, percent=92).collect()]
    assert sorted(got, key=str) == sorted([(5, 5, 1), (5, 5, 1), (7, 5, 1), (8, 5, 1), (21, 21, 1), (None, 21, 2), (23, 21, 1), (None, None, 0)], key=str)


def test_common_template_makes_no_diagonals(spark, monkeypatch):
    """Documents and items with one opening of 12 words in common share no window: nothing is joined; a 13th word makes all of it hits."""
    opening = " ".join(f"open{i}" for i in range(12))
    seen = {}
    keep = decontaminate.stage
    monkeypatch.setattr(decontaminate, "stage", lambda df, name: seen.setdefault(name, keep(df, name)))
    tail = lambda tag, n: " ".join(f"{tag}{n}w{i}" for i in range(20))
    docs = [(n, f"{opening} {tail('d', n)}") for n in range(40)] + [(100, f"x {opening} i7w0 and more"), (101, "short one here"), (102, "a short one here, short ONE here")]
    items = [(n, f"{opening} {tail('i', n)}") for n in range(40)] + [(200, "short one here"), (201, "one"), (202, "short one"), (203, "here short")]
    got = {r["doc_id"]: (r["n_hit"], r["items"]) for r in decontaminate.hits(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {100: (13, ["7"]), 101: (3, ["200", "201", "202"]), 102: (6, ["200", "201", "202", "203"])}
    assert seen["found"].where("len = 13").count() == 1
