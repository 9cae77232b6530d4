"""Hard negatives, phrases and near duplicates: against DuckDB, brute force, and odd rows."""

import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from workpulse.llm import hard_negatives, near_dedup, phrases

from tests.llm.conftest import PROSE, edge_documents


# -- hard negatives

def brute_negatives(rows):
    """rows: (id, vector, label); positives 5, negatives 3, every second id is an anchor."""
    ok = [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab in rows if lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = []
    for n, (i, v, lab) in enumerate(ok):
        if i is None or i % 2:
            continue
        score = [(sum(a * b for a, b in zip(v, w)), j, other) for m, (j, w, other) in enumerate(ok) if m != n]
        for p in sorted((s for s in score if s[2] == lab), key=key)[:5]:
            hard = [s for s in sorted((s for s in score if s[2] != lab), key=key) if 50 * p[0] <= 100 * s[0] <= 95 * p[0]]
            out += [(i, p[1], k, s[1], p[0], s[0]) for k, s in enumerate(hard[:3], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [7, 4096])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", block)
    monkeypatch.setattr(hard_negatives, "STEP", 3)
    rng = np.random.default_rng(5)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.2, 16) + 0.1], int(i) % 4) for i in range(90)]
    rows += [(200, [0.5] * 16, 1)] * 3 + [(202, [], 1), (204, None, 1), (206, [0.5] * 16, None), (None, [0.4] * 16, 2),
             (208, [float("nan")] + [0.1] * 15, 0), (210, [float("inf")] + [0.1] * 15, 0), (212, [0.3] * 5, 0), (214, [None] + [0.1] * 15, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 AS row", "2 AS id", "3 AS score").repartition(3)
    got = hard_negatives.mine(df, every=2)
    cols = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    assert sorted((tuple(r[c] for c in cols) for r in got.collect()), key=str) == brute_negatives(rows)


def test_anchor_slices_cover_all_anchors(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 8)], i % 3) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    whole = sorted(map(tuple, hard_negatives.mine(df, every=5).collect()))
    monkeypatch.setattr(hard_negatives, "SLICE_BYTES", 400)
    assert sorted(map(tuple, hard_negatives.mine(df, every=5).collect())) == whole


def test_scores_beyond_exact_doubles():
    x = np.array([[2**23, 2**23 - 1, 3]] * 8, dtype=np.int32)
    b = hard_negatives.Block(3, 8, *(np.arange(3, dtype=np.int64).tobytes() for _ in range(3)), x.tobytes())
    anchor = np.full(8, 2**24 - 1, dtype=np.int32)
    rows, score = hard_negatives.scan(b, anchor, np.ones(3, dtype=bool), lambda low, high: high >= low)
    assert score.tolist() == [8 * (2**24 - 1) * int(v) for v in (2**23, 2**23 - 1, 3)]


def test_hard_negatives_of_an_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.mine(df).collect() == []


# -- phrases

def brute_phrases(docs, least, top):
    out = []
    for lang in {d[1] or "und" for d in docs}:
        f = Counter()
        for text, own in docs:
            if (own or "und") == lang:
                for piece in re.split(r"[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
                    w = re.findall(r"[^\x20\x09]+", piece)
                    f.update(tuple(w[i:i + k]) for k in range(1, 6) for i in range(len(w) - k + 1))
        n = sum(c for p, c in f.items() if len(p) == 1)
        cand = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        rows = []
        for p, a in cand.items():
            if any(c >= a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, c in cand.items() if len(q) > len(p)):
                continue
            score, _, left, right = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, r, p.decode(), -a, left, right, n, -s) for r, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("at_once", [50, 2_000_000])
def test_phrases_equal_brute_force(spark, monkeypatch, at_once):
    monkeypatch.setattr(phrases, "BYTES_AT_ONCE", at_once)
    monkeypatch.setattr(phrases, "MIN_BITS", 15)
    rng = np.random.default_rng(2)
    vocab = ["the", "of", "new york", "new", "york", "state", "É", "é", "日本", "a\x00b", "A"]
    docs = [(" ".join(rng.choice(vocab, int(rng.integers(0, 40)))) + rng.choice([".", ",", "\n", "\t \t", ""]) + " one two  three\tfour five six", [None, "en", "de"][i % 3]) for i in range(120)]
    docs += [(None, "en"), ("", None), (" \t\n;", "en"), ("x " * 3000, "fr"), ("one two three four five six", "en"), ("one two three four five six", "en")]
    df = spark.createDataFrame(docs, "text string, lang string").selectExpr("*", "1 AS run", "2 AS n", "3 AS words").repartition(4)
    got = [tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in phrases.mine(df, least=5, top=30).collect()]
    assert sorted(got) == brute_phrases(docs, 5, 30)


def test_phrases_graph_holds_frequent_runs_only(spark, monkeypatch):
    """All pairs are frequent here and hardly a triple is: the graph has the words, pairs and few more, not a row for each place."""
    rows = {}
    staged = phrases.stage
    monkeypatch.setattr(phrases, "stage", lambda df, name: rows.setdefault(name, staged(df, name)))
    rng = np.random.default_rng(7)
    vocab = np.array([f"w{i}" for i in range(25)])
    docs = [(" ".join(vocab[rng.integers(0, 25, 400)]) + f" only{i} once{i}", "en") for i in range(40)] + [("a b c d e f, a b c d", "en")] * 9
    got = phrases.mine(spark.createDataFrame(docs, "text string, lang string").repartition(3), least=9, top=50).collect()
    assert sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in got) == brute_phrases(docs, 9, 50)
    assert rows["graph"].count() < 2_000


def test_phrases_of_an_empty_table(spark):
    assert phrases.mine(spark.createDataFrame([], "text string, lang string")).collect() == []


# -- near duplicates

def test_sequential_test_keeps_similar_pairs():
    least = near_dedup.least_matches(80)
    assert least == sorted(least) and least[-1] < 0.8 * near_dedup.HASHES
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**32, (4000, near_dedup.HASHES), dtype=np.uint32)
    for share, kept in ((0.8, 1.0), (0.3, 0.0)):
        y = np.where(rng.random(x.shape) < share, x, x + np.uint32(1))
        assert abs(len(near_dedup.survives(x, y, least)) / len(x) - kept) < 0.01


def test_minhashes_estimate_the_similarity():
    rng = np.random.default_rng(4)
    a = rng.integers(0, 2**63, 400).astype(np.uint64)
    b = np.concatenate([a[:360], rng.integers(0, 2**63, 40).astype(np.uint64)])
    sig = near_dedup.minhashes(np.concatenate([np.sort(a), np.sort(b)]), np.array([400, 400]))
    assert abs((sig[0] == sig[1]).mean() - 360 / 440) < 0.12


def near_sql(spark, rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    return sorted(con.execute(f"SELECT doc_id, n_shingles, component_id, kept FROM ({near_dedup.OP13_SQL})").fetchall())


@pytest.mark.parametrize("rounds,block", [(0, 4), (1, 512), (2, 8)])
def test_groups_of_near_copies_equal_sql(spark, monkeypatch, rounds, block):
    """Copies that differ in one word each link with the original but not with one another; chains; unlike texts."""
    monkeypatch.setattr(near_dedup, "ROUNDS", rounds)
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    base = [f"w{i}" for i in range(45)]
    rows = [(1000, " ".join(base)), (1001, " ".join(base))]
    for i in range(1, 40):
        rows.append((i, " ".join(base[:i] + [f"x{i}"] + base[i + 1:])))
    for i in range(30):  # a chain: each shares most with the next
        rows.append((2000 + i, " ".join(f"c{j}" for j in range(i * 2, i * 2 + 40))))
    for i in range(20):  # share a band now and then, link with nothing
        rows.append((3000 + i, " ".join([f"b{j}" for j in range(30)] + [f"u{i}_{j}" for j in range(12)])))
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS cls", "2 AS sig", "3 AS bucket").repartition(4)
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in near_dedup.dedup(df, width=4).collect())
    assert got == near_sql(spark, rows)


def test_near_duplicates_of_odd_rows(spark, edge_dir, empty_dir):
    rows = near_dedup.op13_near_dedup(spark, edge_dir).collect()
    docs = edge_documents()
    assert len(rows) == len(docs)
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"], r["kept"]))
    assert by[1] == by[2] == [(0, 1, True)] or by[1] == [(0, 1, True)] and by[2] == [(0, 2, True)]
    assert len(by[6]) == 2 and set(by[6]) == {(len(PROSE.split()) - 3, 6, True)} and by[7][0][1:] == (6, False)
    assert {x[1:] for x in by[None]} == {(6, False), (None, True)}
    assert {x[1] for x in by[8]} == {6} and by[-3] == [(1, -3, True)] and by[51] == [(1, -3, False)]
    assert near_dedup.op13_near_dedup(spark, empty_dir).collect() == []
