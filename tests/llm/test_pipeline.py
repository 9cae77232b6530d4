"""The pipeline's stages, each held against brute force on its own input."""

import public_tokenizers
import tiktoken

import corpus_pipeline as C
from workpulse.llm import bpe, quality_rules
from workpulse.llm.common import stage

from tests.llm.conftest import CLASHING, PROSE, edge_documents
from tests.llm.test_brute_force import brute_components, counted, kept_lines

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rules = quality_rules.learn(*quality_rules.labelled(docs, labels))
    before = {r["doc_id"]: r["text"] for r in docs.collect()}

    out = stage(C.quality(spark, docs, SF), "t")
    assert out.columns == COLUMNS
    after = {r["doc_id"]: r["text"] for r in out.collect()}
    for i, t in before.items():
        n_words, _, _, _, n_repeat = counted(t)
        failed = n_words < 20 or 100 * n_repeat > 30 * n_words
        assert (i in after) <= (not failed)
        if not failed and not rules:
            assert i in after
    docs, before = out, after

    out = stage(C.lines(spark, docs, SF), "t")
    rows = out.collect()
    assert out.columns == COLUMNS and {r["doc_id"]: r["text"] for r in rows} == kept_lines(list(before.items()))
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    docs, before = out, {r["doc_id"]: r["text"] for r in rows}

    out = stage(C.near_duplicates(spark, docs, SF), "t")
    comps = brute_components(list(before.items()), C.SHINGLE_WORDS, C.SIMILARITY)
    assert out.columns == COLUMNS and {r["doc_id"] for r in out.collect()} == {c for _, c, _ in comps.values()}
    docs, before = out, {r["doc_id"]: r["text"] for r in out.collect()}

    import re
    items = [re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m.group().lower(), r["text"])) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    spans = {tuple(w[i:i + 13]) for w in items if len(w) >= 13 for i in range(len(w) - 12)}
    out = stage(C.decontaminated(spark, docs, SF), "t")
    clean = set()
    for i, t in before.items():
        w = re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m.group().lower(), t))
        hit = {j for k in range(len(w) - 12) if tuple(w[k:k + 13]) in spans for j in range(k, k + 13)}
        if not hit or 20 * len(hit) < len(w):
            clean.add(i)
    assert out.columns == COLUMNS and {r["doc_id"] for r in out.collect()} == clean and len(clean) < len(before)

    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.vocabulary(public_tokenizers.path(bpe.RANKS)), special_tokens={})
    last = C.tokens(spark, out, SF).collect()
    assert {r["doc_id"] for r in last} == clean
    assert all(r["round_trip"] and r["ids"] == enc.encode_ordinary(before[r["doc_id"]]) and r["n_tokens"] == len(r["ids"]) for r in last)


def test_odd_rows_and_clashing_names(spark, edge_dir):
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    assert docs.columns == [*COLUMNS, *CLASHING]
    for name, f in C.STAGES[:-1]:
        out = f(spark, docs, edge_dir)
        assert out.columns == docs.columns, name
        assert all(r["unit"] == "x" and r["row"] == "x" for r in out.collect()), name
    key = lambda r: (r["doc_id"], r["text"])
    near = [key(r) for r in C.near_duplicates(spark, docs, edge_dir).collect()]
    assert near.count((6, PROSE)) == 1 and (7, PROSE) not in near and near.count((-3, "one two")) == 1 and (51, "one two") not in near
    assert (None, None) in near and (None, PROSE) in near and (1, None) in near and (2, "") in near
    assert [t for i, t in near if i == 8] == ["Another text under the same id, long enough to count as a line."]  # its other text is near 6
    clean = [key(r) for r in C.decontaminated(spark, docs, edge_dir).collect()]
    assert (6, PROSE) not in clean and (None, PROSE) not in clean and (-3, "one two") not in clean and (9, edge_documents()[12][1]) in clean
    assert sorted(map(str, (r["doc_id"] for r in C.lines(spark, docs, edge_dir).collect()))) == sorted(str(d[0]) for d in edge_documents())
    assert len(C.run(spark, edge_dir).collect()) > 0


def test_near_duplicates_go_by_id_and_text(spark):
    """Unlike texts under one id are documents of their own; equal rows and near copies go, whatever the partitions."""
    def near(tag, *changed):
        return " ".join(f"{tag}{'x' if i in changed else ''}{i}" for i in range(60))
    docs = [(5, near("a")), (5, near("b")), (5, near("a")), (7, near("a", 59)), (8, near("b", 59)), (9, near("c")), (9, near("c").upper()), (9, near("c")),
            (4, near("d", 0)), (4, near("d")), (11, near("d")), (12, ""), (12, ""), (12, " "), (13, None), (13, None), (None, near("a")), (None, near("a"))]
    for n in (1, 5):
        df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS row", "1 AS label").repartition(n)
        got = sorted(((r["doc_id"], r["text"]) for r in C.near_duplicates(spark, df, SF).collect()), key=str)
        nine = [t for i, t in got if i == 9]
        assert len(nine) == 1 and nine[0].lower() == near("c")
        four = [t for i, t in got if i == 4]
        assert len(four) == 1 and four[0] in (near("d"), near("d", 0))
        rest = [(5, near("a")), (5, near("b")), (12, ""), (12, " "), (13, None), (None, near("a")), (None, near("a"))]
        assert [k for k in got if k[0] not in (9, 4)] == sorted(rest, key=str)
