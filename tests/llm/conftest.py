import pytest

#: Names that the operators use inside; inputs may have them as extra columns.
CLASHING = ["row", "shard", "size", "n_words", "kept", "hashes", "s1", "cls", "w", "g", "fp", "ids", "path", "license", "start", "end", "kind",
            "n", "item", "base", "_t", "_w", "gone", "score", "copies", "law", "rule", "id", "unit"]

LONG = " ".join(f"word{i % 977}x{i}" for i in range(12_000))
PROSE = "the quick brown fox jumps over the lazy dog while seven more foxes watch from the edge of a quiet green field near town"


def edge_documents():
    """(doc_id, text, lang, source): nulls, empty and very long texts, ties, repeated rows and ids."""
    return [
        (1, None, None, None), (2, "", "en", "a"), (3, " \t\n\r\n ", "en", "a"), (4, LONG, "en", "a"), (5, "a" * 60_000, "en", "b"),
        (6, PROSE, "en", "b"), (6, PROSE, "en", "b"), (7, PROSE, None, "b"), (None, PROSE, "en", "c"), (None, None, None, None),
        (8, PROSE + " and back", "en", "c"), (8, "Another text under the same id, long enough to count as a line.", "en", "c"),
        (9, "Shared line of some length\nshared LINE of some length \nown line number nine here", "en", "c"),
        (10, "\tShared line of some length\x0b\nßÉ İ own line number ten", "de", "c"),
        (11, "mail joe.x@example.com, 10.0.0.1, +1 (555) 555-0100, 4111 1111 1111 1111\n🙂 b@c.d 256.1.1.1", "en", "c"),
        (12, "\x00 <|endoftext|> <s> ▁▁ é̀ 日本語テキスト 🙂🙂", "en", "c"), (13, "no no no no no no no no no no no no no no no no no no no no no no", "en", "c"),
        (14, "Released under the MIT License.\nof words", "en", "c"), (-3, "one two", "fr", "c"), (50, "Licensed under CC BY-NC 4.0.", "en", "c"),
        (51, "one two", "fr", "c"),
    ]


def write(spark, path, documents, benchmark=(), labels=(), extra=True):
    docs = spark.createDataFrame([(*d, len(d[1] or "")) for d in documents], "doc_id long, text string, lang string, source string, n_chars long")
    if extra:
        for c in CLASHING:
            docs = docs.selectExpr("*", f"'x' AS `{c}`")
    docs.coalesce(2).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(benchmark), "item_id long, text string").selectExpr("*", "1 AS w", "2 AS item", "3 AS m").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").selectExpr("*", "1 AS h", "2 AS text").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").selectExpr("*", "1 AS row", "2 AS x").write.parquet(f"{path}/embeddings.parquet")
    return str(path)


@pytest.fixture(scope="session")
def edge_dir(spark, tmp_path_factory):
    items = [(1, PROSE), (1, PROSE), (2, "one two"), (3, None), (4, ""), (None, "own line number ten"), (10, "İ")]
    labels = [(6, 1, 0), (6, 0, 0), (7, None, 0), (None, 1, 0), (4, 1, 1), (4, 1, 1)]
    return write(spark, tmp_path_factory.mktemp("edge"), edge_documents(), items, labels)


@pytest.fixture(scope="session")
def empty_dir(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("empty"), [])
