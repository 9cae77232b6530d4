"""A training-data pipeline over ``documents``: five stages, each written before the next one reads it.

Each stage function takes (spark, docs, sf_dir) and returns a DataFrame; all
but the last return the columns of ``documents`` (any further columns of the
input are carried along, whatever their names). Null and empty texts, repeated
rows and empty tables have the results that the operators define; a document
whose lines all go stays as an empty text, so that every stage's output can be
held against its input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workpulse.llm import bpe, decontaminate, line_dedup, ngram_join, quality_rules
from workpulse.llm.common import small_ids, stage, table

#: Near duplicates of the pipeline: words of a shingle, and least Jaccard similarity in percent.
SHINGLE_WORDS, SIMILARITY = 5, 80


def packed(docs: DataFrame, *cols: str) -> DataFrame:
    """The whole row as one column, so that no name clashes, beside the columns that an operator reads."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), *cols)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the learned decision list keep."""
    judged = quality_rules.judge(packed(docs, "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "quality"))
    return judged.where("kept").select("_doc.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that a smaller document id holds."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    side = F.struct(*[F.col(f"`{c}`") for c in rest]) if rest else F.struct(F.lit(0).alias("none"))
    out = line_dedup.dedup_lines(docs.select("doc_id", "text", side.alias("_doc")), keep=("_doc",))
    new = {"doc_id": F.col("doc_id"), "text": F.col("kept"), "n_chars": F.char_length("kept").cast("long")}
    return out.select(*[new.get(c, F.col("_doc").getField(c)).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id, once.

    Documents go by id and text: another text under the same id is another
    document. Of texts that differ in case or white space only, under one
    id, the one with the smallest hash stays. Documents without id cannot be
    told apart and stay.
    """
    groups = stage(ngram_join.representatives(docs, width=SHINGLE_WORDS, percent=SIMILARITY), "groups")
    gone = stage(groups.where("NOT stays").select("doc_id", "row").distinct(), "gone")
    mine = F.when(F.col("label").isNull(), F.col("row")).alias("blank")  # texts without words are alike only if equal
    again = stage(groups.where("stays AND doc_id IS NOT NULL").groupBy("doc_id", "label", mine).agg(
        F.min("row").alias("row"), F.max("row").alias("last"), F.count("*").alias("rows")).where("rows > 1").select("doc_id", "label", "row", "last"), "again")
    rows = packed(docs, "doc_id", F.xxhash64("text").alias("row"))
    stay = rows.join(small_ids(gone), ["doc_id", "row"], "left_anti")
    if not again.isEmpty():  # copies under one id: one of them
        least = again.where("row != last").select("doc_id", "label", F.col("row").alias("least"))
        copies = groups.where("stays").join(least, ["doc_id", "label"]).where("row != least").select("doc_id", "row").distinct()
        stay = stay.join(copies, ["doc_id", "row"], "left_anti")
        once = again.select("doc_id", "row")
        stay = stay.join(once, ["doc_id", "row"], "left_anti").unionByName(stay.join(once, ["doc_id", "row"], "left_semi").dropDuplicates(["doc_id", "row"]))
    return stay.select("_doc.*")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark passages."""
    found = decontaminate.hits(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))
    bad = stage(found.where(decontaminate.contaminated()).select("doc_id", "row"), "contaminated")
    rows = packed(docs, "doc_id", F.xxhash64("text").alias("row"))
    return rows.alias("d").join(bad.alias("b"), decontaminate.same_row("d", "b"), "left_anti").select("_doc.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids and whether the decoded ids give the text back."""
    rows = docs.select("doc_id", "lang", "source", "text", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("_sha"))
    out = bpe.encode(rows, keep=("lang", "source", "_sha"), back=True)
    return out.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
                      (F.sha2("decoded", 256) == F.col("_sha")).alias("round_trip"))


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("ngram_join", near_duplicates),
    ("decontamination", decontaminated),
    ("byte_bpe", tokens),
]

#: SQL can express neither the learned decision list nor byte-pair encoding; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
