"""Copy-paste detection: per-task TF-IDF cosine of today's comment against each past comment.

Relational form of the vectoriser defaults (raw term counts,
``idf = ln((1 + n) / (1 + df)) + 1``, L2-normalised rows) where the corpus is
*one task's* comments, so the global ``pyspark.ml`` IDF does not apply.

Shape of the plan (no collect):
  * texts are cleaned and tokenised once, into a stage table;
  * keys of at most ``SMALL_KEY`` tokens, all their texts together, take one exchange: each becomes one bounded row, and
    ``score_rows`` works out a block of them at a time; exact by SHA-256 of the cleaned text;
  * keys above that stay spread by text and term: a text's words are counted in its own row, one row per (key, term) has
    its idf and its weight in today's text, and one join of a past text's terms gives both its norm and its dot product;
  * where only copies are asked for, a threshold search comes first: past texts meet today's heaviest terms only, and a
    text whose upper bound (``upper_bound``) stays below the threshold is never multiplied out;
  * every join of vectors pairs today's single vector with past vectors on (key, term): 1 x N per task, never N x N.
    AQE splits skewed join partitions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from workpulse.functions.text import clean_text, tokens
from workpulse.session import join_small, stage_table

#: Bounds and thresholds are compared with this slack, far above the rounding of the sums.
SLACK = 1e-9
#: Tokens of all texts of a key that may lie in one row.
SMALL_KEY = 2000
#: Rows of ``score_rows`` that are worked out together.
BLOCK = 1000


def term_counts(d: DataFrame, key: str) -> DataFrame:
    """``key, doc, term, tf`` (A10) with the doc's ``is_today``, ``n_tokens`` and ``n_terms``.

    Grouping on one struct asks for an exchange on all three: rows that already
    lie by key would otherwise be counted where they are, a hot key in one task.
    """
    words = d.select(key, "doc", "is_today", "n_tokens", "n_terms", F.explode("terms").alias("term"))
    return (words.groupBy(F.struct(key, "doc", "term").alias("g"))
            .agg(F.count(F.lit(1)).alias("tf"), *[F.max(c).alias(c) for c in ("is_today", "n_tokens", "n_terms")])
            .select("g.*", "tf", "is_today", "n_tokens", "n_terms"))


def row_counts(d: DataFrame, key: str) -> DataFrame:
    """``term_counts`` of texts whose (key, doc) does not repeat, without an exchange: ``terms`` is sorted, so equal words are a run.

    No text is empty here; the outer form keeps Spark from working out ``starts`` once more to look for empty ones.
    """
    run = lambda i: (i == 0) | (F.get("terms", i) != F.get("terms", i - 1))
    w = (d.where("n_tokens > 0").select(key, "doc", "is_today", "n_tokens", "terms")
         .withColumn("starts", F.filter(F.sequence(F.lit(0), F.col("n_tokens") - 1), run)))
    end = F.coalesce(F.get("starts", F.col("j") + 1), F.col("n_tokens"))
    return (w.select("*", F.size("starts").alias("n_terms"), F.posexplode_outer("starts").alias("j", "i"))
            .select(key, "doc", F.get("terms", F.col("i")).alias("term"), (end - F.col("i")).cast("long").alias("tf"), "is_today", "n_tokens", "n_terms"))


def vocabulary(counts: DataFrame, elig: DataFrame, key: str) -> DataFrame:
    """``key, term, idf, wt`` of the eligible keys; ``wt`` is the term's weight today, null if today's text lacks it."""
    held = counts.groupBy(key, "term").agg(F.count(F.lit(1)).alias("df"), F.max(F.when(F.col("is_today"), F.col("tf"))).alias("t_tf"))
    idf = F.log((F.col("n_docs") + 1) / (F.col("df") + 1)) + F.lit(1.0)
    return join_small(held, elig, key).select(key, "term", idf.alias("idf"), (F.col("t_tf") * idf).alias("wt"))


def heads(today: DataFrame, threshold: float, key: str) -> DataFrame:
    """``key, term, idf, wt, tail, t_norm``: the fewest heaviest terms of today's text that a copy cannot all lack.

    ``tail`` is the norm of the terms left out: below ``threshold`` of the whole
    (``t_norm``), so a past text with none of the head terms stays below it.
    The window is over the terms of one text.
    """
    square = F.col("wt") * F.col("wt")
    order = Window.partitionBy(key).orderBy(F.col("wt").desc(), "term")
    whole = F.sum(square).over(Window.partitionBy(key))
    after = F.sum(square).over(order.rowsBetween(1, Window.unboundedFollowing))
    t = today.select("*", whole.alias("whole"), F.coalesce(after, F.lit(0.0)).alias("after"))
    floor = F.lit(threshold * threshold - SLACK) * F.col("whole")
    head = t.where(F.col("after") + square >= floor)
    return head.select(key, "term", "idf", "wt", F.sqrt(F.min("after").over(Window.partitionBy(key))).alias("tail"), F.sqrt("whole").alias("t_norm"))


def upper_bound(dot: Column, square: Column, rest: Column, tail: Column, t_norm: Column) -> Column:
    """The greatest cosine that a past text can have, from its head terms alone.

    With head dot product ``a``, head norm ``h``, norm ``s`` of its other terms
    and tail norm ``b`` of today's text, the cosine is at most
    ``(a + b s) / (t sqrt(h h + s s))`` (Cauchy-Schwarz on the tail). It rises
    up to ``s = b h h / a`` and falls behind; ``rest`` is a lower bound of
    ``s``, so the greatest value lies at the larger of the two.
    """
    s = F.greatest(rest, tail * square / dot)
    return (dot + tail * s) / (t_norm * F.sqrt(square + s * s))


def survivors(past: DataFrame, head: DataFrame, threshold: float, key: str) -> DataFrame:
    """``key, doc`` of the past texts that may reach the threshold.

    An idf is at least 1, and n tokens of m terms have squared counts of
    ``n n / m`` or more, so the norm of a text's other terms needs no join.
    """
    w = F.col("tf") * F.col("idf")
    met = (past.join(head, [key, "term"]).groupBy(key, "doc")
           .agg(F.sum(w * F.col("wt")).alias("dot"), F.sum(w * w).alias("square"), F.sum("tf").alias("tokens"), F.count(F.lit(1)).alias("terms"),
                *[F.max(c).alias(c) for c in ("n_tokens", "n_terms", "tail", "t_norm")]))
    others = F.col("n_terms") - F.col("terms")
    rest = F.when(others > 0, (F.col("n_tokens") - F.col("tokens")) / F.sqrt(others.cast("double"))).otherwise(F.lit(0.0))
    bound = upper_bound(F.col("dot"), F.col("square"), rest, F.col("tail"), F.col("t_norm"))
    return met.where(bound >= F.lit(threshold - SLACK)).select(key, "doc")


def best_cosine(past: DataFrame, vocab: DataFrame, t_norm: DataFrame, key: str) -> DataFrame:
    """``key, max_sim`` over the given past texts, all their terms multiplied."""
    w = F.col("tf") * F.col("idf")
    per_doc = (past.join(vocab.hint("shuffle_hash"), [key, "term"]).groupBy(key, "doc")
               .agg(F.sqrt(F.sum(w * w)).alias("norm"), F.sum(w * F.coalesce(F.col("wt"), F.lit(0.0))).alias("dot")))
    cos = F.when((F.col("norm") > 0) & (F.col("t_norm") > 0), F.col("dot") / (F.col("norm") * F.col("t_norm")))
    return join_small(per_doc, t_norm, key).groupBy(key).agg(F.max(cos).alias("max_sim"))


def score_block(docs: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each key's list of texts: the greatest cosine (0 if no past text shares a term), exact match, and whether it has today's and a past text."""
    n = len(docs)
    d = docs.flatten()
    key = np.repeat(np.arange(n), np.diff(docs.offsets.to_numpy()))
    # A text of unknown day counts in its key, as neither today's nor a past one.
    flag = d.field("is_today")
    today = flag.fill_null(False).to_numpy(zero_copy_only=False)
    earlier = ~flag.fill_null(True).to_numpy(zero_copy_only=False)
    n_docs = np.bincount(key, minlength=n)
    n_today = np.bincount(key[today], minlength=n)
    scored = (n_today > 0) & (n_docs > n_today)
    code = lambda a: a.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    digest = code(d.field("digest")) + key * len(d)
    exact = np.zeros(n, bool)
    exact[np.intersect1d(digest[today], digest[earlier]) // max(len(d), 1)] = True
    # Rows that repeat a (key, doc) are one text.
    _, doc = np.unique(np.stack([key, code(d.field("doc")), today, earlier]), axis=1, return_inverse=True)
    doc = doc.reshape(-1)
    terms = d.field("terms")
    word = code(terms.flatten())
    row = np.repeat(np.arange(len(d)), np.diff(terms.offsets.to_numpy()))
    size = len(word) + 1
    at, first, tf = np.unique(doc[row] * size + word, return_index=True, return_counts=True)
    row, word = row[first], word[first]
    # idf and today's weight of each (key, term).
    _, first, term, df = np.unique(key[row] * size + word, return_index=True, return_inverse=True, return_counts=True)
    owner = key[row[first]]
    idf = np.log((n_docs[owner] + 1) / (df + 1)) + 1.0
    now = today[row]
    t_tf = np.zeros(len(df))
    np.maximum.at(t_tf, term[now], tf[now])
    wt = t_tf * idf
    t_norm = np.sqrt(np.bincount(owner, wt * wt, n))
    # Norm and dot product of each past text.
    past = earlier[row]
    text, w = (at // size)[past], (tf * idf[term])[past]
    norm = np.sqrt(np.bincount(text, w * w, len(d)))
    dot = np.bincount(text, w * wt[term[past]], len(d))
    whose = np.zeros(len(d), np.int64)
    whose[doc] = key
    with np.errstate(divide="ignore", invalid="ignore"):
        cos = np.nan_to_num(dot / (norm * t_norm[whose]), nan=0.0, posinf=0.0)
    best = np.zeros(n)
    np.maximum.at(best, whose, cos)
    return best, exact, scored


def score_rows(batches):
    """``key, docs`` in, ``key, max_sim, exact_match`` out for the keys that are scored."""
    for batch in batches:
        for i in range(0, batch.num_rows, BLOCK):
            part = batch.slice(i, BLOCK)
            docs = part.column("docs")
            best, exact, scored = score_block(pa.ListArray.from_arrays(pa.array(docs.offsets.to_numpy() - docs.offsets[0].as_py(), pa.int32()), docs.flatten()))
            out = pa.RecordBatch.from_arrays([part.column(0), pa.array(best), pa.array(exact)], [part.schema.names[0], "max_sim", "exact_match"])
            yield out.filter(pa.array(scored))


def score_small(d: DataFrame, key: str) -> DataFrame:
    """``key, max_sim, exact_match`` of keys whose texts fit into one row."""
    rows = d.groupBy(key).agg(F.collect_list(F.struct("doc", "is_today", "digest", "terms")).alias("docs"))
    schema = T.StructType([rows.schema[key], T.StructField("max_sim", T.DoubleType()), T.StructField("exact_match", T.BooleanType())])
    return rows.mapInArrow(score_rows, schema)


def score_spread(d: DataFrame, threshold: float, key: str, report_max: bool) -> DataFrame:
    """``key, max_sim, exact_match`` of keys of any size, spread by text and term."""
    # Corpus size and eligibility per key (U5): one aggregation.
    elig = stage_table(d.groupBy(key)
                       .agg(F.count_if("is_today").alias("n_today"), F.count(F.lit(1)).alias("n_docs"))
                       .where((F.col("n_today") > 0) & (F.col("n_docs") > F.col("n_today")))
                       .select(key, "n_docs"), "copy-paste keys")
    # U4: today's cleaned text equals some past cleaned text, as one aggregation on (key, digest).
    exact = (d.groupBy(key, "digest")
             .agg(F.bool_or("is_today").alias("t"), F.bool_or(~F.col("is_today")).alias("p"))
             .where(F.col("t") & F.col("p")).select(key).distinct()
             .withColumn("exact_match", F.lit(True)))
    # Texts under a repeated number are counted as one, which takes an exchange.
    whole = d.groupBy(key, "doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    counts = row_counts(d, key) if whole else stage_table(term_counts(d.withColumn("n_terms", F.size(F.array_distinct("terms"))), key), "copy-paste counts")
    vocab = stage_table(vocabulary(counts, elig, key), "copy-paste vocabulary")
    past = counts.where(~F.col("is_today"))
    today = vocab.where("wt IS NOT NULL")
    t_norm = today.groupBy(key).agg(F.sqrt(F.sum(F.col("wt") * F.col("wt"))).alias("t_norm"))
    if not report_max:
        near = survivors(past, heads(today, threshold, key), threshold, key)
        past = past.join(near, [key, "doc"], "left_semi")
    best = best_cosine(past, vocab, t_norm, key)
    return (elig.select(key).join(best, key, "left").join(exact, key, "left")
            .select(key, "max_sim", F.coalesce("exact_match", F.lit(False)).alias("exact_match")))


def copy_paste(docs: DataFrame, threshold: float, key: str = "key", report_max: bool = True) -> DataFrame:
    """``docs(key, doc, is_today, text)`` -> ``(key, max_sim, exact_match, copy_paste_detected)``.

    A key is scored only when its today text and at least one past text are
    non-blank after strip + lower (F10, M17); other keys are absent (callers
    default them to not copied). ``doc`` must be unique within a key, and a key
    has one today text. Keys below ``threshold`` have a null ``max_sim`` unless
    ``report_max`` is set.
    """
    # Texts are cleaned and tokenised once: the stage table holds each doc's terms and the digest of its text.
    text = docs.select(key, "doc", "is_today", clean_text(F.col("text")).alias("clean")).where(F.col("clean") != "")
    d = stage_table(text.select(key, "doc", "is_today", F.sha2("clean", 256).alias("digest"), F.sort_array(tokens(F.col("clean"))).alias("terms"))
                    .withColumn("n_tokens", F.size("terms")), "copy-paste terms")
    # At most one key in ``SMALL_KEY`` tokens is large; each text counts as one at least.
    weight = F.sum(F.greatest(F.col("n_tokens"), F.lit(1)))
    large = stage_table(d.groupBy(key).agg(weight.alias("n")).where(F.col("n") > SMALL_KEY).select(key), "copy-paste large keys")
    if large.isEmpty():
        out = score_small(d, key)
    else:
        spread = score_spread(join_small(d, large, key, "left_semi"), threshold, key, report_max)
        out = score_small(join_small(d, large, key, "left_anti"), key).unionByName(spread)
    # A past that shares no term scores 0 (M16); a key that is null equals none.
    known = F.col(key).isNotNull()
    max_sim = F.when(known, F.coalesce("max_sim", F.lit(0.0))).otherwise(F.lit(0.0))
    exact_m = known & F.col("exact_match")
    shown = max_sim if report_max else F.when(max_sim >= F.lit(threshold), max_sim)
    return out.select(key, shown.alias("max_sim"), exact_m.alias("exact_match"),
                      (exact_m | (max_sim >= F.lit(threshold))).alias("copy_paste_detected"))
