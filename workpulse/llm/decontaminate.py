"""Benchmark decontamination by winnowing, in DataFrame operations only.

Of every ``WINNOW`` consecutive ``GRAM``-word hashes the smallest is kept, so
any span of GRAM + WINNOW - 1 = 13 words that a document shares with a
benchmark item leaves the same fingerprint in both. Documents meet the
benchmark in a join of fingerprints; the few that share one are then read
again: a window's smallest gram together with the hash of its 13 words, the
same on both sides, gives a diagonal (document position minus item position),
and on it every window of 13 words is compared word by word. Grams that many
documents and items have in common (a question template) make no diagonal
unless a whole window is shared. Items of fewer than 13 words have no full
span; they are joined as whole sequences, all lengths in one pass.

The benchmark's side is broadcast only if its rows are counted and few
(``BROADCAST_ROWS``); else both sides are shuffled. No document meets another
one, and no row holds more than one document.

Defined results: a null or empty text has no words, is never hit and hits
nothing; an item without id is listed as an empty string; rows that repeat an
id with another text are judged one by one; repeated equal rows each get the
same result; an empty benchmark hits nothing; an empty table gives an empty
result; other columns are not read by ``hits``.

Arrays are exploded by the outer variants: for the others the optimiser adds
a filter on the array's size and moves it below the projections, which would
make the words and all their hashes again for each use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from workpulse.llm.common import ascii_lower, stage, table

SPAN = 13
GRAM = 4
WINNOW = SPAN - GRAM + 1
#: Rows of the benchmark's side up to which it is broadcast (of about 100 bytes).
BROADCAST_ROWS = 100_000
#: A document is contaminated if at least one word in so many is hit.
HIT_SHARE = 20
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def split_words(text: str) -> Column:
    return F.split(ascii_lower(F.coalesce(F.col(text), F.lit(""))), SEPARATORS, -1)


def words(parts: str) -> Column:
    """The parts without the empty ones that separators at the text's ends leave."""
    p = F.col(parts)
    lead = F.when(F.get(p, F.lit(0)) == "", 1).otherwise(0)
    tail = F.when((F.get(p, F.size(p) - 1) == "") & (F.size(p) > lead), 1).otherwise(0)
    return F.slice(p, lead + 1, F.size(p) - lead - tail)


def shifted(c: str, k: int, f) -> Column:
    """Each element with the one k places later."""
    n = F.greatest(F.size(c) - k, F.lit(0))
    return F.zip_with(F.slice(c, 1, n), F.slice(c, k + 1, n), f)


def with_words(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    return df.select(*keep, split_words(text).alias("_p")).select(*keep, words("_p").alias("w"))


def with_grams(df: DataFrame) -> DataFrame:
    """``w`` to ``g``: hashes of all GRAM-word sequences, doubled up from single words."""
    out = df.withColumn("g", F.transform("w", lambda x: F.xxhash64(x)))
    for k in (1, 2):
        out = out.withColumn("g", shifted("g", k, lambda a, b: F.xxhash64(a, b)))
    return out


def with_minima(df: DataFrame) -> DataFrame:
    """``g`` to ``fp``: the smallest gram of each window of WINNOW grams."""
    out = df.withColumn("fp", F.col("g"))
    for k in (1, 2, 4, 2):  # minima of 2, 4, 8 and 10
        out = out.withColumn("fp", shifted("fp", k, lambda a, b: F.least(a, b)))
    return out


def with_fingerprints(df: DataFrame) -> DataFrame:
    """``g`` to ``fp``: the distinct minima of all windows of WINNOW grams."""
    return with_minima(df).withColumn("fp", F.array_distinct("fp"))


def with_windows(df: DataFrame) -> DataFrame:
    """``g`` to ``win``: of each window of SPAN words its smallest gram, and a hash of all its words."""
    out = with_minima(df).withColumn("span", F.col("g"))
    for k in (GRAM, SPAN - 2 * GRAM):  # hashes of 8 and 13 words
        out = out.withColumn("span", shifted("span", k, lambda a, b: F.xxhash64(a, b)))
    return out.withColumn("win", F.zip_with("fp", "span", lambda a, b: F.struct(a.alias("gram"), b.alias("span"))))


def small(df: DataFrame) -> DataFrame:
    """Broadcast a counted, small side; leave a large one to the planner."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def same_row(a: str, b: str) -> Column:
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.row") == F.col(f"{b}.row"))


def rows_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    """doc_id, row (tells apart texts of one id) and text."""
    return docs.select(F.col(key).alias("doc_id"), F.xxhash64(text).alias("row"), F.col(text).alias("text"))


def hits(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
         item: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, row, n_words, n_hit and items (sorted ids) of every document with a hit."""
    rows = rows_of(docs, key, text)
    items = with_words(benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), F.col(item_text).alias("_text")),
                       "_text", ["item"]).distinct()
    items = stage(items.withColumn("m", F.size("w")), "items").where("m > 0")

    long_items = with_grams(items.where(f"m >= {SPAN}"))
    prints = stage(with_windows(long_items).select("item", F.hash("w").alias("_v"), F.posexplode_outer("win").alias("ipos", "win"))
                   .select("win.gram", "win.span", "item", "_v", "ipos"), "prints")

    # 1. Documents that share a fingerprint with an item.
    shared = with_fingerprints(with_grams(with_words(rows, "text", ["doc_id", "row"])))
    maybe = (shared.select("doc_id", "row", F.explode_outer("fp").alias("gram"))
             .join(small(prints.select("gram").distinct()), "gram", "left_semi").select("doc_id", "row").distinct())
    maybe = stage(maybe, "maybe")
    read = stage(with_words(rows.alias("d").join(maybe.alias("m"), same_row("d", "m"), "left_semi"), "text", ["doc_id", "row"])
                 .dropDuplicates(["doc_id", "row"]), "maybe-words")

    # 2. Diagonals, and the windows on them that are equal word by word.
    diagonals = (with_windows(with_grams(read)).select("doc_id", "row", F.posexplode_outer("win").alias("pos", "win"))
                 .select("doc_id", "row", "pos", "win.gram", "win.span").join(small(prints), ["gram", "span"])
                 .select("doc_id", "row", "item", "_v", (F.col("pos") - F.col("ipos")).alias("shift")).distinct())
    both = (diagonals.alias("x").join(read.alias("d"), same_row("x", "d"))
            .select("x.*", F.col("d.w").alias("w"))
            .join(small(items.where(f"m >= {SPAN}").select("item", F.hash("w").alias("_v"), "m", F.col("w").alias("iw"))), ["item", "_v"]))
    lo = F.greatest(F.lit(0), -F.col("shift"))
    hi = F.least(F.col("m"), F.size("w") - F.col("shift")) - SPAN
    equal = F.filter(F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>")),
                     lambda j: F.slice("w", F.col("shift") + j + 1, SPAN) == F.slice("iw", j + 1, SPAN))
    found = (both.select("doc_id", "row", "item", "shift", F.explode_outer(equal).alias("j")).where("j IS NOT NULL")
             .select("doc_id", "row", "item", (F.col("shift") + F.col("j")).alias("start"), F.lit(SPAN).alias("len")))

    # 3. Short items: each is one window as a whole; a text's words are made once and cut to each length in turn.
    lengths = [m for (m,) in items.where(f"m < {SPAN}").select("m").distinct().collect()]  # at most SPAN - 1 of them
    if lengths:
        whole = small(items.where(f"m < {SPAN}").select("item", F.array_join("w", " ").alias("seq")).distinct())
        starts = F.when(F.size("w") >= F.col("len"), F.sequence(F.lit(1), F.size("w") - (F.col("len") - 1)))
        cut = with_words(rows, "text", ["doc_id", "row"]).select("*", F.explode_outer(F.array(*map(F.lit, sorted(lengths)))).alias("len"))
        seqs = cut.select("doc_id", "row", "len", F.posexplode_outer(F.transform(starts, lambda i: F.array_join(F.slice("w", i, F.col("len")), " "))).alias("start", "seq"))
        found = found.unionByName(seqs.join(whole, "seq").select("doc_id", "row", "item", "start", "len"))
    found = stage(found.distinct(), "found")

    # 4. Words inside any window, as a union of intervals per document.
    n_hit = found.select("doc_id", "row", "start", (F.col("start") + F.col("len")).alias("end")).distinct().selectExpr(
        "doc_id", "row", "start", "end",
        "max(end) OVER (PARTITION BY doc_id, row ORDER BY start, end ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS upto")
    n_hit = n_hit.groupBy("doc_id", "row").agg(
        F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce("upto", F.lit(0))))).cast("long").alias("n_hit"))
    named = found.groupBy("doc_id", "row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    counts = (with_words(rows.alias("d").join(named.select("doc_id", "row").alias("m"), same_row("d", "m"), "left_semi"), "text", ["doc_id", "row"])
              .select("doc_id", "row", F.size("w").cast("long").alias("n_words")).dropDuplicates(["doc_id", "row"]))
    return (counts.alias("c").join(n_hit.alias("h"), same_row("c", "h")).select("c.*", "n_hit").alias("c")
            .join(named.alias("h"), same_row("c", "h")).select("c.*", "items"))


def contaminated() -> Column:
    return (F.col("n_hit") > 0) & (HIT_SHARE * F.col("n_hit") >= F.col("n_words"))


def op8_winnowing(spark, sf_dir):
    """Benchmark hits of all documents."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = hits(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))
    sizes = with_words(rows_of(docs, "doc_id", "text"), "text", ["doc_id", "row"]).select("doc_id", "row", F.size("w").cast("long").alias("n_words"))
    out = (sizes.alias("d").join(found.drop("n_words").alias("h"), same_row("d", "h"), "left")
           .select("d.doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                   F.coalesce("items", F.array().cast("array<string>")).alias("items")))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.encode(F.array_join("items", ","), "utf-8"), 256).alias("items_sha256"), contaminated().alias("contaminated"))


OP8_SQL = r"""
WITH lowered AS (
  SELECT 0 AS side, CAST(doc_id AS VARCHAR) AS id, text FROM documents
  UNION ALL SELECT 1, CAST(item_id AS VARCHAR), text FROM benchmark),
tokens AS (
  SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lowered),
items AS (
  SELECT id AS item, unnest(CASE WHEN len(w) < 13 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i:i + 12], ' ')) END) AS win,
         least(13, len(w)) AS len FROM tokens WHERE side = 1 AND len(w) > 0),
lens AS (SELECT DISTINCT len FROM items),
wins AS (
  SELECT id, len, unnest(range(1, len(w) - len + 2)) AS start,
         unnest(list_transform(range(1, len(w) - len + 2), lambda i: array_to_string(w[i:i + len - 1], ' '))) AS win
  FROM tokens, lens WHERE side = 0 AND len(w) >= len),
found AS (SELECT DISTINCT wins.id, wins.start, wins.len, item FROM wins JOIN items ON wins.win = items.win AND wins.len = items.len),
hit AS (SELECT id, count(DISTINCT pos) AS n_hit FROM (SELECT id, unnest(range(start, start + len)) AS pos FROM found) GROUP BY id),
named AS (SELECT id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM found GROUP BY id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM documents JOIN tokens ON side = 0 AND tokens.id = CAST(doc_id AS VARCHAR) LEFT JOIN hit ON hit.id = tokens.id LEFT JOIN named ON named.id = tokens.id
"""
