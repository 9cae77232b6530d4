"""Quality rules: base statistics and a learned decision list, as Spark expressions only.

``statistics`` describes each whole text by counts. Sequential covering learns
an ordered list of rules from labelled statistics: a rule grows, condition by
condition, on two thirds of the rows until it covers no good document, is
pruned from its end on the remaining third, and is kept if it is precise
enough on both; the rows it covers are then set aside and the next rule
grows. A list becomes one conditional expression (``verdict``), so scoring is
a projection inside the scan's stage.

Learning reads at most ``LABELLED`` labelled documents (those with the
smallest hashes of their ids); everything else covers all rows.

Defined results: a null or empty text has zero counts and fails the base
rules; of several labels for one id the lowest quality counts; labels without
id or quality are ignored; without labels of both kinds the list is empty and
only the base rules reject; repeated rows each get a row; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from workpulse.llm.common import ASCII_SPACE, table

#: Bound of the labelled rows that rules are learned from.
LABELLED = 4000
#: Words of a window; ``statistics`` doubles its hashes up to it.
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: A rule covers at least so many rejected rows, and so large a share of what it covers is rejected.
MIN_COVERED, MIN_PRECISION = 5, 0.97
MAX_RULES, MAX_CONDITIONS = 24, 4
#: Thresholds tried for each statistic when a rule grows.
CUTS = 64

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks", "n_digits", "n_distinct"]
#: What rules look at: (name, numerator, denominator); shares, so that length alone decides nothing.
SHARES = [
    ("symbol_share", "n_symbols", "word_chars"), ("upper_share", "n_upper", "word_chars"), ("mark_share", "n_marks", "word_chars"),
    ("digit_share", "n_digits", "word_chars"), ("word_length", "word_chars", "n_words"), ("repeat_share", "n_repeat_words", "n_words"),
    ("distinct_share", "n_distinct", "n_words"), ("dup_line_share", "n_dup_lines", "n_lines"), ("line_words", "n_words", "n_lines"),
]


def left_after(text: Column, drop: str) -> Column:
    """Characters of the text that are left without the runs that ``drop`` matches."""
    return F.char_length(F.regexp_replace(text, drop, "")).cast("long")


def joined(grams: str, k: int) -> Column:
    """Hashes of windows of 2k words from those of k words: each with the one that starts k words later."""
    n = F.greatest(F.size(grams) - k, F.lit(0))
    return F.zip_with(F.slice(grams, 1, n), F.slice(grams, k + 1, n), lambda a, b: F.xxhash64(a, b))


def repeated_words(grams: Column) -> Column:
    """Words inside windows that occur twice or more, from the hashes of all windows in order.

    Only a text with a repeated window sorts its (hash, position) pairs; the
    positions of repeated windows, in order, each cover the words up to the
    next one, at most a whole window.
    """
    def covered(p: Column) -> Column:
        ahead = F.zip_with(F.slice(p, 1, F.size(p) - 1), F.slice(p, 2, F.size(p) - 1), lambda a, b: F.least(b - a, F.lit(WINDOW)))
        return F.aggregate(ahead, F.lit(WINDOW), lambda s, x: s + x)

    def positions(s: Column) -> Column:
        like = lambda j, k: F.coalesce(F.get(s, j)["g"] == F.get(s, k)["g"], F.lit(False))
        at = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda j: like(j, j - 1) | like(j, j + 1))
        return F.array_sort(F.transform(at, lambda j: F.get(s, j)["i"]))

    let = lambda value, f: F.get(F.transform(F.array(value), f), F.lit(0))  # noqa: E731  evaluates ``value`` once
    pairs = F.array_sort(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(grams)) == F.size(grams), 0).otherwise(
        let(let(pairs, positions), covered)).cast("long")


def statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the columns of COUNTS.

    The words and the hashes of their windows are columns of their own, so
    that each is made once per row. The counts leave through a generator
    (``inline`` of one struct): the optimiser would otherwise move a filter on
    a count below the projections and make the words again inside lambdas.
    """
    t = F.coalesce(F.col("_t"), F.lit(""))
    bare = F.btrim(t, F.lit(ASCII_SPACE))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+", -1))
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.btrim(x, F.lit(ASCII_SPACE)) != "")
    kept = [c for c in df.columns]
    return (df.withColumn("_t", F.col(text)).withColumns({"_w": words, "_l": lines})
            .withColumn("_g", F.transform("_w", lambda x: F.xxhash64(x))).withColumn("_g", joined("_g", 1))
            .withColumn("_g", joined("_g", 2)).withColumn("_g", joined("_g", 4)).select(*kept, F.inline(F.array(F.struct(
                F.size("_w").cast("long").alias("n_words"),
                F.char_length(F.array_join("_w", "")).cast("long").alias("word_chars"),
                left_after(t, r"[^#*$%&|<>]+").alias("n_symbols"),
                (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
                repeated_words(F.col("_g")).alias("n_repeat_words"),
                F.size("_l").cast("long").alias("n_lines"),
                left_after(t, r"[^A-Z]+").alias("n_upper"),
                left_after(t, r"[^!?]+").alias("n_marks"),
                left_after(t, r"[^0-9]+").alias("n_digits"),
                F.size(F.array_distinct("_w")).cast("long").alias("n_distinct"))))))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    share: int
    above: bool
    cut: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        return x[:, self.share] > self.cut if self.above else x[:, self.share] <= self.cut

    def column(self) -> Column:
        name, num, den = SHARES[self.share]
        share = F.col(num) / F.greatest(F.col(den), F.lit(1))
        return share > self.cut if self.above else share <= self.cut


Rule = tuple[Condition, ...]


def covers(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for c in rule:
        out &= c.holds(x)
    return out


def grow(x: np.ndarray, bad: np.ndarray) -> Rule:
    """Add the condition of the largest gain until the rule covers no good row."""
    rule: list[Condition] = []
    while len(rule) < MAX_CONDITIONS and (~bad).any() and bad.any():
        before = np.log2(bad.mean())
        best, gain = None, 0.0
        for k in range(x.shape[1]):
            v = np.unique(x[:, k])
            gaps = (v[1:] + v[:-1]) / 2
            for cut in gaps[np.unique(np.linspace(0, len(gaps) - 1, min(CUTS, len(gaps))).astype(int))] if len(gaps) else ():
                over = x[:, k] > cut
                for above, hit in ((True, over), (False, ~over)):
                    p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
                    if p and (g := p * (np.log2(p / (p + n)) - before)) > gain:
                        best, gain = Condition(k, above, float(cut)), g
        if best is None:
            break
        rule.append(best)
        hit = best.holds(x)
        x, bad = x[hit], bad[hit]
    return tuple(rule)


def worth(rule: Rule, x: np.ndarray, bad: np.ndarray) -> float:
    hit = covers(rule, x)
    p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
    return (p - n) / (p + n) if p + n else -1.0


def prune(rule: Rule, x: np.ndarray, bad: np.ndarray) -> Rule:
    """Cut conditions off the end while that makes the rule no worse on rows it was not grown on."""
    return max((rule[:k] for k in range(len(rule), 0, -1)), key=lambda r: (worth(r, x, bad), -len(r)))


def learn(x: np.ndarray, bad: np.ndarray) -> list[Rule]:
    """Sequential covering: an ordered list of rules that reject. x: (rows, SHARES), bad: rejected rows."""
    third = np.arange(len(x)) % 3 == 2
    rules, left = [], np.ones(len(x), dtype=bool)
    while len(rules) < MAX_RULES:
        g, p = left & ~third, left & third
        if (bad & g).sum() < MIN_COVERED:
            break
        rule = grow(x[g], bad[g])
        if not rule:
            break
        rule = prune(rule, x[p], bad[p])
        hit = covers(rule, x) & left
        if (hit & bad).sum() < MIN_COVERED or bad[hit].mean() < MIN_PRECISION:
            break
        rules.append(rule)
        left &= ~hit
    return rules


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that covers the row, from 1; null if none does."""
    out = F.lit(None).cast("int")
    for k in range(len(rules), 0, -1):
        both = F.lit(True)
        for c in rules[k - 1]:
            both = both & c.column()
        out = F.when(both, k).otherwise(out)
    return out


def labelled(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", bound: int = LABELLED):
    """(x, bad) of at most ``bound`` labelled documents that pass the base rules."""
    one = labels.where(f"{key} IS NOT NULL AND quality IS NOT NULL").groupBy(F.col(key).alias("_id")).agg(F.min("quality").alias("quality"))
    n = one.count()
    cut = int(min(1.0, bound / max(1, n)) * 2**40)
    picked = one.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 40)) < cut)
    rows = docs.select(F.col(key).alias("_id"), F.col(text).alias("text")).join(F.broadcast(picked), "_id")
    shares = [(F.col(num) / F.greatest(F.col(den), F.lit(1))).alias(name) for name, num, den in SHARES]
    got = (statistics(rows).where(~base_failed()).select(F.xxhash64("_id").alias("h"), (F.col("quality") == 0).alias("bad"), *shares).collect())
    got = sorted(tuple(r) for r in got)[:bound]
    return (np.array([r[2:] for r in got], dtype=float).reshape(len(got), len(SHARES)), np.array([r[1] for r in got], dtype=bool))


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with its statistics, base_failed, the number of the rule that rejects (or null) and kept."""
    rules = learn(*labelled(docs, labels, key, text))
    return (statistics(docs, text).withColumn("base_failed", base_failed()).withColumn("rule", verdict(rules))
            .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()))


def op10_quality_rules(spark, sf_dir):
    """Statistics and verdicts of all documents, rules learned from ``labels``."""
    out = judge(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "quality"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
