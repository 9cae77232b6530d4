"""Phrase collocations from a weighted de Bruijn graph over words.

Nodes are runs of ``LONGEST`` - 1 words, edges runs of ``LONGEST`` words that
lead from one node to the next, weighted by how often they occur within a
piece (text between two breaks). Each word starts one run through the graph:
an edge, or what is left of it where the piece ends. Only these are counted
from the texts; everything shorter follows from them:

* the flow out of a run of k words is the weight of all runs of k + 1 words
  that start with it; what does not flow on ends there, so
  f(run) = outflow + runs that end with it.
* where all of a run's weight flows through one longer run, the path is unary:
  the run is compacted into the longer one and is no phrase of its own. A run
  is inside a longer one of the same weight exactly if one word more, before
  or behind, has the same weight, so one step each way decides it.

Most runs of a large corpus are too rare for any phrase, and the longer they
are the more of them are. The graph is cut at words, pairs and triples whose
bucket of hashes counts fewer than the least frequency over the whole corpus:
a word's run ends before the first of them. Buckets hold whole counts, so no run
that is frequent enough is ever cut short, and its count stays exact: each place
where it occurs starts a run that holds it. Runs that are too rare may lose
weight, which only leaves them too rare. So the graph grows with the frequent
triples, not with the distinct runs of five words. The more text, the more
buckets (up to 2**``MAX_BITS`` for each length, bitmaps of 16 MB); where they do
not suffice, fewer runs are cut and more edges counted, with the same result.
A language's words are summed up beside the graph.

Words and runs are compared as text, never by hash.

Defined results: a null or empty text has no words; a null language is
``und``; a document counts as often as it occurs in the table; a text of any
length is one piece list, never cut; ties in a cut's score go to the smallest
first part, ties in the ranking to the larger count, then to the phrase that
comes first in bytes. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workpulse.llm.common import stage, table
from workpulse.llm.ngram_join import powers

#: Words of an edge, and of the longest phrase.
LONGEST = 5
#: Runs of up to so many words are counted in buckets first.
CUT = 3
#: Buckets of hashes of runs of one length: a power of two, about one for each 16 bytes of text, within these powers.
MIN_BITS, MAX_BITS = 16, 27
#: Bytes of text that are cut into words at once: their arrays stay in a core's cache.
BYTES_AT_ONCE = 250_000
#: Runs of one length whose buckets a task adds up before they leave it.
PAIRS_AT_ONCE = 4_000_000
#: Runs of the graph that a task adds up before they leave it.
RUNS_AT_ONCE = 1_000_000
#: A language's candidates are ranked in so many parts first.
PARTS = 64

#: Of each byte: 0 in a word, 1 blank, 2 break.
KIND = np.zeros(256, dtype=np.uint8)
KIND[[0x20, 0x09]] = 1
KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2


def slices(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.StringArray:
    """Strings buf[start:end], one for each pair."""
    size = end - start
    offset = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(offset[-1]) + np.repeat(start - offset[:-1], size)
    return pa.StringArray.from_buffers(len(size), pa.py_buffer(offset.astype(np.int32).tobytes()), pa.py_buffer(buf[at].tobytes()))


class Words:
    """All words of some texts in order, joined by single spaces: ``buf[start:end]``, and the piece of each."""

    def __init__(self, texts: list[bytes]):
        raw = np.frombuffer(b"\n".join(texts).lower() + b"\n", dtype=np.uint8)  # bytes.lower() is A-Z only
        kind = KIND[raw]
        word = kind == 0
        edge = np.diff(word.view(np.int8), prepend=np.int8(0))
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.piece = np.searchsorted(np.flatnonzero(kind == 2), first)
        word[last] = True  # one separator stays behind each word
        self.buf = raw[word]
        size = last - first
        self.end = np.cumsum(size + 1) - 1
        self.start = self.end - size
        self.buf[self.end] = 0x20

    def buckets(self, bits: int, lang: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For runs of 1 to ``CUT`` words: the bucket of the run that starts at each word, and whether it lies in one piece."""
        up, down = powers(len(self.buf) + 1)
        sums = np.zeros(len(self.buf) + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum((self.buf + np.uint64(1)) * up[:-1], out=sums[1:])
            h = (sums[self.end] - sums[self.start]) * down[self.start]
            h = run = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(lang)
            for k in range(1, min(CUT, len(h)) + 1):
                if k > 1:
                    run = (run[:-1] ^ (run[:-1] >> np.uint64(32))) * np.uint64(0x94D049BB133111EB) + h[k - 1:]
                mixed = (run ^ (run >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
                yield (mixed >> np.uint64(64 - bits)).astype(np.uint32), self.piece[:len(run)] == self.piece[k - 1:]

    def lengths(self, bits: int, lang: int, bitmaps: np.ndarray) -> np.ndarray:
        """Words of the longest run that starts at each word and has no rare bucket within, 0 if the word itself is rare."""
        out = np.zeros(len(self.start), dtype=np.int64)
        tables = self.buckets(bits, lang)
        whole = np.ones(len(self.start) + 1, dtype=bool)
        for k in range(1, min(LONGEST, len(self.start)) + 1):
            whole = whole[:-1] & whole[1:]
            if k <= CUT:
                bucket, inside = next(tables)
                whole &= inside & ((bitmaps[k - 1][bucket >> 3] >> (bucket & 7).astype(np.uint8)) & 1 > 0)
            out[:len(whole)] += whole
        return out


def by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Words]]:
    """(language, words) of parts of the rows (lang, text), whole texts each."""
    held: dict[str, tuple[list[bytes], int]] = {}
    for b in batches:
        for lang, raw in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), strict=True):
            texts, size = held.get(lang, ([], 0))
            texts.append(raw := raw or b"")
            if size + len(raw) < BYTES_AT_ONCE:
                held[lang] = texts, size + len(raw)
            else:
                held.pop(lang, None)
                yield lang, Words(texts)
    for lang, (texts, _) in held.items():
        yield lang, Words(texts)


def seed(lang: str) -> int:
    """Sets languages apart in the buckets."""
    return int.from_bytes(lang.encode()[:7], "big") * 2 + 1


def part_bits(bits: int) -> int:
    """Buckets of a table are dealt in parts of a power of two."""
    return min(16, max(3, bits - 10))


def count_buckets(bits: int, least: int):
    """(part, at, n) of all runs of 1 to ``CUT`` words of rows (lang, text): a part's buckets and their counts, packed.

    Up to ``PAIRS_AT_ONCE`` runs of a length are added up before they leave. A count of ``least`` or more leaves as ``least``,
    which is enough for its bucket.
    """
    low, kind = part_bits(bits), np.min_scalar_type(least)

    def counted(k, held):
        bucket, n = np.unique(np.concatenate(held), return_counts=True)
        part = bucket >> low
        first = np.flatnonzero(np.diff(part, prepend=part[0] + 1))
        cuts = np.append(first, len(part))
        packed = lambda v: pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer((cuts * v.itemsize).astype(np.int32)), pa.py_buffer(v)])
        parts = part[first].astype(np.int64) + ((k - 1) << (bits - low))
        at = (bucket & ((1 << low) - 1)).astype(np.uint16)
        return pa.RecordBatch.from_arrays([pa.array(parts), packed(at), packed(np.minimum(n, least).astype(kind))], names=["part", "at", "n"])

    def run(batches):
        held: dict[int, list[np.ndarray]] = {k: [] for k in range(1, CUT + 1)}
        for lang, words in by_language(batches):
            for k, (bucket, inside) in enumerate(words.buckets(bits, seed(lang)), 1):
                held[k].append(bucket[inside])
                if sum(map(len, held[k])) >= PAIRS_AT_ONCE:
                    yield counted(k, held[k])
                    held[k] = []
        for k, some in held.items():
            if sum(map(len, some)):
                yield counted(k, some)
    return run


def frequent_parts(bits: int, least: int):
    """(part, bits) of rows (part, at, n) in the order of their parts: a bit for each bucket that holds ``least`` runs."""
    size, kind = 1 << part_bits(bits), np.min_scalar_type(least)

    def bitmap(part, counts):
        return pa.RecordBatch.from_arrays([pa.array([part]), pa.array([np.packbits(counts >= least, bitorder="little").tobytes()], pa.binary())], names=["part", "bits"])

    def run(batches):
        part, counts = None, np.zeros(size, dtype=np.int64)
        for b in batches:
            for own, at, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if own != part:
                    if counts.max() >= least:
                        yield bitmap(part, counts)
                    part, counts = own, np.zeros(size, dtype=np.int64)
                counts[np.frombuffer(at, np.uint16)] += np.frombuffer(n, kind)
        if counts.max() >= least:
            yield bitmap(part, counts)
    return run


def frequent_buckets(pieces: DataFrame, bits: int, least: int) -> bytes:
    """For runs of 1 to ``CUT`` words, a bit for each bucket that holds at least ``least`` of them."""
    counts = pieces.mapInArrow(count_buckets(bits, least), "part long, at binary, n binary")
    found = counts.repartition("part").sortWithinPartitions("part").mapInArrow(frequent_parts(bits, least), "part long, bits binary")
    out, size = bytearray(CUT * (1 << bits) // 8), (1 << part_bits(bits)) // 8
    for r in found.collect():  # the size of the bitmaps at most
        out[r["part"] * size:(r["part"] + 1) * size] = r["bits"]
    return bytes(out)


def edges_and_ends(bits: int, bitmaps):
    """(lang, run, words, n): each word's run through the graph, an edge of ``LONGEST`` words or what is left of it at the
    end of its piece or before a rare run; and with no words, how many words the language has."""
    def counted(lang, held, total):
        found = pc.value_counts(pa.concat_arrays(held))
        runs = pa.concat_arrays([found.field("values"), pa.array([""])])
        n = pa.concat_arrays([found.field("counts").cast(pa.int64()), pa.array([total], pa.int64())])
        k = pc.add(pc.count_substring(runs, " "), 1)
        k = pc.if_else(pc.equal(runs, ""), 0, k)
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(runs), pa.string()), runs, k.cast(pa.int32()), n], names=["lang", "run", "words", "n"])

    def run(batches):
        tables = np.frombuffer(bitmaps.value, dtype=np.uint8).reshape(CUT, -1)
        held: dict[str, tuple[list[pa.StringArray], int]] = {}
        for lang, words in by_language(batches):
            length = words.lengths(bits, seed(lang), tables)
            head = np.flatnonzero(length)
            runs, total = held.pop(lang, ([], 0))
            runs.append(slices(words.buf, words.start[head], words.end[head + length[head] - 1]))
            total += len(length)
            if sum(map(len, runs)) < RUNS_AT_ONCE:
                held[lang] = runs, total
            else:
                yield counted(lang, runs, total)
        for lang, (runs, total) in held.items():
            yield counted(lang, runs, total)
    return run


def flows(graph: DataFrame) -> DataFrame:
    """(lang, run, words, n) of all runs of 1 to ``LONGEST`` words: each takes what flows through it on to longer ones and what ends with it."""
    shorter = graph.where("words > 0").select("lang", "run", "n", F.explode(F.expr("sequence(1, words)")).alias("words"))
    return shorter.select("lang", F.expr("substring_index(run, ' ', words)").alias("run"), "words", "n").groupBy("lang", "run", "words").agg(F.sum("n").alias("n"))


def compacted(runs: DataFrame) -> DataFrame:
    """(lang, run, through): the largest weight that one word more, behind or before, has."""
    longer = runs.where("words > 2")
    step = F.expr("explode(array(substring_index(run, ' ', words - 1), substring_index(run, ' ', 1 - words)))")
    return longer.select("lang", step.alias("run"), "n").groupBy("lang", "run").agg(F.max("n").alias("through"))


def mine(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 100, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score, cut (words of the first part) of each language's first ``top`` phrases."""
    spark = docs.sparkSession
    pieces = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    size = pieces.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(MAX_BITS, max(MIN_BITS, (size // 16).bit_length()))
    bitmap = spark.sparkContext.broadcast(frequent_buckets(pieces, bits, least))
    graph = stage(pieces.mapInArrow(edges_and_ends(bits, bitmap), "lang string, run string, words int, n long")
                  .groupBy("lang", "run", "words").agg(F.sum("n").alias("n")), "graph")
    total = graph.where("words = 0").select("lang", F.col("n").alias("total"))
    runs = stage(flows(graph).where(F.col("n") >= least), "runs")

    phrases = runs.where("words > 1")
    through = compacted(runs)
    open_ends = phrases.join(through, ["lang", "run"], "left").where("through IS NULL OR through < n").select("lang", "run", "words", "n")
    cuts = open_ends.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut")).select(
        "lang", "run", F.col("n").alias("a"), "cut", F.expr("substring_index(run, ' ', cut)").alias("first"),
        F.expr("substring_index(run, ' ', cut - words)").alias("rest"))
    part = lambda name, n: runs.select("lang", F.col("run").alias(name), F.col("n").alias(n))
    wide = lambda c: f"cast({c} AS decimal(19, 0))"
    scored = (cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"]).join(F.broadcast(total), "lang")
              .withColumn("score", F.expr(f"(cast(1000 * {wide('a')} AS decimal(22, 0)) * cast(total AS decimal(16, 0))) div (cast({wide('l')} * {wide('r')} AS decimal(38, 0)))")))
    weakest = scored.groupBy("lang", "run", "a", "total").agg(F.min(F.struct("score", "cut", "l", "r")).alias("c"))
    rows = weakest.select("lang", F.col("run").alias("phrase"), "a", "c.l", "c.r", F.col("total").alias("n"), "c.score", "c.cut")
    order = "ORDER BY score DESC, a DESC, phrase"
    rows = rows.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    rows = rows.selectExpr("*", f"row_number() OVER (PARTITION BY lang, part {order}) AS at").where(F.col("at") <= top)  # what no part's first rows hold is no first row
    return rows.selectExpr("lang", f"row_number() OVER (PARTITION BY lang {order}) AS rank", "phrase", "a", "l", "r", "n", "score", "cut").where(F.col("rank") <= top)


def op12_phrases(spark, sf_dir):
    """Each language's first 2,000 phrases of 2 to 5 words that occur 100 times or more."""
    out = mine(table(spark, sf_dir, "documents", "text", "lang"))
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[.,;:!?\x0A-\x0D]')) AS piece FROM documents WHERE text IS NOT NULL),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
f AS MATERIALIZED (
  SELECT lang, k, run, count(*) AS n FROM (
    SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS run
    FROM words, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k) GROUP BY ALL),
total AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
runs AS MATERIALIZED (SELECT * FROM f WHERE n >= 100),
part AS (
  SELECT lang, run, k, n, string_split(run, ' ') AS w FROM runs WHERE k > 1),
inside AS (
  SELECT DISTINCT lang, array_to_string(w[i:i + m - 1], ' ') AS run, n FROM part, (SELECT unnest([2, 3, 4]) AS m), (SELECT unnest([1, 2, 3, 4]) AS i)
  WHERE m < k AND i + m - 1 <= k),
cand AS MATERIALIZED (SELECT p.* FROM part p WHERE NOT EXISTS (SELECT 1 FROM inside s WHERE s.lang = p.lang AND s.run = p.run AND 100 * s.n >= 100 * p.n)),
halves AS MATERIALIZED (
  SELECT lang, run, n AS a, j, array_to_string(w[1:j], ' ') AS first, array_to_string(w[j + 1:], ' ') AS rest
  FROM cand, (SELECT unnest([1, 2, 3, 4]) AS j) WHERE j < k),
cuts AS (
  SELECT h.lang, h.run, a, j, x.n AS l, y.n AS r, t.n AS n, ((1000::HUGEINT * a * t.n) // (x.n::HUGEINT * y.n))::BIGINT AS score
  FROM halves h JOIN runs x ON x.lang = h.lang AND x.run = h.first JOIN runs y ON y.lang = h.lang AND y.run = h.rest JOIN total t ON t.lang = h.lang),
low AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, run ORDER BY score, j) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(run)) AS rank, run AS phrase, a, l, r, n, score
FROM low QUALIFY rank <= 2000
"""
