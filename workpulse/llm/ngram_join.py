"""N-gram Jaccard join by T-occurrence search, and the components of its links.

Documents are sets of hashed word shingles. Two sets of a and b shingles link
at a Jaccard similarity of t exactly if they share at least
T = ceil(t (a + b) / (1 + t)) of them.

1. Equal sets become one class with a number of its own (document ids may
   repeat or be null); document ids come back in at the end.
2. Most classes cannot link: a set of n shingles with more than n - ceil(t n)
   that no other set holds is out. This is counted over all sets, on the
   shingles whose hash lies in a fixed part of the hash range (the same part
   for every set, so the counts of those shingles are exact). Sets that this
   does not settle go on; none is lost.
3. For the rest, all shingles are counted exactly. Ordered from rare to
   frequent, linked sets share one of their first n - ceil(t n) + 1 shingles,
   so sets meet through these only. Chains of meetings give candidate groups.
4. In blocks of a group, each set queries the block's inverted lists by
   DivideSkip: short lists are merged and counted, the L longest are probed by
   binary search for the sets that can still reach T. Groups larger than a
   block are dealt as pairs of blocks, so no task ever holds a whole large
   group; a task answers with each set's number of links and one link to its
   component's smallest set, never with all pairs.
5. Components of these links, over all tasks.

Shingles are 64-bit hashes; a chance collision can move one overlap by one.

Defined results: a null or empty text, or one without words, has an empty set
and is linked with nothing; equal sets are linked; a row without id gets the
smallest id that its set's links reach, or null; the texts of a repeated id
are searched one by one and are one component; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workpulse.llm.common import connected_components, small_ids, stage, table

#: Part of the hash range on which step 2 counts.
PART = 0.25
#: Sets in a block of step 4.
BLOCK = 512
#: DivideSkip's weight of a probe against a merged entry.
MU = 1.0
#: Bytes of text that are hashed at once.
BYTES_AT_ONCE = 1_000_000

#: Stands for the smallest id of a set whose rows have none; behind all others.
NO_ID = 2**63 - 1

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[str, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse modulo 2**64, for i < n."""
    if not _powers or len(_powers["up"]) < n:
        for name, base in (("up", BASE), ("down", INVERSE)):
            p = np.full(n, base, dtype=np.uint64)
            p[0] = 1
            _powers[name] = np.multiply.accumulate(p)
    return _powers["up"][:n], _powers["down"][:n]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts (A-Z lower-cased), and the text of each."""
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    buf = np.frombuffer(b" ".join(texts).lower() + b" ", dtype=np.uint8)
    up, down = powers(len(buf) + 1)
    sums = np.empty(len(buf) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    space = IS_SPACE[buf]
    edge = np.diff(np.concatenate([[True], space]).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    h = (sums[end] - sums[start]) * down[start]
    return mixed(h ^ ((end - start).astype(np.uint64) << np.uint64(40))), np.searchsorted(np.cumsum(sizes), start, side="right")


def shingle_sets(texts: list[str | None], width: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts' sorted distinct shingle hashes behind one another, and each text's number of them."""
    h, own = word_hashes([(t or "").encode() for t in texts])
    n = np.bincount(own, minlength=len(texts))
    x = h.copy()
    for k in range(1, width):
        x[:len(x) - k] = mixed(x[:len(x) - k] * np.uint64(0xD6E8FEB86659FD93) + h[k:])
    whole = np.arange(len(h)) + width <= np.repeat(np.cumsum(n), n)  # a shingle must end in its own text
    value, of = x[whole], own[whole]
    short = np.flatnonzero((n > 0) & (n < width))
    if len(short):
        first = np.cumsum(n) - n
        extra = []
        for i in short.tolist():
            v = np.uint64(n[i])
            for w in h[first[i]:first[i] + n[i]]:
                v = mixed(np.array([v * np.uint64(0xD6E8FEB86659FD93) + w], dtype=np.uint64))[0]
            extra.append(v)
        value, of = np.concatenate([value, np.array(extra, dtype=np.uint64)]), np.concatenate([of, short])
    order = np.lexsort((value, of))
    value, of = value[order], of[order]
    keep = np.ones(len(value), dtype=bool)
    keep[1:] = (value[1:] != value[:-1]) | (of[1:] != of[:-1])
    return value[keep], np.bincount(of[keep], minlength=len(texts))


def hashed(batch: pa.RecordBatch, column: int, width: int):
    """(first row, number of rows, hashes, sizes) of consecutive parts of a batch."""
    texts, done = batch.column(column).to_pylist(), 0
    with np.errstate(over="ignore"):
        while done < len(texts):
            upto, size = done, 0
            while upto < len(texts) and (upto == done or size < BYTES_AT_ONCE):
                size += len(texts[upto] or "")
                upto += 1
            yield done, upto - done, *shingle_sets(texts[done:upto], width)
            done = upto


def signatures(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each set; together with its size they name the set."""
    with np.errstate(over="ignore"):
        sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(h * np.uint64(k) + np.uint64(1)))]) for k in (3, 5)]
        ends = np.cumsum(n)
        return tuple((s[ends] - s[ends - n]).view(np.int64) for s in sums)


def classify(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n, s1, s2 and the further numbers of every row of ``docs`` (doc_id, text, numbers)."""
    more = docs.columns[2:]

    def run(batches):
        for b in batches:
            for first, rows, h, n in hashed(b, 1, width):
                s1, s2 = signatures(h, n)
                rest = [b.column(i).slice(first, rows) for i in range(2, 2 + len(more))]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, rows), pa.array(n.astype(np.int64)), pa.array(s1), pa.array(s2), *rest],
                                                 names=["doc_id", "n", "s1", "s2", *more])
    return docs.mapInArrow(run, "doc_id long, n long, s1 long, s2 long" + "".join(f", {c} long" for c in more))


def part_postings(docs: DataFrame, width: int, part: float) -> DataFrame:
    """(h, s1): every row's shingles in the lowest ``part`` of the hash range."""
    cut = np.uint64(int(part * 2**64) - 1)

    def run(batches):
        for b in batches:
            for _, _, h, n in hashed(b, 1, width):
                s1, _ = signatures(h, n)
                low = h <= cut
                yield pa.RecordBatch.from_arrays([pa.array(h[low].view(np.int64)), pa.array(np.repeat(s1, n)[low])], names=["h", "s1"])
    return docs.mapInArrow(run, "h long, s1 long")


def sets(docs: DataFrame, width: int) -> DataFrame:
    """(cls, first, n, copies, hashes) of rows (text, cls, first, n, s1, s2, copies) whose text has the signature n, s1, s2."""
    def run(batches):
        for b in batches:
            for first, rows, h, n in hashed(b, 0, width):
                s1, s2 = signatures(h, n)
                cls, least, *named, copies = (b.column(i).slice(first, rows) for i in range(1, 7))
                right = (n == named[0].to_numpy()) & (s1 == named[1].to_numpy()) & (s2 == named[2].to_numpy())
                offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                out = pa.RecordBatch.from_arrays([cls, least, pa.array(n.astype(np.int64)), copies, pa.ListArray.from_arrays(pa.array(offsets), pa.array(h.view(np.int64)))],
                                                 names=["cls", "first", "n", "copies", "hashes"])
                yield out.filter(pa.array(right))
    return docs.mapInArrow(run, "cls long, first long, n long, copies long, hashes array<long>")


def signed_sets(docs: DataFrame, width: int) -> DataFrame:
    """(n, s1, s2, hashes) of every row of ``docs`` (text): for rows that no id leads to."""
    def run(batches):
        for b in batches:
            for _, _, h, n in hashed(b, 0, width):
                s1, s2 = signatures(h, n)
                offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(n.astype(np.int64)), pa.array(s1), pa.array(s2), pa.ListArray.from_arrays(pa.array(offsets), pa.array(h.view(np.int64)))],
                                                 names=["n", "s1", "s2", "hashes"])
    return docs.mapInArrow(run, "n long, s1 long, s2 long, hashes array<long>")


def divide_skip(queries: list[np.ndarray], indexed: list[np.ndarray], percent: int, same: bool) -> list[tuple[int, np.ndarray]]:
    """(query, indexed sets that link with it); within one list of sets (``same``) each pair once."""
    size = np.array([len(x) for x in indexed], dtype=np.int64)
    flat, of = np.concatenate(indexed), np.repeat(np.arange(len(indexed)), size)
    order = np.lexsort((of, flat))
    flat, of = flat[order], of[order]
    head = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
    value, length = flat[head], np.diff(np.r_[head, len(flat)])
    entry = np.repeat(np.arange(len(head)), length) * len(indexed) + of  # ascending: list by list, set by set
    out = []
    for q, x in enumerate(queries):
        a = len(x)
        least = -(-percent * a // 100)  # the smallest set that can link, and the least overlap with any
        at = np.searchsorted(value, x)
        inside = at < len(value)
        at = at[inside][value[at[inside]] == x[inside]]
        if len(at) < least:
            continue
        at = at[np.argsort(length[at], kind="stable")]
        skip = min(least - 1, int(least / (MU * np.log2(max(2, length[at[-1]])) + 1)))
        short, long = at[:len(at) - skip], at[len(at) - skip:]
        n = length[short]
        ends = np.cumsum(n)
        count = np.bincount(of[np.arange(ends[-1]) + np.repeat(head[short] - (ends - n), n)], minlength=len(indexed))
        cand = np.flatnonzero(count >= least - skip)
        if same:
            cand = cand[cand < q]
        cand = cand[(size[cand] >= least) & (100 * a >= percent * size[cand])]
        if not len(cand):
            continue
        overlap = count[cand]
        if len(long):
            probe = long[:, None] * len(indexed) + cand[None, :]
            spot = np.minimum(np.searchsorted(entry, probe), len(entry) - 1)
            overlap = overlap + (entry[spot] == probe).sum(0)
        cand = cand[100 * overlap >= percent * (a + size[cand] - overlap)]
        if len(cand):
            out.append((q, cand))
    return out


def search(percent: int):
    """The links inside a block, or between two: (cls, first, other, other_first, links) per set that has any."""
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates("cls").sort_values(["n", "cls"], kind="stable")
        cls, first, copies = rows["cls"].to_numpy(), rows["first"].to_numpy(), rows["copies"].to_numpy()
        hashes = [np.asarray(x) for x in rows["hashes"]]
        across = key[1] != key[2]
        left = np.flatnonzero(rows["block"].to_numpy() == key[1])
        right = np.flatnonzero(rows["block"].to_numpy() == key[2]) if across else left
        links, up = np.zeros(len(cls), dtype=np.int64), np.arange(len(cls))

        def root(i: int) -> int:
            while up[i] != i:
                up[i] = up[up[i]]
                i = up[i]
            return i

        found = divide_skip([hashes[i] for i in left], [hashes[i] for i in right], percent, not across) if len(left) and len(right) else []
        for q, cand in found:
            i, others = left[q], right[cand]
            links[i] += copies[others].sum()
            links[others] += copies[i]
            for r in {root(j) for j in others.tolist()}:
                x, y = root(i), root(r)
                if x != y:
                    up[max(x, y, key=lambda z: cls[z])] = min(x, y, key=lambda z: cls[z])
        has = np.flatnonzero(links)
        to = np.array([root(i) for i in has.tolist()], dtype=np.int64)
        return pd.DataFrame({"cls": cls[has], "first": first[has], "other": cls[to], "other_first": first[to], "links": links[has]})

    return run


def linked(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Steps 1 to 4 for ``docs`` (doc_id, text, further numbers): its rows with their sets, the distinct sets, and links between these."""
    rows = stage(classify(docs, width), "classes")
    docs = docs.select("doc_id", "text")
    classes = stage(rows.where("n > 0").groupBy("n", "s1", "s2").agg(F.coalesce(F.min("doc_id"), F.lit(NO_ID)).alias("first"), F.count("*").alias("copies"))
                    .withColumn("cls", F.monotonically_increasing_id()), "numbers")

    # 2. Sets with enough shingles of their own are out.
    alone = (part_postings(docs, width, PART).groupBy("h").agg(F.min("s1").alias("s1"), F.max("s1").alias("last")).where("s1 = last")
             .groupBy("s1").agg(F.count("*").alias("own")))
    prefix = F.expr(f"n - (n * {percent} + 99) div 100 + 1")
    left = stage(classes.join(alone, "s1", "left").where(F.coalesce("own", F.lit(0)) < prefix)
                 .select("cls", "first", "n", "s1", "s2", "copies"), "suspects")
    known, nameless = left.where(F.col("first") != NO_ID), left.where(F.col("first") == NO_ID)
    kept = sets(docs.join(small_ids(known), F.col("doc_id") == F.col("first")).select("text", "cls", "first", "n", "s1", "s2", "copies"), width)
    if not nameless.isEmpty():
        loose = signed_sets(docs.where("doc_id IS NULL").select("text"), width).join(small_ids(nameless), ["n", "s1", "s2"])
        kept = kept.unionByName(loose.select(*kept.columns).dropDuplicates(["cls"]))
    kept = stage(kept, "sets")

    # 3. First shingles from rare to frequent, and the groups of sets that meet through them.
    postings = kept.select("cls", "n", F.explode("hashes").alias("h"))
    often = postings.groupBy("h").agg(F.count("*").alias("df")).where("df > 1")
    ranked = postings.join(often, "h").selectExpr(
        "cls", "n", "h", "row_number() OVER (PARTITION BY cls ORDER BY df, h) AS at", "count(*) OVER (PARTITION BY cls) AS common")
    lists = stage(ranked.where(F.col("at") <= prefix - (F.col("n") - F.col("common"))).select("h", "cls"), "lists")
    hubs = lists.groupBy("h").agg(F.min("cls").alias("hub"))
    groups = connected_components(lists.join(hubs, "h").where("cls != hub").select(F.col("cls").alias("a"), F.col("hub").alias("b")).distinct(),
                                  "meetings")

    # 4. Blocks: a small group shares its block with other small groups, a large one is dealt to pairs of blocks.
    sizes = groups.groupBy("component").agg(F.count("*").alias("size"))
    members = groups.join(sizes, "component").withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    members = stage(members.select(F.col("node").alias("cls"), "component", "blocks"), "members")
    together = max(1, members.where("blocks = 1").count() // BLOCK)
    mine = F.when(F.col("blocks") > 1, F.pmod(F.xxhash64("cls"), F.col("blocks"))).otherwise(0).cast("int")
    unit = F.when(F.col("blocks") > 1, F.concat(F.lit("g"), "component")).otherwise(
        F.concat(F.lit("s"), F.pmod(F.xxhash64("component"), F.lit(together))))
    dealt = (kept.join(members, "cls").select("*", unit.alias("unit"), mine.alias("block"))
             .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("unit", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block", "cls", "first", "n", "copies", "hashes"))
    found = stage(dealt.groupBy("unit", "i", "j").applyInPandas(search(percent), "cls long, first long, other long, other_first long, links long"), "links")

    return rows, classes, found


def link_edges(found: DataFrame) -> DataFrame:
    """The links as edges between (smallest document id, set)."""
    return found.select(F.struct("first", "cls").alias("a"), F.struct(F.col("other_first").alias("first"), F.col("other").alias("cls")).alias("b"))


def representatives(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, row (hash of the text), label (number of its set, null without words) and stays, of every row.

    A row stays if its set is the first of its component and its id the
    smallest of that set; unlike texts under one id are not one document here.
    Rows without id or words stay. Rows of one id and label that stay are
    copies of each other (their texts may differ in case or white space).
    """
    rows, classes, found = linked(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("row")), width, percent)
    component = connected_components(link_edges(found), "components").select(F.col("node.cls").alias("cls"), F.col("component.cls").alias("component"))
    classes = classes.join(component, "cls", "left").select("n", "s1", "s2", "cls", "first", (F.coalesce("component", "cls") == F.col("cls")).alias("leads"))
    return rows.join(classes, ["n", "s1", "s2"], "left").select(
        "doc_id", "row", F.col("cls").alias("label"),
        F.coalesce(F.col("doc_id").isNull() | F.col("cls").isNull() | (F.col("leads") & (F.col("doc_id") == F.col("first"))), F.lit(True)).alias("stays"))


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """key, n_shingles, component_id and n_links (other documents it links with) of every row.

    ``width``: words of a shingle; ``percent``: least Jaccard similarity.
    """
    rows, classes, found = linked(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")), width, percent)

    # 5. Components of the links and of repeated ids, by each set's smallest document id, and their documents.
    edges = link_edges(found)
    sign = F.struct("n", "s1", "s2")
    again = stage(rows.where("doc_id IS NOT NULL AND n > 0").groupBy("doc_id").agg(F.min(sign).alias("lo"), F.max(sign).alias("hi")).where("lo != hi").select("doc_id"), "again")
    if not again.isEmpty():
        held = rows.join(again, "doc_id", "left_semi").join(classes, ["n", "s1", "s2"]).select("doc_id", F.struct("first", "cls").alias("a")).distinct()
        edges = edges.unionByName(held.join(held.groupBy("doc_id").agg(F.min("a").alias("b")), "doc_id").select("a", "b"))
    component = connected_components(edges, "components").select(F.col("node.cls").alias("cls"), F.col("component.first").alias("component"))
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    classes = classes.join(component, "cls", "left").join(links, "cls", "left").select(
        "n", "s1", "s2", "copies", F.nullif(F.coalesce("component", "first"), F.lit(NO_ID)).alias("component"), "links")
    return (rows.join(classes, ["n", "s1", "s2"], "left").select(
        F.col("doc_id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"),
        (F.coalesce(F.col("copies") - 1, F.lit(0)) + F.coalesce("links", F.lit(0))).cast("long").alias("n_links")))


def op6_ngram_join(spark, sf_dir):
    """Components of all documents whose sets of 4-word shingles reach a Jaccard similarity of 0.85."""
    return join(table(spark, sf_dir, "documents", "doc_id", "text"), width=4, percent=85)


OP6_SQL = r"""
WITH RECURSIVE tokens AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM tokens WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * k >= 85 * (p.n + q.n - k)),
reach AS (SELECT doc_id AS x, doc_id AS c FROM tokens UNION SELECT l.y, r.c FROM reach r JOIN links l ON l.x = r.x),
comps AS (SELECT x, min(c) AS component_id FROM reach GROUP BY x)
SELECT t.doc_id, coalesce(n, 0) AS n_shingles, component_id, coalesce((SELECT count(*) FROM links l WHERE l.x = t.doc_id), 0) AS n_links
FROM tokens t LEFT JOIN sizes USING (doc_id) JOIN comps ON comps.x = t.doc_id
"""
