"""MinHash near-duplicates with sequential Bayesian verification.

1. Every document is the set of its hashed word shingles, with a signature of
   ``HASHES`` minimum hashes. Equal sets become one class.
2. Signatures are cut into bands of ``BAND`` hashes; classes that agree on a
   band are candidates. A pair of similarity 0.8 agrees on none of the bands
   with a probability below 1e-7.
3. A pair's signatures are compared in batches. With m of the first n hashes
   equal and a uniform prior, the similarity has a Beta(m + 1, n - m + 1)
   posterior; the pair is dropped once the posterior probability of reaching
   the threshold is below ``MISS``. A survivor is verified on the full sets.
4. Pairs are not listed within a bucket of candidates. In each of
   ``ROUNDS`` rounds, every bucket whose members lie in several components
   names a leader, the class with the most candidates in common with others
   (from the second round on, one outside the first leader's component), and
   only leader and members of other components are compared. A group of
   copies falls to one component after as many comparisons as it has members.
5. What is still open then, i.e. a bucket with several components, is settled
   by blocks of the classes that meet in such buckets: pairs that share a band
   and lie in unlike components are tested and verified in the task, which
   answers only with links that join components. No link is lost to a cap.

Shingles are 64-bit hashes; a chance collision can move one overlap by one.

Defined results: a null or empty text, or one without words, has an empty set
and is linked with nothing; equal sets are linked; a row without id gets the
smallest id that its links reach, or null, and is kept only in the latter
case; the texts of a repeated id are one component; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from workpulse.llm.common import connected_components, small_ids, stage, table
from workpulse.llm.ngram_join import hashed, sets, signatures, signed_sets

#: Hashes of a signature, of a band, and of a batch of the sequential test.
HASHES, BAND, BATCH = 128, 4, 16
#: Posterior probability of a link at which a pair is dropped.
MISS = 1e-6
ROUNDS = 2
#: Classes in a block of step 5.
BLOCK = 512
#: Stands for the smallest id of a class whose rows have none; behind all others.
NO_ID = 2**63 - 1

_random = np.random.default_rng(13)
#: Fixed: each hash of a signature is a 32-bit linear function of a shingle's hash.
FACTOR = _random.integers(0, 2**31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
SHIFT = _random.integers(0, 2**32, HASHES, dtype=np.uint32)


def least_matches(percent: int, miss: float = MISS) -> list[int]:
    """For each batch's end n: the fewest equal hashes with P(similarity >= percent / 100) >= miss."""
    t = percent / 100
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        # P(Beta(m + 1, n - m + 1) >= t) = P(Binomial(n + 1, t) <= m)
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return out


def minhashes(h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """(sets, HASHES) minimum hashes of the sets that lie behind one another in ``h``; empty sets get zeros."""
    out = np.zeros((len(n), HASHES), dtype=np.uint32)
    full = np.flatnonzero(n)
    if len(full):
        start = (np.cumsum(n) - n)[full]
        x = (h ^ (h >> np.uint64(32))).astype(np.uint32)
        with np.errstate(over="ignore"):
            for k in range(HASHES):
                out[full, k] = np.minimum.reduceat(x * FACTOR[k] + SHIFT[k], start)
    return out


def signed(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n, s1, s2, sig of every row of ``docs`` (doc_id, text)."""
    def run(batches):
        for b in batches:
            for first, rows, h, n in hashed(b, 1, width):
                s1, s2 = signatures(h, n)
                sig = minhashes(h, n).tobytes()
                offsets = np.arange(rows + 1, dtype=np.int32) * (4 * HASHES)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, rows), pa.array(n.astype(np.int64)), pa.array(s1), pa.array(s2),
                                                  pa.BinaryArray.from_buffers(pa.binary(), rows, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(sig)])],
                                                 names=["doc_id", "n", "s1", "s2", "sig"])
    return docs.mapInArrow(run, "doc_id long, n long, s1 long, s2 long, sig binary")


def bands() -> Column:
    """(band, bucket) for each band of ``sig``; a row each."""
    key = lambda b: F.xxhash64(b, F.substring("sig", b * (4 * BAND) + 1, F.lit(4 * BAND)))
    return F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(HASHES // BAND - 1)), key)).alias("band", "bucket")


def survives(x: np.ndarray, y: np.ndarray, least: list[int]) -> np.ndarray:
    """Pairs of signatures (rows of x and y) that the sequential test does not drop."""
    left = np.arange(len(x))
    same = np.zeros(len(x), dtype=np.int64)
    for k, need in enumerate(least):
        part = slice(k * BATCH, (k + 1) * BATCH)
        same = same + (x[left, part] == y[left, part]).sum(1)
        stay = same >= need
        left, same = left[stay], same[stay]
    return left


def signature_rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint32).reshape(len(column), HASHES)


def linked(pairs: DataFrame, classes: DataFrame, kept: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose full sets reach the threshold, after the sequential test."""
    least = least_matches(percent)

    def prune(batches):
        for batch in batches:
            if batch.num_rows:
                left = survives(signature_rows(batch.column(2)), signature_rows(batch.column(3)), least)
                yield batch.select(["a", "b"]).take(pa.array(left))

    def verify(batches):
        for batch in batches:
            stay = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (v.values.to_numpy() for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                stay.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(stay, pa.bool_()))

    def side(values: DataFrame, c: str, name: str) -> DataFrame:
        return values.select(F.col("cls").alias(c), F.col(name).alias(f"{name}_{c}"))

    both = pairs.join(side(classes, "b", "sig"), "b").join(side(classes, "a", "sig"), "a")
    pairs = stage(both.select("a", "b", "sig_a", "sig_b").mapInArrow(prune, "a long, b long"), "survivors")
    both = pairs.join(side(kept, "b", "hashes"), "b").join(side(kept, "a", "hashes"), "a")
    return both.select("a", "b", "hashes_a", "hashes_b").mapInArrow(verify, "a long, b long")


def led(members: DataFrame, first: bool) -> DataFrame:
    """(a, b): each open bucket's leader and its members of other components, once."""
    leader = F.max(F.struct("weight", (-F.col("cls")).alias("back"), "comp"))
    top = members.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), leader.alias("lead")).where("lo != hi").select("bucket", "lead")
    if not first:
        rest = members.join(top, "bucket").where("comp != lead.comp")
        top = rest.groupBy("bucket").agg(leader.alias("lead"))
    pairs = members.join(top, "bucket").where("comp != lead.comp").select((-F.col("lead.back")).alias("x"), "cls")
    return pairs.select(F.least("x", "cls").alias("a"), F.greatest("x", "cls").alias("b")).distinct()


def reach(q: np.ndarray, others: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of ``others`` link with ``q``; the hashes of ``q`` ascend."""
    size = np.array([len(x) for x in others])
    flat = np.concatenate(others)
    hit = q[np.minimum(np.searchsorted(q, flat), len(q) - 1)] == flat
    both = np.add.reduceat(hit.astype(np.int64), np.cumsum(size) - size)
    return np.flatnonzero(100 * both >= percent * (len(q) + size - both))


def open_groups(members: DataFrame) -> DataFrame:
    """(cls, comp, group, blocks) of the classes in open buckets; classes that meet, in some steps, share a group."""
    opened = (members.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("cls").alias("hub")).where("lo != hi").select("bucket", "hub"))
    meet = members.join(opened, "bucket")
    groups = connected_components(meet.select(F.col("cls").alias("a"), F.col("hub").alias("b")), "meetings").withColumnsRenamed({"node": "cls", "component": "group"})
    size = groups.groupBy("group").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    return meet.select("cls", "comp").distinct().join(groups, "cls").join(size, "group")


def crossed(groups: DataFrame, suspects: DataFrame, kept: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that join all components with a link between them, by blocks of the groups.

    A task compares the pairs of two blocks that share a band and lie in
    unlike components, prunes them by the sequential test, verifies the rest
    on the full sets, and answers with one link for each two components that it
    joins: never with all pairs.
    """
    least = least_matches(percent)
    together = max(1, groups.where("blocks = 1").count() // BLOCK)
    mine = F.when(F.col("blocks") > 1, F.pmod(F.xxhash64("cls"), F.col("blocks"))).otherwise(0).cast("int")
    unit = F.when(F.col("blocks") > 1, F.concat(F.lit("g"), "group")).otherwise(F.concat(F.lit("s"), F.pmod(F.xxhash64("group"), F.lit(together))))
    rows = (groups.join(suspects.select("cls", "sig"), "cls").join(kept, "cls")
            .select("*", unit.alias("unit"), mine.alias("block"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with"))
            .select("unit", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block", "cls", "comp", "sig", "hashes"))

    def compare(key: tuple, part: pa.Table) -> pa.Table:
        i, j = key[1].as_py(), key[2].as_py()
        block, cls, comp = (part.column(c).to_numpy().copy() for c in ("block", "cls", "comp"))
        sig = signature_rows(part.column("sig"))
        bands_of = sig.reshape(len(sig), HASHES // BAND, BAND)
        hashes = [x.values.to_numpy().view(np.uint64) for x in part.column("hashes")]  # they ascend as unsigned numbers
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        found = []
        for q in left:
            to = right[(comp[right] != comp[q]) & ((cls[right] > cls[q]) | (i != j))]
            to = to[(bands_of[to] == bands_of[q]).all(2).any(1)]
            if len(to):
                to = to[survives(np.broadcast_to(sig[q], (len(to), HASHES)), sig[to], least)]
            if len(to):
                for y in to[reach(hashes[q], [hashes[k] for k in to], percent)]:
                    if comp[y] != comp[q]:
                        found.append((cls[q], cls[y]))
                        comp[comp == comp[y]] = comp[q]
        return pa.table({c: pa.array([x[k] for x in found], pa.int64()) for k, c in enumerate(("a", "b"))})

    return rows.groupBy("unit", "i", "j").applyInArrow(compare, "a long, b long")


def merged(links: list[DataFrame]) -> DataFrame:
    """(cls, comp): the smallest class within two links. Equal labels lie in one component; a leader's group gets one label.

    Two steps instead of all components are enough here: what they leave
    apart stays open, and is settled by the next round or by the blocks.
    """
    edges = links[0]
    for more in links[1:]:
        edges = edges.unionByName(more)
    both = stage(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "both")
    near = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    far = both.join(near.select(F.col("a").alias("b"), "m"), "b").groupBy("a").agg(F.min("m").alias("far"))
    return near.join(far, "a").select(F.col("a").alias("cls"), F.least("m", "far").alias("comp"))


def components(links: list[DataFrame], name: str) -> DataFrame:
    edges = links[0]
    for more in links[1:]:
        edges = edges.unionByName(more)
    return connected_components(edges, name).select(F.col("node").alias("cls"), F.col("component").alias("comp"))


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """key, n_shingles, component_id and kept of every row.

    ``width``: words of a shingle; ``percent``: least Jaccard similarity (bands are made for 80 and above).
    """
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = stage(signed(docs, width), "signatures")
    classes = stage(rows.where("n > 0").groupBy("n", "s1", "s2").agg(F.coalesce(F.min("doc_id"), F.lit(NO_ID)).alias("first"), F.first("sig").alias("sig"))
                    .withColumn("cls", F.monotonically_increasing_id()), "classes")

    # 2. Buckets with two classes or more.
    postings = classes.select("cls", bands())
    shared = postings.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    met = stage(postings.join(shared, "bucket"), "buckets")
    weight = met.groupBy("cls").agg(F.sum("size").alias("weight"))
    suspects = stage(classes.join(weight, "cls").select("cls", "n", "s1", "s2", "first", "weight", "sig"), "suspects")
    met = met.select("bucket", "band", "cls").join(suspects.select("cls", "weight"), "cls")

    # Their full sets.
    wanted = suspects.select("cls", "first", "n", "s1", "s2", F.lit(1).cast("long").alias("copies"))
    known, nameless = wanted.where(F.col("first") != NO_ID), wanted.where(F.col("first") == NO_ID)
    kept = sets(docs.join(small_ids(known, 250_000), F.col("doc_id") == F.col("first")).select("text", "cls", "first", "n", "s1", "s2", "copies"), width).select("cls", "hashes")
    if not nameless.isEmpty():
        kept = kept.unionByName(signed_sets(docs.where("doc_id IS NULL").select("text"), width).join(nameless, ["n", "s1", "s2"]).select("cls", "hashes"))
    kept = stage(kept.dropDuplicates(["cls"]), "sets")

    # 3. and 4. Leaders first; then 5., all that is open.
    links: list[DataFrame] = []
    members = met.withColumn("comp", F.col("cls"))
    for k in range(ROUNDS):
        pairs = stage(led(members, not k), "led")
        if pairs.isEmpty():
            break
        links.append(stage(linked(pairs, suspects, kept, percent), "links"))
        members = stage(met.join(merged(links), "cls", "left").withColumn("comp", F.coalesce("comp", "cls")), "members")
    else:
        links.append(stage(crossed(stage(open_groups(members), "groups"), suspects, kept, percent), "links"))

    # Components of the links and of repeated ids, named by their smallest document id.
    sign = F.struct("n", "s1", "s2")
    again = stage(rows.where("doc_id IS NOT NULL AND n > 0").groupBy("doc_id").agg(F.min(sign).alias("lo"), F.max(sign).alias("hi")).where("lo != hi").select("doc_id"), "again")
    if not again.isEmpty():
        held = rows.join(again, "doc_id", "left_semi").join(classes, ["n", "s1", "s2"]).select("doc_id", "cls").distinct()
        links.append(held.join(held.groupBy("doc_id").agg(F.min("cls").alias("b")), "doc_id").select(F.col("cls").alias("a"), "b"))
    named = classes.select("n", "s1", "s2", "cls", "first")
    if links:
        named = named.join(components(links, "components"), "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
        named = named.join(named.groupBy("comp").agg(F.min("first").alias("least")), "comp")
    else:
        named = named.withColumn("least", F.col("first"))
    named = named.select("n", "s1", "s2", F.nullif(F.col("least"), F.lit(NO_ID)).alias("component"))
    out = rows.select("doc_id", "n", "s1", "s2").join(named, ["n", "s1", "s2"], "left").withColumn("component_id", F.coalesce("component", "doc_id"))
    stays = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    return out.select(F.col("doc_id").alias(key), F.col("n").alias("n_shingles"), "component_id", stays.alias("kept"))


def op13_near_dedup(spark, sf_dir):
    """Components of all documents whose sets of 4-word shingles reach a Jaccard similarity of 0.8."""
    return dedup(table(spark, sf_dir, "documents", "doc_id", "text"), width=4, percent=80)


OP13_SQL = r"""
WITH RECURSIVE tokens AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM tokens WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * k >= 80 * (p.n + q.n - k)),
reach AS (SELECT doc_id AS x, doc_id AS c FROM tokens UNION SELECT l.y, r.c FROM reach r JOIN links l ON l.x = r.x),
comps AS (SELECT x, min(c) AS component_id FROM reach GROUP BY x)
SELECT t.doc_id, coalesce(n, 0) AS n_shingles, component_id, t.doc_id = component_id AS kept
FROM tokens t LEFT JOIN sizes USING (doc_id) JOIN comps ON comps.x = t.doc_id
"""
