"""Reversible line deduplication: sharded cuckoo filters over exact reference counts.

A line's key is the line without ASCII white space at its ends and with A-Z
lower-cased; keys under ``min_chars`` code points take no part. Of a key that
several documents hold, only the lines of the smallest document id stay.

The store keeps three tables:

* ``postings``: one row per line (128-bit key digest, document, position);
* ``refs``: the exact reference count, smallest and largest document per key;
* ``filters``: one cuckoo filter per shard of the key space. A key held by one
  document has one copy of its fingerprint there, a key held by several has
  two. A look-up thus says "absent", "held" or "perhaps shared", and never
  misses a key.

``insert`` probes the filters with the batch's distinct keys; only keys that
may be present meet the exact table. ``delete`` recounts the keys of the
documents that go, from the postings that stay, and takes fingerprints out of
the filters again, so a later document gets its line back. ``resolve`` probes
the filters with the documents' lines, checks the few that may be shared
against the exact table, and drops lines.

Every attempt of a step writes to a folder of its own. The step counts once a
manifest row that names its tables is written, as the last thing; a step that
fails before leaves the last version whole and can be done again.
``LineStore.open`` reads the newest manifest, so later jobs go on with a store.
When the keys outgrow the shards, their number doubles and the filters are
built anew from the exact table (amortised: once per doubling). Deletions are
kept as lists of ids; every ``COMPACT_AFTER`` of them the postings are written
without the deleted documents.

Defined results: a null or empty text is one empty line; a document without id
neither counts nor loses lines; rows that repeat an id are one document (their
lines stay or go together); an empty table gives an empty store and result;
other columns are not read.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workpulse.llm.common import shared_path, table

MIN_CHARS = 10
#: Keys that one filter holds, about, at most.
KEYS_PER_SHARD = 16_384
#: Deletions after which the postings are written anew without them.
COMPACT_AFTER = 4
#: Lines that one task probes against one filter.
LINES_PER_PROBE = 50_000
SLOTS = 4
SPACE = b" \t\n\x0b\x0c\r"

POSTINGS = "hi long, lo long, doc_id long, row long, pos int, batch int"
REFS = "hi long, lo long, n long, first_doc long, last_doc long"
FILTERS = "shard int, slots binary"
MANIFEST = "version long, state string"


class CuckooFilter:
    """16-bit fingerprints in buckets of four, changed for whole arrays of keys at once."""

    def __init__(self, slots: np.ndarray):
        self.slots = slots.reshape(-1, SLOTS)
        self.mask = np.int64(len(self.slots) - 1)

    @classmethod
    def empty(cls, copies: int) -> CuckooFilter:
        """Room for ``copies`` fingerprints at a load of at most three quarters."""
        buckets = 1 << max(2, int(np.ceil(np.log2(max(1, copies) / (0.75 * SLOTS)))))
        return cls(np.zeros(buckets * SLOTS, dtype=np.uint16))

    def where(self, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        fp = (lo & 0xFFFF).astype(np.uint16)
        fp[fp == 0] = 1
        return fp, (lo >> 16) & self.mask

    def other(self, fp: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        return bucket ^ ((fp.astype(np.int64) * 0x5BD1E995 >> 7) & self.mask)

    def copies(self, lo: np.ndarray) -> np.ndarray:
        fp, a = self.where(lo)
        b = self.other(fp, a)
        n = (self.slots[a] == fp[:, None]).sum(1)
        return n + np.where(a != b, (self.slots[b] == fp[:, None]).sum(1), 0)

    def add(self, lo: np.ndarray, rounds: int = 400) -> bool:
        """Place one copy of each key; False if some found no place (the filter is then to be rebuilt larger)."""
        fp, b = self.where(lo)
        for turn in range(rounds):
            if not len(fp):
                return True
            order = np.argsort(b, kind="stable")
            fp, b = fp[order], b[order]
            new = np.r_[True, b[1:] != b[:-1]]
            rank = np.arange(len(b)) - np.flatnonzero(new)[np.cumsum(new) - 1]
            free = self.slots[b] == 0
            spot = free & (np.cumsum(free, 1) == rank[:, None] + 1)
            ok = spot.any(1)
            self.slots[b[ok], spot[ok].argmax(1)] = fp[ok]
            fp, b, head = fp[~ok], b[~ok], (rank == 0)[~ok]
            if turn >= 1 and head.any():  # the first one of a full bucket takes a slot, its owner moves on
                at = (b[head], np.full(head.sum(), turn % SLOTS))
                out = self.slots[at].copy()
                self.slots[at] = fp[head]
                fp[head] = out
            b = self.other(fp, b)
        return not len(fp)

    def remove(self, lo: np.ndarray) -> None:
        """Take one copy of each key out."""
        fp, a = self.where(lo)
        while len(fp):
            b = self.other(fp, a)
            _, first = np.unique(np.stack([np.minimum(a, b), fp.astype(np.int64)], 1), axis=0, return_index=True)
            left = first  # one copy per fingerprint and pair of buckets in each turn
            for side in (a, b):
                hit = self.slots[side[left]] == fp[left][:, None]
                found = hit.any(1)
                self.slots[side[left][found], hit[found].argmax(1)] = 0
                left = left[~found]
            rest = np.ones(len(fp), dtype=bool)
            rest[first] = False
            fp, a = fp[rest], a[rest]


def changed_filter(shard: int, old: bytes | None, lo: np.ndarray, delta: np.ndarray) -> bytes | None:
    """A shard's filter after adding or taking out copies; None if it has to be rebuilt larger."""
    if old is None:
        f = CuckooFilter.empty(int(delta[delta > 0].sum()))
    else:
        f = CuckooFilter(np.frombuffer(old, dtype=np.uint16).copy())
    for k in (1, 2):
        f.remove(lo[delta <= -k])
    if (f.slots != 0).sum() + delta[delta > 0].sum() > 0.85 * f.slots.size:
        return None
    return f.slots.tobytes() if all(f.add(lo[delta >= k]) for k in (1, 2)) else None


def line_keys(text: str | None, min_chars: int):
    """(position, 16-byte digest) of every line of the text that takes part."""
    for pos, line in enumerate((text or "").encode().split(b"\n")):
        key = line.strip(SPACE).lower()  # of bytes: A-Z only
        if len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars):
            yield pos, blake2b(key, digest_size=16).digest()


def explode_lines(docs: DataFrame, batch: int, min_chars: int) -> DataFrame:
    """``docs``: doc_id, text. One row per line that takes part."""
    def run(batches):
        for b in batches:
            ids, rows, pos, keys = [], [], [], []
            for doc, row, text in zip(*(b.column(i).to_pylist() for i in range(3))):
                before = len(keys)
                for p, k in line_keys(text, min_chars):
                    pos.append(p)
                    keys.append(k)
                ids += [doc] * (len(keys) - before)
                rows += [row] * (len(keys) - before)
            kid = np.frombuffer(b"".join(keys), dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(kid[:, 0].copy()), pa.array(kid[:, 1].copy()), pa.array(ids, pa.int64()), pa.array(rows, pa.int64()),
                 pa.array(pos, pa.int32()), pa.array(np.full(len(ids), batch, dtype=np.int32))],
                names=["hi", "lo", "doc_id", "row", "pos", "batch"])

    rows = docs.where("doc_id IS NOT NULL").select("doc_id", row_hash(), "text")
    return rows.mapInArrow(run, POSTINGS)


def row_hash():
    """Tells apart rows that repeat an id with other texts."""
    return F.xxhash64("text").alias("row")


def counted(postings: DataFrame) -> DataFrame:
    return postings.groupBy("hi", "lo").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc"),
                                            F.max("doc_id").alias("last_doc"))


def copies_of(first, last):
    """Copies that a key's fingerprint has: none, one, or two if documents share it."""
    return F.when(first.isNull(), 0).when(first < last, 2).otherwise(1)


@dataclass
class LineStore:
    """State of the corpus seen so far, under ``path`` in a shared folder. One writer at a time."""

    spark: SparkSession
    path: str
    min_chars: int = MIN_CHARS
    state: dict = field(default_factory=lambda: {"version": 0, "shards": 0, "batches": [], "refs": None, "filters": None, "dead": []})

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> LineStore:
        """The store that earlier steps, of this or another session, left under ``path``."""
        rows = spark.read.schema(MANIFEST).json(f"{path}/manifests")
        newest = rows.agg(F.max_by("state", "version").alias("state")).first()["state"]
        if newest is None:
            raise ValueError(f"no line store under {path}")
        said = json.loads(newest)
        return cls(spark, path, said.pop("min_chars"), said)

    def _attempt(self) -> tuple[int, str]:
        """The next version, and a folder that no other attempt at it writes to."""
        v = self.state["version"] + 1
        return v, f"{self.path}/v{v}-{uuid.uuid4().hex}"

    def _publish(self, state: dict) -> None:
        """Make ``state`` the one in force: one row, written by one task, seen whole or not at all."""
        row = (state["version"], json.dumps(state | {"min_chars": self.min_chars}))
        self.spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("append").json(f"{self.path}/manifests")
        self.state = state

    def _read(self, where: str | None, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(where) if where else self.spark.createDataFrame([], schema)

    def refs(self) -> DataFrame:
        return self._read(self.state["refs"], REFS)

    def filters(self) -> DataFrame:
        return self._read(self.state["filters"], FILTERS)

    def postings(self) -> DataFrame:
        """The lines of all live documents: a deletion covers the batches before it."""
        s = self.state
        if not s["batches"]:
            return self._read(None, POSTINGS)
        p = self.spark.read.schema(POSTINGS).parquet(*s["batches"])
        for where, upto in s["dead"]:
            gone = self.spark.read.schema("doc_id long").parquet(where).withColumn("upto", F.lit(upto))
            p = p.join(gone, (p.doc_id == gone.doc_id) & (p.batch < gone.upto), "left_anti")
        return p

    def shard(self, shards: int | None = None):
        return F.pmod(F.col("hi"), F.lit(shards or self.state["shards"])).cast("int").alias("shard")

    def insert(self, docs: DataFrame) -> None:
        """Add documents (doc_id, text)."""
        s, (v, where) = self.state, self._attempt()
        explode_lines(docs, v, self.min_chars).write.parquet(f"{where}/postings")
        new = counted(self.spark.read.schema(POSTINGS).parquet(f"{where}/postings"))
        if s["refs"] is None:
            refs = new.withColumn("was", F.lit(0))
        else:
            probed = self._probed(new)
            known, fresh = probed.where("copies > 0").drop("copies"), probed.where("copies = 0").drop("copies")
            old = self.refs().selectExpr("hi", "lo", "n AS n0", "first_doc AS f0", "last_doc AS l0")
            merged = old.join(known, ["hi", "lo"], "full_outer").select(
                "hi", "lo", (F.coalesce("n", F.lit(0)) + F.coalesce("n0", F.lit(0))).alias("n"),
                F.least("first_doc", "f0").alias("first_doc"), F.greatest("last_doc", "l0").alias("last_doc"),
                copies_of(F.col("f0"), F.col("l0")).alias("was"))
            refs = merged.unionByName(fresh.select("hi", "lo", "n", "first_doc", "last_doc", F.lit(0).alias("was")))
        self._commit(where, refs, version=v, batches=[*s["batches"], f"{where}/postings"])

    def delete(self, ids: DataFrame) -> None:
        """Take documents (doc_id) out again."""
        s, (v, where) = self.state, self._attempt()
        if s["refs"] is None:
            return
        dead = f"{where}/dead"
        ids.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long")).distinct().write.parquet(dead)
        gone = self.spark.read.schema("doc_id long").parquet(dead)
        before = self.postings()
        touched = before.join(gone, "doc_id", "left_semi").select("hi", "lo").distinct()
        rest = before.join(gone, "doc_id", "left_anti")
        again = counted(rest.join(touched, ["hi", "lo"], "left_semi"))
        again = touched.join(again, ["hi", "lo"], "left").withColumnsRenamed({"n": "n1", "first_doc": "f1", "last_doc": "l1"})
        refs = self.refs().join(again.withColumn("hit", F.lit(True)), ["hi", "lo"], "left").select(
            "hi", "lo", F.expr("if(hit, n1, n) AS n"), F.expr("if(hit, f1, first_doc) AS first_doc"),
            F.expr("if(hit, l1, last_doc) AS last_doc"), copies_of(F.col("first_doc"), F.col("last_doc")).alias("was"))
        if len(s["dead"]) + 1 < COMPACT_AFTER:
            self._commit(where, refs, version=v, dead=[*s["dead"], [dead, v]])
        else:
            rest.write.parquet(f"{where}/postings")
            self._commit(where, refs, version=v, batches=[f"{where}/postings"], dead=[])

    def _commit(self, where: str, refs: DataFrame, **change) -> None:
        """Write the exact table (with the copies each key had before), bring the filters in line with it, and publish both."""
        refs.write.parquet(f"{where}/counts")
        refs = self.spark.read.schema(REFS + ", was int").parquet(f"{where}/counts")
        had = self.state["shards"]
        shards = max(had, 1 << max(0, int(np.ceil(np.log2(max(1, refs.where("n > 0").count()) / KEYS_PER_SHARD)))))
        now = copies_of(F.col("first_doc"), F.col("last_doc"))
        steps = refs.select(self.shard(shards), "lo", now.alias("copies"), (now - F.col("was")).alias("delta"))
        filters = self._changed(steps, where) if shards == had or not had else self._built(steps, where)
        self._publish(self.state | {"shards": shards, "refs": f"{where}/counts", "filters": filters} | change)

    def _built(self, steps: DataFrame, where: str, kept: DataFrame | None = None) -> str:
        """Filters of all keys in ``steps``, built from the exact table, beside the ``kept`` ones."""
        def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            room = 2 * max(1, int(rows["copies"].sum()))
            while (got := changed_filter(key[0], CuckooFilter.empty(room).slots.tobytes(), rows["lo"].to_numpy(),
                                         rows["copies"].to_numpy())) is None:
                room *= 2
            return pd.DataFrame({"shard": [key[0]], "slots": [got]})

        built = steps.where("copies > 0").groupBy("shard").applyInPandas(build, FILTERS)
        (built if kept is None else kept.unionByName(built)).write.parquet(f"{where}/filters")
        return f"{where}/filters"

    def _changed(self, steps: DataFrame, where: str) -> str:
        """The filters in force with the steps' changes made; shards that outgrow theirs are built anew."""
        old = self.filters()

        def change_one(key: tuple, changes: pd.DataFrame, kept: pd.DataFrame) -> pd.DataFrame:
            had = kept["slots"].iloc[0] if len(kept) else None
            got = changed_filter(key[0], had, changes["lo"].to_numpy(), changes["delta"].to_numpy())
            return pd.DataFrame({"shard": [key[0]], "slots": [got]})

        (steps.where("delta != 0").groupBy("shard").cogroup(old.groupBy("shard"))
         .applyInPandas(change_one, FILTERS).write.parquet(f"{where}/changed"))
        filters = self.spark.read.schema(FILTERS).parquet(f"{where}/changed")
        full = filters.where("slots IS NULL").select("shard")
        if full.isEmpty():
            return f"{where}/changed"
        return self._built(steps.join(full, "shard", "left_semi"), where, filters.where("slots IS NOT NULL"))

    def _probed(self, keys: DataFrame) -> DataFrame:
        """``keys`` (hi, lo, ...) with the copies that their shard's filter shows.

        A shard with very many rows (a line that a third of all documents hold)
        is dealt to several tasks, each with the shard's filter.
        """
        cols = keys.columns
        schema = ", ".join(f"{c} {t}" for c, t in keys.dtypes) + ", copies int"
        keys, filters = keys.select("*", self.shard()), self.filters()
        heavy = (keys.groupBy("shard").count().where(F.col("count") > LINES_PER_PROBE)
                 .select("shard", F.ceil(F.col("count") / LINES_PER_PROBE).cast("int").alias("tasks")))
        keys = keys.join(heavy, "shard", "left").select(
            *cols, "shard", F.pmod(F.xxhash64(*cols), F.coalesce("tasks", F.lit(1))).cast("int").alias("salt"))
        heavy = heavy.toDF("_shard", "_tasks")  # other names: both sides of the cogroup come from it
        filters = filters.join(heavy, F.col("shard") == F.col("_shard"), "left").selectExpr(
            "shard", "slots", "explode(sequence(0, coalesce(_tasks, 1) - 1)) AS salt")

        def look(key: tuple, rows: pd.DataFrame, kept: pd.DataFrame) -> pd.DataFrame:
            out = rows[cols].copy()
            if len(kept):
                n = CuckooFilter(np.frombuffer(kept["slots"].iloc[0], dtype=np.uint16)).copies(rows["lo"].to_numpy())
            else:
                n = np.zeros(len(rows))
            out["copies"] = n.astype(np.int32)
            return out

        return (keys.groupBy("shard", "salt").cogroup(filters.groupBy("shard", "salt"))
                .applyInPandas(look, schema))

    def resolve(self, docs: DataFrame, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
        """Of inserted documents: key, ``keep``, text, n_lines, n_dropped and kept (the text without its dropped lines)."""
        docs = docs.select(F.col(key).alias("doc_id"), *keep, F.col(text).alias("text")).select("*", row_hash())
        if self.state["refs"] is None:
            dropped = self.spark.createDataFrame([], "doc_id long, row long, gone array<int>")
        else:
            maybe = self._probed(self.postings().drop("batch")).where("copies >= 2").drop("copies")
            shared = self.refs().where("first_doc < last_doc").select("hi", "lo", "first_doc")
            dropped = (maybe.join(shared, ["hi", "lo"]).where("doc_id != first_doc")
                       .groupBy("doc_id", "row").agg(F.collect_set("pos").alias("gone")))
        lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
        stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("gone"))
        return (docs.join(dropped, ["doc_id", "row"], "left").withColumn("_lines", lines).select(
            F.col("doc_id").alias(key), *keep, "text", F.size("_lines").cast("long").alias("n_lines"),
            F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_dropped"),
            F.when(F.col("gone").isNull(), F.coalesce("text", F.lit("")))
            .otherwise(F.array_join(F.transform(stay, lambda i: F.get("_lines", i)), "\n")).alias("kept")))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Insert ``docs`` into a new store and resolve them."""
    store = LineStore(docs.sparkSession, shared_path(docs.sparkSession, "lines"))
    store.insert(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")))
    return store.resolve(docs, key, text, keep)


def op1_line_dedup(spark, sf_dir):
    """Line dedup over all documents, as digests."""
    out = dedup_lines(table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept", "utf-8"), 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
         translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
held AS (
  SELECT key, min(doc_id) AS first_doc FROM keyed WHERE length(key) >= 10 AND doc_id IS NOT NULL
  GROUP BY key HAVING min(doc_id) < max(doc_id)),
marked AS (
  SELECT k.doc_id, k.pos, k.line, coalesce(k.doc_id <> h.first_doc, false) AS gone
  FROM keyed k LEFT JOIN held h ON k.key = h.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
