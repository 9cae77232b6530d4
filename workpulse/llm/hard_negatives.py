"""Hard-negative mining by BOND: a vertical scan that shrinks a bitmap of candidates, dimension by dimension.

Vectors are stored in columns: a block holds up to ``BLOCK_ROWS`` rows, one
array for each dimension, and each dimension's smallest and largest value.
For one anchor a block's dimensions are read in the order of the anchor's
magnitudes, largest first, ``STEP`` at a time. After each step the dimensions
not yet read can add at least ``low`` and at most ``high`` to a candidate's
score (from the block's smallest and largest values), and

1. positives: a candidate of the anchor's label stays in the bitmap while its
   highest possible score reaches the fifth best lowest possible one;
2. negatives: a candidate of another label stays while it may still fall into
   one of the windows that the positives' scores open, and may still be among
   the first three there.

What is left when all dimensions are read has its exact score. A task keeps
the best rows of each anchor over all its blocks, so later blocks are pruned
by earlier ones; Spark merges the tasks' answers.

Anchors are a stated query set. They go out in slices of at most
``SLICE_BYTES`` (counted), each read against all blocks; no slice is left out.

Defined results: a row with a null label or vector, or a null or non-finite
component, takes no part; neither does one with a component of
``LIMIT`` / 256 or more in magnitude, whose scores could leave 64 bits.
Vectors of unlike lengths are compared as if the shorter one went on with
zeros; an empty vector scores 0 with all. A row without id is no anchor and
comes last among ties. Repeated rows are rows of their own, as anchors and as
candidates; a row is never its own positive. Equal scores and ids of unlike
rows stay in a fixed order of labels. An empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workpulse.llm.common import stage, table

#: Rows of a block.
BLOCK_ROWS = 4096
#: Dimensions read between two looks at the bitmap.
STEP = 8
#: Bound of the anchors (integers, windows) that are sent out at once.
SLICE_BYTES = 32_000_000
#: Least and greatest share of a positive's score, in percent, that a hard negative has.
WINDOW = (50, 95)
POSITIVES, NEGATIVES = 5, 3
#: Bound of a component's magnitude after scaling; 32,768 dimensions stay in 64 bits.
LIMIT = 1 << 24
#: Stands for a null id; behind all others.
NO_ID = 2**63 - 1
BLOCKS = "n int, dims int, row binary, id binary, label binary, x binary"


def cleaned(vectors: DataFrame, key: str, vector: str, label: str, scale: int) -> DataFrame:
    """(row, id, label, x) of the rows that take part; x holds whole numbers."""
    v = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    ok = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < LIMIT // scale, F.lit(False)))
    rows = vectors.where(F.col(label).isNotNull() & F.col(vector).isNotNull() & ok)
    return rows.select(F.monotonically_increasing_id().alias("row"), F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("id"),
                       F.col(label).cast("long").alias("label"), F.transform(v, lambda x: x.cast("int")).alias("x"))


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in columns of the rows (row, id, label, x) of a partition."""
    def block(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts).combine_chunks()
        lists = t.column("x").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        size = np.diff(lists.offsets.to_numpy())
        dims = int(size.max(initial=0))
        x = np.zeros((len(size), dims), dtype=np.int32)
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        x[np.repeat(np.arange(len(size)), size), at] = lists.flatten().to_numpy()
        cols = [t.column(c).to_numpy().astype(np.int64).tobytes() for c in ("row", "id", "label")]
        return pa.RecordBatch.from_arrays([pa.array([len(size)], pa.int32()), pa.array([dims], pa.int32()), *[pa.array([c], pa.binary()) for c in (*cols, np.ascontiguousarray(x.T).tobytes())]],
                                          names=["n", "dims", "row", "id", "label", "x"])

    held: list[pa.RecordBatch] = []
    for b in batches:
        while b.num_rows:
            room = BLOCK_ROWS - sum(h.num_rows for h in held)
            held.append(b.slice(0, room))
            b = b.slice(min(room, b.num_rows))
            if sum(h.num_rows for h in held) == BLOCK_ROWS:
                yield block(held)
                held = []
    if held:
        yield block(held)


class Block:
    """Rows in columns; ``x[d]`` holds all rows' values of dimension d."""

    def __init__(self, n: int, dims: int, row: bytes, id: bytes, label: bytes, x: bytes):  # noqa: A002
        self.row, self.id, self.label = (np.frombuffer(b, dtype=np.int64) for b in (row, id, label))
        self.x = np.frombuffer(x, dtype=np.int32).reshape(dims, n).astype(np.float64)
        self.low, self.high = self.x.min(1, initial=LIMIT), self.x.max(1, initial=-LIMIT)
        self.exact = dims == 0 or dims * float(LIMIT) * np.abs(self.x).max(initial=0) < 2**53

    def column(self, dims: np.ndarray, rows: np.ndarray | None) -> np.ndarray:
        return self.x[dims] if rows is None else self.x[np.ix_(dims, rows)]


def scan(block: Block, anchor: np.ndarray, alive: np.ndarray, shrink: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(rows left, their exact scores); ``shrink`` gets each row's lowest and highest possible score and says which stay."""
    a = np.zeros(len(block.x), dtype=np.int64)
    a[:min(len(a), len(anchor))] = anchor[:len(a)]
    order = np.argsort(-np.abs(a), kind="stable")
    order = order[a[order] != 0]
    kind = np.float64 if block.exact else np.int64
    ends = np.stack([a[order] * block.low[order], a[order] * block.high[order]])
    rest_low, rest_high = (np.concatenate([np.cumsum(e[::-1])[::-1], [0]]) for e in (ends.min(0), ends.max(0)))
    if not block.exact:  # bounds are rounded: leave room for it
        slack = 1 + 2.0**-50 * np.abs(ends).sum()
        rest_low, rest_high = rest_low - slack, rest_high + slack
    rows = np.flatnonzero(alive)
    score = np.zeros(len(rows), dtype=kind)
    for k in range(0, len(order), STEP):
        if not len(rows):
            break
        dims = order[k:k + STEP]
        part = block.column(dims, None if len(rows) == len(alive) else rows)
        score = score + a[dims].astype(kind) @ part.astype(kind, copy=False)
        if k + STEP < len(order):
            stay = shrink(score + rest_low[k + STEP], score + rest_high[k + STEP])
            rows, score = rows[stay], score[stay]
    return rows, score.astype(np.int64)


def best(found: list[tuple], n: int) -> list[tuple]:
    """The first n of (-score, id, row)."""
    return sorted(found)[:n]


def nth(values: np.ndarray, n: int) -> float:
    """The n-th largest value."""
    return np.partition(values, len(values) - n)[len(values) - n] if len(values) >= n else -np.inf


def positives(block: Block, row: int, label: int, anchor: np.ndarray, held: list[tuple], n: int) -> list[tuple]:
    """``held`` and the block's rows of the anchor's label: the first n by score."""
    least = -held[-1][0] if len(held) == n else -np.inf
    rows, score = scan(block, anchor, (block.label == label) & (block.row != row),
                       lambda low, high: high >= max(least, nth(low, n)))
    top = np.lexsort((block.row[rows], block.id[rows], -score))[:n]
    return best(held + [(-int(score[i]), int(block.id[rows[i]]), int(block.row[rows[i]])) for i in top], n)


def negatives(block: Block, label: int, anchor: np.ndarray, windows: np.ndarray, held: list[list[tuple]], n: int) -> list[list[tuple]]:
    """For each window (lowest, highest score): ``held`` and the block's rows of other labels inside it, the first n by score."""
    least = [-h[-1][0] if len(h) == n else -np.inf for h in held]

    def shrink(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        stay = np.zeros(len(low), dtype=bool)
        for (bottom, top), known in zip(windows, least, strict=True):
            reach = (high >= max(bottom, known)) & (low <= top)
            if reach.any():
                reach &= high >= nth(low[(low >= bottom) & (high <= top)], n)
            stay |= reach
        return stay

    rows, score = scan(block, anchor, block.label != label, shrink)
    out = []
    for (bottom, top), known in zip(windows, held, strict=True):
        inside = np.flatnonzero((score >= bottom) & (score <= top))
        inside = inside[np.lexsort((block.row[rows[inside]], block.id[rows[inside]], -score[inside]))[:n]]
        out.append(best(known + [(-int(score[i]), int(block.id[rows[i]]), int(block.row[rows[i]])) for i in inside], n))
    return out


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for b in batches:
        for r in b.to_pylist():
            yield Block(**r)


def anchor_rows(every: int) -> Callable:
    """The anchors (row, id, label, x) of the blocks: rows whose id is divisible by ``every``."""
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                block = Block(**r)
                at = np.flatnonzero((block.id % every == 0) & (block.id != NO_ID))
                x = [block.x[:, i].astype(np.int32).tobytes() for i in at]
                yield pa.RecordBatch.from_arrays([pa.array(block.row[at]), pa.array(block.id[at]), pa.array(block.label[at]), pa.array(x, pa.binary())], names=["row", "id", "label", "x"])
    return run


def find_positives(anchors: list, n: int) -> Callable:
    def run(batches):
        held: dict[int, list[tuple]] = {}
        for block in blocks_of(batches):
            for a in anchors.value:
                held[a["row"]] = positives(block, a["row"], a["label"], np.frombuffer(a["x"], dtype=np.int32), held.get(a["row"], []), n)
        out = [(a, -s, i, r) for a, found in held.items() for s, i, r in found]
        yield pa.RecordBatch.from_pydict({c: [x[k] for x in out] for k, c in enumerate(("anchor", "score", "id", "row"))},
                                         schema=pa.schema([(c, pa.int64()) for c in ("anchor", "score", "id", "row")]))
    return run


def window(score: int, percent: tuple[int, int]) -> tuple[int, int]:
    """The scores s with low * score <= 100 * s <= high * score."""
    return -(-percent[0] * score // 100), percent[1] * score // 100


def find_negatives(anchors: list, n: int, percent: tuple[int, int]) -> Callable:
    def run(batches):
        held: dict[int, list[list[tuple]]] = {}
        windows = {a["row"]: np.array([w for s in sorted(set(a["scores"])) if (w := window(s, percent))[0] <= w[1]], dtype=np.int64).reshape(-1, 2) for a in anchors.value}
        for block in blocks_of(batches):
            for a in anchors.value:
                w = windows[a["row"]]
                if len(w):
                    held[a["row"]] = negatives(block, a["label"], np.frombuffer(a["x"], dtype=np.int32), w, held.get(a["row"], [[]] * len(w)), n)
        out = []
        for a in anchors.value:
            scores = [s for s in sorted(set(a["scores"])) if (w := window(s, percent))[0] <= w[1]]
            for s, found in zip(scores, held.get(a["row"], [])):
                out += [(a["row"], s, -score, i, r) for score, i, r in found]
        names = ("anchor", "positive_score", "score", "id", "row")
        yield pa.RecordBatch.from_pydict({c: [x[k] for x in out] for k, c in enumerate(names)}, schema=pa.schema([(c, pa.int64()) for c in names]))
    return run


def in_slices(blocks: DataFrame, anchors: DataFrame, width: int, run: Callable, schema: str) -> DataFrame:
    """``run(anchors)`` over all blocks, for one slice of the anchors after another; ``width``: bytes of an anchor."""
    spark = blocks.sparkSession
    slices = max(1, -(-anchors.count() * width // SLICE_BYTES))
    out = spark.createDataFrame([], schema)
    for k in range(slices):
        mine = [r.asDict() for r in anchors.where(F.pmod(F.xxhash64("row"), F.lit(slices)) == k).orderBy("row").collect()]
        out = out.unionByName(blocks.mapInArrow(run(spark.sparkContext.broadcast(mine)), schema))
    return out


def first(found: DataFrame, by: list[str], n: int) -> DataFrame:
    """The first n rows of each group by score, then id, with their ``rank``; a group has at most n rows from each task."""
    order = ", ".join(by)
    return found.selectExpr("*", f"row_number() OVER (PARTITION BY {order} ORDER BY score DESC, id, row) AS rank").where(F.col("rank") <= n)


def mine(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", every: int = 50, scale: int = 256,
         n_positives: int = POSITIVES, n_negatives: int = NEGATIVES, percent: tuple[int, int] = WINDOW) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: the hard negatives of each anchor and positive."""
    rows = cleaned(vectors, key, vector, label, scale)
    count, dims = vectors.agg(F.count("*"), F.max(F.size(vector))).first()
    parts = max(1, -(-count // BLOCK_ROWS))
    blocks = stage(rows.repartition(parts).mapInArrow(packed, BLOCKS), "vectors")
    anchors = stage(blocks.mapInArrow(anchor_rows(every), "row long, id long, label long, x binary"), "anchors")
    width = 4 * max(dims or 0, 0) + 8 * (4 + n_positives)
    near = stage(first(in_slices(blocks, anchors, width, lambda a: find_positives(a, n_positives), "anchor long, score long, id long, row long"),
                       ["anchor"], n_positives), "positives")
    scores = near.groupBy(F.col("anchor").alias("row")).agg(F.collect_list("score").alias("scores"))  # n_positives at most
    asked = stage(anchors.join(scores, "row"), "windows")
    hard = first(in_slices(blocks, asked, width, lambda a: find_negatives(a, n_negatives, percent),
                           "anchor long, positive_score long, score long, id long, row long"), ["anchor", "positive_score"], n_negatives)
    pairs = near.select("anchor", F.col("id").alias("positive"), F.col("score").alias("positive_score"))
    named = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    true = lambda c: F.nullif(F.col(c), F.lit(NO_ID))
    return pairs.join(hard, ["anchor", "positive_score"]).join(named, "anchor").select(
        "anchor_id", true("positive").alias("positive_id"), F.col("rank").cast("int").alias("rank"), true("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))


def op11_hard_negatives(spark, sf_dir):
    """Hard negatives of every fiftieth vector, some labels moved by one so that they do not follow the vectors."""
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors.withColumn("label", moved))


OP11_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id, a.label = b.label AS same, list_dot_product(a.x, b.x)::BIGINT AS score
  FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 50 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id NULLS LAST) <= 5),
n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         (row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.vec_id NULLS LAST))::INTEGER AS rank
  FROM p JOIN s ON s.a = p.a AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT * FROM n WHERE rank <= 3
"""
