"""Sharding by jump consistent hashing.

A stable key and the number of shards alone decide a row's shard; there is no
ring table. Going from n to n + 1 shards moves a row only into the new shard
(about 1 / (n + 1) of all rows).

Defined results: an integer key is used as it is, any other key by its
``xxhash64``; a null key counts as 0. Rows that are equal in key and text are
all kept and get slots of their own. An empty table gives an empty result.
Columns of the input besides key and text are not read by ``assign``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from workpulse.llm.common import table

SHARDS = 8
#: Rows that one window task numbers, about.
ROWS_PER_BLOCK = 100_000


def jump_hash(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of every 64-bit key; all keys take their next jump together until none lands inside."""
    state = keys.astype(np.int64).view(np.uint64).copy()
    bucket = np.full(len(state), -1, dtype=np.int64)
    jump = np.zeros(len(state), dtype=np.int64)
    live = np.arange(len(state))
    with np.errstate(over="ignore"):
        while len(live):
            bucket[live] = jump[live]
            state[live] = state[live] * np.uint64(2862933555777941757) + np.uint64(1)
            step = float(1 << 31) / ((state[live] >> np.uint64(33)).astype(np.float64) + 1.0)
            jump[live] = ((bucket[live] + 1).astype(np.float64) * step).astype(np.int64)
            live = live[jump[live] < buckets]
    return bucket.astype(np.int32)


def jump_shard(buckets: int):
    """A column function: 64-bit key -> shard."""
    @F.pandas_udf(T.IntegerType())
    def shard(key: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(key.to_numpy(dtype=np.int64), buckets))
    return shard


def stable_key(df: DataFrame, key: str):
    integral = isinstance(df.schema[key].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    c = F.col(key).cast("long") if integral else F.when(F.col(key).isNotNull(), F.xxhash64(key))
    return F.coalesce(c, F.lit(0).cast("long"))


def assign(df: DataFrame, key: str, text: str, shards: int = SHARDS) -> DataFrame:
    """Every row's shard now and after one more shard is added, and its slot in its shard.

    Slots are numbered in two steps so that no task sees a whole shard: rows
    are numbered inside blocks (a hash of the row), and a running sum over the
    blocks' counts gives each block its first slot.
    """
    rows = df.select(
        F.col(key).alias("doc_id"), stable_key(df, key).alias("_key"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"))
    blocks = max(1, df.count() // (ROWS_PER_BLOCK * shards) + 1) * 4
    rows = rows.select("*", jump_shard(shards)("_key").alias("shard"), jump_shard(shards + 1)("_key").alias("grown_shard"),
                       F.pmod(F.xxhash64("_key", "size", "text_crc32"), F.lit(blocks)).cast("int").alias("_block"))
    first = (rows.groupBy("shard", "_block").agg(F.count("*").alias("_n"))
             .selectExpr("shard", "_block", "sum(_n) OVER (PARTITION BY shard ORDER BY _block) - _n AS _first"))
    numbered = rows.selectExpr(
        "*", "row_number() OVER (PARTITION BY shard, _block ORDER BY _key, size, text_crc32) - 1 AS _row")
    return numbered.join(first, ["shard", "_block"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("_first") + F.col("_row")).cast("long").alias("slot"), "grown_shard")


def write_shards(df: DataFrame, key: str, path: str, shards: int = SHARDS, files_per_shard: int = 16) -> None:
    """Write all columns of ``df`` under ``path/shard=<k>/``; several tasks write each shard."""
    placed = df.withColumn("shard", jump_shard(shards)(stable_key(df, key)))
    salt = F.pmod(F.xxhash64(*[c for c in df.columns]), F.lit(files_per_shard))
    (placed.repartition(shards * files_per_shard, "shard", salt).write.partitionBy("shard").mode("overwrite").parquet(path))


def op2_jump_sharding(spark, sf_dir):
    """All documents into shards 0 to 7 by doc_id."""
    return assign(table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text")
