"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from workpulse.session import checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Space, tab, line feed, vertical tab, form feed, carriage return.
ASCII_SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """The named columns of a table; other columns are never read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder of ``spark.checkpoint.dir`` (local runs without it get their own)."""
    return f"{checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_ids(df: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """Broadcast a side of a few numbers per row if it is counted and has at most ``rows`` rows (some 50 MB).

    A larger side is left to the planner, which shuffles both.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, every other character as it is (``lower`` alone would change É or İ)."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


def connected_components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component is its smallest reachable node.

    Alternating large-star and small-star steps. Each step is a min per node
    (combined on the map side) joined back to the edges, so a node with very
    many edges is split by the skew join; no component is ever gathered.
    Each round is written to the shared folder.
    """
    e = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
              .where("a != b").distinct(), name)
    mark = None
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        e = (both.join(low, "a").where("b > a").select(F.col("b"), F.least("a", "m").alias("m"))
             .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct())
        low = e.groupBy("a").agg(F.min("b").alias("m"))
        star = e.join(low, "a")
        e = stage(star.select(F.col("a"), F.col("m").alias("b"))
                  .unionByName(star.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct(), name)
        row = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if (row[0], row[1]) == mark:
            break
        mark = (row[0], row[1])
    return (e.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))
