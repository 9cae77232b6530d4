"""Positions within groups of any size (O2-O4): ranges of the whole order instead of one window per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from workpulse.session import stage_table


def with_positions(df: DataFrame, by: list[str], order: list[Column], out: str = "position", ranges: int | None = None) -> DataFrame:
    """``df`` with each row's position (from 1) in its group ``by`` under ``order``, which must leave no ties.

    Rows are dealt into ranges of (by, order), by sampled bounds, so that a
    group with a third of all rows spreads over a third of the ranges. A range
    counts its rows of each group; the running sum of these counts (one row a
    range and group) is the offset of the range, and rows are numbered within
    their range only. The dealt rows are a stage table, so numbers and offsets
    come from the same ranges.
    """
    spark = df.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = stage_table(df.repartitionByRange(n, *[F.col(c) for c in by], *order).withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy(*by, "_range").agg(F.count(F.lit(1)).alias("_n")).select(*by, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    local = F.row_number().over(Window.partitionBy("_range", *by).orderBy(*order))
    return (dealt.withColumn("_local", local).join(offsets, [*by, "_range"])
            .withColumn(out, (F.col("_before") + F.col("_local")).cast("long")).drop("_range", "_local", "_before"))


def write_ordered(df: DataFrame, path: str, order: list[str], ranges: int | None = None) -> None:
    """Files in the given order: each holds one range, sorted; file names ascend with the ranges."""
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(n, *order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def read_ordered(spark, path: str) -> DataFrame:
    """The rows of ``write_ordered`` with the file and the place in it: ``_file`` and ``_row`` give the order back."""
    rows = spark.read.parquet(path)
    return rows.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
