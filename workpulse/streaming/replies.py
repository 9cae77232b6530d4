"""Requests and replies of the external grader as streams.

A request waits for its reply for a stated time. Both sides are streams with
watermarks, joined outer: a reply in time goes out with its request, a request
whose time is over goes out without one, and the parsers then give it the
fallback record. A reply after its time, without a request, or to another run
meets nothing. State holds only requests and replies that can still meet.

Every micro-batch writes its own ``epoch=<n>`` folder with overwrite, so a
replayed batch rewrites the same files. A watermark only moves on with later
rows, so a run's last rows are followed by a closing mark (``closing_marks``)
on both streams, a row of no item.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REQUESTS = "org string, work_item_id long, as_of timestamp, kind string, asked_at timestamp"
REPLIES = "org string, work_item_id long, as_of timestamp, kind string, raw string, replied_at timestamp"
#: What ``operators.grading.grade`` and ``operators.nudge.write_nudges`` read.
RESPONSES = "org string, work_item_id long, as_of timestamp, kind string, raw string"
CLOSING = "closing"
KEY = ("org", "work_item_id", "as_of", "kind")


def matched(requests: DataFrame, replies: DataFrame, wait: str, late: str = "0 seconds") -> DataFrame:
    """Each request with each of its replies that came within ``wait``; without any, once with a null ``raw``.
    Closing marks meet each other and come out too.

    ``late``: how far behind its time a row of either stream may arrive.
    """
    q = requests.withWatermark("asked_at", late).alias("q")
    r = replies.withWatermark("replied_at", late).alias("r")
    same = F.expr(" AND ".join(f"q.{c} = r.{c}" for c in KEY) + f" AND r.replied_at >= q.asked_at AND r.replied_at <= q.asked_at + INTERVAL {wait}")
    return q.join(r, same, "left_outer").select(*[F.col(f"q.{c}") for c in KEY], F.col("r.raw"))


def closing_marks(spark: SparkSession, at: str) -> tuple[DataFrame, DataFrame]:
    """A last row for each stream that moves the watermarks to ``at``."""
    when = F.lit(at).cast("timestamp")
    base = spark.range(1).select(F.lit("").alias("org"), F.lit(-1).cast("long").alias("work_item_id"), when.alias("as_of"), F.lit(CLOSING).alias("kind"))
    return base.withColumn("asked_at", when), base.withColumn("raw", F.lit(None).cast("string")).withColumn("replied_at", when)


def match_landed(spark: SparkSession, requests_dir: str, replies_dir: str, out_dir: str, checkpoint_location: str, wait: str) -> DataFrame:
    """Run the join over all files landed so far, one trigger, and read the responses back.

    ``checkpoint_location`` must be on shared storage; a run that is started
    again goes on where the last one stopped.
    """
    def source(schema: str, path: str) -> DataFrame:
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1_000_000).parquet(path)

    def write(batch: DataFrame, epoch_id: int) -> None:
        # Closing marks go here, not in the stream: a filter there would move below the watermark and hide them from it.
        batch.where(F.col("kind") != CLOSING).write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/epoch={epoch_id}")

    query = (matched(source(REQUESTS, requests_dir), source(REPLIES, replies_dir), wait).writeStream.foreachBatch(write)
             .option("checkpointLocation", checkpoint_location).trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(RESPONSES).option("recursiveFileLookup", "true").parquet(out_dir)
