"""Comment arrival as Structured Streaming (the daily schedule, re-expressed).

New comment payload files are read as a stream, exploded with their payload
position and landing time (the file's modification time, the same on replay),
and appended to the landed comments folder by ``foreachBatch``. Nothing is
dropped here, however late, early or repeated: readers take the newest version
of each comment (``operators.comments.current_comments``). Each micro-batch
writes to its own ``epoch=<id>`` folder with overwrite, so a batch replayed
after a failure rewrites the same files (idempotent sink). The optional
``on_batch`` hook runs the daily snapshot upsert. An external scheduler starts
the query with ``availableNow`` once per run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from workpulse.sources.landed import COMMENT_PAYLOAD, explode_comments


def comment_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(COMMENT_PAYLOAD)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return explode_comments(reader.json(source_dir).withColumn("landed_at", F.col("_metadata.file_modification_time")))


def start_landing(spark: SparkSession, source_dir: str, landed_dir: str, checkpoint_location: str,
                  on_batch: Callable[[int], None] | None = None,
                  available_now: bool = True) -> StreamingQuery:
    """Start the landing stream; ``checkpoint_location`` must be on shared storage."""

    def write(batch: DataFrame, epoch_id: int) -> None:
        # Empty batches land nothing and trigger nothing.
        if batch.isEmpty():
            return
        (batch.write.mode("overwrite")
         .parquet(f"{landed_dir.rstrip('/')}/epoch={epoch_id}"))
        if on_batch is not None:
            on_batch(epoch_id)

    w = (comment_stream(spark, source_dir).writeStream.foreachBatch(write)
         .option("checkpointLocation", checkpoint_location))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 day")
    return w.start()


def read_landed_comments(spark: SparkSession, landed_dir: str) -> DataFrame:
    """All landed versions (every epoch) in the comments input shape."""
    from workpulse.schemas import COMMENTS
    return spark.read.schema(COMMENTS).parquet(landed_dir).select(*[f.name for f in COMMENTS.fields])
