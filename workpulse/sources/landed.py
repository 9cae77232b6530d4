"""Landed tracker payloads -> typed inputs.

Inputs are read as lines and parsed with explicit schemas (never inferred); a
record that does not parse is kept aside in a quarantine DataFrame, with the
file it came from, instead of failing the job, and its item simply gets no rows
(a failing item gives an empty result). Nothing is copied: rows and quarantine
are two readings of the same lines, and each parses a line once.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from workpulse import schemas as SC
from workpulse.sources.standins import TrackerInputs

CORRUPT = "_corrupt_record"

# Raw comment payload: one record per work item, comments in API order.
COMMENT_PAYLOAD = T.StructType([
    T.StructField("org", T.StringType(), False),
    T.StructField("work_item_id", T.LongType(), False),
    T.StructField("comments", T.ArrayType(T.StructType([
        T.StructField("id", T.LongType()), T.StructField("text", T.StringType()),
        T.StructField("createdBy", T.StructType([T.StructField("displayName", T.StringType()),
                                                 T.StructField("uniqueName", T.StringType())])),
        T.StructField("createdDate", T.StringType())]))),
])

# Raw work item payload: id plus the tracker's field map (dotted keys, values as JSON text).
WORK_ITEM_PAYLOAD = T.StructType([
    T.StructField("org", T.StringType(), False), T.StructField("project", T.StringType(), False),
    T.StructField("id", T.LongType(), False),
    T.StructField("fields", T.MapType(T.StringType(), T.StringType())),
])

# Payload field keys.
FIELD_KEYS = {
    "title": "System.Title",
    "work_item_type": "System.WorkItemType",
    "state": "System.State",
    "iteration_path": "System.IterationPath",
    "assigned_to": "System.AssignedTo",
    "remaining_hours": "Microsoft.VSTS.Scheduling.RemainingWork",
    "original_estimate": "Microsoft.VSTS.Scheduling.OriginalEstimate",
    "state_change_date": "Microsoft.VSTS.Common.StateChangeDate",
    "changed_date": "System.ChangedDate",
}


@dataclass
class Landed:
    """``rows``: the records that parse. ``quarantine``: the text of the others, their file, the start of the split
    of that file in which they lie, and when the file landed."""

    rows: DataFrame
    quarantine: DataFrame


def read_json(spark: SparkSession, path: str, schema: T.StructType, landed: bool = False) -> Landed:
    """JSON lines by ``schema``, with a quarantine of the records that do not parse or have no field of it.

    Blank lines are skipped. ``landed`` adds ``landed_at``, the time of the file, to the rows.
    """
    full = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    meta = [F.col(f"_metadata.{name}").alias(out) for name, out in
            (("file_path", "file"), ("file_block_start", "split_start"), ("file_modification_time", "landed_at"))]
    lines = spark.read.text(path).select("value", F.struct(*meta).alias("_from")).where(F.trim("value") != "")
    # The generator keeps the parsed columns apart from the filters, which would else be moved below the
    # projection and parse the line again.
    parsed = lines.select(F.col("value").alias("_line"), "_from", F.inline(F.array(F.from_json("value", full, options))))
    nothing = reduce(and_, [F.col(f.name).isNull() for f in schema.fields])
    bad = F.col(CORRUPT).isNotNull() | nothing
    at = [F.col("_from.landed_at").alias("landed_at")] if landed else []
    return Landed(rows=parsed.where(~bad).select(*schema.names, *at),
                  quarantine=parsed.where(bad).select(F.col("_line").alias(CORRUPT), "_from.*"))


def explode_comments(payloads: DataFrame) -> DataFrame:
    """Comment arrays -> one row per comment with its payload position and landing time.

    ``payloads`` may carry ``landed_at``; without it all versions count as landed at once.
    """
    at = F.col("landed_at") if "landed_at" in payloads.columns else F.lit(None).cast("timestamp").alias("landed_at")
    return payloads.select("org", "work_item_id", at, F.posexplode("comments").alias("pos", "c")).select(
        "org", "work_item_id", "landed_at", F.col("pos").cast("long").alias("pos"), F.col("c.id").alias("id"),
        F.col("c.text").alias("text"), F.col("c.createdBy").alias("createdBy"),
        F.col("c.createdDate").alias("createdDate"))


def project_fields(payloads: DataFrame) -> DataFrame:
    """Field map -> work item columns; numeric fields cast with ``try_cast`` (K1)."""
    f = F.col("fields")
    cols = {name: f[key] for name, key in FIELD_KEYS.items()}
    for num in ("remaining_hours", "original_estimate"):
        cols[num] = F.expr(f"try_cast(fields['{FIELD_KEYS[num]}'] AS DOUBLE)")
    return payloads.select("org", "project", "id", *[cols[c.name].alias(c.name) for c in SC.WORK_ITEMS.fields
                                                     if c.name not in ("org", "project", "id")])


def load_tracker(spark: SparkSession, base: str, history: DataFrame | None = None) -> tuple[TrackerInputs, dict]:
    """Read ``base/{iterations,stories,links,work_items,comments}`` JSON-lines landings.

    Returns the inputs and the quarantined records per source.
    """
    it = read_json(spark, f"{base}/iterations", SC.ITERATIONS)
    st = read_json(spark, f"{base}/stories", SC.STORIES)
    ln = read_json(spark, f"{base}/links", SC.LINKS)
    wi = read_json(spark, f"{base}/work_items", WORK_ITEM_PAYLOAD)
    cm = read_json(spark, f"{base}/comments", COMMENT_PAYLOAD, landed=True)
    inputs = TrackerInputs(iterations=it.rows, stories=st.rows, links=ln.rows, work_items=project_fields(wi.rows),
                           comments=explode_comments(cm.rows), history=history)
    return inputs, {"iterations": it.quarantine, "stories": st.quarantine, "links": ln.quarantine,
                    "work_items": wi.quarantine, "comments": cm.quarantine}
