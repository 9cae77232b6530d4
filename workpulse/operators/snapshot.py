"""40-column snapshot flatten (K8, D7, D8, X16, X17) and NOT NULL enforcement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workpulse.functions.dates import as_of_ts, parse_iso
from workpulse.functions.text import nullif_empty, pipe_join
from workpulse.schemas import SNAPSHOT, SNAPSHOT_NOT_NULL


def to_snapshot_rows(tasks: DataFrame, as_of: str) -> DataFrame:
    """Enriched tasks -> snapshot rows in DDL order and types."""
    iso_date = lambda c: F.to_date(parse_iso(c))
    cols = {
        "snapshot_date": F.to_date(as_of_ts(as_of)),
        "snapshot_timestamp": as_of_ts(as_of),
        "azure_org": F.col("org"),
        "azure_project": F.col("project"),
        "sprint_name": F.col("sprint_name"),
        "iteration_path": F.col("iteration_path"),
        "sprint_start_date": iso_date(F.col("start_date")),
        "sprint_finish_date": iso_date(F.col("finish_date")),
        "sprint_days_remaining": F.col("days_remaining"),
        "work_item_id": F.col("id"),
        "task_title": F.col("title"),
        "work_item_type": F.col("work_item_type"),
        "task_state": F.col("state"),
        "assignee_name": F.col("assignee_name"),
        "assignee_email": nullif_empty(F.col("assignee_email")),
        "remaining_hours": F.col("remaining_hours"),
        "original_estimate": F.col("original_estimate"),
        "days_since_state_change": F.col("days_since_state_change"),
        "days_since_last_update": F.col("days_since_last_update"),
        "has_comment_today": F.col("has_comment_today"),
        "today_comment_text": nullif_empty(F.col("today_comment_text")),
        "today_comment_author_name": F.col("today_comment_author_name"),
        "today_comment_author_email": F.col("today_comment_author_email"),
        "today_comment_timestamp": F.col("today_comment_ts"),
        "today_comment_image_urls": pipe_join(F.col("today_image_urls")),
        "recent_comment_count": F.col("recent_comment_count"),
        "recent_comment_authors": F.col("recent_comment_authors"),
        "comment_quality_score": F.col("quality_score"),
        "comment_quality_label": F.col("quality_label"),
        "copy_paste_detected": F.col("copy_paste_detected"),
        "blocker_detected": F.col("blocker_detected"),
        "hours_stale": F.col("hours_stale"),
        "sentiment": nullif_empty(F.col("sentiment")),
        "ai_suggested_followup": nullif_empty(F.col("suggested_followup")),
        "risk_score": F.col("risk_score"),
        "risk_label": F.col("risk_label"),
        "needs_attention": F.col("needs_attention"),
        "eod_compliant": F.col("eod_compliant"),
        "nudge_tone": nullif_empty(F.col("nudge.tone")),
        "nudge_message": nullif_empty(F.col("nudge.message")),
    }
    return tasks.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in SNAPSHOT.fields])


def null_violations(rows: DataFrame) -> DataFrame:
    """One-row count of rows breaking any NOT NULL column."""
    bad = F.lit(False)
    for c in SNAPSHOT_NOT_NULL:
        bad = bad | F.col(c).isNull()
    return rows.agg(F.count_if(bad).alias("violations"))


def enforce_not_null(rows: DataFrame) -> DataFrame:
    """Fails the write job itself (no extra pass) when a NOT NULL column is NULL."""
    bad = F.lit(False)
    for c in SNAPSHOT_NOT_NULL:
        bad = bad | F.col(c).isNull()
    return rows.where(F.when(bad, F.raise_error(F.lit("snapshot row violates a NOT NULL column")))
                      .otherwise(F.lit(True)))
