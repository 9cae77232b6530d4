"""Explicit schemas for every landed input and for the snapshot fact table (never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D, B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()


def _f(name, typ, nullable=True):
    return T.StructField(name, typ, nullable)


# Current iterations of each team, in the order the tracker returned them.
ITERATIONS = T.StructType([
    _f("org", S, False), _f("project", S, False), _f("pos", I, False), _f("name", S), _f("path", S),
    _f("startDate", S), _f("finishDate", S),
])

# Parent items (stories) with the fields the parent scan filters on.
STORIES = T.StructType([
    _f("org", S, False), _f("project", S, False), _f("id", L, False), _f("work_item_type", S), _f("state", S),
    _f("iteration_path", S),
])

# One-hop hierarchy links; rel NULL marks the echoed source row.
LINKS = T.StructType([_f("org", S, False), _f("source_id", L, False), _f("target_id", L), _f("rel", S)])

# Work item details, one row per item (dotted payload keys already projected).
WORK_ITEMS = T.StructType([
    _f("org", S, False), _f("project", S, False), _f("id", L, False), _f("title", S), _f("work_item_type", S),
    _f("state", S), _f("iteration_path", S), _f("assigned_to", S), _f("remaining_hours", D),
    _f("original_estimate", D), _f("state_change_date", S), _f("changed_date", S),
])

# Comments, one row per landed version; pos = position in the landed payload array, landed_at = when that
# payload landed. A comment is (org, work item, id); its newest version counts.
COMMENTS = T.StructType([
    _f("org", S, False), _f("work_item_id", L, False), _f("pos", L, False), _f("id", L), _f("text", S),
    _f("createdBy", T.StructType([_f("displayName", S), _f("uniqueName", S)])), _f("createdDate", S),
    _f("landed_at", T.TimestampType()),
])

# Grader / nudge replies keyed by task and run.
RESPONSES = T.StructType([
    _f("org", S, False), _f("work_item_id", L, False), _f("as_of", T.TimestampType()), _f("kind", S), _f("raw", S),
])

GRADE_FIELDS = T.StructType([
    _f("quality_score", I), _f("quality_label", S), _f("blocker_detected", B), _f("progress_detectable", B),
    _f("sentiment", S), _f("suggested_followup", S),
])

NUDGE_FIELDS = T.StructType([_f("message", S), _f("tone", S)])

# The 40-column daily snapshot, in DDL order (nullable=False marks NOT NULL).
SNAPSHOT = T.StructType([
    _f("snapshot_date", T.DateType(), False), _f("snapshot_timestamp", T.TimestampType(), False),
    _f("azure_org", S, False), _f("azure_project", S, False),
    _f("sprint_name", S, False), _f("iteration_path", S, False), _f("sprint_start_date", T.DateType()),
    _f("sprint_finish_date", T.DateType()), _f("sprint_days_remaining", I, False),
    _f("work_item_id", I, False), _f("task_title", S, False), _f("work_item_type", S, False),
    _f("task_state", S, False), _f("assignee_name", S), _f("assignee_email", S), _f("remaining_hours", D),
    _f("original_estimate", D), _f("days_since_state_change", I, False), _f("days_since_last_update", I, False),
    _f("has_comment_today", B, False), _f("today_comment_text", S), _f("today_comment_author_name", S),
    _f("today_comment_author_email", S), _f("today_comment_timestamp", T.TimestampType()),
    _f("today_comment_image_urls", S),
    _f("recent_comment_count", I, False), _f("recent_comment_authors", S),
    _f("comment_quality_score", I, False), _f("comment_quality_label", S, False),
    _f("copy_paste_detected", B, False), _f("blocker_detected", B, False), _f("hours_stale", B, False),
    _f("sentiment", S), _f("ai_suggested_followup", S),
    _f("risk_score", I, False), _f("risk_label", S, False), _f("needs_attention", B, False),
    _f("eod_compliant", B, False),
    _f("nudge_tone", S), _f("nudge_message", S),
])

SNAPSHOT_KEY = ("azure_org", "azure_project", "snapshot_date", "work_item_id")
SNAPSHOT_NOT_NULL = tuple(f.name for f in SNAPSHOT.fields if not f.nullable)
