"""Run summary per (org, project) (A11, A14, K9) and the ordered task list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workpulse.operators.ranking import with_positions
from workpulse.params import ESCALATED_LABELS


def run_summary(tasks: DataFrame) -> DataFrame:
    """Eight counters plus analysed count; missing/blocker/risk counters cover analysed tasks only."""
    analysed = F.col("branch") == "analysed"
    c = lambda cond: F.count_if(cond).cast("long")
    s = tasks.groupBy("org", "project").agg(
        F.count(F.lit(1)).cast("long").alias("total_tasks"),
        c(F.col("needs_attention")).alias("flagged_tasks"),
        c(analysed & ~F.col("has_comment_today")).alias("tasks_missing_comment"),
        c(analysed & F.col("blocker_detected")).alias("tasks_with_blockers"),
        c(analysed & F.col("risk_label").isin(*ESCALATED_LABELS)).alias("tasks_at_risk_or_critical"),
        c(F.col("branch") == "skipped_state").alias("tasks_skipped_state"),
        c(F.col("branch") == "skipped_history").alias("tasks_skipped_good_history"),
    )
    return s.select(
        "org", "project", "total_tasks", "flagged_tasks",
        (F.col("total_tasks") - F.col("flagged_tasks")).alias("healthy_tasks"),
        "tasks_missing_comment", "tasks_with_blockers", "tasks_at_risk_or_critical", "tasks_skipped_state",
        "tasks_skipped_good_history",
        (F.col("total_tasks") - F.col("tasks_skipped_state") - F.col("tasks_skipped_good_history"))
        .alias("tasks_analysed"),
    )


def ordered_tasks(tasks: DataFrame) -> DataFrame:
    """Each project's tasks, most critical first, ties in ascending id order (O4), with their ``position`` from 1."""
    return with_positions(tasks, ["org", "project"], [F.desc("risk_score"), F.asc("id")]).orderBy("org", "project", "position")
