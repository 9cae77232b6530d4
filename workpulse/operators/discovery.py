"""Sprint discovery: current iteration, parents in it, their children, in-scope items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workpulse.functions.dates import days_remaining, elapsed_days, parse_iso, total_days
from workpulse.functions.text import parse_assignee
from workpulse.params import CLOSED_PARENT_STATES, HIERARCHY_FORWARD, Params
from workpulse.session import join_small

PROJECT_KEY = ["org", "project"]


def current_sprint(iterations: DataFrame, as_of: str) -> DataFrame:
    """First listed current iteration per project, with calendar figures.

    ``min_by`` over the list position aggregates map-side; no sort, no window.
    """
    first = (iterations.groupBy(*PROJECT_KEY)
             .agg(F.min_by(F.struct("name", "path", "startDate", "finishDate"), F.col("pos")).alias("it")))
    start_s = F.coalesce(F.col("it.startDate"), F.lit(""))
    finish_s = F.coalesce(F.col("it.finishDate"), F.lit(""))
    start_ts, finish_ts = parse_iso(start_s), parse_iso(finish_s)
    return first.select(
        *PROJECT_KEY,
        F.coalesce(F.col("it.name"), F.lit("")).alias("sprint_name"),
        F.coalesce(F.col("it.path"), F.lit("")).alias("iteration_path"),
        start_s.alias("start_date"),
        finish_s.alias("finish_date"),
        F.when(finish_s != "", days_remaining(finish_ts, as_of)).otherwise(F.lit(0)).alias("days_remaining"),
        F.when((start_s != "") & (finish_s != ""), total_days(start_ts, finish_ts)).otherwise(F.lit(0))
        .alias("total_days"),
        (finish_s != "").alias("dates_configured"),
    )


def sprint_parents(stories: DataFrame, sprint: DataFrame, p: Params, sprint_small: bool | None = None) -> DataFrame:
    """Parents whose iteration path equals the sprint path, of a parent type, not closed."""
    s = stories.where(F.col("work_item_type").isin(list(p.parent_types))
                      & ~F.col("state").isin(list(CLOSED_PARENT_STATES)))
    keys = sprint.select(*PROJECT_KEY, "iteration_path")
    return join_small(s, keys, PROJECT_KEY + ["iteration_path"], "left_semi", p.broadcast_row_limit, sprint_small)


def child_ids(parents: DataFrame, links: DataFrame) -> DataFrame:
    """Distinct hierarchy-forward children of the parents."""
    fwd = links.where((F.col("rel") == F.lit(HIERARCHY_FORWARD)) & F.col("target_id").isNotNull())
    return (parents.select(*PROJECT_KEY, F.col("id").alias("source_id"))
            .join(fwd.select("org", "source_id", "target_id"), ["org", "source_id"])
            .select(*PROJECT_KEY, F.col("target_id").alias("id"))
            .distinct())


def project_items(items: DataFrame, as_of: str) -> DataFrame:
    """K1 field projection with defaults, assignee normalisation (X5) and elapsed days."""
    a = parse_assignee(F.col("assigned_to"))
    return items.select(
        *PROJECT_KEY, "id",
        F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce("work_item_type", F.lit("")).alias("work_item_type"),
        F.coalesce("state", F.lit("")).alias("state"),
        F.coalesce("iteration_path", F.lit("")).alias("item_iteration_path"),
        a["display_name"].alias("assignee_name"),
        a["email"].alias("assignee_email"),
        "remaining_hours", "original_estimate",
        elapsed_days(parse_iso(F.col("state_change_date")), as_of).alias("days_since_state_change"),
        elapsed_days(parse_iso(F.col("changed_date")), as_of).alias("days_since_last_update"),
    )


def scoped_items(work_items: DataFrame, children: DataFrame, p: Params) -> DataFrame:
    """Details of children of an allowed type, as landed, so that the runs of several days can share them.

    The type filter runs before any comment is touched (F8). Each child keeps
    the project of the sprint that reached it.
    """
    w = work_items.where(F.col("work_item_type").isin(list(p.allowed_types))).drop("project")
    return w.join(children, ["org", "id"], "inner")


def in_scope_items(work_items: DataFrame, children: DataFrame, as_of: str, p: Params) -> DataFrame:
    """``scoped_items`` projected with defaults and the day's figures."""
    return project_items(scoped_items(work_items, children, p), as_of)


def stage_counts(parents: DataFrame, children: DataFrame, items: DataFrame) -> DataFrame:
    """Per-project counts of parents, children and fetched tasks."""
    pc = parents.groupBy(*PROJECT_KEY).agg(F.count(F.lit(1)).alias("parent_count"))
    cc = children.groupBy(*PROJECT_KEY).agg(F.count(F.lit(1)).alias("child_count"))
    tc = items.groupBy(*PROJECT_KEY).agg(F.count(F.lit(1)).alias("task_count"))
    out = pc.join(cc, PROJECT_KEY, "full").join(tc, PROJECT_KEY, "full")
    return out.select(*PROJECT_KEY, *[F.coalesce(c, F.lit(0)).cast("long").alias(c)
                                      for c in ("parent_count", "child_count", "task_count")])
