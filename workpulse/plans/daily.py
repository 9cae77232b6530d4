"""The daily run as one Spark plan (Entry 1): discovery -> comments -> branch -> similarity + grading
-> risk -> attention -> nudges -> snapshot rows; summary, cards and outboxes fan out from one table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workpulse.operators.comments import attach_comments, comment_rollup, current_comments, recent_comments, similarity_docs
from workpulse.operators.discovery import (
    child_ids,
    current_sprint,
    project_items,
    scoped_items,
    sprint_parents,
    stage_counts,
)
from workpulse.operators.gate import BRANCH_ANALYSED, assign_branch
from workpulse.operators.grading import grade, grading_requests
from workpulse.operators.nudge import write_nudges
from workpulse.operators.risk import flag_attention, score_risk
from workpulse.operators.routing import (
    disposition_counts,
    dispositions,
    report_cards,
    report_outbox,
    reminder_outbox,
)
from workpulse.operators.similarity import copy_paste
from workpulse.operators.snapshot import to_snapshot_rows
from workpulse.operators.summary import run_summary
from workpulse.params import DEFAULT_SENTIMENT, SKIPPED_LABEL, Params
from workpulse.session import cut_lineage, fits_broadcast, join_small
from workpulse.sources.standins import TrackerInputs

SPRINT_COLUMNS = ["sprint_name", "iteration_path", "start_date", "finish_date", "days_remaining", "total_days",
                  "dates_configured"]


def _identity(df: DataFrame, label: str | None = None) -> DataFrame:
    return df


@dataclass
class Scope:
    """What the runs over the same inputs share whatever their day: in-scope work items as landed and their newest comments."""

    parents: DataFrame
    children: DataFrame
    items: DataFrame
    comments: DataFrame


def find_scope(inp: TrackerInputs, as_of: str, p: Params, stage=cut_lineage) -> Scope:
    """The scope for several runs, each of its two tables built once. Which sprint is current, and so the scope, does
    not depend on the day: ``as_of`` only sets the sprint's figures, which each run works out."""
    sprint = current_sprint(inp.iterations, as_of)
    parents = sprint_parents(inp.stories, sprint, p, fits_broadcast(sprint, p.broadcast_row_limit))
    children = child_ids(parents, inp.links)
    items = stage(scoped_items(inp.work_items, children, p), "landed items")
    return Scope(parents, children, items, stage(newest_of(inp.comments, items), "landed comments"))


def newest_of(comments: DataFrame, items: DataFrame) -> DataFrame:
    """The newest versions of the comments on ``items``; F8 before S5: no others are scanned further."""
    ids = items.select("org", F.col("id").alias("work_item_id")).distinct()
    return current_comments(comments.join(ids, ["org", "work_item_id"], "left_semi"))


def build_tasks(inp: TrackerInputs, as_of: str, p: Params, stage=_identity, scope: Scope | None = None
                ) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Discovery + comment assembly: one row per (project, task) with sprint scalars attached.

    ``stage`` materialises the two tables read by several consumers: in-scope
    items and the cleaned lookback comments. ``scope`` takes what ``find_scope``
    has found for several runs.
    """
    sprint = current_sprint(inp.iterations, as_of)
    # One bounded size probe of the sprint table serves both joins that use it.
    sprint_small = fits_broadcast(sprint, p.broadcast_row_limit)
    parents = scope.parents if scope else sprint_parents(inp.stories, sprint, p, sprint_small)
    children = scope.children if scope else child_ids(parents, inp.links)
    items = stage(project_items(scope.items if scope else scoped_items(inp.work_items, children, p), as_of), "in-scope items")
    mine = scope.comments if scope else newest_of(inp.comments, items)
    recent = stage(recent_comments(mine, as_of, p), "lookback comments")
    tasks = attach_comments(items, comment_rollup(recent))
    tasks = join_small(tasks, sprint.select("org", "project", *SPRINT_COLUMNS), ["org", "project"], "inner",
                       p.broadcast_row_limit, sprint_small)
    return tasks, recent, sprint, stage_counts(parents, children, items)


def analyse(tasks: DataFrame, recent: DataFrame, as_of: str, p: Params, history: DataFrame | None,
            grader_responses: DataFrame | None = None, nudge_responses: DataFrame | None = None,
            stage=_identity) -> DataFrame:
    """Branch, analyse the analysed branch only, score, flag and nudge; skipped rows take fixed defaults (K7)."""
    t = stage(assign_branch(tasks, history, p, as_of), "branched tasks")
    analysed = F.col("branch") == F.lit(BRANCH_ANALYSED)
    # Similarity only for analysed tasks (explicit filter before the costly stage).
    docs = similarity_docs(recent, t.where(analysed).select("org", "id"))
    cp = copy_paste(docs, p.copy_paste_threshold, report_max=False).select(
        F.col("key.org").alias("org"), F.col("key.work_item_id").alias("id"), F.col("copy_paste_detected").alias("cp"))
    t = t.join(cp, ["org", "id"], "left")
    t = grade(t, as_of, grader_responses)
    copied = analysed & F.coalesce(F.col("cp"), F.lit(False))
    q = F.col("quality")
    label = F.when(copied & (q["quality_label"] != F.lit("missing")), F.lit("copy-pasted")).otherwise(q["quality_label"])
    t = t.withColumns({
        "eod_compliant": analysed & F.col("has_comment_today"),
        "quality_score": F.when(analysed, q["quality_score"]).otherwise(F.lit(0)),
        "quality_label": F.when(analysed, label).otherwise(F.lit(SKIPPED_LABEL)),
        "blocker_detected": F.when(analysed, q["blocker_detected"]).otherwise(F.lit(False)),
        "progress_detectable": F.when(analysed, q["progress_detectable"]).otherwise(F.lit(False)),
        "sentiment": F.when(analysed, q["sentiment"]).otherwise(F.lit(DEFAULT_SENTIMENT)),
        "suggested_followup": F.when(analysed, q["suggested_followup"]).otherwise(F.lit("")),
        "copy_paste_detected": copied,
    }).drop("quality", "cp")
    t = score_risk(t, p)
    t = flag_attention(t, p)
    skipped_signals = F.struct(F.lit(0).alias("days_since_state_change"), F.lit(0).alias("days_since_last_update"),
                               F.lit(False).alias("hours_stale"), F.lit(0).alias("comment_quality_score"),
                               F.lit(False).alias("copy_paste_detected"), F.lit(False).alias("blocker_detected"),
                               F.lit(0).alias("days_remaining_in_sprint"))
    first_label = p.label_cuts[0][1]
    t = t.withColumns({
        "risk_score": F.when(analysed, F.col("risk_score")).otherwise(F.lit(0)),
        "risk_label": F.when(analysed, F.col("risk_label")).otherwise(F.lit(first_label)),
        "hours_stale": F.when(analysed, F.col("hours_stale")).otherwise(F.lit(False)),
        "signals": F.when(analysed, F.col("signals")).otherwise(skipped_signals),
        "quality_gate_triggered": analysed & F.col("quality_gate_triggered"),
        "needs_attention": analysed & F.col("needs_attention"),
    })
    return write_nudges(t, as_of, nudge_responses)


@dataclass
class DailyRun:
    tasks: DataFrame
    snapshot: DataFrame
    summary: DataFrame
    cards: DataFrame
    dispositions: DataFrame
    disposition_counts: DataFrame
    reminders: DataFrame
    report: DataFrame
    stage_counts: DataFrame
    sprint: DataFrame
    grading_requests: DataFrame
    nudge_requests: DataFrame
    built: tuple[DataFrame, DataFrame, DataFrame, DataFrame]


def run_daily(inp: TrackerInputs, as_of: str, p: Params = Params(), grader_responses: DataFrame | None = None,
              nudge_responses: DataFrame | None = None, recipients=None, materialize: bool = True,
              require_sprint: bool = False, built: tuple | None = None, scope: Scope | None = None) -> DailyRun:
    """Build every output of one run.

    ``built`` takes the tasks and comments of another run (``DailyRun.built``) over
    the same inputs at the same ``as_of``, e.g. to grade them by other replies;
    ``scope`` takes what ``find_scope`` has found for runs of several days.

    With ``materialize`` (default) the tables read by several consumers are
    checkpointed into the shared checkpoint folder: in-scope items, lookback
    comments, branched tasks and the enriched task table before the fan-out
    to snapshot, summary, cards and outboxes. Each is computed once, survives
    executor loss, and keeps every downstream plan small.
    """
    if require_sprint and inp.iterations.isEmpty():
        raise RuntimeError("no current iteration found")
    stage = cut_lineage if materialize else _identity
    tasks, recent, sprint, counts = built or build_tasks(inp, as_of, p, stage, scope)
    enriched = stage(analyse(tasks, recent, as_of, p, inp.history, grader_responses, nudge_responses, stage),
                     "enriched tasks")
    disp = dispositions(enriched, p, recipients)
    summary = run_summary(enriched)
    return DailyRun(
        tasks=enriched, snapshot=to_snapshot_rows(enriched, as_of), summary=summary,
        cards=report_cards(enriched, as_of), dispositions=disp, disposition_counts=disposition_counts(disp),
        reminders=reminder_outbox(disp, as_of, p), report=report_outbox(summary, sprint, as_of, p, recipients),
        stage_counts=counts, sprint=sprint,
        grading_requests=grading_requests(enriched, as_of),
        nudge_requests=enriched.where("needs_attention").select(
            "org", "project", F.col("id").alias("work_item_id"), F.col("nudge_request").alias("request")),
        built=(tasks, recent, sprint, counts),
    )
