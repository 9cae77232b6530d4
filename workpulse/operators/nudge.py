"""Nudge stage for flagged tasks: first name, issue list, request text, reply parse, fallback."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from workpulse.functions.dates import as_of_ts
from workpulse.functions.text import nudge_first_name
from workpulse.functions.text import py_strip
from workpulse.operators.grading import unfence
from workpulse.params import DEFAULT_TONE, ESCALATED_LABELS
from workpulse.schemas import NUDGE_FIELDS

# ---------------------------------------------------------------------------
# Fixed values (issue phrases, joiner, default and fallback texts).
# ---------------------------------------------------------------------------
ISSUE_NO_COMMENT = "no EOD comment was added today"
ISSUE_COPIED = "the EOD comment appears identical to previous days"
ISSUE_VAGUE = "the EOD comment is too vague to indicate real progress"
ISSUE_BLOCKER = "a blocker was mentioned in the comment"
ISSUE_HOURS = "remaining hours have not been updated"
ISSUE_RISK = "this task is scored %s for sprint completion"
ISSUES_JOINER = "; "
ISSUES_DEFAULT = "the task needs attention"
FALLBACK_MESSAGE = "Hi %s, a quick note on %s: %s. Can you share an update before EOD?"
REQUEST_LINES = ("Developer first name: ", "Task title: ", "Current state: ", "Remaining hours: ",
                 "Sprint days remaining: ", "Issues identified: ", "Consecutive days flagged: ",
                 "Suggested follow-up question from analysis: ")
HOURS_NOT_SET = "not set"
CONSECUTIVE_DAYS = 1


def issues_text(has_comment, label, blocker, stale, risk_label) -> Column:
    """Ordered issue list joined by '; ', default text when empty."""
    first = (F.when(~has_comment, F.lit(ISSUE_NO_COMMENT))
             .when(label == "missing", F.lit(ISSUE_NO_COMMENT))
             .when(label == "copy-pasted", F.lit(ISSUE_COPIED))
             .when(label == "vague", F.lit(ISSUE_VAGUE)))
    items = F.array_compact(F.array(
        first,
        F.when(blocker, F.lit(ISSUE_BLOCKER)),
        F.when(stale, F.lit(ISSUE_HOURS)),
        F.when(risk_label.isin(*ESCALATED_LABELS), F.format_string(ISSUE_RISK, risk_label))))
    return F.coalesce(F.nullif(F.array_join(items, ISSUES_JOINER), F.lit("")), F.lit(ISSUES_DEFAULT))


def nudge_columns(df: DataFrame) -> DataFrame:
    """Adds ``first_name``, ``issues`` and the X14 ``nudge_request`` text."""
    out = df.withColumn("first_name", nudge_first_name(F.col("assignee_name")))
    out = out.withColumn("issues", issues_text(F.col("has_comment_today"), F.col("quality_label"),
                                               F.col("blocker_detected"), F.col("hours_stale"), F.col("risk_label")))
    hours = F.coalesce(F.col("remaining_hours").cast("string"), F.lit(HOURS_NOT_SET))
    vals = (F.col("first_name"), F.col("title"), F.col("state"), hours, F.col("days_remaining").cast("string"),
            F.col("issues"), F.lit(str(CONSECUTIVE_DAYS)), F.coalesce(F.col("suggested_followup"), F.lit("")))
    return out.withColumn("nudge_request", F.concat_ws("\n", *[F.concat(F.lit(h), v)
                                                             for h, v in zip(REQUEST_LINES, vals)]))


def fallback_nudge() -> Column:
    """Deterministic message, tone 'gentle'."""
    return F.struct(F.format_string(FALLBACK_MESSAGE, F.col("first_name"), F.col("title"), F.col("issues"))
                    .alias("message"), F.lit(DEFAULT_TONE).alias("tone"))


def parse_nudge_reply(raw) -> tuple[Column, Column]:
    """K4: one whole JSON object; missing keys take defaults (unlike the grade reply)."""
    t = py_strip(unfence(raw))
    parsed = F.from_json(unfence(raw), NUDGE_FIELDS)
    return parsed, F.coalesce(t.startswith("{") & t.endswith("}") & parsed.isNotNull(), F.lit(False))


def write_nudges(df: DataFrame, as_of: str, responses: DataFrame | None = None) -> DataFrame:
    """Adds nullable ``nudge`` struct: only for ``needs_attention`` rows.

    A parsed reply supplies message/tone (defaults '' / 'gentle', K4); a missing
    or unparseable reply gives the fallback text (X9).
    """
    out = nudge_columns(df)
    if responses is None:
        nudge = fallback_nudge()
    else:
        # Several replies for one task and run: a deterministic pick (greatest text).
        r = (responses.where((F.col("kind") == "nudge") & (F.col("as_of") == as_of_ts(as_of)))
             .groupBy("org", "work_item_id").agg(F.max_by("raw", F.struct("as_of", "raw")).alias("nudge_reply")))
        out = out.join(r.withColumnRenamed("work_item_id", "id"), ["org", "id"], "left")
        parsed, ok = parse_nudge_reply(F.col("nudge_reply"))
        nudge = F.when(ok, F.struct(F.coalesce(parsed["message"], F.lit("")).alias("message"),
                                    F.coalesce(parsed["tone"], F.lit(DEFAULT_TONE)).alias("tone"))) \
            .otherwise(fallback_nudge())
    return out.withColumn("nudge", F.when(F.col("needs_attention"), nudge))
