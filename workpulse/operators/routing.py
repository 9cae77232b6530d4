"""Notification routing as tables: reminder dispositions and outbox rows, report outbox, report cards
(F14-F17, J7, A12, A13, S9, S10, X7, X10, X11, X18-X20, X22, D9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from workpulse.functions.dates import as_of_ts, display_date, display_datetime
from workpulse.functions.text import py_strip, reminder_first_name
from workpulse.operators.ranking import with_positions
from workpulse.params import Params
from workpulse.session import join_small, stage_table

# ---------------------------------------------------------------------------
# Fixed values (message texts and formats).
# ---------------------------------------------------------------------------
REMINDER_SUBJECT = "EOD Reminder - #%s %s - %s - %s"
REMINDER_GREETING = "Hi %s,\n\nYour task #%s '%s' needs attention (risk: %s, score: %s).\n\n"
REMINDER_NO_COMMENT = "No EOD comment was added today.\n\n"
REMINDER_COPIED = ("Today's comment appears identical to a recent one (score %s/10). "
                   "Please add a meaningful update describing what actually changed today.\n\n")
REMINDER_LOW = ("Today's comment scored %s/10 — "
                "a more specific update (what was done, what remains, any risks) would help.\n\n")
REMINDER_NUDGE = "Suggested next step: %s\n\n"
REMINDER_FOOTER = "Open the HTML version of this email for full details."
REASON_NO_COMMENT = "no comment today"
REASON_COPIED = "copy-pasted comment (score %s/10)"
REASON_LOW = "quality score %s/10 below threshold %s"
REPORT_SUBJECT = "EOD Task Report - %s - %s"
REPORT_BODY = ("EOD Task Report for %s (%s)\n\nTotal tasks: %s\nNeeds attention: %s\nHealthy: %s\n\n"
               "Open the HTML version to see full details and nudge messages.")
PILL_NO_COMMENT = "No comment today"
PILL_COPIED = "Copy-pasted comment"
PILL_BLOCKER = "Blocker detected"
PILL_HOURS = "Hours not updated"
PILL_STATE = "State unchanged %sd"
PILL_QUALITY = "Comment quality: %s/10 (%s)"
NO_COMMENT_PLACEHOLDER = "No EOD comment added today."
UNKNOWN_SPRINT_END = "unknown"

DISPOSITIONS = ("skipped_state", "skipped_good_quality", "skipped_no_email", "already_recipient", "sent")


def _recipients_df(spark, recipients) -> DataFrame:
    if isinstance(recipients, DataFrame):
        df = recipients.select(F.col(recipients.columns[0]).alias("email"))
    else:
        df = spark.createDataFrame([(r,) for r in recipients], "email string")
    return df.select(F.lower(py_strip(F.col("email"))).alias("recipient_key")).distinct()


def dispositions(tasks: DataFrame, p: Params, recipients=None) -> DataFrame:
    """Flagged tasks with their first-failing-test ``disposition`` and ``send_reason``.

    Order of tests: state > good quality > no email > already a recipient > send.
    """
    flagged = tasks.where(F.col("needs_attention"))
    state = F.col("state_norm")
    email = py_strip(F.coalesce(F.col("assignee_email"), F.lit("")))
    has, copied, q = F.col("has_comment_today"), F.col("copy_paste_detected"), F.col("quality_score")
    is_gate = state == F.lit(p.gate)
    good = has & ~copied & (q >= F.lit(p.good_threshold))
    rec = _recipients_df(tasks.sparkSession, recipients if recipients is not None else p.recipients)
    f = flagged.withColumn("email_key", F.lower(email))
    f = join_small(f, rec.select(F.col("recipient_key").alias("email_key"), F.lit(True).alias("is_recipient")),
                   "email_key", "left", p.broadcast_row_limit)
    disp = (F.when(~state.isin(list(p.active_states)), F.lit("skipped_state"))
            .when(is_gate & good, F.lit("skipped_good_quality"))
            .when(email == "", F.lit("skipped_no_email"))
            .when(F.coalesce(F.col("is_recipient"), F.lit(False)), F.lit("already_recipient"))
            .otherwise(F.lit("sent")))
    reason = (F.when(~is_gate, F.lit(None).cast("string"))
              .when(~has, F.lit(REASON_NO_COMMENT))
              .when(copied, F.format_string(REASON_COPIED, q))
              .when(q < F.lit(p.good_threshold), F.format_string(REASON_LOW, q, F.lit(p.good_threshold))))
    return f.withColumn("disposition", disp).withColumn("send_reason", reason).withColumn("email_to", email)


def disposition_counts(disp: DataFrame) -> DataFrame:
    """Per project and disposition (the duplicate-recipient case has no counter in the reference)."""
    return disp.groupBy("org", "project", "disposition").agg(F.count(F.lit(1)).cast("long").alias("n"))


def reminder_body(p: Params) -> Column:
    has, copied, q = F.col("has_comment_today"), F.col("copy_paste_detected"), F.col("quality_score")
    issue = (F.when(~has, F.lit(REMINDER_NO_COMMENT))
             .when(copied, F.format_string(REMINDER_COPIED, q))
             .when(q < F.lit(p.good_threshold), F.format_string(REMINDER_LOW, q))
             .otherwise(F.lit("")))
    nudge = F.when(F.col("nudge").isNotNull(), F.format_string(REMINDER_NUDGE, F.col("nudge.message"))) \
        .otherwise(F.lit(""))
    head = F.format_string(REMINDER_GREETING, F.col("assignee_name"), F.col("id"), F.col("title"),
                           F.col("risk_label"), F.col("risk_score"))
    return F.concat(head, issue, nudge, F.lit(REMINDER_FOOTER))


def reminder_outbox(disp: DataFrame, as_of: str, p: Params) -> DataFrame:
    """One outbox row per reminder to send (subject, body, recipient)."""
    today = display_date(as_of_ts(as_of))
    sent = disp.where(F.col("disposition") == "sent")
    return sent.select(
        "org", "project", F.col("id").alias("work_item_id"), F.lit("reminder").alias("kind"),
        F.array(F.col("email_to")).alias("recipients"),
        F.format_string(REMINDER_SUBJECT, F.col("id"), F.col("title"), F.col("sprint_name"), today).alias("subject"),
        reminder_body(p).alias("body"),
        reminder_first_name(F.col("assignee_name")).alias("first_name"),
        "send_reason",
    )


def recipient_batches(recipients: DataFrame, size: int) -> DataFrame:
    """``batch`` (from 0) and its ``recipients``: the distinct addresses in order, ``size`` to a batch.

    Addresses are numbered by ranges of their order, so no task and no row holds all of them.
    """
    listed = recipients.select(F.lit(1).alias("list"), py_strip(F.col("email")).alias("email")).where("email != ''").distinct()
    placed = with_positions(listed, ["list"], [F.col("email")])
    return (placed.groupBy(F.floor((F.col("position") - 1) / F.lit(size)).cast("long").alias("batch"))
            .agg(F.array_sort(F.collect_list("email")).alias("recipients")))


def report_outbox(summary: DataFrame, sprint: DataFrame, as_of: str, p: Params, recipients: DataFrame | None = None
                  ) -> DataFrame:
    """S9 + X11: one report row per project with tasks and ``batch`` of recipients, the array of a mail header.

    ``recipients`` (email), the same table that the dispositions use, comes
    before the parameter list. A batch has ``p.report_batch`` addresses at
    most; without recipients each project has one row with an empty array.
    """
    today = display_date(as_of_ts(as_of))
    s = summary.join(sprint.select("org", "project", "sprint_name"), ["org", "project"])
    if recipients is None:
        lists = [p.recipients[i:i + p.report_batch] for i in range(0, len(p.recipients), p.report_batch)] or [()]
        rows = F.array(*[F.struct(F.lit(i).cast("long").alias("batch"), F.array(*[F.lit(r) for r in x]).cast("array<string>").alias("recipients"))
                         for i, x in enumerate(lists)])
        s = s.select("*", F.inline(rows))
    else:
        batches = stage_table(recipient_batches(recipients, p.report_batch), "recipient batches")
        n = batches.count()
        s = s.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(n, 1) - 1).cast("long"))).alias("batch"))
        s = s.join(batches, "batch", "left").withColumn("recipients", F.coalesce("recipients", F.array().cast("array<string>")))
    return s.select(
        "org", "project", "batch", F.lit("report").alias("kind"), "recipients",
        F.format_string(REPORT_SUBJECT, F.col("sprint_name"), today).alias("subject"),
        F.format_string(REPORT_BODY, F.col("sprint_name"), today, F.col("total_tasks"), F.col("flagged_tasks"),
                        F.col("total_tasks") - F.col("flagged_tasks")).alias("body"),
        display_datetime(as_of_ts(as_of)).alias("fetched_at_display"),
    )


def report_cards(tasks: DataFrame, as_of: str) -> DataFrame:
    """Typed report-card values per task (no HTML), true label kept."""
    flagged = F.col("needs_attention")
    hours = F.when(F.col("remaining_hours").isNotNull(),
                   F.concat(F.col("remaining_hours").cast("string"), F.lit("h remaining")))
    meta = F.concat_ws(" · ", F.col("assignee_name"),
                       F.when(flagged, F.concat(F.lit("State: "), F.col("state"))).otherwise(F.col("state")), hours)
    pills = F.array_compact(F.array(
        F.when(~F.col("eod_compliant"), F.lit(PILL_NO_COMMENT)),
        F.when(F.col("copy_paste_detected"), F.lit(PILL_COPIED)),
        F.when(F.col("blocker_detected"), F.lit(PILL_BLOCKER)),
        F.when(F.col("hours_stale"), F.lit(PILL_HOURS)),
        F.format_string(PILL_STATE, F.col("signals.days_since_state_change")),
        F.format_string(PILL_QUALITY, F.col("quality_score"), F.col("quality_label"))))
    text = F.nullif(F.col("today_comment_text"), F.lit(""))
    return tasks.select(
        "org", "project", F.col("id").alias("work_item_id"),
        F.when(flagged, F.lit("flagged")).otherwise(F.lit("healthy")).alias("section"),
        F.concat(F.lit("#"), F.col("id").cast("string"), F.when(flagged, F.lit(" : ")).otherwise(F.lit(" — ")),
                 F.col("title")).alias("card_title"),
        meta.alias("meta"),
        F.col("risk_label").alias("badge_label"), F.col("risk_score").alias("badge_score"),
        F.when(flagged, pills).otherwise(F.array().cast("array<string>")).alias("pills"),
        F.when(flagged, F.coalesce(text, F.lit(NO_COMMENT_PLACEHOLDER))).otherwise(text).alias("comment"),
        F.col("nudge.tone").alias("nudge_tone"), F.col("nudge.message").alias("nudge_message"),
        F.coalesce(F.substring(F.nullif(F.col("finish_date"), F.lit("")), 1, 10), F.lit(UNKNOWN_SPRINT_END))
        .alias("sprint_end_display"),
        display_datetime(as_of_ts(as_of)).alias("fetched_at_display"),
    )


def section_sizes(cards: DataFrame) -> DataFrame:
    """Flagged / healthy counts per project."""
    return cards.groupBy("org", "project").agg(
        F.count_if(F.col("section") == "flagged").cast("long").alias("flagged_count"),
        F.count_if(F.col("section") == "healthy").cast("long").alias("healthy_count"))
