"""Registered queries that run over several landings, streams or files: comment state, replies, ordered output, observed writes."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workpulse.functions.dates import as_of_ts
from workpulse.operators.discovery import child_ids, current_sprint, sprint_parents
from workpulse.operators.nudge import write_nudges
from workpulse.operators.ranking import read_ordered, with_positions, write_ordered
from workpulse.params import DEFAULT_AS_OF, Params
from workpulse.plans import oracle as O
from workpulse.plans.daily import DailyRun, run_daily
from workpulse.session import checkpoint_dir
from workpulse.sources import standins as SV
from workpulse.sources.comment_state import COLUMNS, compact, newest_comments
from workpulse.sources.landed import COMMENT_PAYLOAD, CORRUPT, explode_comments, read_json
from workpulse.sources.snapshot_store import observed_upsert, read_snapshot
from workpulse.streaming.replies import closing_marks, match_landed

AS_OF = DEFAULT_AS_OF
P = Params()


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# ---------------------------------------------------------------------------
# Comment state
# ---------------------------------------------------------------------------

#: Landing times at which the first and the second epoch of the stand-in end.
EPOCH_ENDS = ("2024-01-12 00:00:00", "2024-01-22 00:00:00")


def land_comments(spark: SparkSession, sf: str, landing: str, on_epoch) -> None:
    """Four landings: three by landing time, then old versions once more (a late redelivery)."""
    v = SV.landed_versions(spark, sf).select(*COLUMNS)
    first, second = (F.lit(t).cast("timestamp") for t in EPOCH_ENDS)
    at = F.col("landed_at")
    parts = [at < first, (at >= first) & (at < second), at >= second, (at < first) & (F.col("id") % 6 == 0)]
    for epoch, part in enumerate(parts):
        v.where(part).write.parquet(f"{landing}/epoch={epoch}")
        on_epoch(epoch)


def q_comment_state_loop(spark, sf) -> DataFrame:
    """The newest version of each comment, from state and later epochs, after edits, redeliveries and two compactions."""
    base = new_folder(spark, "comment-state")
    land_comments(spark, sf, f"{base}/landed", lambda e: compact(spark, f"{base}/landed", f"{base}/state", e) if e in (0, 2) else None)
    c = newest_comments(spark, f"{base}/landed", f"{base}/state", 3)
    return c.select("org", "work_item_id", F.col("id").alias("comment_id"), "text", "createdDate", "landed_at")


def q_comment_lookback(spark, sf) -> DataFrame:
    """The same with a lookback: the days before it are not read from the state."""
    base = new_folder(spark, "comment-lookback")
    land_comments(spark, sf, f"{base}/landed", lambda e: compact(spark, f"{base}/landed", f"{base}/state", e) if e == 1 else None)
    since = datetime.date.fromisoformat(AS_OF[:10]) - datetime.timedelta(days=P.lookback_days)
    c = newest_comments(spark, f"{base}/landed", f"{base}/state", 2, since)
    return c.select("org", "work_item_id", F.col("id").alias("comment_id"), "text", "createdDate", "landed_at")


NEWEST_SQL = """
  SELECT org, work_item_id, id AS comment_id,
    CASE WHEN version = 2 THEN coalesce(text, '') || ' (edited)' ELSE text END AS text,
    CASE WHEN abs(id) % 7 = 0 THEN '2099-01-01T00:00:00Z' ELSE createdDate END AS createdDate,
    landed_at + to_days(CAST(version AS INTEGER)) AS landed_at
  FROM (SELECT *, CASE WHEN abs(id) % 5 = 0 THEN 2 WHEN abs(id) % 3 = 0 THEN 1 ELSE 0 END AS version FROM sv_comments)"""


def sql_comment_state_loop() -> str:
    return O.with_ctes(O.standin_ctes(AS_OF), NEWEST_SQL)


def sql_comment_lookback() -> str:
    return O.with_ctes(O.standin_ctes(AS_OF), f"""
      SELECT * FROM ({NEWEST_SQL}) WHERE createdDate <> ''
        AND CAST(substr(createdDate, 1, 10) AS DATE) >= CAST('{AS_OF[:10]}' AS DATE) - {P.lookback_days}""")


# ---------------------------------------------------------------------------
# Replies
# ---------------------------------------------------------------------------

WAIT = "2 hours"
CLOSED = "2024-02-02 00:00:00"


def _landed_replies(spark: SparkSession, requests: DataFrame, replies: DataFrame, name: str) -> DataFrame:
    """Responses to the requests, through landed files and the stream join."""
    base = new_folder(spark, name)
    last_request, last_reply = closing_marks(spark, CLOSED)
    requests.unionByName(last_request).write.parquet(f"{base}/requests")
    replies.unionByName(last_reply).write.parquet(f"{base}/replies")
    return match_landed(spark, f"{base}/requests", f"{base}/replies", f"{base}/responses", f"{base}/checkpoint", WAIT)


def _asked(requests: DataFrame, kind: str) -> DataFrame:
    at = F.timestamp_seconds(F.unix_seconds(as_of_ts(AS_OF)) + F.col("work_item_id") % 600)
    return requests.select("org", "work_item_id", as_of_ts(AS_OF).alias("as_of"), F.lit(kind).alias("kind"), at.alias("asked_at"))


def _replied(asked: DataFrame, raw, answered, late) -> DataFrame:
    """Replies a minute after their requests, or three hours if ``late``."""
    after = F.when(late, F.lit(3 * 3600)).otherwise(F.lit(60))
    return asked.where(answered).select("org", "work_item_id", "as_of", "kind", raw.alias("raw"),
                                        F.timestamp_seconds(F.unix_seconds("asked_at") + after).alias("replied_at"))


def _grade_replies(asked: DataFrame) -> DataFrame:
    """By work_item_id % 9: bare, fenced, null, 8.0, junk, late, none, a missing key, 7.5."""
    k = F.col("work_item_id")
    m = k % 9
    score = F.when(m == 1, F.lit("6")).when(m == 3, F.lit("8.0")).when(m == 8, F.lit("7.5")).otherwise(F.lit("8"))
    label = F.when(m == 0, F.lit("excellent")).otherwise(F.lit("good"))
    body = F.concat(F.lit('{"quality_score": '), score, F.lit(', "quality_label": "'), label, F.lit('", "blocker_detected": '),
                    F.when(k % 2 == 0, F.lit("true")).otherwise(F.lit("null")), F.lit(', "progress_detectable": true, "sentiment": "positive"'),
                    F.when(m == 7, F.lit("")).otherwise(F.concat(F.lit(', "suggested_followup": "What is next on '), k.cast("string"), F.lit('?"'))), F.lit("}"))
    raw = F.when(m == 1, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).when(m == 4, F.lit("I cannot grade {this}")).when(m != 2, body)
    return _replied(asked, raw, m != 6, m == 5)


def _nudge_replies(asked: DataFrame) -> DataFrame:
    """By work_item_id % 5: both fields, a message only, junk, none, late."""
    k = F.col("work_item_id")
    m = k % 5
    message = F.concat(F.lit('{"message": "Please update '), k.cast("string"), F.lit('"'))
    raw = F.when(m == 1, F.concat(message, F.lit("}"))).when(m == 2, F.lit("no reply today")).otherwise(F.concat(message, F.lit(', "tone": "firm"}')))
    return _replied(asked, raw, m != 3, m == 4)


def _daily(spark: SparkSession, sf: str) -> DailyRun:
    from workpulse.plans.queries import _run  # one run without replies is shared with the other queries
    return _run(spark, sf)


def q_daily_with_replies(spark, sf) -> DataFrame:
    """The daily run with graders and nudge writers that answer in many ways, late or not at all."""
    first = _daily(spark, sf)
    asked = _asked(first.grading_requests, "grade")
    grades = _landed_replies(spark, asked, _grade_replies(asked), "grade-replies")
    run = run_daily(SV.tracker_inputs(spark, sf, AS_OF), AS_OF, P, grader_responses=grades, built=first.built)
    asked = _asked(run.nudge_requests, "nudge")
    nudges = _landed_replies(spark, asked, _nudge_replies(asked), "nudge-replies")
    t = write_nudges(run.tasks, AS_OF, nudges)
    return t.select("org", "project", F.col("id").alias("work_item_id"), "branch", "quality_score", "quality_label", "blocker_detected", "sentiment",
                    "suggested_followup", "copy_paste_detected", "risk_score", "risk_label", "needs_attention",
                    F.col("nudge.tone").alias("nudge_tone"), F.col("nudge.message").alias("nudge_message"))


def sql_daily_with_replies() -> str:
    blank, ok = O.is_blank("b.today_comment_text"), "b.id % 9 IN (0, 1, 3)"
    graded = f"""
      SELECT b.*, coalesce(c.copy_paste_detected, false) AND b.branch = 'analysed' AS copied,
        CASE WHEN {blank} THEN 0 WHEN {ok} THEN (CASE WHEN b.id % 9 = 1 THEN 6 ELSE 8 END) ELSE 0 END AS g_score,
        CASE WHEN {blank} THEN 'missing' WHEN {ok} THEN (CASE WHEN b.id % 9 = 0 THEN 'excellent' ELSE 'good' END) ELSE 'vague' END AS g_label,
        NOT {blank} AND {ok} AND b.id % 2 = 0 AS g_blocker, NOT {blank} AND {ok} AS g_progress,
        CASE WHEN NOT {blank} AND {ok} THEN 'positive' ELSE 'neutral' END AS g_sentiment,
        CASE WHEN {blank} THEN 'Can you share what you worked on today for ''' || b.title || '''?'
             WHEN {ok} THEN 'What is next on ' || CAST(b.id AS VARCHAR) || '?'
             ELSE 'What progress did you make on ''' || b.title || ''' today?' END AS g_followup
      FROM branched b LEFT JOIN cp_result c ON c.key = b.org || '/' || CAST(b.id AS VARCHAR)"""
    ctes = [(n, graded if n == "graded" else sql) for n, sql in O.pipeline_ctes(AS_OF, P)]
    return O.with_ctes(ctes, """
      SELECT org, project, id AS work_item_id, branch, quality_score, quality_label, blocker_detected, sentiment, suggested_followup,
        copy_paste_detected, risk_score, risk_label, needs_attention,
        CASE WHEN needs_attention AND id % 5 = 0 THEN 'firm' ELSE nudge_tone END AS nudge_tone,
        CASE WHEN needs_attention AND id % 5 IN (0, 1) THEN 'Please update ' || CAST(id AS VARCHAR) ELSE nudge_message END AS nudge_message
      FROM final""")


# ---------------------------------------------------------------------------
# Ordered output
# ---------------------------------------------------------------------------

def q_ordered_children(spark, sf) -> DataFrame:
    """Parents and children of each project by ascending id, with positions, read back from sorted files."""
    sprint = current_sprint(SV.iterations(spark, sf, AS_OF), AS_OF)
    parents = sprint_parents(SV.stories(spark, sf), sprint, P)
    ids = parents.select("org", "project", "id").withColumn("kind", F.lit("parent")).unionByName(
        child_ids(parents, SV.links(spark, sf)).withColumn("kind", F.lit("child")))
    by = ["org", "project", "kind"]
    path = new_folder(spark, "ordered-children")
    write_ordered(with_positions(ids, by, [F.col("id")]), path, [*by, "position"])
    return read_ordered(spark, path).select(*by, "id", "position")


def sql_ordered_children() -> str:
    return O.with_ctes(O.standin_ctes(AS_OF) + O.sprint_ctes(AS_OF) + O.discovery_ctes(AS_OF, P), """
      SELECT *, row_number() OVER (PARTITION BY org, project, kind ORDER BY id) AS position
      FROM (SELECT org, project, 'parent' AS kind, id FROM parents UNION ALL SELECT org, project, 'child' AS kind, id FROM children)""")


# ---------------------------------------------------------------------------
# Observed writes
# ---------------------------------------------------------------------------

def q_write_report(spark, sf) -> DataFrame:
    """What the writes of three runs reported: a whole one, one with rows that break NOT NULL, an empty one.

    Rows that break a NOT NULL column stop a run's write before the table is
    touched; ``table_rows`` is counted in the table after each run.
    """
    rows = _daily(spark, sf).snapshot
    path = new_folder(spark, "observed")
    broken = rows.withColumns({"task_title": F.when(F.col("work_item_id") % 10 != 0, F.col("task_title")),
                               "risk_label": F.when(F.col("work_item_id") % 4 != 0, F.col("risk_label"))})
    out = []
    for name, run in (("whole", rows), ("broken", broken), ("empty", rows.where("false"))):
        m = observed_upsert(spark, path, run, staged=True)
        out.append((name, m.rows, m.violations, m.nulls.get("task_title", 0), m.nulls.get("risk_label", 0), m.written, read_snapshot(spark, path).count()))
    return spark.createDataFrame(out, "run string, n_rows long, violations long, null_titles long, null_labels long, written boolean, table_rows long")


def sql_write_report() -> str:
    return O.with_ctes(O.pipeline_ctes(AS_OF, P), """
      SELECT 'whole' AS run, count(*) AS n_rows, 0::BIGINT AS violations, 0::BIGINT AS null_titles, 0::BIGINT AS null_labels, true AS written, count(*) AS table_rows FROM final
      UNION ALL SELECT 'broken', count(*), count(*) FILTER (WHERE id % 10 = 0 OR id % 4 = 0), count(*) FILTER (WHERE id % 10 = 0),
        count(*) FILTER (WHERE id % 4 = 0), false, count(*) FROM final
      UNION ALL SELECT 'empty', 0, 0, 0, 0, false, count(*) FROM final""")


# ---------------------------------------------------------------------------
# Quarantine
# ---------------------------------------------------------------------------

def q_quarantined_records(spark, sf) -> DataFrame:
    """Comment payloads landed as lines, some of them cut, mistyped, no JSON, empty or blank: the comments of the
    good ones beside the text of the others, which name the file they came from."""
    e = SV.read_table(spark, sf, "events").select("event_id", F.col("event_id").cast("string").alias("eid"),
                                                  F.col("user_id").cast("string").alias("uid"), "event_type")
    m = F.col("event_id") % 9
    head = F.concat(F.lit('{"org": "contoso", "work_item_id": '), "uid")
    line = (F.when(m == 0, head)
            .when(m == 1, F.concat(F.lit('{"org": "contoso", "work_item_id": "seven", "comments": [{"id": '), "eid", F.lit("}]}")))
            .when(m == 2, F.concat(F.lit("no record: "), "eid")).when(m == 3, F.lit("{}")).when(m == 4, F.lit("  "))
            .when(m == 5, F.concat(head, F.lit(', "comments": null}')))
            .otherwise(F.concat(head, F.lit(', "comments": [{"id": '), "eid", F.lit(', "text": "'), "event_type", F.lit('"}]}'))))
    path = new_folder(spark, "payload-lines")
    e.select(line.alias("value")).write.text(path)
    got = read_json(spark, path, COMMENT_PAYLOAD)
    nothing = F.lit(None)
    good = explode_comments(got.rows).select(F.lit("comment").alias("kind"), "org", "work_item_id", F.col("id").alias("comment_id"), "text",
                                             nothing.cast("string").alias("record"), nothing.cast("boolean").alias("has_file"))
    bad = got.quarantine.select(F.lit("quarantined").alias("kind"), nothing.cast("string").alias("org"), nothing.cast("long").alias("work_item_id"),
                                nothing.cast("long").alias("comment_id"), nothing.cast("string").alias("text"), F.col(CORRUPT).alias("record"),
                                (F.col("file").contains(path.rsplit("/", 1)[1]) & F.col("split_start").isNotNull() & F.col("landed_at").isNotNull()).alias("has_file"))
    return good.unionByName(bad)


def sql_quarantined_records() -> str:
    return """
      SELECT 'comment' AS kind, 'contoso' AS org, user_id AS work_item_id, event_id AS comment_id, event_type AS text,
        NULL::VARCHAR AS record, NULL::BOOLEAN AS has_file
      FROM events WHERE event_id % 9 > 5
      UNION ALL
      SELECT 'quarantined', NULL, NULL, NULL, NULL,
        CASE event_id % 9 WHEN 0 THEN '{"org": "contoso", "work_item_id": ' || user_id
          WHEN 1 THEN '{"org": "contoso", "work_item_id": "seven", "comments": [{"id": ' || event_id || '}]}'
          WHEN 2 THEN 'no record: ' || event_id ELSE '{}' END, true
      FROM events WHERE event_id % 9 < 4"""


LOOPS = {
    "comment_state_loop": (q_comment_state_loop, sql_comment_state_loop),
    "comment_lookback": (q_comment_lookback, sql_comment_lookback),
    "daily_with_replies": (q_daily_with_replies, sql_daily_with_replies),
    "ordered_children": (q_ordered_children, sql_ordered_children),
    "write_report": (q_write_report, sql_write_report),
    "quarantined_records": (q_quarantined_records, sql_quarantined_records),
}
