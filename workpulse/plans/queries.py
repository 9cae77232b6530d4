"""Registered queries: each reads the driver tables through the stand-in recipes and runs one
operator group; ``ORACLES`` holds the matching DuckDB SQL (see ``workpulse.plans.oracle``)."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workpulse.functions.dates import as_of_ts, elapsed_days, parse_iso
from workpulse.functions.text import clean_text, image_urls, pipe_join, strip_html, tokens
from workpulse.operators.comments import comment_rollup, current_comments, recent_comments, similarity_docs
from workpulse.operators.discovery import child_ids, current_sprint, in_scope_items, project_items, sprint_parents
from workpulse.operators.gate import assign_branch, latest_compliant
from workpulse.operators.grading import with_parsed_grade, with_rubric
from workpulse.operators.nudge import write_nudges
from workpulse.operators.routing import section_sizes
from workpulse.operators.risk import flag_attention, score_risk
from workpulse.operators.similarity import copy_paste
from workpulse.operators.summary import ordered_tasks
from workpulse.params import DEFAULT_AS_OF, Params
from workpulse.plans import oracle as O
from workpulse.plans.daily import Scope, find_scope, run_daily
from workpulse.plans.loops import LOOPS
from workpulse.schemas import GRADE_FIELDS
from workpulse.session import checkpoint_dir, compiled_methods, ensure_utc, join_small, stage_table
from workpulse.sources import standins as SV
from workpulse.sources.snapshot_store import incremental_history, init_table, read_snapshot, upsert

AS_OF = DEFAULT_AS_OF
PREV_AS_OF = "2024-01-29 18:00:00"
P = Params()

_cache: dict = {}


def _run(spark: SparkSession, sf: str, as_of: str = AS_OF, landed: tuple[SV.TrackerInputs, Scope] | None = None):
    """One daily run per (session, data folder, as_of) shared by the pipeline-output queries."""
    key = (spark.sparkContext.applicationId, id(spark), sf, as_of)
    if key not in _cache:
        ensure_utc(spark)
        inp, scope = landed or (SV.tracker_inputs(spark, sf, AS_OF), None)
        _cache[key] = run_daily(inp, as_of, P, recipients=SV.recipients(spark, sf), scope=scope)
    return _cache[key]


def _landed_once(inp: SV.TrackerInputs) -> SV.TrackerInputs:
    """The inputs of several runs over the same tables: work items and comments are built once and read by each run."""
    return replace(inp, work_items=stage_table(inp.work_items, "work items"), comments=stage_table(inp.comments, "comments"))


def _sql_pipeline(final: str, as_of: str = AS_OF) -> str:
    return O.with_ctes(O.pipeline_ctes(as_of, P), final)


def _rec_cte() -> tuple[str, str]:
    return ("sv_recipients", "SELECT upper(lower(c_name) || CASE WHEN c_mktsegment = 'MACHINERY' THEN '@example.com' "
                             "ELSE '@partner.example.com' END) AS email FROM customer")


# ---------------------------------------------------------------------------
# Discovery
# ---------------------------------------------------------------------------

def q_sprint_calendar(spark, sf):
    ensure_utc(spark)
    return current_sprint(SV.iterations(spark, sf, AS_OF), AS_OF)


def sql_sprint_calendar():
    return O.with_ctes(O.standin_ctes(AS_OF) + O.sprint_ctes(AS_OF), "SELECT * FROM sprint")


def _children(spark, sf):
    sprint = current_sprint(SV.iterations(spark, sf, AS_OF), AS_OF)
    return child_ids(sprint_parents(SV.stories(spark, sf), sprint, P), SV.links(spark, sf))


def q_sprint_children(spark, sf):
    ensure_utc(spark)
    return _children(spark, sf).select("org", "project", F.col("id").alias("child_id"))


def sql_sprint_children():
    return O.with_ctes(O.standin_ctes(AS_OF) + O.sprint_ctes(AS_OF) + O.discovery_ctes(AS_OF, P),
                       "SELECT org, project, id AS child_id FROM children")


def q_in_scope_tasks(spark, sf):
    ensure_utc(spark)
    return in_scope_items(SV.work_items(spark, sf, AS_OF), _children(spark, sf), AS_OF, P)


def sql_in_scope_tasks():
    return O.with_ctes(O.standin_ctes(AS_OF) + O.sprint_ctes(AS_OF) + O.discovery_ctes(AS_OF, P),
                       "SELECT * FROM items")


def q_day_arithmetic(spark, sf):
    ensure_utc(spark)
    w = SV.work_items(spark, sf, AS_OF)
    sc = parse_iso(F.col("state_change_date"))
    cal = F.coalesce(F.greatest(F.lit(0), F.datediff(F.to_date(as_of_ts(AS_OF)), F.to_date(sc))), F.lit(0))
    return w.select("id", elapsed_days(sc, AS_OF).alias("days_since_state_change"),
                    elapsed_days(parse_iso(F.col("changed_date")), AS_OF).alias("days_since_last_update"),
                    cal.cast("int").alias("calendar_days_since_change"))


def sql_day_arithmetic():
    sc = O.parse_iso("state_change_date")
    return O.with_ctes(O.standin_ctes(AS_OF), f"""
      SELECT id, {O.elapsed_days(sc, AS_OF)} AS days_since_state_change,
        {O.elapsed_days(O.parse_iso('changed_date'), AS_OF)} AS days_since_last_update,
        CAST(coalesce(greatest(0, date_diff('day', CAST({sc} AS DATE), {O.date_lit(AS_OF)})), 0) AS INTEGER)
          AS calendar_days_since_change
      FROM sv_work_items""")


# ---------------------------------------------------------------------------
# Text
# ---------------------------------------------------------------------------

def q_html_text(spark, sf):
    pages = SV.read_table(spark, sf, "pages")
    return pages.select("page_id", strip_html(F.col("html")).alias("text"),
                        F.size(image_urls(F.col("html"))).cast("int").alias("n_images"))


def sql_html_text():
    return (f"SELECT page_id, {O.strip_html('html')} AS text, CAST(len({O.image_urls('html')}) AS INTEGER) AS n_images "
            f"FROM pages")


def q_image_urls(spark, sf):
    c = SV.comments(spark, sf).select(F.lit("comment").alias("source"), F.col("id"), F.col("text"))
    pg = SV.read_table(spark, sf, "pages").select(F.lit("page").alias("source"), F.col("page_id").alias("id"),
                                                  F.col("html").alias("text"))
    u = c.unionByName(pg).withColumn("u", image_urls(F.col("text")))
    return u.select("source", "id", pipe_join(F.col("u")).alias("image_urls"), F.size("u").cast("int").alias("n_urls"))


def sql_image_urls():
    return O.with_ctes(O.standin_ctes(AS_OF), f"""
      SELECT source, id, nullif(array_to_string(u, '|'), '') AS image_urls, CAST(len(u) AS INTEGER) AS n_urls
      FROM (SELECT source, id, {O.image_urls('text')} AS u
            FROM (SELECT 'comment' AS source, id, text FROM sv_comments
                  UNION ALL SELECT 'page' AS source, page_id AS id, html AS text FROM pages))""")


# ---------------------------------------------------------------------------
# Comments and similarity
# ---------------------------------------------------------------------------

def q_comment_rollup(spark, sf):
    ensure_utc(spark)
    r = comment_rollup(recent_comments(SV.comments(spark, sf), AS_OF, P))
    return r.select("org", "work_item_id", "has_comment_today", "today_comment_text",
                    pipe_join(F.col("today_image_urls")).alias("today_image_urls"), "today_comment_author_name",
                    "today_comment_author_email", "today_comment_ts", "recent_comment_count",
                    "recent_comment_authors")


def sql_comment_rollup():
    ctes = O.standin_ctes(AS_OF) + [("recent", O.recent_sql(AS_OF, P, None))] + O.rollup_ctes()
    return O.with_ctes(ctes, """
      SELECT org, work_item_id, has_comment_today, today_comment_text,
        nullif(array_to_string(today_image_urls, '|'), '') AS today_image_urls, today_comment_author_name,
        today_comment_author_email, today_comment_ts, recent_comment_count, recent_comment_authors
      FROM rollup""")


def _sim_out(res: DataFrame, key: str) -> DataFrame:
    return res.select(F.col("key").alias(key), F.round("max_sim", 6).alias("max_sim"), "exact_match",
                      "copy_paste_detected")


def _with_copies(docs: DataFrame, number) -> DataFrame:
    """Beside the rows, a past copy of some today texts, whole or with an addition, so that every outcome occurs."""
    text = F.when(number % 5 == 0, F.concat(F.lit("  "), "text", F.lit(" "))).otherwise(F.concat("text", F.lit(" and so on")))
    copies = docs.where(F.col("is_today") & (number % 5 <= 1))
    return docs.unionByName(copies.select("key", F.lit(-1).cast("long").alias("doc"), F.lit(False).alias("is_today"), text.alias("text")))


def _copies_sql(docs: str, number: str) -> list[tuple[str, str]]:
    return [("base", docs), ("sdocs", f"""SELECT * FROM base UNION ALL SELECT key, -1 AS doc, false AS is_today,
      CASE WHEN {number} % 5 = 0 THEN '  ' || text || ' ' ELSE text || ' and so on' END AS text FROM base WHERE is_today AND {number} % 5 <= 1""")]


def q_copy_paste_similarity(spark, sf):
    conv = SV.read_table(spark, sf, "conversations").select("conv_id", "turn", "text")
    last = conv.groupBy("conv_id").agg(F.max("turn").alias("last_turn"))
    docs = join_small(conv, last, "conv_id").select(F.col("conv_id").alias("key"), F.col("turn").alias("doc"),
                                              (F.col("turn") == F.col("last_turn")).alias("is_today"), "text")
    return _sim_out(copy_paste(_with_copies(docs, F.col("key")), P.copy_paste_threshold), "conv_id")


def sql_copy_paste_similarity():
    docs = ("SELECT conv_id AS key, turn AS doc, turn = max(turn) OVER (PARTITION BY conv_id) AS is_today, text "
            "FROM conversations")
    return O.with_ctes(_copies_sql(docs, "key") + O.similarity_ctes("sdocs", P.copy_paste_threshold),
                       "SELECT key AS conv_id, round(max_sim, 6) AS max_sim, exact_match, copy_paste_detected "
                       "FROM cp_result")


def q_copy_paste_comments(spark, sf):
    ensure_utc(spark)
    # Both today's and past comments come from these rows: their texts are cleaned once, as in the daily run.
    docs = similarity_docs(stage_table(recent_comments(SV.comments(spark, sf), AS_OF, P), "lookback comments"))
    out = _sim_out(copy_paste(docs, P.copy_paste_threshold), "item")
    return out.select("item.org", "item.work_item_id", *out.columns[1:])


def sql_copy_paste_comments():
    ctes = O.standin_ctes(AS_OF) + [("recent", O.recent_sql(AS_OF, P, None))] + O.rollup_ctes()[:1]
    ctes.append(("sdocs", "SELECT org || '/' || CAST(work_item_id AS VARCHAR) AS key, pos AS doc, is_today, text FROM ranked "
                          "WHERE NOT is_today OR rn = 1"))
    return O.with_ctes(ctes + O.similarity_ctes("sdocs", P.copy_paste_threshold),
                       "SELECT split_part(key, '/', 1) AS org, CAST(split_part(key, '/', 2) AS BIGINT) AS work_item_id, "
                       "round(max_sim, 6) AS max_sim, exact_match, copy_paste_detected FROM cp_result")


def q_landed_comments(spark, sf):
    """The newest version of each comment among redelivered, edited, late and future-dated ones."""
    c = current_comments(SV.landed_versions(spark, sf))
    return c.select("org", "work_item_id", F.col("id").alias("comment_id"), "text", "createdDate", "landed_at")


def sql_landed_comments():
    return O.with_ctes(O.standin_ctes(AS_OF), """
      SELECT org, work_item_id, id AS comment_id,
        CASE WHEN version = 2 THEN coalesce(text, '') || ' (edited)' ELSE text END AS text,
        CASE WHEN abs(id) % 7 = 0 THEN '2099-01-01T00:00:00Z' ELSE createdDate END AS createdDate,
        landed_at + to_days(CAST(version AS INTEGER)) AS landed_at
      FROM (SELECT *, CASE WHEN abs(id) % 5 = 0 THEN 2 WHEN abs(id) % 3 = 0 THEN 1 ELSE 0 END AS version FROM sv_comments)""")


def q_document_text_stats(spark, sf):
    docs = SV.read_table(spark, sf, "documents")
    t = docs.select("doc_id", tokens(F.col("text")).alias("toks"), clean_text(F.col("text")).alias("clean"))
    return t.select("doc_id", F.size("toks").cast("int").alias("n_tokens"),
                    F.size(F.array_distinct("toks")).cast("int").alias("n_distinct_tokens"),
                    F.length("clean").cast("int").alias("clean_chars"))


def sql_document_text_stats():
    return (f"SELECT doc_id, CAST(len(toks) AS INTEGER) AS n_tokens, "
            f"CAST(len(list_distinct(toks)) AS INTEGER) AS n_distinct_tokens, "
            f"CAST(length(clean) AS INTEGER) AS clean_chars "
            f"FROM (SELECT doc_id, {O.tokens('text')} AS toks, {O.clean_text('text')} AS clean FROM documents)")


def q_copy_paste_documents(spark, sf):
    """Latest document of each (source, language) against all earlier ones, whole texts."""
    docs = SV.read_table(spark, sf, "documents").select(
        F.concat_ws("/", "source", "lang").alias("key"), F.col("doc_id").alias("doc"), "text")
    last = docs.groupBy("key").agg(F.max("doc").alias("last_doc"))
    d = join_small(docs, last, "key").select("key", "doc", (F.col("doc") == F.col("last_doc")).alias("is_today"), "text")
    return _sim_out(copy_paste(_with_copies(d, F.col("doc")), P.copy_paste_threshold), "source_lang")


def sql_copy_paste_documents():
    docs = ("SELECT source || '/' || lang AS key, doc_id AS doc, "
            "doc_id = max(doc_id) OVER (PARTITION BY source, lang) AS is_today, text FROM documents")
    return O.with_ctes(_copies_sql(docs, "doc") + O.similarity_ctes("sdocs", P.copy_paste_threshold),
                       "SELECT key AS source_lang, round(max_sim, 6) AS max_sim, exact_match, copy_paste_detected "
                       "FROM cp_result")


# ---------------------------------------------------------------------------
# Gate
# ---------------------------------------------------------------------------

def q_latest_compliant(spark, sf):
    ensure_utc(spark)
    return latest_compliant(SV.snapshot_history(spark, sf), P, AS_OF)


def sql_latest_compliant():
    return O.with_ctes(O.standin_ctes(AS_OF), f"""
      SELECT azure_org, work_item_id, snapshot_date AS latest_date, comment_quality_score AS latest_score,
        (eod_compliant AND NOT copy_paste_detected AND comment_quality_score >= {P.good_threshold}) AS is_good
      FROM (SELECT *, row_number() OVER (PARTITION BY azure_org, work_item_id
                                         ORDER BY snapshot_date DESC, snapshot_timestamp DESC) AS rn
            FROM sv_history WHERE eod_compliant AND comment_quality_score IS NOT NULL)
      WHERE rn = 1""")


def _all_tasks(spark, sf):
    w = SV.work_items(spark, sf, AS_OF).where(F.col("work_item_type").isin(list(P.allowed_types)))
    return project_items(w, AS_OF)


def _all_tasks_sql():
    return [("items_all", O.project_items_sql(AS_OF, "sv_work_items", P))]


def q_gate_branch(spark, sf):
    ensure_utc(spark)
    t = assign_branch(_all_tasks(spark, sf), SV.snapshot_history(spark, sf), P, AS_OF)
    return t.select("org", "project", "id", "state_norm", "history_good", "branch")


def sql_gate_branch():
    sn = f"lower({O.py_strip('state')})"
    ctes = O.standin_ctes(AS_OF) + _all_tasks_sql() + [("tasks_g", f"SELECT *, {sn} AS state_norm FROM items_all")]
    ctes += O.gate_ctes(AS_OF, P, "tasks_g")
    return O.with_ctes(ctes, """
      SELECT b.org, b.project, b.id, b.state_norm, coalesce(l.is_good, false) AND b.state_norm = 'active'
               AS history_good, b.branch
      FROM branched b LEFT JOIN latest l ON l.azure_org = b.org AND l.work_item_id = b.id""")


# ---------------------------------------------------------------------------
# Grading
# ---------------------------------------------------------------------------

def q_grader_parse(spark, sf):
    r = SV.grader_responses(spark, sf, AS_OF)
    title = F.concat(F.lit("Task "), F.col("work_item_id").cast("string"))
    g = with_parsed_grade(r, "raw", title, "g", ok_col="parsed_ok")
    return g.select("response_id", "work_item_id", "parsed_ok",
                    *[F.col("g")[f.name].alias(f.name) for f in GRADE_FIELDS.fields])


def _sql_unfence(raw: str) -> str:
    s = O.py_strip(raw)
    inner = f"coalesce(string_split({s}, '```')[2], '')"
    inner = f"(CASE WHEN starts_with({inner}, 'json') THEN substr({inner}, 5) ELSE {inner} END)"
    return f"(CASE WHEN starts_with({s}, '```') THEN {inner} ELSE {s} END)"


def sql_grader_parse():
    from workpulse.operators.grading import FAILED_FOLLOWUP
    eid, etype = "event_id", "event_type"
    score = (f"(CAST(CAST(floor(value) AS BIGINT) % 11 AS VARCHAR) || "
             f"CASE WHEN {eid} % 5 = 0 THEN '.0' WHEN {eid} % 11 = 0 THEN '.5' ELSE '' END)")
    body = (f"'{{\"quality_score\": ' || {score} || ', \"quality_label\": \"' || "
            f"(CASE WHEN CAST(floor(value) AS BIGINT) % 11 >= 7 THEN 'good' ELSE 'vague' END) || "
            f"'\", \"blocker_detected\": ' || (CASE WHEN {etype} = 'error' THEN 'true' ELSE 'false' END) || "
            f"', \"progress_detectable\": ' || (CASE WHEN {etype} = 'purchase' THEN 'true' ELSE 'false' END) || "
            f"', \"sentiment\": ' || (CASE WHEN {eid} % 7 = 0 THEN 'null' WHEN {etype} = 'error' THEN '\"negative\"' "
            f"ELSE '\"positive\"' END) || ', \"suggested_followup\": \"What changed in ' || {etype} || '?\"}}'")
    raw = (f"CASE WHEN {eid} % 6 = 0 THEN '```json' || chr(10) || {body} || chr(10) || '```' "
           f"WHEN {eid} % 6 = 1 THEN '  ```' || chr(10) || {body} || chr(10) || '```  ' "
           f"WHEN {eid} % 6 = 2 THEN {body} "
           f"WHEN {eid} % 6 = 3 THEN 'Sorry, I cannot grade this: ' || props "
           f"WHEN {eid} % 6 = 4 THEN NULL "
           f"ELSE '{{\"quality_score\": ' || {score} || '}}' END")
    b = "b"
    tb = O.py_strip(b)
    jt = lambda path: f"json_type(CASE WHEN json_valid({b}) THEN {b} END, '$.{path}')"
    ok = (f"coalesce(starts_with({tb}, '{{') AND ends_with({tb}, '}}') AND json_valid({b}) "
          f"AND {jt('quality_score')} IN ('BIGINT', 'UBIGINT', 'DOUBLE') "
          f"AND TRY_CAST(json_extract_string(CASE WHEN json_valid({b}) THEN {b} END, '$.quality_score') AS DOUBLE) % 1 = 0 AND {jt('quality_label')} = 'VARCHAR' "
          f"AND {jt('blocker_detected')} = 'BOOLEAN' AND {jt('progress_detectable')} = 'BOOLEAN' "
          f"AND {jt('sentiment')} IN ('VARCHAR', 'NULL') AND {jt('suggested_followup')} = 'VARCHAR', false)")
    pre, post = FAILED_FOLLOWUP.split("%s")
    title = "'Task ' || CAST(work_item_id AS VARCHAR)"
    ex = lambda path: f"json_extract_string(CASE WHEN ok THEN {b} END, '$.{path}')"
    return f"""
      SELECT response_id, work_item_id, ok AS parsed_ok,
        CASE WHEN ok THEN CAST(CAST({ex('quality_score')} AS DOUBLE) AS INTEGER) ELSE 0 END AS quality_score,
        CASE WHEN ok THEN {ex('quality_label')} ELSE 'vague' END AS quality_label,
        CASE WHEN ok THEN CAST({ex('blocker_detected')} AS BOOLEAN) ELSE false END AS blocker_detected,
        CASE WHEN ok THEN CAST({ex('progress_detectable')} AS BOOLEAN) ELSE false END AS progress_detectable,
        CASE WHEN ok THEN {ex('sentiment')} ELSE 'neutral' END AS sentiment,
        CASE WHEN ok THEN {ex('suggested_followup')} ELSE {O.q(pre)} || {title} || {O.q(post)} END
          AS suggested_followup
      FROM (SELECT *, {ok} AS ok FROM (SELECT *, {_sql_unfence('raw')} AS b
            FROM (SELECT event_id AS response_id, user_id AS work_item_id, {raw} AS raw FROM events)))"""


def q_rubric_grade(spark, sf):
    conv = SV.read_table(spark, sf, "conversations")
    title = F.concat(F.lit("Conversation "), F.col("conv_id").cast("string"))
    g = with_rubric(conv, "text", title, "g")
    return g.select("conv_id", "turn", *[F.col("g")[f.name].alias(f.name) for f in GRADE_FIELDS.fields])


def sql_rubric_grade():
    g = O.rubric_sql("text", "'Conversation ' || CAST(conv_id AS VARCHAR)")
    cols = ", ".join(f"{v} AS {k}" for k, v in g.items())
    return f"SELECT conv_id, turn, {cols} FROM conversations"


# ---------------------------------------------------------------------------
# Risk, attention, nudges on all tasks with the analysis stand-in
# ---------------------------------------------------------------------------

def _scored(spark, sf):
    ensure_utc(spark)
    t = _all_tasks(spark, sf)
    sprint = current_sprint(SV.iterations(spark, sf, AS_OF), AS_OF)
    t = join_small(t, sprint.select("org", "project", "days_remaining", "dates_configured"), ["org", "project"])
    return flag_attention(score_risk(SV.analysis(t), P), P)


def _scored_sql():
    has, cp, q = "(id % 4 <> 0)", "(id % 13 = 0)", "CAST(id % 11 AS INTEGER)"
    analysis = f"""
      SELECT i.*, s.days_remaining, s.dates_configured, {has} AS has_comment_today, {q} AS quality_score,
        CASE WHEN NOT {has} THEN 'missing' WHEN {cp} THEN 'copy-pasted' WHEN {q} >= 7 THEN 'good' ELSE 'vague' END
          AS quality_label,
        {cp} AS copy_paste_detected, (id % 17 = 0) AS blocker_detected,
        'What is left on ' || i.title || '?' AS suggested_followup,
        lower({O.py_strip('i.state')}) AS state_norm
      FROM items_all i JOIN sprint s ON s.org = i.org AND s.project = i.project"""
    r = O.risk_sql(P)
    scored = f"SELECT *, {r['hours_stale']} AS hours_stale, {r['risk_score']} AS risk_score, " \
             f"{r['risk_label']} AS risk_label FROM sc_analysis"
    a = O.attention_sql(P)
    flagged = f"SELECT *, {a['quality_gate_triggered']} AS quality_gate_triggered, " \
              f"{a['needs_attention']} AS needs_attention FROM sc_scored"
    return (O.standin_ctes(AS_OF) + O.sprint_ctes(AS_OF) + _all_tasks_sql()
            + [("sc_analysis", analysis), ("sc_scored", scored), ("sc_flagged", flagged)])


def q_risk_scores(spark, sf):
    return _scored(spark, sf).select("org", "project", "id", "days_since_state_change", "days_since_last_update",
                                     "days_remaining", "dates_configured", "hours_stale", "risk_score", "risk_label")


def sql_risk_scores():
    return O.with_ctes(_scored_sql(), """
      SELECT org, project, id, days_since_state_change, days_since_last_update, days_remaining, dates_configured,
        hours_stale, risk_score, risk_label FROM sc_flagged""")


def q_attention_flags(spark, sf):
    return _scored(spark, sf).select("org", "project", "id", "risk_score", "quality_gate_triggered",
                                     "needs_attention")


def sql_attention_flags():
    return O.with_ctes(_scored_sql(), "SELECT org, project, id, risk_score, quality_gate_triggered, needs_attention "
                                      "FROM sc_flagged")


def q_nudge_issues(spark, sf):
    n = write_nudges(_scored(spark, sf), AS_OF).where("needs_attention")
    return n.select("org", "project", "id", "first_name", "issues", F.col("nudge.tone").alias("nudge_tone"),
                    F.col("nudge.message").alias("nudge_message"), "nudge_request")


def sql_nudge_issues():
    from workpulse.operators.nudge import REQUEST_LINES
    n = O.nudge_sql()
    vals = ("first_name", "title", "state", "coalesce(CAST(remaining_hours AS VARCHAR), 'not set')",
            "CAST(days_remaining AS VARCHAR)", "issues", "'1'", "coalesce(suggested_followup, '')")
    req = " || chr(10) || ".join(f"{O.q(h)} || {v}" for h, v in zip(REQUEST_LINES, vals))
    return O.with_ctes(_scored_sql(), f"""
      SELECT org, project, id, first_name, issues, 'gentle' AS nudge_tone,
        {n['message']('first_name', 'title', 'issues')} AS nudge_message, {req} AS nudge_request
      FROM (SELECT *, {n['first_name']} AS first_name, {n['issues']} AS issues FROM sc_flagged)
      WHERE needs_attention""")


# ---------------------------------------------------------------------------
# The daily run and what derives from it
# ---------------------------------------------------------------------------

def q_snapshot_rows(spark, sf):
    return _run(spark, sf).snapshot


def sql_snapshot_rows():
    return _sql_pipeline(f"SELECT {O.snapshot_select(AS_OF)} FROM final")


def q_snapshot_upsert(spark, sf):
    """Write day D-1, then day D twice (rerun), into one table; read the whole table back."""
    ensure_utc(spark)
    path = f"{checkpoint_dir(spark).rstrip('/')}/snapshot-upsert-{uuid.uuid4().hex}"
    inp = SV.tracker_inputs(spark, sf, AS_OF)
    landed = replace(inp, history=stage_table(inp.history, "history")), find_scope(inp, AS_OF, P)
    for as_of in (PREV_AS_OF, AS_OF, AS_OF):
        upsert(spark, path, _run(spark, sf, as_of, landed).snapshot, staged=True)
    return read_snapshot(spark, path)


def sql_snapshot_upsert():
    parts = []
    for as_of in (PREV_AS_OF, AS_OF):
        parts.append("SELECT * FROM (" + O.with_ctes(O.pipeline_ctes(as_of, P),
                                                     f"SELECT {O.snapshot_select(as_of)} FROM final") + ")")
    return "\nUNION ALL\n".join(parts)


LOOP_DAYS = ("2024-01-28 18:00:00", PREV_AS_OF, AS_OF, AS_OF)


def q_snapshot_history_loop(spark, sf):
    """Three days and a rerun of the last one; each run's gate reads the table that the earlier runs wrote."""
    ensure_utc(spark)
    base = f"{checkpoint_dir(spark).rstrip('/')}/snapshot-loop-{uuid.uuid4().hex}"
    inp = SV.tracker_inputs(spark, sf, AS_OF)
    init_table(spark, f"{base}/table")
    built: dict = {}  # a rerun analyses the tasks and comments of its day again, by the history that it finds
    with compiled_methods(spark):
        scope = find_scope(inp, AS_OF, P)
        for as_of in LOOP_DAYS:
            history = incremental_history(spark, f"{base}/table", f"{base}/state", as_of)
            run = run_daily(replace(inp, history=history), as_of, P, built=built.get(as_of), scope=scope)
            built[as_of] = run.built
            upsert(spark, f"{base}/table", run.snapshot, staged=True)
    return read_snapshot(spark, f"{base}/table")


def sql_snapshot_history_loop():
    seen = """SELECT azure_org, work_item_id, snapshot_date, comment_quality_score, eod_compliant, copy_paste_detected,
              snapshot_timestamp FROM ({rows})"""
    empty = ("SELECT NULL::VARCHAR AS azure_org, NULL::BIGINT AS work_item_id, NULL::DATE AS snapshot_date, "
             "NULL::INTEGER AS comment_quality_score, NULL::BOOLEAN AS eod_compliant, NULL::BOOLEAN AS copy_paste_detected, "
             "NULL::TIMESTAMP AS snapshot_timestamp WHERE false")
    days, before = [], []
    for i, as_of in enumerate(LOOP_DAYS):
        ctes = [(n, (seen.format(rows=" UNION ALL ".join(f"SELECT * FROM {d}" for d in before)) if before else empty)
                 if n == "sv_history" else sql) for n, sql in O.pipeline_ctes(as_of, P)]
        days.append((f"day{i}", O.with_ctes(ctes, f"SELECT {O.snapshot_select(as_of)} FROM final")))
        before.append(f"day{i}")
    # The rerun replaces the last day's rows.
    return O.with_ctes(days, "SELECT * FROM day0 UNION ALL SELECT * FROM day1 UNION ALL SELECT * FROM day3")


def q_section_sizes(spark, sf):
    return section_sizes(_run(spark, sf).cards)


def sql_section_sizes():
    return _sql_pipeline("""
      SELECT org, project, count(*) FILTER (WHERE needs_attention) AS flagged_count,
        count(*) FILTER (WHERE NOT needs_attention) AS healthy_count FROM final GROUP BY org, project""")


def q_task_order(spark, sf):
    # The list shows four columns: only these are dealt into ranges, not the whole task rows.
    shown = _run(spark, sf).tasks.select("org", "project", "id", "risk_score")
    return ordered_tasks(shown).select("org", "project", F.col("id").alias("work_item_id"), "risk_score", "position")


def sql_task_order():
    return _sql_pipeline("""
      SELECT org, project, id AS work_item_id, risk_score,
        row_number() OVER (PARTITION BY org, project ORDER BY risk_score DESC, id) AS position FROM final""")


def q_run_summary(spark, sf):
    return _run(spark, sf).summary


def sql_run_summary():
    c = lambda cond: f"CAST(count(*) FILTER (WHERE {cond}) AS BIGINT)"
    return _sql_pipeline(f"""
      SELECT org, project, total_tasks, flagged_tasks, total_tasks - flagged_tasks AS healthy_tasks,
        tasks_missing_comment, tasks_with_blockers, tasks_at_risk_or_critical, tasks_skipped_state,
        tasks_skipped_good_history, total_tasks - tasks_skipped_state - tasks_skipped_good_history AS tasks_analysed
      FROM (SELECT org, project, CAST(count(*) AS BIGINT) AS total_tasks, {c('needs_attention')} AS flagged_tasks,
              {c("branch = 'analysed' AND NOT has_comment_today")} AS tasks_missing_comment,
              {c("branch = 'analysed' AND blocker_detected")} AS tasks_with_blockers,
              {c("branch = 'analysed' AND risk_label IN ('At Risk', 'Critical')")} AS tasks_at_risk_or_critical,
              {c("branch = 'skipped_state'")} AS tasks_skipped_state,
              {c("branch = 'skipped_history'")} AS tasks_skipped_good_history
            FROM final GROUP BY org, project)""")


def _disp_sql(p: Params = P) -> str:
    from workpulse.operators.routing import REASON_COPIED, REASON_LOW, REASON_NO_COMMENT
    active = ", ".join(O.q(s) for s in p.active_states)
    email = O.py_strip("coalesce(assignee_email, '')")
    good = f"(has_comment_today AND NOT copy_paste_detected AND quality_score >= {p.good_threshold})"
    cp, cs = REASON_COPIED.split("%s")
    l1, l2, l3 = REASON_LOW.split("%s")
    qs = "CAST(quality_score AS VARCHAR)"
    return f"""
      SELECT *, CASE WHEN state_norm NOT IN ({active}) THEN 'skipped_state'
                     WHEN state_norm = {O.q(p.gate)} AND {good} THEN 'skipped_good_quality'
                     WHEN email_to = '' THEN 'skipped_no_email'
                     WHEN lower(email_to) IN (SELECT lower({O.py_strip('email')}) FROM sv_recipients)
                       THEN 'already_recipient'
                     ELSE 'sent' END AS disposition,
        CASE WHEN state_norm <> {O.q(p.gate)} THEN NULL
             WHEN NOT has_comment_today THEN {O.q(REASON_NO_COMMENT)}
             WHEN copy_paste_detected THEN {O.q(cp)} || {qs} || {O.q(cs)}
             WHEN quality_score < {p.good_threshold} THEN {O.q(l1)} || {qs} || {O.q(l2)} || '{p.good_threshold}' || {O.q(l3)}
        END AS send_reason
      FROM (SELECT *, {email} AS email_to FROM final WHERE needs_attention)"""


def _sql_routing(final: str) -> str:
    ctes = O.pipeline_ctes(AS_OF, P) + [_rec_cte(), ("disp", _disp_sql())]
    return O.with_ctes(ctes, final)


def q_reminder_dispositions(spark, sf):
    return _run(spark, sf).disposition_counts


def sql_reminder_dispositions():
    return _sql_routing("SELECT org, project, disposition, CAST(count(*) AS BIGINT) AS n FROM disp "
                        "GROUP BY org, project, disposition")


def q_reminder_outbox(spark, sf):
    r = _run(spark, sf).reminders
    return r.select("org", "project", "work_item_id", F.col("recipients")[0].alias("recipient"), "subject", "body",
                    "first_name", "send_reason")


def sql_reminder_outbox():
    from workpulse.operators.routing import (REMINDER_COPIED, REMINDER_FOOTER, REMINDER_GREETING, REMINDER_LOW,
                                             REMINDER_NO_COMMENT, REMINDER_NUDGE, REMINDER_SUBJECT)
    fill = lambda fmt, *vals: " || ".join(
        [O.q(part) + (f" || {vals[i]}" if i < len(vals) else "") for i, part in enumerate(fmt.split("%s"))])
    today = f"strftime({O.ts_lit(AS_OF)}, '%d %b %Y')"
    qs = "CAST(quality_score AS VARCHAR)"
    issue = (f"CASE WHEN NOT has_comment_today THEN {O.q(REMINDER_NO_COMMENT)} "
             f"WHEN copy_paste_detected THEN {fill(REMINDER_COPIED, qs)} "
             f"WHEN quality_score < {P.good_threshold} THEN {fill(REMINDER_LOW, qs)} ELSE '' END")
    nudge = f"CASE WHEN nudge_message IS NOT NULL OR needs_attention THEN {fill(REMINDER_NUDGE, 'nudge_message')} ELSE '' END"
    head = fill(REMINDER_GREETING, "assignee_name", "CAST(id AS VARCHAR)", "title", "risk_label",
                "CAST(risk_score AS VARCHAR)")
    first = O.first_token("assignee_name")
    return _sql_routing(f"""
      SELECT org, project, id AS work_item_id, email_to AS recipient,
        {fill(REMINDER_SUBJECT, 'CAST(id AS VARCHAR)', 'title', 'sprint_name', today)} AS subject,
        {head} || ({issue}) || ({nudge}) || {O.q(REMINDER_FOOTER)} AS body,
        CASE WHEN {first} = '' OR coalesce(assignee_name, '') = 'Unassigned' THEN 'there' ELSE {first} END
          AS first_name,
        send_reason
      FROM disp WHERE disposition = 'sent'""")


def q_report_outbox(spark, sf):
    return _run(spark, sf).report.select("org", "project", "batch", F.array_join("recipients", ",").alias("recipients"), "subject",
                                         "body", "fetched_at_display")


def sql_report_outbox():
    from workpulse.operators.routing import REPORT_BODY, REPORT_SUBJECT
    today = f"strftime({O.ts_lit(AS_OF)}, '%d %b %Y')"
    parts = REPORT_BODY.split("%s")
    vals = ["sprint_name", today, "CAST(total AS VARCHAR)", "CAST(flagged AS VARCHAR)",
            "CAST(total - flagged AS VARCHAR)"]
    body = " || ".join(O.q(pt) + (f" || {vals[i]}" if i < len(vals) else "") for i, pt in enumerate(parts))
    sp = REPORT_SUBJECT.split("%s")
    batches = f"""SELECT batch, string_agg(email, ',' ORDER BY email) AS recipients
      FROM (SELECT email, (row_number() OVER (ORDER BY email) - 1) // {P.report_batch} AS batch FROM (SELECT DISTINCT email FROM sv_recipients)) GROUP BY batch"""
    return O.with_ctes(O.pipeline_ctes(AS_OF, P) + [_rec_cte(), ("sv_batches", batches)], f"""
      SELECT org, project, batch, recipients,
        {O.q(sp[0])} || sprint_name || {O.q(sp[1])} || {today} || {O.q(sp[2])} AS subject,
        {body} AS body, strftime({O.ts_lit(AS_OF)}, '%d %b %Y, %I:%M %p UTC') AS fetched_at_display
      FROM (SELECT org, project, any_value(sprint_name) AS sprint_name, count(*) AS total,
                   count(*) FILTER (WHERE needs_attention) AS flagged
            FROM final GROUP BY org, project) CROSS JOIN sv_batches""")


def q_report_cards(spark, sf):
    c = _run(spark, sf).cards
    return c.select("org", "project", "work_item_id", "section", "card_title", "meta", "badge_label", "badge_score",
                    F.array_join("pills", "|").alias("pills"), "comment", "nudge_tone", "nudge_message",
                    "sprint_end_display", "fetched_at_display")


def sql_report_cards():
    from workpulse.operators.routing import (NO_COMMENT_PLACEHOLDER, PILL_BLOCKER, PILL_COPIED, PILL_HOURS,
                                             PILL_NO_COMMENT, PILL_QUALITY, PILL_STATE)
    s1, s2 = PILL_STATE.split("%s")
    q1, q2, q3 = PILL_QUALITY.split("%s")
    pills = (f"concat_ws('|', CASE WHEN NOT eod_compliant THEN {O.q(PILL_NO_COMMENT)} END, "
             f"CASE WHEN copy_paste_detected THEN {O.q(PILL_COPIED)} END, "
             f"CASE WHEN blocker_detected THEN {O.q(PILL_BLOCKER)} END, "
             f"CASE WHEN hours_stale THEN {O.q(PILL_HOURS)} END, "
             f"{O.q(s1)} || CAST(CASE WHEN branch = 'analysed' THEN days_since_state_change ELSE 0 END AS VARCHAR) "
             f"|| {O.q(s2)}, {O.q(q1)} || CAST(quality_score AS VARCHAR) || {O.q(q2)} || quality_label || {O.q(q3)})")
    hours = "CASE WHEN remaining_hours IS NOT NULL THEN CAST(remaining_hours AS VARCHAR) || 'h remaining' END"
    meta = (f"concat_ws(' · ', assignee_name, CASE WHEN needs_attention THEN 'State: ' || state ELSE state END, "
            f"{hours})")
    return _sql_pipeline(f"""
      SELECT org, project, id AS work_item_id, CASE WHEN needs_attention THEN 'flagged' ELSE 'healthy' END AS section,
        '#' || CAST(id AS VARCHAR) || CASE WHEN needs_attention THEN ' : ' ELSE ' — ' END || title AS card_title,
        {meta} AS meta, risk_label AS badge_label, risk_score AS badge_score,
        CASE WHEN needs_attention THEN {pills} ELSE '' END AS pills,
        CASE WHEN needs_attention THEN coalesce(nullif(today_comment_text, ''), {O.q(NO_COMMENT_PLACEHOLDER)})
             ELSE nullif(today_comment_text, '') END AS comment,
        nudge_tone, nudge_message,
        coalesce(substr(nullif(finish_date, ''), 1, 10), 'unknown') AS sprint_end_display,
        strftime({O.ts_lit(AS_OF)}, '%d %b %Y, %I:%M %p UTC') AS fetched_at_display
      FROM final""")


def q_stage_counts(spark, sf):
    return _run(spark, sf).stage_counts


def sql_stage_counts():
    ctes = O.standin_ctes(AS_OF) + O.sprint_ctes(AS_OF) + O.discovery_ctes(AS_OF, P)
    return O.with_ctes(ctes, """
      SELECT coalesce(a.org, b.org, c.org) AS org, coalesce(a.project, b.project, c.project) AS project,
        CAST(coalesce(a.n, 0) AS BIGINT) AS parent_count, CAST(coalesce(b.n, 0) AS BIGINT) AS child_count,
        CAST(coalesce(c.n, 0) AS BIGINT) AS task_count
      FROM (SELECT org, project, count(*) AS n FROM parents GROUP BY ALL) a
      FULL OUTER JOIN (SELECT org, project, count(*) AS n FROM children GROUP BY ALL) b
        ON a.org = b.org AND a.project = b.project
      FULL OUTER JOIN (SELECT org, project, count(*) AS n FROM items GROUP BY ALL) c
        ON coalesce(a.org, b.org) = c.org AND coalesce(a.project, b.project) = c.project""")


def q_grading_requests(spark, sf):
    return _run(spark, sf).grading_requests


def sql_grading_requests():
    from workpulse.operators.grading import REQUEST_LINES
    vals = ("title", "assignee_name", "today_comment_text")
    req = " || chr(10) || ".join(f"{O.q(h)} || coalesce({v}, '')" for h, v in zip(REQUEST_LINES, vals))
    return _sql_pipeline(f"""
      SELECT org, project, id AS work_item_id, {O.ts_lit(AS_OF)} AS as_of, {req} AS request
      FROM final WHERE branch = 'analysed' AND NOT {O.is_blank('today_comment_text')}""")


def q_nudge_requests(spark, sf):
    return _run(spark, sf).nudge_requests


def sql_nudge_requests():
    from workpulse.operators.nudge import REQUEST_LINES
    vals = ("first_name", "title", "state", "coalesce(CAST(remaining_hours AS VARCHAR), 'not set')",
            "CAST(days_remaining AS VARCHAR)", "issues", "'1'", "coalesce(suggested_followup, '')")
    req = " || chr(10) || ".join(f"{O.q(h)} || {v}" for h, v in zip(REQUEST_LINES, vals))
    return _sql_pipeline(f"SELECT org, project, id AS work_item_id, {req} AS request FROM final WHERE needs_attention")


def _prepared(fn):
    """Every registered query runs with the UTC / measured-broadcast session policy (``ensure_utc``)."""
    def run(spark, sf):
        ensure_utc(spark)
        return fn(spark, sf)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


QUERIES = {
    "sprint_calendar": (q_sprint_calendar, sql_sprint_calendar),
    "sprint_children": (q_sprint_children, sql_sprint_children),
    "in_scope_tasks": (q_in_scope_tasks, sql_in_scope_tasks),
    "day_arithmetic": (q_day_arithmetic, sql_day_arithmetic),
    "html_text": (q_html_text, sql_html_text),
    "image_urls": (q_image_urls, sql_image_urls),
    "comment_rollup": (q_comment_rollup, sql_comment_rollup),
    "landed_comments": (q_landed_comments, sql_landed_comments),
    "copy_paste_similarity": (q_copy_paste_similarity, sql_copy_paste_similarity),
    "copy_paste_comments": (q_copy_paste_comments, sql_copy_paste_comments),
    "copy_paste_documents": (q_copy_paste_documents, sql_copy_paste_documents),
    "document_text_stats": (q_document_text_stats, sql_document_text_stats),
    "latest_compliant": (q_latest_compliant, sql_latest_compliant),
    "gate_branch": (q_gate_branch, sql_gate_branch),
    "grader_parse": (q_grader_parse, sql_grader_parse),
    "rubric_grade": (q_rubric_grade, sql_rubric_grade),
    "risk_scores": (q_risk_scores, sql_risk_scores),
    "attention_flags": (q_attention_flags, sql_attention_flags),
    "nudge_issues": (q_nudge_issues, sql_nudge_issues),
    "snapshot_rows": (q_snapshot_rows, sql_snapshot_rows),
    "snapshot_upsert": (q_snapshot_upsert, sql_snapshot_upsert),
    "snapshot_history_loop": (q_snapshot_history_loop, sql_snapshot_history_loop),
    "section_sizes": (q_section_sizes, sql_section_sizes),
    "task_order": (q_task_order, sql_task_order),
    "run_summary": (q_run_summary, sql_run_summary),
    "reminder_dispositions": (q_reminder_dispositions, sql_reminder_dispositions),
    "reminder_outbox": (q_reminder_outbox, sql_reminder_outbox),
    "report_outbox": (q_report_outbox, sql_report_outbox),
    "report_cards": (q_report_cards, sql_report_cards),
    "stage_counts": (q_stage_counts, sql_stage_counts),
    "grading_requests": (q_grading_requests, sql_grading_requests),
    "nudge_requests": (q_nudge_requests, sql_nudge_requests),
    **LOOPS,
}
QUERIES = {name: (_prepared(fn), sql) for name, (fn, sql) in QUERIES.items()}
