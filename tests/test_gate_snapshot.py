"""Multi-day simulation: the gate reads the snapshot table's own history (T3-T5), upsert idempotency (S8),
NOT NULL enforcement (S11), history scan pruning (S6)."""

import pytest
from pyspark.sql import functions as F

from workpulse import schemas as SC
from workpulse.operators.routing import recipient_batches, report_outbox
from workpulse.params import HIERARCHY_FORWARD, Params
from workpulse.plans.daily import run_daily
from workpulse.sources.snapshot_store import read_history, read_snapshot, upsert
from workpulse.sources.standins import TrackerInputs

GOOD_COMMENT = ("<div>Finished the invoice export and merged it with 12 tests for rounding and empty months. Remaining work is "
                "the archive step, about 3 hours, and the only risk is the old date format of one customer.</div>")
D1, D2, D3 = "2024-01-28 18:00:00", "2024-01-29 18:00:00", "2024-01-30 18:00:00"


def tiny_inputs(spark, history=None):
    it = spark.createDataFrame([("o", "p", 0, "S1", "P\\S1", "2024-01-20T00:00:00Z", "2024-02-05T00:00:00Z")],
                               SC.ITERATIONS)
    st = spark.createDataFrame([("o", "p", 1, "User Story", "Active", "P\\S1")], SC.STORIES)
    ln = spark.createDataFrame([("o", 1, 10, HIERARCHY_FORWARD), ("o", 1, 11, HIERARCHY_FORWARD), ("o", 1, 12, HIERARCHY_FORWARD),
                                ("o", 1, None, None)], SC.LINKS)
    who = '{"displayName": "Ann Lee", "uniqueName": "ann@x.io"}'
    wi = spark.createDataFrame([
        ("o", "p", 10, "Task A", "Task", "Active", "P\\S1", who, 5.0, 8.0, "2024-01-27T10:00:00Z",
         "2024-01-28T10:00:00Z"),
        ("o", "p", 11, "Task B", "Task", "Resolved", "P\\S1", "Bo", None, 3.0, "2024-01-20T10:00:00Z",
         "2024-01-20T10:00:00Z"),
        ("o", "p", 12, "Task C", "Task", "Closed", "P\\S1", None, 1.0, 1.0, "", ""),
    ], SC.WORK_ITEMS)
    cm = spark.createDataFrame([
        ("o", 10, 0, 100, GOOD_COMMENT, ("Ann Lee", "ann@x.io"), "2024-01-28T09:00:00Z", None),
        ("o", 11, 0, 101, "<p>done</p>", ("Bo", "bo@x.io"), "2024-01-28T09:00:00Z", None),
        ("o", 11, 1, 102, "<p>done</p>", ("Bo", "bo@x.io"), "2024-01-29T09:00:00Z", None),
    ], SC.COMMENTS)
    return TrackerInputs(iterations=it, stories=st, links=ln, work_items=wi, comments=cm, history=history)


def run_day(spark, path, as_of, p):
    hist = read_history(spark, path)
    run = run_daily(tiny_inputs(spark, hist), as_of, p)
    upsert(spark, path, run.snapshot)
    return {r.id: r for r in run.tasks.collect()}


def test_gate_is_absorbing_under_latest_policy(spark, tmp_table):
    p = Params()
    d1 = run_day(spark, tmp_table, D1, p)
    assert d1[10].branch == "analysed" and d1[10].quality_score >= 7 and d1[10].eod_compliant
    assert d1[12].branch == "skipped_state"
    d2 = run_day(spark, tmp_table, D2, p)
    assert d2[10].branch == "skipped_history" and not d2[10].eod_compliant and d2[10].quality_label == "skipped"
    d3 = run_day(spark, tmp_table, D3, p)
    assert d3[10].branch == "skipped_history"          # the D1 row stays "latest compliant" (T4)
    snap = read_snapshot(spark, tmp_table)
    assert snap.count() == 9 and snap.select("snapshot_date").distinct().count() == 3


def test_yesterday_policy_expires(spark, tmp_table):
    p = Params(gate_policy="yesterday")
    run_day(spark, tmp_table, D1, p)
    assert run_day(spark, tmp_table, D2, p)[10].branch == "skipped_history"
    assert run_day(spark, tmp_table, D3, p)[10].branch == "analysed"


def test_rerun_same_day(spark, tmp_path):
    # Parity default: the rerun reads today's own good row and suppresses itself (T5).
    a = str(tmp_path / "a")
    assert run_day(spark, a, D1, Params())[10].branch == "analysed"
    assert run_day(spark, a, D1, Params())[10].branch == "skipped_history"
    # Option: history strictly before as_of's date -> reruns are idempotent.
    b = str(tmp_path / "b")
    p = Params(history_before_as_of=True)
    run_day(spark, b, D1, p)
    first = sorted(map(tuple, read_snapshot(spark, b).drop("snapshot_timestamp").collect()))
    run_day(spark, b, D1, p)
    assert sorted(map(tuple, read_snapshot(spark, b).drop("snapshot_timestamp").collect())) == first


def test_copy_detected_when_repeated(spark, tmp_table):
    t = run_day(spark, tmp_table, D2, Params())
    assert t[11].copy_paste_detected and t[11].quality_label == "copy-pasted"


def test_upsert_twice_equals_once_and_keeps_other_dates(spark, tmp_table):
    run = run_daily(tiny_inputs(spark), D1, Params())
    rows = run.snapshot
    upsert(spark, tmp_table, rows)
    once = sorted(map(tuple, read_snapshot(spark, tmp_table).collect()))
    upsert(spark, tmp_table, rows)
    assert sorted(map(tuple, read_snapshot(spark, tmp_table).collect())) == once
    later = run_daily(tiny_inputs(spark), D2, Params()).snapshot.where("work_item_id = 10")
    upsert(spark, tmp_table, later)
    snap = read_snapshot(spark, tmp_table)
    assert snap.count() == len(once) + 1
    assert [f.dataType for f in snap.schema.fields] == [f.dataType for f in SC.SNAPSHOT.fields]


def test_not_null_enforced(spark, tmp_table):
    rows = run_daily(tiny_inputs(spark), D1, Params()).snapshot.withColumn("task_title", F.lit(None).cast("string"))
    with pytest.raises(Exception):
        upsert(spark, tmp_table, rows)


def test_empty_run_writes_nothing(spark, tmp_table):
    rows = run_daily(tiny_inputs(spark), D1, Params()).snapshot.where("false")
    assert upsert(spark, tmp_table, rows) == 0


def test_history_scan_is_pruned_and_pushed(spark, tmp_table):
    upsert(spark, tmp_table, run_daily(tiny_inputs(spark), D1, Params()).snapshot)
    from workpulse.operators.gate import latest_compliant
    df = latest_compliant(read_history(spark, tmp_table), Params(), D3)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(eod_compliant), EqualTo(eod_compliant,true)" in plan
    scan = [line for line in plan.splitlines() if "ReadSchema" in line][0]
    assert "task_title" not in scan and "nudge_message" not in scan
    assert "SortMergeJoin" not in plan


def test_replies_drive_grades_and_nudges(spark):
    from datetime import datetime
    ts = datetime(2024, 1, 28, 18, 0, 0)
    reply = ('```json\n{"quality_score": 9, "quality_label": "excellent", "blocker_detected": true, '
             '"progress_detectable": true, "sentiment": "positive", "suggested_followup": "Q?"}\n```')
    grades = spark.createDataFrame([("o", 10, ts, "grade", reply), ("o", 11, ts, "grade", "junk"), ("other", 10, ts, "grade", "junk")], SC.RESPONSES)
    nudges = spark.createDataFrame([("o", 10, ts, "nudge", '{"message": "Please add detail.", "tone": "direct"}')],
                                   SC.RESPONSES)
    run = run_daily(tiny_inputs(spark), D1, Params(), grader_responses=grades, nudge_responses=nudges)
    t = {r.id: r for r in run.tasks.collect()}
    assert (t[10].quality_score, t[10].quality_label, t[10].blocker_detected) == (9, "excellent", True)
    # Fallback grade; the future-dated identical comment counts as a past one -> label overridden.
    assert (t[11].quality_score, t[11].quality_label) == (0, "copy-pasted")
    assert t[10].needs_attention and t[10].nudge.message == "Please add detail." and t[10].nudge.tone == "direct"
    assert t[11].nudge.tone == "gentle" and t[11].nudge.message.startswith("Hi Bo, a quick note on Task B: ")
    req = {r.work_item_id: r.request for r in run.grading_requests.collect()}
    assert set(req) == {10, 11} and req[11] == "Task title: Task B\nDeveloper: Bo\nEOD comment: done"


def test_incremental_history_matches_full_scan(spark, tmp_path):
    from workpulse.sources.snapshot_store import incremental_history
    full, inc, state = str(tmp_path / "full"), str(tmp_path / "inc"), str(tmp_path / "state")
    p = Params()
    days = [D1, D2, D3, D3]
    for as_of in days:
        a = run_daily(tiny_inputs(spark, read_history(spark, full)), as_of, p)
        b = run_daily(tiny_inputs(spark, incremental_history(spark, inc, state, as_of)), as_of, p)
        ra = {r.id: (r.branch, r.quality_score, r.eod_compliant) for r in a.tasks.collect()}
        rb = {r.id: (r.branch, r.quality_score, r.eod_compliant) for r in b.tasks.collect()}
        assert ra == rb, as_of
        upsert(spark, full, a.snapshot)
        upsert(spark, inc, b.snapshot)
    import os
    assert sorted(os.listdir(state)) == ["before=2024-01-28", "before=2024-01-29", "before=2024-01-30"]


def test_partial_and_stale_states_are_not_used(spark, tmp_path):
    import os
    import time
    from workpulse.sources.snapshot_store import incremental_history
    table, state = str(tmp_path / "t"), str(tmp_path / "s")
    rows = run_daily(tiny_inputs(spark), D1, Params()).snapshot
    upsert(spark, table, rows)
    rank = lambda h: sorted((r.work_item_id, str(r.snapshot_date)) for r in h.collect())
    want = rank(incremental_history(spark, table, state, D2))
    assert len(want) == 2
    folder = f"{state}/before={D2[:10]}"
    # A job that died: one row, no commit marker.
    for f in os.listdir(folder):
        os.remove(os.path.join(folder, f))
    spark.read.schema("work_item_id int").parquet(folder).limit(0).write.mode("overwrite").parquet(folder)
    os.remove(os.path.join(folder, "_SUCCESS"))
    assert rank(incremental_history(spark, table, state, D2)) == want
    # A late upsert of an earlier day: the state is older than that partition.
    time.sleep(1.1)
    late = rows.where("work_item_id = 10").withColumn("work_item_id", F.lit(77))
    upsert(spark, table, late)
    assert rank(incremental_history(spark, table, state, D2)) == sorted([*want, (77, D1[:10])])


def test_catalog_table_is_typed(spark, tmp_path):
    from workpulse.sources.snapshot_store import create_table
    for _ in range(2):
        create_table(spark, str(tmp_path / "t"), "typed_snapshot")
    cols = [(r.col_name, r.data_type) for r in spark.sql("DESCRIBE typed_snapshot").collect() if not r.col_name.startswith("#")]
    assert dict(cols) == {f.name: f.dataType.simpleString() for f in SC.SNAPSHOT.fields} and len(dict(cols)) == 40
    spark.sql("DROP TABLE typed_snapshot")


def test_daily_outputs_have_no_python_or_cartesian(spark):
    run = run_daily(tiny_inputs(spark), D1, Params())
    for name in ("snapshot", "summary", "cards", "dispositions", "reminders", "report", "stage_counts",
                 "grading_requests", "nudge_requests"):
        plan = getattr(run, name)._jdf.queryExecution().executedPlan().toString()
        for bad in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in plan, (name, bad)


def test_image_only_today_and_same_day_comments(spark):
    """The latest comment today is image-only -> has a comment, text empty, graded 'missing'.
    T7: an earlier comment of the same day is neither today's comment nor a past one."""
    base = tiny_inputs(spark)
    cm = spark.createDataFrame([
        ("o", 10, 0, 200, "<div>alpha beta gamma</div>", ("Ann Lee", "ann@x.io"), "2024-01-28T09:00:00Z", None),
        ("o", 10, 1, 201, "<img src='https://img/x.png'>", ("Ann Lee", "ann@x.io"), "2024-01-28T10:00:00Z", None),
        ("o", 10, 2, 202, "<div>alpha beta gamma</div>", ("Bo", "bo@x.io"), "2024-01-27T10:00:00Z", None),
        ("o", 11, 0, 203, "<p>shipped the fix</p>", ("Bo", "bo@x.io"), "2024-01-28T09:00:00Z", None),
        ("o", 11, 1, 204, "<p>Shipped the fix</p>", ("Cy", "cy@x.io"), "2024-01-29T09:00:00Z", None),
    ], SC.COMMENTS)
    inp = TrackerInputs(iterations=base.iterations, stories=base.stories, links=base.links,
                        work_items=base.work_items, comments=cm)
    run = run_daily(inp, D1, Params())
    t = {r.id: r for r in run.tasks.collect()}
    s = {r.work_item_id: r for r in run.snapshot.collect()}
    assert t[10].has_comment_today and t[10].quality_label == "missing" and t[10].quality_score == 0
    assert t[10].copy_paste_detected is False            # blank today text: no comparison (T7, T12)
    assert s[10].today_comment_text is None and s[10].today_comment_image_urls == "https://img/x.png"
    assert s[10].eod_compliant and s[10].needs_attention and s[10].recent_comment_count == 1
    # Future-dated comment (tomorrow) counts as a past comment and matches after strip + lower.
    assert t[11].copy_paste_detected and s[11].recent_comment_authors == "Cy"


def test_reminder_disposition_order(spark):
    from workpulse.operators.routing import dispositions
    rows = [  # id, state_norm, email, has_comment, copied, quality
        (1, "closed", "", False, True, 0),            # fails state first
        (2, "active", "", True, False, 9),            # gate state with a good comment -> good quality wins
        (3, "active", "  ", False, False, 0),         # no email (blank after strip)
        (4, "resolved", " Boss@X.io ", True, False, 2),  # already a recipient (case/space-insensitive)
        (5, "active", "dev@x.io", True, True, 9),     # copied -> not good -> sent
        (6, "resolved", "dev@x.io", True, False, 9),  # non-gate state -> sent, no reason
    ]
    df = spark.createDataFrame([("o", "p", True) + r for r in rows],
                               "org string, project string, needs_attention boolean, id long, state_norm string, "
                               "assignee_email string, has_comment_today boolean, copy_paste_detected boolean, "
                               "quality_score int")
    got = {r.id: (r.disposition, r.send_reason)
           for r in dispositions(df, Params(recipients=("boss@x.io",))).collect()}
    assert got == {1: ("skipped_state", None), 2: ("skipped_good_quality", None),
                   3: ("skipped_no_email", "no comment today"), 4: ("already_recipient", None),
                   5: ("sent", "copy-pasted comment (score 9/10)"), 6: ("sent", None)}


def test_recipients_come_in_bounded_batches(spark):
    """Distinct addresses in order, each once, none over the size; no recipients give one row without addresses."""
    emails = [f"  p{i % 230:03d}@x.io " for i in range(500)] + [None, " "]
    table = spark.createDataFrame([(e,) for e in emails], "email string")
    got = {r.batch: r.recipients for r in recipient_batches(table, 50).collect()}
    assert sorted(got) == [0, 1, 2, 3, 4] and [len(got[b]) for b in sorted(got)] == [50, 50, 50, 50, 30]
    assert [e for b in sorted(got) for e in got[b]] == [f"p{i:03d}@x.io" for i in range(230)]
    summary = spark.createDataFrame([("o", "p", 3, 1), ("o", "q", 1, 0)], "org string, project string, total_tasks long, flagged_tasks long")
    sprint = spark.createDataFrame([("o", "p", "S1"), ("o", "q", "S1")], "org string, project string, sprint_name string")
    rows = lambda p, table=None: sorted((r.project, r.batch, len(r.recipients)) for r in report_outbox(summary, sprint, "2024-01-30 18:00:00", p, table).collect())
    assert rows(Params(report_batch=100), table) == [(p, b, n) for p in "pq" for b, n in ((0, 100), (1, 100), (2, 30))]
    assert rows(Params(), table.where("false")) == rows(Params()) == [("p", 0, 0), ("q", 0, 0)]
    assert rows(Params(recipients=("a@x.io", "b@x.io", "c@x.io"), report_batch=2)) == [(p, b, n) for p in "pq" for b, n in ((0, 2), (1, 1))]
