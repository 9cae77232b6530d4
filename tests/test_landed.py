"""Landed JSON payloads: explicit schemas, quarantine of broken records, posexplode order, field map."""

import json
import os

from workpulse.operators.comments import current_comments
from workpulse.params import HIERARCHY_FORWARD, Params
from workpulse.plans.daily import run_daily
from workpulse.sources.landed import COMMENT_PAYLOAD, CORRUPT, load_tracker, read_json


def _write(path, rows, raw_lines=()):
    path.mkdir(parents=True)
    with open(path / "part-0.json", "w") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")
        for line in raw_lines:
            f.write(line + "\n")


def test_load_and_run(spark, tmp_path):
    b = tmp_path / "landed"
    _write(b / "iterations", [{"org": "o", "project": "p", "pos": 0, "name": "S9", "path": "P\\S9",
                               "startDate": None, "finishDate": "2024-02-02T00:00:00Z"}])
    _write(b / "stories", [{"org": "o", "project": "p", "id": 1, "work_item_type": "User Story", "state": "New",
                            "iteration_path": "P\\S9"}])
    _write(b / "links", [{"org": "o", "source_id": 1, "target_id": 7, "rel": HIERARCHY_FORWARD}, {"org": "o", "source_id": 1, "rel": None}])
    _write(b / "work_items", [{"org": "o", "project": "p", "id": 7, "fields": {
        "System.Title": "Write docs", "System.WorkItemType": "Task", "System.State": "Active",
        "System.AssignedTo": {"displayName": "Ann Lee", "uniqueName": "ann@x.io"},
        "Microsoft.VSTS.Scheduling.RemainingWork": 4, "Microsoft.VSTS.Common.StateChangeDate": "2024-01-25T10:00:00Z",
        "System.ChangedDate": "2024-01-30T10:00:00.123Z"}}], raw_lines=["{broken json"])
    _write(b / "comments", [{"org": "o", "work_item_id": 7, "comments": [
        {"id": 1, "text": "<div>first today</div>", "createdBy": {"displayName": "Ann Lee"},
         "createdDate": "2024-01-30T09:00:00Z"},
        {"id": 2, "text": "<div>second today</div>", "createdBy": {"displayName": "Ann Lee"},
         "createdDate": "2024-01-30T09:00:00Z"}]}])
    inputs, quarantine = load_tracker(spark, str(b))
    assert quarantine["work_items"].count() == 1 and quarantine["comments"].count() == 0
    w = inputs.work_items.first()
    assert (w.title, w.remaining_hours, w.original_estimate) == ("Write docs", 4.0, None)
    assert json.loads(w.assigned_to)["uniqueName"] == "ann@x.io"
    t = run_daily(inputs, "2024-01-30 18:00:00", Params()).tasks.first()
    # Two comments at the same instant: the first in payload order is "today's comment".
    assert t.today_comment_text == "first today" and t.assignee_email == "ann@x.io"
    assert (t.days_remaining, t.total_days, t.dates_configured) == (3, 0, True)
    assert t.days_since_state_change == 5 and t.days_since_last_update == 0


def test_quarantine_names_file_and_time(spark, tmp_path):
    """Cut, mistyped, foreign and empty records are set apart with their file; blank lines are nothing."""
    good = {"org": "o", "work_item_id": 1, "comments": [{"id": 5, "text": "x"}], "more": [1, {"a": 2}]}
    bad = ['{"org": "o", "work_item_id": 2', '{"org": "o", "work_item_id": "two"}', "plain words", "{}", "null", '{"other": 1}']
    _write(tmp_path / "c", [good], bad + ["", "   "])
    (tmp_path / "c" / "part-1.json").write_text(json.dumps({**good, "work_item_id": 3, "comments": None}) + "\n" + bad[0])
    got = read_json(spark, str(tmp_path / "c"), COMMENT_PAYLOAD, landed=True)
    rows = {r.work_item_id: r for r in got.rows.collect()}
    assert set(rows) == {1, 3} and rows[1].comments[0].id == 5 and rows[3].comments is None and rows[1].landed_at is not None
    apart = got.quarantine.collect()
    assert sorted(r[CORRUPT] for r in apart) == sorted([*bad, bad[0]])
    assert {r.file.rsplit("/", 1)[1] for r in apart if r[CORRUPT] == bad[0]} == {"part-0.json", "part-1.json"}
    assert all(r.split_start == 0 and r.landed_at is not None for r in apart)


def test_a_line_is_parsed_once(spark, tmp_path):
    _write(tmp_path / "c", [{"org": "o", "work_item_id": 1, "comments": []}])
    got = read_json(spark, str(tmp_path / "c"), COMMENT_PAYLOAD)
    for df in (got.rows, got.quarantine):
        assert df._jdf.queryExecution().executedPlan().toString().count("from_json(") == 1
    assert got.rows.count() == 1 and got.quarantine.isEmpty()


def test_newest_file_wins(spark, tmp_path):
    """Of two versions of a comment the one that landed later counts, not the one further back in its payload."""
    b, old = tmp_path / "landed", {"id": 1, "text": "old", "createdBy": {"displayName": "A"}, "createdDate": "2024-01-30T09:00:00Z"}
    for name in ("iterations", "stories", "links", "work_items"):
        _write(b / name, [])
    _write(b / "comments", [{"org": "o", "work_item_id": 7, "comments": [{**old, "id": 9}, {**old, "id": 8}, old]}])
    (b / "comments" / "part-1.json").write_text(json.dumps({"org": "o", "work_item_id": 7, "comments": [{**old, "text": "new"}]}))
    os.utime(b / "comments" / "part-0.json", (1_700_000_000, 1_700_000_000))
    got = {r.id: r.text for r in current_comments(load_tracker(spark, str(b))[0].comments).collect()}
    assert got == {9: "old", 8: "old", 1: "new"}
