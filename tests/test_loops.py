"""Comment state, replies as streams, positions and ordered files, bucketed and observed upsert."""

import datetime
import os
import time

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from workpulse.operators.comments import current_comments
from workpulse.operators.ranking import read_ordered, with_positions, write_ordered
from workpulse.schemas import COMMENTS
from workpulse.sources.comment_state import compact, epochs, newest_comments, read_versions, valid_state
from workpulse.streaming.replies import closing_marks, match_landed

DAY = datetime.datetime(2024, 1, 10)


def comment(item, cid, text, created, landed):
    return ("o", item, cid, cid, text, ("A", "a@x"), created.isoformat() + "Z" if created else "", landed)


def land(spark, base, epoch, rows):
    spark.createDataFrame(rows, COMMENTS).write.parquet(f"{base}/landed/epoch={epoch}")


def texts(df):
    return sorted((r["work_item_id"], r["id"], r["text"]) for r in df.collect())


@pytest.fixture()
def landed(spark, tmp_path):
    base = str(tmp_path)
    d = [DAY + datetime.timedelta(days=i) for i in range(6)]
    land(spark, base, 0, [comment(1, 1, "first", d[0], d[0]), comment(1, 2, "second", d[1], d[1]), comment(2, 3, "no date", None, d[1])])
    land(spark, base, 1, [comment(1, 1, "first, edited", d[0], d[2]), comment(2, 4, "fourth", d[2], d[2])])
    compact(spark, f"{base}/landed", f"{base}/state", 1)
    land(spark, base, 2, [comment(1, 2, "second, edited", d[4], d[4]), comment(3, 5, "fifth", d[4], d[4])])
    return base, d


def full_scan(spark, base):
    return texts(current_comments(read_versions(spark, [p for p, _ in epochs(spark, f"{base}/landed").values()])))


def test_state_and_later_epochs_equal_the_full_scan(spark, landed):
    base, d = landed
    got = newest_comments(spark, f"{base}/landed", f"{base}/state", 2)
    assert texts(got) == full_scan(spark, base)
    read = {f.split(base)[1].split("/")[1:3][-1] if "landed/epoch" in f else "state" for f in got.inputFiles()}
    assert read == {"state", "epoch=2"}  # earlier epochs are not opened


def test_lookback_reads_its_days_only(spark, landed):
    base, d = landed
    since = d[2].date()
    got = newest_comments(spark, f"{base}/landed", f"{base}/state", 2, since)
    want = [(1, 2, "second, edited"), (2, 4, "fourth"), (3, 5, "fifth")]
    assert texts(got) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "created_day" in plan.split("PartitionFilters")[1].split("]")[0]


def test_late_redelivery_does_not_bring_an_old_version_back(spark, landed):
    base, d = landed
    # An older version of comment 1, moved to a day inside the lookback, lands last.
    land(spark, base, 3, [comment(1, 1, "older", d[3], d[0]), comment(1, 2, "second", d[1], d[1])])
    for since in (None, d[2].date()):
        got = texts(newest_comments(spark, f"{base}/landed", f"{base}/state", 3, since))
        assert (1, 1, "older") not in got
        assert got == [x for x in full_scan(spark, base) if since is None or x[1] in (2, 4, 5)]


def test_unfinished_and_overtaken_states_are_passed_over(spark, landed):
    base, _ = landed
    state = valid_state(spark, f"{base}/landed", f"{base}/state", 2)
    assert state[0] == 1 and valid_state(spark, f"{base}/landed", f"{base}/state", 0) is None
    os.makedirs(f"{base}/state/upto=2,landed=0")  # a job that never committed
    assert valid_state(spark, f"{base}/landed", f"{base}/state", 2) == state
    time.sleep(1.1)
    spark.createDataFrame([comment(9, 9, "replayed", DAY, DAY)], COMMENTS).write.mode("overwrite").parquet(f"{base}/landed/epoch=0")
    assert valid_state(spark, f"{base}/landed", f"{base}/state", 2) is None
    assert texts(newest_comments(spark, f"{base}/landed", f"{base}/state", 2)) == full_scan(spark, base)
    compact(spark, f"{base}/landed", f"{base}/state", 2)
    assert valid_state(spark, f"{base}/landed", f"{base}/state", 2)[0] == 2


def test_no_landing_yet(spark, tmp_path):
    assert newest_comments(spark, str(tmp_path / "none"), str(tmp_path / "state"), 5).collect() == []


def test_replies_in_time_late_and_missing(spark, tmp_path):
    at = datetime.datetime(2024, 1, 30, 18)
    ask = lambda i: Row(org="o", work_item_id=i, as_of=at, kind="grade", asked_at=at)
    say = lambda i, raw, minutes: Row(org="o", work_item_id=i, as_of=at, kind="grade", raw=raw, replied_at=at + datetime.timedelta(minutes=minutes))
    base = str(tmp_path)
    spark.createDataFrame([ask(1), ask(2), ask(3), ask(4)]).write.parquet(f"{base}/q")
    spark.createDataFrame([say(1, "yes", 1), say(2, "late", 121), say(4, "one", 5), say(4, "two", 6), say(8, "nobody asked", 1)]).write.parquet(f"{base}/r")
    run = lambda: sorted((r["work_item_id"], r["raw"]) for r in match_landed(spark, f"{base}/q", f"{base}/r", f"{base}/out", f"{base}/cp", "2 hours").collect())
    assert run() == [(1, "yes"), (4, "one"), (4, "two")]  # requests 2 and 3 may still be answered
    q, r = closing_marks(spark, "2024-02-01 00:00:00")
    q.write.mode("append").parquet(f"{base}/q")
    r.write.mode("append").parquet(f"{base}/r")
    got = run()  # goes on where it stopped
    assert [x for x in got if x[1]] == [(1, "yes"), (4, "one"), (4, "two")] and [x[0] for x in got if x[1] is None] == [2, 3]


def test_positions_equal_a_window_and_ranges_split_a_hot_group(spark):
    rows = [("a" if i % 3 else "b", (i * 7919) % 101, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, score int, id long")
    got = with_positions(df, ["g"], [F.desc("score"), F.asc("id")], ranges=8)
    want = df.selectExpr("*", "row_number() OVER (PARTITION BY g ORDER BY score DESC, id) AS position")
    assert sorted(map(tuple, got.collect())) == sorted((r["g"], r["score"], r["id"], r["position"]) for r in want.collect())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert all("_range" in w.split("\n")[0] for w in plan.split("Window [row_number")[1:])


def test_ordered_files(spark, tmp_path):
    df = spark.range(500).selectExpr("(id * 37) % 500 AS id")
    write_ordered(df, str(tmp_path / "o"), ["id"], ranges=4)
    rows = sorted((r["_file"], r["_row"], r["id"]) for r in read_ordered(spark, str(tmp_path / "o")).collect())
    assert [r[2] for r in rows] == list(range(500)) and len({r[0] for r in rows}) > 1


def test_rerun_of_one_item_leaves_other_buckets_alone(spark, tmp_path):
    from workpulse.plans.queries import _run
    from workpulse.sources.snapshot_store import observed_upsert, read_snapshot
    rows = _run(spark, "/root/testdata/sf0.001").snapshot
    path = str(tmp_path / "t")
    first = observed_upsert(spark, path, rows)
    assert (first.written, first.violations) == (True, 0)

    def files():
        return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}

    before, table = files(), read_snapshot(spark, path).count()
    one = rows.orderBy("work_item_id").limit(1).withColumn("task_title", F.lit("changed"))
    observed_upsert(spark, path, one)
    after = files()
    changed = {os.path.dirname(f) for f in set(before) ^ set(after)}
    assert len(changed) == 1 and all(after[f] == t for f, t in before.items() if os.path.dirname(f) not in changed)
    assert read_snapshot(spark, path).count() == table and read_snapshot(spark, path).where("task_title = 'changed'").count() == 1
    empty = observed_upsert(spark, path, rows.where("false"))
    assert (empty.rows, empty.written) == (0, False)
    broken = observed_upsert(spark, path, rows.withColumn("risk_label", F.lit(None).cast("string")))
    assert broken.nulls == {"risk_label": broken.rows} and not broken.written and files() == after
