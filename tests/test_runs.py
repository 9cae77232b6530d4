"""What the queries over whole runs do once: task lists by their own columns, tasks shared by two gradings, inputs by all days."""

from types import SimpleNamespace

from pyspark.sql import functions as F

from workpulse.operators import ranking
from workpulse.params import DEFAULT_AS_OF, Params
from workpulse.plans import daily, queries
from workpulse.sources import snapshot_store
from workpulse.sources import standins as SV
from tests.conftest import SF_SMALL


def test_task_order_deals_its_own_columns(spark, monkeypatch):
    tasks = spark.createDataFrame([("acme", "p", i, i % 3, "long text " * 50) for i in range(9)], "org string, project string, id long, risk_score int, nudge_request string")
    dealt = []
    staged = ranking.stage_table
    monkeypatch.setattr(ranking, "stage_table", lambda df, label: (dealt.append(set(df.columns)), staged(df, label))[1])
    monkeypatch.setattr(queries, "_run", lambda *_: SimpleNamespace(tasks=tasks))
    got = [(r.work_item_id, r.position) for r in queries.q_task_order(spark, "").collect()]
    assert got == [(i, n) for n, i in enumerate(sorted(range(9), key=lambda i: (-(i % 3), i)), 1)]
    assert dealt == [{"org", "project", "id", "risk_score", "_range"}]


def test_second_grading_takes_the_built_tasks(spark, monkeypatch):
    inp = SV.tracker_inputs(spark, SF_SMALL, DEFAULT_AS_OF)
    first = daily.run_daily(inp, DEFAULT_AS_OF, Params())
    monkeypatch.setattr(daily, "build_tasks", None)
    again = daily.run_daily(inp, DEFAULT_AS_OF, Params(), built=first.built)
    assert first.snapshot.count() > 100
    assert first.snapshot.exceptAll(again.snapshot).isEmpty() and again.snapshot.exceptAll(first.snapshot).isEmpty()


def test_inputs_of_several_runs_are_built_once(spark):
    inp = queries._landed_once(SV.tracker_inputs(spark, SF_SMALL, DEFAULT_AS_OF))
    for df in (inp.work_items, inp.comments):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Union" not in plan
    assert inp.work_items.count() == SV.work_items(spark, SF_SMALL).count()


def test_staged_rows_are_not_staged_again(spark, tmp_path, monkeypatch):
    rows = daily.run_daily(SV.tracker_inputs(spark, SF_SMALL, DEFAULT_AS_OF), DEFAULT_AS_OF, Params()).snapshot
    counts, staged = {}, snapshot_store.stage_table

    def stage(df, label):
        out = staged(df, label)
        counts[label] = out.count()
        return out

    monkeypatch.setattr(snapshot_store, "stage_table", stage)
    path, n = str(tmp_path / "t"), rows.count()
    assert snapshot_store.upsert(spark, path, rows, staged=True) == n and counts == {}
    some = rows.where("work_item_id % 3 = 0").withColumn("risk_label", F.lit("again"))
    assert snapshot_store.upsert(spark, path, some, staged=True) == some.count()
    # A rerun stages the rows that stay, and no row that is written again.
    assert counts == {"snapshot rows kept": n - some.count()}
    want = rows.where("work_item_id % 3 <> 0").unionByName(some)
    got = snapshot_store.read_snapshot(spark, path)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    bad = snapshot_store.observed_upsert(spark, path, rows.withColumn("task_title", F.when(F.col("work_item_id") % 2 == 0, F.col("task_title"))), staged=True)
    odd = rows.where("work_item_id % 2 <> 0").count()
    assert (bad.rows, bad.violations, bad.nulls, bad.written) == (n, odd, {"task_title": odd}, False)
    assert snapshot_store.observed_upsert(spark, path, rows.where("false"), staged=True) == snapshot_store.Written(0, 0, {}, False)
    assert got.count() == n


def test_days_share_their_scope(spark, monkeypatch):
    inp = SV.tracker_inputs(spark, SF_SMALL, DEFAULT_AS_OF)
    days = (queries.PREV_AS_OF, DEFAULT_AS_OF)
    alone = [daily.run_daily(inp, d, Params()).snapshot for d in days]
    scope = daily.find_scope(inp, DEFAULT_AS_OF, Params())
    monkeypatch.setattr(daily, "scoped_items", None)
    monkeypatch.setattr(daily, "newest_of", None)
    for d, want in zip(days, alone):
        got = daily.run_daily(inp, d, Params(), scope=scope).snapshot
        assert want.count() > 100 and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_history_loop_builds_its_scope_once_and_a_rerun_no_tasks(spark, monkeypatch):
    calls = {"scoped_items": 0, "newest_of": 0, "recent_comments": 0, "assign_branch": 0}
    limits, before = set(), spark.conf.get("spark.sql.codegen.hugeMethodLimit")

    def counted(name, f):
        def run(*a, **k):
            calls[name] += 1
            limits.add(spark.conf.get("spark.sql.codegen.hugeMethodLimit"))
            return f(*a, **k)
        return run

    for name in calls:
        monkeypatch.setattr(daily, name, counted(name, getattr(daily, name)))
    rows = queries.q_snapshot_history_loop(spark, SF_SMALL)
    assert [r[0].isoformat() for r in rows.select("snapshot_date").distinct().orderBy("snapshot_date").collect()] == ["2024-01-28", "2024-01-29", "2024-01-30"]
    # The rerun reads its day's tasks and comments, and branches them by the history that the earlier runs wrote.
    assert calls == {"scoped_items": 1, "newest_of": 1, "recent_comments": 3, "assign_branch": 4}
    assert limits == {"8000"} and spark.conf.get("spark.sql.codegen.hugeMethodLimit") == before
