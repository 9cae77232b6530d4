"""Comment landing stream: every version lands, the newest one counts, idempotent epochs, hook per batch."""

import json

from workpulse.operators.comments import current_comments, recent_comments, similarity_docs
from workpulse.operators.similarity import copy_paste
from workpulse.params import Params
from workpulse.streaming.comment_landing import read_landed_comments, start_landing


def _payload(path, name, rows):
    with open(path / name, "w") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")


def test_landing_keeps_all_versions_and_calls_hook(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    c = lambda i, day: {"id": i, "text": f"<p>c{i}</p>", "createdBy": {"displayName": "A"},
                        "createdDate": f"2024-01-{day}T10:00:00Z"}
    _payload(src, "a.json", [{"org": "o", "work_item_id": 1, "comments": [c(1, 28), c(2, 29)]}])
    seen = []
    landed, ckpt = str(tmp_path / "landed"), str(tmp_path / "ckpt")
    start_landing(spark, str(src), landed, ckpt, on_batch=seen.append).awaitTermination()
    # Redelivered comment 2 plus a new comment 3.
    _payload(src, "b.json", [{"org": "o", "work_item_id": 1, "comments": [c(2, 29), c(3, 30)]}])
    start_landing(spark, str(src), landed, ckpt, on_batch=seen.append).awaitTermination()
    rows = sorted((r.work_item_id, r.id, r.pos) for r in read_landed_comments(spark, landed).collect())
    assert rows == [(1, 1, 0), (1, 2, 0), (1, 2, 1), (1, 3, 1)]  # all versions land
    now = current_comments(read_landed_comments(spark, landed))
    assert sorted((r.work_item_id, r.id) for r in now.collect()) == [(1, 1), (1, 2), (1, 3)]
    assert len(seen) == 2


def test_future_dates_drop_nothing_and_payloads_do_not_merge(spark, tmp_path):
    """Comments at position 0 of three payloads of one item stay three; an edit replaces its comment only."""
    import os
    src = tmp_path / "src"
    src.mkdir()
    c = lambda i, t, day: {"id": i, "text": t, "createdBy": {"displayName": "A"}, "createdDate": f"{day}T10:00:00Z"}
    rows = [("a", c(9, "far ahead", "2099-01-01")), ("b", c(1, "red green", "2024-01-28")), ("c", c(2, "blue", "2024-01-29")),
            ("d", c(3, "red blue", "2024-01-30")), ("e", c(3, "red green blue", "2024-01-30"))]
    for n, (name, comment) in enumerate(rows):
        _payload(src, f"{name}.json", [{"org": "o", "work_item_id": 1, "comments": [comment]}])
        os.utime(src / f"{name}.json", (1_700_000_000 + n, 1_700_000_000 + n))
        start_landing(spark, str(src), str(tmp_path / "landed"), str(tmp_path / "ckpt")).awaitTermination()
    now = current_comments(read_landed_comments(spark, str(tmp_path / "landed")))
    assert sorted((r.id, r.text) for r in now.collect()) == [(1, "red green"), (2, "blue"), (3, "red green blue"), (9, "far ahead")]
    docs = similarity_docs(recent_comments(now.where("id != 9"), "2024-01-30 18:00:00", Params()))
    assert docs.count() == 3
    r = copy_paste(docs, 0.92).first()
    assert not r.copy_paste_detected and 0.5 < r.max_sim < 0.92
