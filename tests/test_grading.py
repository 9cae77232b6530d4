"""Grader reply parsing (K3/K4/X12) and the rubric grader (G3) on comments of every score band."""

import pytest
from pyspark.sql import functions as F

from workpulse.operators.grading import parse_grade, parse_reply, rubric_grade
from workpulse.operators.nudge import parse_nudge_reply
from workpulse.schemas import GRADE_FIELDS

GOOD = ('{"quality_score": 8, "quality_label": "good", "blocker_detected": false, "progress_detectable": true, '
        '"sentiment": "positive", "suggested_followup": "What is next?"}')


@pytest.mark.parametrize("raw,ok", [
    (GOOD, True), ("```json\n" + GOOD + "\n```", True), ("```\n" + GOOD + "\n```", True),
    ("  \n" + GOOD + "  ", True), ("not json at all", False), (None, False), ('{"quality_score": 5}', False),
    (GOOD.replace('"positive"', "null"), True), (GOOD.replace("8", "8.0"), True), (GOOD.replace("8", "7.5"), False),
    (GOOD.replace("false", '"no"'), False), (GOOD.replace("8", "null"), False), (GOOD.replace('"sentiment": "positive", ', ""), False),
    (GOOD.replace("false", "null"), True), (GOOD + " trailing", False), (GOOD.replace("8", '"8"'), False), ("```json\n```", False),
])
def test_reply_parse(spark, raw, ok):
    df = spark.createDataFrame([(raw,)], "raw string")
    _, flag = parse_reply(F.col("raw"), GRADE_FIELDS)
    r = df.select(flag.alias("ok"), parse_grade(F.col("raw"), F.lit("T1")).alias("g")).first()
    assert r.ok is ok
    if ok:
        assert (r.g.quality_score, r.g.quality_label, r.g.progress_detectable) == (8, "good", True)
    else:
        assert (r.g.quality_score, r.g.quality_label, r.g.blocker_detected) == (0, "vague", False)
        assert r.g.suggested_followup == "What progress did you make on 'T1' today?"


def test_nudge_reply_defaults(spark):
    df = spark.createDataFrame([('{"message": "hi"}',), ('{"tone": "firm"}',), ("junk",)], "raw string")
    parsed, ok = parse_nudge_reply(F.col("raw"))
    rows = df.select(ok.alias("ok"), parsed.alias("p")).collect()
    assert [r.ok for r in rows] == [True, True, False]


# Own comments, a few for each band of the score.
BANDS = [
    ("Finished the invoice export and merged the branch, rounding of 3 currencies is covered by tests. Remaining work is the "
     "archive job, about 4 hours, and there is a risk that the old format needs a migration first.", 8, 10),
    ("Finished the export today, the remaining part is the archive job for 2 customers", 6, 9),
    ("Merged the parser", 2, 5), ("ok", 0, 1), ("still on it", 0, 3), ("almost done", 0, 3),
]


def test_rubric_bands(spark):
    df = spark.createDataFrame([(t,) for t, _, _ in BANDS], "t string")
    for (text, lo, hi), r in zip(BANDS, df.select(rubric_grade(F.col("t"), F.lit("Task")).alias("g")).collect()):
        assert lo <= r.g.quality_score <= hi, (text, r.g.quality_score)
        assert r.g.blocker_detected is False


def test_rubric_blank_and_blocker(spark):
    df = spark.createDataFrame([("  ",), (None,), ("Blocked waiting on the DB team dependency",)], "t string")
    rows = df.select(rubric_grade(F.col("t"), F.lit("X")).alias("g")).collect()
    assert rows[0].g.quality_label == rows[1].g.quality_label == "missing"
    assert rows[0].g.suggested_followup == "Can you share what you worked on today for 'X'?"
    assert rows[2].g.blocker_detected and rows[2].g.sentiment == "negative"
