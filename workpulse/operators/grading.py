"""Comment grading as a table stage.

The grader is an external service: this stage emits a ``requests`` table for
eligible rows only and reads a ``responses`` table back. For offline runs the
deterministic rubric grader (G3) fills the same struct from column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from workpulse.functions.text import is_blank, py_strip
from workpulse.params import DEFAULT_SENTIMENT
from workpulse.schemas import GRADE_FIELDS

# ---------------------------------------------------------------------------
# Fixed values (texts of the records produced without a usable grader reply).
# ---------------------------------------------------------------------------
MISSING_FOLLOWUP = "Can you share what you worked on today for '%s'?"
FAILED_FOLLOWUP = "What progress did you make on '%s' today?"
REQUEST_LINES = ("Task title: ", "Developer: ", "EOD comment: ")
# Rubric (approximation of the published grading rules, not parity).
VAGUE_PHRASES = ("done", "in progress", "working on it", "same as yesterday")
DONE_WORDS = ("completed", "complete", "finished", "implemented", "fixed", "added", "merged", "deployed", "wrote",
              "tested", "resolved", "updated", "handled", "reviewed")
LEFT_WORDS = ("remaining", "left", "next", "todo", "tomorrow", "will", "pending", "plan")
RISK_WORDS = ("blocker", "blockers", "blocked", "risk", "risks", "waiting", "dependency", "issue", "issues")
BLOCKER_PHRASES = ("blocked", "blocking", "waiting on", "waiting for", "dependency", "depends on")
NO_BLOCKER_PHRASES = ("no blocker", "no blockers")
RUBRIC_FOLLOWUP = "What specifically remains on '%s', and when will it be done?"
WORD_PATTERN = r"[\p{L}\p{N}_]+"


def _record(score, label, blocker, progress, sentiment, followup) -> Column:
    return F.struct(score.cast("int").alias("quality_score"), label.alias("quality_label"),
                    blocker.alias("blocker_detected"), progress.alias("progress_detectable"),
                    sentiment.alias("sentiment"), followup.alias("suggested_followup"))


def missing_record(title) -> Column:
    """K6: no usable comment -> score 0, 'missing', no grader call."""
    return _record(F.lit(0), F.lit("missing"), F.lit(False), F.lit(False), F.lit(DEFAULT_SENTIMENT),
                   F.format_string(MISSING_FOLLOWUP, title))


def failed_record(title) -> Column:
    """Grader failure -> score 0, 'vague'."""
    return _record(F.lit(0), F.lit("vague"), F.lit(False), F.lit(False), F.lit(DEFAULT_SENTIMENT),
                   F.format_string(FAILED_FOLLOWUP, title))


def request_text(title, developer, comment) -> Column:
    """The three-line grading request."""
    return F.concat_ws("\n", *[F.concat(F.lit(h), F.coalesce(c, F.lit("")))
                               for h, c in zip(REQUEST_LINES, (title, developer, comment))])


def unfence(raw) -> Column:
    """Strip a leading code fence (and a ``json`` tag) the way the reply parser does (K3)."""
    return _unfence_stripped(py_strip(raw))


def _unfence_stripped(s) -> Column:
    inner = F.coalesce(F.try_element_at(F.split(s, "```"), F.lit(2)), F.lit(""))
    inner = F.when(inner.startswith("json"), F.substr(inner, F.lit(5))).otherwise(inner)
    return F.when(s.startswith("```"), inner).otherwise(s)


#: Grade fields that a reply may give as null: no blocker, no progress, no sentiment, no follow-up.
NULLABLE = ("blocker_detected", "progress_detectable", "sentiment", "suggested_followup")


def _loose(schema) -> tuple[T.StructType, T.StructType]:
    """The schema with numbers as doubles, and with every field as its JSON text."""
    typed = [T.StructField(f.name, T.DoubleType() if isinstance(f.dataType, T.IntegerType) else f.dataType) for f in schema.fields]
    return T.StructType(typed), T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])


def _reply_ok(body_stripped, parsed, texts, schema) -> Column:
    """One whole object with every key present. Null is accepted for the fields of ``NULLABLE``; a value of another
    type is not (typed it is null, as text it is not); a number must be whole (8 and 8.0, but not 7.5)."""
    ok = body_stripped.startswith("{") & body_stripped.endswith("}") & parsed.isNotNull()
    ok = ok & F.forall(F.array(*[F.lit(f.name) for f in schema.fields]),
                       lambda k: F.array_contains(F.json_object_keys(body_stripped), k))
    for f in schema.fields:
        v = parsed[f.name]
        whole = v == F.floor(v) if isinstance(f.dataType, T.IntegerType) else F.lit(True)
        given = v.isNotNull() & whole
        ok = ok & (given | texts[f.name].isNull() if f.name in NULLABLE else given)
    return F.coalesce(ok, F.lit(False))


def _fields(parsed, schema) -> list[Column]:
    """The record's values: whole numbers as integers, a null flag as false."""
    out = []
    for f in schema.fields:
        v = parsed[f.name].cast(f.dataType)
        out.append(F.coalesce(v, F.lit(False)) if isinstance(f.dataType, T.BooleanType) else v)
    return out


def parse_reply(raw, schema) -> tuple[Column, Column]:
    """JSON object reply -> (struct, ok)."""
    body = unfence(raw)
    typed, text = _loose(schema)
    parsed = F.from_json(body, typed)
    return parsed, _reply_ok(py_strip(body), parsed, F.from_json(body, text), schema)


def parse_grade(raw, title) -> Column:
    """K3 + X12: reply text -> grade record, any failure -> the fallback record."""
    parsed, ok = parse_reply(raw, GRADE_FIELDS)
    return F.when(ok, _record(*_fields(parsed, GRADE_FIELDS))).otherwise(failed_record(title))


def with_parsed_grade(df: DataFrame, raw: str, title, out: str = "quality", ok_col: str | None = None) -> DataFrame:
    """Row-staged ``parse_grade``: strip, unfence and ``from_json`` each run once per row."""
    t = df.withColumn("__s", py_strip(F.col(raw)))
    t = t.withColumn("__b", _unfence_stripped(F.col("__s")))
    typed, text = _loose(GRADE_FIELDS)
    t = t.withColumns({"__bt": py_strip(F.col("__b")), "__p": F.from_json(F.col("__b"), typed),
                       "__t": F.from_json(F.col("__b"), text)})
    t = t.withColumn("__ok", _reply_ok(F.col("__bt"), F.col("__p"), F.col("__t"), GRADE_FIELDS))
    rec = _record(*_fields(F.col("__p"), GRADE_FIELDS))
    t = t.withColumn(out, F.when(F.col("__ok"), rec).otherwise(failed_record(title)))
    if ok_col:
        t = t.withColumn(ok_col, F.col("__ok"))
    return t.drop("__s", "__b", "__bt", "__p", "__t", "__ok")


def _has_phrase(norm: Column, phrases) -> Column:
    out = F.lit(False)
    for ph in phrases:
        out = out | norm.contains(f" {ph} ")
    return out


def _rubric_parts(text) -> dict:
    toks = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD_PATTERN), 0)
    return {"toks": toks}


def _rubric_flags(text, toks) -> dict:
    norm = F.concat(F.lit(" "), F.array_join(toks, " "), F.lit(" "))
    words = F.size(toks)
    has = lambda ws: F.arrays_overlap(toks, F.array(*[F.lit(w) for w in ws]))
    return {
        "words": words,
        "vague": (words <= 5) & _has_phrase(norm, VAGUE_PHRASES),
        "done": has(DONE_WORDS), "left": has(LEFT_WORDS), "risk": has(RISK_WORDS),
        "digit": F.coalesce(text, F.lit("")).rlike("[0-9]"),
        "blocker": _has_phrase(norm, BLOCKER_PHRASES) | (
            _has_phrase(norm, ("blocker", "blockers")) & ~_has_phrase(norm, NO_BLOCKER_PHRASES)),
        "blank": is_blank(text),
    }


def _rubric_score(f: dict) -> Column:
    b = lambda c, v: F.when(c, F.lit(v)).otherwise(F.lit(0))
    words = f["words"]
    raw = (F.lit(1) + b(f["done"], 2) + b(f["left"], 2) + b(f["risk"], 1) + b(words >= 12, 2) + b(words >= 25, 1)
           + b(f["digit"], 1))
    return F.when(f["vague"], F.least(F.lit(3), F.greatest(F.lit(0), words - 1))).otherwise(F.least(F.lit(10), raw))


def _rubric_record(f: dict, score, title) -> Column:
    label = F.when(score >= 8, F.lit("excellent")).when(score >= 5, F.lit("good")).otherwise(F.lit("vague"))
    sentiment = F.when(f["blocker"], F.lit("negative")).when(score >= 7, F.lit("positive")).otherwise(F.lit("neutral"))
    graded = _record(score, label, f["blocker"], f["done"], sentiment, F.format_string(RUBRIC_FOLLOWUP, title))
    return F.when(f["blank"], missing_record(title)).otherwise(graded)


def rubric_grade(text, title) -> Column:
    """Deterministic rubric grader (approximation of the published rules), as one column expression."""
    f = _rubric_flags(text, _rubric_parts(text)["toks"])
    return _rubric_record(f, _rubric_score(f), title)


def with_rubric(df: DataFrame, text: str, title, out: str = "quality") -> DataFrame:
    """Row-staged G3: tokens once, then flags, then score, then the record."""
    t = df.withColumn("__toks", _rubric_parts(F.col(text))["toks"])
    flags = _rubric_flags(F.col(text), F.col("__toks"))
    t = t.withColumns({f"__{k}": v for k, v in flags.items()})
    staged = {k: F.col(f"__{k}") for k in flags}
    t = t.withColumn("__score", _rubric_score(staged))
    t = t.withColumn(out, _rubric_record(staged, F.col("__score"), title))
    return t.drop("__toks", "__score", *[f"__{k}" for k in flags])


def grading_requests(tasks: DataFrame, as_of: str) -> DataFrame:
    """G1: one request row per analysed task with a non-blank comment today."""
    from workpulse.functions.dates import as_of_ts
    eligible = tasks.where((F.col("branch") == "analysed") & ~is_blank(F.col("today_comment_text")))
    return eligible.select("org", "project", F.col("id").alias("work_item_id"), as_of_ts(as_of).alias("as_of"),
                           request_text(F.col("title"), F.col("assignee_name"), F.col("today_comment_text"))
                           .alias("request"))


def grade(tasks: DataFrame, as_of: str, responses: DataFrame | None = None) -> DataFrame:
    """Attach ``quality`` (the grade record) to analysed tasks.

    With ``responses`` (``org, work_item_id, as_of, kind, raw``), replies for this
    run are parsed; a request without a reply counts as a failed call. Without
    them the rubric grader is used.
    """
    title = F.col("title")
    blank = is_blank(F.col("today_comment_text"))
    if responses is None:
        return with_rubric(tasks, "today_comment_text", title)
    from workpulse.functions.dates import as_of_ts
    # Several replies for one task and run: a deterministic pick (greatest text).
    r = (responses.where((F.col("kind") == "grade") & (F.col("as_of") == as_of_ts(as_of)))
         .groupBy("org", "work_item_id").agg(F.max_by("raw", F.struct("as_of", "raw")).alias("reply")))
    j = with_parsed_grade(tasks.join(r.withColumnRenamed("work_item_id", "id"), ["org", "id"], "left"), "reply", title,
                          "parsed")
    return j.withColumn("quality", F.when(blank, missing_record(title)).otherwise(F.col("parsed"))) \
        .drop("reply", "parsed")
