"""Stand-in tracker inputs derived from the driver tables (FIXTURES.md part B).

Every recipe is plain column arithmetic on the given tables, so the work grows
with them; ``workpulse.plans.oracle`` holds the same recipes in SQL.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from workpulse.functions.dates import as_of_ts
from workpulse.params import DEFAULT_AS_OF, HIERARCHY_FORWARD
from workpulse.session import fits_broadcast, spread

ORG = "acme"
# A second org whose stories and items carry numbers that the first one uses as well.
OTHER = "beta"
# Finish-date offsets (days after as_of's date) cycled over nations.
FINISH_OFFSETS = (-1, 0, 1, 2, 3, 5, 6, 14)


_READS: dict = {}
# Text tables whose regex / tokenising work runs before the first shuffle.
_ROW_HEAVY = {"events", "pages", "conversations", "documents"}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Driver table ``name``; the DataFrame (file listing + footer schema) is reused per session.

    Thin scans of text tables are spread over the session's cores (see ``spread``).
    """
    key = (spark.sparkContext.applicationId, id(spark), sf_dir.rstrip("/"), name)
    if key not in _READS:
        df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
        _READS[key] = spread(df) if name in _ROW_HEAVY else df
    return _READS[key]


def _iso_seconds(ts):
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def iterations(spark: SparkSession, sf_dir: str, as_of: str = DEFAULT_AS_OF) -> DataFrame:
    """Two current iterations per project (= nation); most list the sprint first."""
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("n_nationkey")
    sprint_first = (k % 6) != 5
    rows = n.select("n_nationkey", "n_name", F.explode(F.array(F.lit(ORG), F.lit(OTHER))).alias("org"))
    rows = rows.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("pos"))
    is_sprint = (F.col("pos") == 0) == sprint_first
    offset = F.element_at(F.array(*[F.lit(x) for x in FINISH_OFFSETS]), (k % 8 + 1).cast("int"))
    finish = F.concat(F.date_format(F.date_add(F.to_date(as_of_ts(as_of)), offset), "yyyy-MM-dd"),
                      F.lit("T00:00:00Z"))
    start = F.concat(F.date_format(F.date_sub(F.to_date(as_of_ts(as_of)), 10), "yyyy-MM-dd"), F.lit("T00:00:00Z"))
    return rows.select(
        "org", F.col("n_name").alias("project"), F.col("pos").cast("int").alias("pos"),
        F.when(is_sprint, F.concat(F.lit("Sprint "), k.cast("string"))).otherwise(F.lit("Backlog")).alias("name"),
        F.when(is_sprint, F.col("n_name")).otherwise(F.concat(F.col("n_name"), F.lit(" Backlog"))).alias("path"),
        F.when(is_sprint & ((k % 5) != 4), start).alias("startDate"),
        F.when(is_sprint & ((k % 7) != 6), finish).alias("finishDate"),
    )


def orgs(both) -> Column:
    """The orgs of a row: the first one, and the second one as well where ``both`` holds."""
    return F.explode(F.when(both, F.array(F.lit(ORG), F.lit(OTHER))).otherwise(F.array(F.lit(ORG)))).alias("org")


def nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """key and name; broadcast if counted and small."""
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return F.broadcast(n) if fits_broadcast(n, 1000) else n


def stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", orgs(F.col("c_custkey") % 2 == 0))
    n = nations(spark, sf_dir)
    seg = F.col("c_mktsegment")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        "org", F.col("n_name").alias("project"), F.col("c_custkey").alias("id"),
        F.when(F.col("c_custkey") % 5 == 0, F.lit("Bug")).otherwise(F.lit("User Story")).alias("work_item_type"),
        F.when(seg == "BUILDING", F.lit("Closed")).when(seg == "MACHINERY", F.lit("Removed"))
        .otherwise(F.lit("Active")).alias("state"),
        F.col("n_name").alias("iteration_path"),
    )


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", orgs(F.col("o_orderkey") % 5 == 0))
    return o.select(
        "org", F.col("o_custkey").alias("source_id"), F.col("o_orderkey").alias("target_id"),
        F.when(F.col("o_orderkey") % 11 == 0, F.lit(None).cast("string")).otherwise(F.lit(HIERARCHY_FORWARD))
        .alias("rel"),
    )


def work_items(spark: SparkSession, sf_dir: str, as_of: str = DEFAULT_AS_OF) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                                  "o_orderpriority")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = nations(spark, sf_dir)
    qty = (read_table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
           .agg(F.sum("l_quantity").alias("remaining_hours")))
    base = (o.join(c.join(n, c.c_nationkey == n.n_nationkey), F.col("o_custkey") == F.col("c_custkey"))
            .join(qty, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("*", orgs(F.col("o_orderkey") % 5 == 0)))
    key, cust, name = F.col("o_orderkey"), F.col("c_custkey"), F.col("c_name")
    email = F.concat(F.lower(name), F.lit("@example.com"))
    assigned = (F.when(cust % 13 == 0, F.lit(None).cast("string"))
                .when(cust % 13 == 1, name)
                .when(cust % 13 == 2, F.lit(""))
                .when(cust % 10 == 0, F.concat(F.lit('{"displayName": "'), name, F.lit('"}')))
                .otherwise(F.concat(F.lit('{"displayName": "'), name, F.lit('", "uniqueName": "'), email,
                                    F.lit('"}'))))
    now_s = F.unix_seconds(as_of_ts(as_of))
    hours = F.col("o_custkey") % 24
    state_change = F.timestamp_seconds(now_s - (key * 7 % 15) * 86400 - hours * 3600)
    changed = F.timestamp_seconds(now_s - (key % 9) * 86400 - hours * 3600)
    status = F.col("o_orderstatus")
    return base.select(
        "org", F.col("n_name").alias("project"), key.alias("id"),
        F.concat(F.when(F.col("org") == OTHER, F.lit("Beta order ")).otherwise(F.lit("Order ")), key.cast("string"), F.lit(" ("), F.col("o_orderpriority"), F.lit(")")).alias("title"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("Bug")).otherwise(F.lit("Task")).alias("work_item_type"),
        F.when(status == "O", F.lit("Active")).when(status == "P", F.lit(" resolved ")).otherwise(F.lit("Closed"))
        .alias("state"),
        F.col("n_name").alias("iteration_path"),
        assigned.alias("assigned_to"),
        F.col("remaining_hours"),
        (F.col("o_totalprice") / F.lit(2000.0)).alias("original_estimate"),
        F.when(key % 97 == 0, F.lit("")).otherwise(_iso_seconds(state_change)).alias("state_change_date"),
        _iso_seconds(changed).alias("changed_date"),
    )


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as HTML comments: user = work item, event = comment, type = author."""
    e = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    eid, etype, props = F.col("event_id"), F.col("event_type"), F.col("props")
    m = eid % 10
    img = lambda q, tail: F.concat(F.lit("<img alt=" + q + "s" + q + " src=" + q + "https://img.example.com/"),
                                   eid.cast("string"), F.lit(tail + q + ">"))
    text = (F.when(m == 0, F.lit(None).cast("string"))
            .when(m == 1, F.lit(""))
            .when(m == 2, F.concat(F.lit("<div>"), etype, F.lit(" &amp;lt;ok&amp;gt; "), props,
                                   F.lit("</div><div><br/></div><P>&nbsp;</P>")))
            .when(m == 3, F.concat(F.lit("<div>Working on "), etype, F.lit(" flow</div>"), img('"', ".png"),
                                   F.lit("<IMG SRC='https://img.example.com/b"), eid.cast("string"),
                                   F.lit(".jpg'>")))
            .when(m == 4, img("'", ".gif"))
            .otherwise(F.concat(F.lit("<div>Update on "), etype, F.lit(": "), props,
                                F.lit("</div><ul><li>done</li><li>next</li></ul>"))))
    author = F.struct(F.when(etype == "signup", F.lit("")).otherwise(etype).alias("displayName"),
                      F.concat(etype, F.lit("@example.com")).alias("uniqueName"))
    created = F.when(eid % 53 == 0, F.lit("")).otherwise(
        F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    return e.select(F.when(eid % 4 == 0, F.lit(OTHER)).otherwise(F.lit(ORG)).alias("org"),
                    F.col("user_id").alias("work_item_id"), eid.alias("pos"), eid.alias("id"), text.alias("text"),
                    author.alias("createdBy"), created.alias("createdDate"), F.col("ts").alias("landed_at")
                    ).unionByName(order_comments(spark, sf_dir))


#: Texts of the comments on orders, by o_orderkey % 7 (0: no comment) and day (0: today); K: the order's number.
ORDER_TEXTS = {
    1: ("Reviewed module K with the team", "REVIEWED module K with the team ", "Planned the sessions of next week"),
    2: ("Checked totals and totals of batch K against ledger ledger ledger for north south east west and sent reports reports to finance",
        "Checked totals and totals of batch K against ledger ledger ledger for north south east west and sent reports reports to audit",
        "Checked totals and totals of batch K against ledger ledger ledger for north south east west and sent reports reports to sales"),
    3: ("Blocked, waiting on the database team for access to K", "Wrote the first queries", "Set up the workbench"),
    4: ("Completed the export of K and merged it with 12 tests, remaining work is the archive step and about 2 hours of review, "
        "the only risk is the old format of one customer", "Completed the import and fixed 3 defects", "Drafted the layout of both files"),
    5: ("done", "in progress", "started"),
    6: ("Finished K, left are 4 checks for tomorrow and a risk of delay from one supplier", "", "Ordered the parts"),
}


def order_comments(spark: SparkSession, sf_dir: str, as_of: str = DEFAULT_AS_OF) -> DataFrame:
    """Three comments on most orders, today's and those of two days before, so that every grade, exact and near
    copies and blockers occur; those on every tenth order are the second org's."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("day"))
    k, day = F.col("o_orderkey"), F.col("day")
    text = F.lit(None).cast("string")
    for kind, texts in ORDER_TEXTS.items():
        for d, t in enumerate(texts):
            filled = F.lit(t) if "K" not in t else F.concat(F.lit(t.split("K")[0]), k.cast("string"), F.lit(t.split("K")[1]))
            text = F.when((k % 7 == kind) & (day == d), filled).otherwise(text)
    ts = F.timestamp_seconds(F.unix_seconds(as_of_ts(as_of)) - day * 86400 - (k % 5 + 1) * 3600)
    cid = (k * 4 + day + 1) * -1  # apart from the events' numbers
    return o.where(k % 7 != 0).select(
        F.when(k % 10 == 0, F.lit(OTHER)).otherwise(F.lit(ORG)).alias("org"), k.cast("long").alias("work_item_id"), cid.cast("long").alias("pos"),
        cid.cast("long").alias("id"), text.alias("text"),
        F.struct(F.concat(F.lit("dev"), (k % 3).cast("string")).alias("displayName"), F.lit("dev@example.com").alias("uniqueName")).alias("createdBy"),
        _iso_seconds(ts).alias("createdDate"), ts.alias("landed_at"))


def landed_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments as they land: every third again a day later (unchanged), every fifth edited two days later, every
    seventh dated far in the future."""
    c = comments(spark, sf_dir)
    m = F.abs(F.col("id"))
    again = F.array_compact(F.array(F.lit(0), F.when(m % 3 == 0, F.lit(1)), F.when(m % 5 == 0, F.lit(2))))
    v = c.withColumn("version", F.explode(again))
    return v.withColumns({
        "text": F.when(F.col("version") == 2, F.concat(F.coalesce("text", F.lit("")), F.lit(" (edited)"))).otherwise(F.col("text")),
        "createdDate": F.when(m % 7 == 0, F.lit("2099-01-01T00:00:00Z")).otherwise(F.col("createdDate")),
        "landed_at": F.col("landed_at") + F.make_dt_interval(days=F.col("version")),
    }).drop("version")


def snapshot_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per (user, day) history rows in snapshot shape (the columns the gate reads)."""
    e = read_table(spark, sf_dir, "events").select("ts", "user_id", "event_type", "value")
    return (e.groupBy(F.col("user_id").alias("work_item_id"), F.to_date("ts").alias("snapshot_date"))
            .agg(F.least(F.lit(10), F.floor(F.max("value") / 15)).cast("int").alias("comment_quality_score"),
                 F.bool_or(F.col("event_type") == "purchase").alias("eod_compliant"),
                 F.bool_or(F.col("event_type") == "error").alias("copy_paste_detected"),
                 F.max("ts").alias("snapshot_timestamp"))
            .select(F.lit(ORG).alias("azure_org"), "*"))


def analysis(work: DataFrame) -> DataFrame:
    """Analysis records from work item ``id`` and ``title`` (quality, copy, blocker, comment presence).

    Row-local: apply it to task rows that already carry these columns (no join)."""
    k = F.col("id")
    has = (k % 4) != 0
    copied = (k % 13) == 0
    q = (k % 11).cast("int")
    label = (F.when(~has, F.lit("missing")).when(copied, F.lit("copy-pasted"))
             .when(q >= 7, F.lit("good")).otherwise(F.lit("vague")))
    return work.select(
        "*", has.alias("has_comment_today"), q.alias("quality_score"), label.alias("quality_label"),
        copied.alias("copy_paste_detected"), ((k % 17) == 0).alias("blocker_detected"),
        F.lit(True).alias("progress_detectable"), F.lit("neutral").alias("sentiment"),
        F.concat(F.lit("What is left on "), F.col("title"), F.lit("?")).alias("suggested_followup"),
    )


def recipients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers; those of one segment have the address that tasks are assigned to, the others one elsewhere."""
    c = read_table(spark, sf_dir, "customer").select("c_name", "c_mktsegment")
    domain = F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("@example.com")).otherwise(F.lit("@partner.example.com"))
    return c.select(F.upper(F.concat(F.lower("c_name"), domain)).alias("email"))


def grader_responses(spark: SparkSession, sf_dir: str, as_of: str = DEFAULT_AS_OF) -> DataFrame:
    """Grader replies: bare, fenced, fenced-with-tag, junk, NULL and incomplete JSON."""
    e = read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "props")
    eid, etype = F.col("event_id"), F.col("event_type")
    pts = F.floor(F.col("value")) % 11
    score = F.concat(pts.cast("string"), F.when(eid % 5 == 0, F.lit(".0")).when(eid % 11 == 0, F.lit(".5")).otherwise(F.lit("")))
    body = F.concat(
        F.lit('{"quality_score": '), score,
        F.lit(', "quality_label": "'), F.when(pts >= 7, F.lit("good")).otherwise(F.lit("vague")),
        F.lit('", "blocker_detected": '), F.when(etype == "error", F.lit("true")).otherwise(F.lit("false")),
        F.lit(', "progress_detectable": '), F.when(etype == "purchase", F.lit("true")).otherwise(F.lit("false")),
        F.lit(', "sentiment": '), F.when(eid % 7 == 0, F.lit("null")).when(etype == "error", F.lit('"negative"')).otherwise(F.lit('"positive"')),
        F.lit(', "suggested_followup": "What changed in '), etype, F.lit('?"}'))
    m = eid % 6
    raw = (F.when(m == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```")))
           .when(m == 1, F.concat(F.lit("  ```\n"), body, F.lit("\n```  ")))
           .when(m == 2, body)
           .when(m == 3, F.concat(F.lit("Sorry, I cannot grade this: "), F.col("props")))
           .when(m == 4, F.lit(None).cast("string"))
           .otherwise(F.concat(F.lit('{"quality_score": '), score, F.lit("}"))))
    return e.select(F.lit(ORG).alias("org"), eid.alias("response_id"), F.col("user_id").alias("work_item_id"), as_of_ts(as_of).alias("as_of"),
                    F.lit("grade").alias("kind"), raw.alias("raw"))


@dataclass
class TrackerInputs:
    """The landed inputs of one daily run."""

    iterations: DataFrame
    stories: DataFrame
    links: DataFrame
    work_items: DataFrame
    comments: DataFrame
    history: DataFrame | None = None
    responses: DataFrame | None = None


def tracker_inputs(spark: SparkSession, sf_dir: str, as_of: str = DEFAULT_AS_OF) -> TrackerInputs:
    return TrackerInputs(
        iterations=iterations(spark, sf_dir, as_of), stories=stories(spark, sf_dir), links=links(spark, sf_dir),
        work_items=work_items(spark, sf_dir, as_of), comments=comments(spark, sf_dir),
        history=snapshot_history(spark, sf_dir),
    )
