"""Comment assembly: lookback scan, today/recent split, one row per task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workpulse.functions.dates import as_of_ts, is_on_as_of_date, parse_iso
from workpulse.functions.text import image_urls, pipe_join, strip_html
from workpulse.params import Params

#: Two orgs may use the same work item number.
ITEM = ("org", "work_item_id")


def current_comments(landed: DataFrame) -> DataFrame:
    """The newest landed version of each comment (org, work item, id); redeliveries collapse, edits win.

    Versions landed at the same instant: the greatest position, then text. A
    comment without id is its own identity (by its content). One max per
    comment, combined on the map side.
    """
    key = F.coalesce("id", F.xxhash64("text", "createdDate", "createdBy"))
    rest = [c for c in landed.columns if c not in ("org", "work_item_id")]
    order = F.struct("landed_at", "pos", F.coalesce("text", F.lit("")))
    return (landed.withColumn("_key", key).groupBy("org", "work_item_id", "_key")
            .agg(F.max_by(F.struct(*rest), order).alias("v")).select("org", "work_item_id", "v.*"))


def recent_comments(comments: DataFrame, as_of: str, p: Params) -> DataFrame:
    """Comments with a created date no older than the lookback instant, cleaned.

    Future-dated comments are kept, as in the reference. Rows whose created
    date does not parse are dropped.
    """
    created = parse_iso(F.col("createdDate"))
    cutoff = as_of_ts(as_of) - F.make_dt_interval(days=F.lit(p.lookback_days))
    c = (comments.where(F.col("createdDate").isNotNull() & (F.col("createdDate") != ""))
         .withColumn("created_ts", created)
         .where(F.col("created_ts") >= cutoff))
    return c.select(
        "org", "work_item_id", "pos", F.col("id").alias("comment_id"),
        strip_html(F.col("text")).alias("text"),
        image_urls(F.col("text")).alias("image_urls"),
        F.coalesce(F.col("createdBy.displayName"), F.lit("")).alias("author_name"),
        F.coalesce(F.col("createdBy.uniqueName"), F.lit("")).alias("author_email"),
        "created_ts",
        is_on_as_of_date(F.col("created_ts"), as_of).alias("is_today"),
    )


def _newest_first_key():
    # Newest first, ties kept in payload order (O1): larger is earlier in the list.
    return F.struct(F.col("created_ts"), (-F.col("pos")).alias("neg_pos"))


def comment_rollup(recent: DataFrame) -> DataFrame:
    """One row per task: today flags, latest today comment, recent count and authors.

    Everything is an associative aggregate (map-side partial aggregation), so a
    task with a huge number of comments never becomes one in-memory group. The
    author list is built from per-(task, author) rows, bounded by distinct authors.
    """
    latest = F.struct("text", "image_urls", "author_name", "author_email", "created_ts")
    main = (recent.withColumn("k", _newest_first_key()).withColumn("latest", latest)
            .groupBy(*ITEM)
            .agg(F.bool_or("is_today").alias("has_comment_today"),
                 F.expr("max_by(latest, k) FILTER (WHERE is_today)").alias("today"),
                 F.count_if(~F.col("is_today")).cast("int").alias("recent_comment_count")))
    authors = (recent.where(~F.col("is_today"))
               .groupBy(*ITEM, "author_name").agg(F.max(_newest_first_key()).alias("first_seen"))
               .groupBy(*ITEM)
               .agg(F.sort_array(F.collect_list(F.struct("first_seen", "author_name")), asc=False).alias("a")))
    authors = authors.select(*ITEM,
                             pipe_join(F.transform("a", lambda x: x["author_name"])).alias("recent_comment_authors"))
    return main.join(authors, list(ITEM), "left").select(
        *ITEM, "has_comment_today",
        F.col("today.text").alias("today_comment_text"),
        F.col("today.image_urls").alias("today_image_urls"),
        F.col("today.author_name").alias("today_comment_author_name"),
        F.col("today.author_email").alias("today_comment_author_email"),
        F.col("today.created_ts").alias("today_comment_ts"),
        "recent_comment_count", "recent_comment_authors",
    )


def attach_comments(items: DataFrame, rollup: DataFrame) -> DataFrame:
    """Tasks left-joined to their comment rollup; no comments -> empty defaults."""
    j = items.join(rollup.withColumnRenamed("work_item_id", "id"), ["org", "id"], "left")
    return j.withColumns({
        "has_comment_today": F.coalesce("has_comment_today", F.lit(False)),
        "today_image_urls": F.coalesce("today_image_urls", F.array().cast("array<string>")),
        "recent_comment_count": F.coalesce("recent_comment_count", F.lit(0)),
    })


def similarity_docs(recent: DataFrame, tasks: DataFrame | None = None) -> DataFrame:
    """Rows for the copy-paste check: each task's latest today comment and its non-today comments.

    key = struct(org, work_item_id), doc = comment id: unique within a task
    whatever payload a comment came in. ``tasks`` (org, id) restricts the rows.
    """
    w = recent.withColumn("k", _newest_first_key()).withColumn(
        "doc", F.coalesce("comment_id", F.xxhash64("text", "created_ts", "pos")))
    if tasks is not None:
        w = w.join(tasks.select("org", F.col("id").alias("work_item_id")).distinct(), list(ITEM), "left_semi")
    key = F.struct(*ITEM).alias("key")
    today = (w.where("is_today").groupBy(*ITEM)
             .agg(F.max_by(F.struct("doc", "text"), F.col("k")).alias("t"))
             .select(key, F.col("t.doc").alias("doc"), F.lit(True).alias("is_today"), F.col("t.text").alias("text")))
    past = w.where(~F.col("is_today")).select(key, "doc", F.lit(False).alias("is_today"), "text")
    return today.unionByName(past)
