"""Snapshot fact table on Parquet: create (S7), history read (S6), idempotent upsert.

Layout: ``<path>/snapshot_date=YYYY-MM-DD/bucket=N/*.parquet``; key (org, project,
date, item), bucket by a hash of the key. Writes use dynamic partition
overwrite, so only the (date, bucket) folders that hold a rewritten key are read
and replaced: a rerun of one item touches one bucket of its day. The rows of these
folders that stay are checkpointed into the shared checkpoint folder before the
overwrite, which cuts the lineage to the files being replaced; folders that hold
nothing yet are written directly. What a write has seen (rows, nulls of each NOT
NULL column) is counted by the pass that lists the folders, which reads the key
and the NOT NULL columns only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from workpulse.schemas import SNAPSHOT, SNAPSHOT_KEY, SNAPSHOT_NOT_NULL
from workpulse.session import stage_table

#: Buckets of a day. A table keeps the number it was created with.
BUCKETS = 16
PARTITIONS = ("snapshot_date", "bucket")
STORED = T.StructType([*SNAPSHOT.fields, T.StructField("bucket", T.IntegerType())])

HISTORY_COLUMNS = ("azure_org", "work_item_id", "snapshot_date", "snapshot_timestamp", "comment_quality_score",
                   "eod_compliant", "copy_paste_detected")


def _has_data(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p) and len(fs.listStatus(p)) > 0


def init_table(spark: SparkSession, path: str) -> None:
    """Create the (empty) table folder if absent; idempotent."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        fs.mkdirs(p)


def create_table(spark: SparkSession, path: str, name: str = "task_daily_snapshot") -> None:
    """The typed catalog table over ``path`` with its 40 columns, if absent (S7); create it before the first write.

    Dates and buckets are found in the folders' names, so no partition needs to be registered: after a write,
    ``REFRESH TABLE``. Filters on the date prune folders; the bucket shows as one more column once there are files.
    """
    init_table(spark, path)
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in SNAPSHOT.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet LOCATION '{path}'")


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The whole table with its exact schema (partition values typed as DATE, never inferred)."""
    if not _has_data(spark, path):
        return spark.createDataFrame([], SNAPSHOT)
    return _stored(spark, path).select(*[f.name for f in SNAPSHOT.fields])


def _stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORED).parquet(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """History columns only (S6); the scan reads 7 of 40 columns."""
    return read_snapshot(spark, path).select(*HISTORY_COLUMNS)


def bucket_of() -> Column:
    return F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in SNAPSHOT_KEY]), F.lit(BUCKETS)).cast("int")


def kept_rows(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of the touched folders whose key is not written again."""
    return existing.join(new.select(*SNAPSHOT_KEY), list(SNAPSHOT_KEY), "left_anti").select(*existing.columns)


def merge_rows(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of the touched folders after the upsert: existing minus re-written keys, plus new."""
    return kept_rows(existing, new).unionByName(new.select(*existing.columns))


@dataclass(frozen=True)
class Written:
    """What one write has seen: rows, rows that break a NOT NULL column, nulls of each, and whether it was written."""

    rows: int
    violations: int
    nulls: dict[str, int]
    written: bool


def observed_upsert(spark: SparkSession, path: str, new: DataFrame, staged: bool = False) -> Written:
    """Idempotent write of one run's rows with its metrics.

    The input is computed once, into a stage table; with ``staged`` it comes
    from one already, by column expressions alone, and is read from there. It
    is counted before the write: an empty run and one with a null in a NOT NULL
    column leave the table as it is.
    """
    null = {c: F.col(c).isNull() for c in SNAPSHOT_NOT_NULL}
    broken = F.lit(False)
    for c in null.values():
        broken = broken | c
    rows = new.withColumn("bucket", bucket_of())
    rows = rows if staged else stage_table(rows, "snapshot rows")
    # At most BUCKETS folders for each date of the run.
    seen = rows.groupBy(*PARTITIONS).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(broken).alias("n_broken"),
                                         *[F.count_if(c).alias(f"null_{n}") for n, c in null.items()]).collect()
    n, violations = sum(r["n_rows"] for r in seen), sum(r["n_broken"] for r in seen)
    nulls = {c: k for c in null if (k := sum(r[f"null_{c}"] for r in seen))}
    if not n or violations:
        return Written(n, violations, nulls, False)
    init_table(spark, path)
    touched = [(str(r[0]), r[1]) for r in seen]
    held = [t for t in touched if _has_data(spark, f"{path.rstrip('/')}/snapshot_date={t[0]}/bucket={t[1]}")]
    if held:
        pick = F.lit(False)
        for day in sorted({d for d, _ in held}):
            pick = pick | ((F.col("snapshot_date") == F.lit(day).cast("date")) & F.col("bucket").isin([b for d, b in held if d == day]))
        # Only the rows that stay come from the files being replaced.
        rows = stage_table(kept_rows(_stored(spark, path).where(pick), rows), "snapshot rows kept").unionByName(rows.select(*STORED.fieldNames()))
    # Every row of a run shares one date: the rebalance hint lets AQE split large folders and join small ones.
    (rows.hint("rebalance", *PARTITIONS).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITIONS).parquet(path))
    return Written(n, 0, nulls, True)


def upsert(spark: SparkSession, path: str, new: DataFrame, staged: bool = False) -> int:
    """``observed_upsert`` that fails on a null in a NOT NULL column; returns the number of rows written (0 -> no write, S12)."""
    done = observed_upsert(spark, path, new, staged)
    if done.violations:
        raise ValueError(f"{done.violations} snapshot rows violate a NOT NULL column: {done.nulls}")
    return done.rows


# ---------------------------------------------------------------------------
# Incremental history for the gate (J5 without a full history scan)
# ---------------------------------------------------------------------------

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _valid_states(spark: SparkSession, path: str, state_dir: str) -> list[str]:
    """Dates D whose ``before=D`` state is whole and up to date, ascending.

    Whole: the job that wrote it committed (``_SUCCESS``). Up to date: no file
    of a snapshot partition dated before D is as new as that marker, so a late
    upsert of an earlier day makes all states after it stale. Only file
    listings are read, one per snapshot date.
    """
    p, fs = _fs(spark, state_dir)
    if not fs.exists(p):
        return []
    marks = {}
    for s in fs.listStatus(p):
        mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")
        if s.getPath().getName().startswith("before=") and fs.exists(mark):
            marks[s.getPath().getName().split("=", 1)[1]] = fs.getFileStatus(mark).getModificationTime()
    root, fs = _fs(spark, path)
    newest = {}
    for s in fs.listStatus(root) if marks and fs.exists(root) else []:
        if s.getPath().getName().startswith("snapshot_date="):
            files = [f.getModificationTime() for f in fs.listStatus(s.getPath())]
            newest[s.getPath().getName().split("=", 1)[1]] = max([s.getModificationTime(), *files])
    return sorted(d for d, t in marks.items() if all(changed < t for day, changed in newest.items() if day < d))


def incremental_history(spark: SparkSession, path: str, state_dir: str, as_of: str,
                        include_as_of_date: bool = True) -> DataFrame:
    """Gate history with the same answer as the full scan, reading one row per item plus recent days.

    ``state_dir/before=D`` holds each item's latest compliant row dated before D.
    It is derived from the newest earlier state plus only the snapshot partitions
    since that state (partition pruning on ``snapshot_date``), and written once.
    The result is that state plus the rows dated ``as_of``'s date (the reference
    also reads the run day's own rows; pass ``include_as_of_date=False`` for the
    ``history_before_as_of`` policy). A state that a failed job left, or that is
    older than a snapshot partition it covers, is not used and is built again.
    """
    day = as_of[:10]  # as_of is 'YYYY-MM-DD HH:MM:SS' in UTC
    hist = read_history(spark, path).where(F.col("eod_compliant") & F.col("comment_quality_score").isNotNull())
    dates = _valid_states(spark, path, state_dir)
    target = f"{state_dir.rstrip('/')}/before={day}"
    if day not in dates:
        prior = [d for d in dates if d < day]
        if prior:
            base = spark.read.parquet(f"{state_dir.rstrip('/')}/before={prior[-1]}").select(*HISTORY_COLUMNS)
            delta = hist.where((F.col("snapshot_date") >= F.lit(prior[-1]).cast("date"))
                               & (F.col("snapshot_date") < F.lit(day).cast("date")))
            rows = base.unionByName(delta)
        else:
            rows = hist.where(F.col("snapshot_date") < F.lit(day).cast("date"))
        rec = F.struct(*[c for c in HISTORY_COLUMNS if c not in ("azure_org", "work_item_id")])
        latest = (rows.groupBy("azure_org", "work_item_id")
                  .agg(F.max_by(rec, F.struct("snapshot_date", "snapshot_timestamp")).alias("r"))
                  .select("azure_org", "work_item_id", "r.*").select(*HISTORY_COLUMNS))
        latest.write.mode("overwrite").parquet(target)
    state = spark.read.parquet(target).select(*HISTORY_COLUMNS)
    if not include_as_of_date:
        return state
    return state.unionByName(hist.where(F.col("snapshot_date") == F.lit(day).cast("date")))
