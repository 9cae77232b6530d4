"""Newest version of every comment as kept state plus the landings since.

Landings are the ``epoch=<n>`` folders of the landing stream. A state covers
all epochs up to one: a row for each comment, its newest version, partitioned
by the day the comment was created. A daily read takes the newest whole state,
of it only the days that the lookback reaches, and the epochs since; neither
grows with the age of the table. ``compact`` writes the next state and is run
every few epochs.

A state counts only with its job's commit marker and only while no epoch it
covers is newer than the marker: one that a dead job left, or that a replayed
or late epoch overtook, is passed over and the next older one is used with
more epochs, down to none. Its folder's name says which epochs it covers and
the latest landing in it: rows that land later than that overrule any row of
the state, so days before the lookback need not be read to know them stale.
Where an epoch brings an older landing (a late redelivery), the state is read
whole and landing times decide.
"""

from __future__ import annotations

import datetime
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from workpulse.functions.dates import parse_iso
from workpulse.operators.comments import current_comments
from workpulse.schemas import COMMENTS

COLUMNS = [f.name for f in COMMENTS.fields]
DAY = "created_day"
STATE = T.StructType([*COMMENTS.fields, T.StructField(DAY, T.DateType())])


def _committed(spark: SparkSession, folder: str, prefix: str) -> dict[str, tuple[str, int, int]]:
    """Committed subfolders by the rest of their names: (path, newest file, time of the commit marker)."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(folder)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = {}
    for s in fs.listStatus(root) if fs.exists(root) else []:
        name, mark = s.getPath().getName(), hadoop.Path(s.getPath(), "_SUCCESS")
        if name.startswith(prefix) and fs.exists(mark):
            newest = max([s.getModificationTime(), *(f.getModificationTime() for f in fs.listStatus(s.getPath()))])
            out[name[len(prefix):]] = s.getPath().toString(), newest, fs.getFileStatus(mark).getModificationTime()
    return out


def epochs(spark: SparkSession, landing: str) -> dict[int, tuple[str, int]]:
    """Committed landings: epoch -> (path, time of its newest file)."""
    return {int(n): (path, newest) for n, (path, newest, _) in _committed(spark, landing, "epoch=").items()}


def valid_state(spark: SparkSession, landing: str, state_dir: str, upto: int) -> tuple[int, int, str] | None:
    """(last epoch covered, latest landing in microseconds, path) of the newest whole, up-to-date state up to ``upto``."""
    landed = epochs(spark, landing)
    found = []
    for name, (path, _, marked) in _committed(spark, state_dir, "upto=").items():
        last, high = map(int, re.fullmatch(r"(\d+),landed=(-?\d+)", name).groups())
        if last <= upto and all(newest <= marked for e, (_, newest) in landed.items() if e <= last):
            found.append((last, high, path))
    return max(found, default=None)


def read_versions(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All versions in the given landings; only these folders are listed and read."""
    if not paths:
        return spark.createDataFrame([], COMMENTS)
    return spark.read.schema(COMMENTS).parquet(*paths).select(*COLUMNS)


def newest_comments(spark: SparkSession, landing: str, state_dir: str, upto: int, since: datetime.date | None = None) -> DataFrame:
    """The newest version of each comment landed up to epoch ``upto``: what a scan of all landings would give.

    ``since``: only comments created on that day or later (those whose date
    does not parse are left out then, as in the lookback).
    """
    state = valid_state(spark, landing, state_dir, upto)
    later = [path for e, (path, _) in sorted(epochs(spark, landing).items()) if (state is None or e > state[0]) and e <= upto]
    versions = read_versions(spark, later)
    if state is not None:
        kept = spark.read.schema(STATE).parquet(state[2])
        late = versions.where(F.coalesce(F.unix_micros("landed_at"), F.lit(state[1])) <= state[1])
        if since is not None and (not later or late.isEmpty()):
            kept = kept.where(F.col(DAY) >= F.lit(since))  # partitions of earlier days are not read
        versions = kept.select(*COLUMNS).unionByName(versions)
    rows = current_comments(versions).select(*COLUMNS)
    return rows if since is None else rows.where(F.to_date(parse_iso(F.col("createdDate"))) >= F.lit(since))


def compact(spark: SparkSession, landing: str, state_dir: str, upto: int) -> str:
    """Write the state up to an epoch from the last valid one and the epochs since; its path."""
    rows = newest_comments(spark, landing, state_dir, upto)
    before = valid_state(spark, landing, state_dir, upto)
    later = [path for e, (path, _) in epochs(spark, landing).items() if (before is None or e > before[0]) and e <= upto]
    high = read_versions(spark, later).agg(F.max(F.unix_micros("landed_at"))).first()[0]
    high = max(x for x in (high, before and before[1], -(2**62)) if x is not None)
    path = f"{state_dir.rstrip('/')}/upto={upto},landed={high}"
    if before is not None and before[2].rstrip("/").endswith(f"/upto={upto},landed={high}"):
        return path  # already there, whole and up to date
    (rows.withColumn(DAY, F.to_date(parse_iso(F.col("createdDate")))).hint("rebalance", DAY)
     .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(DAY).parquet(path))
    return path
