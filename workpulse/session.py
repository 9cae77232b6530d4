"""Session helpers: UTC session time zone, checkpoint folder, size-checked broadcast, generated code that the JVM compiles."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(master: str | None = None, app: str = "workpulse", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session for local runs and tests. On a cluster, use the cluster's session."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.driver.memory": "8g",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """All day arithmetic is defined in UTC; joins broadcast only on measured sizes.

    Static, estimate-based broadcast is off (estimates after ``explode`` or an
    aggregation can be far off, and a wrong guess is a driver OOM at scale).
    AQE still converts a join to broadcast at runtime when the *materialized*
    shuffle side is below ``spark.sql.adaptive.autoBroadcastJoinThreshold``, and
    ``join_small`` broadcasts after its bounded row probe.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "10MB")


#: Bytes of the largest method that the JVM compiles; a larger one is interpreted row by row, however many rows there are.
JIT_LIMIT = "8000"


@contextlib.contextmanager
def compiled_methods(spark: SparkSession):
    """Within it, plans whose generated methods exceed ``JIT_LIMIT`` (wide task rows) run operator by operator instead."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, JIT_LIMIT)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only in local mode, when the setting is absent (tests), a private folder is
    created; a cluster run without the setting fails instead of using a
    machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/ABFS) for cluster runs")
        configured = tempfile.mkdtemp(prefix="workpulse-ckpt-", dir=os.environ.get("WORKPULSE_TMP", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def stage_table(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Computed once, survives lost executors, cuts the lineage, and (unlike a
    checkpoint) later readers prune columns and push filters into it.
    ``label`` becomes the Spark job description (event log, history server).
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    path = f"{checkpoint_dir(spark).rstrip('/')}/{label.replace(' ', '-')}-{uuid.uuid4().hex}"
    previous = sc.getLocalProperty("spark.job.description")
    sc.setLocalProperty("spark.job.description", f"workpulse: {label}")
    try:
        df.write.parquet(path)
    finally:
        sc.setLocalProperty("spark.job.description", previous)
    return spark.read.schema(df.schema).parquet(path)


#: Older name, used by the daily run's stages.
cut_lineage = stage_table


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a scan that arrived in fewer partitions than the session has cores.

    A large input already arrives in many splits and is returned unchanged; a
    thin one (e.g. one Parquet row group) would otherwise run its CPU-heavy row
    work (regex, tokenising) in a single task.
    """
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
        thin = df.rdd.getNumPartitions() < cores
    except Exception:  # sessions without RDD access (e.g. Spark Connect): leave the scan as it is
        return df
    return df.repartition(cores) if thin else df


def fits_broadcast(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (bounded probe, never a full count)."""
    return df.limit(max_rows + 1).count() <= max_rows


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner", max_rows: int = 100_000,
               known_small: bool | None = None) -> DataFrame:
    """Join with ``small`` broadcast only when its row count is proven below ``max_rows``.

    Above the bound the join is left to the planner (sort-merge, or AQE's
    runtime, size-checked broadcast conversion). ``known_small`` passes the
    result of an earlier probe of the same rows.
    """
    if fits_broadcast(small, max_rows) if known_small is None else known_small:
        return big.join(F.broadcast(small), on, how)
    return big.join(small, on, how)
