"""Session construction and lineage cutting.

Every job in this package is a lazy DataFrame plan; the session settings here
are the ones the plans rely on: ANSI mode (Spark 4 default), UTC session time
zone for epoch/date formatting, and adaptive execution so that joins whose
build side turns out small at run time become broadcast joins, skewed
partitions are split and shuffle partitions are coalesced.
"""

from __future__ import annotations

import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(
    app: str = "sitelens",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_conf(input_bytes: int, total_cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized to the data rather than to a default.

    Scan splits and shuffle partitions target ``partition_bytes`` each (a few
    hundred MB keeps a task's sort/hash buffers within executor memory and
    spills rare), with at least three waves of tasks over the cores; AQE
    then coalesces shuffle partitions that turn out small and splits skewed
    ones. For 100 TB on 1,000 executors x 8 cores that is ~400k shuffle
    partitions upper bound, coalesced at run time.
    """
    shuffle = max(3 * total_cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(partition_bytes // 8),
    }


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster (``spark.checkpoint.dir``).

    On a cluster the folder must be set by the deployment; only a session in
    one process (``local``, ``local[n]``: tests) without one gets a folder of
    its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a cluster job needs a shared "
                "checkpoint folder")
        configured = tempfile.mkdtemp(prefix="sitelens-ckpt-")
    sc.setCheckpointDir(configured)
    return configured


def work_folder(spark: SparkSession) -> str:
    """This application's folder for stage outputs, in the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/sitelens-{spark.sparkContext.applicationId}"


def stored(df: DataFrame, name: str = "stage", partition_by: list[str] | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and a
    lost executor then re-reads files instead of recomputing the lineage."""
    path = f"{work_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*(partition_by or [])).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt to all cores where it has fewer partitions than they are
    (a small input in few row groups), for work that is heavy per row. Inputs
    with enough partitions are left as they are, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def remove_work(spark: SparkSession) -> None:
    """Delete this application's stage outputs (at the end of a job)."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(work_folder(spark))
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    with _LOCK:
        for key in [k for k in _PUBLISHED if k[0] == spark.sparkContext.applicationId]:
            del _PUBLISHED[key]


def signature(spark: SparkSession, paths: list[str]) -> tuple:
    """What the files under ``paths`` look like now: number, size and time of
    the last change. Asks the file system only; no job runs."""
    conf, found = spark.sparkContext._jsc.hadoopConfiguration(), []
    for path in paths:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(conf)
        held = fs.getContentSummary(p)
        found.append((held.getFileCount(), held.getLength(), fs.getFileStatus(p).getModificationTime()))
    return tuple(found)


_PUBLISHED: dict[tuple[str, str], tuple] = {}
_LOCK = threading.RLock()


def published(spark: SparkSession, name: str, build, inputs: list[str]) -> DataFrame:
    """A derived table written once per application and state of its input
    files to the shared folder, and read back by every consumer (the
    pipeline's stage outputs: joined sites, org metrics, search index). It is
    built anew when the files under ``inputs`` have changed.

    The table is deliberately not bucketed by its key: a key holding a third
    of the rows would make one bucket, and so one task of every consumer,
    hold a third of the table. Plain files split evenly over scan tasks and
    consumers collapse hot keys by partial aggregation.
    """
    key = (spark.sparkContext.applicationId, name)
    now = signature(spark, inputs)
    with _LOCK:
        entry = _PUBLISHED.get(key)
        if entry is None or entry[0] != now:
            entry = _PUBLISHED[key] = (now, stored(build(), "published"))
    return entry[1]
