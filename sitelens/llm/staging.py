"""Tables written between the steps of an operator, and row keys."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.session import checkpoint_dir


def shared_folder(spark: SparkSession) -> str:
    """This application's folder in ``spark.checkpoint.dir``, which all
    executors share (a session in one process without that setting gets a
    folder of its own)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/sitelens-llm-{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: later
    steps see one fixed result, and a lost executor costs a reread only."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Hand at most BATCH_BYTES at a time to Python tasks: the session's Arrow
    batches, by rows alone, hold tens of megabytes of long texts several times
    over (in the executor, the worker, and as Python strings)."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = re.fullmatch("([0-9]+)b?", spark.conf.get(name))
    if not now or int(now.group(1)) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def remove_staged(spark: SparkSession) -> None:
    """Delete this application's tables and archives below the shared folder
    (at the end of a job; frames read from them are gone then)."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else (``lower`` also changes other letters)."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
