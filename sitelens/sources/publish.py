"""Published tables that readers can trust: versions and a pointer.

A publication is a folder of tables. Each run writes its tables into a version
folder of its own; when all of them are complete, one small pointer file is
replaced by a rename, and from then on readers find the new version. A job that
dies earlier leaves the pointer, and so the last good version, as it was. The
last ``keep`` versions stay, so that readers that started on an older one can
finish.

The pointer goes through Hadoop's file system interface, so a publication can
lie in any store that Spark writes to.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from sitelens.sources.readers import write_table

POINTER, VERSIONS = "_current", "_versions"


class NothingPublished(FileNotFoundError):
    pass


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def published_versions(spark: SparkSession, root: str) -> list[str]:
    """The versions that the pointer names: the one that readers follow, then
    those published before it that are still kept."""
    return (_read_text(spark, f"{root.rstrip('/')}/{POINTER}") or "").split()


def current_version(spark: SparkSession, root: str) -> str | None:
    """Name of the version that readers follow, None before the first."""
    return next(iter(published_versions(spark, root)), None)


def versions(spark: SparkSession, root: str) -> list[str]:
    """All version folders, oldest first, unfinished ones included."""
    fs, p = _fs(spark, f"{root}/{VERSIONS}")
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


class Publication:
    """A version being written; a context manager that publishes it when the
    block ends and leaves the last one in place when it fails."""

    def __init__(self, spark: SparkSession, root: str, keep: int = 2):
        stamp = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
        self.spark, self.root, self.keep = spark, root.rstrip("/"), max(keep, 1)
        self.version = f"{stamp}-{uuid.uuid4().hex[:8]}"
        self.folder = f"{self.root}/{VERSIONS}/{self.version}"

    def write(self, df: DataFrame, name: str, **options) -> DataFrame:
        """Write one table of the version and read it back."""
        write_table(df, f"{self.folder}/{name}", **options)
        return self.read(name) if options.get("fmt", "parquet") == "parquet" else df

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def publish(self) -> None:
        """Let readers follow this version, then drop what is older than the
        last ``keep`` published ones (what jobs that died left included)."""
        kept = [self.version, *published_versions(self.spark, self.root)][:self.keep]
        new = f"{self.root}/{POINTER}.{self.version}"
        _write_text(self.spark, new, "\n".join(kept))
        jvm = self.spark.sparkContext._jvm
        _, source = _fs(self.spark, new)
        _, target = _fs(self.spark, f"{self.root}/{POINTER}")
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        flags = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        flags[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context.rename(source, target, flags)
        for old in versions(self.spark, self.root):
            if old < min(kept):
                self.discard(old)

    def discard(self, version: str | None = None) -> None:
        fs, p = _fs(self.spark, f"{self.root}/{VERSIONS}/{version or self.version}")
        fs.delete(p, True)

    def __enter__(self) -> Publication:
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is None:
            self.publish()
        elif issubclass(kind, Exception):
            self.discard()


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the current version. The frame stays on that version even
    when a later one is published."""
    version = current_version(spark, root.rstrip("/"))
    if version is None:
        raise NothingPublished(root)
    return spark.read.parquet(f"{root.rstrip('/')}/{VERSIONS}/{version}/{name}")
