"""Readers and writers.

Schemas are always explicit (no inference): key columns stay text so that
leading zeros survive, numeric text goes through lenient conversion, and NaN
becomes NULL at the boundary.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitelens.operators.clean import nan_to_null_all
from sitelens.session import stored

SEARCH_RECORD = T.StructType([T.StructField(n, T.StringType())
                              for n in ("objectID", "href", "title", "section", "text")])
LISTING = T.StructType([T.StructField("listing", T.StringType()),
                        T.StructField("items", T.ArrayType(T.StringType()))])


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType | str | None = None, on_missing: str = "fail",
               ignore_corrupt: bool = False, **options) -> DataFrame | None:
    """Read one table. ``on_missing="skip"`` returns None for an absent path
    (the stage ends quietly, S8); ``ignore_corrupt`` skips unreadable files
    (S9). CSV defaults: header row, no inference."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        options = {"header": "true", "inferSchema": "false", **options}
    if ignore_corrupt:
        options["ignoreCorruptFiles"] = "true"
    if options:
        reader = reader.options(**{k: str(v) for k, v in options.items()})
    try:
        df = reader.load(path)
    except AnalysisException as e:
        if on_missing == "skip" and "PATH_NOT_FOUND" in str(e):
            return None
        raise
    # text formats only: on parquet the wrapped columns would keep filters from
    # the scan, and what this package writes there has no NaN any more
    return df if fmt in ("parquet", "orc") else nan_to_null_all(df)


CORRUPT = "_corrupt_record"
QUARANTINE = "file string, line string, reason string"


def read_quarantined(spark: SparkSession, path: str, fmt: str, schema: T.StructType | str, **options) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantine): nothing is dropped without a word.

    Text formats (csv, json by lines): a line that does not fit the schema
    becomes a quarantine row (file, line, reason) instead of a row of NULLs.
    Every format: a file of which no row could be read becomes one quarantine
    row, with the reason found in its first bytes (files of no bytes hold
    nothing and are not named). Rows of good files are unaffected. The
    quarantine reads the contents of suspect files only.

    Text formats are parsed once, all columns of every line, into a stored
    stage that both frames read: a scan that needs fewer columns would judge
    lines by those alone.
    """
    kind = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    options = {"header": "true", **options} if fmt == "csv" else options
    file = F.col("_metadata.file_path")
    text = fmt in ("csv", "json")
    reader = spark.read.format(fmt).options(**{k: str(v) for k, v in options.items()}).option("ignoreCorruptFiles", "true")
    if text:
        wide = T.StructType([*kind.fields, T.StructField(CORRUPT, T.StringType())])
        rows = reader.schema(wide).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).load(path)
        rows = stored(rows.select(*kind.fieldNames(), CORRUPT, file.alias("__file")), "parsed")
        good = nan_to_null_all(rows.filter(F.col(CORRUPT).isNull()).drop(CORRUPT, "__file"))
        broken = rows.filter(F.col(CORRUPT).isNotNull()).select(
            F.col("__file").alias("file"), F.col(CORRUPT).alias("line"), F.lit("line does not fit the schema").alias("reason"))
    else:
        rows = reader.schema(kind).load(path)
        good, broken = rows, None
    read = rows.select(file.alias("file") if not text else F.col("__file").alias("file")).distinct()
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    listed = listed.filter(~F.element_at(F.split("path", "/"), -1).rlike("^[_.]"))
    suspect = listed.join(read, F.col("path") == F.col("file"), "left_anti")
    magic = {"parquet": "PAR1", "orc": "ORC"}.get(fmt)
    reason = F.lit("no row could be read")
    if magic:
        marked = F.substring("content", 1, len(magic)) == F.lit(magic).cast("binary")
        reason = F.when(~marked, f"not a {fmt} file").otherwise(reason)
    files = suspect.select(F.col("path").alias("file"), F.lit(None).cast("string").alias("line"), reason.alias("reason"))
    return good, files if broken is None else broken.unionByName(files)


def read_search_records(spark: SparkSession, path: str) -> DataFrame:
    """JSON array of search records."""
    return spark.read.schema(SEARCH_RECORD).option("multiLine", "true").json(path)


def read_listings(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """S5 + S13: listings file flattened to (listing, item). ``lines``: one
    listing a line, as Spark writes them, instead of one array a file."""
    df = spark.read.schema(LISTING).option("multiLine", str(not lines).lower()).json(path)
    return df.select("listing", F.explode("items").alias("item"))


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: list[str] | None = None, **options) -> None:
    """Full refresh (overwrite). CSV exports carry a header, no index."""
    w = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        options = {"header": "true", **options}
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.options(**{k: str(v) for k, v in options.items()}).save(path)


def profile(df: DataFrame, name: str, k: int = 5) -> DataFrame:
    """One row ``(table, rows, first_columns)``."""
    return df.agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows"),
                  F.lit(",".join(df.columns[:k])).alias("first_columns"))


def preview(df: DataFrame, order: list[str], k: int = 5) -> DataFrame:
    """The first k rows by an explicit order."""
    return df.orderBy(*order).limit(k)
