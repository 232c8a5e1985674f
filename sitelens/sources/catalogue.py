"""Catalogue scan, S12: many small documents with a ``key: value`` header
block between ``---`` lines become catalogue items.

Read with Spark's text source (whole file per row, recursive, glob filter),
so files are spread over tasks; every field is extracted with native string
functions. ``date: last-modified`` takes the file's modification time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.functions.fmt import epoch_ms
from sitelens.functions.text import reading_time, word_count

HEADER = r"(?s)^\s*---[ \t]*\r?\n(.*?)\r?\n---[ \t]*(\r?\n|$)"


def _scalar(header: Column, key: str) -> Column:
    raw = F.regexp_extract(header, rf"(?m)^{key}:[ \t]*(.*?)[ \t]*$", 1)
    quoted = F.regexp_extract(raw, r"""^(["'])(.*)\1""", 2)
    plain = F.trim(F.regexp_replace(raw, r"\s+#.*$", ""))
    value = F.when(raw.rlike(r"""^["']"""), quoted).otherwise(plain)
    return F.when(value != "", value)


def _categories(header: Column) -> Column:
    flow = F.regexp_extract(header, r"(?m)^categories:[ \t]*\[(.*)\][ \t]*$", 1)
    block = F.regexp_extract(header, r"(?m)^categories:[ \t]*\r?\n((?:[ \t]+-[ \t]*.*(?:\r?\n|$))+)", 1)
    from_flow = F.transform(F.split(flow, ","), lambda c: F.trim(F.regexp_replace(c, r"""^\s*["']|["']\s*$""", "")))
    from_block = F.transform(
        F.filter(F.split(block, r"\r?\n"), lambda l: F.trim(l) != ""),
        lambda l: F.trim(F.regexp_replace(F.regexp_replace(l, r"^[ \t]+-[ \t]*", ""), r"""^["']|["']$""", "")))
    return (F.when(flow != "", F.filter(from_flow, lambda c: c != ""))
            .when(block != "", from_block))


def read_catalogue(spark: SparkSession, root: str, glob: str = "index.qmd") -> DataFrame:
    """Items: path, title, subtitle, author, date, date_ms, image,
    description, categories, word_count, reading_time."""
    # keyword arguments: text() would reset an option() of the same name
    files = (spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter=glob)
             .select(F.col("_metadata.file_path").alias("path"),
                     F.col("_metadata.file_modification_time").alias("modified"),
                     F.col("value")))
    header = F.regexp_extract("value", HEADER, 1)
    body = F.regexp_replace("value", HEADER, "")
    date_text = _scalar(header, "date")
    date = (F.when(date_text == "last-modified", F.to_date("modified"))
            .otherwise(F.try_to_date(date_text, "yyyy-MM-dd")))
    items = files.select(
        "path",
        _scalar(header, "title").alias("title"),
        _scalar(header, "subtitle").alias("subtitle"),
        _scalar(header, "author").alias("author"),
        date.alias("date"),
        _scalar(header, "image").alias("image"),
        _scalar(header, "description").alias("description"),
        _categories(header).alias("categories"),
        word_count(body).alias("word_count"))
    return items.withColumns({
        "reading_time": reading_time("word_count"),
        "date_ms": epoch_ms("date"),
    })
