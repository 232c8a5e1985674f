"""Workbook (xlsx) source, S1/S2: one sheet of many workbook files as a
DataFrame of text columns.

Files are listed and read by Spark's ``binaryFile`` source (any Hadoop file
system, one row per file, files spread over tasks); each task unpacks its
workbooks with the standard library (``zipfile`` + streaming XML parse) in
``mapInPandas``. Cells come out as text, exactly as stored: numbers in their
stored decimal form, shared and inline strings, booleans as ``TRUE``/``FALSE``.
Typing is left to the lenient conversion of the cleaning step. Every row
carries ``_file`` and ``_row`` (sheet row number), the explicit order that
keep-first needs.
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from xml.etree import ElementTree as ET

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_PKG_REL = "{http://schemas.openxmlformats.org/package/2006/relationships}"
_CELL_REF = re.compile(r"([A-Z]+)(\d+)")


def _col_index(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _text(el) -> str:
    return "".join(t.text or "" for t in el.iter(f"{_NS}t"))


def _sheet_path(zf: zipfile.ZipFile, sheet: str | None) -> str:
    wb = ET.fromstring(zf.read("xl/workbook.xml"))
    sheets = list(wb.iter(f"{_NS}sheet"))
    if not sheets:
        raise ValueError("workbook has no sheets")
    chosen = sheets[0] if sheet is None else next(
        (s for s in sheets if s.get("name") == sheet), None)
    if chosen is None:
        raise ValueError(f"no sheet named {sheet!r}")
    rid = chosen.get(f"{_REL}id")
    rels = ET.fromstring(zf.read("xl/_rels/workbook.xml.rels"))
    for rel in rels.iter(f"{_PKG_REL}Relationship"):
        if rel.get("Id") == rid:
            target = rel.get("Target")
            return target.lstrip("/") if target.startswith("/") else posixpath.normpath(
                posixpath.join("xl", target))
    raise ValueError(f"sheet relation {rid} not found")


def _shared_strings(zf: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in zf.namelist():
        return []
    root = ET.fromstring(zf.read("xl/sharedStrings.xml"))
    return [_text(si) for si in root.iter(f"{_NS}si")]


def sheet_rows(content: bytes, sheet: str | None = None, max_rows: int | None = None):
    """Yield ``(row_number, [cell text or None, ...])`` for one sheet."""
    with zipfile.ZipFile(io.BytesIO(content)) as zf:
        shared = _shared_strings(zf)
        with zf.open(_sheet_path(zf, sheet)) as fh:
            seen = 0
            for _, el in ET.iterparse(fh, events=("end",)):
                if el.tag != f"{_NS}row":
                    continue
                values: dict[int, str] = {}
                for pos, c in enumerate(el.iter(f"{_NS}c")):
                    ref = c.get("r")
                    m = _CELL_REF.match(ref or "")
                    idx = _col_index(m.group(1)) if m else pos
                    kind = c.get("t")
                    v = c.find(f"{_NS}v")
                    if kind == "s" and v is not None:
                        values[idx] = shared[int(v.text)]
                    elif kind == "inlineStr":
                        is_ = c.find(f"{_NS}is")
                        values[idx] = _text(is_) if is_ is not None else None
                    elif kind == "b" and v is not None:
                        values[idx] = "TRUE" if v.text == "1" else "FALSE"
                    elif v is not None:
                        values[idx] = v.text
                row_no = int(el.get("r")) if el.get("r") else seen + 1
                width = max(values) + 1 if values else 0
                yield row_no, [values.get(i) for i in range(width)]
                el.clear()
                seen += 1
                if max_rows is not None and seen >= max_rows:
                    return


def _header_names(cells: list) -> list[str]:
    """Header cells to unique names ('' -> 'Unnamed: i', repeats -> 'x.1')."""
    out, seen = [], {}
    for i, c in enumerate(cells):
        name = c if c not in (None, "") else f"Unnamed: {i}"
        if name in seen:
            seen[name] += 1
            name = f"{name}.{seen[name]}"
        else:
            seen[name] = 0
        out.append(name)
    return out


def read_workbook(spark: SparkSession, path: str, sheet: str | None = None,
                  glob: str = "*.xlsx", recursive: bool = False,
                  on_error: str = "fail") -> DataFrame:
    """The first (or named) sheet of every workbook under ``path``.

    Row 1 is the header; columns are the union of all files' headers (first
    file's order first), all ``StringType``. Unreadable files (S9): ``fail``
    stops the job, ``skip`` drops them, ``record`` keeps going and adds an
    ``_error`` column with one row per unreadable file (``_row`` 0).
    """
    if on_error not in ("fail", "skip", "record"):
        raise ValueError(f"on_error must be fail, skip or record, not {on_error!r}")
    # ship this module's parsing helpers with the tasks (by value), so
    # executors need not have the package installed
    import sys

    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", str(recursive).lower()).load(path)
             .select("path", "content"))

    def headers(batches):
        import pandas as pd
        for pdf in batches:
            paths, names = [], []
            for p, content in zip(pdf["path"], pdf["content"]):
                try:
                    first = next(sheet_rows(bytes(content), sheet, max_rows=1), (1, []))[1]
                except Exception:  # noqa: BLE001
                    if on_error != "fail":
                        continue
                    raise
                paths.append(p)
                names.append(_header_names(first))
            if paths:
                yield pd.DataFrame({"path": paths, "names": names})

    # the union of header names, each with the first (file, position) where
    # it appears; only the distinct names reach the driver
    heads = files.mapInPandas(headers, "path string, names array<string>")
    firsts = (heads.select("path", F.posexplode("names").alias("pos", "name"))
              .groupBy("name").agg(F.min(F.struct("path", "pos")).alias("first")))
    columns = [r["name"] for r in sorted(firsts.collect(), key=lambda r: tuple(r["first"]))]
    reserved = {"_file", "_row", "_error"}
    if reserved & set(columns):
        raise ValueError(f"header uses reserved names {reserved & set(columns)}")

    schema = T.StructType([T.StructField("_file", T.StringType()), T.StructField("_row", T.IntegerType())]
                          + [T.StructField(c, T.StringType()) for c in columns]
                          + ([T.StructField("_error", T.StringType())] if on_error == "record" else []))

    def rows(batches):
        import pandas as pd
        names_all = schema.fieldNames()

        def frame(recs):
            f = pd.DataFrame(recs, columns=names_all, dtype=object)
            f = f.astype(object).where(f.notna(), None)
            return f.astype({"_row": "int32"})

        for pdf in batches:
            for p, content in zip(pdf["path"], pdf["content"]):
                out = []
                try:
                    it = sheet_rows(bytes(content), sheet)
                    first = next(it, None)
                    if first is None:
                        continue
                    names = _header_names(first[1])
                    for row_no, cells in it:
                        rec = {"_file": p, "_row": row_no}
                        rec.update(zip(names, cells))
                        out.append(rec)
                        if len(out) >= 10_000:
                            yield frame(out)
                            out = []
                except Exception as exc:  # noqa: BLE001
                    if on_error == "fail":
                        raise
                    if on_error == "record":
                        if out:
                            yield frame(out)
                        yield frame([{"_file": p, "_row": 0,
                                      "_error": f"{type(exc).__name__}: {exc}"[:500]}])
                    continue
                if out:
                    yield frame(out)

    return files.mapInPandas(rows, schema)


def strip_cell_text(df: DataFrame) -> DataFrame:
    """Blank-only cells -> NULL (pandas reads them as missing)."""
    return df.withColumns({c: F.when(F.trim(F.col(c)) != "", F.col(c))
                           for c in df.columns if c not in ("_file", "_row", "_error")})
