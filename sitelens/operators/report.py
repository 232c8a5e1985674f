"""Report tables: KPI row, payer mix, shares, map layer, sorted and paged
views, samples (A6-A8, P16, L1-L3)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitelens.functions.fmt import fmt_count, fmt_pct
from sitelens.functions.numeric import residual
from sitelens.operators.grain import sum_at_grain
from sitelens.operators.stats import attach
from sitelens.session import stored

# The residual category of the payer mix, the long-format
# column names and the formatted hover-field labels of the report.
OTHER_LABEL = "Other (Private/Medicare)"
CATEGORY, VALUE = "Category", "Patients"
COUNT_LABEL, SHARE_LABEL = "Patients (fmt)", "Medicaid %"


def kpi_row(df: DataFrame, key: str, order: str, name: str, measure: str,
            distinct: str = "exact") -> DataFrame:
    """``sites`` (rows), ``organizations`` (distinct ``name``) and
    ``patients`` (grain-safe sum of ``measure``: first row per ``key``), one
    row from one scan.

    Rows are first aggregated per (key, name) with map-side partial
    aggregation; the group holding each key's first row is flagged with a
    window over those (few) groups; one global aggregate finishes.
    ``distinct="approx"`` counts names with ``approx_count_distinct`` (HLL++,
    fixed-size state) instead of exactly.
    """
    groups = df.groupBy(key, name).agg(
        F.count(F.lit(1)).alias("__n"), F.min(order).alias("__o"),
        F.min_by(measure, order).alias("__m"))
    first = F.row_number().over(Window.partitionBy(key).orderBy("__o")) == 1
    groups = groups.withColumn("__first", first)
    return groups.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("sites"),
        (F.count_distinct(F.col(name)) if distinct == "exact"
         else F.approx_count_distinct(F.col(name))).alias("organizations"),
        F.coalesce(F.sum(F.when(F.col("__first"), F.col("__m"))), F.lit(0.0)).alias("patients"))


def share_of_total(df: DataFrame, value: str, by: list[str] | None = None,
                   out: str = "share") -> DataFrame:
    """``value / sum(value)`` over all rows (or within ``by``); a zero
    total gives NULL. The input is stored first, so that what it aggregates is
    read once; the overall total is a scalar subquery over the stored rows,
    per-group totals are joined back on the group keys."""
    df = stored(df, "shares")
    if not by:
        tot = df.agg(F.sum(value).alias("__total"))
        joined = attach(df, tot)
    else:
        tot = df.groupBy(*by).agg(F.sum(value).alias("__total"))
        joined = df.join(tot, by, "left")
    return (joined.withColumn(out, F.try_divide(F.col(value), F.col("__total")))
            .drop("__total"))


def payer_mix(df: DataFrame, key: str, order: str, total: str,
              parts: dict[str, str], other_label: str = OTHER_LABEL,
              category: str = CATEGORY, value: str = VALUE) -> DataFrame:
    """A7 + A8: grain-safe totals of each part plus the residual, one row per
    category with its share of their sum (NULL when the sum is 0). The
    shares are computed inside the single aggregated row, so the input is
    read once."""
    cols = [total, *parts.values()]
    return mix_rows(sum_at_grain(df, key, order, cols), total, parts, other_label, category, value)


def mix_rows(sums: DataFrame, total: str, parts: dict[str, str], other_label: str = OTHER_LABEL,
             category: str = CATEGORY, value: str = VALUE) -> DataFrame:
    """The payer mix from one row of sums."""
    values = [(label, F.col(c)) for label, c in parts.items()]
    values.append((other_label, residual(total, *parts.values())))
    denom = reduce(lambda a, b: a + b, [v for _, v in values])
    rows = [F.struct(F.lit(label).alias(category), v.alias(value),
                     F.try_divide(v, denom).alias("share")) for label, v in values]
    return sums.select(F.inline(F.array(*rows)))


def map_layer(df: DataFrame, lat: str, lon: str, size: str, color: str, title: str,
              hover: dict[str, bool]) -> DataFrame:
    """Position, size and colour measures, the hover title and only the
    hover fields flagged True."""
    shown = [c for c, on in hover.items() if on]
    return df.select(F.col(lat).alias("lat"), F.col(lon).alias("lon"),
                     F.col(size).alias("size"), F.col(color).alias("color"),
                     F.col(title).alias("hover_title"), *shown)


def with_tooltips(df: DataFrame, count_col: str, pct_col: str,
                  count_label: str = COUNT_LABEL, pct_label: str = SHARE_LABEL) -> DataFrame:
    """Formatted copies of a count and a share for hover text (K6, K7)."""
    return df.withColumns({count_label: fmt_count(count_col), pct_label: fmt_pct(pct_col)})


def top_k(df: DataFrame, by: str, k: int, tiebreak: list[str]) -> DataFrame:
    """L2: the k rows with the largest numeric ``by`` (NULLs last), ties broken
    by ``tiebreak``. Planned as a per-partition top-k then a merge."""
    return df.orderBy(F.col(by).desc_nulls_last(), *tiebreak).limit(k)


def page(df: DataFrame, order: list[str], number: int, size: int) -> DataFrame:
    """L3: page ``number`` (1-based) of ``size`` rows under a total order."""
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


def page_after(df: DataFrame, order: list[str], last: tuple | None, size: int) -> DataFrame:
    """L3 keyset paging: the rows strictly after ``last`` (the order-key
    values of the previous page's last row), ascending order, NULLs first as
    in the order itself."""
    if last is not None:
        same, cond = F.lit(True), F.lit(False)
        for name, value in zip(order, last, strict=True):
            c = F.col(name)
            cond = cond | (same & (c.isNotNull() if value is None else F.coalesce(c > F.lit(value), F.lit(False))))
            same = same & (c.isNull() if value is None else F.coalesce(c == F.lit(value), F.lit(False)))
        df = df.filter(cond)
    return df.orderBy(*order).limit(size)


PART = "__part"


class RankIndex:
    """L3 for deep pages: a table dealt into ranges of an order and stored so,
    with the number of rows of each range. A page is the few ranges that hold
    its rows: nothing before them is read or sorted."""

    def __init__(self, df: DataFrame, order: list[str], parts: int | None = None):
        """Store ``df`` by ranges of the total order ``order``."""
        self.order = order
        dealt = df.repartitionByRange(*([parts] if parts else []), *order)
        dealt = dealt.withColumn(PART, F.spark_partition_id())
        self.rows = stored(dealt, "ranks", partition_by=[PART])
        self.parts = self.rows.groupBy(PART).agg(F.count(F.lit(1)).alias("n"))

    def starts(self) -> list[tuple[int, int, int]]:
        """(part, rows before it, rows) of every range: one small row each."""
        out, before = [], 0
        for r in self.parts.orderBy(PART).collect():
            out.append((r[PART], before, r["n"]))
            before += r["n"]
        return out

    def page(self, offset: int, size: int) -> DataFrame:
        """The ``size`` rows from rank ``offset`` (0-based) on."""
        held = [(p, before) for p, before, n in self.starts() if before < offset + size and before + n > offset]
        rows = self.rows.filter(F.col(PART).isin([p for p, _ in held])).drop(PART)
        return rows.orderBy(*self.order).offset(offset - held[0][1] if held else 0).limit(size)


def sample_n(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """L1: n rows drawn without replacement (fewer if fewer exist): those
    whose key hashes lowest under the seed, so a rerun draws the same."""
    draw = F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(f"|{seed}")))
    return df.orderBy(draw, key).limit(n)
