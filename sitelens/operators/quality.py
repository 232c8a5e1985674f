"""Single-pass data-quality gate (Q0-Q7, T4).

Every rule is one expression of a single aggregation, so the whole gate costs
one scan however many rules there are.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sitelens.operators.clean import fill_zero, in_range, violates
from sitelens.sources.contracts import missing_columns


@dataclass
class Gate:
    """Rules of a gate. ``min_rows``: (name, n) -> passes when rows > n.
    ``row_rules``: (name, predicate, columns) -> passes when the predicate
    holds on every row (a NULL result counts as a violation); a rule whose
    ``columns`` do not all exist is not evaluated and fails.
    ``required``: column names that must exist."""
    min_rows: list[tuple[str, int]] = field(default_factory=list)
    row_rules: list[tuple[str, Column, list[str]]] = field(default_factory=list)
    required: list[str] = field(default_factory=list)


# The reference gate's coordinate box (inclusive) and its size
# rules (rows must exceed these counts).
LAT_RANGE = (41, 47)
LON_RANGE = (-125, -116)
MIN_ROWS = [("not_empty", 0), ("min_rows", 10)]


class GateFailed(AssertionError):
    pass


def _aggs(df: DataFrame, gate: Gate) -> list[Column]:
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, (_, pred, cols) in enumerate(gate.row_rules):
        known = not missing_columns(df, cols)
        aggs.append((F.count_if(violates(pred)) if known else F.max(F.lit(None).cast("bigint"))).alias(f"__v{i}"))
    return aggs


def quality_gate(df: DataFrame, gate: Gate) -> DataFrame:
    """Rows ``(rule, observed, passed)`` plus a final ``gate`` row; observed is
    the row count for size rules, the number of violating rows for row rules
    and the number of missing columns for the column rule."""
    return _verdict(df.agg(*_aggs(df, gate)), gate, missing_columns(df, gate.required))


def _verdict(counts: DataFrame, gate: Gate, missing: list[str]) -> DataFrame:
    """The rows of a gate from its one row of counts."""
    rows = []
    for name, n in gate.min_rows:
        rows.append(F.struct(F.lit(name).alias("rule"), F.col("__rows").alias("observed"),
                             (F.col("__rows") > n).alias("passed")))
    if gate.required:
        rows.append(F.struct(F.lit("required_columns").alias("rule"),
                             F.lit(len(missing)).cast("bigint").alias("observed"),
                             F.lit(not missing).alias("passed")))
    for i, (name, _, _) in enumerate(gate.row_rules):
        v = F.col(f"__v{i}")
        rows.append(F.struct(F.lit(name).alias("rule"), v.alias("observed"), F.coalesce(v == 0, F.lit(False)).alias("passed")))
    failed = sum(F.when(r["passed"], 0).otherwise(1) for r in rows)
    rows.append(F.struct(F.lit("gate").alias("rule"), failed.cast("bigint").alias("observed"),
                         (failed == 0).alias("passed")))
    return counts.select(F.inline(F.array(*rows)))


def enforce(result: DataFrame) -> None:
    """Raise :class:`GateFailed` when the gate row did not pass (reads the
    few result rows only)."""
    bad = [r["rule"] for r in result.filter(~F.col("passed")).select("rule").collect()]
    if bad:
        raise GateFailed(f"quality gate failed: {bad}")


def observe_gate(df: DataFrame, gate: Gate, name: str = "quality_gate"):
    """The gate's counts as metrics riding on another action (a write):
    returns (observed DataFrame, Observation); ``observed_gate`` turns the
    metrics into the gate's rows when the action is done."""
    obs = Observation(name)
    return df.observe(obs, *_aggs(df, gate)), obs


def observed_gate(df: DataFrame, gate: Gate, obs: Observation) -> DataFrame:
    """The rows that ``quality_gate(df, gate)`` would give, from the metrics
    of a finished action: no data is read again."""
    found = obs.get
    counts = df.sparkSession.range(1).select(*[
        F.lit(found[n]).cast("bigint").alias(n) for n in ["__rows", *[f"__v{i}" for i in range(len(gate.row_rules))]]])
    return _verdict(counts, gate, missing_columns(df, gate.required))


def site_gate(lat: str = "latitude", lon: str = "longitude", total: str = "total_patients",
              uninsured: str = "uninsured", medicaid_share: str = "pct_medicaid",
              name: str = "organization", lat_range=LAT_RANGE, lon_range=LON_RANGE, fill: bool = False) -> Gate:
    """The reference gate (Q1-Q6) for a joined site table. ``fill``: missing
    counts are taken as 0 inside the rules, for a table that was not patched
    before (``patch_for_gate``)."""
    count = lambda c: F.coalesce(F.col(c), F.lit(0.0)) if fill else F.col(c)
    return Gate(
        min_rows=list(MIN_ROWS),
        required=[lat, lon, total, medicaid_share, name],
        row_rules=[
            ("coordinates_in_bounds", in_range(lat, *lat_range) & in_range(lon, *lon_range), [lat, lon]),
            ("uninsured_le_total", ~(count(uninsured) > count(total)), [uninsured, total]),
            ("non_negative_total", count(total) >= 0, [total]),
        ])


def patch_for_gate(df: DataFrame, cols=("total_patients", "uninsured", "medicaid")) -> DataFrame:
    """Q0: unmatched rows get 0 in the count columns before testing."""
    return fill_zero(df, [c for c in cols if c in df.columns])


def required_fields(records: DataFrame, fields=("href", "title", "text")) -> DataFrame:
    """T4: every search record has a non-empty ``href``, ``title``, ``text``."""
    rules = [(f"{f}_present", F.col(f).isNotNull() & (F.col(f) != ""), [f]) for f in fields]
    return quality_gate(records, Gate(min_rows=[("not_empty", 0)], row_rules=rules,
                                      required=list(fields)))
