"""Every registered query against its DuckDB oracle on the sf0.001 tables
(the driver runs the same comparison at sf0.01)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from sitelens.plans.registry import REGISTRY
from sitelens.plans.standins import TABLES

SF = "/root/testdata/sf0.001"


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_registered_with_oracle_or_rows_only():
    qs, oracle = E.queries(), E.oracle_sql()
    assert set(oracle) <= set(qs)
    assert set(REGISTRY) <= set(qs) and set(REGISTRY) <= set(oracle)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    cur = con.execute(E.oracle_sql()[name])
    ocols = [c[0] for c in cur.description]
    orows = cur.fetchall()
    srows = [tuple(r) for r in sdf.collect()]
    assert sorted(sdf.columns) == sorted(ocols)
    duck = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
            "BOOLEAN": "boolean", "DATE": "date"}
    otypes = {c[0]: duck.get(str(c[1]), str(c[1])) for c in cur.description}
    assert dict(sdf.dtypes) == otypes
    assert len(srows) == len(orows)
    assert _canon(sdf.columns, srows) == _canon(ocols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["Category", "Patients", "share"] and len(rows) == 3
