"""Every registered query against its DuckDB text (the external check, run here at sf0.001)."""

import pytest

from pipewright import registry
from pipewright.oracle.compare import compare

from .conftest import SF001, SF01

ORACLES = registry.oracle_sql()
QUERIES = registry.queries()


def test_every_query_has_an_oracle_or_is_listed():
    rows_only = set(QUERIES) - set(ORACLES)
    assert rows_only == set()


SPARK_TO_DUCK = {"IntegerType()": "INTEGER", "LongType()": "BIGINT", "DoubleType()": "DOUBLE",
                 "StringType()": "VARCHAR", "DateType()": "DATE", "BooleanType()": "BOOLEAN",
                 "TimestampNTZType()": "TIMESTAMP"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_parity_sf0001(spark, duck001, name):
    df = QUERIES[name](spark, SF001)
    r = compare(df, duck001, ORACLES[name])
    assert r["ok"], r
    # same column types too (the external check compares schemas)
    st = {f.name: SPARK_TO_DUCK.get(repr(f.dataType), repr(f.dataType)) for f in df.schema.fields}
    rel = duck001.sql(ORACLES[name])
    dt = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert st == dt, {c: (st.get(c), dt.get(c)) for c in set(st) | set(dt) if st.get(c) != dt.get(c)}


@pytest.mark.parametrize("name", ["pipeline_outcome", "coverage_by_region", "renewal_scorecard", "team_velocity"])
def test_parity_sf001_headline(spark, duck01, name):
    r = compare(QUERIES[name](spark, SF01), duck01, ORACLES[name])
    assert r["ok"], r


def test_flatten_columns(spark):
    assert QUERIES["flatten_nested"](spark, SF001).columns == ["name", "c_custkey", "_place", "_orders", "_counts"]

