"""Every registered query against its DuckDB twin on the small fixture
(the driver runs the same comparison at sf0.01)."""

import pytest

import __spark_entry__ as E
from compare_oracle import compare, duck
from conftest import SF_SMALL

_CON = {}


@pytest.mark.parametrize("name", sorted(E._QUERIES))
def test_query_matches_oracle(spark, name):
    con = _CON.setdefault("c", duck(SF_SMALL))
    ok, msg = compare(spark, SF_SMALL, name, con)
    assert ok, msg


_TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(E._QUERIES))
def test_query_types_match_oracle(spark, name):
    con = _CON.setdefault("c", duck(SF_SMALL))
    schema = E.queries()[name](spark, SF_SMALL).schema
    spark_types = {f.name: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in schema.fields}
    duck_types = {r[0]: r[1] for r in con.execute("DESCRIBE " + E.oracle_sql()[name]).fetchall()}
    assert spark_types == duck_types


def test_every_query_has_an_oracle():
    assert set(E._QUERIES) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "total_funding_v2_lc" in df.columns
