"""Every registered query against its SQL twin."""

import oracle_compare
import pytest

import __spark_entry__ as entry_module

QUERIES = entry_module.QUERIES
ORACLE = entry_module.ORACLE


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle_compare.connect(sf_dir)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    assert oracle_compare.differences(QUERIES[name](spark, sf_dir), con, ORACLE[name]) is None


SQL_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN"}


def test_column_types_match(spark, sf_dir, con):
    wrong = {}
    for name, query in QUERIES.items():
        ours = {c: SQL_TYPES.get(t, t.upper()) for c, t in query(spark, sf_dir).dtypes}
        result = con.sql(ORACLE[name])
        theirs = {c: str(t) for c, t in zip(result.columns, result.types)}
        if ours != theirs:
            wrong[name] = {c: (ours.get(c), theirs.get(c)) for c in ours.keys() | theirs.keys() if ours.get(c) != theirs.get(c)}
    assert not wrong


def test_entry(spark):
    assert "sold_date" in entry_module.entry(spark).columns
