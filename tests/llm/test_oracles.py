"""Queries with an SQL twin, and the shape of all of them."""

import oracle_compare
import pytest

import __spark_entry__ as entry_module
from shelfmark.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_twin(spark, sf_dir, name):
    assert oracle_compare.differences(QUERIES[name](spark, sf_dir), oracle_compare.connect(sf_dir), ORACLE[name]) is None


def test_all_ten_and_the_pipeline_are_registered():
    names = entry_module.queries()
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert "pipeline" in names
