"""Registered queries of the training-data operators against DuckDB on the smallest tables."""

from __future__ import annotations

import oracle
import pytest

import __spark_entry__ as entry_module
from tiffin.llm.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


def test_every_operator_is_registered():
    names = entry_module.queries()
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(names)
    assert set(SQL) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, sf_dir, name):
    difference = oracle.compare(entry_module.queries()[name](spark, sf_dir), con, SQL[name])
    assert difference is None, difference
