"""Every registered query: its result against its SQL twin, and the shape of its plan."""

import re

import oracle
import pytest
from conftest import plan_of

import __spark_entry__ as entry_point
from seqloom.plans import QUERIES as OWN

QUERIES = {name: run for name, run in entry_point.queries().items() if name in OWN}
SQL = {name: sql for name, sql in entry_point.oracle_sql().items() if name in OWN}
#: Selectors in vectorised Python; every other query stays in the JVM.
PYTHON = {"selector_batched"}


@pytest.fixture(scope="module")
def con(sf):
    return oracle.connect(sf)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)


def test_entry_has_stable_columns(spark):
    assert entry_point.entry(spark).columns == ["series_title", "gsm_id", "files", "size_gb"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf, con, name):
    result = QUERIES[name](spark, sf)
    assert ("Python" in plan_of(result)) == (name in PYTHON)
    assert not re.search(r"MapIn|Cartesian|NestedLoop", plan_of(result))
    assert oracle.differences(result, con, SQL[name]) == []
