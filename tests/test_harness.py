"""Every registered query of the library against its SQL statement; those of the optional package are in its own tests."""

from __future__ import annotations

import compare
import pytest

import __spark_entry__ as entry
from haltwerk.harness import oracle, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


def test_every_query_has_an_oracle():
    assert queries.queries().keys() == oracle.oracle_sql().keys()
    assert queries.queries().keys() <= entry.queries().keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()


def test_entry_gives_rows(spark):
    assert not entry.entry(spark).isEmpty()


@pytest.mark.parametrize("name", list(queries.queries()))
def test_query_equals_oracle(spark, con, name):
    assert compare.difference(spark, con, entry.queries()[name], entry.oracle_sql()[name], SF) is None
