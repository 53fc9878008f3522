"""Every registered query against its SQL oracle, over the whole tables."""

import pytest

import __spark_entry__ as contract
from checks import oracle, registry
from checks.compare import compare

SF_DIR = "/root/testdata/sf0.01"


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(oracle.statements())


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query_equals_oracle(spark, name):
    same, note = compare(spark, SF_DIR, name)
    assert same, note


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
