"""Every registered query against its SQL on the given tables."""

import pytest
from comparing import compare, connect

from __spark_entry__ import entry
from traitrank.plans.oracle import all_oracles
from traitrank.plans.queries import all_queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_oracles())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_sql(spark, duck, name):
    assert compare(all_queries()[name](spark, SF_DIR), duck, all_oracles()[name]) is None


def test_entry(spark):
    assert entry(spark).columns == ["collection_id", "token_id", "rarity_score", "rank"]
