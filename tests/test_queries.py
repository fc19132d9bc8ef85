"""Every registered query against its SQL on the smallest tables, and independence of partitioning."""

import pytest

import __spark_entry__ as entry
from sft_tables.operators import chat
from sft_tables.plans import fixtures
from tests import oracle

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    if name in ORACLES:
        problem = oracle.compare(spark, con, name, QUERIES[name], ORACLES[name], SF)
        assert problem in (None, "both empty"), problem
    else:
        assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 11


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("block", [1, 2, 3])
def test_conversation_blocks_do_not_matter(spark, block):
    turns = fixtures.turns(spark, SF).repartition(40)
    for fn in (chat.validate_turns, chat.expand_turns):
        assert sorted(fn(turns, block=block).collect(), key=str) == sorted(fn(turns.repartition(1)).collect(), key=str)
