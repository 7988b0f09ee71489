import pytest

from __spark_entry__ import entry, oracle_sql, queries
from churnflow.plans.catalog import QUERIES
from churnflow.plans.oracle import ORACLE
from tests.oracle import connect, difference

@pytest.fixture(scope="module")
def answers(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_answer():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_answer(spark, sf_dir, answers, name):
    assert difference(QUERIES[name](spark, sf_dir), answers, ORACLE[name]) is None


def test_entry(spark):
    assert entry(spark).where("status = 'failed'").count() == 11
