"""Every registered query against its SQL oracle on the smallest tables."""

import pytest

from checks.compare import compare, oracle_connection
from checks.oracles import ORACLES
from checks.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(FOLDER)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_oracle(spark, oracle, name):
    problem, _ = compare(spark, oracle, FOLDER, name)
    assert problem == ""
