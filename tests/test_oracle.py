"""Every query against its DuckDB oracle at sf0.01 (those of the training-data
operators have tests of their own)."""

import pytest

from scripts.check_oracle import compare, duck_con

from conftest import SF01

from tomewise.queries import ORACLE
from tomewise.queries import QUERIES as CORE

@pytest.fixture(scope="module")
def con():
    return duck_con(SF01)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, con, name):
    msg = compare(spark, con, name, CORE[name], ORACLE[name], SF01)
    assert ": OK" in msg, msg


def test_every_query_of_the_reference_is_checked():
    assert not set(CORE) - set(ORACLE)
