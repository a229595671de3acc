"""Queries that SQL can express, against that SQL."""

import pytest

from monthspan.llm.queries import ORACLES, QUERIES
from tests.compare import connect, difference
from tests.llm.data import SF


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) is None
