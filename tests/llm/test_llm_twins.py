"""Registered queries against their SQL twins, value by value."""

import pytest

from compare import connect, differences
from remitlens.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_twin(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) == []
