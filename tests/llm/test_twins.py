"""Registered queries against their SQL twins."""

import pytest

from cairnlake.llm import oracle, queries
from check_oracle import compare, oracle_connection

FOLDER = "/root/testdata/sf0.001"


def test_all_are_registered():
    numbers = [int(n[2:].split("_")[0]) for n in queries.queries() if n != "pipeline"]
    assert sorted(numbers) == list(range(1, 14)) and "pipeline" in queries.queries()


@pytest.mark.parametrize("name", list(oracle.oracle_sql()))
def test_query_equals_sql(spark, name):
    _, problem = compare(spark, oracle_connection(FOLDER), FOLDER, name)
    assert problem is None, problem
