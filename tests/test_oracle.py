"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as contract
from cairnlake.testbed import oracle as twins, queries as registered
from check_oracle import compare, oracle_connection

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(FOLDER)


def test_every_query_has_a_twin():
    assert set(registered.queries()) == set(twins.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(registered.queries()))
def test_query_equals_sql(spark, oracle, name):
    _, problem = compare(spark, oracle, FOLDER, name)
    assert problem is None, problem


def test_entry_returns_the_summary(spark):
    summary = contract.entry(spark)
    assert summary.columns == [
        "user_id",
        "billing_country",
        "total_orders",
        "total_lifetime_spend",
        "average_order_value",
        "last_purchase_date",
        "distinct_products_purchased",
        "browsed_categories",
    ]
    assert not summary.isEmpty()
