import pytest

from cairnlake.operators import quality
from helpers import rows


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [("a", "x"), ("a", "x"), ("b", None), (None, None), (None, None)], "k string, l string"
    )


def test_unique_key(table):
    assert rows(quality.unique_key(table, ["k", "l"], "u")) == {("u", "a", "x", 2): 1, ("u", None, None, 2): 1}


def test_non_null(table):
    assert rows(quality.non_null(table, ["k", "l"], "n")) == {("n", "l", 1): 1, ("n", "k,l", 2): 1}
    assert quality.null_rows(table, ["l"]).count() == 3


def test_enforce(table):
    quality.enforce(quality.non_null(table.where("k = 'a'"), ["k", "l"], "n"))
    with pytest.raises(quality.AssertionFailed, match="'n'"):
        quality.enforce(quality.non_null(table, ["k"], "n"))
