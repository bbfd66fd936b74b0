import json
import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from cairnlake.functions import json_text
from helpers import rows

JSON_TEXTS = [
    '{"a":1}', "[1,2]", "123", '"x"', "null", "true", ' {"a": 1.50}\n', '{"a":1,"a":2}', "{}", "[]",
    '{"b":1,"a":[1, 2.0, 1e2]}', '"\\u00e9 \\n"', "-0.5", '[[["deep"]]]', '"],["',
]
OTHER_TEXTS = [
    "", "a,b,c", '{"a":1}\n{"b":2}', '1],"w":[2', '"a"][2', '{"a":1}][', "1,2", '1, "x"', '{"a":1},',
    "tru", "[1", '{"a":1}}', "01", "{'a':1}", '{"a":1} // c', "-", "NaN", '1,"n":2', "1]",
    '"a","b"', '{"a":1}],"x":[{"b":2}', ']', ',', '1]\n[2',
]


def verdicts(spark, texts):
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = table.select("i", json_text.is_single_json(F.col("t")).alias("ok")).collect()
    return [row.ok for row in sorted(found)]


def test_only_one_whole_value_is_json(spark):
    assert verdicts(spark, JSON_TEXTS) == [True] * len(JSON_TEXTS)
    assert verdicts(spark, OTHER_TEXTS) == [False] * len(OTHER_TEXTS)


def python_accepts(text):
    def refuse(name):
        raise ValueError(name)

    try:
        json.loads(text, parse_constant=refuse)
        return True
    except (ValueError, RecursionError):
        return False


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet='[]{}",:1a \n\\', max_size=12), min_size=200, max_size=400))
def test_verdict_equals_a_strict_parser(spark, texts):
    assert verdicts(spark, texts) == [python_accepts(t) for t in texts]


def test_normal_form_keeps_the_value(spark):
    texts = ['{"b": 1, "a": [1.50, null, "é"]}', "1" * 60, '{"x": 1e400}', '{"x": 1234567890123456789.25}']
    table = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", json_text.sealed_json(F.col("t")).alias("s")
    )
    for row in table.select("t", json_text.normal_json(F.col("s"), F.col("t")).alias("n")).collect():
        assert json.loads(row.n) == json.loads(row.t)


MEMBERS = ("id", "n")
ARRAYS = [
    ('[{"id":"1","n":2}]', [("1", "2")]),
    ('[{"id":"1"},5]', [("1", None), (None, None)]),
    ("[1,2]", [(None, None), (None, None)]),
    ('{"id":"1"}', []),
    ("[]", []),
    ("null", []),
    ("no list", []),
    (None, []),
    ('[{"id":{"a":1},"n":"[x]"},{"id":"{y}","n":[1]}]', [(None, "[x]"), ("{y}", None)]),
    ("[null]", [(None, None)]),
    ('[{"id":true,"n":null}]', [("true", None)]),
    ('[{"id":"1"}', []),
    ('\n [{"id":"2","x":{}}]', [("2", None)]),
    ('["{\\"id\\":1}"]', [(None, None)]),
    ('[{"id":"1"}] more', []),
    ('[{"id":"1"}][{"id":"2"}]', []),
    (' [{"id":"]"},{"id":"["}] ', [("]", None), ("[", None)]),
    ('[{"id":"a{b","n":100399.0}]', [("a{b", "100399.0")]),
]


@pytest.mark.parametrize("text,expected", ARRAYS)
def test_explode_records(spark, text, expected):
    table = spark.createDataFrame([("k", text)], "k string, items string")
    found = json_text.explode_records(table, "items", MEMBERS)
    assert found.columns == ["k", *MEMBERS]
    assert sorted(rows(found).elements(), key=repr) == sorted([("k", *r) for r in expected], key=repr)


def test_one_object_and_nothing_after_it(spark):
    """Against a parser that tells where the first value ends, on nested objects with odd strings and odd ends."""
    draw = random.Random(8)
    odd = ["", "}", "{", "]", '"', "\\", '\\"', "a", "{}", "},{", "é\n"]

    def value(depth):
        kind = draw.randrange(5) if depth else draw.randrange(3)
        if kind == 0:
            return "".join(draw.choices(odd, k=draw.randrange(4)))
        if kind < 3:
            return draw.choice([1, -2.5, True, None, 0])
        if kind == 3:
            return [value(depth - 1) for _ in range(draw.randrange(3))]
        return {f"k{i}" + draw.choice(odd): value(depth - 1) for i in range(draw.randrange(3))}

    texts = []
    for _ in range(1500):
        first = draw.choice([value(6), {"a": value(5)}, {"a": value(2)}])
        end = draw.choice(["", "", "", " ", "\t\r", "}", " {}", "x", ",", "[]", '"', " 1", "{"])
        texts.append(draw.choice(["", " "]) + json.dumps(first, ensure_ascii=draw.random() < 0.5) + end)
    table = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in table.select("t", json_text.is_single_object(F.col("t")).alias("one")).collect():
        found, end = json.JSONDecoder().raw_decode(row.t.strip())
        assert row.one == (isinstance(found, dict) and end == len(row.t.strip())), row.t
