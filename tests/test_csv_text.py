"""CSV in text columns against Python's csv module."""

import csv
import io
import random

from helpers import plan
from pyspark.sql import functions as F

from cairnlake.functions import csv_text
from cairnlake.functions.csv_text import split_records, value_count


SIGNS = ["a", "b c", ",", '"', "\n", "\r\n", "\x01", "\x01n", "é", "", " "]


def written(records, quoting):
    out = io.StringIO()
    csv.writer(out, lineterminator="\n", quoting=quoting).writerows(records)
    return out.getvalue()


def random_records(draw):
    count = draw.randrange(1, 5)
    return [["".join(draw.choices(SIGNS, k=draw.randrange(4))) for _ in range(count)] for _ in range(draw.randrange(1, 6))]


def test_records_and_their_values_are_those_that_were_written(spark):
    draw, cases = random.Random(9), []
    for _ in range(300):
        records, quoting = random_records(draw), draw.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL])
        # A record of blanks alone, not in quotes, is a blank line.
        kept = [r for r in records if written([r], quoting).strip(" \t\r\n")]
        cases.append((written(records, quoting), kept))
    table = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(cases)], "i int, text string")
    split = table.select("i", csv_text.split_records(F.col("text")).alias("records"))
    counted = split.select("i", "records", F.transform("records", csv_text.value_count).alias("n"))
    for row in counted.collect():
        expected = cases[row.i][1]
        read = [next(csv.reader(io.StringIO(record, newline=""))) for record in row.records]
        assert read == expected, cases[row.i]
        assert row.n == [len(r) for r in expected]


def test_quotes_that_enclose_no_whole_value_have_no_count(spark):
    broken = ['a,"b', 'a"', '"a"b,c', 'a,b"c"', '"a,"b",c"', 'x "y" z', '"', 'a,"b""']
    whole = {"": 1, "a": 1, "a,b": 2, ",": 2, '""': 1, '"",""': 2, '"a,b",c': 2, '"a""b",""""': 2, '"\n,"': 1}
    table = spark.createDataFrame([(t,) for t in [*broken, *whole]], "t string")
    got = {r.t: r.n for r in table.select("t", csv_text.value_count(F.col("t")).alias("n")).collect()}
    assert got == {t: None for t in broken} | whole


def test_very_long_values(spark):
    text = '"' + 'x""y,\n' * 200_000 + '",b\n' + "c" * 1_000_000 + ",d\n"
    table = spark.createDataFrame([(text,)], "t string").select(csv_text.split_records(F.col("t")).alias("r"))
    (row,) = table.select(F.transform("r", csv_text.value_count).alias("n"), F.transform("r", F.length).alias("l")).collect()
    assert row.n == [2, 2] and row.l == [1_200_004, 1_000_002]


def test_header_lines(spark):
    table = spark.createDataFrame([("k,v",), ('"k","v"',), (" k,v \r",), ("k,v,w",), ("K,V",), ("﻿k,v",)], "t string")
    got = [r.s for r in table.select(csv_text.spells(F.col("t"), ["k", "v"]).alias("s")).collect()]
    assert got == [True, True, True, False, False, True]


def test_records_with_runs_of_quotes(spark):
    text = 'a,"",b\n"""x""\n""\x01q\x01",""\r\nc,"""",""""""\n"d\r\r\n""",e'
    table = spark.createDataFrame([(text,)], "text string")
    assert table.select(split_records(table.text)).first()[0] == [
        'a,"",b', '"""x""\n""\x01q\x01",""', 'c,"""",""""""', '"d\r\r\n""",e']


def test_values_are_counted_by_one_pass_of_the_expression(spark):
    table = spark.createDataFrame([('a,"b,""c""",d',), ('"a"b',), (None,), ("",)], "text string")
    counted = table.select(value_count(table.text).alias("n"))
    assert [r[0] for r in counted.collect()] == [3, None, None, 1]
    assert plan(counted, execute=False).count("regexp_replace") == 1
