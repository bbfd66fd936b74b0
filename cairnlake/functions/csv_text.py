"""CSV held in text columns: values counted and records told apart by their quotes.

A value with a comma, a quote or a line break stands in quotes, and its own quotes are doubled.  All steps are linear in the text
and none recurses, so very long values are no trouble.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Quotes inside a CSV value are doubled; without this a JSON value splits over several columns.
QUOTING = {"quote": '"', "escape": '"'}
_QUOTED_VALUE = r'(^|,)"[^"]*"(?=,|$)'
#: Stand-ins for a line break inside quotes, for a doubled quote and for the sign that starts a stand-in.
_SIGN, _SIGN_ITSELF, _BREAK, _RETURN, _DOUBLED = "\x01", "\x01s", "\x01n", "\x01r", "\x01q"


def value_count(record: Column) -> Column:
    """How many values a record has; NULL if its quotes do not enclose whole values.

    Doubled quotes go first; what is left encloses values.  An odd quote, as a line that ends inside a value has,
    or text beside a quoted value stays behind.
    """
    enclosed = F.regexp_replace(F.replace(record, F.lit('""'), F.lit("")), _QUOTED_VALUE, "$1")
    plain = F.when(record.contains('"'), enclosed).otherwise(record)

    def counted(text: Column) -> Column:
        commas = F.octet_length(text) - F.octet_length(F.replace(text, F.lit(","), F.lit("")))
        return F.when(~text.contains('"'), commas + 1)

    # An array of one, so that the expression is computed once for all mentions of what it gives.
    return F.get(F.transform(F.array(plain), counted), F.lit(0))


def spells(record: Column, names: list[str]) -> Column:
    """Whether a record is the header line of these columns, in quotes or not."""
    core = F.trim(F.replace(record, F.lit('"'), F.lit("")), F.lit(" \t\r\n﻿"))
    return core == ",".join(names)


def split_records(text: Column) -> Column:
    """The records of a CSV text: its lines, except that a line break inside quotes does not end one.

    Records without any sign but blanks are left out.  A text whose last quote is open ends with the record it is in.
    """
    # Two quotes in a row leave what follows inside or outside as it was; without them there are few parts.
    single = F.replace(F.replace(text, F.lit(_SIGN), F.lit(_SIGN_ITSELF)), F.lit('""'), F.lit(_DOUBLED))
    parts = F.split(single, '"', -1)

    def kept(part: Column, place: Column) -> Column:
        inside = F.replace(F.replace(part, F.lit("\n"), F.lit(_BREAK)), F.lit("\r"), F.lit(_RETURN))
        return F.when(place % 2 == 1, inside).otherwise(part)

    def restored(line: Column) -> Column:
        breaks = F.replace(F.replace(line, F.lit(_BREAK), F.lit("\n")), F.lit(_RETURN), F.lit("\r"))
        quotes = F.replace(breaks, F.lit(_DOUBLED), F.lit('""'))
        return F.when(line.contains(_SIGN), F.replace(quotes, F.lit(_SIGN_ITSELF), F.lit(_SIGN))).otherwise(line)

    # A single sign is split at without a regular expression.
    joined = F.array_join(F.transform(parts, kept), '"')
    lines = F.split(F.replace(F.replace(joined, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n")), "\n", -1)
    return F.transform(F.filter(lines, lambda line: F.trim(line, F.lit(" \t")) != ""), restored)
