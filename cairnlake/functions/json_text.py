"""JSON held in text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: JSON as the standard has it; Spark's reader takes more unless told not to.
STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
#: Levels of nesting that are told apart without parsing.
_LEVELS = 4
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
#: Numbers that a variant would round: over 38 digits, exponents of three digits, long mantissas with an exponent.
_INEXACT = r"[0-9.]{39}|[eE][+-]?[0-9]{3}|[0-9.]{16,}[eE]"


def explode_records(table: DataFrame, column: str, keys: tuple[str, ...]) -> DataFrame:
    """One row per element of a JSON array text, with the named members in place of the text.

    A text that is NULL or is not exactly one JSON array gives no row.  A member is text, and NULL
    when it is missing, JSON null, an object or an array; an element that is no object has NULL
    members only.

    Reading the text straight into structs is the fast way, and right when every brace opens an
    element and the only brackets are the first and the last character.  It cannot tell a nested
    object from a text that looks like one, ignores what follows the array and gives up on elements
    that are no objects: such texts are parsed a second time, strictly and as variants.
    """
    text, fast, sealed = F.col(column), F.col("_fast"), F.col("_sealed")
    record = "struct<" + ", ".join(f"{key}: string" for key in keys) + ">"
    core = F.trim(text, F.lit(" \t\r\n"))
    braces = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("{"), F.lit("")))
    plain = (
        (braces == F.size(fast))
        & (F.locate("[", core, 2) == 0)
        & (F.locate("]", core) == F.length(core))
    )

    def checked(element: Column, found: Column) -> Column:
        members = []
        for key in keys:
            as_text = F.try_variant_get(element, f"$.{key}", "string")
            kept = F.when(~_is_nested(element, key), F.coalesce(found[key], as_text))
            members.append(kept.alias(key))
        return F.struct(*members)

    nothing = F.array().cast(f"array<{record}>")
    elements = F.when(
        is_sealed(sealed, text), F.try_variant_get(sealed, "$[0]", "array<variant>")
    )
    careful = F.zip_with(elements, F.coalesce(fast, nothing), checked)
    kept = [name for name in table.columns if name != column]
    # Both readings are columns of their own, so that each is computed once, if at all.
    return (
        table.where(core.startswith("["))
        .withColumn("_fast", F.from_json(text, f"array<{record}>", STRICT))
        .withColumn("_plain", F.coalesce(plain, F.lit(False)))
        .withColumn("_sealed", F.when(~F.col("_plain"), sealed_json(text)))
        .select(*kept, F.explode(F.when(F.col("_plain"), fast).otherwise(careful)).alias("_record"))
        .select(*kept, *(F.col("_record")[key].alias(key) for key in keys))
    )


def _is_nested(element: Column, key: str) -> Column:
    as_array = F.try_variant_get(element, f"$.{key}", "array<variant>")
    as_object = F.try_variant_get(element, f"$.{key}", "map<string,variant>")
    return as_array.isNotNull() | as_object.isNotNull()


def may_be_json(text: Column) -> Column:
    """False for texts whose ends alone show that they are not one JSON value.

    Spares the parser most CSV texts, each of which would cost an exception.
    """
    core = F.trim(text, F.lit(" \t\r\n"))
    starts, ends = F.substring(core, 1, 1), F.substring(core, -1, 1)
    number = core.rlike(r"^-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?$")
    return (
        F.when(starts == "{", ends == "}")
        .when(starts == "[", ends == "]")
        .when(starts == '"', ends == '"')
        .when(starts.isin("t", "f", "n"), core.isin("true", "false", "null"))
        .otherwise(number)
    )


def sealed_json(text: Column) -> Column:
    """Parse ``[text, seal]`` where the seal is the text's own SHA-256.

    Spark's JSON reader stops after the first value and ignores what follows.  In the sealed array
    the second element equals the seal exactly when ``text`` is one whole JSON value: extra values
    move the seal to a later place, and a text that closes the array early would have to contain
    its own SHA-256.
    """
    sealed = F.concat(F.lit("["), text, F.lit(',"'), F.sha2(text, 256), F.lit('"]'))
    return F.when(may_be_json(text), F.try_parse_json(sealed))


def is_sealed(sealed: Column, text: Column) -> Column:
    """True when ``sealed_json(text)`` found exactly one JSON value in the text."""
    return F.coalesce(
        F.try_variant_get(sealed, "$[1]", "string") == F.sha2(text, 256), F.lit(False)
    )


def is_single_json(text: Column) -> Column:
    """True when the text is exactly one JSON value (object, array or scalar)."""
    return is_sealed(sealed_json(text), text)


def is_single_object(text: Column) -> Column:
    """True when a text that parses as JSON is one object with nothing after it.

    Without its strings a text shows its nesting: the innermost brackets are replaced by a sign, level by level, and one
    object leaves that sign alone.  Texts nested deeper than :data:`_LEVELS` are parsed with a seal.  What stands between the brackets is the
    parser's to judge; this finds the values after the first, which it does not see.
    """
    core = F.trim(text, F.lit(" \t\r\n"))
    # Without escaped signs every quote opens or closes a string.
    open_text = F.replace(F.replace(core, F.lit("\\\\"), F.lit("")), F.lit('\\"'), F.lit(""))
    shape = F.regexp_replace(open_text, '"[^"]*"', "s")
    for _ in range(_LEVELS):
        shape = F.regexp_replace(shape, r"\{[^{}\[\]]*\}|\[[^{}\[\]]*\]", "v")
    # The shape is mentioned once, or its steps would be generated once for each mention.
    left = F.regexp_extract(shape, r"^v$|[{}\[\]]", 0)
    known = F.create_map(F.lit("v"), F.lit(True), F.lit(""), F.lit(False))
    return core.startswith("{") & F.coalesce(F.try_element_at(known, left), is_single_json(text))


def normal_json(sealed: Column, text: Column) -> Column:
    """The sealed value in compact form.

    A value with a number that would lose digits keeps the text it came with; only numbers count, whatever stands in
    strings.
    """
    compact = F.to_json(F.variant_get(sealed, "$[0]", "variant"))
    numbers = F.regexp_replace(text, _STRING, "s")
    return F.when(numbers.rlike(_INEXACT), text).otherwise(compact)
