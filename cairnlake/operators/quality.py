"""Data-quality assertions.  An assertion is a DataFrame of the rows that break it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


class AssertionFailed(Exception):
    """Raised by :func:`enforce` when an assertion has violations."""


def any_null(columns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.col(name).isNull() for name in columns))


def unique_key(table: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Keys that occur more than once: ``(assertion, keys..., n)``.

    NULLs count as equal, as in GROUP BY.  Counts are combined in each task before the shuffle.
    """
    return (
        table.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
        .select(F.lit(name).alias("assertion"), *keys, "n")
    )


def non_null(table: DataFrame, columns: list[str], name: str) -> DataFrame:
    """Rows with a NULL in one of the columns, counted per combination of empty columns.

    The result is ``(assertion, null_columns, n)``; it cannot have more rows than there are
    combinations.
    """
    empty = F.array_compact(F.array(*(F.when(F.col(c).isNull(), F.lit(c)) for c in columns)))
    return (
        table.where(any_null(columns))
        .groupBy(F.array_join(empty, ",").alias("null_columns"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(name).alias("assertion"), "null_columns", "n")
    )


def null_rows(table: DataFrame, columns: list[str]) -> DataFrame:
    """The offending rows themselves."""
    return table.where(any_null(columns))


def enforce(violations: DataFrame) -> None:
    """Raise when the violations are not empty; stops at the first one found."""
    first = violations.limit(1).collect()
    if first:
        raise AssertionFailed(str(first[0].asDict()))


#: Rows of assertions that refused a version: the run, the model, the assertion and the row as JSON.
VIOLATIONS = "run string, model string, assertion string, violation string"


def stored_form(violations: DataFrame, run: str, model: str) -> DataFrame:
    """Violations of any assertion in the columns of :data:`VIOLATIONS`."""
    rest = [name for name in violations.columns if name != "assertion"]
    return violations.select(
        F.lit(run).alias("run"), F.lit(model).alias("model"), "assertion", F.to_json(F.struct(*rest)).alias("violation")
    )


def keep_violations(assertions: list[DataFrame], path: str, run: str, model: str) -> DataFrame | None:
    """Append the violations of all assertions on a model to a table; None, and nothing written, if there are none.

    The folder is named by run and model, so what a run found stays whatever later runs find.
    """
    if not assertions:
        return None
    found = reduce(DataFrame.unionByName, (stored_form(rows, run, model) for rows in assertions))
    if found.isEmpty():
        return None
    folder = f"{path.rstrip('/')}/run={run}/model={model}"
    found.drop("run", "model").write.mode("append").parquet(folder)
    return found.sparkSession.read.schema("assertion string, violation string").parquet(folder)


def violations(spark: SparkSession, path: str) -> DataFrame:
    """All stored violations, of all runs."""
    return spark.read.schema(VIOLATIONS).option("basePath", path).parquet(path).select("run", "model", "assertion", "violation")


def refuse_null(table: DataFrame, columns: list[str]) -> DataFrame:
    """The table itself, failing at run time on the first row with a NULL in a required column."""
    checked = [
        F.when(
            F.col(name).isNull(), F.raise_error(F.lit(f"required column {name} is NULL"))
        ).otherwise(F.col(name)).alias(name)
        if name in columns
        else F.col(name)
        for name in table.columns
    ]
    return table.select(*checked)
