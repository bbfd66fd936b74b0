"""Filter interaction audit: what each of several filters removes in every order they can be applied in.

A document fails some of the filters; the set of those is its mask.  Documents are counted by part and mask, so all that
follows works on the at most 2^filters cells of each part.  A recursive query then extends prefixes of filters by the letters
not used yet: each level joins the cells of its part, carries the bits of the filters applied so far, and adds what the new
filter does to the prefix's trail.  Prefixes of full length are the orders, and their trails the steps.

A copy is found by the smallest doc_id of its text, over all documents: smallest ids are combined in each task
before they are shuffled, texts that occur under one id only are dropped, and the rest is joined back by an equi-join both
sides of which come straight from a shuffle, so that adaptive execution splits the partition of a text that
very many documents share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cairnlake.llm.scratch import stored

#: Words are maximal runs of anything but these.
BLANKS = r"[\x20\x09-\x0D]+"
#: Places that rows without a doc_id are dealt to in the join with the labels.
NULL_PLACES = 1 << 16


def text_failures(text: Column, words: Column) -> list[Column]:
    """Whether a text fails A (under 200 words), B (under half of them distinct), C (over 2 % capitals), D (odd signs)."""
    capitals = F.octet_length(text) - F.octet_length(F.regexp_replace(text, "[A-Z]+", ""))
    return [
        F.size(words) < 200,
        100 * F.size(F.array_distinct(words)).cast("long") < 50 * F.size(words).cast("long"),
        100 * capitals.cast("long") > 2 * F.char_length(text).cast("long"),
        text.rlike("[#$%&*|]"),
    ]


def as_mask(failures: list[Column]) -> Column:
    """Bit i is set where failure i holds; what is unknown does not hold."""
    mask = F.lit(0)
    for i, fails in enumerate(failures):
        mask = mask + F.when(fails, 1 << i).otherwise(0)
    return mask


def documents_with_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, good, toxic`` of every row of documents, with the five filters A to E as bits 0 to 4.

    A null source is the empty one, a null text an empty text.  E, a copy, needs a smaller doc_id: a row without a doc_id
    is none and makes none, nor do rows that repeat a doc_id.  A document that several labels name is good or toxic if one of them
    says so.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    split = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(docs["source"], F.lit("")).alias("part"),
        text.alias("text"),
        F.array_remove(F.split(text, BLANKS), "").alias("words"),
    )
    rows = stored(
        split.select(
            "doc_id",
            "part",
            F.unhex(F.sha2("text", 256)).alias("digest"),
            as_mask(text_failures(F.col("text"), F.col("words"))).alias("mask"),
        ),
        "audit-rows",
    )
    firsts = stored(
        rows.groupBy("digest")
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .where("first < last")
        .select("digest", "first"),
        "audit-firsts",
    )
    known = stored(
        labels.where(labels["doc_id"].isNotNull())
        .groupBy(labels["doc_id"].cast("long").alias("doc_id"))
        .agg(F.max((labels["quality"] == 1).cast("int")).alias("good"), F.max((labels["toxic"] == 1).cast("int")).alias("toxic")),
        "audit-labels",
    ).withColumn("place", F.lit(0))
    place = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("digest"), F.lit(NULL_PLACES)).cast("int")).otherwise(0)
    copy = F.when(F.col("doc_id") > F.col("first"), 1 << 4).otherwise(0)
    return (
        rows.withColumn("place", place)
        .join(known, ["doc_id", "place"], "left")
        .join(firsts, "digest", "left")
        .select(
            "part",
            (F.col("mask") + copy).alias("mask"),
            F.coalesce("good", F.lit(0)).alias("good"),
            F.coalesce("toxic", F.lit(0)).alias("toxic"),
        )
    )


def audit(masked: DataFrame, letters: str) -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``.

    ``masked`` has ``part, mask, good, toxic`` of each document; filter i of ``letters`` is bit i of the mask.  Every
    part that has a document gets a row for each order and step; an empty table has no parts and gives no rows.
    The number of rows the recursion may make grows with the number of parts, so the session's limit on it is lifted.
    """
    spark = masked.sparkSession
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    counted = masked.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("good").cast("long")).alias("good"),
        F.sum(F.col("toxic").cast("long")).alias("toxic"),
    )
    # At most one cell for each set of filters.
    cells = stored(counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells")), "audit-cells")

    def total(condition: str, field: str = "n") -> str:
        return f"aggregate(filter(c.cells, x -> {condition}), 0L, (t, x) -> t + x.{field})"

    bit = "shiftleft(1, p.place)"
    here = f"(x.mask & {bit}) <> 0 AND (x.mask & p.applied) = 0"
    metrics = {
        "step": "p.step + 1",
        "letter": "p.letter",
        "kept": total(f"(x.mask & (p.applied | {bit})) = 0"),
        "removed": total(here),
        "redundant": total(f"(x.mask & {bit}) <> 0 AND (x.mask & p.applied) <> 0"),
        "unique_fails": total(f"x.mask = {bit}"),
        "good_lost": total(here, "good"),
        "toxic_lost": total(here, "toxic"),
    }
    entry = "named_struct(" + ", ".join(f"'{name}', {value}" for name, value in metrics.items()) + ")"
    kind = "array<struct<step:int,letter:string," + ",".join(f"{m}:bigint" for m in list(metrics)[2:]) + ">>"
    unused = "array(" + ", ".join(f"'{letter}'" for letter in letters) + ")"
    orders = spark.sql(
        f"""
        WITH RECURSIVE prefixes(part, prefix, step, applied, trail) AS (
            SELECT part, '', 0, 0, cast(array() AS {kind}) FROM {{cells}}
            UNION ALL
            SELECT p.part, concat(p.prefix, p.letter), p.step + 1, p.applied | {bit}, concat(p.trail, array({entry}))
            FROM (
                SELECT part, prefix, step, applied, trail, posexplode({unused}) AS (place, letter)
                FROM prefixes WHERE step < {len(letters)}
            ) p JOIN {{cells}} c ON c.part = p.part
            WHERE (p.applied & {bit}) = 0
        )
        SELECT part, prefix AS filter_order, inline(trail) FROM prefixes WHERE step = {len(letters)}
        """,
        cells=cells,
    )
    return orders.selectExpr(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost",
        "sum(removed) OVER (PARTITION BY part, letter) AS shapley",
    )


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """:func:`audit` of the filters A to E over every row and whole text of documents; extra columns are not read."""
    return audit(documents_with_masks(docs, labels), "ABCDE")
