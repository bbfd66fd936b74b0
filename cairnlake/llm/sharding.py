"""Reproducible shuffle into shards: a Feistel permutation with cycle walking over global row numbers.

Row number ``r`` of ``n`` goes to place ``p(r)``; the shard is ``p mod shards`` and the slot ``p div shards``, so
shards differ by one row at most and their slots have no gaps.  Both can be computed from a row number alone, and a
row number from shard and slot, on any machine (:class:`Permutation`).

The permutation works on ``rows x columns >= n`` places, a little more than ``n``: a place is a pair, and rounds
add to one half, modulo its range, a keyed hash of the other half.  A result of ``n`` or more is permuted again
until it is below ``n``.  The places beyond ``n`` are fewer than the square root of ``n`` plus one.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from cairnlake.llm.row_numbers import with_row_number
from cairnlake.llm.scratch import stored

ROUNDS = 6
#: Walks that are tried.  Up to n = 4096 no walk can be longer; beyond, one is with probability below 64 ** -64.
WALKS = 64


def whole(number: Column, divisor: Column) -> Column:
    """Integer division; exact up to 2 ** 53, as the quotient of the multiple below is."""
    return ((number - number % divisor) / divisor).cast("bigint")


@dataclass(frozen=True)
class Permutation:
    """The permutation of 0 .. count - 1 that belongs to a seed."""

    count: int
    seed: int = 0

    @property
    def rows(self) -> int:
        root = math.isqrt(self.count)
        return max(1, root + (root * root < self.count))

    @property
    def columns(self) -> int:
        return max(1, -(-self.count // self.rows))

    def _hash(self, turn: int, half: int) -> int:
        return int(hashlib.md5(f"{self.seed}:{turn}:{half}".encode()).hexdigest()[:15], 16)

    def _once(self, place: int, forward: bool) -> int:
        high, low = divmod(place, self.columns)
        sign = 1 if forward else -1
        for turn in range(ROUNDS) if forward else reversed(range(ROUNDS)):
            if turn % 2 == 0:
                high = (high + sign * self._hash(turn, low)) % self.rows
            else:
                low = (low + sign * self._hash(turn, high)) % self.columns
        return high * self.columns + low

    def place(self, row: int) -> int:
        """Where a row number goes."""
        row = self._once(row, True)
        while row >= self.count:
            row = self._once(row, True)
        return row

    def row(self, place: int) -> int:
        """The row number that goes to a place."""
        place = self._once(place, False)
        while place >= self.count:
            place = self._once(place, False)
        return place

    def column(self, row: Column) -> Column:
        """:meth:`place` as a Spark expression."""

        def hashed(turn: Column, half: Column) -> Column:
            text = F.concat_ws(":", F.lit(str(self.seed)), turn.cast("string"), half.cast("string"))
            return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")

        def turned(pair: Column, turn: Column) -> Column:
            high, low = pair["high"], pair["low"]
            return F.when(
                turn % 2 == 0,
                F.struct(((high + hashed(turn, low)) % self.rows).alias("high"), low.alias("low")),
            ).otherwise(F.struct(high.alias("high"), ((low + hashed(turn, high)) % self.columns).alias("low")))

        def once(place: Column) -> Column:
            columns = F.lit(self.columns).cast("bigint")
            start = F.struct(whole(place, columns).alias("high"), (place % columns).alias("low"))
            return F.aggregate(
                F.lit(list(range(ROUNDS))), start, turned, lambda pair: pair["high"] * columns + pair["low"]
            )

        count = F.lit(self.count).cast("bigint")
        walked = F.aggregate(
            F.lit(list(range(WALKS))),
            once(row),
            lambda place, _: F.when(place < count, place).otherwise(once(place)),
        )
        return F.when(walked < count, walked).otherwise(F.raise_error(F.lit("a walk did not end")).cast("bigint"))


def shard_rows(table: DataFrame, key: str, ties: list[str], shards: int, seed: int = 0) -> DataFrame:
    """Add ``shard`` and ``slot`` to every row, by its global row number in ascending (key, ties) order.

    The key is numeric and not null.  The table is stored first, as its row count is needed to plan the permutation;
    pass only the columns that are needed.
    """
    table = stored(table, "shard-rows")
    permutation = Permutation(table.count(), seed)
    placed = with_row_number(table, key, ties, "_row").withColumn("_to", permutation.column(F.col("_row")))
    return placed.select(
        *table.columns,
        (F.col("_to") % shards).cast("int").alias("shard"),
        whole(F.col("_to"), F.lit(shards)).alias("slot"),
    )


def shard_documents(docs: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row of documents.

    The size is the text's UTF-8 bytes plus 16; a null text has no bytes and the checksum of an empty one.  Rows are
    numbered by doc_id, then by checksum and size; rows without a doc_id come among the negative ids, spread by a
    hash of their text, so that many of them do not meet in one task.  Equal rows each get a place of their own.
    Other columns, whatever their names, are not read.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.coalesce(
            docs["doc_id"].cast("long"), F.lit(-(1 << 62)) + F.shiftrightunsigned(F.xxhash64(text), 2)
        ).alias("_key"),
    )
    placed = shard_rows(rows, "_key", ["doc_id", "text_crc32", "size"], shards, seed)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
