"""Bitmaps of hash slots: a bounded stand-in for a set of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cairnlake.llm.scratch import stored

#: Bits of a bitmap: 128 KB.
SLOT_BITS = 20


def slot_of(hashed: Column, *, bits: int = SLOT_BITS) -> Column:
    """The slot of a 64-bit hash."""
    return hashed.bitwiseAND(F.lit((1 << bits) - 1)).cast("int")


def bitmap(slots: DataFrame, bits: int = SLOT_BITS) -> DataFrame:
    """One row with ``bits``, an array of ``2^bits / 64`` longs in which the bits of ``slots(slot)`` are set."""
    words = slots.groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, slot & 63))").alias("mask")
    )
    every = slots.sparkSession.range(1 << (bits - 6)).select(F.col("id").cast("int").alias("word"))
    full = every.join(words, "word", "left").select("word", F.coalesce("mask", F.lit(0).cast("long")).alias("mask"))
    listed = full.agg(F.sort_array(F.collect_list(F.struct("word", "mask"))).alias("listed"))
    return stored(listed.select(F.col("listed.mask").alias("bits")), "bitmap")


def has_slot(bits: Column, slot: Column) -> Column:
    word = F.get(bits, F.shiftright(slot, 6))
    return F.call_function("getbit", word, slot.bitwiseAND(F.lit(63))) == 1
