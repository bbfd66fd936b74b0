"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Targets: sources in code point order, null last, weigh as given, repeating; they share the tokens of all sources by
weight, but none gets more than ``max_repeats`` times its own, and what is over is shared again among the others.

Each source's tokens, with its documents in a seeded order, are cut into blocks of equal size, the last of what remains.
A source's seats in the mix are blocks: it goes through its blocks in a seeded permutation, again from the start when it is through,
until it has its target; the last seat may be a part of a block, so that a source smaller than a block gets its target, too.
Seats go to sources one after the other, each to the source with the highest quotient ``target / (2 * given + 1)`` of
those that have not got all of theirs.  Consecutive parts of that sequence, of equal numbers of seats, are the shards: each shard has
its integer quota of blocks of every source, and which blocks these are follows from the permutation.

Only totals of sources meet in the driver.  Places of documents within a source come from totals of ranges of the
seeded order, so a source with a third of all documents is no group of its own anywhere.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, functions as F

from cairnlake.llm.scratch import stored

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
#: Tokens in a block: this, or the part of all tokens below if that is less.
BLOCK_TOKENS = 65_536
LEAST_BLOCKS = 10_000
#: Sources whose totals the driver takes; more are refused.
MAX_SOURCES = 100_000
#: Documents that a range of the seeded order is to hold, and bits of the order.
DOCUMENTS_PER_RANGE = 4_000
ORDER_BITS = 60


@dataclass(frozen=True)
class Quota:
    """What the mix takes of one source."""

    source: str | None
    tokens: int
    target: float
    blocks: int
    #: Tokens that the mix takes, repeats counted.
    taken: int
    #: Seats of this source, in the order of its turns, that belong to the shards up to each one.
    shard_ends: tuple[int, ...]
    factor: int
    shift: int

    def turn(self, block: int) -> int:
        """When in a pass the block has its turn."""
        return (block * self.factor + self.shift) % max(self.blocks, 1)


def last_pass(tokens: int, taken: int, blocks: int, block: int, last_turn: int) -> tuple[int, int]:
    """Turns of the pass that does not go through, and the tokens that it takes of the block after them.

    ``last_turn`` is the turn of the last block, which may be short.
    """
    if not tokens:
        return 0, 0
    rest, short = taken % tokens, tokens - (blocks - 1) * block
    # After the turn of the short block, as if it were a whole one.
    return divmod(rest + (block - short if rest >= last_turn * block + short else 0), block)


def share_targets(tokens: list[int], weights: list[int], max_repeats: int) -> list[float]:
    """Targets of sources in order: the total by weight, none above ``max_repeats`` times its tokens."""
    targets, free, rest = [0.0] * len(tokens), set(range(len(tokens))), float(sum(tokens))
    while free:
        total = sum(weights[i] for i in free)
        over = {i for i in free if rest * weights[i] / total > max_repeats * tokens[i]}
        if not over:
            for i in free:
                targets[i] = rest * weights[i] / total
            break
        for i in over:
            targets[i] = float(max_repeats * tokens[i])
            rest -= targets[i]
        free -= over
    return targets


def apportion(targets: list[float], limits: list[int], seats: int) -> list[int]:
    """Sainte-Lague: ``seats`` go one by one to the highest ``target / (2 * given + 1)``; ties to the first.

    The bulk is an apportionment of certainly fewer seats, by its divisor; the rest, some for each source, are given singly.
    """
    total = sum(targets)
    if not total or seats <= 0:
        return [0] * len(targets)
    # Rounding adds at most half a seat for each source; one less for what floats round.
    bulk = max(0, seats - len(targets))
    given = [
        max(0, min(limit, math.floor(bulk * target / total + 0.5) - 1)) for target, limit in zip(targets, limits)
    ]
    heap = [
        (-target / (2 * got + 1), i) for i, (target, got, limit) in enumerate(zip(targets, given, limits)) if got < limit and target > 0
    ]
    heapq.heapify(heap)
    for _ in range(seats - sum(given)):
        if not heap:
            break
        _, i = heapq.heappop(heap)
        given[i] += 1
        if given[i] < limits[i]:
            heapq.heappush(heap, (-targets[i] / (2 * given[i] + 1), i))
    return given


def plan_mix(
    totals: list[tuple[str | None, int]],
    weights: tuple[int, ...],
    max_repeats: int,
    shards: int,
    seed: int,
    least_blocks: int = LEAST_BLOCKS,
) -> tuple[int, list[Quota]]:
    """The block size and the quotas of sources given with their tokens."""
    named = sorted(((s, n) for s, n in totals if s is not None), key=lambda x: x[0].encode())
    ordered = named + [(s, n) for s, n in totals if s is None]
    tokens = [n for _, n in ordered]
    targets = share_targets(tokens, [weights[i % len(weights)] for i in range(len(tokens))], max_repeats)
    block = max(1, min(BLOCK_TOKENS, sum(tokens) // least_blocks))
    quotas, seats = [], []
    for i, (source, size) in enumerate(ordered):
        blocks = -(-size // block)
        draw = int(hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), 16)
        factor, count = draw % max(blocks, 1), max(blocks, 1)
        while math.gcd(factor, count) != 1:
            factor += 1
        taken = min(max_repeats * size, math.floor(targets[i] + 0.5))
        quota = Quota(source, size, targets[i], blocks, taken, (), factor % count, (draw >> 64) % count)
        extra, cut = last_pass(size, taken, blocks, block, quota.turn(blocks - 1))
        quotas.append(quota)
        seats.append((taken // size * blocks + extra + (cut > 0)) if size else 0)
    ends = [apportion(targets, seats, sum(seats) * (shard + 1) // shards) for shard in range(shards)]
    return block, [replace(quota, shard_ends=tuple(e[i] for e in ends)) for i, quota in enumerate(quotas)]


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def order_key(docs: DataFrame) -> Column:
    """What the seeded order is drawn from: the doc_id, or a hash of the text of a row without one."""
    return F.coalesce(docs["doc_id"].cast("string"), F.concat(F.lit("x"), F.hex(F.xxhash64(docs["text"]))))


def placed(rows: DataFrame, seed: int, most: int) -> DataFrame:
    """Add ``_at``: the tokens of the same ``_source`` before a row in the seeded order of documents.

    ``rows`` has ``_key, _source, _size`` and any other columns; it is read twice, so store it if it is costly.
    ``most`` is the number of rows of the largest source, by which the order is cut into ranges.
    """
    bits = min(ORDER_BITS, max(1, most // DOCUMENTS_PER_RANGE).bit_length() + 1)
    order = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), "_key")), 1, 15), 16, 10)
    rows = rows.withColumn("_order", order.cast("long")).withColumn(
        "_range", F.shiftright("_order", ORDER_BITS - bits)
    )
    keyed = rows.withColumn("_name", F.coalesce(F.concat(F.lit("="), "_source"), F.lit("")))
    totals = keyed.groupBy("_name", "_range").agg(F.sum("_size").alias("_total"))
    before = Window.partitionBy("_name").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_name", "_range", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_name", "_range").orderBy("_order", "_key", "_size").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return (
        keyed.withColumn("_inside", F.coalesce(F.sum("_size").over(inside), F.lit(0)))
        .join(offsets, ["_name", "_range"])
        .withColumn("_at", F.col("_offset") + F.col("_inside"))
        .drop("_name", "_range", "_order", "_offset", "_inside")
    )


def _turn(number: Column, quota: Column) -> Column:
    return (number * quota["factor"] + quota["shift"]) % quota["blocks"]


def mixed(
    rows: DataFrame,
    weights: tuple[int, ...],
    max_repeats: int,
    shards: int,
    seed: int,
    least_blocks: int = LEAST_BLOCKS,
) -> tuple[int, DataFrame]:
    """The block size, and ``rows`` with ``_at`` and ``_quota`` (what the mix takes of their source)."""
    spark = rows.sparkSession
    totals = rows.groupBy("_source").agg(F.sum("_size").alias("n"), F.count(F.lit(1)).alias("rows")).limit(MAX_SOURCES + 1).collect()
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    block, quotas = plan_mix([(r["_source"], r["n"]) for r in totals], weights, max_repeats, shards, seed, least_blocks)
    table = spark.createDataFrame(
        [
            (q.source, q.tokens, q.target, max(q.blocks, 1), q.taken // max(q.tokens, 1),
             *last_pass(q.tokens, q.taken, q.blocks, block, q.turn(q.blocks - 1)), q.factor, q.shift, list(q.shard_ends))
            for q in quotas
        ],
        "_name string, tokens long, target double, blocks long, passes long, extra long, cut long, factor long, shift long, "
        "ends array<long>",
    )
    fields = [c for c in table.columns if c != "_name"]
    quota = table.select("_name", F.struct(*fields).alias("_quota"))
    # One row for each source, at most MAX_SOURCES.
    most = max((r["rows"] for r in totals), default=0)
    return block, placed(rows, seed, most).join(F.broadcast(quota), F.col("_source").eqNullSafe(F.col("_name"))).drop("_name")


def mix_documents(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    shards: int = 8,
    seed: int = 0,
) -> DataFrame:
    """``doc_id, size, source_size, target, taken, by_shard`` for every row of documents.

    The size is the number of words; a null or empty text has none and nothing is taken of it.  Null is a source of
    its own.  ``taken`` counts words as often as the mix repeats them, ``by_shard`` those of each shard.  Rows that repeat are
    documents of their own; which of them a block cuts does not matter.  Extra columns are not read.
    """
    rows = stored(
        docs.select(
            docs["doc_id"].cast("long").alias("_id"),
            order_key(docs).alias("_key"),
            docs["source"].alias("_source"),
            count_words(docs["text"]).alias("_size"),
        ),
        "mix-sizes",
    )
    block, found = mixed(rows, weights, max_repeats, shards, seed)
    at, end, quota = F.col("_at"), F.col("_at") + F.col("_size"), F.col("_quota")
    first, last = (at - at % block) / block, (end - 1 - (end - 1) % block) / block

    def seats(number: Column) -> Column:
        """The shard of each seat that a block has, and the words that it takes of the document."""
        turn, low = _turn(number, quota), F.greatest(at, number * block)

        def seat(pass_: Column) -> Column:
            place = pass_ * quota["blocks"] + turn
            kept = (
                F.when((pass_ < quota["passes"]) | (turn < quota["extra"]), block)
                .when(turn == quota["extra"], quota["cut"])
                .otherwise(0)
            )
            return F.struct(
                F.size(F.filter(quota["ends"], lambda end_: end_ <= place)).alias("shard"),
                F.greatest(F.least(end, number * block + kept) - low, F.lit(0)).alias("words"),
            )

        return F.transform(F.sequence(F.lit(0).cast("long"), quota["passes"]), seat)

    every = F.flatten(F.transform(F.sequence(first.cast("long"), F.greatest(first, last).cast("long")), seats))

    def of_shard(shard: Column) -> Column:
        return F.aggregate(F.col("_seats"), F.lit(0).cast("long"), lambda sum_, s: sum_ + F.when(s["shard"] == shard, s["words"]).otherwise(0))

    listed = found.withColumn("_seats", F.when(F.col("_size") > 0, every).otherwise(F.array().cast("array<struct<shard:int,words:bigint>>")))
    return listed.select(
        F.col("_id").alias("doc_id"),
        F.col("_size").alias("size"),
        quota["tokens"].alias("source_size"),
        quota["target"].alias("target"),
        # The second mention of _seats keeps the optimiser from computing it anew for every shard.
        F.aggregate("_seats", F.lit(0).cast("long"), lambda sum_, s: sum_ + s["words"]).alias("taken"),
        F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), of_shard).alias("by_shard"),
    )


def taken_texts(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    shards: int = 8,
    seed: int = 0,
    least_blocks: int = 64,
) -> DataFrame:
    """What the mix takes of ``docs``, in its columns: a row for each time a document is taken.

    Documents are taken whole: one goes with the block in which its first word is, and with a part of a block if that word is in
    the part.  A source has its target but for about a document at each end of a run of blocks, and blocks are large here (a
    64th of all tokens or 65,536, whichever is less) so that there are few.  Documents without words are not taken.  Repeated rows and columns with any names are as in ``docs``.
    """
    names = [f"_keep{i}" for i in range(len(docs.columns))]
    rows = docs.select(
        *(docs[c].alias(n) for c, n in zip(docs.columns, names)),
        order_key(docs).alias("_key"),
        docs["source"].alias("_source"),
        count_words(docs["text"]).alias("_size"),
    )
    block, found = mixed(rows, weights, max_repeats, shards, seed, least_blocks)
    quota, inside = F.col("_quota"), F.col("_at") % block
    turn = _turn((F.col("_at") - inside) / block, quota)
    again = (turn < quota["extra"]) | ((turn == quota["extra"]) & (inside < quota["cut"]))
    copies = F.when(F.col("_size") > 0, quota["passes"] + again.cast("long")).otherwise(0)
    taken = found.withColumn("_copies", copies).where("_copies > 0")
    return taken.select(*names, F.explode(F.sequence(F.lit(1).cast("long"), "_copies"))).select(*names).toDF(*docs.columns)
