"""Conversation repair by a dynamic programme whose cost vectors are stored at checkpoints only.

A conversation is to read: nothing, or an optional system turn and then pairs of a user and an assistant turn.  The automaton of
that has four states, and in each of them one of user and assistant may follow, so the initials of the edits say all of a
repair.  Going backwards over the rows, a vector holds the cheapest cost to the end from each state.  Vectors are kept at every
sqrt(n)-th row; going forwards, a block's vectors are computed again from the checkpoint at its end, and at each point the ASCII-least edit
is taken whose cost and the rest's make up the cost at hand.  Vectors relative to their least value are few, so a row costs
a dictionary look-up.

Spark brings the rows together twice.  First without texts: rows alike in all are counted before they are shuffled, a first
occurrence is found by a join, and a task goes through the rows of its conversations in order, holding one byte for each row of one
conversation, as its audit, one text, does.  Then texts pass by the audit, and the repaired conversation is hashed as it
streams.  The digest runs through a conversation's turns in order, so a conversation is read by one task, which holds one batch.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cairnlake.llm.scratch import stored
from cairnlake.llm.workers import map_batches

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
_BLANKS = " \t\n\x0b\x0c\r"
#: States: nothing yet, after the system turn, after a user turn, after an assistant turn.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
#: Where user or assistant, whichever may follow, leads from each state; and where an initial leads.
_FORCED = (_USER, _USER, _ASSISTANT, _USER)
_KEPT = {
    (_START, "s"): _SYSTEM, (_START, "u"): _USER, (_SYSTEM, "u"): _USER, (_USER, "a"): _ASSISTANT, (_ASSISTANT, "u"): _USER,
}
_ROLE = {_USER: "user", _ASSISTANT: "assistant"}
#: Cheapest ways to the end from each state when no rows are left.
_END = (0, 2 * INSERT, INSERT, 0)
_INITIALS = "sua"
#: A row's code: 0 must go; else 1, and 2 for each place of its initial among s, u, a and others, and 1 more if truncated.
_MUST_GO = 0
#: What a row of the first pass is.
DROPPED, BLANK, DUPLICATE, CUT, SOUND = range(5)


def code_of(initial: str, truncated: bool) -> int:
    place = _INITIALS.find(initial) if initial else -1
    return 1 + 2 * (place if place >= 0 else len(_INITIALS)) + truncated


def _row_edits(state: int, code: int) -> list[tuple[str, int, int]]:
    """The edits a row allows in a state: initial, cost, next state."""
    edits = [("D", DELETE, state)]
    if code != _MUST_GO:
        place, truncated = divmod(code - 1, 2)
        kept = _KEPT.get((state, _INITIALS[place])) if place < len(_INITIALS) else None
        if kept is not None:
            edits.append(("K", KEEP + truncated * TRUNCATED, kept))
        edits.append(("R", REROLE + truncated * TRUNCATED, _FORCED[state]))
    return edits


@cache
def _before(after: tuple[int, ...], code: int) -> tuple[int, ...]:
    """The cost vector before a row, from the one after it."""
    row = [min(cost + after[to] for _, cost, to in _row_edits(state, code)) for state in range(4)]
    # Two insertions in a row lead through every state there is to lead to.
    once = [_FORCED[state] for state in range(4)]
    return tuple(min(row[s], INSERT + row[once[s]], 2 * INSERT + row[once[once[s]]]) for s in range(4))


@cache
def _edits(after: tuple[int, ...], code: int, state: int) -> tuple[str, int]:
    """The ASCII-least tight edits from a state up to and with the row's own, and the state they lead to."""
    before, done = _before(after, code), ""
    while True:
        tight = [
            (name, to) for name, cost, to in _row_edits(state, code) if before[state] == cost + after[to]
        ] + [("I", _FORCED[state])] * (before[state] == INSERT + before[_FORCED[state]])
        name, to = min(tight)
        done, state = done + name, to
        if name != "I":
            return done, state


def _relative(vector: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    least = min(vector)
    return tuple(v - least for v in vector), least


def repair(codes: bytes) -> tuple[str, int]:
    """The ASCII-least of the cheapest audits of a conversation's rows, and its cost."""
    count = len(codes)
    block = max(1, math.isqrt(count))
    checkpoints, vector, total = {}, _relative(_END)[0], 0
    for i in range(count - 1, -1, -1):
        if (i + 1) % block == 0 or i == count - 1:
            checkpoints[i + 1] = vector
        vector, least = _relative(_before(vector, codes[i]))
        total += least
    cost = total + vector[_START]
    audit, state = [], _START
    for first in range(0, count, block):
        after = min(first + block, count)
        vectors = [checkpoints[after]]
        for i in range(after - 1, first, -1):
            vectors.append(_relative(_before(vectors[-1], codes[i]))[0])
        for i, behind in zip(range(first, after), reversed(vectors)):
            done, state = _edits(behind, codes[i], state)
            audit.append(done)
    while state not in (_START, _ASSISTANT):
        audit.append("I")
        state = _FORCED[state]
    return "".join(audit), cost


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, dropped`` of the damaged rows; nulls of role and text, and in the hash, are one space."""

    def spaced(column: Column) -> Column:
        return F.coalesce(column.cast("string"), F.lit(" "))

    conv, turn = conversations["conv_id"].cast("long"), conversations["turn"].cast("long")
    text = spaced(conversations["text"])
    kind = F.crc32(F.concat_ws(":", spaced(conv), spaced(turn)).cast("binary")) % 20
    return conversations.select(
        conv.alias("conv_id"),
        turn.alias("turn"),
        F.when(kind == 4, "user").otherwise(spaced(conversations["role"])).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (kind == 0).alias("dropped"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")


def with_faults(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, print, kind, n``: rows alike in all as one, with their first fault; ``n`` counts them.

    Of rows alike the first has the fault and the others are its duplicates (or blank, too).
    """
    trimmed = F.rtrim("text", F.lit(_BLANKS))
    trimmed = F.ltrim(trimmed, F.lit(_BLANKS))
    kind = (
        F.when(F.col("dropped"), DROPPED)
        .when(trimmed == "", BLANK)
        .when(F.right(trimmed, F.lit(1)).isin(".", "!", "?"), SOUND)
        .otherwise(CUT)
    )
    alike = stored(
        rows.withColumn("kind", kind)
        .withColumn("print", F.unhex(F.sha2("text", 256)))
        .groupBy("conv_id", "turn", "role", "print", "kind")
        .agg(F.count(F.lit(1)).alias("n")),
        "alike-rows",
    )
    seen = stored(
        alike.where(F.col("kind") > BLANK)
        .groupBy("conv_id", "role", "print")
        .agg(F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("turns"))
        .where("turns > 1")
        .select(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("print").alias("_print"), "first"),
        "seen-rows",
    )
    again = (
        F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("print") == F.col("_print"))
    )
    later = (F.col("kind") > BLANK) & F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn"))
    return alike.join(seen, again, "left").select(
        "conv_id", "turn", "role", "print", F.when(later, DUPLICATE).otherwise(F.col("kind")).alias("kind"), "n"
    )


_AUDITED = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


class _Conversation:
    """What the first pass notes of a conversation's rows, in order."""

    def __init__(self, number: int | None):
        self.number, self.codes = number, bytearray()
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.least = self.most = self.initial = None

    def add(self, turn: int | None, role: str, kind: int, n: int) -> None:
        if kind == DROPPED:
            return
        if turn is not None:
            self.least = turn if self.least is None else self.least
            self.distinct += turn != self.most
            self.most = turn
        initial = role[:1]
        legal = ("su", "ua", "au")
        if self.initial is not None:
            self.illegal += self.initial + initial not in legal
        self.illegal += (n - 1) * (initial + initial not in legal)
        self.initial = initial
        self.blank += n * (kind == BLANK)
        self.duplicate += (kind == DUPLICATE) + (n - 1) * (kind != BLANK)
        self.truncated += kind == CUT
        must_go = kind in (BLANK, DUPLICATE)
        self.codes.append(_MUST_GO if must_go else code_of(initial, kind == CUT))
        self.codes += bytes([_MUST_GO]) * (n - 1)

    def result(self) -> tuple:
        audit, cost = repair(bytes(self.codes))
        gaps = 0 if self.most is None else self.most - self.least + 1 - self.distinct
        return self.number, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    types = {"long": pa.int64(), "string": pa.string()}
    names, kinds = zip(*(field.split() for field in schema.split(", ")))
    return pa.RecordBatch.from_arrays(
        [pa.array(column, types[kind]) for column, kind in zip(zip(*rows), kinds)], names=list(names)
    )


def audited(faults: DataFrame) -> DataFrame:
    """The counts, cost and audit of every conversation of :func:`with_faults`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, done = None, []
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("conv_id", "turn", "role", "kind", "n")]
            for conv, turn, role, kind, n in zip(*columns):
                if current is None or current.number != conv:
                    if current is not None:
                        done.append(current.result())
                    current = _Conversation(conv)
                current.add(turn, role, kind, n)
            if done:
                yield _batch(done, _AUDITED)
                done = []
        if current is not None:
            yield _batch([current.result()], _AUDITED)

    ordered = faults.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "print")
    return map_batches(ordered.select("conv_id", "turn", "role", "kind", "n"), run, _AUDITED)


class _Repaired:
    """A conversation's repaired rows, hashed one after the other as its damaged rows pass by its audit."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.first = audit, 0, _START, True
        self.digest = hashlib.sha256()

    def _write(self, role: str, text: str) -> None:
        self.digest.update((("" if self.first else "\n") + role + ":" + text).encode())
        self.first = False

    def _insert(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.state = _FORCED[self.state]
            self._write(_ROLE[self.state], "")
            self.at += 1

    def add(self, role: str, text: str) -> None:
        self._insert()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            self.state = _FORCED[self.state]
            self._write(_ROLE[self.state], text)
        elif edit == "K":
            self.state = _KEPT[self.state, role[:1]]
            self._write(role, text)

    def result(self) -> str:
        self._insert()
        return self.digest.hexdigest()


def hashed(audits: DataFrame, rows: DataFrame) -> DataFrame:
    """The columns of ``audits`` and ``repaired_sha256``: ``rows`` are the damaged ones that were not dropped."""
    head = audits.select("conv_id", F.struct(*audits.columns[1:]).alias("head"))
    none = F.lit(None).cast(head.schema["head"].dataType)
    head = head.selectExpr("conv_id", "head", "0 AS part", "cast(null AS bigint) AS turn", "'' AS role", "cast(null AS binary) AS print", "'' AS text")
    texts = rows.select(
        "conv_id", none.alias("head"), F.lit(1).alias("part"), "turn", "role", F.unhex(F.sha2("text", 256)).alias("print"), "text"
    )
    schema = f"{_AUDITED}, repaired_sha256 string"
    fields = audits.columns[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, current, done = None, None, []
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("conv_id", "head", "role", "text")]
            for conv, first, role, text in zip(*columns):
                if first is not None:
                    if current is not None:
                        done.append((*head, current.result()))
                    head, current = (conv, *(first[name] for name in fields)), _Repaired(first["audit"])
                else:
                    current.add(role, text)
            if done:
                yield _batch(done, schema)
                done = []
        if current is not None:
            yield _batch([(*head, current.result())], schema)

    ordered = head.unionByName(texts).repartition("conv_id").sortWithinPartitions("conv_id", "part", "turn", "role", "print")
    return map_batches(ordered.select("conv_id", "head", "role", "text"), run, schema)


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` of every conversation, damaged first.

    Rows go by turn, nulls first; rows of one turn by role and a digest of their text, so that reruns agree and rows alike are
    neighbours.  Rows without a conv_id are one conversation.  An empty role has no initial and cannot be kept.
    A conversation of which no row is left has zeros, an empty audit and the hash of nothing; an empty table gives no
    rows.  Extra columns are not read.
    """
    rows = damage(conversations)
    audits = stored(audited(with_faults(rows)), "audits")
    return hashed(audits, rows.where(~F.col("dropped")))
