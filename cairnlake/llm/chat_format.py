"""Chat records of many layouts to one training format.

A record is a JSON object.  The set of its nested field paths, hashed, is its schema fingerprint, and selects a
declarative mapping: which paths are turns, and where a turn's role and text are.  Mappings turn prompt, instruction
and message layouts into canonical turns ``role, text``.

A formatted turn is ``<s>role[INST]text[/INST]</s>``, and a conversation is its turns one after the other.  Control strings inside a
role or text get a backslash behind their first character, and backslashes are doubled, so what stands in a text never reads
as a control string and everything can be read back.  The loss mask covers the texts of assistant turns.

A conversation is kept as its turns, in rows: it is nowhere one string or one list, so one that holds a third of
all rows needs no more memory than another.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cairnlake.llm.workers import map_batches

BEGIN, TEXT, END = "<s>", "[INST]", "[/INST]</s>"
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")
ASSISTANT = "assistant"
_TURN = re.compile(re.escape(BEGIN) + "(.*?)" + re.escape(TEXT) + "(.*?)" + re.escape(END), re.DOTALL)
_ESCAPED = re.compile(r"\\(\\)?")


class UnknownSchema(ValueError):
    """A record whose fingerprint has no mapping."""


@dataclass(frozen=True)
class Turn:
    """Where a turn is: the text's path, and its role's path or the role itself."""

    text: str
    role: str | None = None
    role_path: str | None = None


@dataclass(frozen=True)
class Mapping:
    """The field paths of a layout and its turns in order.  With ``each``, turns repeat for the items of that list."""

    paths: tuple[str, ...]
    turns: tuple[Turn, ...]
    each: str | None = None
    roles: tuple[tuple[str, str], ...] = ()


MAPPINGS = (
    Mapping(("messages", "messages[].content", "messages[].role"), (Turn("content", role_path="role"),), "messages"),
    Mapping(
        ("conversations", "conversations[].from", "conversations[].value"),
        (Turn("value", role_path="from"),),
        "conversations",
        (("human", "user"), ("gpt", "assistant")),
    ),
    Mapping(("message", "message.content", "message.role"), (Turn("message.content", role_path="message.role"),)),
    Mapping(("from", "value"), (Turn("value", role_path="from"),)),
    Mapping(("role", "text"), (Turn("text", role_path="role"),)),
    Mapping(("prompt",), (Turn("prompt", "user"),)),
    Mapping(("response",), (Turn("response", ASSISTANT),)),
    Mapping(("system",), (Turn("system", "system"),)),
    Mapping(("prompt", "response"), (Turn("prompt", "user"), Turn("response", ASSISTANT))),
    Mapping(("completion", "prompt"), (Turn("prompt", "user"), Turn("completion", ASSISTANT))),
    Mapping(("prompt", "response", "system"), (Turn("system", "system"), Turn("prompt", "user"), Turn("response", ASSISTANT))),
    Mapping(("instruction", "output"), (Turn("instruction", "user"), Turn("output", ASSISTANT))),
    Mapping(
        ("input", "instruction", "output"),
        (Turn("instruction", "system"), Turn("input", "user"), Turn("output", ASSISTANT)),
    ),
)


def field_paths(value, prefix: str = "") -> set[str]:
    """All nested field paths of a JSON value; a list's items share the path ``[]``."""
    if isinstance(value, dict):
        found = set()
        for name, member in value.items():
            path = f"{prefix}.{name}" if prefix else name
            found |= {path} | field_paths(member, path)
        return found
    if isinstance(value, list):
        return set().union(*(field_paths(item, f"{prefix}[]") for item in value)) if value else set()
    return set()


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


@functools.lru_cache(maxsize=1)
def _by_fingerprint() -> dict[str, Mapping]:
    return {fingerprint(m.paths): m for m in MAPPINGS}


def _at(record, path: str):
    for name in path.split("."):
        record = record.get(name) if isinstance(record, dict) else None
    return record


def _plain(value) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def canonical_turns(record: str | None) -> list[tuple[str, str]]:
    """The turns of one record.  A null or absent role or text is empty; other scalars become their JSON text."""
    value = json.loads(record) if record else None
    mapping = _by_fingerprint().get(fingerprint(field_paths(value)))
    if not isinstance(value, dict) or mapping is None:
        raise UnknownSchema(f"no mapping for the fields {sorted(field_paths(value))}")
    renamed = dict(mapping.roles)
    turns = []
    for item in _at(value, mapping.each) or [] if mapping.each else [value]:
        for turn in mapping.turns:
            role = turn.role if turn.role_path is None else _plain(_at(item, turn.role_path))
            turns.append((renamed.get(role, role), _plain(_at(item, turn.text))))
    return turns


def escape(text: str) -> str:
    text = text.replace("\\", "\\\\")
    for control in CONTROLS:
        text = text.replace(control, f"{control[0]}\\{control[1:]}")
    return text


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda found: found[1] or "", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and the span of its characters that the loss counts (empty unless the assistant's)."""
    head = BEGIN + escape(role) + TEXT
    body = escape(text)
    return head + body + END, len(head), len(head) + (len(body) if role == ASSISTANT else 0)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts from formatted turns; anything that is not a turn is refused."""
    turns, at = [], 0
    for found in _TURN.finditer(formatted):
        if found.start() != at:
            raise ValueError("text outside a turn")
        turns.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    if at != len(formatted):
        raise ValueError("text outside a turn")
    return turns


def format_records(records: DataFrame) -> DataFrame:
    """``conv_id, turn, part, formatted, loss_from, loss_to`` from ``conv_id, turn, record`` (JSON text).

    One row for each canonical turn; ``part`` counts the turns of one record.  Map-only.  A record whose
    fingerprint has no mapping stops the job (:class:`UnknownSchema`): nothing is dropped in silence.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, part, formatted, low, high = [], [], [], [], []
            for i, record in enumerate(batch.column("record").to_pylist()):
                for number, (role, text) in enumerate(canonical_turns(record)):
                    line, begin, end = format_turn(role, text)
                    rows.append(i)
                    part.append(number)
                    formatted.append(line)
                    low.append(begin)
                    high.append(end)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id").take(at),
                    batch.column("turn").take(at),
                    pa.array(part, pa.int32()),
                    pa.array(formatted, pa.string()),
                    pa.array(low, pa.int32()),
                    pa.array(high, pa.int32()),
                ],
                names=["conv_id", "turn", "part", "formatted", "loss_from", "loss_to"],
            )

    return map_batches(
        records.select(records["conv_id"].cast("long").alias("conv_id"), records["turn"].cast("long").alias("turn"), "record"),
        run,
        "conv_id long, turn long, part int, formatted string, loss_from int, loss_to int",
    )


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Read formatted turns back: ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``.

    Rows of a conversation meet in one task, sorted, as a digest has to run through them in order; the task holds one
    batch and the running digests, however long the conversation.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        current, state = None, None

        def close() -> None:
            if state is not None:
                turns, loss = state["turns"], state["loss"]
                done.append((current, state["n"], turns.hexdigest(), state["loss_chars"], loss.hexdigest(), state["chars"]))

        def flush() -> pa.RecordBatch:
            columns = list(zip(*done)) or [()] * 6
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        for batch in batches:
            rows = zip(*(batch.column(n).to_pylist() for n in ("conv_id", "formatted", "loss_from", "loss_to")))
            for conv_id, line, low, high in rows:
                if state is None or conv_id != current:
                    close()
                    current = conv_id
                    state = {"n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0, "chars": 0}
                for role, text in read_turns(line):
                    state["n"] += 1
                    state["turns"].update(f"{role}\n{text}\n".encode())
                masked = unescape(line[low:high])
                state["loss"].update(masked.encode())
                state["loss_chars"] += len(masked)
                state["chars"] += len(line)
            if len(done) >= 1000:
                yield flush()
                done = []
        close()
        yield flush()

    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "part", "formatted")
    return map_batches(
        ordered.select("conv_id", "formatted", "loss_from", "loss_to"),
        run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


def turn_records(conversations: DataFrame) -> DataFrame:
    """Rows ``conv_id, turn, role, text`` as JSON records of several layouts, one for each turn.

    Which layout a row gets depends on its conversation; a null role or text becomes an empty one.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))

    def record(**fields: Column) -> Column:
        return F.to_json(F.struct(*(value.alias(name) for name, value in fields.items())))

    message = F.struct(role.alias("role"), text.alias("content"))
    layout = F.pmod(F.coalesce(F.col("conv_id").cast("long"), F.lit(0)), F.lit(5))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(layout == 0, record(messages=F.array(message)))
        .when(layout == 1, record(message=message))
        .when(layout == 2, record(**{"from": role, "value": text}))
        .when((layout == 3) & (role == "user"), record(prompt=text))
        .when((layout == 3) & (role == ASSISTANT), record(response=text))
        .when((layout == 3) & (role == "system"), record(system=text))
        .otherwise(record(role=role, text=text))
        .alias("record"),
    )


def format_conversations(conversations: DataFrame) -> DataFrame:
    """The digests of all conversations, formatted and read back.

    Turns are taken in ascending order (null first); rows that tie are taken by their formatted text, and repeated
    rows are turns of their own.  Rows without a conv_id make one conversation.  Extra columns are not read.
    """
    columns = [conversations["conv_id"].cast("long").alias("conv_id"), conversations["turn"].cast("long").alias("turn")]
    rows = conversations.select(*columns, conversations["role"].alias("role"), conversations["text"].alias("text"))
    return conversation_digests(format_records(turn_records(rows)))
