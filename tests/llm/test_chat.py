import hashlib
import json

import pytest
from hypothesis import given, strategies as st

from cairnlake.llm import chat_format as chat

TEXTS = st.text(st.sampled_from("\\<>[]/sINT ab\n"), max_size=30) | st.text(max_size=20)


@given(TEXTS, TEXTS)
def test_turns_read_back(role, text):
    line, low, high = chat.format_turn(role, text)
    assert chat.read_turns(line + line) == [(role, text)] * 2
    assert all(control not in chat.escape(text) for control in chat.CONTROLS)
    assert (chat.unescape(line[low:high]) == text) if role == chat.ASSISTANT else low == high


def test_layouts_become_the_same_turns():
    said = [("user", "hi"), ("assistant", "yes")]
    for record in (
        {"messages": [{"role": r, "content": t} for r, t in said]},
        {"conversations": [{"from": "human", "value": "hi"}, {"from": "gpt", "value": "yes"}]},
        {"prompt": "hi", "response": "yes"},
        {"completion": "yes", "prompt": "hi"},
        {"instruction": "hi", "output": "yes"},
    ):
        assert chat.canonical_turns(json.dumps(record)) == said
    assert chat.canonical_turns('{"instruction": "be short", "input": null, "output": 5}') == [
        ("system", "be short"), ("user", ""), ("assistant", "5")]


@pytest.mark.parametrize("record", [None, "[]", "3", '{"other": 1}', '{"prompt": "a", "extra": {"deep": 1}}'])
def test_unknown_layouts_are_refused(record):
    with pytest.raises(chat.UnknownSchema):
        chat.canonical_turns(record)


def test_text_outside_turns_is_refused():
    with pytest.raises(ValueError):
        chat.read_turns("x<s>user[INST]a[/INST]</s>")


def test_conversations_against_plain_python(spark):
    rows = [(c, t, r, s) for c in range(12) for t, (r, s) in enumerate(
        [("system", None), ("user", f"q {c} [INST]"), ("assistant", "a\\</s>"), ("tool", ""), ("assistant", "😀")])]
    rows += [(None, 0, None, "no id"), (None, None, "user", "first"), (3, 2, "assistant", "a\\</s>"), (5, 9, None, None)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    got = {r.conv_id: r for r in chat.format_conversations(table.withColumn("record", table["role"])).collect()}
    assert chat.format_conversations(table.limit(0)).count() == 0
    conversations = {}
    for conv, turn, role, text in rows:
        line = chat.format_turn(role or "", text or "")[0]
        conversations.setdefault(conv, []).append((-1 if turn is None else turn, line, role or "", text or ""))
    assert set(got) == set(conversations)
    for conv, turns in conversations.items():
        turns.sort()
        loss = "".join(t[3] for t in turns if t[2] == "assistant")
        sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
        assert tuple(got[conv])[1:] == (
            len(turns), sha("".join(f"{t[2]}\n{t[3]}\n" for t in turns)), len(loss), sha(loss), sum(len(t[1]) for t in turns))
