"""Conversation repair against all edit sequences, and against a plain program on whole tables."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import cache

import pytest
from helpers import rows

from cairnlake.llm import conversation_repair as cr

BLANKS = r"[^\x20\x09-\x0D]"
KINDS = [("s", False), ("u", False), ("a", False), ("t", False), ("u", True), ("a", True), ("s", True), None]


def codes(kinds):
    return bytes(0 if k is None else cr.code_of(*k) for k in kinds)


def every_repair(kinds):
    """The best (cost, audit) of all sequences with up to two insertions in a gap."""
    gaps = [(2 * len(g), "I" * len(g), g) for n in range(3) for g in map("".join, itertools.product("ua", repeat=n))]
    best = None
    choices = []
    for kind in kinds:
        own = [(3, "D", "")]
        if kind is not None:
            own += [(kind[1], "K", kind[0]), (2 + kind[1], "R", "u"), (2 + kind[1], "R", "a")]
        choices.append(own)
    parts = [gaps]
    for own in choices:
        parts += [own, gaps]
    for path in itertools.product(*parts):
        if re.fullmatch("(s?(ua)+)?", "".join(p[2] for p in path)):
            one = (sum(p[0] for p in path), "".join(p[1] for p in path))
            best = one if best is None else min(best, one)
    return best


@pytest.mark.parametrize("length", [0, 1, 2])
def test_all_short_conversations(length):
    for kinds in itertools.product(KINDS, repeat=length):
        audit, cost = cr.repair(codes(kinds))
        assert (cost, audit) == every_repair(kinds), kinds


def test_some_of_three_rows():
    random.seed(3)
    for _ in range(12):
        kinds = random.choices(KINDS, k=3)
        audit, cost = cr.repair(codes(kinds))
        assert (cost, audit) == every_repair(kinds), kinds


def suffix_repair(kinds):
    """The best (cost, audit) from each place and last role on, whole suffixes compared."""

    @cache
    def best(i, last, inserted):
        ways = []
        follows = {"": "u", "s": "u", "u": "a", "a": "u"}[last]
        if i == len(kinds):
            if last in ("", "a"):
                ways.append((0, ""))
        else:
            def row(cost, name, to):
                c, rest = best(i + 1, to, 0)
                ways.append((c + cost, name + rest))

            row(3, "D", last)
            if kinds[i] is not None:
                initial, cut = kinds[i]
                if initial == follows or (initial == "s" and last == ""):
                    row(int(cut), "K", initial)
                row(2 + cut, "R", follows)
        if inserted < 2:
            c, rest = best(i, follows, inserted + 1)
            ways.append((c + 2, "I" + rest))
        return min(ways, default=(10**9, ""))

    return best(0, "", 0)


def test_longer_conversations():
    random.seed(4)
    for _ in range(300):
        kinds = tuple(random.choices(KINDS, k=random.randrange(40)))
        audit, cost = cr.repair(codes(kinds))
        assert (cost, audit) == suffix_repair(kinds)


def test_long_conversation_has_the_cost_of_a_forward_pass():
    random.seed(5)
    kinds = random.choices(KINDS, k=100_003)
    audit, cost = cr.repair(codes(kinds))
    costs = {"": 0}

    def insertions(at):
        for _ in range(3):
            for last, c in list(at.items()):
                to = {"": "u", "s": "u", "u": "a", "a": "u"}[last]
                at[to] = min(at.get(to, 10**9), c + 2)
        return at

    costs = insertions(costs)
    for kind in kinds:
        after = {last: c + 3 for last, c in costs.items()}
        if kind is not None:
            for last, c in costs.items():
                to = {"": "u", "s": "u", "u": "a", "a": "u"}[last]
                after[to] = min(after.get(to, 10**9), c + 2 + kind[1])
                if kind[0] == to or (kind[0] == "s" and last == ""):
                    after[kind[0]] = min(after.get(kind[0], 10**9), c + kind[1])
        costs = insertions(after)
    assert cost == min(costs.get("", 10**9), costs.get("a", 10**9))
    assert len(audit.replace("I", "")) == len(kinds)


def plain(conversations):
    """Every result from rows (conv_id, turn, role, text), in plain Python."""
    groups = defaultdict(list)
    for conv, turn, role, text in conversations:
        own = groups[conv]
        role, text = " " if role is None else role, " " if text is None else text
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        damage = zlib.crc32(key.encode()) % 20
        if damage == 0:
            continue
        if damage == 1:
            text = ""
        if damage == 2:
            text = re.sub("[.!?]", "", text)
        if damage == 4:
            role = "user"
        own += [(turn, role, text)] * (2 if damage == 3 else 1)
    found = Counter()
    for conv, own in groups.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        turns = [r[0] for r in own if r[0] is not None]
        seen, kinds, count = set(), [], Counter()
        for _, role, text in own:
            signs = re.findall(BLANKS, text)
            fault = "blank" if not signs else "duplicate" if (role, text) in seen else "truncated" if signs[-1] not in ".!?" else ""
            seen.add((role, text))
            count[fault] += 1
            kinds.append(None if fault in ("blank", "duplicate") else (role[:1], fault == "truncated"))
        cost, audit = suffix_repair(tuple(kinds))
        out, last, left = [], "", iter(own)
        for edit in audit:
            follows = {"": "user", "s": "user", "u": "assistant", "a": "user"}[last]
            _, role, text = ("", follows, "") if edit == "I" else next(left)
            if edit != "D":
                role = role if edit == "K" else follows
                last = role[0]
                out.append(f"{role}:{text}")
        assert next(left, None) is None
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        digest = hashlib.sha256("\n".join(out).encode()).hexdigest()
        found[(conv, gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, digest)] += 1
    return found


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_edges(spark):
    random.seed(6)
    texts = [None, "", " \n\t ", "Yes.", "no", "a. b", "Really? ", "long " * 5000, "é!\x0b", "same.", "same."]
    roles = ["user", "assistant", "system", None, "", "tool", "User", "u"]
    table = [
        (random.choice([None, *range(30)]), random.choice([None, *range(-2, 9)]), random.choice(roles + ["user", "assistant"] * 4), random.choice(texts))
        for _ in range(600)
    ]
    table += [(100, None, None, None), (101, 2**62, "user", "far."), (101, 5, "user", "near.")] + [(7, 3, "user", "Yes.")] * 50
    conversations = spark.createDataFrame(table, "conv_id long, turn long, role string, text string").repartition(6)
    for name in ("kind", "print", "n", "first", "dropped", "_conv", "_copy"):
        conversations = conversations.withColumn(name, conversations["role"])
    found = cr.repair_conversations(conversations)
    assert found.columns == COLUMNS
    assert rows(found) == plain(table)


def test_given_table(spark):
    conversations = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    table = [tuple(r) for r in conversations.select("conv_id", "turn", "role", "text").collect()]
    assert rows(cr.repair_conversations(conversations)) == plain(table)


def test_empty_table_and_nothing_left(spark):
    kind = "conv_id long, turn long, role string, text string"
    assert cr.repair_conversations(spark.createDataFrame([], kind)).count() == 0
    turn = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    one = cr.repair_conversations(spark.createDataFrame([(1, turn, "user", "gone.")], kind)).first()
    assert tuple(one) == (1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
