"""Near-duplicates, repeated passages and exact copies against brute force."""

import hashlib
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from cairnlake.llm import chosen_path, seed_extend, stream_dedup
from cairnlake.llm.components import connected_components
from cairnlake.llm.scratch import stored
from cairnlake.session import scratch_path

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string"


def corpus(seed: int, count: int) -> list[tuple[int, str]]:
    draw = random.Random(seed)
    base = [" ".join(draw.choice("abcdefghij") * draw.randint(1, 3) for _ in range(60)) for _ in range(6)]
    rows = []
    for i in range(count):
        words = draw.choice(base).split()
        for _ in range(draw.choice([0, 0, 1, 2, 5, 30])):
            words[draw.randrange(len(words))] = f"edit{draw.randint(0, 99)}"
        if draw.random() < 0.3:
            words += draw.choice(base).split()[10:45]
        rows.append((i, draw.choice([" ", "\n"]).join(words)))
    return rows


def linked(rows, threshold, width=5):
    sets = {}
    for doc, text in rows:
        words = WORDS.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[doc] = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if len(words) >= width else {tuple(words)} - {()}
    least = {d: d for d in sets}

    def root(d):
        while least[d] != d:
            d = least[d]
        return d

    for a in sets:
        for b in sets:
            if a < b and sets[a] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) > 0:
                x, y = sorted((root(a), root(b)))
                least[y] = x
    return {d: (len(s), root(d)) for d, s in sets.items()}


@pytest.mark.parametrize("leaf, block, threshold", [(512, 1536, Fraction(85, 100)), (4, 8, Fraction(8, 10))])
def test_near_duplicates(spark, monkeypatch, leaf, block, threshold):
    monkeypatch.setattr(chosen_path, "LEAF", leaf)
    monkeypatch.setattr(chosen_path, "BLOCK", block)
    rows = corpus(7, 150)
    got = chosen_path.link_documents(spark.createDataFrame(rows, SCHEMA).repartition(5), threshold).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == linked(rows, threshold)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_links_between_components_of_equal_size():
    """A chain a1 - a2 - b1 - b2 whose middle link joins two components that are largest at the same time."""
    core, own_a, own_b = range(93), range(100, 107), range(200, 207)
    a2, b1 = [*core, *own_a], [*core, *own_b]
    a1, b2 = [*a2, *range(300, 316)], [*b1, *range(400, 416)]
    sets = [np.sort(np.array(s, dtype=np.uint64)) for s in (a1, a2, b1, b2)]
    forest = chosen_path.exact_links(sets, Fraction(85, 100))
    assert len({forest.root(i) for i in range(4)}) == 1


@given(st.integers(0, 10_000))
@settings(max_examples=60, deadline=None)
def test_links_are_those_of_all_pairs(seed):
    draw = random.Random(seed)
    base = [draw.sample(range(300), 40) for _ in range(3)]
    sets = []
    for _ in range(draw.randint(2, 30)):
        own = set(draw.choice(base)) - set(draw.sample(range(300), draw.randint(0, 60)))
        sets.append(own | set(draw.sample(range(300, 400), draw.randint(1, 4))))
    forest = chosen_path.exact_links([np.sort(np.array(list(s), dtype=np.uint64)) for s in sets], Fraction(8, 10))
    plain = chosen_path.Forest(len(sets))
    for i, a in enumerate(sets):
        for j in range(i):
            if 10 * len(a & sets[j]) >= 8 * len(a | sets[j]):
                plain.join(i, j)
    pairs = [(i, j) for i in range(len(sets)) for j in range(i)]
    assert [forest.root(i) == forest.root(j) for i, j in pairs] == [plain.root(i) == plain.root(j) for i, j in pairs]


def test_near_duplicates_of_every_kind_of_row(edge_documents, no_documents):
    got = chosen_path.link_documents(edge_documents).collect()
    assert len(got) == edge_documents.count()
    found = {r.doc_id: r.component_id for r in got}
    assert found[8] == found[9] == found[7] == 7 and found[13] == 12 and found[5] == 5 - 1
    assert [found[i] for i in (0, 1, 2)] == [0, 1, 2]
    assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)
    assert chosen_path.link_documents(no_documents).count() == 0
    kept = chosen_path.keep_one_of_each(edge_documents)
    assert kept.columns == edge_documents.columns and kept.where("doc_id = 8").count() == 0


@pytest.mark.parametrize("keep", [chosen_path.keep_one_of_each, stream_dedup.drop_copies])
def test_columns_of_any_name_keep_their_values(spark, keep):
    """Columns named as the operators' own helpers, and the smallest doc_id there is."""
    names = ["_id", "_sha", "_number", "_keep0", "_keep4", "digest", "doc", "n", "best", "locator", "h1", "cluster"]
    texts = ["one two three four five six seven", "one  two three four five six seven", "other words", None, "other words"]
    ids = [-(1 << 63), 3, 4, None, 5]
    rows = [(d, t, *(f"{name}-{i}" for name in names)) for i, (d, t) in enumerate(zip(ids, texts))]
    schema = ", ".join(["doc_id long", "text string", *(f"{name} string" for name in names)])
    docs = spark.createDataFrame(rows, schema).repartition(3)
    got = keep(docs)
    assert got.schema == docs.schema
    # The longer of the texts that differ in blanks stays in exact, the smaller doc_id in near deduplication.
    longer = 1 if keep is stream_dedup.drop_copies else 0
    assert sorted(map(str, got.collect())) == sorted(str(r) for r in docs.collect() if r.doc_id in (ids[longer], 4, None))
    assert keep(docs.limit(0)).count() == 0


def test_components(spark):
    draw = random.Random(3)
    pairs = [(draw.randrange(400), draw.randrange(400)) for _ in range(230)] + [(i, i + 1) for i in range(500, 560)]
    pairs += [(999, i) for i in range(1000, 1100)]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    least = {x: x for p in pairs for x in p}
    for _ in range(100):
        for a, b in pairs:
            least[a] = least[b] = min(least[a], least[b])
    assert got == {x: c for x, c in least.items() if any(x in p and p[0] != p[1] for p in pairs)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def without_repeats(rows, window):
    words = {i: WORDS.findall(text or "") for i, (_, text) in enumerate(rows)}
    seen = Counter(tuple(w[i : i + window]) for w in words.values() for i in range(len(w) - window + 1))
    out = []
    for i, (doc, _) in enumerate(rows):
        gone = {p for s in range(len(words[i]) - window + 1) if seen[tuple(words[i][s : s + window])] > 1 for p in range(s, s + window)}
        out.append((doc, len(words[i]), len(gone), " ".join(w for p, w in enumerate(words[i]) if p not in gone)))
    return Counter(out)


@pytest.mark.parametrize("window, anchor", [(35, 8), (6, 2)])
def test_repeated_passages(spark, window, anchor):
    rows = corpus(11, 60) + [(100, "so so so so so so so so so so so so"), (101, None), (102, ""), (103, "short")]
    rows += [rows[5], (None, rows[6][1]), (rows[7][0], "another text of this document")]
    got = seed_extend.remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(4), window, anchor)
    assert Counter(map(tuple, got.collect())) == without_repeats(rows, window)


def test_repeated_passages_of_every_kind_of_row(edge_documents, no_documents):
    rows = [(r.doc_id, r.text) for r in edge_documents.select("doc_id", "text").collect()]
    got = seed_extend.remove_repeats(edge_documents)
    assert Counter(map(tuple, got.collect())) == without_repeats(rows, 35)
    assert seed_extend.remove_repeats(no_documents).count() == 0


def copies(rows):
    groups = {}
    for doc, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), doc))
    out = []
    for doc, text in rows:
        plain = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        best = min(groups[plain], key=lambda x: (x[0], x[1] is None, x[1] or 0))[1]
        out.append((doc, best, len(groups[plain]), doc == best, hashlib.sha256(plain.encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("digits", [64, 1])
def test_exact_copies(spark, digits):
    """With one digit all digests collide, and comparing bytes has to tell texts apart."""
    rows = corpus(2, 50) + [(200, "a b"), (201, "ab "), (202, "a  b"), (203, None), (204, " "), (205, "")]
    got = stream_dedup.deduplicate(spark.createDataFrame(rows, SCHEMA).repartition(4), digits)
    assert Counter(map(tuple, got.collect())) == copies(rows)


def test_exact_copies_of_every_kind_of_row(edge_documents, no_documents):
    rows = [(r.doc_id, r.text) for r in edge_documents.select("doc_id", "text").collect()]
    assert Counter(map(tuple, stream_dedup.deduplicate(edge_documents).collect())) == copies(rows)
    assert stream_dedup.deduplicate(no_documents).count() == 0
    left = stream_dedup.drop_copies(edge_documents)
    assert left.columns == edge_documents.columns
    texts = [re.sub(r"\s", "", r.text or "") for r in left.select("text").collect()]
    assert len(texts) == len(set(texts)) == len({re.sub(r"\s", "", t or "") for _, t in rows})


def test_state_outlives_the_stream(spark):
    """A second run with the same checkpoint goes on counting from the state on disk."""
    work, source = scratch_path(spark, "test-state"), scratch_path(spark, "test-source")
    first = spark.createDataFrame([(2, "", 3, "d", "d"), (1, "", 3, "d", "d"), (5, "", 1, "e", "e")],
                                  "doc_id long, locator string, n_points long, text_sha256 string, digest string")
    more = spark.createDataFrame([(9, "", 7, "d", "d"), (0, "", 1, "f", "f")], first.schema)
    for rows in (first, more):
        rows.coalesce(1).write.mode("append").parquet(source)
        stream_dedup.run_stream(spark.readStream.schema(first.schema).parquet(source), f"{work}/c", f"{work}/u")
    entries = stream_dedup.last_entries(spark, f"{work}/u", stream_dedup.keyed_state(first)).collect()
    assert {(r.digest, r.n, ~r.best.minus_id) for r in entries} == {("d", 3, 9), ("e", 1, 5), ("f", 1, 0)}


def test_stored_tables_are_read_back(spark):
    assert stored(spark.range(3).toDF("a"), "test").count() == 3
