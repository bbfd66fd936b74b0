"""The whole pipeline against a plain version of its stages."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from cairnlake.llm import bradley_terry, mixing, queries
from cairnlake.llm.text_arrays import read_texts

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=queries.piece_model())
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def corpus():
    """Good and bad documents, chains of near copies, copies that differ in blanks, small sources, long and empty texts."""
    draw = random.Random(77)
    vocabulary = [f"{a}{b}" for a in ("ar", "ben", "cor", "del", "est") for b in ("an", "ol", "ith", "une")]

    def prose(count):
        words = draw.choices(vocabulary, k=count)
        return " ".join(w.capitalize() + "," if i % 9 == 0 else w + ("." if i % 9 == 8 else "") for i, w in enumerate(words))

    texts = [prose(draw.randrange(30, 200)) for _ in range(70)]
    texts += [" ".join(draw.choices(["!!", "buy", "$$$", "CLICK", "###"], k=draw.randrange(20, 80))) for _ in range(25)]
    for number in range(8):  # each text shares most with the one before, the ends of a chain too little
        words = prose(120).split()
        for step in range(5):
            texts.append(" ".join(words))
            words = words[6:] + prose(6).split()
    texts += [t.replace(" ", "  ", 3) for t in texts[:10]] + texts[3:6] + [prose(9000), None, "", "   ", "short one"]
    draw.shuffle(texts)
    sources = ["big"] * 6 + ["middle"] * 2 + ["small", None]
    rows = []
    for i, text in enumerate(texts):
        source = "tiny" if i == 17 else draw.choice(sources)
        rows.append((i * 3 - 40, text, "en", source, len(text or "")))
    labels = [(d, int(not (t and "$$$" in t)), 0) for d, t, *_ in rows if d % 4]
    return rows, labels


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def plain_exact(rows):
    best = {}
    for row in rows:
        key = re.sub(r"[\x20\x09-\x0D]", "", row[1] or "")
        best[key] = min(best.get(key, row), row, key=lambda r: (-len(r[1] or ""), r[0]))
    return list(best.values())


def plain_near(rows):
    rows = sorted(rows)
    sets, root = [shingles(r[1]) for r in rows], list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return [row for i, row in enumerate(rows) if top(i) == i]


def plain_mix(rows):
    size = {r[0]: len(WORD.findall(r[1] or "")) for r in rows}
    totals = defaultdict(int)
    for r in rows:
        totals[r[3]] += size[r[0]]
    block, quotas = mixing.plan_mix(list(totals.items()), (1, 2, 3), 3, 8, 6, 64)
    order = {r[0]: int(hashlib.md5(f"6:{r[0]}".encode()).hexdigest()[:15], 16) for r in rows}
    taken = []
    for quota in quotas:
        at, starts = 0, defaultdict(list)
        for row in sorted((r for r in rows if r[3] == quota.source), key=lambda r: order[r[0]]):
            if size[row[0]]:
                starts[at // block].append((at % block, row))
            at += size[row[0]]
        left = quota.taken
        while left > 0 and at:
            for b in sorted(range(quota.blocks), key=quota.turn):
                length = min(block, at - b * block)
                taken += [row for place, row in starts[b] if place < left]
                left -= min(length, max(left, 0))
    return taken


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path, (rows, labels) = tmp_path_factory.mktemp("pipeline"), corpus()
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(path / "labels.parquet"))
    return str(path)


def test_run_equals_the_plain_stages(spark, folder):
    rows, _ = corpus()
    allowed = ~bradley_terry.held_out(F.col("doc_id"), 3, 1)
    ranking = bradley_terry.learn(queries.documents(spark, folder), queries.labels(spark, folder), allowed, seed=1)
    scores = np.concatenate([ranking.score(bradley_terry.features(t)) for _, t in read_texts(pa.array([r[1] for r in rows], pa.string()))])
    good = [row for row, score in zip(rows, scores) if score >= 0.5]
    bad = {r[0] for r in rows if r[1] and "$$$" in r[1]}
    assert not bad & {r[0] for r in good} and len(good) >= len(rows) - len(bad) - 4
    exact = plain_exact(good)
    near = plain_near(exact)
    assert len(exact) < len(good) and len(near) < len(exact) - 10
    expected = []
    for row in plain_mix(near):
        ids = LIBRARY.encode(row[1] or "")
        digests = [hashlib.sha256(t.encode()).hexdigest() for t in (",".join(map(str, ids)), LIBRARY.decode(ids))]
        expected.append((row[0], len(ids), *digests))
    got = corpus_pipeline.run(spark, folder).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert sorted(map(tuple, got.collect())) == sorted(expected)


def test_stages_of_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    docs = queries.documents(spark, str(tmp_path))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, str(tmp_path))
        assert found.columns == docs.columns and found.count() == 0
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
