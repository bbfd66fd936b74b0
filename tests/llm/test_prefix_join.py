"""Benchmark decontamination against plain string comparison."""

import hashlib
import random
import re
from collections import Counter

import pytest
from helpers import rows
from pyspark.sql import functions as F

from cairnlake.llm import prefix_join

COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain(documents, items, window=10):
    windows = set()
    for item, text in items:
        own = words(text)
        windows |= {(item, tuple(own[i : i + window])) for i in range(max(len(own) - window, 0) + 1) if own}
    found = Counter()
    for doc, text in documents:
        own = words(text)
        hit, seen = set(), set()
        for item, run in windows:
            for i in range(len(own) - len(run) + 1):
                if tuple(own[i : i + len(run)]) == run:
                    hit |= set(range(i, i + len(run)))
                    seen.add(item)
        listed = sorted(str(i) for i in seen if i is not None)
        digest = hashlib.sha256(",".join(listed).encode()).hexdigest()
        found[(doc, len(own), len(hit), len(listed), digest, bool(hit))] += 1
    return found


@pytest.fixture(scope="module")
def items():
    random.seed(12)
    said = [f"t{random.randrange(40)}" for _ in range(60)]
    return [
        (1, " ".join(said[:25])),
        (2, " ".join(said[20:45])),
        (2, " ".join(said[20:45])),
        (3, "Hello, World!"),
        (4, "a"),
        (5, None),
        (6, " .,; "),
        (7, "one two three four five six"),
        (8, "y y y y y y y y y y y y"),
        (9, "日本 é ß"),
        (10, "one two three four five six seven eight nine"),
        (12, " ".join(said[:25])),
        (None, "nobody's item of words"),
    ], said


def test_edges(spark, edge_documents, items):
    benchmark = spark.createDataFrame(items[0], "item_id long, text string").selectExpr("*", "'x' AS words", "'y' AS win", "1 AS token")
    found = prefix_join.find_contamination(edge_documents, benchmark)
    assert found.columns == COLUMNS
    documents = [tuple(r) for r in edge_documents.select("doc_id", edge_documents["text"]).collect()]
    assert rows(found) == plain(documents, items[0])


@pytest.mark.parametrize("window, shingle", [(10, 4), (3, 2), (4, 4)])
def test_random_texts(spark, items, window, shingle):
    random.seed(window)
    said = items[1]
    documents = [(None, "nobody's item of words"), (0, "x nobody's item of words x")]
    for i in range(1, 120):
        own = []
        for _ in range(random.randrange(6)):
            a = random.randrange(len(said))
            own += said[a : a + random.randrange(1, 30)] + random.choices(said + ["y", "one", "two", "a"], k=random.randrange(4))
            own += ["y"] * random.choice([0, 0, 3, 9, 10, 15])
        documents.append((i % 100, random.choice([" ", ", ", "\n"]).join(w.upper() if random.random() < 0.2 else w for w in own)))
    docs = spark.createDataFrame(documents, "doc_id long, text string").repartition(5)
    benchmark = spark.createDataFrame(items[0], "item_id long, text string")
    expected = plain(documents, items[0], window)
    assert sum(1 for r in expected if r[5]) > 50
    assert rows(prefix_join.find_contamination(docs, benchmark, window, shingle)) == expected


def test_empty_tables(spark, no_documents, edge_documents, items):
    benchmark = spark.createDataFrame(items[0], "item_id long, text string")
    assert prefix_join.find_contamination(no_documents, benchmark).count() == 0
    found = prefix_join.find_contamination(edge_documents, benchmark.limit(0))
    assert found.count() == edge_documents.count() and found.where("contaminated OR n_hit > 0 OR n_items > 0").isEmpty()


def test_native(spark, edge_documents, items):
    benchmark = spark.createDataFrame(items[0], "item_id long, text string")
    plan = prefix_join.find_contamination(edge_documents, benchmark)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_places_do_not_hold_their_document(spark):
    """A document that is benchmark text throughout has a place for every word: with all words in each it would take gigabytes."""
    draw = random.Random(4)
    items = [(i, " ".join(f"w{draw.randint(0, 3000)}" for _ in range(40))) for i in range(60)] + [(60, "two words"), (61, "one")]
    long_ = " ".join(text for _ in range(8) for _, text in draw.sample(items, 60))
    rows_ = [(0, long_), (1, "one"), (2, "w1 two words w2"), (3, None)]
    docs, benchmark = spark.createDataFrame(rows_, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    bits = spark.range(1).select(F.expr("array_repeat(-1L, 65536)").alias("bits"))
    found = prefix_join.shingles_in_documents(docs, bits.scalar(), [1, 2, 4])
    below = found._jdf.queryExecution().optimizedPlan().children().head().output().toString()
    assert "_near" in below and "words#" not in below.replace("n_words#", "")
    longest = found.selectExpr("max(array_max(transform(found, x -> size(x.around))))").first()[0]
    assert longest == 2 * prefix_join.WINDOW - prefix_join.SHINGLE
    assert rows(prefix_join.find_contamination(docs, benchmark)) == plain(rows_, items)
