"""Filter audit against all permutations in plain Python."""

import itertools
import re
from collections import Counter

from helpers import rows

from cairnlake.llm import filter_audit

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def plain_audit(documents, labels):
    """``documents``: (doc_id, text, source); ``labels``: (doc_id, quality, toxic)."""
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, t in labels if t == 1}
    first = {}
    for doc, text, _ in documents:
        if doc is not None:
            first[text or ""] = min(doc, first.get(text or "", doc))
    fails = []
    for doc, text, source in documents:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        bad = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": doc is not None and doc > first[text],
        }
        fails.append((source or "", {k for k, v in bad.items() if v}, doc in good and doc is not None, doc in toxic and doc is not None))
    found = []
    for part in {f[0] for f in fails}:
        own = [f[1:] for f in fails if f[0] == part]
        removed_by = Counter()
        part_rows = []
        for order in itertools.permutations("ABCDE"):
            left = list(own)
            gone = []
            for step, letter in enumerate(order, 1):
                here = [d for d in left if letter in d[0]]
                redundant = sum(letter in d[0] for d in gone)
                left = [d for d in left if letter not in d[0]]
                gone += here
                removed_by[letter] += len(here)
                part_rows.append(
                    [part, "".join(order), step, len(left), len(here), redundant, sum(d[0] == {letter} for d in own),
                     sum(d[1] for d in here), sum(d[2] for d in here)]
                )
        found += [tuple([*r, removed_by[r[1][r[2] - 1]]]) for r in part_rows]
    return Counter(found)


def test_edges_equal_all_permutations(spark, edge_documents):
    known = [(1, 1, 0), (4, None, 1), (7, 1, 1), (7, 0, 0), (8, 1, None), (None, 1, 1), (999, 1, 1)]
    labels = spark.createDataFrame(known, "doc_id long, quality int, toxic int")
    documents = [tuple(r) for r in edge_documents.select("doc_id", edge_documents["text"], "source").collect()]
    documents = [(d, t, s) for d, t, s in documents]
    found = filter_audit.audit_documents(edge_documents, labels)
    assert found.columns == COLUMNS
    assert rows(found) == plain_audit(documents, known)


def test_copies_capitals_and_many_parts(spark):
    texts = ["a b c # d", "AAAA b", "same words here", "x " * 300, " ".join(f"w{i}" for i in range(250)), None, ""]
    documents = [(i, texts[i % 7], f"s{i % 40}" if i % 11 else None) for i in range(300)]
    documents += [(None, "same words here", "s1")] * 3
    known = [(i, i % 3 == 0, i % 5 == 0) for i in range(0, 300, 2)]
    docs = spark.createDataFrame(documents, "doc_id long, text string, source string")
    labels = spark.createDataFrame([(a, int(b), int(c)) for a, b, c in known], "doc_id long, quality int, toxic int")
    assert rows(filter_audit.audit_documents(docs, labels)) == plain_audit(documents, known)


def test_empty_tables(spark, no_documents):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit_documents(no_documents, labels).count() == 0
    one = spark.createDataFrame([(1, "a", None)], "doc_id long, text string, source string")
    found = filter_audit.audit_documents(one, labels)
    assert found.count() == 600 and found.agg({"removed": "sum"}).first()[0] == 120


def test_shares_are_those_of_shapley(spark):
    masked = spark.createDataFrame([("p", m, 0, 0) for m in range(8) for _ in range(m + 1)], "part string, mask int, good int, toxic int")
    found = filter_audit.audit(masked, "ABC").selectExpr("substr(filter_order, step, 1) AS letter", "shapley").distinct()
    # A document that fails k filters is removed by each of them in 1/k of the 6 orders.
    expected = {
        letter: sum((m + 1) * 6 // bin(m).count("1") for m in range(8) if m >> i & 1) for i, letter in enumerate("ABC")
    }
    assert dict(map(tuple, found.collect())) == expected
