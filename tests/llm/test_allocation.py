"""Mixing, sharding and fingerprints."""

import hashlib
import struct
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
import regex
import xxhash
from hypothesis import given, settings, strategies as st

from cairnlake.llm import i_match, mixing, row_numbers, sharding
from cairnlake.llm.text_arrays import read_texts


@given(st.lists(st.integers(0, 50), min_size=1, max_size=7))
def test_targets_share_everything_below_their_limits(tokens):
    weights = [1 + i % 3 for i in range(len(tokens))]
    targets = mixing.share_targets(tokens, weights, 3)
    assert sum(targets) == pytest.approx(sum(tokens))
    assert all(t <= 3 * n + 1e-9 for t, n in zip(targets, tokens))
    free = [t / w for t, n, w in zip(targets, tokens, weights) if t < 3 * n - 1e-9]
    assert not free or max(free) - min(free) < 1e-6 * max(1, max(free))


@given(st.lists(st.integers(0, 30), min_size=1, max_size=6), st.integers(0, 60))
def test_apportionment_gives_to_the_highest_quotient(targets, seats):
    limits = [3 * t + 1 for t in targets]
    got = [0] * len(targets)
    for _ in range(seats):
        open_ = [i for i, t in enumerate(targets) if t and got[i] < limits[i]]
        if not open_:
            break
        got[max(open_, key=lambda i: (Fraction(targets[i], 2 * got[i] + 1), -i))] += 1
    assert mixing.apportion([float(t) for t in targets], limits, seats) == got


@pytest.mark.parametrize("documents_per_range", [3, 4000])
def test_mix_against_its_plan(spark, monkeypatch, documents_per_range):
    monkeypatch.setattr(mixing, "DOCUMENTS_PER_RANGE", documents_per_range)
    rows = [(i, " ".join(["w"] * (i % 37)), None if i % 11 == 0 else f"s{i % 4}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    got = mixing.mix_documents(docs, seed=1).toPandas()
    assert mixing.mix_documents(docs.repartition(3), seed=1).toPandas().sort_values("doc_id").taken.tolist() == got.sort_values("doc_id").taken.tolist()
    assert (got.taken <= 3 * got["size"]).all()
    by = defaultdict(lambda: [0, 0, 0, 0])
    source = {d: s for d, _, s in rows}
    for r in got.itertuples():
        own = by[source[r.doc_id]]
        own[0] += r.size
        own[1] += r.taken
        own[2], own[3] = r.source_size, r.target
    names = sorted(s for s in by if s) + [None]
    targets = mixing.share_targets([by[s][0] for s in names], [1, 2, 3, 1, 2], 3)
    for name, target in zip(names, targets):
        assert by[name][2] == by[name][0] and by[name][3] == pytest.approx(target)
        assert abs(by[name][1] - target) <= 4
    assert (got.by_shard.map(sum) == got.taken).all()
    before = Counter((d, t) for d, t, _ in rows)
    taken = Counter()
    for r in mixing.taken_texts(docs, seed=1).collect():
        assert before[r.doc_id, r.text] == 1
        taken[r.source] += len(r.text.split())
    # Whole documents: off by those that lie across the end of what is taken.
    assert all(abs(taken[n] - t) <= 4 * 37 for n, t in zip(names, targets))


def plain_mix(documents, weights, max_repeats, shards, seed, block):
    """Words that each shard takes of each document: seats given one by one, blocks taken word by word."""
    words = defaultdict(list)
    order = {doc: int(hashlib.md5(f"{seed}:{doc}".encode()).hexdigest()[:15], 16) for doc, _, _ in documents}
    for doc, size, source in sorted(documents, key=lambda r: order[r[0]]):
        words[source] += [doc] * size
    sources = sorted((s for s in {r[2] for r in documents} if s is not None)) + [None] * any(r[2] is None for r in documents)
    targets = mixing.share_targets([len(words[s]) for s in sources], [weights[i % len(weights)] for i in range(len(sources))], max_repeats)
    queues = []
    for i, source in enumerate(sources):
        own = words[source]
        cut = [own[j : j + block] for j in range(0, len(own), block)]
        draw = int(hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), 16)
        factor, count = draw % max(len(cut), 1), max(len(cut), 1)
        while Fraction(factor, count).denominator != count:
            factor += 1
        turns = sorted(range(len(cut)), key=lambda b: (b * factor + (draw >> 64)) % count)
        left, queue = min(max_repeats * len(own), int(targets[i] + 0.5)), []
        while left > 0 and cut:
            for b in turns:
                if left > 0:
                    queue.append(cut[b][:left])
                    left -= len(queue[-1])
        queues.append(queue)
    total, given = sum(map(len, queues)), [0] * len(sources)
    taken = defaultdict(lambda: [0] * shards)
    for shard in range(shards):
        for _ in range(total * (shard + 1) // shards - total * shard // shards):
            waiting = [i for i in range(len(sources)) if given[i] < len(queues[i])]
            i = max(waiting, key=lambda i: (Fraction(targets[i]) / (2 * given[i] + 1), -i))
            for doc in queues[i][given[i]]:
                taken[doc][shard] += 1
            given[i] += 1
    return taken


@pytest.mark.parametrize("block, shards", [(7, 8), (64, 3), (1000, 5)])
def test_shards_take_the_blocks_of_their_quotas(spark, monkeypatch, block, shards):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", block)
    plan = mixing.plan_mix
    monkeypatch.setattr(mixing, "plan_mix", lambda *given: plan(*given[:5], least_blocks=1))
    names = ["big"] * 200 + ["small"] * 6 + ["tiny", None, None] + ["other"] * 60
    documents = [(i, i * 7 % 31, name) for i, name in enumerate(names)]
    rows = [(i, " ".join(["w"] * size), name) for i, size, name in documents]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    expected = plain_mix(documents, (1, 3, 2, 2), 3, shards, 1, block)
    got = mixing.mix_documents(docs, weights=(1, 3, 2, 2), shards=shards, seed=1).collect()
    assert {r.doc_id: r.by_shard for r in got} == {doc: expected[doc] for doc, _, _ in documents}


@pytest.mark.parametrize("least_blocks", [10_000, 100_000])
def test_small_sources_get_their_targets(least_blocks):
    """Sources far smaller than a block, and one of two thirds of a block with a target of three times its size."""
    sizes = {"a": 5_000_000_000, "b": 20_000, "c": 10_000, "d": 1, "e": 70_001, None: 300}
    block, quotas = mixing.plan_mix(list(sizes.items()), (1, 2, 3), 3, 8, 0, least_blocks)
    assert block > 25_000
    for q in quotas:
        assert abs(q.taken - q.target) <= 1 and list(q.shard_ends) == sorted(q.shard_ends)
        turns, cut = mixing.last_pass(q.tokens, q.taken, q.blocks, block, q.turn(q.blocks - 1))
        assert q.shard_ends[-1] == q.taken // q.tokens * q.blocks + turns + (cut > 0)
        taken = [min(block, q.tokens - b * block) for b in range(q.blocks)]
        order = sorted(range(min(q.blocks, 10)), key=q.turn)
        if q.blocks < 10:
            in_last = sum(taken[b] for b in order[:turns]) + cut
            assert q.taken == q.taken // q.tokens * q.tokens + in_last
            assert not cut or cut < taken[order[turns]]
    # Every shard has as many blocks, and its quota of the largest source is what that source has of all.
    seats = [sum(q.shard_ends[s] - (q.shard_ends[s - 1] if s else 0) for q in quotas) for s in range(8)]
    assert max(seats) - min(seats) <= 1


@pytest.mark.parametrize("block", [7, 64, 1000])
def test_mix_takes_its_quota_to_the_word(spark, monkeypatch, block):
    """Blocks larger than documents and than sources; the texts have the words that are counted."""
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", block)
    plan = mixing.plan_mix
    monkeypatch.setattr(mixing, "plan_mix", lambda *given: plan(*given[:5], least_blocks=1))
    names = ["big"] * 300 + ["small"] * 6 + ["tiny", None, None]
    rows = [(i, " ".join(f"{i}w{j}" for j in range(1 + i * 7 % 31)), name) for i, name in enumerate(names)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = {r.doc_id: r for r in mixing.mix_documents(docs, weights=(1, 3, 2, 2), seed=1).collect()}
    for name in set(names):
        own = [got[d] for d, _, s in rows if s == name]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 1
    texts = {d: t for d, t, _ in rows}
    words = Counter()
    for r in mixing.taken_texts(docs, weights=(1, 3, 2, 2), seed=1).collect():
        assert r.text == texts[r.doc_id]
        words[r.source] += len(r.text.split())
    for name in set(names):
        target = next(got[d].target for d, _, s in rows if s == name)
        assert abs(words[name] - target) <= 4 * 31


def test_mix_takes_every_kind_of_row(edge_documents, no_documents):
    got = mixing.mix_documents(edge_documents).toPandas()
    assert len(got) == edge_documents.count() and (got.taken <= 3 * got["size"]).all()
    assert (got.groupby(got.target).taken.sum() - got.groupby(got.target).target.first()).abs().max() <= 4
    assert mixing.mix_documents(no_documents).count() == 0
    texts = mixing.taken_texts(edge_documents)
    assert texts.columns == edge_documents.columns and texts.count() > 0
    assert mixing.taken_texts(no_documents).count() == 0


@given(st.integers(1, 700), st.integers(0, 5))
@settings(max_examples=25, deadline=None)
def test_permutation_is_one(count, seed):
    permutation = sharding.Permutation(count, seed)
    places = [permutation.place(row) for row in range(count)]
    assert sorted(places) == list(range(count))
    assert [permutation.row(p) for p in places] == list(range(count))


def test_shards_against_the_permutation(spark):
    rows = [(i * 3 - 50, f"text {i % 40} é" if i % 9 else None) for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = sorted(sharding.shard_documents(docs, 40, 10).collect(), key=lambda r: r.doc_id)
    permutation = sharding.Permutation(500, 10)
    for number, (r, (doc, text)) in enumerate(zip(got, rows)):
        data = (text or "").encode()
        place = permutation.place(number)
        assert tuple(r) == (doc, len(data) + 16, zlib.crc32(data), "rows", place % 40, place // 40, None)


@pytest.mark.parametrize("rows_per_range", [1, 100_000])
def test_row_numbers_are_gapless_in_order(spark, monkeypatch, rows_per_range):
    monkeypatch.setattr(row_numbers, "CUTS", 7)
    keys = [k * k * (-1) ** k for k in range(300)] + [5] * 40 + [-(1 << 62), 1 << 62]
    table = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key long, i int").repartition(5)
    got = row_numbers.with_row_number(table, "key", ["i"], "number", rows_per_range).collect()
    assert [(r.key, r.i) for r in sorted(got, key=lambda r: r.number)] == sorted((k, i) for i, k in enumerate(keys))
    assert sorted(r.number for r in got) == list(range(len(keys)))


def test_shards_of_every_kind_of_row(edge_documents, no_documents):
    got = sharding.shard_documents(edge_documents, 4).collect()
    count = edge_documents.count()
    assert sorted((r.shard, r.slot) for r in got) == sorted((p % 4, p // 4) for p in range(count))
    assert sharding.shard_documents(no_documents, 4).count() == 0


def plain_terms(text):
    found = {t for t in regex.split(r"[^\p{L}\p{N}]+", text.lower()) if t}
    return sorted(signed(xxhash.xxh64_intdigest(t.encode(), 42)) for t in found)


def signed(number):
    return number - (1 << 64) if number >> 63 else number


def hash_of(numbers):
    found = 42
    for n in numbers:
        found = xxhash.xxh64_intdigest(struct.pack("<q", n), found)
    return found


def plain_parts(own):
    """The hash of the sorted terms that each fixed lexicon has."""
    parts = []
    for size in range(2, 10):
        for draw in range(4):
            mask = (1 << size) - 1
            kept = [h for h in own if xxhash.xxh64_intdigest(struct.pack("<i", draw), hash_of([h])) & mask == 0]
            parts.append(hash_of(kept) & 0xFFFFFFFF | 1 if kept else 0)
    return parts


def plain_likeness(a, b):
    used = [(x, y) for x, y in zip(a[1], b[1]) if x or y]
    return 1.0 if a == b else sum(x == y for x, y in used) / len(used) if used else 0.0


@pytest.mark.parametrize("low, high", [(0.05, 0.5), (0.9, 0.95)])
def test_fingerprints_equal_plain_python(spark, low, high):
    """Band, lexicons, hashes and likeness; with the second band no text has a term of it."""
    rows = [(i, " ".join(f"T{(i * 7 + j) % 150 + 100 * (j % 3)}é," for j in range(40 + 3 * i))) for i in range(40)]
    rows += [(50, None), (51, "tiny text"), (52, ""), (53, rows[3][1])]
    texts = [t or "" for _, t in rows]
    count = Counter(slot for t in texts for slot in {h & 0xFFFFF for h in plain_terms(t)})
    band = {slot for slot, n in count.items() if low <= n / len(texts) <= high}

    def fingerprint(text):
        every = plain_terms(text)
        return hash_of(every), plain_parts([h for h in every if h & 0xFFFFF in band] or every)

    def as_text(print_):
        return f"{print_[0]:016x}" + "".join(f"{p:08x}" for p in print_[1])

    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for r in i_match.fingerprint_documents(docs, (low, high)).collect():
        i = [d for d, _ in rows].index(r.doc_id)
        after, part = texts[(i + 1) % len(texts)], len(texts[i]) // 4
        own, changed, other = map(fingerprint, (texts[i], texts[i][: len(texts[i]) - part] + after[:part], after))
        assert (r.fingerprint, r.edited_fingerprint) == (as_text(own), as_text(changed))
        assert r.near_edited == pytest.approx(plain_likeness(own, changed))
        assert r.near_next == pytest.approx(plain_likeness(own, other))


@pytest.mark.parametrize("texts_per_range", [1, 4000])
def test_fingerprints_and_edits(spark, edge_documents, no_documents, monkeypatch, texts_per_range):
    monkeypatch.setattr(i_match, "TEXTS_PER_RANGE", texts_per_range)
    rows = [(i, " ".join(f"t{(i * 7 + j) % 150 + 100 * (j % 3)}é" for j in range(40 + i))) for i in range(0, 60, 2)]
    rows += [(5, rows[2][1]), (70, None), (71, "tiny text"), (72, "")]
    rows.sort()
    got = sorted(i_match.fingerprint_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect(), key=lambda r: r.doc_id)
    texts = [t or "" for _, t in rows]
    for i, r in enumerate(got):
        part = len(texts[i]) // 4
        edited = texts[i][: len(texts[i]) - part] + texts[(i + 1) % len(texts)][:part]
        assert (r.doc_id, r.n_chars, r.edited_sha256) == (rows[i][0], len(texts[i]), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    prints = defaultdict(set)
    for text, r in zip(texts, got):
        prints[text].add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values()) and len({p for s in prints.values() for p in s}) == len(prints)
    assert sum(r.near_edited for r in got[:20]) > 2 * sum(r.near_next for r in got[:20])
    assert i_match.fingerprint_documents(edge_documents).count() == edge_documents.count()
    assert i_match.fingerprint_documents(no_documents).count() == 0
    single = i_match.fingerprint_documents(edge_documents.where("doc_id = 12")).first()
    assert single.near_next == 1.0
