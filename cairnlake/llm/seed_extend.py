"""Passages that repeat, by seed and extend on winnowed anchors.

Every window of ``window`` words holds one anchor: of its runs of ``anchor`` words, the one with the smallest hash
(the last of equal ones).  Equal windows have equal anchors, so a join on anchors finds every repeat.  Neighbouring windows
with the same anchor make a stretch.

Seeds are anchors that occur more than once.  They are extended both ways, first to whole stretches: where a whole
stretch occurs again, all its windows do.  Stretches that do not, which lie at the ends of repeats, are extended word by
word, by comparing the windows of the seed's stretches.  Joined, the repeated windows of a document are its maximal repeats
of at least ``window`` words.

Nothing is done pair by pair: occurrences are counted with map-side combine, and counts are joined back to them, so
a passage in a third of all documents costs each of them its own rows only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cairnlake.llm.scratch import stored
from cairnlake.llm.text_arrays import Texts, hash_runs, hash_spans, mix, ragged, read_texts
from cairnlake.llm.workers import map_batches

WINDOW_WORDS = 35
ANCHOR_WORDS = 8
_STEP = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(_STEP), -1, 2**64))


def last_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """For every run of ``width`` values, the position of its smallest (the last of equal ones)."""
    at, span = np.arange(len(values)), 1
    while span < width:
        shift = min(span, width - span)
        left, right = at[:-shift], at[shift:]
        at = np.where(values[right] <= values[left], right, left)
        span += shift
    return at


def _powers(step: np.uint64, count: int) -> np.ndarray:
    powers = np.full(max(count, 1), step, dtype=np.uint64)
    powers[0] = 1
    return np.cumprod(powers, dtype=np.uint64)


def stretches(texts: Texts, window: int, anchor: int) -> dict[str, np.ndarray]:
    """Of each text its stretches: ``text, start, windows, anchor, region`` (hashes of the anchor and of all words)."""
    starts, ends, bounds = texts.words()
    words = hash_spans(texts.data, starts, ends)
    counts = np.maximum(np.diff(bounds) - window + 1, 0)
    text, place = ragged(counts)
    first = bounds[:-1][text] + place
    if not len(first):
        return {k: np.zeros(0, np.int64) for k in ("text", "start", "windows")} | {
            k: np.zeros(0, np.uint64) for k in ("anchor", "region")
        }
    grams = hash_runs(words, anchor)
    chosen = last_minimum(grams, window - anchor + 1)[first]
    head = np.flatnonzero(np.r_[True, (chosen[1:] != chosen[:-1]) | (text[1:] != text[:-1])])
    windows = np.diff(np.r_[head, len(first)])
    low, high = first[head], first[head] + windows + window - 1
    total = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(mix(words, 5) * _powers(_STEP, len(words)), out=total[1:])
    region = (total[high] - total[low]) * _powers(_INVERSE, len(words))[low]
    shape = ((high - low) * 4096 + (chosen[head] - low)).astype(np.uint64)
    return {
        "text": text[head],
        "start": place[head],
        "windows": windows,
        "anchor": grams[chosen[head]],
        "region": mix(region ^ mix(shape, 9), 13),
    }


def _content(docs: DataFrame) -> DataFrame:
    """``doc_id, key, text``; the key tells apart rows that share a doc_id."""
    return docs.select(
        F.coalesce(docs["doc_id"].cast("long"), F.lit(-(1 << 63))).alias("doc_id"),
        F.xxhash64(docs["text"]).alias("key"),
        docs["text"].alias("text"),
    )


def _seeded(content: DataFrame, window: int, anchor: int) -> DataFrame:
    """The stretches whose anchor occurs more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in read_texts(batch.column("text")):
                found = stretches(texts, window, anchor)
                rows = pa.array(first + found["text"])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(rows),
                        batch.column("key").take(rows),
                        pa.array(found["anchor"].view(np.int64)),
                        pa.array(found["region"].view(np.int64)),
                        pa.array(found["start"].astype(np.int32)),
                        pa.array(found["windows"].astype(np.int32)),
                    ],
                    names=["doc_id", "key", "anchor", "region", "start", "windows"],
                )

    schema = "doc_id long, key long, anchor long, region long, start int, windows int"
    every = stored(map_batches(content, run, schema), "stretches")
    often = every.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    return stored(every.join(stored(often, "anchors"), "anchor"), "seeds")


def _ends(content: DataFrame, seeds: DataFrame, window: int) -> DataFrame:
    """Repeated windows of stretches that do not repeat as a whole: ``doc_id, key, span``."""
    regions = seeds.groupBy("anchor", "region").agg(
        F.count(F.lit(1)).alias("times"), F.min(F.struct("doc_id", "key", "start", "windows")).alias("one")
    )
    regions = stored(regions, "regions")
    open_anchors = stored(regions.where("times = 1").select("anchor").distinct(), "open-anchors")
    # One stretch stands for all that are equal to it; its windows are known to repeat.
    compared = regions.join(open_anchors, "anchor").select(
        "one.doc_id", "one.key", F.struct("one.start", "one.windows", "anchor", "times").alias("stretch")
    )
    per_text = compared.groupBy("doc_id", "key").agg(F.collect_list("stretch").alias("stretches"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in read_texts(batch.column("text")):
                starts, ends, bounds = texts.words()
                runs = hash_runs(hash_spans(texts.data, starts, ends), window, salt=1000)
                listed = batch.column("stretches").slice(first, len(texts))
                owner = np.repeat(np.arange(len(texts)), np.diff(listed.offsets.to_numpy()))
                inner = listed.flatten()
                start, count = inner.field("start").to_numpy(), inner.field("windows").to_numpy()
                stretch, place = ragged(count)
                at = start[stretch] + place
                rows = pa.array(first + owner[stretch])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(rows),
                        batch.column("key").take(rows),
                        inner.field("anchor").take(pa.array(stretch)),
                        pa.array(runs[bounds[owner[stretch]] + at].view(np.int64)),
                        pa.array(at.astype(np.int32)),
                        pa.array(np.minimum(inner.field("times").to_numpy()[stretch], 2)),
                    ],
                    names=["doc_id", "key", "anchor", "run", "start", "times"],
                )

    texts = content.join(per_text.hint("shuffle_hash"), ["doc_id", "key"])
    windows = stored(
        map_batches(texts, run, "doc_id long, key long, anchor long, run long, start int, times long"), "windows"
    )
    again = stored(
        windows.groupBy("anchor", "run").agg(F.sum("times").alias("n")).where("n > 1").select("anchor", "run"), "again"
    )
    # Windows of stretches known to repeat as a whole (times 2) are spans already.
    return (
        windows.where("times = 1")
        .join(again, ["anchor", "run"])
        .select("doc_id", "key", _span(F.col("start"), F.col("start") + window).alias("span"))
    )


def _span(start, end):
    return F.shiftleft(start.cast("long"), 32) + end.cast("long")


def repeated_spans(docs: DataFrame, window: int = WINDOW_WORDS, anchor: int = ANCHOR_WORDS) -> DataFrame:
    """``doc_id, key, spans``: for each text with repeats, word spans ``start << 32 | end`` whose union repeats."""
    content = _content(docs)
    seeds = _seeded(content, window, anchor)
    whole = stored(
        seeds.groupBy("anchor", "region").agg(F.count(F.lit(1)).alias("times")).where("times > 1"), "whole"
    )
    spans = seeds.join(whole, ["anchor", "region"]).select(
        "doc_id", "key", _span(F.col("start"), F.col("start") + F.col("windows") + (window - 1)).alias("span")
    )
    every = spans.unionByName(_ends(content, seeds, window))
    return every.groupBy("doc_id", "key").agg(F.collect_set("span").alias("spans"))


def covered(count: int, spans: np.ndarray) -> np.ndarray:
    """Which of ``count`` words lie in a span."""
    edge = np.zeros(count + 1, dtype=np.int64)
    np.add.at(edge, spans >> 32, 1)
    np.add.at(edge, spans & 0xFFFFFFFF, -1)
    return np.cumsum(edge[:-1]) > 0


def remove_repeats(
    docs: DataFrame, window: int = WINDOW_WORDS, anchor: int = ANCHOR_WORDS, digest: bool = False
) -> DataFrame:
    """``doc_id, n_words, n_removed`` and ``kept`` (the words that stay, joined by one space) of every row.

    A word goes when a window of ``window`` words around it also starts elsewhere, in the same text or another; windows
    are those of the input.  A null text has no words; texts shorter than a window keep all.  Of rows that repeat as a
    whole, every window occurs elsewhere.  Extra columns are not read.  With ``digest``, ``kept_sha256`` is
    returned in place of the words.
    """
    name = "kept_sha256" if digest else "kept"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in read_texts(batch.column("text")):
                starts, ends, bounds = texts.words()
                removed, kept = [], []
                for i in range(len(texts)):
                    low, high = bounds[i], bounds[i + 1]
                    at, to = starts[low:high], ends[low:high]
                    spans = batch.column("spans")[first + i]
                    gone = 0
                    if spans.is_valid:
                        stay = ~covered(int(high - low), spans.values.to_numpy())
                        at, to = at[stay], to[stay]
                        gone = int(high - low) - len(at)
                    text = b" ".join([texts.data[a:b].tobytes() for a, b in zip(at, to)])
                    removed.append(gone)
                    kept.append(hashlib.sha256(text).hexdigest() if digest else text.decode())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, len(texts)),
                        pa.array(np.diff(bounds), pa.int64()),
                        pa.array(removed, pa.int64()),
                        pa.array(kept, pa.string()),
                    ],
                    names=["doc_id", "n_words", "n_removed", name],
                )

    spans = repeated_spans(docs, window, anchor)
    joined = _content(docs).join(spans.hint("shuffle_hash"), ["doc_id", "key"], "left").select("doc_id", "text", "spans")
    done = map_batches(joined, run, f"doc_id long, n_words long, n_removed long, {name} string")
    return done.withColumn("doc_id", F.when(F.col("doc_id") != F.lit(-(1 << 63)), F.col("doc_id")))
