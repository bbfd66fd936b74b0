"""Toxicity by class-conditional Kneser-Ney models.

Two models, one of toxic and one of ordinary texts, are counted on all labelled documents they may learn from.  A word's
count in a class is Kneser and Ney's: after how many distinct words it stands there.  Copies of a text and words that a
text repeats add nothing to it.  Counts are absolutely discounted, and what the discounts take away goes to the
continuation counts of both classes together.  The discounts are in proportion to the size of a class, so that
what is rare rests on the shared counts and says nothing for either class.

The two log-likelihoods are subtracted, for each word and, divided by the number of words, for the whole text.  That of the
text and the largest of its words (toxic words stand among ordinary ones) are the features of a logistic calibration, fitted on
labelled documents that the counts leave out.

Pairs of words are counted over the whole corpus.  A word of which no count outlasts its discount rests on the shared
counts in both classes alike, so the difference of the logarithms is the same for all such words and they need no table.  Of
the others, those after the most words are sent to the workers, up to a fixed number.  If there are more, the words of the
documents that the workers do not have are joined with the rest, so no word is given up at any scale.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cairnlake.llm.bitmaps import bitmap, has_slot, slot_of
from cairnlake.llm.bradley_terry import held_out, labelled_sample
from cairnlake.llm.scratch import stored
from cairnlake.llm.text_arrays import Texts, hash_spans, lower_ascii, read_texts
from cairnlake.llm.workers import map_batches

#: Bits of a word's hash, and of the hash of the word before it, that tell words apart.
WORD_BITS, BEFORE_BITS = 40, 24
#: Words that are sent to the workers: 16 bytes for each.
SENT_WORDS = 1 << 20
#: Words are sent in steps of their counts, each by this factor above the one before it.
STEP = 1.05
#: Taken off every count of the smaller class; off those of the other, as many more as it has more contexts.
DISCOUNT = 4.0
#: Of the documents to learn from, one in so many is kept for the calibration ...
CALIBRATION_PARTS = 8
#: ... which takes at most so many of each label.
CALIBRATION_PER_CLASS = 5_000
RIDGE = 1e-2
_START = np.uint64(0x1ED270)

#: Words are runs of ASCII letters and digits and of all other characters beyond ASCII.
_OUTSIDE = np.ones(256, dtype=bool)
_OUTSIDE[0x80:] = False
for _low, _high in (("0", "9"), ("A", "Z"), ("a", "z")):
    _OUTSIDE[ord(_low) : ord(_high) + 1] = False


@dataclass(frozen=True)
class Tokens:
    """The words of some texts: their text, the bounds of each text's, and 40-bit hashes."""

    text: np.ndarray
    bounds: np.ndarray
    word: np.ndarray
    before: np.ndarray


def tokens(texts: Texts) -> Tokens:
    starts, ends, bounds = texts.words(_OUTSIDE)
    hashed = hash_spans(lower_ascii(texts.data), starts, ends)
    word, before = hashed >> np.uint64(64 - WORD_BITS), np.empty_like(hashed)
    before[1:] = hashed[:-1] >> np.uint64(64 - BEFORE_BITS)
    before[bounds[:-1][bounds[:-1] < bounds[1:]]] = _START
    return Tokens(np.repeat(np.arange(len(texts)), np.diff(bounds)), bounds, word, before)


@dataclass(frozen=True)
class Models:
    """Differences of log-likelihoods, toxic less ordinary, by word, and the calibration."""

    words: np.ndarray  # ascending: the words sent
    ratio: np.ndarray  # theirs
    other: float  # that of a word that no table has
    rest: DataFrame | None  # (word, ratio) of the words with a table that are not sent, if any
    weights: np.ndarray


def _features(models: Models, rows: DataFrame) -> DataFrame:
    """``key, most, mean`` of every row of ``rows(key, text)``: the largest difference of a word, and the mean; 0 without words."""
    words, ratio, other, listed = models.words, models.ratio, models.other, models.rest is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in read_texts(batch.column("text")):
                found = tokens(texts)
                at = np.minimum(np.searchsorted(words, found.word), max(len(words) - 1, 0))
                sent = words[at] == found.word if len(words) else np.zeros(len(found.word), dtype=bool)
                own = np.full(len(found.word), other)
                own[sent] = ratio[at[sent]]
                total = np.bincount(found.text, own, minlength=len(texts))
                count = np.diff(found.bounds)
                # The largest of the words that are certain: of those sent, and of all if there are no others to join.
                most = np.full(len(texts), -np.inf)
                certain = sent if listed else np.ones(len(sent), dtype=bool)
                np.maximum.at(most, found.text[certain], own[certain])
                columns = [batch.column("key").slice(first, len(texts)), pa.array(count, pa.int64()), pa.array(total), pa.array(most)]
                if listed:
                    order = np.lexsort((found.word[~sent], found.text[~sent]))
                    text, word = found.text[~sent][order], found.word[~sent][order]
                    head = np.flatnonzero(np.r_[True, (text[1:] != text[:-1]) | (word[1:] != word[:-1])]) if len(text) else np.zeros(0, int)
                    times = np.diff(np.r_[head, len(text)])
                    ends = pa.array(np.r_[0, np.cumsum(np.bincount(text[head], minlength=len(texts)))], pa.int32())
                    columns += [
                        pa.ListArray.from_arrays(ends, pa.array(word[head].view(np.int64))),
                        pa.ListArray.from_arrays(ends, pa.array(times, pa.int64())),
                    ]
                names = ["key", "count", "total", "most", "words", "times"][: len(columns)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, count long, total double, most double" + (", words array<long>, times array<long>" if listed else "")
    table = map_batches(rows, run, schema)
    mean = F.col("total") / F.greatest("count", F.lit(1))
    if listed:
        # Rows may repeat; their numbers are fixed once they are stored.
        table = stored(table.withColumn("_row", F.monotonically_increasing_id()), "words-to-join")
        asked = table.select("_row", F.explode(F.arrays_zip("words", "times")).alias("_w"))
        joined = (
            asked.select("_row", F.col("_w.words").alias("word"), F.col("_w.times").alias("times"))
            .join(models.rest, "word")
            .groupBy("_row")
            .agg(
                F.sum(F.col("times") * (F.col("ratio") - F.lit(other))).alias("_more"),
                F.max("ratio").alias("_most"),
                F.count(F.lit(1)).alias("_joined"),
            )
        )
        mean = (F.col("total") + F.coalesce("_more", F.lit(0.0))) / F.greatest("count", F.lit(1))
        unseen = F.when(F.size("words") > F.coalesce("_joined", F.lit(0)), F.lit(other))
        table = table.join(joined, "_row", "left").withColumn("most", F.greatest("most", "_most", unseen))
    full = F.col("count") > 0
    return table.select(
        "key", F.when(full, F.col("most")).otherwise(0.0).alias("most"), F.when(full, mean).otherwise(0.0).alias("mean")
    )


def count_words(sample: DataFrame) -> DataFrame:
    """``word, c0, c1, both`` over ``_label, text``: after how many distinct words every word stands in each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column("_label").to_numpy()
            for first, texts in read_texts(batch.column("text")):
                found = tokens(texts)
                pair = (found.word << np.uint64(BEFORE_BITS)) | found.before
                toxic = label[first + found.text] == 1
                ordinary, insulting = np.unique(pair[~toxic]), np.unique(pair[toxic])
                pairs = np.concatenate([ordinary, insulting])
                where = np.repeat(np.array([1, 2], dtype=np.int8), [len(ordinary), len(insulting)])
                yield pa.RecordBatch.from_arrays([pa.array(pairs.view(np.int64)), pa.array(where)], names=["pair", "seen"])

    # One long and one byte for each distinct pair of a task; classes are combined by their bits.
    pairs = map_batches(sample, run, "pair long, seen byte").groupBy("pair").agg(F.bit_or("seen").alias("seen"))
    return pairs.groupBy(F.shiftrightunsigned("pair", BEFORE_BITS).alias("word")).agg(
        F.sum(F.col("seen").bitwiseAND(F.lit(1)).cast("long")).alias("c0"),
        F.sum(F.shiftright(F.col("seen").cast("int"), 1).cast("long")).alias("c1"),
        F.count(F.lit(1)).alias("both"),
    )


def fit_tables(counts: DataFrame) -> Models:
    """The models' tables from the words' counts; the driver gets totals, and SENT_WORDS rows at most."""
    sums = counts.agg(
        *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("c0", "c1", "both")), F.count(F.lit(1)).alias("n")
    ).first()
    totals = [max(float(sums["c0"]), 1.0), max(float(sums["c1"]), 1.0)]
    discounts = [DISCOUNT * total / min(totals) for total in totals]
    left = [F.greatest(F.col(f"c{c}") - discounts[c], F.lit(0.0)) for c in (0, 1)]
    # The share of a class that the discounts leave to the shared counts, from all words.
    certain = counts.agg(*(F.coalesce(F.sum(own), F.lit(0.0)) for own in left)).first()
    free = [max(totals[c] - certain[c], 1e-9) for c in (0, 1)]
    mass = float(sums["both"]) + 0.5 * (float(sums["n"]) + 1)
    shared = (F.col("both") + 0.5) / mass
    likely = [(left[c] + free[c] * shared) / totals[c] for c in (0, 1)]
    table = stored(
        counts.where((F.col("c0") > discounts[0]) | (F.col("c1") > discounts[1])).select(
            "word", (F.log(likely[1]) - F.log(likely[0])).alias("ratio"), F.floor(F.log("both") / np.log(STEP)).cast("int").alias("step")
        ),
        "word-ratios",
    )
    least, room = None, SENT_WORDS
    steps = sorted(table.groupBy("step").count().collect(), reverse=True)
    for step, n in steps:
        if n > room:
            break
        least, room = step, room - n
    sent = (table.where(F.col("step") >= least) if least is not None else table.limit(0)).select("word", "ratio").toArrow()
    word, ratio = sent["word"].to_numpy().view(np.uint64), sent["ratio"].to_numpy()
    order = np.argsort(word)
    rest = None
    if sum(n for _, n in steps) > len(word):
        rest = (table if least is None else table.where(F.col("step") < least)).select("word", "ratio")
    other = float(np.log(free[1] / totals[1]) - np.log(free[0] / totals[0]))
    return Models(word[order], ratio[order], other, rest, np.zeros(3))


def calibrate(values: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Logistic regression of the label on the features, by Newton steps."""
    design = np.column_stack([values, np.ones(len(values))])
    weights = np.zeros(design.shape[1])
    if not toxic.any() or toxic.all():
        weights[0] = 1.0
        weights[-1] = -1.0
        return weights
    for _ in range(50):
        likely = 1 / (1 + np.exp(-np.clip(design @ weights, -500, 500)))
        slope = design.T @ (toxic - likely) - RIDGE * weights
        curve = (design * (likely * (1 - likely))[:, None]).T @ design + RIDGE * np.eye(design.shape[1])
        step = np.linalg.solve(curve, slope)
        weights = weights + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return weights


def _different_texts(docs: DataFrame, labels: DataFrame, allowed: Column) -> DataFrame:
    """``_label, text`` of the labelled documents whose doc_id is allowed; of equal texts with equal labels one.

    Which one it is, is found on hashes, before any text is moved; and a bitmap of the documents' hashes keeps most other
    texts from being shuffled.
    """
    known = (
        labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].cast("int").alias("_label"))
        .where(F.col("_label").isin(0, 1) & F.col("doc_id").isNotNull() & allowed)
        .groupBy("doc_id")
        .agg(F.max("_label").alias("_label"))
    )
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    hashed = texts.select("doc_id", F.xxhash64("text").alias("_hash"), F.length("text").alias("_length"))
    one = (
        hashed.join(known, "doc_id")
        .groupBy("_hash", "_length", "_label")
        .agg(F.min("doc_id").alias("doc_id"))
        .select("doc_id", "_label")
    )
    one = stored(one, "learned-from")
    bits = bitmap(one.select(slot_of(F.xxhash64("doc_id")).alias("slot")).distinct())
    likely = texts.where(has_slot(bits.scalar(), slot_of(F.xxhash64("doc_id"))))
    return likely.join(one.hint("shuffle_hash"), "doc_id").select("_label", "text")


def learn(docs: DataFrame, labels: DataFrame, allowed: Column) -> Models:
    """Count on all allowed labelled documents but those kept for the calibration; calibrate on these."""
    kept = F.pmod(F.xxhash64("doc_id"), F.lit(CALIBRATION_PARTS)) == 0
    models = fit_tables(stored(count_words(_different_texts(docs, labels, allowed & ~kept)), "words"))

    sample = labelled_sample(docs, labels, "toxic", allowed & kept, CALIBRATION_PER_CLASS)
    table = _features(models, sample.select(F.col("_label").cast("int").alias("key"), "text")).toArrow()
    values = np.column_stack([table["most"].to_numpy(), table["mean"].to_numpy()])
    toxic = table["key"].to_numpy() == 1
    order = np.lexsort((values[:, 1], values[:, 0], toxic))
    return replace(models, weights=calibrate(values[order], toxic[order]))


def score_documents(docs: DataFrame, labels: DataFrame, parts: int = 5, part: int = 0) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of documents.

    Labels are learned from rows that are not held out; nothing but the text is an input of a score.  A text without
    words has no likelihoods to compare and scores as one where both are equal.  Rows that repeat each get their score.
    """
    models = learn(docs, labels, ~held_out(F.col("doc_id"), parts, part))

    rows = docs.select(docs["doc_id"].cast("long").alias("key"), docs["text"].alias("text"))
    most, mean, last = (F.lit(float(w)) for w in models.weights)
    score = 1 / (1 + F.exp(-F.greatest(F.least(F.col("most") * most + F.col("mean") * mean + last, F.lit(500.0)), F.lit(-500.0))))
    return _features(models, rows).select(F.col("key").alias("doc_id"), score.alias("score")).select(
        "doc_id",
        held_out(F.col("doc_id"), parts, part).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
