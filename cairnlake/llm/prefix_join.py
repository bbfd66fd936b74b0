"""Benchmark decontamination by a prefix-filtered set join.

A window is so many consecutive words of a benchmark item, or all words of a shorter one.  It is a set of shingles of a few words
at their offsets.  A document that contains the window contains all of its shingles, so one of them is enough of a prefix:
the one that is rarest in the documents.  Documents are read once; of their shingles those that are in a bitmap of the
benchmark's are kept with the words around them, counted, and joined with the windows whose rarest shingle they are.
A candidate has to lie within the document (its start and its length) and is then compared word by word.

Shingles of the documents that the benchmark does not have never leave their task; false hits of the bitmap, a fixed size
at any scale, only cost work.  Windows that very many items share are one window; the items of a set of windows are looked up
once for all documents with that set.  Everything is DataFrame expressions.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from cairnlake.llm.bitmaps import bitmap, has_slot, slot_of
from cairnlake.llm.scratch import stored

#: Words of a window, and of a shingle (of a shorter window: all its words).
WINDOW = 10
SHINGLE = 4
#: Bits of the bitmap of the benchmark's shingles: 512 KB.
SHINGLE_BITS = 22
_FOUND = "array<struct<low:int,token:bigint,around:array<string>>>"
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Runs of digits, letters a to z and characters beyond ASCII, after lower-casing A to Z; null has none."""
    lowered = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lowered, _SEPARATORS), "")


def _shingle(words: Column, at: Column, length: int) -> Column:
    return F.xxhash64(F.lit(length), *(F.get(words, at + i) for i in range(length)))


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``item, win, seq``: the distinct windows of each item, as their words joined by blanks and a digest of that.

    Rows that share an item_id are one item; a row without one has windows, but is not listed.
    """
    split = items.select(items["item_id"].cast("string").alias("item"), words_of(items["text"]).alias("words"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)))
    cut = split.where(F.size("words") > 0).select("item", "words", F.explode(starts).alias("start"))
    seq = F.array_join(F.slice("words", F.col("start") + 1, window), " ")
    return cut.select("item", seq.alias("seq")).distinct().select("item", F.md5("seq").alias("win"), "seq")


def window_shingles(windows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``win, seq, length, offset, token``: the shingles of every window of ``windows(win, seq)``."""
    split = windows.withColumn("words", F.split("seq", " ")).withColumn("length", F.least(F.size("words"), F.lit(shingle)))
    offsets = F.sequence(F.lit(0), F.size("words") - F.col("length"))
    placed = split.select("win", "seq", "words", "length", F.explode(offsets).alias("offset"))
    token = reduce(
        lambda other, n: F.when(F.col("length") == n, _shingle(F.col("words"), F.col("offset"), n)).otherwise(other),
        range(1, shingle),
        _shingle(F.col("words"), F.col("offset"), shingle),
    )
    return placed.select("win", "seq", "length", "offset", token.alias("token"))


def shingles_in_documents(docs: DataFrame, bits: Column, lengths: list[int], window: int = WINDOW) -> DataFrame:
    """``doc_id, _key, _more, n_words, at, found``: places of documents where a shingle stands that the bitmap has.

    ``found`` has the shingles that start there, with the words around them as far as a window can reach.  Every document
    has one row more, at its end, in which ``found`` is null.  ``_key`` and ``_more`` name a document by its doc_id and text; rows equal
    in both have the same result.  Words are tested one by one in generated code, and only places found become rows.  These have the
    words that a window can reach, never all words of the document, as the places of one document are held in memory together.
    """
    split = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.xxhash64(docs["doc_id"].cast("long"), docs["text"]).alias("_key"),
        F.hash(docs["text"], docs["doc_id"].cast("long")).alias("_more"),
        words_of(docs["text"]).alias("words"),
    )
    places = split.select("*", F.posexplode(F.concat("words", F.array(F.lit(None).cast("string")))).alias("at", "_word"))
    words, at, count, longest = F.col("words"), F.col("at"), F.size("words"), max(lengths, default=0)

    def known(of: Column, place: Column, n: int) -> Column:
        return (place + n <= F.size(of)) & has_slot(bits, slot_of(_shingle(of, place, n), bits=SHINGLE_BITS))

    kept = reduce(lambda a, b: a | b, (known(words, at, n) for n in lengths), at == count)
    low = F.greatest(at - (window - longest), F.lit(0))
    near = places.where(kept).select(
        "doc_id", "_key", "_more", count.cast("long").alias("n_words"), "at", (at - low).alias("_before"),
        F.slice("words", low + 1, at + window - low).alias("_near"),
    )
    words, before = F.col("_near"), F.col("_before")

    def entry(n: int) -> Column:
        first, around = (at - before, words) if n == longest else (at, F.slice(words, before + 1, window))
        return F.when(
            known(words, before, n), F.struct(first.alias("low"), _shingle(words, before, n).alias("token"), around.alias("around"))
        )

    found = F.array_compact(F.array(*(entry(n) for n in lengths))) if lengths else F.lit(None)
    return near.select("doc_id", "_key", "_more", "n_words", "at", F.when(at < F.col("n_words"), found.cast(_FOUND)).alias("found"))


def occurrences(found: DataFrame, tokens: DataFrame) -> DataFrame:
    """``_key, _more, win, start, end``: every place of a document where a window of ``tokens`` occurs.

    ``found`` comes from :func:`shingles_in_documents`, ``tokens`` from :func:`window_shingles`; both should be stored.
    """
    placed = found.where(F.col("found").isNotNull()).select("_key", "_more", "n_words", "at", F.inline("found"))
    counts = placed.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    # A window with a shingle that no document has is dropped: its rarest shingle has no count.
    ranked = tokens.join(counts, "token", "left").groupBy("win", "seq").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "offset")).alias("rarest")
    )
    prefixes = stored(
        ranked.where("rarest.n > 0").select(
            "win", "seq", F.size(F.split("seq", " ")).alias("size"), F.col("rarest.token").alias("token"), F.col("rarest.offset").alias("offset")
        ),
        "window-prefixes",
    )
    start = F.col("at") - F.col("offset")
    within = (start >= 0) & (start + F.col("size") <= F.col("n_words"))
    same = F.array_join(F.slice("around", start - F.col("low") + 1, F.col("size")), " ") == F.col("seq")
    return (
        placed.join(prefixes, "token")
        .where(within)
        .where(same)
        .select("_key", "_more", "win", start.alias("start"), (start + F.col("size")).alias("end"))
    )


def covered(found: DataFrame) -> DataFrame:
    """``_key, _more, n_hit, wins``: words that occurrences cover, each counted once, and the distinct windows."""
    before = Window.partitionBy("_key", "_more").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("end").over(before), F.lit(0))
    new = F.greatest(F.col("end") - F.greatest(F.col("start"), reached), F.lit(0))
    return (
        found.withColumn("new", new)
        .groupBy("_key", "_more")
        .agg(F.sum("new").cast("long").alias("n_hit"), F.sort_array(F.collect_set("win")).alias("wins"))
    )


def find_contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of every row of documents.

    Words are compared after lower-casing A to Z.  A null or empty text has no words; an item without words has no
    window.  Rows of documents that repeat each get their result; rows of items that repeat are one.  ``n_items`` and the digest leave out
    items without an id, whose windows count for ``n_hit``.  Extra columns are not read.
    """
    windows = stored(item_windows(items, window), "item-windows")
    tokens = stored(window_shingles(windows.select("win", "seq").distinct(), shingle), "window-shingles")
    lengths = sorted(row["length"] for row in tokens.select("length").distinct().collect())  # at most ``shingle`` of them
    bits = bitmap(tokens.select(slot_of(F.col("token"), bits=SHINGLE_BITS).alias("slot")).distinct(), SHINGLE_BITS)
    found = stored(shingles_in_documents(docs, bits.scalar(), lengths, window), "document-shingles")

    hit = stored(covered(occurrences(found, tokens)).withColumn("set", F.md5(F.array_join("wins", ""))), "hit-documents")
    sets = hit.groupBy("set").agg(F.first("wins").alias("wins"))
    listed = (
        sets.select("set", F.explode("wins").alias("win"))
        .join(windows.where(F.col("item").isNotNull()).select("win", "item"), "win")
        .groupBy("set")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    named = stored(
        listed.select("set", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256")),
        "item-sets",
    )
    results = stored(hit.join(named, "set", "left").select("_key", "_more", "n_hit", "n_items", "items_sha256"), "hits-and-items")
    hits = F.coalesce("n_hit", F.lit(0).cast("long"))
    return (
        found.where(F.col("found").isNull())
        .select("doc_id", "_key", "_more", "n_words")
        .join(results, ["_key", "_more"], "left")
        .select(
            "doc_id",
            "n_words",
            hits.alias("n_hit"),
            F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
            F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
            (hits > 0).alias("contaminated"),
        )
    )
