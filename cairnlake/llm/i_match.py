"""I-Match fingerprints: hashes of a document's mid-frequency terms under several randomised lexicons.

Terms are lower-cased runs of letters and digits.  Their document frequencies are counted over all documents in a fixed
number of hash slots, so the table of frequencies has a bounded size at any scale; rare terms that share a slot with
a term of the band hardly move its frequency, as the band's limits are shares of all documents, but count as terms of the
band themselves.  The lexicon is the set of slots whose inverse document frequency lies in the band.

Every randomised lexicon is a fixed random subset of that: a term is in it or not, whatever the document.  Of a document, all
terms that a randomised lexicon has are sorted and hashed together.  Lexicons keep a quarter, an eighth and so on of all terms, several
of each: the large ones tell documents of few terms apart, the small ones still agree when many of a long document's terms
are exchanged.  The likeness of two fingerprints is the share of lexicons under which they agree, of those that have a term of
either.  A hash of all terms is part of a fingerprint as well.

Everything is DataFrame expressions; texts are shuffled once, to bring each document next to its neighbour.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cairnlake.llm.bitmaps import bitmap, has_slot, slot_of
from cairnlake.llm.row_numbers import ranges_of
from cairnlake.llm.scratch import stored

#: Shares of documents between which a term's document frequency must lie: the band of inverse document frequency.
BAND = (0.0005, 0.02)
#: Texts that are brought together to find neighbours.
TEXTS_PER_RANGE = 4_000
#: Randomised lexicons: so many of each size.  Size n keeps one of 2^n terms.
DRAWS, SIZES = 4, range(2, 10)
LEXICONS = DRAWS * len(SIZES)


def terms(text: Column) -> Column:
    """Hashes of the distinct terms of a text."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.array_distinct(F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """One row with ``bits``, the bitmap of the slots whose share of documents lies in the band."""
    total = docs.agg(F.count(F.lit(1)).alias("total"))
    slot = F.transform(terms(docs["text"]), lambda h: slot_of(h))
    counts = docs.select(F.explode(F.array_distinct(slot)).alias("slot")).groupBy("slot").agg(F.count(F.lit(1)).alias("n"))
    share = F.col("n") / total.scalar()
    return bitmap(counts.where((share >= band[0]) & (share <= band[1])).select("slot"))


def with_fingerprint(table: DataFrame, text: Column, bits: Column, name: str) -> DataFrame:
    """Add ``name``: ``whole`` (hash of all distinct terms) and ``parts`` (a hash for each lexicon; 0: no terms).

    Equal texts have equal fingerprints.  A text without a term of the lexicon is named by all its terms; one without
    terms has no parts but zeros.
    """

    def kept(lexicon_: Column) -> Column:
        return F.filter(
            F.col("_own"), lambda h: F.xxhash64(h, lexicon_["draw"]).bitwiseAND(lexicon_["mask"]) == F.lit(0)
        )

    def hashed(terms_: Column) -> Column:
        part = F.xxhash64(terms_).bitwiseAND(F.lit(0xFFFFFFFF)).bitwiseOR(F.lit(1))
        return F.when(F.size(terms_) > 0, part).otherwise(F.lit(0).cast("long"))

    lexicons = F.array(
        *(
            F.struct(F.lit(draw).alias("draw"), F.lit((1 << size) - 1).cast("long").alias("mask"))
            for size in SIZES
            for draw in range(DRAWS)
        )
    )
    parts = F.transform(F.transform(lexicons, kept), hashed)
    # The second mention of _own keeps the optimiser from computing it anew for every lexicon.
    parts = F.when(F.size("_own") > 0, parts).otherwise(F.lit([0] * LEXICONS).cast("array<bigint>"))
    return (
        table.withColumn("_terms", F.sort_array(terms(text)))
        .withColumn("_bits", bits)
        .withColumn("_listed", F.filter("_terms", lambda h: has_slot(F.col("_bits"), slot_of(h))))
        .withColumn("_own", F.when(F.size("_listed") > 0, F.col("_listed")).otherwise(F.col("_terms")))
        .withColumn(name, F.struct(F.xxhash64("_terms").alias("whole"), parts.alias("parts")))
        .drop("_terms", "_listed", "_own", "_bits")
    )


def as_text(fingerprint: str) -> Column:
    parts = F.transform(F.col(f"{fingerprint}.parts"), lambda p: F.lpad(F.lower(F.hex(p)), 8, "0"))
    return F.concat(F.lpad(F.lower(F.hex(F.col(f"{fingerprint}.whole"))), 16, "0"), F.array_join(parts, ""))


def likeness(a: str, b: str) -> Column:
    """The share of lexicons with a term of either under which two fingerprints agree; 1 for equal ones, 0 without lexicons."""
    pairs = F.zip_with(F.col(f"{a}.parts"), F.col(f"{b}.parts"), lambda x, y: F.when((x != 0) | (y != 0), x == y))
    used = F.size(F.filter(pairs, lambda same: same.isNotNull()))
    agree = F.size(F.filter(pairs, lambda same: same))
    return F.when(F.col(a) == F.col(b), F.lit(1.0)).otherwise(F.coalesce(F.try_divide(agree, used), F.lit(0.0)))


def fingerprint_documents(docs: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` of every row.

    The edited text has its last quarter (``floor(n_chars / 4)`` code points) replaced by as many from the start of
    the next document in ascending doc_id, or by all of that if it is shorter; after the last comes the first.  A null text is
    empty.  Rows that share a doc_id follow each other by a hash of their text; rows without one come among the negative
    ids.  A single document is its own neighbour.  Extra columns are not read.
    """
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(docs["text"], F.lit("")).alias("text"),
        F.xxhash64(docs["text"]).alias("_tie"),
        F.coalesce(
            docs["doc_id"].cast("long"), F.lit(-(1 << 62)) + F.shiftrightunsigned(F.xxhash64(docs["text"]), 2)
        ).alias("_key"),
    )
    bits = lexicon(docs, band).scalar()
    ranged = rows.withColumn("_range", ranges_of(rows, "_key", TEXTS_PER_RANGE).number("_key"))

    # The first document of each range follows the last one of the range before.
    firsts = stored(ranged.groupBy("_range").agg(F.min(F.struct("_key", "_tie")).alias("_first")), "range-firsts")
    order = Window.orderBy("_range")
    followed = firsts.select(
        F.coalesce(F.lag("_range").over(order), F.max("_range").over(Window.partitionBy(F.lit(1)))).alias("_before"), "_first"
    )
    heads = stored(
        with_fingerprint(
            ranged.join(
                followed,
                (F.col("_key") == F.col("_first._key")) & (F.col("_tie") == F.col("_first._tie")),
            ),
            F.col("text"),
            bits,
            "_print",
        )
        .groupBy(F.col("_before").alias("_range"))
        .agg(F.max(F.struct("text", "_print")).alias("_head")),
        "range-heads",
    )
    inside = Window.partitionBy("_range").orderBy("_key", "_tie")
    printed = with_fingerprint(ranged, F.col("text"), bits, "_print")
    neighbour = printed.withColumn("_next", F.lead(F.struct("text", "_print")).over(inside)).join(heads, "_range", "left")
    edited = neighbour.withColumn("_next", F.coalesce("_next", "_head")).withColumn("n_chars", F.char_length("text"))
    part = F.floor(F.col("n_chars") / 4).cast("int")
    changed = edited.withColumn(
        "_edited",
        F.concat(F.substring("text", F.lit(1), F.col("n_chars") - part), F.substring(F.col("_next.text"), F.lit(1), part)),
    ).select("doc_id", "n_chars", "_edited", "_print", F.col("_next._print").alias("_next"))
    both = with_fingerprint(changed, F.col("_edited"), bits, "_edited_print")
    return both.select(
        "doc_id",
        F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2("_edited", 256).alias("edited_sha256"),
        as_text("_print").alias("fingerprint"),
        as_text("_edited_print").alias("edited_fingerprint"),
        likeness("_print", "_edited_print").alias("near_edited"),
        likeness("_print", "_next").alias("near_next"),
    )
