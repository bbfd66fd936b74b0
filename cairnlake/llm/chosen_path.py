"""Near-duplicates by a chosen-path set similarity join on word shingles.

Documents are sets of shingles.  Independent trees branch them recursively: a node selects one or two coordinates of
the documents' minwise hashes (one always, a second with the probability that makes ``1 / threshold`` of them on
average), and a document goes to the child named by its value there.  Pairs at or above the threshold stay together
with a probability that hardly falls with depth, others part quickly; the number of trees follows from the recall
aimed at.  Small nodes are compared exhaustively on minwise sketches.  A node that stops shrinking holds documents
that are alike throughout, and goes on as a whole.

What nodes find are candidate edges, at most one less than the node has documents.  Their connected components are
clusters; in each cluster all pairs are decided on full shingle sets, so sketches never decide a link.  A cluster
larger than a block is cut into blocks, and each pair of blocks is compared in a task of its own.

Equal sets are collapsed to one representative before all this, so exact copies cost nothing here.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from cairnlake.llm.components import connected_components
from cairnlake.llm.scratch import discard, stored
from cairnlake.llm.stream_dedup import row_key
from cairnlake.llm.text_arrays import CHUNK_BYTES, Texts, hash_runs, hash_spans, lower_ascii, mix, read_texts
from cairnlake.llm.workers import map_batches, whole_groups

SHINGLE_WORDS = 5
THRESHOLD = Fraction(8, 10)
#: Minwise hashes of each document.
COORDINATES = 64
#: Chance that all trees miss a pair at the threshold, at TARGET_DEPTH levels.
MISS = 1e-6
TARGET_DEPTH = 3
#: Nodes of at most this many documents are compared exhaustively.
LEAF = 512
MAX_DEPTH = 6
#: A node with more than this share of its parent's documents has stopped shrinking.
STUCK = 0.5
#: Documents in a block of a large cluster.
BLOCK = 1536
#: Times that the texts of all clusters are dealt out to pairs of blocks at once, on average; more are dealt out in passes.
COPIES = 1.5
#: A sketch passes when it agrees in at least the expected number of places less this many standard deviations.
DEVIATIONS = 6

_factors = np.random.Generator(np.random.PCG64(77)).integers(0, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def path_survival(threshold: float, depth: int) -> float:
    """Chance that a pair at the threshold still shares a node of one tree after ``depth`` levels."""
    alive, second = 1.0, 1 / threshold - 1
    for _ in range(depth):
        alive = 1 - (1 - threshold * alive) * (1 - second * threshold * alive)
    return alive


def tree_count(threshold: float) -> int:
    return math.ceil(math.log(MISS) / math.log(1 - path_survival(threshold, TARGET_DEPTH)))


def least_agreement(threshold: float) -> int:
    """Places of two four-bit sketches that must agree for a pair to be a candidate."""
    agree = threshold + (1 - threshold) / 16
    return math.floor(COORDINATES * agree - DEVIATIONS * math.sqrt(COORDINATES * agree * (1 - agree)))


def shingle_sets(texts: Texts, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, ascending, one text after the other, and their numbers."""
    lowered = Texts(lower_ascii(texts.data), texts.offsets)
    starts, ends, bounds = lowered.words()
    words = hash_spans(lowered.data, starts, ends)
    runs = hash_runs(words, width)
    sets = []
    for low, high in zip(bounds[:-1], bounds[1:]):
        if high - low >= width:
            sets.append(np.unique(runs[low : high - width + 1]))
        elif high > low:
            # All words as one shingle, told apart from others by its length.
            sets.append(hash_runs(words[low:high], int(high - low), salt=100 + int(high - low)))
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    return np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64), np.array([len(s) for s in sets])


def minwise(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """COORDINATES minwise hashes of each set, as 32-bit numbers; sets are not empty."""
    first = np.cumsum(sizes) - sizes
    out = np.empty((len(sizes), COORDINATES), dtype=np.uint32)
    for i, factor in enumerate(_factors):
        out[:, i] = mix(np.minimum.reduceat(values * factor, first), i) >> np.uint64(32)
    return out


def packed_sketch(coordinates: np.ndarray) -> np.ndarray:
    """The last four bits of every coordinate, two in a byte: an eighth of what shuffling the coordinates would take."""
    low = (coordinates & np.uint32(15)).astype(np.uint8)
    return low[:, 0::2] | (low[:, 1::2] << np.uint8(4))


def unpacked_sketch(packed: np.ndarray) -> np.ndarray:
    """The four-bit values of packed sketches, in an order of their own."""
    return np.concatenate([packed & np.uint8(15), packed >> np.uint8(4)], axis=1)


def _described(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, n_shingles, h1, h2, coordinates, sketch`` of every row; h1 and h2 name the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in read_texts(batch.column("text")):
                values, sizes = shingle_sets(texts, width)
                full = sizes > 0
                h1, h2 = np.zeros(len(sizes), np.uint64), np.zeros(len(sizes), np.uint64)
                coordinates: list[bytes | None] = [None] * len(sizes)
                sketches: list[bytes | None] = [None] * len(sizes)
                if full.any():
                    at = (np.cumsum(sizes) - sizes)[full]
                    h1[full] = np.add.reduceat(values, at)
                    h2[full] = np.add.reduceat(mix(values, 3), at)
                    least = minwise(values, sizes[full])
                    for i, row, sketch in zip(np.flatnonzero(full), least, packed_sketch(least)):
                        coordinates[i], sketches[i] = row.tobytes(), sketch.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, len(texts)),
                        pa.array(sizes, pa.int64()),
                        pa.array(h1.view(np.int64)),
                        pa.array(h2.view(np.int64)),
                        pa.array(coordinates, pa.binary()),
                        pa.array(sketches, pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "h1", "h2", "coordinates", "sketch"],
                )

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    return map_batches(rows, run, "doc_id long, n_shingles long, h1 long, h2 long, coordinates binary, sketch binary")


def _branched(table: DataFrame, threshold: float, trees: int | None) -> DataFrame:
    """The children ``(node, doc, parent_size)`` of each row's node; at the root, of every tree."""
    second = 1 / threshold - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = b"".join(batch.column("coordinates").to_pylist())
            sketch = np.frombuffer(raw, dtype=np.uint32).reshape(batch.num_rows, COORDINATES)
            docs, size = batch.column("doc").to_numpy(), batch.column("size").to_numpy()
            if trees is None:
                parents = [batch.column("node").to_numpy().view(np.uint64)]
            else:
                parents = [np.full(len(docs), mix(np.uint64([tree + 1]), 11)[0]) for tree in range(trees)]
            for parent in parents:
                draw = mix(parent, 21)
                chosen = (draw % np.uint64(COORDINATES)).astype(np.int64)
                other = (chosen + 1 + ((draw >> np.uint64(8)) % np.uint64(COORDINATES - 1)).astype(np.int64)) % COORDINATES
                twice = np.flatnonzero((draw >> np.uint64(32)).astype(np.float64) < second * 2.0**32)
                for rows, at in ((np.arange(len(docs)), chosen), (twice, other[twice])):
                    value = sketch[rows, at].astype(np.uint64) | (at.astype(np.uint64) << np.uint64(32))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(mix(mix(value, 31) ^ parent[rows], 41).view(np.int64)),
                            pa.array(docs[rows]),
                            pa.array(size[rows]),
                        ],
                        names=["node", "doc", "parent_size"],
                    )

    return map_batches(table, run, "node long, doc long, parent_size long")


class Forest:
    """Disjoint sets of 0 .. n - 1."""

    def __init__(self, n: int):
        self.up, self.size = list(range(n)), [1] * n

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            if self.size[i] < self.size[j]:
                i, j = j, i
            self.up[j] = i
            self.size[i] += self.size[j]


def _spanning(ids: np.ndarray, forest: Forest) -> tuple[list[int], list[int]]:
    """Edges from the smallest id of each set to its others."""
    least: dict[int, int] = {}
    roots = [forest.root(i) for i in range(len(ids))]
    for i, root in enumerate(roots):
        least[root] = min(least.get(root, int(ids[i])), int(ids[i]))
    pairs = [(least[root], int(ids[i])) for i, root in enumerate(roots) if least[root] != int(ids[i])]
    return [a for a, _ in pairs], [b for _, b in pairs]


def _leaf_edges(members: DataFrame, threshold: float) -> DataFrame:
    """Candidate edges of small nodes: exhaustive comparison of sketches."""
    need = least_agreement(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_groups(batches, ["node"]):
            raw = b"".join(table.column("sketch").to_pylist())
            sketch = unpacked_sketch(np.frombuffer(raw, dtype=np.uint8).reshape(-1, COORDINATES // 2))
            ids = table.column("doc").to_numpy()
            sizes = np.diff(bounds)
            pair = bounds[:-1][sizes == 2]
            alike = pair[(sketch[pair] == sketch[pair + 1]).sum(axis=1) >= need]
            a, b = [ids[alike]], [ids[alike + 1]]
            for low, high in zip(bounds[:-1][sizes > 2], bounds[1:][sizes > 2]):
                forest, own = Forest(high - low), sketch[low:high]
                for i in range(high - low - 1):
                    for j in np.flatnonzero((own[i + 1 :] == own[i]).sum(axis=1) >= need):
                        forest.join(i, i + 1 + int(j))
                left, right = _spanning(ids[low:high], forest)
                a.append(np.array(left, dtype=np.int64))
                b.append(np.array(right, dtype=np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    return map_batches(members.repartition("node").sortWithinPartitions("node"), run, "a long, b long")


def candidate_edges(sets: DataFrame, threshold: float) -> list[DataFrame]:
    """Edges between documents of ``sets(doc, coordinates, sketch)`` that trees bring together."""
    found = []
    coordinates = sets.select("doc", "coordinates")
    frontier = coordinates.withColumn("node", F.lit(0).cast("long")).withColumn("size", F.lit(0).cast("long"))
    nodes, trees = None, tree_count(threshold)
    for depth in range(1, MAX_DEPTH + 1):
        children = stored(_branched(frontier, threshold, trees if depth == 1 else None), "path-children")
        if nodes is not None:
            discard(nodes)
        counts = stored(children.groupBy("node").agg(F.count(F.lit(1)).alias("size"), F.min("doc").alias("hub")).where("size > 1"), "path-counts")
        nodes = stored(children.join(counts, "node"), "path-nodes")
        discard(children, counts)
        stuck = (F.col("size") > LEAF) & (
            (F.lit(depth) == MAX_DEPTH) | ((F.lit(depth) > 1) & (F.col("size") > STUCK * F.col("parent_size")))
        )
        small = nodes.where(F.col("size") <= LEAF).select("node", "doc").join(sets.select("doc", "sketch"), "doc")
        found.append(stored(_leaf_edges(small, threshold), "path-edges"))
        alike = nodes.where(stuck & (F.col("doc") != F.col("hub"))).select(F.col("hub").alias("a"), F.col("doc").alias("b"))
        found.append(stored(alike, "path-edges"))
        large = nodes.where((F.col("size") > LEAF) & ~stuck).select("node", "doc", "size")
        if large.isEmpty():
            break
        frontier = large.join(coordinates, "doc")
    discard(nodes)
    return found


def exact_links(
    sets: list[np.ndarray], threshold: Fraction, left: np.ndarray | None = None
) -> Forest:
    """Link all pairs of sets at or above the threshold; with ``left``, only pairs of a marked and an unmarked set.

    Shared elements are counted for one set against all others at once, through the postings of its elements.
    The component of one set, the first that links, is fixed for the whole call: sets in it need no turn of their own, as
    an end outside it takes its turn and is compared with all, and of two ends inside it nothing is left to decide.
    """
    sizes = np.array([len(s) for s in sets])
    forest, n = Forest(len(sets)), len(sets)
    values, owner = np.concatenate(sets), np.repeat(np.arange(n), sizes)
    order = np.argsort(values, kind="stable")
    ranked, posting = values[order], owner[order]
    head = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    length = np.diff(np.r_[head, len(ranked)])
    group = np.empty(len(values), dtype=np.int64)
    group[order] = np.repeat(np.arange(len(head)), length)
    begin = np.cumsum(sizes) - sizes
    weight = np.add.reduceat(length[group], begin)
    fixed = None
    for i in np.argsort(-weight, kind="stable") if left is None else np.flatnonzero(left):
        if fixed is not None and forest.root(i) == forest.root(fixed):
            continue
        own = group[begin[i] : begin[i] + sizes[i]]
        own = own[length[own] > 1]
        if not len(own):
            continue
        lengths = length[own]
        at = np.repeat(head[own] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        shared = np.bincount(posting[at], minlength=n)
        alike = threshold.denominator * shared >= threshold.numerator * (sizes + sizes[i] - shared)
        if left is not None:
            alike &= ~left
        for j in np.flatnonzero(alike):
            forest.join(i, int(j))
        if left is None and fixed is None and forest.size[forest.root(i)] > 1:
            fixed = i
    return forest


def _cluster_edges(docs: DataFrame, clusters: DataFrame, width: int, threshold: Fraction) -> list[DataFrame]:
    """Edges that span the true components inside each cluster of ``clusters(doc, cluster, size)``, which should be stored.

    A text meets every block of its cluster, so what is dealt out grows with the square of a cluster.  Passes keep it from being on disk
    all at once: each takes some of the pairs of blocks.
    """

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_groups(batches, ["cluster", "low", "high"]):
            ids, block = table.column("doc").to_numpy(), table.column("block").to_numpy()
            low_block, high_block = table.column("low").to_numpy(), table.column("high").to_numpy()
            text_ends = np.cumsum(pc.fill_null(pc.binary_length(table.column("text")), 0).to_numpy())
            a: list[int] = []
            b: list[int] = []
            first = 0
            while first < len(bounds) - 1:
                # Groups of a few MB of text together, or one group.
                start, before = bounds[first], text_ends[bounds[first] - 1] if bounds[first] else 0
                after = int(np.searchsorted(text_ends[bounds[1:] - 1], before + CHUNK_BYTES, side="right"))
                after = max(after, first + 1)
                sets: list[np.ndarray] = []
                for _, texts in read_texts(table.column("text").slice(start, bounds[after] - start)):
                    values, sizes = shingle_sets(texts, width)
                    sets += np.split(values, np.cumsum(sizes)[:-1])
                for low, high in zip(bounds[first:after], bounds[first + 1 : after + 1]):
                    if high - low < 2:
                        continue
                    left = None if low_block[low] == high_block[low] else block[low:high] == low_block[low]
                    more_a, more_b = _spanning(ids[low:high], exact_links(sets[low - start : high - start], threshold, left))
                    a += more_a
                    b += more_b
                first = after
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    content = docs.select(docs["doc_id"].cast("long").alias("_id"), docs["text"].alias("text"))
    # The small side is built into hash tables, so that texts are not sorted.
    wanted = content.join(clusters.hint("shuffle_hash"), F.col("_id") == F.col("doc")).select("doc", "cluster", "size", "text")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    copies = clusters.agg(F.avg(blocks)).first()[0] or 0
    passes = max(1, math.ceil(copies / COPIES))
    if passes > 1:
        wanted = stored(wanted, "cluster-texts")
    # Texts are shuffled, which take half of the disk that their sets would.
    dealt = (
        wanted.withColumn("block", F.pmod(F.xxhash64("doc"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select("cluster", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "doc", "text")
    )
    turn = F.pmod(F.pmod(F.xxhash64("cluster"), F.lit(passes)) + F.col("low") + F.col("high"), F.lit(passes))
    found = []
    for number in range(passes):
        paired = dealt.where(turn == number).repartition("cluster", "low", "high").sortWithinPartitions("cluster", "low", "high", "doc")
        found.append(stored(map_batches(paired, link, "a long, b long"), "cluster-edges"))
    if passes > 1:
        discard(wanted)
    return found


def link_documents(docs: DataFrame, threshold: Fraction = THRESHOLD, width: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of documents.

    Words are runs of other than blanks, with A to Z lowered.  A text with fewer words than a shingle is one shingle;
    a null text or one without words has none and is linked with nothing.  Two documents are linked when
    ``|A & B| >= threshold * |A | B|``; ``component_id`` is the smallest doc_id that links reach.  Rows that share a
    doc_id count as one document; rows without a doc_id are linked with nothing and kept.  Extra columns are not read.
    """
    described = stored(_described(docs, width), "shingle-sets")
    full = described.where("n_shingles > 0 and doc_id is not null")
    classes = stored(full.groupBy("h1", "h2", "n_shingles").agg(F.min("doc_id").alias("doc")), "set-classes")
    sets = stored(
        full.withColumnRenamed("doc_id", "doc").join(classes, ["h1", "h2", "n_shingles", "doc"]).select("doc", "coordinates", "sketch"),
        "set-sketches",
    )
    # What is left to read of the description, without the sketches.
    whole, described = described, stored(described.select("doc_id", "n_shingles", "h1", "h2"), "shingle-sets")
    discard(whole)
    found = candidate_edges(sets, float(threshold))
    discard(sets)
    clusters = connected_components(reduce(DataFrame.unionByName, found))
    discard(*found)
    sizes = clusters.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    members = stored(
        clusters.join(sizes, "component").select(F.col("id").alias("doc"), F.col("component").alias("cluster"), "size"), "cluster-members"
    )
    discard(clusters)
    found = _cluster_edges(docs, members, width, threshold)
    linked = connected_components(reduce(DataFrame.unionByName, found))
    named = stored(
        classes.join(linked.withColumnRenamed("id", "doc"), "doc", "left").select(
            "h1", "h2", "n_shingles", F.coalesce("component", "doc").alias("_component")
        ),
        "set-components",
    )
    discard(*found, members, classes, linked)
    # Rows that share a doc_id may have different sets; their components are one through the id itself.
    return described.join(named, ["h1", "h2", "n_shingles"], "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("_component", "doc_id")).alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("_component", "doc_id"), F.lit(True)).alias("kept"),
    )


def keep_one_of_each(docs: DataFrame, threshold: Fraction = THRESHOLD, width: int = SHINGLE_WORDS) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its near-duplicates, with all their columns."""
    kept = link_documents(docs, threshold, width).where("kept").select(row_key(F.col("doc_id")).alias("_id")).distinct()
    # Own names by place, as any name can be a column of docs.
    names = [f"_keep{i}" for i in range(len(docs.columns))]
    named = docs.toDF(*names).withColumn("_id", row_key(F.col(names[docs.columns.index("doc_id")])))
    return named.join(kept.hint("shuffle_hash"), "_id", "left_semi").select(*names).toDF(*docs.columns)
