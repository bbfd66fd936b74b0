"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A batch of texts is cut into units (a run of spaces and what follows it up to the next space; no piece of the
vocabulary may hold a space after another character, so no merge crosses units).  Equal units are encoded once.
Their symbols lie in flat arrays.  Each round finds the smallest pair rank of every unit, merges all its leftmost
disjoint occurrences that one-by-one merging would merge in a row, and compacts the arrays; units without a pair
that can merge are done.

The result is what the sentencepiece library gives for models of this kind: BPE with byte fallback, identity
normalisation, a space put in front, spaces escaped.  Other models are refused.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cairnlake.llm.text_arrays import Texts, ragged, read_texts
from cairnlake.llm.workers import map_batches

SPACE = 0x20
ESCAPED_SPACE = "▁"
NO_PAIR = np.int64(1) << 40
#: Bytes of text that are encoded at once: symbols, units and ranks take some seventy times as much.
PIECE_BYTES = 1 << 20
REPLACEMENT = "�".encode()


class Vocabulary:
    """Lookup tables of one model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        pieces = [model.id_to_piece(i) for i in range(size)]
        scores = [model.get_score(i) for i in range(size)]
        self.size = size
        self.byte_id = np.full(256, -1, dtype=np.int64)
        surface: list[bytes] = []
        ids: dict[str, int] = {}
        for i, piece in enumerate(pieces):
            if model.is_byte(i):
                value = int(piece[1:-1], 16)
                self.byte_id[value] = i
                surface.append(bytes([value]))
            elif model.is_control(i) or model.is_unused(i):
                surface.append(b"")
            elif model.is_unknown(i):
                surface.append(" ⁇ ".encode())
            else:
                ids[piece] = i
                surface.append(piece.replace(ESCAPED_SPACE, " ").encode())
        if (self.byte_id < 0).any():
            raise ValueError("the model has no byte fallback")
        if model.encode("a Å  b ", out_type=str)[0][:1] != ESCAPED_SPACE or model.decode(
            model.encode("a Å  b ")
        ) != "a Å  b ":
            raise ValueError("the model normalises texts")
        inner = ids.keys() - {ESCAPED_SPACE}
        if any(ESCAPED_SPACE in p.lstrip(ESCAPED_SPACE) for p in inner):
            raise ValueError("the model has pieces that span words")
        self.is_byte = np.zeros(size, dtype=bool)
        self.is_byte[self.byte_id] = True
        self.space_id = ids[ESCAPED_SPACE]
        # A character outside the vocabulary becomes the symbol size + code point, which never merges.
        self.char_id = np.arange(0x110000, dtype=np.int64) + size
        for piece, i in ids.items():
            if len(piece) == 1:
                self.char_id[ord(piece)] = i
        self.char_id[SPACE] = self.space_id
        # A pair's rank is the place of its piece's score, best first; equal scores share a rank.
        rank = {score: place for place, score in enumerate(sorted({scores[i] for i in ids.values()}, reverse=True))}
        keys, ranks, merged = [], [], []
        for piece, i in ids.items():
            if not piece.strip(ESCAPED_SPACE):
                continue  # runs of spaces: see space_run
            for cut in range(1, len(piece)):
                left, right = ids.get(piece[:cut]), ids.get(piece[cut:])
                if left is not None and right is not None:
                    keys.append(left * size + right)
                    ranks.append(rank[scores[i]])
                    merged.append(i)
        self._index(np.array(keys, dtype=np.uint64), np.array(ranks), np.array(merged))
        runs = {len(p): i for p, i in ids.items() if not p.strip(ESCAPED_SPACE)}
        if len({scores[i] for n, i in runs.items() if n > 1}) > 1 or any(
            rank[scores[i]] != len(rank) - 1 for n, i in runs.items() if n > 1
        ):
            raise ValueError("runs of spaces are not ranked last")
        self.run_ids = runs
        self.surface = pa.array(surface, pa.large_binary())
        self.decimal = pa.array([f"{i},".encode() for i in range(size)], pa.large_binary())

    def _index(self, keys: np.ndarray, ranks: np.ndarray, merged: np.ndarray) -> None:
        """An open-addressing table from pairs to rank and merged symbol."""
        bits = int(np.ceil(np.log2(len(keys) * 4)))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, np.uint64(2**64 - 1))
        self.ranks = np.full(1 << bits, NO_PAIR)
        self.merged = np.zeros(1 << bits, dtype=np.int64)
        slots = ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)
        self.probes = 1
        for key, rank, symbol, slot in zip(keys, ranks, merged, slots):
            steps = 1
            while self.keys[slot] != np.uint64(2**64 - 1):
                slot, steps = (slot + 1) & self.mask, steps + 1
            self.keys[slot], self.ranks[slot], self.merged[slot] = key, rank, symbol
            self.probes = max(self.probes, steps)

    def pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NO_PAIR: cannot merge) and merged symbol of each pair of symbols."""
        size = np.int64(self.size)
        rank, symbol = np.full(len(left), NO_PAIR), np.zeros(len(left), dtype=np.int64)
        open_ = np.flatnonzero((left < size) & (right < size))
        key = (left[open_] * size + right[open_]).astype(np.uint64)
        slot = ((key * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)
        for _ in range(self.probes):
            found = self.keys[slot]
            hit = found == key
            rank[open_[hit]], symbol[open_[hit]] = self.ranks[slot[hit]], self.merged[slot[hit]]
            go = ~hit & (found != np.uint64(2**64 - 1))
            open_, key, slot = open_[go], key[go], (slot[go] + 1) & self.mask
            if not len(open_):
                break
        return rank, symbol

    def space_run(self, length: int) -> list[int]:
        """The ids of a run of spaces that merged with nothing else.

        All pairs of such a run have one rank, so the leftmost merges first; when the first symbol cannot grow
        any further it stays, and the rest goes on by itself.
        """
        longest, out = max(self.run_ids), []
        while length >= 2 * longest:
            out.append(self.run_ids[longest])
            length -= longest
        symbols = [1] * length
        while True:
            for i in range(len(symbols) - 1):
                if symbols[i] + symbols[i + 1] in self.run_ids:
                    symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
                    break
            else:
                return out + [self.run_ids[n] for n in symbols]


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def merge_rounds(symbols: np.ndarray, lengths: np.ndarray, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """BPE of units given as flat symbols and their numbers of symbols (each 1 or more)."""
    done_symbols, done_units = [], []
    unit = np.repeat(np.arange(len(lengths)), lengths)

    def ranked(sym: np.ndarray, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rank, result = np.full(len(sym), NO_PAIR), np.zeros(len(sym), dtype=np.int64)
        inside = np.flatnonzero(units[:-1] == units[1:])
        rank[inside], result[inside] = vocab.pair(sym[inside], sym[inside + 1])
        return rank, result

    rank, result = ranked(symbols, unit)
    while len(symbols):
        first = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
        count = np.diff(np.r_[first, len(unit)])
        least = np.minimum.reduceat(rank, first)
        active = np.repeat(least < NO_PAIR, count)
        if not active.all():
            done_symbols.append(symbols[~active])
            done_units.append(unit[~active])
            symbols, unit, rank, result = symbols[active], unit[active], rank[active], result[active]
            if not len(symbols):
                break
            keep = least < NO_PAIR
            count, least = count[keep], least[keep]
            first = np.cumsum(count) - count
        at = np.flatnonzero(rank == np.repeat(least, count))
        # Of pairs that overlap in a chain (a a a), every second one from the left is merged.
        chain = np.flatnonzero(np.r_[True, (at[1:] != at[:-1] + 1) | (unit[at[1:]] != unit[at[:-1]])])
        place = np.arange(len(at)) - np.repeat(chain, np.diff(np.r_[chain, len(at)]))
        at = at[place % 2 == 0]
        # Merging one may open a pair that goes before the next occurrence: stop after the first such one.
        low = np.repeat(least, count)[at]
        new, owner = result[at], unit[at]
        left = np.where((at > 0) & (unit[at - 1] == owner), symbols[at - 1], vocab.size)
        near = np.r_[False, (at[1:] == at[:-1] + 2) & (owner[1:] == owner[:-1])]
        left[near] = new[np.flatnonzero(near) - 1]
        after = np.minimum(at + 2, len(unit) - 1)
        right = np.where((at + 2 < len(unit)) & (unit[after] == owner), symbols[after], vocab.size)
        opens = (vocab.pair(left, new)[0] <= low) | (vocab.pair(new, right)[0] <= low)
        if opens.any():
            head = np.r_[True, owner[1:] != owner[:-1]]
            before = np.cumsum(opens) - opens  # occurrences before this one that open such a pair
            at_head = np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))
            fine = before == before[at_head]
            at, new = at[fine], new[fine]
        symbols = symbols.copy()
        symbols[at] = new
        stay = np.ones(len(symbols), dtype=bool)
        stay[at + 1] = False
        touched = np.zeros(len(symbols), dtype=bool)
        touched[at] = True
        symbols, unit, rank, result, touched = symbols[stay], unit[stay], rank[stay], result[stay], touched[stay]
        again = np.flatnonzero(touched | np.r_[touched[1:], False])
        last = again == len(symbols) - 1
        nxt = np.where(last, again, again + 1)
        joined = ~last & (unit[nxt] == unit[again])
        rank[again] = NO_PAIR
        rank[again[joined]], result[again[joined]] = vocab.pair(symbols[again[joined]], symbols[nxt[joined]])
    if not done_symbols:
        return symbols, lengths
    symbols, unit = np.concatenate(done_symbols), np.concatenate(done_units)
    order = np.argsort(unit, kind="stable")
    return symbols[order], np.bincount(unit, minlength=len(lengths))


def _lay_out(symbols: np.ndarray, lengths: np.ndarray, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Symbols to ids: leading spaces to run pieces, characters outside the vocabulary to byte pieces."""
    segment, place = ragged(lengths)
    first = np.cumsum(lengths) - lengths
    # Leading plain spaces of each unit (only runs of two or more have anything left to merge).
    space = symbols == vocab.space_id
    ahead = np.cumsum(~space)
    base = ahead[first] - ~space[first]
    leading = space & (ahead == base[segment])
    run = np.bincount(segment[leading], minlength=len(lengths))
    pieces: dict[int, list[int]] = {int(n): vocab.space_run(int(n)) for n in np.unique(run) if n > 1}
    for unit in np.flatnonzero(run > 1):
        ids = pieces[int(run[unit])]
        begin = first[unit]
        symbols[begin : begin + len(ids)] = ids
        symbols[begin + len(ids) : begin + run[unit]] = -1
    keep = symbols >= 0
    symbols, segment = symbols[keep], segment[keep]
    outside = np.flatnonzero(symbols >= vocab.size)
    if len(outside):
        width = np.ones(len(symbols), dtype=np.int64)
        code = symbols[outside] - vocab.size
        width[outside] = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)
        text = "".join(map(chr, code)).encode()
        owner, _ = ragged(width)
        spread = symbols[owner]
        spread[spread >= vocab.size] = vocab.byte_id[np.frombuffer(text, dtype=np.uint8)]
        symbols, segment = spread, segment[owner]
    return symbols, np.bincount(segment, minlength=len(lengths))


def _list_array(values: np.ndarray, lengths: np.ndarray) -> pa.LargeListArray:
    return pa.LargeListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lengths)], pa.int64()), pa.array(values))


def encode_texts(texts: Texts, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts one after the other, and the number of ids of each text."""
    sizes = np.diff(texts.offsets)
    data, filled = texts.data, sizes > 0
    if not filled.any():
        return np.zeros(0, dtype=np.int64), np.zeros(len(texts), dtype=np.int64)
    escaped = ESCAPED_SPACE.encode()
    starts = texts.offsets[:-1][filled]
    # One space goes in front of each text that has any character.
    data = np.insert(data, starts, SPACE)
    sizes = sizes + filled
    if escaped in data.tobytes():
        flat = data.tobytes()
        bounds = np.r_[0, np.cumsum(sizes)]
        parts = [flat[a:b].replace(escaped, b" ") for a, b in zip(bounds[:-1], bounds[1:])]
        data, sizes = np.frombuffer(b"".join(parts), dtype=np.uint8), np.array([len(p) for p in parts])
    begin = np.cumsum(sizes) - sizes
    space = data == SPACE
    head = space & ~np.r_[False, space[:-1]]
    head[begin[sizes > 0]] = True
    unit_at = np.flatnonzero(head)
    units = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(unit_at), [None, pa.py_buffer(np.r_[unit_at, len(data)].astype(np.int64)), pa.py_buffer(data)]
    ).dictionary_encode()
    distinct = units.dictionary
    offsets = np.frombuffer(distinct.buffers()[1], dtype=np.int64)[distinct.offset : distinct.offset + len(distinct) + 1]
    raw = np.frombuffer(distinct.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    codes = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
    chars = np.add.reduceat(((raw & 0xC0) != 0x80).astype(np.int64), offsets[:-1])
    symbols, lengths = merge_rounds(vocab.char_id[codes], chars, vocab)
    ids, lengths = _lay_out(symbols, lengths, vocab)
    index = units.indices.to_numpy()
    listed = _list_array(ids, lengths).take(pa.array(index))
    per_text = np.bincount(np.searchsorted(begin[sizes > 0], unit_at, side="right") - 1, weights=lengths[index])
    counts = np.zeros(len(texts), dtype=np.int64)
    counts[sizes > 0] = per_text.astype(np.int64)
    return listed.flatten().to_numpy(), counts


def decode_ids(ids: np.ndarray, counts: np.ndarray, vocab: Vocabulary) -> list[bytes]:
    """The UTF-8 text of each list of ids: surfaces joined, without the space that encoding puts in front.

    Byte pieces that form no character each become one U+FFFD, as in the library.
    """
    surfaces = vocab.surface.take(pa.array(ids))
    offsets = np.frombuffer(surfaces.buffers()[1], dtype=np.int64)[surfaces.offset : surfaces.offset + len(ids) + 1]
    data = surfaces.buffers()[2]
    view = memoryview(data) if data is not None else memoryview(b"")
    ends = np.cumsum(counts)
    out = []
    for low, high in zip(ends - counts, ends):
        text = view[offsets[low] : offsets[high]].tobytes()
        try:
            text.decode()
        except UnicodeDecodeError:
            text = _decode_broken(ids[low:high], vocab)
        out.append(text[1:] if text[:1] == b" " and high > low and not vocab.is_byte[ids[low]] else text)
    return out


def _decode_broken(ids: np.ndarray, vocab: Vocabulary) -> bytes:
    parts, run = [], bytearray()

    def close() -> None:
        at = 0
        while at < len(run):
            for width in (1, 2, 3, 4):
                try:
                    parts.append(bytes(run[at : at + width]).decode().encode())
                    at += width
                    break
                except UnicodeDecodeError:
                    continue
            else:
                parts.append(REPLACEMENT)
                at += 1
        run.clear()

    for i in ids:
        surface = vocab.surface[int(i)].as_py()
        if vocab.is_byte[i]:
            run.extend(surface)
        else:
            close()
            parts.append(surface)
    close()
    return b"".join(parts)


def encode_documents(docs: DataFrame, model_path: str, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns plus ``ids`` (array of int) for every row; a null or empty text has no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(model_path)
        for batch in batches:
            for first, texts in read_texts(batch.column("_text"), PIECE_BYTES):
                ids, counts = encode_texts(texts, vocab)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), pa.array(ids.astype(np.int32))
                )
                kept = [batch.column(name).slice(first, len(texts)) for name in keep]
                yield pa.RecordBatch.from_arrays([*kept, lists], names=[*keep, "ids"])

    table = docs.select(*keep, docs[text].alias("_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields)
    return map_batches(table, run, f"{fields}, ids array<int>")


def token_digests(docs: DataFrame, model_path: str) -> DataFrame:
    """Per document: number of ids, digest of the ids, digest of the text decoded from them.

    Map-only: nothing is shuffled, and a batch is worked through in pieces of a MB.  Empty and null texts
    have no ids and decode to nothing.  Repeated rows each give a row; a null doc_id is kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(model_path)
        for batch in batches:
            for first, texts in read_texts(batch.column("text"), PIECE_BYTES):
                ids, counts = encode_texts(texts, vocab)
                decimals = vocab.decimal.take(pa.array(ids))
                offsets = np.frombuffer(decimals.buffers()[1], dtype=np.int64)[: len(ids) + 1]
                data = decimals.buffers()[2]
                view = memoryview(data) if data is not None else memoryview(b"")
                ends = np.cumsum(counts)
                ids_sha = [
                    hashlib.sha256(view[offsets[low] : max(offsets[low], offsets[high] - 1)]).hexdigest()
                    for low, high in zip(ends - counts, ends)
                ]
                text_sha = [hashlib.sha256(t).hexdigest() for t in decode_ids(ids, counts, vocab)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, len(texts)),
                        pa.array(counts, pa.int64()),
                        pa.array(ids_sha, pa.string()),
                        pa.array(text_sha, pa.string()),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return map_batches(
        docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text"),
        run,
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
