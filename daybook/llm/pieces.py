"""Sampled subword segmentations by forward filtering and backward sampling, and their lossless inverse.

The vocabulary is that of a SentencePiece model. A piece's probability falls with its rank (score) in the vocabulary; a segmentation's is the
product, raised to ``sharpness``. Forward filtering adds up the probabilities of all segmentations of every beginning of a word; backward
sampling then draws the last piece by its share, the one before it, and so on, which is an exact draw among all
segmentations. The random numbers come from a hash of the row key, the word's place and the step: a row gets the same pieces on any machine and
in any company, equal words of a text are drawn independently.

No piece crosses the start of a word (a run of spaces and what follows it up to the next space), so lattices are built for the distinct
words of some documents at once. Texts are handled as bytes behind one added space: characters that are no piece become byte
pieces, a literal U+2581 too, and joining the pieces gives back the text exactly.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from daybook.llm.common import WordHasher, mix64, text_bytes

SHARPNESS = 1.0
TOGETHER = 6 << 20  # bytes of text whose words are gathered at once
_SLOTS = 1 << 18
_loaded: dict[tuple[str, float], "Lattice"] = {}


class Lattice:
    """Pieces as bytes (a space for U+2581) with their log probabilities, found by hash."""

    def __init__(self, path: str, sharpness: float = SHARPNESS):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        ranks = np.array([-model.get_score(i) for i in range(size)])
        self.scores = -np.log(2 + np.maximum(ranks, 0))
        usable = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i))]
        self.scores = sharpness * (self.scores - np.log(np.exp(self.scores[usable]).sum()))
        self.bytes_of = [b""] * size
        self.byte_id = np.zeros(256, dtype=np.int32)
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:-1], 16)
                self.bytes_of[i], self.byte_id[value] = bytes([value]), i
        self.hasher = WordHasher(fold=False)
        self.keys, self.ids = np.zeros(_SLOTS, dtype=np.uint64), np.full(_SLOTS, -1, dtype=np.int32)
        lengths = set()
        for i in usable:
            piece = model.id_to_piece(i).replace("▁", " ").encode()
            if b" " in piece.lstrip(b" "):
                raise ValueError("a piece of the model crosses the start of a word")
            self.bytes_of[i] = piece
            lengths.add(len(piece))
            key = int(self.hashes(np.frombuffer(piece, dtype=np.uint8), np.array([0]), np.array([len(piece)]))[0])
            at = key & (_SLOTS - 1)
            while self.keys[at]:
                at = (at + 1) & (_SLOTS - 1)
            self.keys[at], self.ids[at] = key, i
        self.lengths = sorted(lengths)

    def sums(self, data: np.ndarray) -> np.ndarray:
        if data.size >= self.hasher.powers.size:
            self.hasher._grow(data.size + 1)
        return np.r_[np.uint64(0), np.cumsum(self.hasher.values[data] * self.hasher.powers[:data.size])]

    def hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, sums: np.ndarray | None = None) -> np.ndarray:
        """Hashes of data[start:end], never 0."""
        sums = self.sums(data) if sums is None else sums
        return mix64((sums[ends] - sums[starts]) * self.hasher.inverses[starts] + (ends - starts).astype(np.uint64)) | np.uint64(1)

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Piece ids, -1 where there is none."""
        found = np.full(hashes.size, -1, dtype=np.int32)
        slot = (hashes & np.uint64(_SLOTS - 1)).astype(np.int64)
        left = np.arange(hashes.size)
        while left.size:
            held = self.keys[slot[left]]
            hit = held == hashes[left]
            found[left[hit]] = self.ids[slot[left[hit]]]
            left = left[~hit & (held != 0)]
            slot[left] = (slot[left] + 1) & (_SLOTS - 1)
        return found

    def edges(self, data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First place, end place and id of every piece that fits into the words, which lie one after the other in ``data``."""
        word_end = np.repeat(np.cumsum(sizes), sizes)
        room = word_end - np.arange(data.size)
        sums = self.sums(data)
        size = np.select([data < 0x80, data < 0xC0, data < 0xE0, data < 0xF0], [1, 0, 2, 3], 4)  # 0: within a character
        firsts, ends, ids = [], [], []
        alone = np.zeros(data.size, dtype=bool)  # characters that are pieces
        for length in self.lengths:
            at = np.flatnonzero((room >= length) & (size > 0))
            if not at.size:
                continue
            found = self.lookup(self.hashes(data, at, at + length, sums))
            at, found = at[found >= 0], found[found >= 0]
            firsts.append(at)
            ends.append(at + length)
            ids.append(found)
            alone[at[size[at] == length]] = True
        lead = np.maximum.accumulate(np.where(size > 0, np.arange(data.size), 0))
        raw = np.flatnonzero(~alone[lead])
        return (np.concatenate([*firsts, raw]), np.concatenate([*ends, raw + 1]), np.concatenate([*ids, self.byte_id[data[raw]]]))

    def filtered(self, data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The draws that end at every place: running shares (each place's end one above its number), first places and ids; and log totals.

        A place is a byte's end; places of a word follow its start, which has the number of the byte before it.
        """
        first, end, ids = self.edges(data, sizes)
        start = np.repeat(np.cumsum(sizes) - sizes, sizes)
        depth = end - start[first]
        order = np.lexsort((end, depth))
        first, end, ids, depth = first[order], end[order], ids[order], depth[order]
        total = np.zeros(data.size + 1)  # at a word's start 0; read before the word before it writes its end there
        inner = first != start[first]
        gain = self.scores[ids]
        weight = np.empty(first.size)
        cuts = np.r_[np.flatnonzero(np.diff(depth, prepend=-1)), depth.size]
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            reached = gain[low:high] + np.where(inner[low:high], total[first[low:high]], 0.0)
            own = np.flatnonzero(np.diff(end[low:high], prepend=-1))
            most = np.maximum.reduceat(reached, own)
            amount = np.diff(np.r_[own, high - low])
            share = np.exp(reached - np.repeat(most, amount))
            added = np.add.reduceat(share, own)
            total[end[low:high][own]] = most + np.log(added)
            weight[low:high] = share / np.repeat(added, amount)
        order = np.argsort(end, kind="stable")
        first, end, ids, weight, inner = first[order], end[order], ids[order], weight[order], inner[order]
        own = np.flatnonzero(np.diff(end, prepend=-1))
        amount = np.diff(np.r_[own, end.size])
        running = np.cumsum(weight)
        running -= np.repeat(np.r_[0.0, running[own[1:] - 1]], amount)
        running[np.r_[own[1:], end.size] - 1] = 1.0
        return end + np.minimum(running, 1.0), np.where(inner, first, -1), ids, total

    def sample(self, texts: list[bytes], keys: np.ndarray) -> list[np.ndarray]:
        """Ids of one sampled segmentation per text; ``keys`` are 64-bit row keys."""
        buffer = np.frombuffer(b"".join(b" " + t for t in texts), dtype=np.uint8)
        doc_size = np.array([len(t) + 1 for t in texts])
        doc_start = np.cumsum(doc_size) - doc_size
        space = buffer == 32
        begins = space & np.r_[True, ~space[:-1]]
        begins[doc_start] = True
        starts = np.flatnonzero(begins)
        ends = np.r_[starts[1:], buffer.size]
        _, head, word = np.unique(self.hashes(buffer, starts, ends), return_index=True, return_inverse=True)
        sizes = ends[head] - starts[head]
        base = np.cumsum(sizes) - sizes
        data = buffer[np.repeat(starts[head] - base, sizes) + np.arange(sizes.sum())]
        shares, before, ids, _ = self.filtered(data, sizes)
        doc = np.searchsorted(doc_start, starts, side="right") - 1
        turn = (np.arange(starts.size) - np.searchsorted(starts, doc_start)[doc]).astype(np.uint64)
        seed = mix64(keys[doc] ^ mix64(turn + np.uint64(0x5851F42D4C957F2D)))
        left = np.argsort(word, kind="stable")  # equal words together: neighbours search in the same place
        at, step = (base + sizes)[word[left]], 0
        drawn: list[tuple[np.ndarray, np.ndarray]] = []
        while left.size:
            u = (mix64(seed[left] + np.uint64(step)) >> np.uint64(11)).astype(np.float64) * 2.0**-53
            edge = np.searchsorted(shares, at + u, side="right")
            drawn.append((left, ids[edge]))
            at = before[edge]
            left, at = left[at >= 0], at[at >= 0]
            step += 1
        amount = np.zeros(starts.size, dtype=np.int64)
        for held, _ in drawn:
            amount[held] += 1
        last = np.cumsum(amount)
        out = np.empty(int(last[-1]) if last.size else 0, dtype=np.int32)
        for step, (held, chosen) in enumerate(drawn):
            out[last[held] - 1 - step] = chosen
        cuts = np.cumsum(np.bincount(doc, weights=amount, minlength=len(texts)).astype(np.int64))
        return np.split(out, cuts[:-1])

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))[1:]


def lattice(path: str, sharpness: float = SHARPNESS) -> Lattice:
    if (path, sharpness) not in _loaded:
        _loaded[path, sharpness] = Lattice(path, sharpness)
    return _loaded[path, sharpness]


def _groups(texts: list[bytes | None]) -> Iterator[list[int]]:
    """Places of texts that are not null, about TOGETHER bytes at once."""
    held, size = [], 0
    for at, text in enumerate(texts):
        if text is not None:
            held.append(at)
            size += len(text)
            if size >= TOGETHER:
                yield held
                held, size = [], 0
    if held:
        yield held


def _encode(batches: Iterator[pa.RecordBatch], path: str, sharpness: float, seed: int, digest: bool) -> Iterator[pa.RecordBatch]:
    own = lattice(path, sharpness)
    for batch in batches:
        texts = text_bytes(batch.column(2))
        keys = mix64(np.asarray(batch.column(1)).view(np.uint64) + np.uint64(seed))
        ids: list[np.ndarray | None] = [None] * len(texts)
        for group in _groups(texts):
            for at, found in zip(group, own.sample([texts[i] for i in group], keys[group]), strict=True):
                ids[at] = found
        if digest:
            columns = [pa.array([None if x is None else x.size for x in ids], pa.int64()),
                       pa.array([None if x is None else zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()),
                       pa.array([None if x is None else own.decode(x.tolist()) == t for x, t in zip(ids, texts, strict=True)], pa.bool_())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n_pieces", "ids_crc32", "lossless"])
        else:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", sharpness: float = SHARPNESS, seed: int = 0,
            digest: bool = False) -> DataFrame:
    """doc_id, ids per row of ``docs``; with ``digest`` doc_id, n_pieces, ids_crc32 and lossless (whether decoding gave the text).

    The id is the row key: rows that repeat an id and its text get equal pieces, a null id is a key of its own. A null text has null ids,
    an empty one the piece of the added space. Other columns are not read; an empty table gives an empty result.
    """
    schema = "doc_id long, n_pieces long, ids_crc32 long, lossless boolean" if digest else "doc_id long, ids array<int>"
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(id_col).cast("long")).alias("key"),
                       F.col(text_col).alias("text")).mapInArrow(lambda batches: _encode(batches, path, sharpness, seed, digest), schema)


def _decode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    own = lattice(path)
    for batch in batches:
        texts = [None if ids is None else own.decode(ids).decode("utf-8", "replace") for ids in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])


def decoded(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, text of ids that ``encoded`` gave; null ids give a null text. Ids of other origin whose bytes are no text are mended with U+FFFD."""
    return tokens.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids")).mapInArrow(
        lambda batches: _decode(batches, path), "doc_id long, text string")
