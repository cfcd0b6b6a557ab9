"""Token sequences of bounded length filled from whole documents by a grouping genetic algorithm.

Documents are tokenised, only those longer than a sequence are cut, and every piece goes whole into one sequence. Which pieces
share a sequence depends on their lengths alone, so the search works on lengths:

* pieces are dealt at random into blocks of about ``BLOCK`` pieces; a block's instance is the count of each length (at most
  ``capacity`` numbers). A full piece is a sequence of its own.
* several islands evolve packings of each block. Crossover injects whole well-filled sequences of one parent into a child, keeps
  those of the other parent that repeat no piece, and puts the displaced pieces back by best fit, longest first. Mutation opens the
  emptiest sequences and some others.
* after every epoch the best packing of an island migrates to its neighbour; after the last the best of the block wins and its
  places are handed to the block's pieces of those lengths.

A block wastes at most the one sequence that stays open, so blocks cost less than one part in some thousands.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from daybook.llm.common import byte_spelling, settle

CAPACITY = 2048
END_ID = 0
BLOCK = 16_384  # pieces packed together
ISLANDS, EPOCHS, POPULATION, CHILDREN = 2, 3, 4, 6
OPENED = 0.02, 0.2  # share of the well-filled sequences that a mutation opens, besides all others
WASTE = 4  # a sequence with at most so many free places counts as well filled
CACHED_WORDS, CACHED_STEMS, LONGEST_CACHED = 200_000, 400_000, 64  # in one table, about 180 MB in a worker at most
SEEN = 1 << 22  # marks of words that occurred once

# ----------------------------------------------------------------------------- tokens

#: Latin letters and then ASCII punctuation other than the apostrophe: the vocabulary's rules cut such a word between the two.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
_LETTERS = re.compile("[a-zß-öø-ÿ]+")
#: Separators for Python's split() that are no white space for the tokenizer.
_ODD = re.compile("[\x1c-\x1f]")
_loaded: dict[str, "WordIds"] = {}


class WordIds(dict):
    """Little-endian 32-bit ids of words. The vocabulary drops white space, so a text's ids are those of its words in order.

    Words and the pieces they are cut into are held once, and from their second occurrence on: most occur once, and a worker
    keeps what it holds while later stages run in it.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.markers = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.spelling = byte_spelling()
        self.seen, self.marks = bytearray(SEEN), 0

    def encode(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def stem(self, stem: str) -> bytes:
        """Lower-case Latin letters are one unit for the vocabulary's rules: their bytes, spelt as characters, go straight to the model."""
        if not _LETTERS.fullmatch(stem):
            return self.encode(stem)
        tokens = self.tokenizer.model.tokenize(stem.encode().decode("latin-1").translate(self.spelling))
        return np.asarray([t.id for t in tokens], dtype="<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        found = _PLAIN.fullmatch(word)
        stem = found[1].lower() if found else word
        keep = stem == word or stem in self  # a spelling of a piece that is not held is not held either
        if stem != word:
            ids = self[stem] + (self[found[2]] if found[2] else b"")
        else:
            ids = self.stem(word)
        if keep and len(word) <= LONGEST_CACHED and self._repeated(word):
            if len(self) >= CACHED_WORDS + CACHED_STEMS:
                self.clear()
            self[word] = ids
        return ids

    def _repeated(self, word: str) -> bool:
        """Whether the word, or another of the same mark, occurred before; marks start anew when half of them are set."""
        mark = hash(word) % SEEN
        if self.seen[mark]:
            return True
        if self.marks >= SEEN // 2:
            self.seen, self.marks = bytearray(SEEN), 0
        self.seen[mark] = 1
        self.marks += 1
        return False

    def text(self, text: str) -> bytes:
        if _ODD.search(text) or any(m in text for m in self.markers):
            return self.encode(text)  # a marker has an id of its own and parts the text around it
        return b"".join(map(self.__getitem__, text.split()))


def word_ids(path: str) -> WordIds:
    if path not in _loaded:
        _loaded[path] = WordIds(path)
    return _loaded[path]


def _cut(batches: Iterator[pa.RecordBatch], path: str, capacity: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    ids_of, end = word_ids(path), np.array([END_ID], dtype="<u4").tobytes()
    for batch in batches:
        rows, piece, start, length, crc, ids = [], [], [], [], [], []
        for at, text in enumerate(batch.column(1).to_pylist()):
            data = ids_of.text(text or "") + end
            for k, low in enumerate(range(0, len(data), 4 * capacity)):
                part = data[low:low + 4 * capacity]
                rows.append(at)
                piece.append(k)
                start.append(low // 4)
                length.append(len(part) // 4)
                crc.append(zlib.crc32(part))
                if with_ids:
                    ids.append(np.frombuffer(part, dtype="<i4"))
        columns = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                   pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
        if with_ids:
            columns.append(pa.array(ids, pa.list_(pa.int32())))
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)


def pieces_of(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
              with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every document: its ids and the end id, cut only if longer than a sequence.

    A null text is an empty one and gives one piece, the end id alone. Other columns of ``docs`` are not read.
    """
    more = ", ids array<int>" if with_ids else ""
    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(
        lambda batches: _cut(batches, path, capacity, with_ids),
        f"doc_id long, piece int, start long, length long, ids_crc32 long{more}")


# ----------------------------------------------------------------------------- packings of one block

class Bins:
    """Open sequences by free places; the tightest that takes a length is found through a bit set of the free places."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.by_free: list[list[list[int]]] = [[] for _ in range(capacity + 1)]
        self.held = 0

    def add(self, items: list[int], free: int) -> None:
        self.by_free[free].append(items)
        self.held |= 1 << free

    def best_fit(self, length: int) -> None:
        fits = self.held >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            place = self.by_free[free]
            items = place.pop()
            if not place:
                self.held ^= 1 << free
        else:
            items, free = [], self.capacity
        items.append(length)
        self.add(items, free - length)

    def packing(self) -> list[list[int]]:
        """All sequences, fullest first."""
        return [items for place in self.by_free for items in place]


def best_fit(items, capacity: int, bins: Bins | None = None) -> list[list[int]]:
    bins = bins or Bins(capacity)
    for length in items:
        bins.best_fit(length)
    return bins.packing()


def fitness(packing: list[list[int]]) -> tuple[int, int]:
    """Fewer sequences first, then unevenly filled ones, whose free places are of more use."""
    return -len(packing), sum(sum(b) ** 2 for b in packing)


def crossover(mother: list[list[int]], father: list[list[int]], counts: np.ndarray, capacity: int, rng) -> list[list[int]]:
    left = counts.tolist()
    bins = Bins(capacity)
    good = [b for b in father if sum(b) >= capacity - WASTE]
    for b, taken in zip(good, rng.random(len(good)) < rng.uniform(0.3, 0.7), strict=True):
        if taken:
            for x in b:
                left[x] -= 1
            bins.add(list(b), capacity - sum(b))
    for b in mother:  # fullest first
        free = capacity - sum(b)
        for at, x in enumerate(b):
            left[x] -= 1
            if left[x] < 0:  # repeats a piece that is in the child already
                for y in b[:at + 1]:
                    left[y] += 1
                break
        else:
            bins.add(list(b), free)
    displaced = [x for x in range(len(left) - 1, 0, -1) for _ in range(left[x])]
    return best_fit(displaced, capacity, bins)


def mutate(packing: list[list[int]], capacity: int, rng) -> list[list[int]]:
    opened = rng.random(len(packing)) < rng.uniform(*OPENED)
    opened |= np.array([sum(b) for b in packing]) < capacity - rng.integers(0, WASTE + 1)
    opened[-2:] = True
    bins, loose = Bins(capacity), []
    for b, out in zip(packing, opened, strict=True):
        if out:
            loose += b
        else:
            bins.add(list(b), capacity - sum(b))
    loose = np.array(loose)
    order = np.argsort(-loose * rng.uniform(0.99, 1.01, loose.size))
    return best_fit(loose[order].tolist(), capacity, bins)


def evolve(counts: np.ndarray, capacity: int, known: list[list[list[int]]], children: int, seed) -> tuple[list[list[list[int]]], int]:
    """Two best packings after some children, and how many there were; ``known`` holds those the island had or received.

    An island that knows nothing begins with packings of the pieces in random order.
    """
    rng = np.random.default_rng(seed)
    items = np.repeat(np.arange(counts.size), counts)
    bound = -(-int(items.sum()) // capacity)
    ranked = known or [best_fit(rng.permutation(items).tolist(), capacity) for _ in range(POPULATION)]
    ranked = sorted(ranked, key=fitness, reverse=True)
    while len(ranked) < POPULATION and len(ranked[0]) > bound:
        ranked.append(mutate(ranked[0], capacity, rng))
    ranked.sort(key=fitness, reverse=True)
    born = 0
    while born < children and len(ranked[0]) > bound:  # nothing can be better than the bound
        one, two = rng.choice(len(ranked), 2, replace=len(ranked) < 2)
        child = mutate(crossover(ranked[min(one, two)], ranked[max(one, two)], counts, capacity, rng), capacity, rng)
        ranked = sorted([*ranked, child], key=fitness, reverse=True)[:POPULATION]
        born += 1
    return ranked[:2], born


def flat(packing: list[list[int]]) -> list[int]:
    """Lengths in order, a 0 after each sequence."""
    return [x for b in packing for x in (*b, 0)]


def unflat(flattened) -> list[list[int]]:
    values = np.asarray(flattened, dtype=np.int64)
    ends = np.flatnonzero(values == 0)
    return [part[:-1].tolist() for part in np.split(values, ends + 1)[:-1]]


# ----------------------------------------------------------------------------- Spark

_STATE = "block long, island int, lengths array<int>, counts array<int>, packings array<array<int>>, born int"


def _island(epoch: int, capacity: int, seed: int):
    def run(key: tuple[Any, ...], rows: pd.DataFrame) -> pd.DataFrame:
        lengths, amounts = rows["lengths"].iloc[0], rows["counts"].iloc[0]
        counts = np.zeros(capacity + 1, dtype=np.int64)
        counts[np.asarray(lengths, dtype=np.int64)] = amounts
        known = [unflat(p) for row in rows["packings"] for p in row]
        best, born = evolve(counts, capacity, known, CHILDREN, [seed, int(key[0]), int(key[1]), epoch])
        return pd.DataFrame({"block": [key[0]], "island": [key[1]], "lengths": [lengths], "counts": [amounts],
                             "packings": [[flat(p) for p in best]], "born": [int(rows["born"].max()) + born]})

    return run


def _places(key: tuple[Any, ...], rows: pd.DataFrame) -> pd.DataFrame:
    """One row per place of the block's best packing: which piece of which length goes where."""
    best = max((unflat(p) for row in rows["packings"] for p in row), key=fitness)
    length = np.array([x for b in best for x in b], dtype=np.int64)
    sequence = np.repeat(np.arange(len(best)), [len(b) for b in best])
    place = np.array([at for b in best for at in np.cumsum([0, *b[:-1]])], dtype=np.int64)
    order = np.argsort(length, kind="stable")
    sorted_lengths = length[order]
    nth = np.empty(length.size, dtype=np.int64)
    nth[order] = np.arange(length.size) - np.searchsorted(sorted_lengths, sorted_lengths)
    return pd.DataFrame({"block": key[0], "length": length, "nth": nth, "sequence": sequence, "offset": place})


def searched(part: DataFrame, blocks: int, capacity: int, seed: int) -> DataFrame:
    """The best packings of every block and island by length counts, and how many children were born for them."""
    histogram = (part.groupBy(F.col("_block").alias("block"), F.col("length").cast("int").alias("length"))
                 .agg(F.count("*").cast("int").alias("n")).groupBy("block")
                 .agg(F.sort_array(F.collect_list(F.struct("length", "n"))).alias("h")))
    state = histogram.select("block", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"), F.col("h.length").alias("lengths"),
                             F.col("h.n").alias("counts"), F.array().cast("array<array<int>>").alias("packings"), F.lit(0).alias("born"))
    tasks = min(blocks * ISLANDS, 4_096)  # an island's work is long against its bytes: tasks are dealt by number, not by size
    for epoch in range(EPOCHS):
        state = settle(state.repartition(tasks, "block", "island").groupBy("block", "island").applyInPandas(_island(epoch, capacity, seed), _STATE))
        if epoch < EPOCHS - 1:  # the best of each island also goes to the next one
            state = state.unionByName(state.withColumn("island", (F.col("island") + 1) % ISLANDS)
                                      .withColumn("packings", F.slice("packings", 1, 1)))
    return state


def pack(pieces: DataFrame, capacity: int = CAPACITY, block: int = BLOCK, seed: int = 17) -> DataFrame:
    """The columns of ``pieces`` with sequence_id and offset; ``length`` lies between 1 and ``capacity``.

    Rows are packed as they are, equal ones too; an empty table gives an empty result. Columns beginning with ``_`` and the names of the
    new columns are reserved: a table with such a column is refused.
    """
    taken = [c for c in pieces.columns if c in ("sequence_id", "offset") or c.startswith("_")]
    if taken:
        raise ValueError(f"reserved column names: {', '.join(taken)}")
    rows = settle(pieces.withColumn("_row", F.monotonically_increasing_id()))
    blocks = max(1, -(-rows.count() // block))
    rows = rows.withColumn("_block", F.pmod(F.xxhash64("_row", F.lit(seed)), F.lit(blocks)))
    part = rows.filter(F.col("length") < capacity)
    state = searched(part, blocks, capacity, seed)
    places = state.groupBy("block").applyInPandas(_places, "block long, length long, nth long, sequence long, offset long")
    turn = Window.partitionBy("_block", "length").orderBy("_row")
    placed = (part.withColumn("_nth", F.row_number().over(turn) - 1)
              .join(places.select(F.col("block").alias("_block"), "length", F.col("nth").alias("_nth"), F.col("sequence").alias("_sequence"),
                                  F.col("offset").alias("offset")), ["_block", "length", "_nth"]))
    # blocks and full pieces number their sequences apart: even and odd
    packed = placed.withColumn("sequence_id", (F.col("_block") * (1 << 24) + F.col("_sequence")) * 2)
    full = rows.filter(F.col("length") >= capacity).withColumn("offset", F.lit(0).cast("long")).withColumn(
        "sequence_id", F.col("_row") * 2 + 1)
    columns = [*pieces.columns, "sequence_id", "offset"]
    return packed.select(columns).unionByName(full.select(columns))


def packed_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: all documents tokenised, cut where too long, and packed.

    See ``pieces_of`` for null and empty texts; repeated rows are packed as often as they occur.
    """
    return pack(pieces_of(docs, path, id_col, text_col, capacity), capacity)
