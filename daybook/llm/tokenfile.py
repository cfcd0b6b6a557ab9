"""Token ids of a corpus in binary files: one array of ids per file, document boundaries and document ids in Elias-Fano code.

A file holds, all little-endian:

* ``MAGIC``; then the ids of its documents one after another, two bytes each if the vocabulary allows it, else four;
* the boundaries (one number more than documents, the first 0) and the document ids less the smallest, each as an Elias-Fano sequence;
* a footer of fixed size that says where these begin.

An Elias-Fano sequence of n ascending numbers up to u keeps the low ``log2(u / n)`` bits of each number side by side and the rest in unary: a bit
set at place ``high + i`` for number i. That is at most 2 + log2(u / n) bits a number. The place of every ``STEP``-th set bit is kept too (32
bits), so any number is found by looking at a few hundred bits; no table of 64-bit offsets is stored or built.

Documents lie in ascending order of their ids over all files: they are sorted by range, each task tokenises its rows and streams them into one
file. A file appears under its name only when it is complete and its content follows from its rows, so a task that runs again changes
nothing. Files are written and read through ``pyarrow.fs``: a plain path or any URI it knows.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from daybook.llm.common import byte_spelling
from daybook.operators.staging import fresh_path, materialise

END_ID = 2
FILE_BYTES = 64 << 20  # text that goes into one file, about
MAX_FILES = 100_000
STEP = 512  # set bits per select entry
MAGIC = b"IDARRAY1"
FOOTER = struct.Struct("<8sIIQQQQQqq")  # magic, width, rows without an id, ids, documents, places of the two sequences, end, smallest and largest id
READ_IDS = 1 << 20  # ids held at once while reading
CACHED, LONGEST_CACHED = 1_000_000, 48  # about 150 MB in a worker at most
SLICE = 1 << 20  # characters of a long text that are encoded at once

# ----------------------------------------------------------------------------- Elias-Fano

def _pack(values: np.ndarray, bits: int) -> bytes:
    """The low ``bits`` bits of each number, side by side."""
    if not bits or not values.size:
        return b""
    out = []
    for low in range(0, values.size, 8 * STEP):  # a whole number of bytes each
        block = values[low:low + 8 * STEP, None] >> np.arange(bits, dtype=np.uint64)[None, :]
        out.append(np.packbits((block & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little").tobytes())
    return b"".join(out)


class EliasFano:
    """An ascending sequence of numbers below 2**64 in near-minimal space, read by place."""

    HEAD = struct.Struct("<QIQQ")  # numbers, low bits, bytes of the low and of the high part

    def __init__(self, n: int, bits: int, low: bytes, high: bytes, select: np.ndarray):
        self.n, self.bits, self.select = n, bits, select
        self.low, self.high = np.frombuffer(low, dtype=np.uint8), np.frombuffer(high, dtype=np.uint8)

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n = values.size
        bits = max(0, (int(values[-1]) // n).bit_length() - 1) if n else 0
        places = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        if n and places[-1] >= 1 << 32:
            raise ValueError("too many numbers for one sequence")
        flags = np.zeros(int(places[-1]) + 1 if n else 0, dtype=np.uint8)
        flags[places] = 1
        return cls(n, bits, _pack(values, bits), np.packbits(flags, bitorder="little").tobytes(), places[::STEP].astype("<u4"))

    def to_bytes(self) -> bytes:
        return self.HEAD.pack(self.n, self.bits, self.low.size, self.high.size) + self.low.tobytes() + self.high.tobytes() + self.select.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        n, bits, low, high = cls.HEAD.unpack_from(data)
        at = cls.HEAD.size
        return cls(n, bits, data[at:at + low], data[at + low:at + low + high], np.frombuffer(data, dtype="<u4", offset=at + low + high, count=-(-n // STEP)))

    def slice(self, first: int, last: int) -> np.ndarray:
        """Numbers ``first`` to ``last`` (excluded)."""
        if not 0 <= first <= last <= self.n:
            raise IndexError(f"{first}:{last} of {self.n}")
        if first == last:
            return np.empty(0, dtype=np.uint64)
        block = first // STEP
        begin = int(self.select[block]) // 8  # bytes of the high part that hold these set bits
        after = -(-last // STEP)
        end = int(self.select[after]) // 8 + 1 if after < self.select.size else self.high.size
        places = np.flatnonzero(np.unpackbits(self.high[begin:end], bitorder="little")) + 8 * begin
        skip = int(np.searchsorted(places, int(self.select[block]))) + first - block * STEP
        numbers = (places[skip:skip + last - first] - np.arange(first, last)).astype(np.uint64) << np.uint64(self.bits)
        if self.bits:
            from_bit, to_bit = first * self.bits, last * self.bits
            lows = np.unpackbits(self.low[from_bit // 8:-(-to_bit // 8)], bitorder="little")[from_bit % 8:][:to_bit - from_bit].reshape(-1, self.bits)
            numbers |= (lows.astype(np.uint64) << np.arange(self.bits, dtype=np.uint64)[None, :]).sum(axis=1, dtype=np.uint64)
        return numbers

    def __getitem__(self, i: int) -> int:
        return int(self.slice(i, i + 1)[0])

    def __len__(self) -> int:
        return self.n

    def first_at_least(self, value: int) -> int:
        """How many numbers are smaller than ``value``."""
        low, high = 0, self.n
        while low < high:
            middle = (low + high) // 2
            if self[middle] < value:
                low = middle + 1
            else:
                high = middle
        return low


# ----------------------------------------------------------------------------- ids

#: The vocabulary's rules never join characters over white space, but for one blank before a word: these parts are encoded apart.
_PART = re.compile(r" ?\S+|\s+(?!\S)|\s+")
#: Letters and ASCII punctuation other than the apostrophe are cut apart as well.
_STEM = re.compile(r"( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]+)")
_WORD = re.compile(" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")
#: White space for Python that is none for the vocabulary's rules.
_ODD = re.compile("[\x1c-\x1f]")
#: Where a long text may be cut: before a single blank between letters.
_SEAM = re.compile(r"(?<=[A-Za-z])(?= [A-Za-z])")
_loaded: dict[str, TextIds] = {}


class TextIds(dict):
    """Little-endian 32-bit ids of parts of texts, as the tokenizer gives them, held while there is room."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.markers = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: a word is one unit for the vocabulary's rules: its bytes, spelt as characters, go straight to the model
        self.model = self.tokenizer.model if self.tokenizer.normalizer is None and type(self.tokenizer.pre_tokenizer).__name__ == "ByteLevel" else None
        self.spelling = byte_spelling()

    def encode(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, part: str) -> bytes:
        found = _STEM.fullmatch(part)
        if found:
            keep = found[1] in self  # a first word is held without its punctuation
            ids = self[found[1]] + self[found[2]]
        else:
            keep = True
            if self.model and _WORD.fullmatch(part):
                ids = array("I", [t.id for t in self.model.tokenize(part.encode().decode("latin-1").translate(self.spelling))]).tobytes()
            else:
                ids = self.encode(part)
        if keep and len(part) <= LONGEST_CACHED:
            if len(self) >= CACHED:
                self.clear()
            self[part] = ids
        return ids

    def pieces(self, text: str) -> Iterator[bytes]:
        """The ids of a text in one or more runs. A text with a marker is encoded whole."""
        if _ODD.search(text) or any(m in text for m in self.markers):
            yield self.encode(text)
            return
        at = 0
        while len(text) - at > SLICE:
            seam = _SEAM.search(text, at + SLICE)
            if not seam:
                break
            yield b"".join(map(self.__getitem__, _PART.findall(text, at, seam.start())))
            at = seam.start()
        yield b"".join(map(self.__getitem__, _PART.findall(text, at)))


def text_ids(path: str) -> TextIds:
    if path not in _loaded:
        _loaded[path] = TextIds(path)
    return _loaded[path]


# ----------------------------------------------------------------------------- files

def _place(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def _width(vocabulary: int) -> int:
    return 2 if vocabulary <= 1 << 16 else 4


def write_file(path: str, documents: Iterable[tuple[int | None, str | None]], ids_of: TextIds, end_id: int = END_ID) -> dict | None:
    """Stream documents, ascending by id and those without one first, into the file ``path``; None (and no file) for no documents."""
    system, place = _place(path)
    width = _width(max(ids_of.vocabulary, end_id + 1))
    draft = f"{place}.{uuid.uuid4().hex}.draft"
    bounds, doc_ids, nulls, out = array("Q", [0]), array("q"), 0, None
    end = array("I", [end_id]).tobytes()
    for doc_id, text in documents:
        if out is None:
            system.create_dir(place.rsplit("/", 1)[0], recursive=True)
            out = system.open_output_stream(draft)
            out.write(MAGIC)
        size = 0
        for data in (*ids_of.pieces(text or ""), end):
            out.write(data if width == 4 else np.frombuffer(data, dtype="<u4").astype("<u2").tobytes())
            size += len(data) // 4
        bounds.append(bounds[-1] + size)
        if doc_id is None:
            nulls += 1
        else:
            doc_ids.append(doc_id)
    if out is None:
        return None
    known = np.frombuffer(doc_ids, dtype=np.int64)
    least, most = (int(known[0]), int(known[-1])) if known.size else (0, 0)
    parts = [EliasFano.of(np.frombuffer(bounds, dtype=np.uint64)).to_bytes(), EliasFano.of(known.view(np.uint64) - np.uint64(least % (1 << 64))).to_bytes()]
    at = len(MAGIC) + bounds[-1] * width
    for part in parts:
        out.write(part)
    ends = [at, at + len(parts[0]), at + len(parts[0]) + len(parts[1])]
    out.write(FOOTER.pack(MAGIC, width, nulls, bounds[-1], len(bounds) - 1, *ends, least, most))
    out.close()
    system.move(draft, place)
    return {"documents": len(bounds) - 1, "ids": bounds[-1], "nulls": nulls, "least": least, "most": most}


class IdFile:
    """Random and sequential access to one file: boundaries and document ids are held coded, ids are read as asked for."""

    def __init__(self, path: str):
        system, place = _place(path)
        self.file = system.open_input_file(place)
        size = self.file.size()
        tail = self.file.read_at(FOOTER.size, size - FOOTER.size) if size >= FOOTER.size else b""
        if tail[:8] != MAGIC:
            raise ValueError(f"not an id file: {path}")
        _, self.width, self.nulls, self.ids, self.documents, *ends, self.least, self.most = FOOTER.unpack(tail)
        self.bounds = EliasFano.from_bytes(self.file.read_at(ends[1] - ends[0], ends[0]))
        self.known = EliasFano.from_bytes(self.file.read_at(ends[2] - ends[1], ends[1]))

    def read(self, first: int, last: int) -> np.ndarray:
        """Ids by place in the file."""
        data = self.file.read_at((last - first) * self.width, len(MAGIC) + first * self.width)
        return np.frombuffer(data, dtype=f"<u{self.width}").astype("<u4")

    def doc_id(self, i: int) -> int | None:
        return None if i < self.nulls else self.known[i - self.nulls] + self.least

    def document(self, i: int) -> np.ndarray:
        """Ids of document number ``i`` with the end id."""
        first, last = (int(b) for b in self.bounds.slice(i, i + 2))
        return self.read(first, last)

    def find(self, doc_id: int) -> np.ndarray | None:
        """Ids of the (first) document with this id."""
        i = self.known.first_at_least(doc_id - self.least) if doc_id >= self.least else self.known.n
        return self.document(self.nulls + i) if i < self.known.n and self.known[i] == doc_id - self.least else None

    def digests(self, rows: int = 4_096) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray, list[int]]]:
        """For some documents at a time: ids of the documents, starts, lengths, crc32 of the ids."""
        for low in range(0, self.documents, rows):
            high = min(low + rows, self.documents)
            bounds = self.bounds.slice(low, high + 1).astype(np.int64)
            known = self.known.slice(max(0, low - self.nulls), max(0, high - self.nulls))
            names = [None] * max(0, min(high, self.nulls) - low) + [int(x) + self.least for x in known]
            sums, i = [], 0
            while i < high - low:
                j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + READ_IDS, side="right")) - 1)
                if j == i + 1:  # one document, perhaps longer than may be held
                    crc = 0
                    for at in range(int(bounds[i]), int(bounds[j]), READ_IDS):
                        crc = zlib.crc32(self.read(at, min(at + READ_IDS, int(bounds[j]))), crc)
                    sums.append(crc)
                else:
                    data = self.read(int(bounds[i]), int(bounds[j]))
                    cuts = bounds[i:j + 1] - bounds[i]
                    sums += [zlib.crc32(data[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                i = j
            yield names, bounds[:-1], np.diff(bounds), sums


# ----------------------------------------------------------------------------- Spark

def _write(batches: Iterator[pa.RecordBatch], path: str, vocabulary: str, end_id: int) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId()
    rows = ((i, t) for b in batches for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
    name = f"{path}/ids-{number:06d}.bin"
    made = write_file(name, rows, text_ids(vocabulary), end_id)
    if made:
        yield pa.RecordBatch.from_pydict({"file": [number], "path": [name], "documents": [made["documents"]], "ids": [made["ids"]]})


def write_ids(docs: DataFrame, path: str, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID,
              file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write all documents below ``path`` and return one row per file: file, path, documents, ids, start (ids in the files before it).

    Rows without an id come first; rows of equal ids are ordered by a hash of their text, equal rows are all written. A null or empty text
    is the end id alone. An empty table gives no file and no row. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    total = rows.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    files = min(MAX_FILES, max(1, -(-total // file_bytes), min(docs.sparkSession.sparkContext.defaultParallelism, total >> 20)))
    # the last key only spreads equal rows over tasks
    order = ["_id", "_hash", "_row"]
    dealt = (rows.withColumns({"_hash": F.xxhash64("_text"), "_row": F.monotonically_increasing_id()})
             .repartitionByRange(files, *order).sortWithinPartitions(*order).select("_id", "_text"))
    written = materialise(dealt.mapInArrow(lambda b: _write(b, path, vocabulary, end_id), "file long, path string, documents long, ids long"))
    files_of = sorted(tuple(r) for r in written.collect())  # at most MAX_FILES rows of four values
    start, listed = 0, []
    for number, name, documents, ids in files_of:
        listed.append((number, name, documents, ids, start))
        start += ids
    return docs.sparkSession.createDataFrame(listed, "file long, path string, documents long, ids long, start long")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for names, starts, lengths, sums in IdFile(path).digests():
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(starts + start), pa.array(lengths), pa.array(sums, pa.int64())],
                                                 names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_digests(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files that ``write_ids`` listed."""
    number = max(1, files.count())
    dealt = files.select("path", "start").repartition(number)
    return dealt.mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def report(docs: DataFrame, vocabulary: str, path: str | None = None, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write all documents as id files and say what the files hold: doc_id, start, n_tokens, ids_crc32 per document."""
    return read_digests(write_ids(docs, path or fresh_path(docs.sparkSession), vocabulary, file_bytes=file_bytes))
