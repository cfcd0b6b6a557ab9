import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from daybook.llm import packing
from daybook.llm.common import tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")


def expected_pieces(rows, capacity):
    tokenizer = Tokenizer.from_file(PATH)
    out = []
    for doc, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        for k, low in enumerate(range(0, ids.size, capacity)):
            part = ids[low:low + capacity]
            out.append((doc, k, low, part.size, zlib.crc32(part.tobytes())))
    return sorted(out, key=repr)


def check_layout(rows, capacity):
    """Every sequence is gapless from 0 and not too long; returns how many there are."""
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


PLAIN = Tokenizer.from_file(PATH)


def plain_ids(text):
    return np.array(PLAIN.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


@pytest.mark.parametrize("text", [
    "a <|endoftext|> b", "a<|startoftext|>B  <|endoftext|>.", "<|ENDOFTEXT|> | x", "don't<|endoftext|>'s",
    "Plain words, twice: Plain WORDS!!", "it's the dogs' don't we'll 'quoted' 3rd 12.5% a_b __x", "Éèaux straße ĞİŞ ΣΑΣ ς œuvre ½ ²",
    "tab\tnew\nline\x0bv\x0cf nbsp em　wide\u0085nel", "odd\x1cseparators\x1fhere", "é composed ́ alone",
    "<|endoftext|> is text", "日本語テキスト mixed 漢字", "emoji 👩‍👩‍👧 ok", "x" * 5_000, "", "   ", "---", "a'b'c 's 'S"])
def test_words_give_the_ids_of_the_text(text):
    ids = packing.WordIds(PATH)
    for _ in range(3):  # the last ones from the cache
        assert ids.text(text) == plain_ids(text)


def test_markers_have_their_own_ids():
    assert np.frombuffer(packing.WordIds(PATH).text("a <|endoftext|> b"), dtype="<u4").tolist() == [320, 49407, 321]


def test_documents_give_the_ids_of_the_text(spark):
    ids = packing.WordIds(PATH)
    for (text,) in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect():
        assert ids.text(text) == plain_ids(text)


def test_small_caches_change_nothing(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 3)
    monkeypatch.setattr(packing, "CACHED_STEMS", 2)
    ids = packing.WordIds(PATH)
    text = "a bb ccc dddd a bb! CCC. eeee a bb! CCC."
    assert ids.text(text) == plain_ids(text)


def test_words_that_occur_once_are_not_held(monkeypatch):
    """A worker keeps its words while later stages run in it: it holds each once, and only those that come again."""
    ids = packing.WordIds(PATH)
    once = " ".join(f"{a}{b}{c}q" for a in "bcdfg" for b in "aeiou" for c in "klmnprst")
    assert ids.text(once) == plain_ids(once) and sum(map(len, [ids, getattr(ids, "stems", {})])) < 10
    assert ids.text(once) == plain_ids(once) and sum(map(len, [ids, getattr(ids, "stems", {})])) == len(once.split())
    monkeypatch.setattr(packing, "CACHED_WORDS", 20)
    monkeypatch.setattr(packing, "CACHED_STEMS", 30)
    for text in (once, once.upper(), once.replace(" ", ", "), once):
        assert ids.text(text) == plain_ids(text)
    assert sum(map(len, [ids, getattr(ids, "stems", {})])) <= 50


def test_marks_that_start_anew_change_nothing(monkeypatch):
    monkeypatch.setattr(packing, "SEEN", 4)
    ids = packing.WordIds(PATH)
    for text in ("a bb ccc dddd eeee ffff a bb! CCC.", "CCC. bb a a gg hh ii jj kk"):
        assert ids.text(text) == plain_ids(text)
    assert ids.marks <= 2


def test_crossover_and_mutation_keep_every_piece():
    rng = np.random.default_rng(3)
    items = rng.integers(1, 100, 500)
    counts = np.bincount(items, minlength=101)
    shuffled = [packing.best_fit(rng.permutation(items).tolist(), 100) for _ in range(2)]
    child = packing.mutate(packing.crossover(*shuffled, counts, 100, rng), 100, rng)
    assert sorted(x for b in child for x in b) == sorted(items.tolist()) and max(map(sum, child)) <= 100
    assert packing.unflat(packing.flat(child)) == child
    assert packing.unflat(packing.flat([])) == []


def test_search_is_better_than_best_fit():
    rng = np.random.default_rng(11)
    triples = []
    for _ in range(60):  # packs perfectly by threes, which best fit misses
        a, b = rng.integers(250, 380, 2)
        triples += [int(a), int(b), 1000 - int(a) - int(b)]
    counts = np.bincount(triples, minlength=1001)
    first = packing.best_fit(sorted(triples, reverse=True), 1000)
    found, born = packing.evolve(counts, 1000, [], 60, 5)
    assert len(found[0]) < len(first) and born > 5
    again = packing.evolve(counts, 1000, found[:1], 5, 6)[0]
    assert len(again[0]) <= len(found[0])


def test_given_documents_are_packed_by_evolution(spark):
    """Random groupings do not reach the bound; crossover and mutation bring them there."""
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    pieces = packing.pieces_of(df, PATH).withColumn("_block", F.lit(0).cast("long")).filter("length < 2048")
    lengths = [r.length for r in pieces.collect()]
    bound = -(-sum(lengths) // 2048)
    assert len(packing.best_fit(np.random.default_rng(1).permutation(lengths).tolist(), 2048)) > bound
    state = packing.searched(pieces, 1, 2048, 17).collect()
    assert min(len(packing.unflat(p)) for r in state for p in r.packings) == bound and all(r.born > 0 for r in state)


def test_edge_rows(spark):
    rows = [(1, "one two three"), (2, None), (3, ""), (4, "word " * 100), (4, "word " * 100), (None, "no id"), (5, "a b c d e f g"),
            (6, "x " * 31), (7, " \n\t ")]
    df = spark.createDataFrame([(d, t, "z", 1) for d, t in rows], "doc_id long, text string, length string, offset int")
    for name in ("offset", "sequence_id", "_row"):
        with pytest.raises(ValueError):
            packing.pack(spark.createDataFrame([(1, 2)], f"length long, {name} long"))
    got = packing.packed_documents(df, PATH, capacity=32).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr) == expected_pieces(rows, 32)
    assert check_layout(got, 32) >= -(-sum(r.length for r in got) // 32)
    assert packing.packed_documents(df.limit(0), PATH).collect() == []


def test_documents_reach_the_bound(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = packing.packed_documents(df, PATH).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr) == expected_pieces(
        [tuple(r) for r in df.collect()], 2048)
    assert check_layout(got, 2048) <= -(-sum(r.length for r in got) // 2048) + 1


def test_blocks_and_reproducible_sequences(spark):
    pieces = spark.range(3_000).selectExpr("id as doc_id", "cast(1 + pmod(xxhash64(id), 2048) as bigint) as length")
    runs = [sorted(tuple(r) for r in packing.pack(pieces, block=500).select("doc_id", "length", "sequence_id", "offset").collect())
            for _ in range(2)]
    assert runs[0] == runs[1] and len(runs[0]) == 3_000
    rows = packing.pack(pieces, block=500).collect()
    assert check_layout(rows, 2048) <= -(-sum(r.length for r in rows) // 2048) * 1.02 + 6


def test_ids_column_holds_what_the_checksum_covers(spark):
    df = spark.createDataFrame([(1, "some words here"), (2, None)], "doc_id long, text string")
    for r in packing.pieces_of(df, PATH, with_ids=True).collect():
        assert len(r.ids) == r.length and zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) == r.ids_crc32
