import os
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from daybook.llm import tokenfile
from daybook.llm.common import tokenizer_path

VOCABULARY = tokenizer_path("byte_bpe_50k.json")


def plain(rows):
    """Expected digests with the tokenizer as it comes, rows sorted by id."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(VOCABULARY)
    out, start = [], 0
    for doc_id, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        out.append((doc_id, start, ids.size, zlib.crc32(ids.tobytes())))
        start += ids.size
    return out


def test_documents_are_read_back(spark, tmp_path):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = tokenfile.report(df, VOCABULARY, str(tmp_path / "ids"), file_bytes=300_000)
    assert sorted(tuple(r) for r in got.collect()) == plain(sorted((r.doc_id, r.text) for r in df.collect()))
    files = sorted(os.listdir(tmp_path / "ids"))
    assert len(files) > 3 and all(f.startswith("ids-") for f in files)
    rows = {r.doc_id: r for r in got.collect()}
    one = tokenfile.IdFile(str(tmp_path / "ids" / files[1]))
    for i in (0, one.documents // 2, one.documents - 1):
        ids = one.document(i)
        assert zlib.crc32(ids) == rows[one.doc_id(i)].ids_crc32 and (one.find(one.doc_id(i)) == ids).all()
    assert one.find(-5) is None and one.find(10**15) is None


TRICKY = ["", None, " ", "  a", "a ", "a  b", "a\n\nb", "\n\n\nx", "don't 'S it's", "a b  c", "a\x1cb \x1d c", "\x85x", "x <|endoftext|> y", "a  <|endoftext|>b", "it's.'ll",
          "word.'s", "é.è ñ!!", "¼ ² a²b", "漢字 かな", "a\r\nb\tc", "😀 😀!", "é́", "x" * 5_000, "...!!! a.b.c", " .", ". .", "A_b __c", "١٢٣ a", "ª º µ", "×÷"]


def test_tricky_texts_equal_the_plain_tokenizer(spark):
    rows = [(k, t) for k, t in enumerate(TRICKY)]
    got = tokenfile.report(spark.createDataFrame(rows, "doc_id long, text string"), VOCABULARY)
    assert sorted(tuple(r) for r in got.collect()) == plain(rows)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aB é'.,!<|> \n\t \x1c1²漢s", max_size=30))
def test_any_text_equals_the_plain_tokenizer(text):
    ids_of = tokenfile.text_ids(VOCABULARY)
    assert b"".join(ids_of.pieces(text)) == ids_of.encode(text)


def test_long_texts_are_cut_at_seams(monkeypatch):
    monkeypatch.setattr(tokenfile, "SLICE", 100)
    ids_of = tokenfile.text_ids(VOCABULARY)
    for text in ("some words  and\n\nmore, " * 200, "x" * 1_000, "a. b. " * 300 + "long words here " * 50):
        assert b"".join(ids_of.pieces(text)) == ids_of.encode(text)
    assert len(list(ids_of.pieces("some words and more " * 200))) > 10


@pytest.mark.parametrize("values", [[], [0], [0] * 2_000, [5, 5, 9], [2**64 - 1], [0, 2**63], list(range(3_000)), sorted(np.random.default_rng(1).integers(0, 1 << 40, 5_000).tolist()),
                                    [0] * 1_500 + [10**9] * 1_500])
def test_sequences(values):
    coded = tokenfile.EliasFano.from_bytes(tokenfile.EliasFano.of(np.array(values, dtype=np.uint64)).to_bytes())
    assert len(coded) == len(values) and coded.slice(0, len(values)).tolist() == values
    for i in range(0, len(values), 97):
        assert coded[i] == values[i] and coded.slice(i, min(i + 700, len(values))).tolist() == values[i:i + 700]
        assert coded.first_at_least(values[i]) == values.index(values[i])
    with pytest.raises(IndexError):
        coded[len(values)]


def test_boundaries_take_little_space():
    bounds = np.cumsum(np.random.default_rng(2).integers(1, 2_000, 100_000)).astype(np.uint64)
    assert len(tokenfile.EliasFano.of(bounds).to_bytes()) * 8 / bounds.size < 2.2 + np.log2(1_000)


def test_edge_rows(spark, tmp_path):
    rows = [(None, "a"), (None, None), (-(2**63), "low"), (2**63 - 1, "high"), (4, "x y"), (4, "z"), (4, "x y"), (5, None), (6, "")] + [(7, "same")] * 300
    df = spark.createDataFrame([(i, t, 1, "q") for i, t in rows], "doc_id long, text string, start int, _id string").repartition(4)
    got = tokenfile.report(df, VOCABULARY, str(tmp_path / "a"), file_bytes=50).collect()
    want = {(i, n, c): 0 for i, _, n, c in plain(rows)}
    assert sorted((r.doc_id is not None, r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == sorted((i is not None, i, n, c) for i, _, n, c in plain(rows))
    assert {(r.doc_id, r.n_tokens, r.ids_crc32) for r in got} == set(want)
    by_start = sorted(got, key=lambda r: r.start)
    assert [r.start for r in by_start] == np.cumsum([0] + [r.n_tokens for r in by_start])[:-1].tolist()
    assert [r.doc_id for r in by_start] == [None, None] + sorted(i for i, _ in rows if i is not None)
    assert tokenfile.report(df.limit(0), VOCABULARY, str(tmp_path / "b")).count() == 0
    with pytest.raises(ValueError):
        (tmp_path / "bad").write_bytes(b"x" * 200)
        tokenfile.IdFile(str(tmp_path / "bad"))


def test_a_task_that_runs_again_writes_the_same_file(tmp_path):
    ids_of = tokenfile.text_ids(VOCABULARY)
    rows = [(1, "one two"), (3, "three")]
    for _ in range(2):
        assert tokenfile.write_file(str(tmp_path / "f"), rows, ids_of)["ids"] == sum(r[2] for r in plain(rows))
    assert os.listdir(tmp_path) == ["f"] and tokenfile.write_file(str(tmp_path / "g"), [], ids_of) is None
