import numpy as np
import pytest
import sentencepiece

from daybook.llm import pieces
from daybook.llm.common import tokenizer_path

PATH = tokenizer_path("piece_bpe_32k.model")
TEXTS = ["", " ", "a", "Hello world", "  two  spaces   and\ttabs\n\nlines ", "Éèaux straße ñ", "日本語テキスト", "emoji 👩‍👩‍👧 x", "▁ literal ▁▁mark", "\x00\x01 control",
         "word " * 300, "x" * 5_000, "á combining ﷽", "123 4567.89 %%% $$$"]


@pytest.fixture(scope="module")
def own():
    return pieces.lattice(PATH)


def keys(n, seed=0):
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64)


def all_segmentations(own, data):
    """Every segmentation of a word with its probability, by trying all pieces at all places."""
    vocabulary = {}
    for i, piece in enumerate(own.bytes_of):
        if piece and not (3 <= i < 259):
            vocabulary[piece] = i

    def walk(at):
        if at == len(data):
            yield (), 0.0
            return
        size = len(data[at:].decode("utf-8")[0].encode())
        steps = [(end, (vocabulary[data[at:end]],)) for end in range(at + 1, len(data) + 1) if data[at:end] in vocabulary]
        if data[at:at + size] not in vocabulary:
            steps.append((at + size, tuple(int(own.byte_id[b]) for b in data[at:at + size])))
        for end, ids in steps:
            for rest, score in walk(end):
                yield ids + rest, score + sum(own.scores[i] for i in ids)

    found = {ids: np.exp(score) for ids, score in walk(0)}
    total = sum(found.values())
    return {ids: p / total for ids, p in found.items()}, np.log(total)


@pytest.mark.parametrize("text", ["the", "token", "é", "aé漢", "䷿!", " "])
def test_draws_follow_the_probabilities_of_all_segmentations(own, text):
    word = (" " + text).encode()
    want, total = all_segmentations(own, word)
    totals = own.filtered(np.frombuffer(word, dtype=np.uint8), np.array([len(word)]))[3]
    assert np.isclose(totals[-1], total)
    n = 20_000
    draws = own.sample([text.encode()] * n, keys(n))
    amounts = {}
    for d in draws:
        amounts[tuple(d.tolist())] = amounts.get(tuple(d.tolist()), 0) + 1
    assert set(amounts) <= set(want)
    for ids, p in want.items():
        assert abs(amounts.get(ids, 0) / n - p) < 5 * np.sqrt(p * (1 - p) / n) + 1e-4


def test_round_trip_and_pieces_of_the_model(own):
    data = [t.encode() for t in TEXTS]
    for ids, text in zip(own.sample(data, keys(len(data))), data, strict=True):
        assert own.decode(ids.tolist()) == text
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for ids in own.sample([b"plain words without odd marks"] * 20, keys(20)):
        assert model.decode(ids.tolist()) == "plain words without odd marks"


def test_key_alone_decides(own):
    data, k = [t.encode() for t in TEXTS], keys(len(TEXTS))
    together = own.sample(data, k)
    for text, key, ids in zip(data, k, together, strict=True):
        assert own.sample([text], np.array([key]))[0].tolist() == ids.tolist()
    other = own.sample(data, keys(len(data), 1))
    assert any(a.tolist() != b.tolist() for a, b in zip(together, other, strict=True))


def test_sharper_sampling_takes_fewer_pieces(own):
    text = [b"some ordinary words of a sentence " * 20]
    assert pieces.lattice(PATH, 4.0).sample(text, keys(1))[0].size <= own.sample(text, keys(1))[0].size


def test_documents_round_trip(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = {r.doc_id: r.text for r in df.collect()}
    ids = pieces.encoded(df, PATH)
    got = pieces.decoded(ids, PATH).collect()
    assert len(got) == len(want) and all(want[r.doc_id] == r.text for r in got)
    first = {r.doc_id: r.ids for r in ids.collect()}
    again = {r.doc_id: r.ids for r in pieces.encoded(df.repartition(7), PATH).collect()}
    assert first == again
    digest = pieces.encoded(df, PATH, digest=True).collect()
    assert all(r.lossless and r.n_pieces == len(first[r.doc_id]) for r in digest)


def test_edge_rows(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(100, None, "x"), (None, "no id", "x"), (3, "Hello world", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    ids = pieces.encoded(df, PATH)
    got = sorted(((r.doc_id, r.text) for r in pieces.decoded(ids, PATH).collect()), key=repr)
    assert got == sorted([r[:2] for r in rows], key=repr)
    assert len({tuple(r.ids) for r in ids.collect() if r.doc_id == 3}) == 1
    assert pieces.encoded(df.limit(0), PATH).count() == 0 and pieces.encoded(df.limit(0), PATH, digest=True).count() == 0
    null = next(r for r in pieces.encoded(df, PATH, digest=True).collect() if r.doc_id == 100)
    assert null.n_pieces is None and null.lossless is None
