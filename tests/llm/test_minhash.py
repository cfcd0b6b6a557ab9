import re

import numpy as np
import pytest

from daybook.llm import minhash
from daybook.llm.common import WordHasher

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows, percent=85):
    """Components by comparing all pairs."""
    sets = [shingles(text) for _, text in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                parent[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[top(i)] = min(doc, least.get(top(i), doc))
    return sorted((doc, len(sets[i]), least[top(i)], least[top(i)] == doc) for i, (doc, _) in enumerate(rows))


def found(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect())


def test_word_hashes_equal_for_equal_words_only():
    h = WordHasher(fold=True)
    text = "Ab ab\tBA  b\x0ba é É a b".encode()
    got = h.words(text)
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text.decode()))
    assert len(got) == len(words) and len(set(got.tolist())) == len(set(words))
    long = (b"x" * 50 + b" ") * 30_000 + b"y" * 2_000_000 + b" z"
    got = h.words(long)
    assert got.size == 30_002 and len(set(got.tolist())) == 3


def test_shingle_sets_of_short_and_long_sequences():
    h = WordHasher(fold=False)
    assert minhash.shingle_set(h.words(b"")).size == 0 and minhash.shingle_set(h.words(b" \n")).size == 0
    assert minhash.shingle_set(h.words(b"a b")).size == 1
    assert minhash.shingle_set(h.words(b"a a a a a a a a")).size == 1
    big = minhash.shingle_set(np.arange(10_000, dtype=np.uint64))
    assert big.size == 9_996
    assert (minhash.signature(big) == minhash.signature(big[::-1])).all()


def test_edge_rows(spark):
    base = " ".join(f"w{i}" for i in range(120))
    near = base.replace("w60 ", "other ")
    rows = [(5, base, "x"), (3, near, "x"), (9, base, None), (9, base, None), (1, "", "x"), (2, None, "x"), (7, "Hi there", "x"),
            (4, "hi\tTHERE", "x"), (8, " \n ", "x"), (6, base + " " + " ".join(f"v{i}" for i in range(60)), "x"),
            (10, "word " * 5_000, "x"), (11, "word " * 7, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_shingles string")
    assert found(minhash.near_duplicates(df)) == brute([r[:2] for r in rows])
    assert minhash.near_duplicates(df.limit(0)).count() == 0
    kept = minhash.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 6, 8, 10]


def test_rows_without_id_link_but_never_name_a_component(spark):
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(None, text), (4, text), (None, "alone")], "doc_id long, text string")
    got = {(r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect()}
    assert got == {(None, 4, False), (4, 4, True), (None, None, True)}
    assert minhash.one_of_each(df).count() == 3


def test_rows_of_one_id_are_judged_by_their_own_texts(spark):
    first, second, third = (" ".join(f"{c}{i}" for i in range(60)) for c in "abc")
    rows = [(5, first, "x"), (5, second, "y"), (3, third, "x"), (5, third + " end", "x"), (5, first, "z"), (5, "", "x"), (5, None, "x"), (6, "", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, Text_Key string")
    kept = minhash.one_of_each(df.repartition(4))
    assert kept.columns == df.columns
    got = sorted((r.doc_id, r.text or "") for r in kept.collect())
    assert got == sorted([(5, first), (5, second), (3, third), (5, ""), (6, "")])


def test_letters_of_one_form_do_not_meet(spark):
    form = [f"w{i}" for i in range(178)]
    rows = [(i, minhash.shingle_set(WordHasher(fold=True).words(" ".join([*form, *(f"u{i}x{k}" for k in range(22))]).encode())).view(np.int64).tolist())
            for i in range(40)]  # similarity 0.8: some shared shingles are among the rarest 15 % of a set, none among the rarest 8 %
    full = spark.createDataFrame(rows, "node long, shingles array<long>")
    apart = full.selectExpr("node", "cast(size(shingles) as long) as n", "node as comp")
    assert minhash._meeting(apart, full, 85).count() == 0
    assert minhash._meeting(apart, full, 79).select("a", "b").distinct().count() == 40 * 39 // 2


def test_chain_and_hot_groups_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(150):  # copies with random changes: some linked only through others
        words = list(base)
        for at in rng.integers(0, 200, rng.integers(1, 9)):
            words[at] = f"x{rng.integers(0, 40)}"
        rows.append((i, " ".join(words)))
    drift = list(base)
    for i in range(40):  # a chain whose ends share little
        drift[i * 5] = f"y{i}"
        rows.append((200 + i, " ".join(["chain", *drift])))
    passage = " ".join(f"p{i}" for i in range(30))
    for i in range(120):  # one passage in many otherwise different texts
        rows.append((300 + i, passage + " " + " ".join(f"z{rng.integers(0, 10**6)}" for _ in range(rng.integers(5, 60)))))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for percent in (85, 80):
        assert found(minhash.near_duplicates(df, percent=percent)) == brute(rows, percent)


def test_documents_equal_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert found(minhash.near_duplicates(df)) == brute([tuple(r) for r in df.select("doc_id", "text").collect()])


@pytest.mark.parametrize("percent", [0, 101])
def test_refuses_impossible_thresholds(spark, percent):
    with pytest.raises(ValueError):
        minhash.near_duplicates(spark.createDataFrame([(1, "a")], "doc_id long, text string"), percent=percent)


def test_matches_follow_the_threshold():
    assert [minhash.matches_for(p) for p in (100, 85, 80, 1)] == [64, 38, 33, 1]
