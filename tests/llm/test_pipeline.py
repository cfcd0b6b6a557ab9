import pytest

import corpus_pipeline
from daybook.llm import minhash, quality, rules
from tests.llm.test_minhash import brute as brute_groups
from tests.llm.test_packing import check_layout, expected_pieces
from tests.llm.test_rules import brute as brute_rules


@pytest.fixture(scope="module")
def stages(spark):
    folder = "/root/testdata/sf0.001"
    docs, results = spark.read.parquet(f"{folder}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        before = docs
        docs = minhash.settle(stage(spark, before, folder))
        results.append((before, docs))
    return results


def test_every_stage_equals_brute_force(spark, stages):
    (docs, good), (_, passing), (_, unique), (_, packed) = stages
    assert all(after.columns == docs.columns for _, after in stages[:3])
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    assert sorted(good.collect()) == sorted(
        docs.join(quality.scored(docs, labels).filter("predicted = 1").select("doc_id"), "doc_id").select(docs.columns).collect())
    assert sorted(passing.collect()) == sorted(r for r in good.collect() if brute_rules(r.text)[-1])
    kept = {d for d, _, _, k in brute_groups([(r.doc_id, r.text) for r in passing.collect()], 80) if k}
    assert sorted(unique.collect()) == sorted(r for r in passing.collect() if r.doc_id in kept)
    rows = packed.collect()
    want = expected_pieces([(r.doc_id, r.text) for r in unique.collect()], 2048)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr) == want
    assert check_layout(rows, 2048) <= -(-sum(r.length for r in rows) // 2048) + 1


def test_clean_labelled_documents_stay(spark, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.001/labels.parquet").collect()}
    before, after = ({r.doc_id for r in df.collect()} for df in stages[0])
    clean = [d for d in before if labels.get(d) == 1]
    assert sum(d in after for d in clean) >= 0.9 * len(clean) and not any(d in after and labels[d] == 0 for d in labels)


def test_run_gives_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r in stages[-1][1].collect())


def test_empty_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.count() == 0


def test_extra_columns_and_nulls_pass_through(spark):
    text = " ".join(f"plain{i % 37} words{i} and more" for i in range(60)) + "."
    rows = [(1, text, None, "kept", 5), (2, None, "en", None, None), (3, "", "en", "kept", 1), (None, text + " x", "en", "kept", 2), (1, text, None, "kept", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, kept string, score int")
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.columns == ["doc_id", "text", "lang", "kept", "score"]
    assert rules.RULES and all(r.text for r in docs.collect())
