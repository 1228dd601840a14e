import hashlib

import corpus_pipeline
from test_links import classes

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    all_rows = {r.doc_id: r for r in docs.collect()}
    state = docs
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in state.collect()}
        state = stage(spark, state, SF).cache()
        if name != "byte_bpe":
            assert state.columns == docs.columns
        after = {r.doc_id for r in state.collect()}
        assert after <= set(before)
        if name == "ngram_jaccard":
            assert after == {i for i, (_, c) in classes(before.items(), 5, 80).items() if c == i}
        if name == "byte_bpe":
            assert {r.doc_id: r.decoded_sha256 for r in state.collect()} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in before.items()}
    assert len(after) > 0.6 * len(all_rows)


def test_run_on_odd_rows(spark, tmp_path):
    rows = [(0, None, "en", "s", 0), (1, "", None, "s", 0), (2, "12", "en", None, 2), (3, "the cat and the dog", None, "s", 3), (3, "the cat and the dog", None, "s", 3)]
    rows += [(10 + i, f"the house and the garden number {i} of the town", "en", "s", 9) for i in range(30)]
    for name, df in {
        "documents": spark.createDataFrame([(*r, 0.5, "x") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, score double, node string"),
        "labels": spark.createDataFrame([(i, 1, 0) for i in range(20)] + [(None, 1, 1)], "doc_id long, quality int, toxic int"),
        "benchmark": spark.createDataFrame([(0, "nothing that any of these texts has in it at all today or tomorrow")], "item_id long, text string"),
    }.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    got = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert 3 in got and not got & {0, 1, 2}
