"""The corpus pipeline, stage by stage, against plain versions of what each stage keeps."""

import corpus_pipeline
from orderflow.llm import language_id
from tests.llm.test_jaccard_join import brute

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    odd = [(10_001, None, "en", "s", 0), (10_002, "", None, None, None), (10_003, "12 34", "en", "s", 5), (None, "the words are here and there", "en", "s", 1)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    columns = docs.columns
    before = {r.doc_id: r for r in docs.collect()}
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "language_id", "near_duplicates", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / name))
        kept = spark.read.parquet(str(tmp_path / name))
        if name == "packing":
            break
        after = {r.doc_id: r for r in kept.collect()}
        assert kept.columns == columns and kept.count() == len(after)
        gone = set(before) - set(after)
        if name == "toxicity":
            marked = [i for i in before if i in labels]
            wrong = [i for i in marked if (i in gone) != (labels[i] == 1)]
            assert len(wrong) <= 0.08 * len(marked) and {10_001, 10_002, 10_003} <= set(after)
        elif name == "language_id":
            assert gone == {10_001, 10_002, 10_003}
            assert all(r.lang and r.lang != language_id.UNKNOWN for r in after.values())
        else:
            classes = {c[1] for c in brute([(i, r.text) for i, r in before.items()])}
            assert set(after) == classes
        before, docs = after, kept
    pieces = kept.collect()
    assert {p.doc_id for p in pieces} == set(before)
    for doc_id in before:
        own = sorted((p.start, p.length) for p in pieces if p.doc_id == doc_id)
        assert sum(n for _, n in own) == next(p.doc_tokens for p in pieces if p.doc_id == doc_id)


def test_corpus_without_languages(spark):
    rows = [(1, "the words are here", None), (2, None, None), (3, "", None), (4, "12 34 _ !", None), (5, "слова", None), (6, "字", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = corpus_pipeline.drop_unknown_language(spark, docs, SF_DIR)
    assert kept.columns == docs.columns and sorted(tuple(r) for r in kept.collect()) == [rows[0], rows[4], rows[5]]
