"""The pipeline's stages: decisions take effect, columns stay, results agree with the operators by brute force."""

import corpus_pipeline
import __spark_entry__ as registry
from sheafspark.llm import queries


def test_registered_queries():
    names = [f"op{n}_" for n in range(1, 14)]
    assert all(sum(q.startswith(n) for q in registry.queries()) == 1 for n in names)
    assert registry.queries()["pipeline"] is corpus_pipeline.run
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "simhash near-dedup", "mixing", "bpe"]


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(str(tmp_path / str(n)))
        before, docs = docs, spark.read.parquet(str(tmp_path / str(n)))
        old, new = before.collect(), docs.collect()
        if n < 4:
            assert docs.columns == before.columns
            assert set(new) <= set(old)
        texts = [r.text.encode().lower() for r in old]
        if name == "toxicity":
            bad = {r.doc_id for r in queries.op10_toxicity(spark, sf_dir).where("predicted = 1").collect()}
            assert sorted(r.doc_id for r in new) == sorted(r.doc_id for r in old if r.doc_id not in bad)
        if name == "exact dedup":
            top = {}
            for r, t in zip(old, texts, strict=True):
                top[t] = max(top.get(t, -1), r.doc_id)
            assert sorted(r.doc_id for r in new) == sorted(top.values())
        if name == "simhash near-dedup":
            from test_duplicates import slow_components, slow_print

            ids = [r.doc_id for r in old]
            assert sorted(r.doc_id for r in new) == sorted(set(slow_components([slow_print(r.text) for r in old], ids)))
        if name == "mixing":
            size = sum(len(t.split()) for t in texts)
            taken = sum(len(r.text.split()) for r in new)
            assert abs(taken - size) < 0.05 * size
    assert docs.columns == [*before.columns, "ids", "decoded"] and docs.count() == before.count()


def test_run_and_odd_rows(spark, odd_documents, no_documents, tmp_path, sf_dir):
    for n, docs in enumerate((odd_documents, no_documents)):
        folder = str(tmp_path / str(n))
        docs.write.parquet(f"{folder}/documents.parquet")
        spark.read.parquet(f"{sf_dir}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
        result = corpus_pipeline.run(spark, folder)
        rows = result.collect()
        assert result.columns == [*docs.columns, "ids", "decoded"]
        assert all(r in {tuple(x) for x in docs.collect()} for r in [tuple(x)[:-2] for x in rows])
    assert rows == []
