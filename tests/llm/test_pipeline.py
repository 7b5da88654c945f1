import corpus_pipeline as cp
from gigframe.llm import edit_decontam as ed
from test_jaccard_join import brute

SF = "/root/testdata/sf0.001"


def test_stages_in_order(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in cp.STAGES] == ["toxicity", "quality", "near_duplicates",
                                         "decontamination", "encode"]
    for name, stage in cp.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = {r.doc_id: r for r in docs.collect()}
        assert set(after) <= set(before)
        if name == "encode":
            assert set(after) == set(before)
            assert all(r.n_tokens == len(r.ids) for r in after.values())
            break
        assert docs.columns == columns and all(before[k] == r for k, r in after.items())
        if name == "near_duplicates":
            want = {d for d, _, c in brute([(k, r.text) for k, r in before.items()], 5, 4, 5) if d == c}
            assert set(after) == want
        if name == "decontamination":
            items = [ed.normal(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            leaked = {k for k, r in before.items() if any(x in ed.normal(r.text) for x in items)}
            assert not leaked & set(after)


def test_stages_on_odd_rows_and_empty_table(spark):
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0),
         (2, "word " * 30000, "en", "s", 5)],
        spark.read.parquet(f"{SF}/documents.parquet").schema)
    for docs in (odd, odd.limit(0)):
        for _, stage in cp.STAGES:
            stage(spark, docs, SF).count()
