from pyspark.sql import functions as F

from gigframe.llm.labelled import training_sample


def test_only_copies_of_one_label_are_merged(spark):
    line = "a line that is common to very many different texts of the corpus "
    own = [" ".join(f"w{k}x{j}" for j in range(60)) for k in range(30)]
    texts = [(k, line + t) for k, t in enumerate(own)]  # share a line
    texts += [(100 + k, line + own[0]) for k in range(20)]  # copies
    texts += [(200, line + own[0]), (201, None), (202, ""), (203, ""), (204, "one two")]
    labels = [(k, 1 if k < 15 else 0) for k in range(30)] + [(100 + k, 1) for k in range(20)]
    labels += [(200, 0), (201, 1), (202, 1), (203, 0), (204, None), (None, 1)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("label", F.lit("x"))
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = sorted((r.text, r.label) for r in training_sample(docs, table, "toxic", F.lit(True), 1000).collect())
    want = {(line + t, 1 if k < 15 else 0) for k, t in enumerate(own)} | {
        (line + own[0], 0), ("", 1), ("", 0)}
    assert got == sorted(want)
    assert training_sample(docs, table.limit(0), "toxic", F.lit(True), 9).count() == 0
