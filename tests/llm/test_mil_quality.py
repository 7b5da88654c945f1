import tracemalloc
import types

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gigframe.llm import arrowtext, queries
from gigframe.llm import mil_quality as mq


def bags(rng, n):
    lens = rng.integers(1, 6, n)
    first = np.concatenate([[0], np.cumsum(lens)])
    return rng.normal(size=(int(first[-1]), mq.N_INPUT)), first


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(1)
    x, first = bags(rng, 6)
    y = np.array([0, 1, 1, 0, 1, 0.0])
    model = mq.train(x, first, y, epochs=1)
    model.params = {k: np.atleast_1d(v).copy() for k, v in model.params.items()}
    g = model.gradient(model.forward(x, first), first, y)

    def loss():
        p = model.forward(x, first)["y"]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    for k, v in model.params.items():
        flat = v.reshape(-1)
        for i in rng.integers(0, max(flat.size, 1), 3):
            old, eps = float(flat[i]), 1e-6
            flat[i] = old + eps
            up = loss()
            flat[i] = old - eps
            down = loss()
            flat[i] = old
            assert (up - down) / (2 * eps) == pytest.approx(float(np.ravel(g[k])[i]), abs=1e-6)


def test_attention_finds_the_deciding_passage():
    rng = np.random.default_rng(2)
    x, first = bags(rng, 400)
    y = np.zeros(400)
    for b in range(0, 400, 2):  # one marked passage makes a bag bad
        x[rng.integers(first[b], first[b + 1]), 0] = 6
        y[b] = 1
    model = mq.train(x, first, y, epochs=30)
    x2, first2 = bags(np.random.default_rng(3), 100)
    mark = [int(first2[b]) for b in range(0, 100, 2)]
    x2[mark, 0] = 6
    f = model.forward(x2, first2)
    assert np.mean((f["y"] > 0.5) == (np.arange(100) % 2 == 0)) > 0.9
    for b in range(100):
        assert f["a"][first2[b]:first2[b + 1]].sum() == pytest.approx(1)


def test_passages_of_odd_texts():
    texts = pa.array(["", "  ", "one", "w " * 64, "w " * 65, "É" * 1000, None], pa.large_string())
    x, first = mq.passages(texts.fill_null(""))
    assert np.diff(first).tolist() == [1, 1, 1, 1, 2, 1, 1]
    assert np.isfinite(x).all() and not x[0].any()


def test_nulls_and_no_labels(spark):
    docs = spark.createDataFrame([(1, None, 0.5), (None, "text", 0.1), (1, None, 0.5)],
                                 "doc_id long, text string, score double")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = mq.fit(docs, labels)
    assert model is None
    assert [r.score for r in mq.score(docs, model).collect()] == [0.5] * 3
    assert mq.keep_good(docs, model, 0.3).count() == 3
    assert mq.score(docs.limit(0), model).count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    out = (queries.QUERIES["op10_mil_quality"](spark, sf)
           .join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id", "left").cache())
    assert out.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert out.where("held_out <> (crc32(cast(cast(doc_id as string) as binary)) % 5 = 0)").count() == 0
    right = out.where("held_out and quality is not null").agg(
        F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert right > 0.95


class OneTask:
    """Stands for a DataFrame of one batch: runs what mapInArrow is given here and now."""

    schema = sparkSession = sparkContext = property(lambda self: self)

    def __init__(self, batch):
        self.batch = batch

    def broadcast(self, value):
        return types.SimpleNamespace(value=value)

    def mapInArrow(self, run, schema):
        return sum(b.num_rows for b in run(iter([self.batch])))


def test_keep_good_holds_little_and_frees_other_operators_objects():
    texts = ["some words of a text that goes on, and on. " * 50] * 4000
    docs = OneTask(pa.RecordBatch.from_pydict({"text": texts}))
    model = mq.Model(np.zeros(mq.N_INPUT), np.ones(mq.N_INPUT), {
        k: np.zeros(n) for k, n in (("W", (mq.N_INPUT, mq.HIDDEN)), ("b", mq.HIDDEN), ("c", mq.HIDDEN),
                                    ("V", (mq.HIDDEN, mq.GATE)), ("U", (mq.HIDDEN, mq.GATE)),
                                    ("w", mq.GATE), ("d", ()))})
    arrowtext.kept("a vocabulary", lambda: bytearray(1000))
    tracemalloc.start()
    try:
        assert mq.keep_good(docs, model, 0.3) == len(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert not arrowtext._KEPT
    assert peak < 60e6, peak


def test_one_object_is_kept():
    made = []
    for key in "aabba":
        arrowtext.kept(key, lambda key=key: made.append(key))
        assert list(arrowtext._KEPT) == [key]
    assert made == ["a", "b", "a"]
    arrowtext.let_go()
    assert not arrowtext._KEPT
