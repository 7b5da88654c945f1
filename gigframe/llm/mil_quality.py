"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages (64 words each, the last one shorter). Every passage is
encoded from its bytes and words; gated attention weighs the passages

    a_k = softmax_k( w . ( tanh(V h_k) * sigmoid(U h_k) ) )

and the score is a logistic function of the weighted passage sum_k a_k h_k. Only
document labels are needed: the attention learns which passages decide. The network is
small and is trained here with numpy on a bounded sample of labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrowtext import let_go, text_slices, utf8
from .components import written
from .labelled import fold, training_sample
from .wordhash import Words

PASSAGE = 64
#: Labelled documents of each class, and passages in all, that a model is fitted on.
SAMPLE_PER_CLASS = 4_000
SAMPLE_PASSAGES = 150_000
#: Bytes of texts whose passages are made at once; the arrays on the way take many times that.
BAG_BYTES = 1 << 20
BUCKETS = 16
HIDDEN, GATE = 24, 12

# Classes of bytes whose shares of a passage are inputs; the rest are class 0.
_CLASSES = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".", b",",
            b"!", b"?", b"#*$%&", b"|", b"<>{}[]()", b"\"'`", b":;/\\@_=+~^-", bytes(range(128, 256))]
_CLASS = np.zeros(256, np.uint8)
for _k, _chars in enumerate(_CLASSES):
    _CLASS[list(_chars)] = _k + 1
N_CLASS = len(_CLASSES) + 1
N_INPUT = N_CLASS + 7 + BUCKETS


def passages(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Inputs of every passage, and the first passage of each text (and the end).

    A text without words has one passage of zeros.
    """
    data, offs = utf8(texts)
    w = Words(data, offs)
    h = w.hashes(lower=True)
    bounds = w.per_doc()
    n_words = np.diff(bounds)
    n_pass = np.maximum(1, -(-n_words // PASSAGE))
    first = np.concatenate([[0], np.cumsum(n_pass)])
    total = int(first[-1])
    x = np.zeros((total, N_INPUT))
    if not len(h):
        return x, first
    of_word = first[w.doc] + (np.arange(len(h)) - bounds[w.doc]) // PASSAGE
    words = np.bincount(of_word, minlength=total).astype(float)
    size = np.maximum(words, 1)
    lens = w.end - w.start
    byte_class = _CLASS[data[w._word]]
    of_byte = np.repeat(of_word, lens)
    shares = np.bincount(of_byte * N_CLASS + byte_class, minlength=total * N_CLASS)
    shares = shares.reshape(total, N_CLASS)
    n_bytes = shares.sum(1)
    x[:, :N_CLASS] = shares / np.maximum(n_bytes, 1)[:, None]
    k = N_CLASS
    x[:, k] = n_bytes / size / 10
    x[:, k + 1] = words / PASSAGE
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (w.doc[1:] == w.doc[:-1])
    x[:, k + 2] = np.bincount(of_word, weights=again, minlength=total) / size
    pairs = np.unique((of_word.astype(np.uint64) << np.uint64(32)) | (h >> np.uint64(32)))
    distinct = np.bincount((pairs >> np.uint64(32)).astype(np.int64), minlength=total)
    x[:, k + 3] = distinct / size
    upper = np.add.reduceat(byte_class == 2, np.cumsum(lens) - lens)
    x[:, k + 4] = np.bincount(of_word, weights=(upper == lens) & (lens > 1), minlength=total) / size
    x[:, k + 5] = np.bincount(of_word, weights=lens <= 3, minlength=total) / size
    x[:, k + 6] = np.bincount(of_word, weights=lens >= 15, minlength=total) / size
    bucket = (h % np.uint64(BUCKETS)).astype(np.int64)
    x[:, k + 7:] = np.bincount(of_word * BUCKETS + bucket, minlength=total * BUCKETS).reshape(
        total, BUCKETS) / size[:, None]
    return x, first


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    params: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        p, seg = self.params, first[:-1]
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        h = np.tanh(x @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * s) @ p["w"]
        lens = np.diff(first)
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, seg), lens))
        a = e / np.repeat(np.add.reduceat(e, seg), lens)
        z = np.add.reduceat(a[:, None] * h, seg, axis=0)
        y = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -30, 30)))
        return {"x": x, "h": h, "t": t, "s": s, "a": a, "z": z, "y": y}

    def gradient(self, f: dict[str, np.ndarray], first: np.ndarray,
                 label: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss, by hand through the attention."""
        p, lens, n = self.params, np.diff(first), len(label)
        dy = (f["y"] - label) / n
        dz = np.repeat(dy, lens)[:, None] * p["c"]
        da = (dz * f["h"]).sum(1)
        mean_da = np.add.reduceat(f["a"] * da, first[:-1])
        de = f["a"] * (da - np.repeat(mean_da, lens))
        gate = f["t"] * f["s"]
        dgate = de[:, None] * p["w"]
        dt = dgate * f["s"] * (1 - f["t"] ** 2)
        ds = dgate * f["t"] * f["s"] * (1 - f["s"])
        dh = f["a"][:, None] * dz + dt @ p["V"].T + ds @ p["U"].T
        du = dh * (1 - f["h"] ** 2)
        return {"W": f["x"].T @ du, "b": du.sum(0), "V": f["h"].T @ dt, "U": f["h"].T @ ds,
                "w": gate.T @ de, "c": f["z"].T @ dy, "d": np.array(dy.sum())}


def train(x: np.ndarray, first: np.ndarray, label: np.ndarray, epochs: int = 40,
          batch: int = 128, rate: float = 0.01, decay: float = 1e-4, seed: int = 7) -> Model:
    """Fit a model to bags by Adam; the same data give the same model."""
    rng = np.random.default_rng(seed)

    def init(*shape: int) -> np.ndarray:
        return rng.normal(0, 1 / np.sqrt(shape[0]), shape)

    model = Model(x.mean(0), x.std(0) + 1e-3, {
        "W": init(x.shape[1], HIDDEN), "b": np.zeros(HIDDEN), "V": init(HIDDEN, GATE),
        "U": init(HIDDEN, GATE), "w": init(GATE), "c": init(HIDDEN), "d": np.zeros(())})
    m = {k: np.zeros_like(v) for k, v in model.params.items()}
    v = {k: np.zeros_like(q) for k, q in model.params.items()}
    step, lens = 0, np.diff(first)
    for epoch in range(epochs):
        order = rng.permutation(len(label))
        lr = rate * (1 - epoch / epochs) + 1e-4
        for at in range(0, len(order), batch):
            bags = order[at:at + batch]
            rows = np.concatenate([np.arange(first[b], first[b + 1]) for b in bags])
            part = np.concatenate([[0], np.cumsum(lens[bags])])
            f = model.forward(x[rows], part)
            g = model.gradient(f, part, label[bags])
            step += 1
            for k, q in model.params.items():
                d = g[k] + decay * q
                m[k] = 0.9 * m[k] + 0.1 * d
                v[k] = 0.999 * v[k] + 0.001 * d * d
                model.params[k] = q - lr * (m[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    return model


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0,
        per_class: int = SAMPLE_PER_CLASS) -> Model | None:
    """A model from a bounded sample of the labelled rows outside the held-out fold.

    None if there are no labelled texts of both classes.
    """
    sample = written(training_sample(docs, labels, "quality",
                                     fold("doc_id", folds) != held_out, per_class), "quality_train")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for rows, texts in text_slices(batch, "text", BAG_BYTES):
                x, first = passages(texts)
                bags = [x[a:b].astype(np.float32).tobytes()
                        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(1), pa.array(np.diff(first), pa.int64()), pa.array(bags, pa.binary())],
                    names=["label", "n", "bag"])

    # Which bags fit into the bound is settled by their sizes; only those are fetched.
    bags = written(sample.select("text", "label").mapInArrow(encode, "label int, n long, bag binary")
                   .withColumn("order", F.xxhash64("bag")), "quality_bags")
    held, chosen = 0, []
    for r in (bags.groupBy("order").agg(F.min("n").alias("n")).orderBy("order")
              .limit(2 * per_class).collect()):
        if held + r["n"] <= SAMPLE_PASSAGES:
            held += r["n"]
            chosen.append((r["order"],))
    ids = docs.sparkSession.createDataFrame(chosen, "order long")  # at most 2 * per_class
    xs, lens, label = [], [], []
    for r in (bags.join(F.broadcast(ids), "order").groupBy("order", "label")
              .agg(F.first("bag").alias("bag")).orderBy("order", "label").toLocalIterator()):
        x = np.frombuffer(r["bag"], np.float32).reshape(-1, N_INPUT)
        xs.append(x)
        lens.append(len(x))
        label.append(r["label"])
    if len(set(label)) < 2:
        return None
    return train(np.concatenate(xs).astype(float), np.concatenate([[0], np.cumsum(lens)]),
                 np.array(label, float))


def _scores(net: Model | None, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Score and number of passages of each text; 0.5 without a model."""
    x, first = passages(texts)
    y = net.forward(x, first)["y"] if net is not None else np.full(len(texts), 0.5)
    return y, np.diff(first)


def score(docs: DataFrame, model: Model | None, folds: int = 5, held_out: int = 0,
          threshold: float = 0.3) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): held_out, score, predicted, n_passages.

    A null or blank text is a bag of one passage of zeros. Without a model every score
    is 0.5. A null doc_id is not held out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        net = shared.value
        for batch in batches:
            for rows, texts in text_slices(batch, "text", BAG_BYTES):
                y, n = _scores(net, texts)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(y), pa.array(n, pa.int64())],
                    names=["doc_id", "score", "n_passages"])

    kept = docs.select("doc_id", "text")
    scored = kept.mapInArrow(run, T.StructType(
        [kept.schema["doc_id"], T.StructField("score", T.DoubleType()),
         T.StructField("n_passages", T.LongType())]))
    return (scored.withColumn("held_out", F.coalesce(fold("doc_id", folds) == held_out, F.lit(False)))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
            .select("doc_id", "held_out", "score", "predicted", "n_passages"))


def keep_good(docs: DataFrame, model: Model | None, threshold: float) -> DataFrame:
    """The rows of ``docs`` (with ``text``) that score ``threshold`` or more, as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for rows, texts in text_slices(batch, "text", BAG_BYTES):
                yield rows.filter(pa.array(_scores(shared.value, texts)[0] >= threshold))

    return docs.mapInArrow(run, docs.schema)
