import re
from collections import Counter

import numpy as np

from gigframe.llm import queries
from gigframe.llm import weak_quality as wq


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(zip(w, w[1:], w[2:], strict=False))
    inside = {i + k for i, g in enumerate(zip(w, w[1:], w[2:], strict=False)) if grams[g] > 1
              for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(inside))


def test_base_counts_equal_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.QUERIES["op6_weak_quality"](spark, sf).collect()
    assert len(got) == len(rows)
    for r in got:
        want = brute(rows[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert r.base_failed == failed and not (failed and r.kept)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    judged = [(r.kept, labels[r.doc_id]) for r in got if r.doc_id in labels and not r.base_failed]
    assert np.mean([k == bool(q) for k, q in judged]) > 0.95


def test_odd_texts(spark):
    texts = [None, "", " \t\n", "a\u00a0b\x0bc\u2003d", "x y z x y z", "l\nl\n l\n\n", "É|#" * 3]
    df = spark.createDataFrame([(k, t, 9) for k, t in enumerate(texts)] + [(None, "a", 9)],
                               "doc_id long, text string, n_words int")
    for r in wq.judge(df).collect():
        t = "a" if r.doc_id is None else texts[r.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(t)
        assert r.base_failed and not r.kept
    assert wq.judge(df.limit(0)).count() == 0


def test_em_recovers_rule_accuracies():
    rng = np.random.default_rng(4)
    good = rng.random(20000) < 0.8
    right = [0.95, 0.9, 0.85, 0.9, 0.7]
    votes = np.stack([np.where(rng.random(len(good)) < 0.2, -1,
                               np.where(rng.random(len(good)) < a, good, ~good)) for a in right], 1)
    combos, weight = np.unique(votes, axis=0, return_counts=True)
    model = wq.estimate(combos, weight.astype(float))
    assert abs(model.prior - 0.8) < 0.03
    for r, a in enumerate(right):
        cast = model.table[r, 1, :2]
        assert abs(cast[1] / cast.sum() - a) < 0.04
    assert np.mean((model.posterior(votes) >= 0.5) == good) > 0.95
