import random

import pytest

from gigframe.llm import edit_decontam as ed
from gigframe.llm import queries


def nearest(p, t):
    """Fewest edits between p and any substring of t."""
    prev = [0] * (len(t) + 1)
    for i, c in enumerate(p, 1):
        cur = [i]
        for j, d in enumerate(t, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (c != d)))
        prev = cur
    return min(prev)


def test_bit_parallel_distance_equals_table():
    rng = random.Random(3)
    for _ in range(300):
        p = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 80)))
        t = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 120)))
        got = ed.Pattern(p).best(t, len(p))
        assert got[0] == nearest(p, t)


@pytest.mark.parametrize("rate", [0.0, 0.05, 0.15])
def test_no_match_within_budget_is_missed(rate):
    rng = random.Random(int(rate * 100))
    words = [f"w{k}x" for k in range(50)]
    items = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(4, 25)))) for k in range(25)]
    search = ed.ItemSearch(items, rate)
    for _ in range(120):
        doc = " ".join(rng.choice(words) for _ in range(30))
        _, item = rng.choice(items)
        hurt = list(item)
        for _ in range(rng.randint(0, 1 + int(rate * len(item)))):
            k = rng.randrange(len(hurt))
            hurt[k:k + rng.randint(0, 1)] = rng.choice(["", "q", "zz"[:1]])
        at = rng.randrange(len(doc))
        doc = ed.normal(doc[:at] + " " + "".join(hurt) + " " + doc[at:])
        want = {i: d for i, t in items if (d := nearest(t, doc)) <= int(rate * len(t))}
        assert {i: d for i, d, _, _ in search.find(doc)} == want


def test_spark_edges(spark, monkeypatch):
    item = "The Quick brown\n fox jumps over the lazy dog again"
    docs = spark.createDataFrame(
        [(1, "x " + item.lower() + " y", "a"), (2, None, "b"), (3, "", "c"), (None, item, "d"),
         (1, "x " + item.lower() + " y", "a"), (5, "the quick brown fxo jumps over the lazy dog", "e")],
        "doc_id long, text string, item_id string")
    items = spark.createDataFrame([(7, item), (8, None), (9, " "), (None, "x"), (7, item)],
                                  "item_id long, text string")
    for size in (ed.BLOCK_CHARS, 10):  # one block or many
        monkeypatch.setattr(ed, "item_blocks", lambda i, n=size, f=ed.item_blocks.__wrapped__
                            if hasattr(ed.item_blocks, "__wrapped__") else ed.item_blocks: f(i, n))
        got = sorted((tuple(r)[:3] for r in ed.matches(docs, items).collect()), key=repr)
        assert got == [(1, 7, 0), (1, 7, 0), (None, 7, 0)]
        assert sorted(r.doc_id for r in ed.without_leaks(docs, items).collect()) == [2, 3, 5]
        monkeypatch.undo()
    assert ed.matches(docs.limit(0), items).count() == 0
    assert ed.matches(docs, items.limit(0)).count() == 0


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, ed.normal(r.text)) for r in
            spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, ed.normal(r.text)) for r in
             spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id): r.distance for r in
           queries.QUERIES["op8_edit_decontam"](spark, sf).collect()}
    assert {k for k, d in got.items() if d == 0} == {
        (d, i) for d, t in docs for i, x in items if x in t}
    assert all(d <= 0.05 * 400 for d in got.values()) and got
