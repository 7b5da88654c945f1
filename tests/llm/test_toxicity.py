import random

import pytest
from pyspark.sql import functions as F

from gigframe.llm import queries
from gigframe.llm import toxicity as tx


def distance(a, b):
    prev = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        cur = [i]
        for j, d in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (c != d)))
        prev = cur
    return prev[-1]


def test_automaton_equals_edit_distance():
    words, begins = ["scum", "idiot", "moron", "disgusting", "worthless"], ["chll"]
    trie = tx.FuzzyTrie(words, begins)
    rng = random.Random(2)
    cases = words + ["chllano", "chll", "chl", "", "i", "idi0t", "idot", "idiiot", "disgstin",
                     "disgusxxing", "scumm", "morons", "xmoron"]
    for _ in range(4000):
        w = list(rng.choice(words + begins))
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(w) + 1)
            w[k:k + rng.randint(0, 1)] = rng.choice(["", "a", "o", "s", "t"])
        cases.append("".join(w))
    for w in cases:
        exact = w in words or any(w.startswith(b) for b in begins)
        near = any(distance(w, t) <= tx.edits_for(t) for t in words)
        assert trie.match(w) == (1 if exact else 2 if near else 0), w


def test_context_tells_quotation_from_abuse():
    trie = tx.FuzzyTrie(["moron", "idiot"], [])
    assert tx.counts_of("you are a moron and an idjot", trie)[1:] == (1, 1, 0)
    assert tx.counts_of('he read the sign "moron" aloud', trie)[1:] == (0, 0, 1)
    assert tx.counts_of("the word moron, they wrote, is quoted", trie)[1:] == (0, 0, 1)
    assert tx.counts_of("«ein idiot» sagte er", trie)[1:] == (0, 0, 1)
    assert tx.counts_of('one " mark\nmoron on the next line "', trie)[1:] == (1, 0, 0)
    assert tx.counts_of("", trie) == (0, 0, 0, 0)


def test_lexicon_needs_evidence():
    counts = {"bad": (40, 0), "rare": (2, 0), "the": (90, 900), "chlla*": (30, 0),
              "chllano": (4, 0), "bad*": (41, 0)}
    assert tx.choose_lexicon(counts, 100, 900) == (["bad"], ["chlla"])


def test_lexicon_has_the_tail_of_terms(spark):
    counts = {"tail": (140, 0), "the": (9000, 9000)} | {f"w{k}q": (60, 0) for k in range(900)}
    words, begins = tx.choose_lexicon(counts, 15_000, 15_000)
    assert set(words) == set(counts) - {"the"} and begins == []
    # 20 of 2,500 toxic texts hold a term that no clean one holds.
    rows = [(k, f"x{k}x {'snark' if k < 20 else 'vile'} y{k}y and z{k}z", 1) for k in range(2500)]
    rows += [(k, f"x{k}x kind y{k}y and z{k}z", 0) for k in range(2500, 5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = tx.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"), held_out=-1)
    trie = tx.FuzzyTrie(model.words, model.beginnings)
    assert [trie.match(w) for w in ("vile", "snark", "kind")] == [1, 1, 0]


def test_nulls_empty_table_and_no_labels(spark):
    docs = spark.createDataFrame([(1, None, "x"), (None, "you idiot", "y"), (3, "", "z"),
                                  (3, "", "z"), (4, "clean " * 5000, "w")],
                                 "doc_id long, text string, score string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = tx.fit(docs, labels)
    out = tx.score(docs, model)
    assert out.count() == 5 and out.where("score < 0 or score > 1 or score is null").count() == 0
    assert out.where("doc_id is null and held_out").count() == 0
    assert tx.drop_toxic(docs, model, 0.3).columns == docs.columns
    assert tx.score(docs.limit(0), model).count() == 0


@pytest.fixture(scope="module")
def scored(spark):
    sf = "/root/testdata/sf0.1"
    df = queries.QUERIES["op1_toxicity"](spark, sf)
    out = df.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id", "left").cache()
    out.count()
    return out


def test_held_out_accuracy_and_contract(spark, scored):
    assert scored.count() == spark.read.parquet("/root/testdata/sf0.1/documents.parquet").count()
    assert scored.where("held_out <> (crc32(cast(cast(doc_id as string) as binary)) % 4 = 2)"
                        ).count() == 0
    assert scored.where("predicted <> cast(score >= 0.3 as int)").count() == 0
    held = scored.where("held_out and toxic is not null")
    n = {(r.toxic, r.predicted): r["count"] for r in
         held.groupBy("toxic", "predicted").agg(F.count("*").alias("count")).collect()}
    recall = n[1, 1] / (n[1, 1] + n.get((1, 0), 0))
    false = n.get((0, 1), 0) / (n.get((0, 1), 0) + n[0, 0])
    assert recall > 0.85 and false < 0.02
