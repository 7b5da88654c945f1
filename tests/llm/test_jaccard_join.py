import random
import re

import numpy as np
import pytest

from gigframe.llm import jaccard_join as jj
from gigframe.llm.signature_tree import bitmap, possible_pairs, spanning_pairs

SF = "/root/testdata/sf0.01"


def shingles(text, n):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n \
        else frozenset([tuple(w)])


def brute(rows, n, num, den):
    """doc_id -> (n_shingles, component) by comparing all pairs."""
    sets = [(d, shingles(t, n)) for d, t in rows]
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    where = {}
    for k, (_, s) in enumerate(sets):
        for g in s:
            where.setdefault(g, []).append(k)
    near = {(a, b) for v in where.values() for x, a in enumerate(v) for b in v[x + 1:]}
    for a, b in near:
        (da, x), (db, y) = sets[a], sets[b]
        if den * len(x & y) >= num * len(x | y):
            p, q = sorted((find(da), find(db)))
            root[q] = p
    return sorted((d, len(s), find(d)) for d, s in sets)


def got(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect())


@pytest.mark.parametrize("n,num,den", [(3, 90, 100), (5, 4, 5)])
def test_whole_table_matches_brute_force(spark, n, num, den):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert got(jj.jaccard_components(spark, docs, n, num, den)) == brute(rows, n, num, den)


def near_copies(rng, n_base, copies, edits):
    words = [f"w{k}" for k in range(400)]
    out = []
    for _ in range(n_base):
        base = [rng.choice(words) for _ in range(rng.randint(30, 90))]
        for _ in range(copies):
            t = list(base)
            for _ in range(rng.randint(0, edits)):
                t[rng.randrange(len(t))] = rng.choice(words)
            out.append(" ".join(t))
    return out


@pytest.mark.parametrize("chunk,n,num,den", [(4, 3, 4, 5), (1024, 3, 90, 100)])
def test_families_at_the_threshold_and_cut_blocks(spark, monkeypatch, chunk, n, num, den):
    monkeypatch.setattr(jj, "CHUNK", chunk)
    rng = random.Random(chunk)
    texts = near_copies(rng, 6, 14, 4) + ["", None, "one", "One", "two words", "x y z"] * 2
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(jj.jaccard_components(spark, df, n, num, den)) == brute(rows, n, num, den)


def test_null_ids_repeated_rows_extra_columns_and_empty_table(spark):
    text = " ".join(f"t{k}" for k in range(40))
    rows = [(7, text, 1, "x"), (7, text, 1, "x"), (None, text, 2, "y"), (3, text + " z", 3, "z"),
            (9, None, 4, "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, cls long, token string")
    out = [tuple(r) for r in jj.jaccard_components(spark, df, 3, 90, 100).collect()]
    assert sorted(out, key=repr) == sorted(
        [(7, 38, 3), (7, 38, 3), (None, 38, None), (3, 39, 3), (9, 0, 9)], key=repr)
    assert sorted(r.doc_id for r in jj.keep_one(spark, df, 3, 90, 100).collect()
                  if r.doc_id is not None) == [3, 9]
    assert jj.jaccard_components(spark, df.limit(0)).count() == 0


def test_trees_never_drop_a_pair_that_links():
    rng = np.random.default_rng(5)
    sets = []
    for _ in range(30):
        base = rng.integers(0, 2**63, rng.integers(5, 600), dtype=np.uint64)
        for _ in range(6):
            s = base.copy()
            s[:rng.integers(0, max(1, len(s) // 5))] = 1
            sets.append(np.unique(s))
    sizes = np.array([len(s) for s in sets])
    maps = [bitmap(s) for s in sets]
    i, j = possible_pairs(sizes, maps, 4, 5)
    left = {(min(a, b), max(a, b)) for a, b in zip(i.tolist(), j.tolist())}
    assert len(left) == len(i)
    for a in range(len(sets)):
        for b in range(a + 1, len(sets)):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 5 * both >= 4 * (sizes[a] + sizes[b] - both):
                assert (a, b) in left
    assert len(left) < len(sets) * 12  # and most others go
    si, sj = spanning_pairs(len(sets), i, j)
    assert len(si) < len(sets) and {(min(a, b), max(a, b)) for a, b in zip(si, sj)} <= left
    side = np.arange(len(sets)) % 2 == 0
    i, j = possible_pairs(sizes, maps, 4, 5, side)
    assert {(min(a, b), max(a, b)) for a, b in zip(i.tolist(), j.tolist())} == {
        p for p in left if side[p[0]] != side[p[1]]}


def brute_links(rows, n, num, den):
    """doc_id -> number of other documents that link with it, by comparing all pairs."""
    sets = [(d, shingles(t, n)) for d, t in rows]
    return sorted((d, sum(1 for e, y in sets if e != d and x and y
                          and den * len(x & y) >= num * len(x | y))) for d, x in sets)


@pytest.mark.parametrize("chunk,edits,n,num,den", [(4, 4, 3, 4, 5), (512, 1, 3, 90, 100)])
def test_every_link_is_counted(spark, monkeypatch, chunk, edits, n, num, den):
    monkeypatch.setattr(jj, "CHUNK", chunk)
    monkeypatch.setattr(jj, "LINK_CHUNK", chunk)
    monkeypatch.setattr(jj, "TABLE_CELLS", 100 * chunk)
    rng = random.Random(chunk)
    texts = near_copies(rng, 6, 14, edits) + ["", None, "one", "One", "two words", "x y z"] * 2
    texts += texts[:20] + texts[:3]  # copies
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = jj.jaccard_links(spark, df, n, num, den).collect()
    want = brute_links(rows, n, num, den)
    assert sum(c for _, c in want) > 2 * len(rows)  # more than any forest has, from both ends
    assert sorted((r.doc_id, r.n_links) for r in out) == want
    assert sorted(tuple(r)[:3] for r in out) == brute(rows, n, num, den)


def test_links_of_odd_rows(spark):
    text = " ".join(f"t{k}" for k in range(40))
    rows = [(7, text), (7, text), (None, text), (3, text + " z"), (3, "something else here"),
            (9, None), (4, text + " z")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = [tuple(r) for r in jj.jaccard_links(spark, df, 3, 90, 100).collect()]
    assert sorted(out, key=repr) == sorted(
        [(7, 38, 3, 2), (7, 38, 3, 2), (None, 38, None, None), (3, 39, 3, 2), (3, 1, 3, 0),
         (9, 0, 9, 0), (4, 39, 3, 2)], key=repr)
    assert jj.jaccard_links(spark, df.limit(0)).count() == 0
