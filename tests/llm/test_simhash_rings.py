import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from gigframe.llm import simhash_rings as sr

SF = "/root/testdata/sf0.01"


def fingerprint(text, n=3):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(w[i:i + n]) for i in range(len(w) - n + 1)] if len(w) >= n else \
        [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, n=3, most=2):
    """(doc_id, fingerprint, component) from all pairs."""
    rows = [(d, fingerprint(t, n)) for d, t in rows]
    root = {d: d for d, _ in rows if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    own = [(d, f) for d, f in rows if d is not None]
    fps = np.array([f for _, f in own], np.uint64)
    for k, (d, f) in enumerate(own):
        for j in np.flatnonzero(np.bitwise_count(fps[:k] ^ np.uint64(f)) <= most).tolist():
            p, q = sorted((find(d), find(own[j][0])))
            root[q] = p
    return sorted(((d, f"{f:016x}", None if d is None else find(d)) for d, f in rows), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "fingerprint", "component_id").collect()),
                  key=repr)


def test_whole_table_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert got(sr.near_duplicates(spark, docs)) == brute(rows)


def test_fingerprints_of_odd_texts():
    texts = ["", None, "One", "two words", "a  b\n\tc d", "É é É é", "x " * 9000, "a b c a b c a b",
             "tab\tand\x0bvt \x1fnot-blank here", "  nbsp is a word 　"]
    out = sr.slice_fingerprints(pa.array([t or "" for t in texts], pa.large_string()), 3)
    assert out.tolist() == [fingerprint(t) for t in texts]


def test_shingles_in_many_steps(monkeypatch):
    monkeypatch.setattr(sr, "SHINGLES", 7)
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abcdefg") for _ in range(rng.randint(0, 30))) for _ in range(40)]
    out = sr.slice_fingerprints(pa.array(texts, pa.large_string()), 3)
    assert out.tolist() == [fingerprint(t) for t in texts]


@pytest.mark.parametrize("segments,most", [(7, 2), (5, 2), (9, 3), (4, 2), (3, 1)])
def test_every_near_pair_shares_a_chain(segments, most):
    """The chain filter never drops a pair, whatever bits differ."""
    bits = list(range(0, 64, 3))
    chains = sr.chains(bits, segments, most)
    for k in range(most + 1):
        for pick in itertools.combinations(bits, k):
            diff = sum(1 << b for b in pick)
            assert any(not diff & key and all((diff & m).bit_count() <= c for m, c in rest)
                       for key, rest in chains)


@pytest.mark.parametrize("bucket,small", [(2048, 32), (3, 2), (8, 4)])
def test_links_connect_what_links(spark, monkeypatch, bucket, small):
    """A family that shares most bits, so that keys are refined level by level."""
    monkeypatch.setattr(sr, "BUCKET", bucket)
    monkeypatch.setattr(sr, "SMALL", small)
    rng = random.Random(bucket)
    fps = {0, (1 << 64) - 1}
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(25):
            x ^= 1 << rng.randrange(64) if rng.random() < 0.8 else \
                1 << rng.randrange(64) | 1 << rng.randrange(64) | 1 << rng.randrange(64)
            fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(sr._signed(f),) for f in fps], "fp long").repartition(3)
    links = [(r.a % 2**64, r.b % 2**64) for r in sr.fingerprint_links(spark, df).collect()]
    assert all((a ^ b).bit_count() <= 2 and a != b for a, b in links)

    def parts(pairs):
        root = {f: f for f in fps}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x
        for a, b in pairs:
            p, q = sorted((find(a), find(b)))
            root[q] = p
        return {f: find(f) for f in fps}

    every = [(a, b) for a, b in itertools.combinations(fps, 2) if (a ^ b).bit_count() <= 2]
    assert parts(links) == parts(every)


def test_nulls_ties_repeated_rows_clashing_columns_and_empty_table(spark):
    text = " ".join(f"t{k}" for k in range(60))
    rows = [(7, text, 1, "x"), (7, text, 1, "x"), (None, text, 2, "y"), (3, text, 3, "z"),
            (9, None, 4, "q"), (8, "  ", 4, "q"), (5, "another text", 1, ""), (5, None, 1, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp long, component_id string")
    out = {(r.doc_id, r.fingerprint): r.component_id for r in sr.near_duplicates(spark, df).collect()}
    f, zero, other = (f"{fingerprint(t):016x}" for t in (text, None, "another text"))
    assert out == {(7, f): 3, (3, f): 3, (None, f): None, (9, zero): 5, (8, zero): 5, (5, zero): 5,
                   (5, other): 5}
    assert sr.near_duplicates(spark, df.limit(0)).count() == 0
