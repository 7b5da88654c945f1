import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from gigframe.llm import phrase_graph as pg
from gigframe.llm import queries

SF = "/root/testdata/sf0.01"


def pieces(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    for p in re.split(r"[.,;:!?\x0A-\x0D]", low):
        yield re.findall(r"[^\x20\x09]+", p)


def brute(rows, least=10, top=2000):
    f = {}
    for lang, text in rows:
        c = f.setdefault(lang or "und", Counter())
        for w in pieces(text):
            for k in (1, 2, 3):
                c.update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        n = sum(v for p, v in c.items() if len(p) == 1)
        cand = {p: v for p, v in c.items() if len(p) > 1 and v >= least}
        longest = Counter()
        for p, v in cand.items():
            if len(p) == 3:
                for q in (p[:2], p[1:]):
                    longest[q] = max(longest[q], v)
        scored = []
        for p, a in cand.items():
            if 100 * longest[p] >= 50 * a:
                continue
            score, _, left, right = min((10**6 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]])
                                        for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -s))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n",
                                              "score").collect())


def test_query_matches_duckdb(spark):
    rows = got(queries.op13_phrase_graph(spark, SF))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    assert rows == sorted(con.execute(pg.ORACLE).fetchall())


@pytest.mark.parametrize("seed,words,size", [(1, 8, 2), (2, 40, 1 << 21), (3, 3, 5)])
def test_small_graphs_match_brute_force(spark, monkeypatch, seed, words, size):
    monkeypatch.setattr(pg, "GRAPH_WORDS", size)
    monkeypatch.setattr(pg, "GRAPH_BYTES", 400)
    monkeypatch.setattr(pg, "WAITING_BYTES", 900)
    rng = random.Random(seed)
    vocab = ["The", "the", "é", "日本", "x" * 40, "-", "ñandú"] + [f"w{k}" for k in range(words)]
    seps = [" "] * 12 + [". ", ",", "\n", "\t", "  ", "!?", " ; ", "\r\n"]
    rows = []
    for _ in range(120):
        t = "".join(rng.choice(vocab) + rng.choice(seps) for _ in range(rng.randint(0, 60)))
        rows.append((rng.choice(["en", "en", "fr", None]), t))
    rows += [("en", "a fixed phrase of many words here")] * 15 + [(None, None), ("xx", ""), ("de", ".")]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    expect = [r for r in brute(rows, least=4, top=30)]
    assert got(pg.phrases(df, least=4, top=30)) == expect


def test_flow_gives_the_counts_of_shorter_runs():
    rng = np.random.default_rng(4)
    words = rng.integers(0, 6, 500)
    follow = np.zeros(500, np.int8)
    cut = rng.random(500) < 0.3
    cut[-1] = True
    for k in range(500):
        follow[k] = 0 if cut[k] else 1 if cut[k + 1] else 2
    counts = Counter()
    for k in range(500):
        for n in range(follow[k] + 1):
            counts[tuple(words[k:k + n + 1].tolist())] += 1
    none = (1 << 21) - 1
    found = {}
    for code, count in pg.graph(words, follow):
        for c, n in zip(code.tolist(), count.tolist(), strict=True):
            found[tuple(w for w in (c >> 42, c >> 21 & none, c & none) if w != none)] = n
    assert found == counts


def test_large_counts_stay_exact(spark, monkeypatch):
    big = 3_000_000_019
    rows = [("en", "a", 2 * big), ("en", "b", 2 * big + 1), ("en", "a b", big), ("en", None, 5 * big)]
    df = spark.createDataFrame(rows, "lang string, phrase string, f long")
    monkeypatch.setattr(pg, "phrase_counts", lambda docs, least: df)
    out = pg.phrases(df, 10, 5).collect()
    assert [(r.phrase, r.score, r.n) for r in out] == [
        ("a b", 10**6 * big * big // (2 * big * (2 * big + 1)), 5 * big)]


def test_one_long_text_repeated_rows_and_empty_table(spark):
    text = "of the sea " * 60000
    df = spark.createDataFrame([(1, "en", text, 3), (1, "en", text, 3), (None, "en", None, 4)],
                               "doc_id long, lang string, text string, f long")
    assert got(pg.phrases(df)) == brute([("en", text)] * 2)
    assert pg.phrases(df.limit(0)).count() == 0
    assert len(pg.Pieces(pa.array(["", " ", ".,"], pa.large_string())).words) == 0
