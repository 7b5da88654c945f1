import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from gigframe.llm import pivot_spelling as ps

SF = "/root/testdata/sf0.01"
LOW = {c: c + 32 for c in range(65, 91)}


def count_words(rows, every=97, least_len=5, least=3):
    n = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = run.translate(LOW)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % every == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1:]
            n[w] += 1
    return {w: k for w, k in n.items() if len(w) >= least_len and k >= least}


def near_map(words):
    """word -> words at one edit, through all words with a letter left out or masked."""
    by = defaultdict(set)
    for w in words:
        by[w, "w"].add(w)
        for k in range(len(w)):
            by[w[:k] + w[k + 1:], "w"].add(w)
            by[w[:k] + "\0" + w[k + 1:], "m"].add(w)
    near = defaultdict(set)
    for (key, kind), group in by.items():
        for a in group:
            for b in group:
                if a != b and (kind == "m" or (key in (a, b) and abs(len(a) - len(b)) == 1)):
                    near[a].add(b)
    return near


def brute(rows, **kw):
    n = count_words(rows, **kw)
    near, form = near_map(n), {}
    for w in n:
        if near[w]:
            best = min(near[w], key=lambda x: (-n[x], x))
            if n[best] >= 2 * n[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), n[w], len(near[w]),
                   n[form[w]] if w in form else None) for w in n)


def got(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near",
                                              "form_n").collect())


def test_whole_table_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert got(ps.spelling_groups(spark, docs)) == brute(rows)


def variants(rng, n_base, each):
    """Texts with misspellings, chains of them, repeated letters and letters beyond ASCII."""
    letters = "abcdeéÿà"
    out = []
    for _ in range(n_base):
        w = "".join(rng.choice(letters[:rng.choice([2, 4, 8])]) for _ in range(rng.randint(4, 9)))
        for k in range(each):
            v = list(w)
            for _ in range(rng.randint(0, 2)):
                at = rng.randrange(len(v) + 1)
                kind = rng.randrange(3)
                if kind == 0:
                    v.insert(at, rng.choice(letters))
                elif at < len(v):
                    v[at:at + 1] = [] if kind == 1 else [rng.choice(letters)]
            out += ["".join(v)] * rng.choice([3, 4, 7, 20])
    return out


@pytest.mark.parametrize("hot,parts,kept", [(1 << 18, 64, 1 << 19), (3, 5, 20), (1, 64, 1)])
def test_variants_and_divided_groups(spark, monkeypatch, hot, parts, kept):
    monkeypatch.setattr(ps, "HOT", hot)
    monkeypatch.setattr(ps, "PARTS", parts)
    monkeypatch.setattr(ps, "KEPT_WORDS", kept)
    monkeypatch.setattr(ps, "LETTERS", 64 if kept < 99 else 1 << 20)
    rng = random.Random(hot)
    words = variants(rng, 40, 8) + ["aaaaa", "aaaaaa", "aaaaaaa"] * 3 + ["a" * 300, "a" * 299] * 3
    rng.shuffle(words)
    rows = [(k, rng.choice([" ", ", ", "-1"]).join(words[k::50])) for k in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(ps.spelling_groups(spark, df)) == brute(rows)


def test_chain_of_forms_and_ties(spark):
    text = ("chainaa " * 100 + "chainab " * 40 + "chainbb " * 16 + "chaibbb " * 7 + "chabbbb " * 3
            + "sister " * 4 + "mister " * 9 + "sinter " * 9)
    rows = [(1, text)]
    out = {r.word: r for r in ps.spelling_groups(
        spark, spark.createDataFrame(rows, "doc_id long, text string"), every=10**6).collect()}
    assert out["chabbbb"].root == "chainaa" and out["chabbbb"].form == "chaibbb"
    assert (out["sister"].form, out["sister"].n_near, out["sister"].form_n) == ("mister", 2, 9)
    assert out["mister"].form is None and out["mister"].root == "mister"


def test_one_pivot_always_survives():
    """Of two near words, one has a pivot in the other's prefix within the position limits."""
    rng = random.Random(8)
    words = sorted({w for w in variants(rng, 60, 8) if len(w) >= 5})
    counts = np.zeros(1 << 16, np.int64)
    for w in words:
        x = w.encode("latin-1")
        for a, b in zip(x, x[1:], strict=False):
            counts[a << 8 | b] += 1
    parts = {w: ps.prefix_and_pivots(w.encode("latin-1"), counts) for w in words}
    met = 0
    for a, others in near_map(words).items():
        for b in others:
            def probes(r, s):
                return any((p + shift, g) in parts[s][0] for p, g in parts[r][1]
                           for more, shift in ps.SHIFTS if len(r) + more == len(s))
            assert probes(a, b) or probes(b, a)
            met += 1
    assert met > 250
    assert all(abs(p[0][0] - p[1][0]) >= 2 for _, p in parts.values())


def test_runs_of_odd_texts_match(spark):
    texts = ["", None, "É" * 5 + "a", "aéb" * 40, "x" * 5000, "naïve naïveté × ÷ÿÿÿÿÿ", "ab1cdefg_hijkl",
             "Ā aaaaaĀbbbbb", "ABCDEF abcdef AbCdEf", "日本語abcdeÀÿ", "word" * 12 + " " + "z" * 49]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, "null ids count"), (5, texts[5])]
    df = spark.createDataFrame([(d, t, 1, "w") for d, t in rows],
                               "doc_id long, text string, n long, word string")
    for every in (97, 2, 1):
        out = {r.word: r.n for r in ps.word_counts(df, every, 5, 1).collect()}
        assert out == count_words(rows, every, 5, 1)
    assert ps.spelling_groups(spark, df.limit(0)).count() == 0
