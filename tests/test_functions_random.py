"""Randomised inputs: the Spark parsers agree with a plain statement of each rule.

All cases go through Spark in one DataFrame (one job per rule).
"""

import random
import re

from pyspark.sql import functions as F

from gigframe.functions import (counter_review_count, parse_review_count, parse_review_pct,
                                parse_subgenre)

ALPHABET = list("ab Z(),/;%0123456789") + ["\t", "No Reviews", " (", "%)"]


def _cases(n=400, seed=11):
    rnd = random.Random(seed)
    out = [None, "", "No Reviews"]
    for _ in range(n):
        out.append("".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 12))))
    return out


def _spark_eval(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def _first(pattern, s):
    m = re.match(pattern, s) if s is not None else None
    return m.group(1) if m else None


def py_subgenre(s):
    head = _first(r"([^(]+)", s)
    part = _first(r"([^/,]+)", head)
    return part.strip() if part is not None else None


def py_review_count(s):
    if s is None or s == "No Reviews":
        return 0
    d = _first(r"(\d+)", s)
    return int(d) if d is not None else None


def py_review_pct(s):
    if s is None or s == "No Reviews":
        return None
    m = re.search(r"\((\d+)%\)", s)
    return int(m.group(1)) if m else None


def py_counter(s):
    if not s or s == "No Reviews":
        return None
    head = s.split("(")[0].strip()
    return int(head) if re.fullmatch(r"[+-]?\d+", head) else None


def test_parsers_agree_with_rules(spark):
    cases = _cases()
    for fn, ref in [(parse_subgenre, py_subgenre), (parse_review_count, py_review_count),
                    (parse_review_pct, py_review_pct), (counter_review_count, py_counter)]:
        got = _spark_eval(spark, fn, cases)
        want = [ref(c) for c in cases]
        bad = [(c, g, w) for c, g, w in zip(cases, got, want) if g != w]
        assert not bad, (fn.__name__, bad[:5])
