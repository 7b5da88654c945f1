import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from gigframe.llm import byte_bpe as bb
from gigframe.llm import queries

RANKS = P.path("byte_bpe_50k.tiktoken")
PARTS = ["a", "b", " ", "  ", "\n", "é", "日", "!!", "=", "--", "1", "23", " the", "ing", "'s", " 's",
         "\t", "A", "🙂", "𐍈", " ", "<|endoftext|>", "x" * 40]


@pytest.fixture(scope="module")
def ref():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bb.read_ranks(RANKS),
                             special_tokens={})


def texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25))) for _ in range(n)]


def test_encoder_equals_library_and_decodes(ref):
    enc = bb.encoder(RANKS, P.PATTERN)
    for t in texts(3000) + ["a" * 5000, " " * 3000, "ab" * 2000, "\n" * 500 + "x"]:
        ids = enc.encode(t)
        assert ids == ref.encode_ordinary(t)
        assert enc.decode(ids) == t.encode()


def test_columns_with_nulls_clashes_and_units(spark, ref):
    some = texts(400, 2) + [None, "", " ", "a  b", " lead", "trail ", "x \n y", "\n x"]
    df = spark.createDataFrame([(k, t, "old", k) for k, t in enumerate(some)],
                               "doc_id long, text string, ids string, other int").repartition(3)
    out = bb.encode_column(df, RANKS, P.PATTERN)
    got = {r.doc_id: r for r in out.collect()}
    for k, t in enumerate(some):
        want = ref.encode_ordinary(t or "")
        assert (got[k].ids, got[k].n_tokens, got[k].other) == (want, len(want), k)
    back = bb.decode_column(out, RANKS, P.PATTERN)
    assert {r.doc_id: bytes(r.decoded) for r in back.collect()} == {
        k: (t or "").encode() for k, t in enumerate(some)}
    dig = bb.encode_digests(df, RANKS, P.PATTERN)
    for r in dig.collect():
        t = some[r.doc_id] or ""
        ids = " ".join(map(str, ref.encode_ordinary(t)))
        assert r.ids_sha256 == hashlib.sha256(ids.encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
    assert bb.encode_digests(df.limit(0), RANKS, P.PATTERN).count() == 0


def test_query_over_whole_table(spark, ref):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.QUERIES["op9_byte_bpe"](spark, sf).collect()
    assert {r.doc_id for r in got} == set(docs) and len(got) == len(docs)
    for r in got:
        ids = ref.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
