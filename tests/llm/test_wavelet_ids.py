import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
from tokenizers import Tokenizer

from gigframe.llm import pretokens, queries
from gigframe.llm import wavelet_ids as wi

JSON = P.path("byte_bpe_50k.json")


def library():
    return Tokenizer.from_file(JSON)


def test_matrix_access_rank_select():
    rng = np.random.default_rng(3)
    for n, top in ((1, 1), (7, 3), (1000, 40), (5000, 50000)):
        ids = np.minimum(rng.zipf(1.3, n), top).astype(np.uint32)
        wm, docs, lengths = wi.open_shard(wi.pack_shard(ids, [None, 5], np.array([0, n]), 16))
        assert docs == [None, 5] and lengths.tolist() == [0, n]
        assert (wm.decode() == ids).all()
        for i in rng.integers(0, n, 20).tolist():
            t = int(ids[i])
            assert wm.access(i) == t
            assert wm.rank(t, i) == int((ids[:i] == t).sum())
        for t in {int(ids[0]), int(ids[-1]), 0, 65535, 70000}:
            where = np.flatnonzero(ids == t).tolist()
            assert wm.count(t) == len(where)
            if len(where) < 300:
                assert wm.occurrences(t) == where
            lo, hi = n // 4, n // 2
            assert wm.count(t, lo, hi) == int((ids[lo:hi] == t).sum())


def expected(tok, text):
    ids = tok.encode(text or "", add_special_tokens=False).ids + [0]
    return len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())


def checked(rows, got):
    """Documents in ascending order of doc_id, nulls first, with the starts that this gives."""
    tok = library()
    got = sorted((tuple(r) for r in got), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d or 0))
    start = 0
    for _, at, n, _ in got:
        assert at == start
        start += n
    assert sorted(((r[0], *r[2:]) for r in got), key=repr) == sorted(
        ((d, *expected(tok, t)) for d, t in rows), key=repr)


def test_shards_round_trip(spark, tmp_path):
    texts = {k: f"word{k} and more\nlines {k}  double" * (k % 5) for k in range(60)}
    rows = [(k, t) for k, t in texts.items()] + [(None, "no id"), (3, "again"), (100, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    path = str(tmp_path / "shards")
    wi.write_shards(df, path, JSON, end_id=0, shard_ids=50)
    checked(rows, wi.document_checksums(spark, path).collect())
    tok = library()
    token = tok.encode(" and", add_special_tokens=False).ids[0]
    want = sum(tok.encode(t or "", add_special_tokens=False).ids.count(token) for _, t in rows)
    assert wi.occurrences(spark, path, token).count() == want > 0
    empty = str(tmp_path / "empty")
    wi.write_shards(df.limit(0), empty, JSON, end_id=0)
    assert wi.document_checksums(spark, empty).count() == 0


def test_special_tokens_in_texts_are_the_librarys(spark, tmp_path):
    assert library().encode("a <|endoftext|> b", add_special_tokens=False).ids[2] == 50256
    rows = list(enumerate(["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>x",
                           "<|endoftext", "plain text, here", "", "é<|endoftext|>\n\n  z " * 40,
                           "<|endoftext|> at the start", "double  blank <|endoftext|>  "]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    path = str(tmp_path / "shards")
    wi.write_shards(df, path, JSON, end_id=0)
    checked(rows, wi.document_checksums(spark, path).collect())


def test_null_and_repeated_ids_are_spread_over_ranges(spark, tmp_path):
    """A third of the rows without an id and a third with one id, over several parts."""
    rows = [(None if k % 3 == 0 else 7 if k % 3 == 1 else k, f"text number {k} " * (k % 4))
            for k in range(600)] + [(8, "the same")] * 5
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows],
                               "doc_id long, text string, spread string, part int").repartition(6)
    path = str(tmp_path / "shards")
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")  # these few rows would share a task
    try:
        wi.write_shards(df, path, JSON, end_id=0, shard_ids=200)
    finally:
        spark.conf.unset(coalesce)
    checked(rows, wi.document_checksums(spark, path).collect())
    docs = wi.read_documents(spark, path, [], [], lambda ids: ())
    shards = spark.read.schema(wi.SHARDS).parquet(path)
    per_part = [r["count"] for r in shards.groupBy("part").count().collect()]
    assert docs.count() == len(rows) and len(per_part) >= 6


def test_counts_are_read_from_the_file(monkeypatch):
    ids = np.arange(5000, dtype=np.uint32) % 700
    payload = wi.pack_shard(ids, [1], np.array([5000]), 10)
    monkeypatch.setattr(wi.WaveletMatrix, "_counted", None)
    wm = wi.open_shard(payload)[0]
    assert wm.count(699) == 7 and wm.select(699, 6) == 4899 and (wm.decode() == ids).all()


def test_query_over_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    tok, start = library(), 0
    got = {r.doc_id: r for r in queries.QUERIES["op7_wavelet_ids"](spark, sf).collect()}
    assert set(got) == set(docs)
    for k in sorted(docs):
        ids = tok.encode(docs[k], add_special_tokens=False).ids + [0]
        r = got[k]
        assert (r.start, r.n_tokens) == (start, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_units_are_words_and_marks():
    """A word is one unit whatever mark or line follows it, so it is encoded once."""
    units = pretokens.Units(pa.array(["of the end.\nThe end, the end!! An été: été", "", "a  b\u00a0 c"],
                                     pa.large_string()))
    words = [units.texts[int(k)].as_py() for k in units.seq]
    assert "".join(words) == "of the end.\nThe end, the end!! An été: étéa  b\u00a0 c"
    assert words.count(" end") == 3 and words.count(" été") == 2 and words.count(" the") == 2
    assert units.bounds.tolist()[1:3] == [units.bounds[1]] * 2


def test_units_give_the_librarys_ids():
    parts = ["a", "b", " ", "  ", "\n", "\n\n", "é", "ß", "×", "÷", "日", "、", "!!", "--", "1", " the",
             "ing", "'s", " 's", "'", "\t", "\r", "\x0b", "\x1c", "\x1f", "\x85", "\u1680", "\u2003",
             "\u200b", "\u2028", "\u202f", "\u205f", "\u3000", "\ufeff", "🙂", ".", ",", "\xa0", "«", "“",
             "”", "n't", "\x00", "\x7f", "\u0345", "\u01c5", "<|endoftext|>", "x" * 70]
    rng = np.random.default_rng(5)
    enc = wi.LibraryEncoder(JSON)
    enc.ids = pretokens.UnitCache(enc.encode_units, 300)
    for _ in range(12):
        texts = ["".join(rng.choice(parts, rng.integers(0, 20))) for _ in range(200)]
        flat, ends = enc.encode_texts(pa.array(["cut\n", *texts], pa.large_string()).slice(1))
        for k, t in enumerate(texts):
            want = enc.tok.encode(t, add_special_tokens=False).ids
            assert flat[ends[k]:ends[k + 1]].tolist() == want, t
        for known in (enc.ids.young, enc.ids.old):
            assert len(known.units) <= 150
            assert max(map(len, known.units.to_pylist()), default=0) <= pretokens.KEPT_BYTES
            assert len(known.ids) == known.sizes.sum() and len(known.sizes) == len(known.units)
