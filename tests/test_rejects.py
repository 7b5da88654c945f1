"""Lines that do not fit are set apart; types that drift are reported; interleaved layout."""

import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import rows
from gigframe.session import scratch_path
from gigframe.sources.rejects import TooManyRejects, keep_rejects, read_with_rejects, type_report
from gigframe.sources.schemas import RAW_TABLES
from gigframe.sources.sinks import clustered, interleaved

SONGS = RAW_TABLES["songs"]
HEADER = "setlist_id,song_name,set_name,encore,is_cover,cover_artist_name,is_tape"


def _land(folder, **files):
    path = os.path.join(str(folder), SONGS.filename)
    os.makedirs(path)
    for name, lines in files.items():
        with open(os.path.join(path, f"{name}.csv"), "w") as f:
            f.write("\n".join([HEADER, *lines]) + "\n")
    return str(folder)


def test_one_bad_line_loads_the_rest(spark, tmp_path):
    good = [f"s{k},Song {k},,{k % 3},false,,false" for k in range(1000)]
    bad = ["s1,two,columns", "s2,Song,,not a number,false,,false", "s3,S,,1,maybe,,false",
           "s4,S,,1,true,,false,one,more"]
    landing = _land(tmp_path, a=good[:500], b=[*good[500:], *bad])
    ok, rejects = read_with_rejects(spark, SONGS, landing)
    assert ok.count() == 1000 and ok.select("song_name").distinct().count() == 1000
    assert ok.agg(F.sum("encore")).first()[0] == sum(k % 3 for k in range(1000))
    got = rejects.collect()
    assert sorted(r.line for r in got) == sorted(bad)
    assert {os.path.basename(r.file) for r in got} == {"b.csv"}
    path = scratch_path(spark, "rejects")
    assert keep_rejects(rejects, path, most=4) == 4
    with pytest.raises(TooManyRejects):
        keep_rejects(rejects, scratch_path(spark, "rejects"), most=3)
    assert spark.read.parquet(path).count() == 4


def test_files_without_bad_lines_and_empty_files(spark, tmp_path):
    landing = _land(tmp_path, a=[], b=["s,\"a, quoted\",,0,false,,"])
    ok, rejects = read_with_rejects(spark, SONGS, landing)
    assert rows(ok, "song_name", "is_tape") == [("a, quoted", None)] and rejects.count() == 0
    assert keep_rejects(rejects, scratch_path(spark, "rejects"), most=0) == 0


def test_drift_is_named_with_its_first_value(spark, tmp_path):
    landing = _land(tmp_path, a=["1,x,,0,false,,false", "2,y,,1,true,,", "3,z,,1.5,yes!,,false"])
    got = {r.column_name: r for r in type_report(spark, SONGS, landing).collect()}
    assert (got["encore"].declared, got["encore"].found, got["encore"].n, got["encore"].misfits,
            got["encore"].first_misfit) == ("bigint", "double", 3, 1, "1.5")
    assert (got["is_cover"].found, got["is_cover"].misfits, got["is_cover"].first_misfit) == (
        "string", 1, "yes!")
    assert (got["setlist_id"].found, got["setlist_id"].misfits) == ("bigint", 0)
    assert (got["set_name"].found, got["set_name"].n) == (None, 0)
    assert (got["is_tape"].found, got["is_tape"].n) == ("boolean", 2)


def test_guards_name_every_text_that_parses(spark):
    from gigframe.sources.rejects import BOOLEAN, DATE_HAS, NUMBER_BEGINS
    texts = ["1", " 1", "+1", "-1.5", ".5", "1e9", "0x1p3", "1d", "NaN", "nan", "-Infinity", "inf", "+INF",
             "\t7", "\x7f7", "true", " TRUE ", "t", "Yes", "n", "0", "no\n", "\x01f", "false", "truex", "abc",
             "2019-08-23", "23-08-2019", "+12019-08-23", "-2019-08-23", "2019/08/23", "x-y-z", "", "A"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    v = F.col("v")
    number = v.try_cast("bigint").isNotNull() | v.try_cast("double").isNotNull()
    date = F.coalesce(F.try_to_date(v, "dd-MM-yyyy"), F.try_to_date(v, "yyyy-MM-dd")).isNotNull()
    missed = df.where((number & ~v.rlike(NUMBER_BEGINS)) | (date & ~v.like(DATE_HAS))
                      | (v.try_cast("boolean").isNotNull() & ~v.rlike(BOOLEAN)))
    assert missed.collect() == []
    assert df.where(v.rlike(BOOLEAN)).where(v.try_cast("boolean").isNull()).collect() == []
    # Before, every text was tried for every type.
    assert df.where("v = 'abc'").where(v.rlike(NUMBER_BEGINS) | v.rlike(BOOLEAN)
                                       | v.like(DATE_HAS)).count() == 0


def _row_groups(path, col, value):
    """Row groups whose statistics let a reader that looks for ``value`` skip none of them."""
    read = total = 0
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            chunks = [meta.row_group(g).column(c) for c in range(meta.num_columns)]
            s = next(c.statistics for c in chunks if c.path_in_schema == col)
            total += 1
            read += s is None or not s.has_min_max or s.min <= value <= s.max
    return read, total


def test_either_column_prunes_an_interleaved_table(spark, tmp_path):
    df = spark.range(64_000).selectExpr("concat('c', lpad(id % 40, 2, '0')) as country",
                                        "concat('g', lpad(pmod(xxhash64(id), 50), 2, '0')) as genre", "id")
    one, both = str(tmp_path / "clustered"), str(tmp_path / "interleaved")
    clustered(df, "country", "genre", partitions=64).write.parquet(one)
    interleaved(df, "country", "genre", partitions=64).write.parquet(both)
    plain, total = _row_groups(one, "genre", "g25")
    assert plain > 0.8 * total  # the second column alone skips next to nothing
    for col, value in (("country", "c20"), ("genre", "g25"), ("country", "c00"), ("genre", "g49")):
        read, total = _row_groups(both, col, value)
        assert read <= 0.3 * total, (col, value, read, total)
    assert spark.read.parquet(both).exceptAll(df).count() == 0 and spark.read.parquet(both).count() == 64_000


def test_interleaved_keeps_nulls_repeated_rows_and_splits_a_hot_value(spark):
    df = spark.range(9000).selectExpr("if(id % 3 = 0, null, if(id % 3 = 1, 'hot', cast(id as string))) as a",
                                      "if(id % 5 = 0, null, id % 4) as b", "id % 4000 as rank")
    out = interleaved(df, "a", "b", partitions=12)
    assert out.columns == df.columns and out.exceptAll(df).count() == 0 and out.count() == 9000
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) <= 3 * 9000 / 12
    assert interleaved(df.limit(0), "a", "b").count() == 0


def test_unique_check_counts_values_of_repeated_hashes_only(spark, monkeypatch):
    from gigframe.operators import quality
    a = spark.createDataFrame([("x",), ("x",), ("y",), (None,), ("z",), ("z",), ("z",)], "k string")
    b = spark.createDataFrame([("x",), ("y",)], "k string")
    want = [("a", "k", "not_null", 1), ("a", "k", "unique", 2), ("b", "k", "not_null", 0),
            ("b", "k", "unique", 0)]
    assert rows(quality.quality_report_written({"a": (a, "k", 1), "b": (b, "k", 0)})) == want
    # Hashes that collide do not make their values equal.
    monkeypatch.setattr(quality, "value_hash", lambda c: F.length(c).cast("long"))
    assert rows(quality.quality_report_written({"a": (a, "k", 1), "b": (b, "k", 0)})) == want
