"""Shape the driver's TPC-H-like test tables into the six raw tables.

Each adapter is a deterministic projection (plus a join to a small dimension)
of whole driver tables, so the raw tables grow with the scale factor. The
rules mirror FIXTURES.md section 2 and are replayed in SQL by the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# The driver tables the adapters read, with their declared types: reading
# with a schema skips the footer-inference job a bare read runs per table.
DRIVER_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def _read(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    reader = spark.read
    if name in DRIVER_SCHEMAS:
        reader = reader.schema(DRIVER_SCHEMAS[name])
    df = reader.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def _join(left: DataFrame, right: DataFrame, cond: str) -> DataFrame:
    return left.join(right, F.expr(cond))


def raw_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = _read(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_acctbal",
                 "c_mktsegment")
    nation = _read(spark, sf_dir, "nation", "n_nationkey", "n_name")
    # Every tenth band gets a second copy (copy = 1) that must lose the
    # keep-first dedup; both copies come from one pass over the customers.
    rows = _join(cust, nation, "c_nationkey = n_nationkey").selectExpr(
        "*", "explode(if(c_custkey % 10 = 0, array(0, 1), array(0))) as copy")
    return rows.selectExpr(
        "cast(c_custkey as string) as band_id",
        "if(copy = 1, concat(c_name, ' (dup)'), c_name) as band_name",
        "if(copy = 1, 'DUP', n_name) as country",
        """case when copy = 1 then 'Dup Metal'
                when c_custkey % 6 = 0 then concat(c_mktsegment, ' Metal')
                when c_custkey % 6 = 1 then concat(c_mktsegment, ' Death Metal (early); Doom (later)')
                when c_custkey % 6 = 2 then concat(c_mktsegment, ' Black Metal/Doom Metal')
                when c_custkey % 6 = 3 then concat(c_mktsegment, ' Folk Metal, Rock')
                when c_custkey % 6 = 4 then concat(' ', c_mktsegment, ' ')
                when c_custkey % 24 = 5 then ''
                when c_custkey % 24 = 11 then '/Doom'
                else concat(c_mktsegment, ' Metal') end as genre""",
        """case when copy = 1 then 'Unknown'
                when c_acctbal < 0 then 'Split-up' else 'Active' end as status""")


def raw_albums(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
               "l_discount", "l_returnflag", "l_linestatus", "l_shipdate")
    orders = _read(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    part = _read(spark, sf_dir, "part", "p_partkey", "p_name")
    base = _join(_join(li, orders, "l_orderkey = o_orderkey"), part, "l_partkey = p_partkey")
    return base.selectExpr(
        "cast(o_custkey as string) as band_id", "p_name as album_name",
        "case when l_linestatus = 'F' then 'Full-length' else 'EP' end as album_type",
        """case when l_linenumber = 7 then 'N/A'
                else cast(year(l_shipdate) - o_custkey % 25 as string) end as year""",
        """case when l_returnflag = 'N' then 'No Reviews'
                when l_linenumber = 6 then cast(null as string)
                when l_linenumber = 5 then 'pending'
                else concat(cast(cast(l_quantity as bigint) as string), ' (',
                            cast(100 - cast(round(l_discount * 500) as bigint) - l_linenumber
                                 as string), '%)') end as reviews""")


def raw_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = _read(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    nation = _read(spark, sf_dir, "nation", "n_nationkey", "n_name")
    return _join(sup, nation, "s_nationkey = n_nationkey").selectExpr(
        """case when s_suppkey % 20 = 0 then '' when s_suppkey % 20 = 1 then cast(null as string)
                else cast(s_suppkey as string) end as label_id""",
        "cast(s_suppkey as string) as band_id", "s_name as label_name",
        "'Metal' as specialization",
        "case when s_acctbal < 0 then 'closed' else 'active' end as status",
        "n_name as country")


def raw_band_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = _read(spark, sf_dir, "customer", "c_custkey", "c_name")
    # Every fifth customer's mapping points at a band that does not exist.
    return cust.selectExpr(
        "case when c_custkey % 5 = 1 then -c_custkey else c_custkey end as ma_band_id", "c_name as ma_band_name",
        "concat('mbid-', cast(c_custkey as string)) as sfm_mbid", "c_name as sfm_artist_name",
        "case when c_custkey % 7 = 0 then 'fuzzy' else 'exact' end as match_type")


SETLIST_EXPRS = [
    "cast(k as string) as setlist_id",
    "concat('mbid-', cast(artist_key as string)) as artist_mbid",
    "concat('Artist ', cast(artist_key as string)) as artist_name",
    "cast(o_orderdate as date) as event_date",
    "case when k % 50 = 0 then '' else concat('v', cast(k % 97 as string)) end as venue_id",
    "concat('Venue ', cast(k % 7 as string)) as venue_name",
    "concat('City ', cast(k % 11 as string)) as city_name",
    "case when k % 3 = 0 then '' else concat('S', cast(k % 5 as string)) end as state",
    """case when k % 40 = 7 then ''
            else case (k % 25) % 6 when 0 then 'US' when 1 then 'DE' when 2 then 'FI'
                                   when 3 then 'SE' when 4 then 'BR' else 'XX' end
       end as country_code""",
    "n_name as country_name",
    "cast(k % 181 - 90 as double) as latitude",
    "case when k % 13 = 0 then cast(null as double) else cast(k % 361 - 180 as double) end"
    " as longitude",
    "case when k % 2 = 0 then 'Tour' else '' end as tour_name",
]


def raw_setlists(spark: SparkSession, sf_dir: str, with_duplicates: bool = True) -> DataFrame:
    orders = _read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    nation = _read(spark, sf_dir, "nation", "n_nationkey", "n_name")
    base = _join(orders, nation, "o_orderkey % 25 = n_nationkey").selectExpr(
        "o_orderkey as k", "o_orderdate", "n_name",
        """case when o_orderkey % 4 = 0 then o_custkey % 40
                when o_orderkey % 4 = 1 then o_custkey % 150 + 100
                else o_custkey end as artist_key""")
    if not with_duplicates:
        return base.selectExpr(*SETLIST_EXPRS)
    # Every 20th setlist is landed twice: the re-sent copy (copy = 1) is a day
    # later at venue 'vDUP'. Both copies come from one pass over the orders.
    rows = base.selectExpr("*", "explode(if(k % 20 = 0, array(0, 1), array(0))) as copy")
    flat = rows.selectExpr(*SETLIST_EXPRS, "copy")
    return (flat.withColumns({
        "event_date": F.expr("if(copy = 1, date_add(event_date, 1), event_date)"),
        "venue_id": F.expr("if(copy = 1, 'vDUP', venue_id)")}).drop("copy"))


def resent_setlists(flat: DataFrame) -> DataFrame:
    """Re-sent copies of every 20th setlist, a day later at venue 'vDUP'.

    They must lose the keep-first dedup (and the streaming dedup).
    """
    return (flat.where("cast(setlist_id as bigint) % 20 = 0")
                .withColumns({"event_date": F.expr("date_add(event_date, 1)"),
                              "venue_id": F.lit("vDUP")}))


def raw_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_linenumber", "l_tax",
               "l_returnflag", "l_linestatus")
    part = _read(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand")
    return _join(li, part, "l_partkey = p_partkey").selectExpr(
        "cast(l_orderkey as string) as setlist_id",
        "case when l_partkey % 50 = 0 then '' else p_name end as song_name",
        "case when l_linestatus = 'F' then l_returnflag else '' end as set_name",
        "cast(l_linenumber % 3 as bigint) as encore",
        "l_linenumber = 4 as is_cover",
        "case when l_linenumber = 4 then p_brand else '' end as cover_artist_name",
        "case when l_linenumber = 2 then cast(null as boolean) else l_tax > 0.06D end as is_tape")


def artist_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search hits per band: one per order of the customer behind the band.

    rank = the order key (search position); the name is an exact (case
    folded) spelling, a tribute act or a foreign namesake, by order key.
    """
    orders = _read(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    cust = _read(spark, sf_dir, "customer", "c_custkey", "c_name")
    return _join(orders, cust, "o_custkey = c_custkey").selectExpr(
        "cast(c_custkey as string) as band_id", "c_name as band_name",
        "cast(o_orderkey as int) as rank",
        """case o_orderkey % 3 when 0 then upper(c_name) when 1 then concat(c_name, ' Tribute')
                else concat(lower(c_name), ' UK') end as name""",
        """case when o_orderkey % 11 = 0 then ''
                else concat('mbid-c', cast(o_orderkey as string)) end as mbid""")


RAW_BUILDERS = {
    "bands": raw_bands,
    "albums": raw_albums,
    "labels": raw_labels,
    "setlists": raw_setlists,
    "songs": raw_songs,
    "band_mapping": raw_band_mapping,
}


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: build(spark, sf_dir) for name, build in RAW_BUILDERS.items()}
