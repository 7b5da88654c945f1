"""Mergeable states: errors within bounds, merge order without effect, exact where small."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from gigframe.operators.sketches import (distinct_count, distinct_merged, distinct_state, quantile,
                                         quantile_merged, quantile_state)
from gigframe.plans import rollups


def test_distinct_error_and_merge_order(spark):
    df = spark.range(200_000).selectExpr("id % 12 as month", "pmod(xxhash64(id), 60000) as band")
    parts = [df.where(f"month % 3 = {k}").groupBy("month").agg(distinct_state("band").alias("s"))
             for k in range(3)]
    exact = df.agg(F.count_distinct("band")).first()[0]
    got = set()
    for order in (parts, parts[::-1], [parts[1], parts[0], parts[2], parts[1]]):
        one = order[0]
        for p in order[1:]:
            one = one.unionByName(p)
        got.add(one.agg(distinct_count(distinct_merged("s"))).first()[0])
    assert len(got) == 1 and abs(got.pop() - exact) <= 0.02 * exact


def test_nulls_blanks_and_groups_without_values(spark):
    df = spark.createDataFrame([(1, ""), (1, None), (1, "a"), (1, "a"), (2, None)], "g int, v string")
    states = df.groupBy("g").agg(distinct_state("v").alias("s"))
    assert rows(states.select("g", distinct_count("s"))) == [(1, 2), (2, 0)]
    nums = spark.createDataFrame([(1, 4.0), (1, None), (1, 2.0), (2, None)], "g int, v double")
    q = nums.groupBy("g").agg(quantile_state("v").alias("s"))
    assert rows(q.select("g", quantile("s", 0.5))) == [(1, 2.0), (2, None)]
    assert spark.createDataFrame([], "v string").agg(distinct_count(distinct_state("v"))).first()[0] == 0


def test_median_rank_error_and_merge_order(spark):
    rng = random.Random(5)
    values = [rng.lognormvariate(3, 1) for _ in range(60_000)]
    df = spark.createDataFrame([(k % 7, v) for k, v in enumerate(values)], "part int, v double")
    states = df.groupBy("part").agg(quantile_state("v").alias("s"))
    for by in (F.col("part"), F.col("part").desc(), F.xxhash64("part")):
        merged = states.orderBy(by).coalesce(1).agg(quantile_merged("s").alias("s"))
        for rank in (0.01, 0.25, 0.5, 0.9):
            got = merged.select(quantile("s", rank)).first()[0]
            assert abs(sum(v <= got for v in values) / len(values) - rank) < 0.01


@pytest.mark.parametrize("by", [["event_year"], ["event_month"], []])
def test_states_roll_up_to_the_exact_counts_of_a_small_fact(spark, by):
    fct = spark.range(5000).selectExpr(
        "2000 + id % 5 as event_year", "1 + id % 12 as event_month",
        "if(id % 9 = 0, null, cast(pmod(xxhash64(id), 700) as string)) as ma_band_id",
        "case when id % 4 = 0 then '' when id % 7 = 0 then null else cast(id % 31 as string) end"
        " as country_code", "id as concert_id")
    late = F.col("concert_id") > 3100
    states = [rollups.month_states(fct.where(~late)), rollups.month_states(fct.where(late))]
    got = rollups.distinct_figures(rollups.merge_month_states(*states, by=by))
    want = fct.groupBy(*by).agg(F.count(F.lit(1)).alias("concert_count"),
                                F.count_distinct("ma_band_id").alias("unique_bands"),
                                F.count_distinct("country_code").alias("unique_countries"))
    cols = [*by, "concert_count", "unique_bands", "unique_countries"]
    assert rows(got, *cols) == rows(want, *cols)
