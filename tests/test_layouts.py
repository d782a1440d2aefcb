"""Bucketed joins, bloom filters, and lookups as SQL text."""

import random

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from plumeledger.operators import lookups, ranking
from plumeledger.plans.standins import as_table
from plumeledger.sources import layouts
from plumeledger.sources.catalog import FUNCTIONS, register
from plumeledger.sources.tables import read_table, write_table


@pytest.fixture(scope="module")
def bucketed(spark, tmp_path_factory):
    rng = random.Random(4)
    left = [(rng.choice([1, 1, 1, *range(40)]), i) for i in range(3000)] + [(None, -1)]
    right = [(k, f"owner {k}") for k in range(30)] + [(1, "again"), (None, "nobody")]
    frames = spark.createDataFrame(left, "k int, x int"), spark.createDataFrame(right, "k int, owner string")
    expected = sorted((k, x, o) for k, x in left for j, o in right if k == j and k is not None)
    root = tmp_path_factory.mktemp("buckets")
    made = [layouts.write_bucketed(df, f"test_buckets_{i}", str(root / str(i)), "k", 8) for i, df in enumerate(frames)]
    yield *made, expected
    for i in range(2):
        spark.sql(f"drop table test_buckets_{i}")


def test_bucketed_join_without_a_shuffle(bucketed, rows):
    left, right, expected = bucketed
    joined = layouts.join_bucketed(left, right, "k")
    plan = plan_of(joined)
    assert "SortMergeJoin" in plan and "Exchange" not in plan and plan.count("Bucketed: true") == 2
    assert rows(joined.select("k", "x", "owner"), sort=True) == sorted(expected, key=repr)
    assert "Exchange" not in plan_of(left.groupBy("k").agg(F.count("*")))


def test_hot_keys_leave_their_bucket(bucketed, rows):
    left, right, expected = bucketed
    assert rows(layouts.hot_keys("k", left, right, most=200)) == [(1,)]
    joined = layouts.join_bucketed(left, right, "k", most=200)
    assert "REPARTITION" in plan_of(joined)
    assert rows(joined.select("k", "x", "owner"), sort=True) == sorted(expected, key=repr)


def test_bloom_filters_skip_row_groups(spark, tmp_path, rows):
    # Every file has small and large keys, so that min/max statistics skip nothing.
    df = spark.range(0, 40_000, 1, 4).select((F.col("id") * 7919 % 1_000_003).alias("k"), F.col("id").alias("v"))
    path = str(tmp_path / "t")
    stored = layouts.write_with_blooms(df, path, ["k"], 20_000)
    absent = next(k for k in range(500_000, 500_100) if df.where(F.col("k") == k).isEmpty())
    there = df.where("v = 25000").first()["k"]
    assert layouts.rows_read(spark, stored.where(F.col("k") == absent)) < 40_000 / 2
    assert 0 < layouts.rows_read(spark, stored.where(F.col("k") == there)) < 40_000 / 2
    assert rows(stored.where(F.col("k") == there).select("v")) == [(25_000,)]
    plain = spark.read.schema(df.schema).parquet(path)
    df.write.parquet(str(tmp_path / "plain"))
    plain = spark.read.parquet(str(tmp_path / "plain"))
    assert layouts.rows_read(spark, plain.where(F.col("k") == absent)) == 40_000


def test_lookups_as_sql(spark, tmp_path, rows):
    root = str(tmp_path)
    owners = [(2020, "a", 2.0, 1), (2020, "b", None, 2), (2021, "a", 5.0, 1)]
    write_table(spark.createDataFrame(owners, "year int, owner string, emissions_quantity double, source_count int"), root, "analysis_owner_year")
    top = [("coal", 2020, 1, 7, "seven", None, 1.0, 9.0), ("coal", 2021, 1, 8, "eight", 2.0, 1.0, None), ("steel", 2020, 1, 9, None, None, None, 3.0)]
    kinds = "subsector string, year int, rank int, source_id long, source_name string, lat double, lon double, emissions_quantity double"
    write_table(as_table(spark.createDataFrame(top, kinds), "analysis_top_sources"), root, "analysis_top_sources")
    assert register(spark, root) == ["analysis_top_sources", "analysis_owner_year", "top_owners_of", "top_of"]
    stored = read_table(spark, root, "analysis_owner_year")
    found = spark.sql("select * from top_owners_of(2020) order by emissions_quantity desc, owner limit 25")
    assert rows(found) == rows(ranking.top_owners(stored, 2020))
    wanted = spark.createDataFrame([("coal", 2020), ("steel", 2020), ("none", 1)], "subsector string, year int")
    wanted.createOrReplaceTempView("wanted")
    found = spark.sql("select w.*, t.* from wanted w, lateral top_of(w.subsector, w.year) t order by w.subsector, w.year, rank")
    assert rows(found) == rows(lookups.top_of_for(read_table(spark, root, "analysis_top_sources"), wanted))
    assert "PartitionFilters: [isnotnull(year" in plan_of(spark.sql("select * from top_owners_of(2021)"))
    assert len(FUNCTIONS) == 9
