"""Keyed Parquet tables and the batch job."""

import os
from datetime import datetime

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from plumeledger.plans.analysis import ROLLUPS, reports, run_analysis
from plumeledger.plans.standins import as_table
from plumeledger.operators import lookups, ranking
from plumeledger.schemas import RESULTS, TABLES, conform, conform_result
from plumeledger.sources import tables
from plumeledger.sources.tables import read_table, table_exists, write_table
from plumeledger.sources.workspace import work_dir

OWNER = "year int, owner string, emissions_quantity double, source_count int"


def months(spark, records):
    df = spark.createDataFrame(
        records, "subsector string, source_id bigint, start_time timestamp_ntz, emissions_quantity double"
    )
    return as_table(df, "emissions_sources")


def files(root, name):
    return {
        os.path.relpath(os.path.join(d, f), f"{root}/{name}")
        for d, _, fs in os.walk(f"{root}/{name}")
        for f in fs
        if f.endswith(".parquet")
    }


def test_registry():
    for table in TABLES.values():
        assert set(table.key) <= set(table.columns)
        assert set(table.directories) <= set(table.key) | set(table.derived)


def test_conform(spark):
    good = spark.createDataFrame([(2020, "a", 1.0, 1)], OWNER)
    assert conform(good.select(*reversed(good.columns)), "analysis_owner_year").columns == good.columns
    with pytest.raises(ValueError, match="missing column.*owner"):
        conform(good.drop("owner"), "analysis_owner_year")
    with pytest.raises(ValueError, match="source_count is bigint, not int"):
        conform(good.withColumn("source_count", F.lit(1).cast("long")), "analysis_owner_year")
    null_key = spark.createDataFrame([(2020, None, 1.0, 1)], OWNER)
    with pytest.raises(Exception, match="null in one of"):
        conform(null_key, "analysis_owner_year").collect()
    null_value = spark.createDataFrame([(2020, "a", None, None)], OWNER)
    assert conform(null_value, "analysis_owner_year").count() == 1


def test_results_have_their_shape(spark):
    def empty(name):
        columns = ", ".join(f"{c} {kind}" for c, kind in TABLES[name].columns.items())
        return spark.createDataFrame([], columns)

    country, top = empty("country_emissions"), empty("analysis_top_sources")
    owners, trends = empty("analysis_owner_year"), empty("analysis_owner_trend")
    found = {
        "sector_total": lookups.sector_timeseries(empty("analysis_sector_year")),
        "subsector_row": lookups.sector_subsectors(country, "power"),
        "source_point": lookups.points_of(empty("analysis_source_year"), "coal", 2020),
        "top_source": lookups.top_of(top, "coal", 2020),
        "ownership_row": lookups.ownership_of(empty("emissions_sources_ownership"), "coal", 1),
        "owner_row": ranking.top_owners(owners, 2020),
        "owner_trend_point": lookups.owner_trend(trends, "a"),
    }
    assert set(found) == set(RESULTS)
    for name, df in found.items():
        assert conform_result(df, name).columns == df.columns
        assert conform_result(df, name).count() == 0
    no_quantity = spark.createDataFrame([("a", None, 1)], "owner string, emissions_quantity double, source_count int")
    with pytest.raises(Exception, match="null in one of"):
        conform_result(no_quantity, "owner_row").collect()


def test_upsert(spark, tmp_path, rows):
    root = str(tmp_path)
    day = datetime(2020, 1, 1)
    write_table(
        months(spark, [("a", 1, day, 1.0), ("a", 2, day, 2.0), ("b", 1, day, 3.0), ("a", 1, datetime(2021, 1, 1), 4.0)]),
        root,
        "emissions_sources",
    )
    before = files(root, "emissions_sources")
    assert len(before) == 3
    batch = months(spark, [("a", 1, day, None), ("a", 3, day, 9.0), ("c", 1, day, 7.0)])
    for _ in range(2):
        write_table(batch, root, "emissions_sources")
        found = read_table(spark, root, "emissions_sources").select(
            "subsector", "source_id", F.year("start_time"), "emissions_quantity"
        )
        assert rows(found, sort=True) == [
            ("a", 1, 2020, None),
            ("a", 1, 2021, 4.0),
            ("a", 2, 2020, 2.0),
            ("a", 3, 2020, 9.0),
            ("b", 1, 2020, 3.0),
            ("c", 1, 2020, 7.0),
        ]
    # Directories without incoming rows were not rewritten.
    after = files(root, "emissions_sources")
    assert {f for f in before if "start_year=2021" in f or "subsector=b" in f} <= after
    # And no scratch table is left.
    assert not [f for f in os.listdir(work_dir(spark)) if "emissions_sources" in f]


def test_directory_names(spark, tmp_path, rows):
    """Values that need escaping, or look like numbers, come back as they were."""
    root = str(tmp_path)
    day = datetime(2020, 1, 1)
    names = ["007", "oil/gas", "a=b", "x y", "1.50", "o'b%20"]
    for quantity in (1.0, 2.0):
        write_table(months(spark, [(n, 1, day, quantity) for n in names]), root, "emissions_sources")
        found = read_table(spark, root, "emissions_sources").select("subsector", "emissions_quantity")
        assert sorted(rows(found)) == sorted((n, quantity) for n in names)


def test_empty_batches(spark, tmp_path, rows):
    root = str(tmp_path)
    nothing = months(spark, [])
    write_table(nothing, root, "emissions_sources")
    assert rows(read_table(spark, root, "emissions_sources")) == []
    write_table(months(spark, [("a", 1, datetime(2020, 1, 1), 1.0)]), root, "emissions_sources")
    write_table(nothing, root, "emissions_sources")
    assert read_table(spark, root, "emissions_sources").count() == 1


def test_order_picks_the_row(spark, tmp_path, rows):
    root = str(tmp_path)
    day = datetime(2020, 1, 1)
    batch = months(spark, [("a", 1, day, q) for q in (5.0, 1.0, 3.0)]).withColumn("line", -F.col("emissions_quantity"))
    write_table(batch, root, "emissions_sources", order=[F.desc("line")])
    assert rows(read_table(spark, root, "emissions_sources").select("emissions_quantity")) == [(1.0,)]


def test_refresh_leaves_nothing_stale(spark, tmp_path, rows):
    root = str(tmp_path)
    assert not table_exists(spark, root, "analysis_owner_year")
    for records in ([(2020, "a", 1.0, 1), (2021, "b", 1.0, 1)], [(2021, "c", 2.0, 2)]):
        write_table(spark.createDataFrame(records, OWNER), root, "analysis_owner_year", mode="refresh")
        assert rows(read_table(spark, root, "analysis_owner_year"), sort=True) == records
    with pytest.raises(ValueError, match="unknown mode"):
        write_table(spark.createDataFrame([], OWNER), root, "analysis_owner_year", mode="append")


def test_unpartitioned_upsert(spark, tmp_path, rows):
    root = str(tmp_path)
    for records in ([(2020, "a", 1.0, 1), (2021, "a", 1.0, 1)], [(2021, "a", 2.0, 2)]):
        write_table(spark.createDataFrame(records, OWNER), root, "analysis_owner_trend")
    assert rows(read_table(spark, root, "analysis_owner_trend"), sort=True) == [
        ("a", 2020, 1.0, 1),
        ("a", 2021, 2.0, 2),
    ]


def test_hot_partition_becomes_several_files(spark, tmp_path):
    """A partition with nearly all rows, most of one facility, is split by key."""
    root = str(tmp_path)
    hot = spark.range(20000).select(
        F.lit("hot").alias("subsector"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("bigint").alias("source_id"),
        F.expr("timestamp_ntz'2020-01-01' + make_interval(0, 0, 0, 0, 0, id)").alias("start_time"),
        F.rand(1).alias("emissions_quantity"),
    )
    cold = months(spark, [("cold", 1, datetime(2020, 1, 1), 1.0)])
    write_table(as_table(hot, "emissions_sources").unionByName(cold), root, "emissions_sources", file_bytes=50_000)
    stored = files(root, "emissions_sources")
    in_hot = [f for f in stored if "subsector=hot" in f]
    assert len(in_hot) > 3
    sizes = [os.path.getsize(f"{root}/emissions_sources/{f}") for f in in_hot]
    assert max(sizes) < 4 * sum(sizes) / len(sizes)
    assert len(stored) == len(in_hot) + 1
    assert read_table(spark, root, "emissions_sources").count() == 20001


def test_rows_bound_a_task_however_small_their_file(spark, tmp_path):
    """A million alike rows are a few bytes each on disk, and all of their width when sorted."""
    root, day = str(tmp_path), datetime(2020, 1, 1)
    alike = months(spark, [("a", k, day, 1.0) for k in range(300)])
    write_table(alike, root, "emissions_sources", file_rows=100)
    assert len(files(root, "emissions_sources")) == 3
    write_table(months(spark, [("a", k, day, 2.0) for k in range(300, 400)]), root, "emissions_sources", file_rows=100)
    assert len(files(root, "emissions_sources")) == 3 + 4  # the folder before, and the one of 400 rows
    assert read_table(spark, root, "emissions_sources").count() == 400


def test_filters_reach_the_scan(spark, tmp_path):
    root = str(tmp_path)
    day = datetime(2020, 1, 1)
    write_table(months(spark, [("a", 1, day, 1.0), ("b", 2, day, 1.0)]), root, "emissions_sources")
    one = read_table(spark, root, "emissions_sources").filter(
        (F.col("subsector") == "a") & (F.col("source_id") == 1)
    ).select("start_time", "emissions_quantity")
    plan = plan_of(one)
    assert "PartitionFilters: [isnotnull(subsector" in plan
    assert "EqualTo(source_id,1)" in plan
    assert "ReadSchema: struct<source_id:bigint,start_time:timestamp_ntz,emissions_quantity:double>" in plan
    write_table(spark.createDataFrame([(2020, "a", 1.0, 1)], OWNER), root, "analysis_owner_trend")
    trend = read_table(spark, root, "analysis_owner_trend").filter(F.col("owner") == "a")
    assert "EqualTo(owner,a)" in plan_of(trend)


def test_failed_publish_leaves_the_table(spark, tmp_path, rows, monkeypatch):
    """An error while the new files are written: the old rows are still read."""
    root = str(tmp_path)
    many = [(2020, f"o{i}", float(i), 1) for i in range(10)]
    write_table(spark.createDataFrame(many, OWNER), root, "analysis_owner_year", mode="refresh")
    publish = tables._publish

    def broken(merged, *rest):
        fails = F.when(F.col("owner") == "new", F.raise_error(F.lit("broken"))).otherwise(F.col("owner"))
        publish(merged.withColumn("owner", fails.cast("string")), *rest)

    monkeypatch.setattr(tables, "_publish", broken)
    for mode in ("refresh", "upsert"):
        with pytest.raises(Exception, match="broken"):
            write_table(spark.createDataFrame([(2020, "new", 1.0, 1)], OWNER), root, "analysis_owner_year", mode=mode)
        assert read_table(spark, root, "analysis_owner_year").count() == 10
    assert not [f for f in os.listdir(work_dir(spark)) if "analysis_owner_year" in f]


def test_reader_keeps_its_snapshot(spark, tmp_path, rows):
    root = str(tmp_path)
    write_table(spark.createDataFrame([(2020, "a", 1.0, 1)], OWNER), root, "analysis_owner_year", mode="refresh")
    before = read_table(spark, root, "analysis_owner_year")
    for n in (2.0, 3.0, 4.0):
        assert rows(read_table(spark, root, "analysis_owner_year").select("emissions_quantity")) == [(n - 1,)]
        write_table(spark.createDataFrame([(2020, "a", n, 1)], OWNER), root, "analysis_owner_year", mode="refresh")
        if n == 2.0:
            assert rows(before.select("emissions_quantity")) == [(1.0,)]
    # Only the last two writes are still there.
    assert len([f for f in os.listdir(f"{root}/analysis_owner_year") if f.startswith("batch=")]) == 2


def test_very_many_directories(spark, tmp_path):
    """Far more directories than one filter expression could name."""
    root = str(tmp_path)
    df = spark.range(5000).select(
        F.concat(F.lit("s/"), F.col("id")).alias("subsector"),
        F.col("id").alias("source_id"),
        F.lit(datetime(2020, 1, 1)).cast("timestamp_ntz").alias("start_time"),
        F.lit(1.0).alias("emissions_quantity"),
    )
    rows_ = as_table(df, "emissions_sources")
    write_table(rows_, root, "emissions_sources")
    write_table(rows_.withColumn("emissions_quantity", F.lit(2.0)), root, "emissions_sources")
    table = read_table(spark, root, "emissions_sources")
    assert table.agg(F.count("*"), F.sum("emissions_quantity")).first()[:] == (5000, 10000.0)


def test_failed_merge_leaves_the_table(spark, tmp_path, rows, monkeypatch):
    root = str(tmp_path)
    day = datetime(2020, 1, 1)
    write_table(months(spark, [("a", 1, day, 1.0)]), root, "emissions_sources")
    broken = months(spark, [("a", 1, day, 2.0), ("a", None, day, 2.0)])
    with pytest.raises(Exception, match="null in one of"):
        write_table(broken, root, "emissions_sources")
    assert rows(read_table(spark, root, "emissions_sources").select("emissions_quantity")) == [(1.0,)]


def test_job(spark, tmp_path, rows):
    root = str(tmp_path)
    country = spark.createDataFrame(
        [("DEU", "power", "coal", 2020, "co2", 5.0), ("DEU", "power", "gas", 2020, "co2", 2.0)],
        "iso3_country string, sector string, subsector string, year int, gas string, emissions_quantity double",
    )
    write_table(as_table(country, "country_emissions"), root, "country_emissions")
    records = [("coal", 7, datetime(2020, m, 1), 1.0) for m in range(1, 13)] + [("gas", 7, datetime(2020, 1, 1), 5.0), ("gas", 8, datetime(2020, 1, 1), 1.0)]
    renamed = F.when(F.month("start_time") <= 6, "old").otherwise("new")
    write_table(months(spark, records).withColumn("source_name", renamed), root, "emissions_sources")
    parents = spark.createDataFrame(
        [("coal", 7, "1", "X", 60.0), ("coal", 7, "2", "Y", 40.0), ("gas", 7, "2", "Y", 50.0)],
        "source_subsector string, source_id bigint, parent_entity_id string, parent_name string, overall_share_percent double",
    )
    name = "emissions_sources_ownership"
    write_table(as_table(parents, name), root, name)
    for _ in range(2):
        run_analysis(spark, root)
        stored = {t: read_table(spark, root, t) for t in ROLLUPS}
        assert rows(stored["analysis_sector_year"]) == [("DEU", 2020, "power", 7.0)]
        # Two names in one year: two ranks, one stored row.
        assert rows(stored["analysis_source_year"].select("subsector", "source_id", "source_name", "emissions_quantity"), sort=True) == [
            ("coal", 7, "new", 6.0),
            ("gas", 7, "old", 5.0),
            ("gas", 8, "old", 1.0),
        ]
        top = stored["analysis_top_sources"].filter(F.col("subsector") == "coal")
        assert rows(top.select("rank", "source_name"), sort=True) == [(1, "new"), (2, "old")]
        by_year = rows(stored["analysis_owner_year"])
        assert by_year == [(2020, "X", 17.0, 3)]
        assert rows(stored["analysis_owner_trend"].select("year", "owner", "emissions_quantity", "source_count")) == by_year
    found = reports(spark, root, "coal")
    assert rows(found["national total by year"]) == [(2020, 7.0)]
    assert rows(found["top coal facilities, latest year"].select("rank")) == [(1,), (2,)]
    assert rows(found["top owners, latest year"].select("owner")) == [("X",)]
    assert dict(rows(found["rows written"]))["analysis_top_sources"] == 4


def test_scratch_folder_is_required_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://host"

        def getCheckpointDir(self):
            return None

    class Session:
        class conf:
            @staticmethod
            def get(*_):
                return None

        sparkContext = Context()

    with pytest.raises(RuntimeError, match="checkpoint"):
        work_dir(Session())
    assert tables.FILE_BYTES > 0
