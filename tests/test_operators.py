"""Edge cases that the driver tables do not have, and random data against plain Python."""

import random
from collections import defaultdict
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from plumeledger.operators import lookups, ownership, presentation, ranking, rollups
from plumeledger.operators.keyed import latest_by_key, upsert

NAN = float("nan")
FACILITY = "subsector string, year int, source_id bigint, source_name string, lat double, lon double, emissions_quantity double"
PARENT = "source_id bigint, parent_name string, overall_share_percent double"
TREND = "owner string, year int, emissions_quantity double, source_count int"


def facility(source_id, quantity, subsector="s", year=2020, name="n", lat=1.0, lon=2.0):
    return (subsector, year, source_id, name, lat, lon, quantity)


# --- keyed rows ---


def test_upsert_replaces_whole_rows(spark, rows):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k int, t string, q double")
    new = spark.createDataFrame(
        [(2, "first", 5.0, 1), (2, "later", None, 2), (3, "c", 3.0, 1)], "k int, t string, q double, n int"
    )
    once = upsert(old, new, ["k"], [F.desc("n")])
    expected = [(1, "a", 1.0), (2, "later", None), (3, "c", 3.0)]
    assert rows(once, sort=True) == expected
    assert rows(upsert(once, new, ["k"], [F.desc("n")]), sort=True) == expected


def test_latest_does_not_depend_on_partitioning(spark, rows):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    for n in (1, 3, 8):
        found = latest_by_key(df.repartition(n), ["k"], [F.desc("id")])
        assert rows(found, sort=True) == [(k, max(range(k, 1000, 7))) for k in range(7)]


# --- rollups ---


def test_source_year_keeps_variants(spark, rows):
    months = spark.createDataFrame(
        [
            ("s", 1, datetime(2020, m, 1), name, None, 2.0, 10.0)
            for m, name in ((1, "old"), (2, "old"), (3, "new"))
        ]
        + [("s", 1, datetime(2021, 1, 1), "new", None, 2.0, None)],
        "subsector string, source_id bigint, start_time timestamp_ntz, source_name string, lat double, lon double, emissions_quantity double",
    )
    years = rollups.source_year(months)
    assert rows(years, sort=True) == [
        ("s", 2020, 1, "new", None, 2.0, 10.0),
        ("s", 2020, 1, "old", None, 2.0, 20.0),
        ("s", 2021, 1, "new", None, 2.0, None),
    ]
    assert rows(rollups.source_year_by_key(years), sort=True) == [
        ("s", 2020, 1, "old", None, 2.0, 20.0),
        ("s", 2021, 1, "new", None, 2.0, None),
    ]


def test_year_of_midnight_is_zone_free(spark, rows):
    months = spark.createDataFrame(
        [("s", 1, datetime(2015, 1, 1), "n", 1.0, 2.0, 1.0)],
        "subsector string, source_id bigint, start_time timestamp_ntz, source_name string, lat double, lon double, emissions_quantity double",
    )
    assert rows(rollups.source_year(months).select("year")) == [(2015,)]


def test_rollups_conserve_sums(spark):
    df = spark.range(5000).select(
        F.concat(F.lit("c"), F.col("id") % 3).alias("iso3_country"),
        (F.col("id") % 5 + 2015).cast("int").alias("year"),
        F.concat(F.lit("s"), F.col("id") % 4).alias("sector"),
        F.when(F.col("id") % 2 == 0, "co2").otherwise("ch4").alias("gas"),
        F.col("id").cast("double").alias("emissions_quantity"),
    )
    total = sum(range(5000))
    sectors = rollups.sector_year(df)
    assert sectors.agg(F.sum("emissions_quantity")).first()[0] == total
    national = rollups.national_total(sectors).collect()
    assert [r["year"] for r in national] == list(range(2015, 2020))
    assert sum(r["national_total"] for r in national) == total
    co2 = rollups.sector_year(df, gas="co2").agg(F.sum("emissions_quantity")).first()[0]
    assert co2 == sum(range(0, 5000, 2))


def test_latest_of_nothing(spark, rows):
    empty = spark.createDataFrame([], TREND)
    assert rows(ranking.latest_ranking(empty, ["owner"], 10)) == []
    assert rows(empty.filter(F.col("year") == rollups.latest(empty))) == []
    assert rows(ranking.top_latest(spark.createDataFrame([], FACILITY + ", rank int"), "s")) == []


def test_latest_ranking_order_is_total(spark, rows):
    """Ties on all but one column of the key, in any order of the input."""
    records = [(c, 2020, s, 5.0) for c in ("A", "B", "C") for s in ("x", "y")]
    for seed in range(4):
        shuffled = random.Random(seed).sample(records, len(records))
        df = spark.createDataFrame(shuffled, "iso3_country string, year int, sector string, emissions_quantity double")
        found = ranking.latest_ranking(df.repartition(3), ["iso3_country", "sector"], 3)
        assert rows(found.select("iso3_country", "sector")) == [("A", "x"), ("A", "y"), ("B", "x")]


def test_upsert_with_null_keys(spark, rows):
    old = spark.createDataFrame([(None, 1), ("a", 1)], "k string, n int")
    new = spark.createDataFrame([(None, 2), ("b", 2)], "k string, n int")
    assert rows(upsert(old, new, ["k"], [F.desc("n")]), sort=True) == [("a", 1), ("b", 2), (None, 2)]


def test_latest_ranking_reads_the_latest_year_only(spark, rows):
    df = spark.createDataFrame(
        [("a", 2020, 99.0, 1), ("b", 2021, 1.0, 1), ("c", 2021, None, 1), ("d", 2021, 1.0, 1)], TREND
    )
    assert [r[0] for r in rows(ranking.latest_ranking(df, ["owner"], 2))] == ["b", "d"]
    assert [r[0] for r in rows(ranking.latest_ranking(df, ["owner"], 9))] == ["b", "d", "c"]


# --- ranking ---


def test_top_sources(spark, rows):
    df = spark.createDataFrame(
        [facility(i, float(i)) for i in range(25)]
        + [facility(i, float(i), "t") for i in range(3)]
        + [facility(1, None, "u"), facility(2, -5.0, "u"), facility(3, NAN, "u")]
        + [facility(5, 1.0, "v", name=n) for n in ("b", None, "a")],
        FACILITY,
    )
    top = ranking.top_sources(df.repartition(5))
    found = {}
    for r in top.orderBy("subsector", "rank").collect():
        found.setdefault(r["subsector"], []).append((r["rank"], r["source_id"], r["source_name"]))
    assert [r[:2] for r in found["s"]] == [(k, 25 - k) for k in range(1, 21)]
    assert [r[:2] for r in found["t"]] == [(1, 2), (2, 1), (3, 0)]
    assert [r[:2] for r in found["u"]] == [(1, 3), (2, 2), (3, 1)]
    assert found["v"] == [(1, 5, None), (2, 5, "a"), (3, 5, "b")]


def test_owner_ranking_takes_null_as_zero(spark, rows):
    df = spark.createDataFrame(
        [("B", 2020, -5.0, 1), ("A", 2020, None, 2), ("C", 2021, 9.0, 1)], TREND
    )
    assert rows(ranking.top_owners(df, 2020)) == [("A", 0.0, 2), ("B", -5.0, 1)]
    by_year = ranking.top_owners_by_year(df, limit=1)
    assert rows(by_year.select("year", "owner", "rank")) == [(2020, "A", 1), (2021, "C", 1)]
    only = spark.createDataFrame([(2021,), (2021,), (1999,)], "year int")
    assert rows(ranking.top_owners_by_year(df, years=only).select("year", "owner")) == [(2021, "C")]


def test_limits(spark):
    df = spark.createDataFrame([], TREND)
    for bad in (0, 201, -1):
        with pytest.raises(ValueError, match="limit"):
            ranking.top_owners(df, 2020, bad)
    ranking.top_owners(df, 2020, 200)


def test_default_owners(spark, rows):
    totals = zip("abcde", (3.0, 9.0, 5.0, 9.0, 1.0), strict=True)
    df = spark.createDataFrame(
        [(o, q, 1) for o, q in totals], "owner string, emissions_quantity double, source_count int"
    )
    assert rows(ranking.default_owners(df)) == [("b",), ("d",), ("c",)]


# --- owners ---


@pytest.mark.parametrize(
    ("parents", "owner"),
    [
        ([("B", 50.0), ("A", 50.0)], "A"),
        ([("B", None), ("A", 0.0)], "A"),
        ([("A", None), ("B", 0.0)], "A"),
        ([(None, 90.0), ("C", 10.0)], "C"),
        ([("A", 99.0), ("B", NAN)], "B"),
        ([("A", 10.0), ("B", 10.5)], "B"),
    ],
)
def test_controlling_parent(spark, rows, parents, owner):
    df = spark.createDataFrame([(1, n, s) for n, s in parents], PARENT)
    assert rows(ownership.controlling_parent(df.repartition(3))) == [(1, owner)]


def test_owner_year(spark, rows):
    years = spark.createDataFrame(
        [
            facility(7, 10.0, "a"),
            facility(7, 5.0, "b"),
            facility(8, 1.0, name="old"),
            facility(8, 2.0, name="new"),
            facility(9, 100.0),
            facility(10, None),
        ],
        FACILITY,
    )
    parents = spark.createDataFrame([(7, "X", 60.0), (7, "Y", 40.0), (8, "Z", 1.0), (10, "N", 1.0)], PARENT)
    controlling = ownership.controlling_parent(parents)
    found = rows(ownership.owner_year(years, controlling), sort=True)
    assert found == [("N", 2020, None, 1), ("X", 2020, 15.0, 2), ("Z", 2020, 3.0, 2)]
    assert rows(ownership.unowned_sources(years, controlling).select("source_id")) == [(9,)]
    attributed = ownership.attribute(years, controlling)
    assert attributed.count() + 1 == years.count()


def test_sources_with_owners(spark, rows):
    top = spark.createDataFrame(
        [("a", 2020, 1, 7), ("a", 2021, 1, 7), ("b", 2020, 1, 7), ("b", 2020, 2, 8)],
        "subsector string, year int, rank int, source_id bigint",
    )
    parents = spark.createDataFrame(
        [("a", 7, "p1", "X", 50.0), ("a", 7, "p2", "Y", None), ("c", 8, "p1", "X", 1.0)],
        "source_subsector string, source_id bigint, parent_entity_id string, parent_name string, overall_share_percent double",
    ).withColumns(
        {c: F.lit(None).cast("string") for c in ("parent_entity_type", "parent_registration_country", "immediate_source_owner", "ownership_path")}
    )
    found = ownership.sources_with_owners(top, parents)
    assert rows(found.select("subsector", "year", "source_id", "parent_name"), sort=True) == [
        ("a", 2020, 7, "X"),
        ("a", 2020, 7, "Y"),
        ("a", 2021, 7, "X"),
        ("a", 2021, 7, "Y"),
        ("b", 2020, 7, None),
        ("b", 2020, 8, None),
    ]


def test_with_confidence(spark, rows):
    schema = "subsector string, source_id bigint, start_time timestamp_ntz, activity string"
    day = datetime(2015, 1, 1)
    left = spark.createDataFrame([("a", 1, day, "5"), ("a", 2, day, "6")], schema)
    right = spark.createDataFrame([("a", 1, day, "high"), ("b", 2, day, "low")], schema)
    found = ownership.with_confidence(left, right)
    assert rows(found.select("source_id", "activity", "activity_confidence"), sort=True) == [
        (1, "5", "high"),
        (2, "6", None),
    ]


# --- lookups ---


def test_null_totals_are_served_as_zero(spark, rows):
    df = spark.createDataFrame([facility(2, None, name=None, lat=None), facility(1, 3.0)], FACILITY)
    assert rows(lookups.points_of(df, "s", 2020)) == [(1, "n", 1.0, 2.0, 3.0), (2, None, None, 2.0, 0.0)]
    assert rows(lookups.points_of(df, "s", 2020, 1)) == [(1, "n", 1.0, 2.0, 3.0)]


def test_one_row_per_gas(spark, rows):
    df = spark.createDataFrame(
        [("DEU", "power", "x", 2020, g, q) for g, q in (("n2o", 2.0), ("co2", 1.0))] + [("FRA", "power", "y", 2020, "co2", 9.0)],
        "iso3_country string, sector string, subsector string, year int, gas string, emissions_quantity double",
    )
    assert rows(lookups.sector_subsectors(df, "power")) == [("x", 2020, 1.0), ("x", 2020, 2.0)]
    assert rows(lookups.list_sectors(df)) == [("power",)]
    assert rows(lookups.list_subsectors(df, "power", "FRA")) == [("y",)]
    wanted = spark.createDataFrame([("FRA", "power"), ("FRA", "power")], "iso3_country string, sector string")
    assert rows(lookups.sector_subsectors_for(df, wanted)) == [("FRA", "power", "y", 2020, 9.0)]


def test_ownership_of(spark, rows):
    df = spark.createDataFrame(
        [("s", 1, "b", "B", None), ("s", 1, "a", None, 5.0), ("t", 1, "c", "C", 1.0)],
        "source_subsector string, source_id bigint, parent_entity_id string, parent_name string, overall_share_percent double",
    ).withColumns(
        {c: F.lit(None).cast("string") for c in ("parent_entity_type", "parent_registration_country", "immediate_source_owner", "ownership_path")}
    )
    found = lookups.ownership_of(df, "s", 1).select("parent_name", "overall_share_percent")
    assert rows(found) == [(None, 5.0), ("B", None)]


# --- presentation ---

SECTORS = "year int, sector string, emissions_quantity double"


def test_pivot(spark, rows):
    df = spark.createDataFrame([(2021, "a", -3.0), (2020, "a", 1.0), (2020, "b", None)], SECTORS)
    expected = [(2020, 1.0, 0.0), (2021, 0.0, None)]
    assert rows(presentation.pivot_clamped(df, ["a", "b"])) == expected
    assert rows(presentation.pivot_clamped(df)) == expected


def test_share(spark, rows):
    df = spark.createDataFrame(
        [(2020, "a", 1.0), (2020, "b", 3.0), (2020, "c", -3.0), (2020, "d", None), (2021, "a", 5.0)], SECTORS
    )
    assert rows(presentation.sector_share(df, 2020)) == [
        (2020, "b", 3.0, 4.0, 0.75),
        (2020, "a", 1.0, 4.0, 0.25),
    ]
    assert rows(presentation.sector_share(df))[2] == (2021, "a", 5.0, 5.0, 1.0)


def test_bubbles(spark, rows):
    def radii(quantities, lat=1.0):
        df = spark.createDataFrame([facility(i, q, lat=lat) for i, q in enumerate(quantities)], FACILITY)
        one = rows(presentation.map_points(df).orderBy("source_id").select("radius"))
        many = rows(presentation.map_points_by(df).orderBy("source_id").select("radius"))
        assert one == many
        return [r[0] for r in one]

    assert radii([100.0, 25.0, 0.0, -1.0]) == [30.0, 17.0]
    assert radii([0.25]) == [17.0]
    assert radii([1.0], lat=None) == []


def test_summary(spark, rows):
    df = spark.createDataFrame([facility(1, 5.0), facility(2, -2.0), facility(3, None)], FACILITY)
    assert rows(presentation.selection_summary(df)) == [(3, 3.0)]
    assert rows(presentation.selection_summary(df.limit(0))) == [(0, 0.0)]


def test_compare(spark, rows):
    df = spark.createDataFrame(
        [("a", 2020, 1.0, 1), ("a", 2026, 9.0, 1), ("b", 2021, None, 1), ("c", 2021, 5.0, 1)], TREND
    )
    found = presentation.owner_trend_compare(df, ["b", "a"])
    assert found.columns == ["year", "b", "a"]
    assert rows(found) == [(2020, None, 1.0), (2021, 0.0, None)]
    with pytest.raises(ValueError, match="between 1 and 5"):
        presentation.owner_trend_compare(df, list("abcdef"))


def test_change(spark):
    points = {
        "falls": [(2015, 100.0), (2016, 300.0), (2020, 80.0), (2026, 500.0)],
        "one": [(2015, 100.0), (2026, 5.0)],
        "zero": [(2015, 0.0), (2016, 5.0)],
        "negative": [(2015, -4.0), (2016, 5.0)],
        "null first": [(2015, None), (2016, 5.0)],
        "null last": [(2015, 4.0), (2016, None)],
    }
    df = spark.createDataFrame([(o, y, q, 1) for o, ps in points.items() for y, q in ps], TREND)
    found = {r["owner"]: (r["change"], r["reduced"]) for r in presentation.owner_change(df.repartition(3)).collect()}
    assert found == {
        "falls": (-0.2, True),
        "one": (None, None),
        "zero": (None, None),
        "negative": (None, None),
        "null first": (None, None),
        "null last": (-1.0, True),
    }


def test_category_index(spark, rows):
    df = spark.createDataFrame([(f"c{i:02d}",) for i in range(12)] + [(None,)], "c string")
    found = dict(rows(presentation.category_index(df, "c")))
    assert found == {f"c{i:02d}": i % 10 for i in range(12)} | {None: 0}
    some = spark.createDataFrame([("c05",), ("c07",)], "c string")
    found = dict(rows(presentation.category_index(df, "c", some)))
    assert (found["c05"], found["c07"], found["c06"]) == (0, 1, 0)
    none = presentation.category_index(df, "c", df.where("false"))
    assert {index for _, index in rows(none)} == {0}


def test_category_index_of_very_many(spark):
    """More values than one array should hold, dealt over several ranges."""
    df = spark.range(60_000).select(F.format_string("v%05d", "id").alias("c"), "id")
    wrong = presentation.category_index(df.repartition(7), "c").where("category_index <> id % 10")
    assert wrong.isEmpty()


def test_coverage(spark, rows):
    df = spark.createDataFrame([(2015,), (2015,), (2030,)], "year int")
    found = rows(presentation.year_coverage(presentation.year_domain(spark), df))
    assert len(found) == 12
    assert found[:2] == [(2015, 2), (2016, 0)]


# --- random data, a third of it in one facility and subsector ---


def random_facilities(rng, n=600):
    def quantity():
        return rng.choice([None, float(rng.randint(-3, 9))])

    hot = [facility(7, quantity(), "hot", 2020, rng.choice("ab"), rng.choice([None, 1.0])) for _ in range(n // 3)]
    rest = [
        facility(rng.randint(0, 40), quantity(), rng.choice("xyz"), rng.randint(2018, 2021))
        for _ in range(n - len(hot))
    ]
    return hot + rest


def null_last(q):
    return (q is None, 0 if q is None else -q)


def null_first(value):
    return (value is not None, value)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_plain_python(spark, rows, seed):
    rng = random.Random(seed)
    records = random_facilities(rng)
    parents = [
        (rng.choice([7, rng.randint(0, 30)]), rng.choice([None, "A", "B", "C"]), rng.choice([None, 0.0, 5.0, 50.0]))
        for _ in range(300)
    ]
    groups = defaultdict(list)
    for r in records:
        groups[r[:2]].append(r[2:])
    expected_top = set()
    for group, members in groups.items():
        members.sort(key=lambda m: (null_last(m[4]), m[0], m[1], null_first(m[2]), m[3]))
        expected_top |= {(*group, k, *m) for k, m in enumerate(members[:20], start=1)}
    owner = {}
    for source_id, name, share in parents:
        if name is not None:
            owner[source_id] = min(owner.get(source_id, (1.0, "")), (-(share or 0.0), name))
    totals = defaultdict(list)
    for r in records:
        if r[2] in owner:
            totals[owner[r[2]][1], r[1]].append(r[6])
    expected_owners = {
        (o, y, sum(q for q in qs if q is not None) if set(qs) != {None} else None, len(qs))
        for (o, y), qs in totals.items()
    }
    for parts in (1, 7):
        rng.shuffle(records)
        rng.shuffle(parents)
        years = spark.createDataFrame(records, FACILITY).repartition(parts)
        controlling = ownership.controlling_parent(spark.createDataFrame(parents, PARENT).repartition(parts))
        assert set(rows(ranking.top_sources(years))) == expected_top
        assert dict(rows(controlling)) == {s: name for s, (_, name) in owner.items()}
        found = ownership.owner_year(years, controlling)
        assert set(rows(found)) == expected_owners
        unowned = ownership.unowned_sources(years, controlling).count()
        assert ownership.attribute(years, controlling).count() + unowned == len(records)


def test_shares_add_up(spark):
    rng = random.Random(3)
    df = spark.createDataFrame(
        [(y, f"s{i}", rng.uniform(-5, 10)) for y in range(2015, 2020) for i in range(9)], SECTORS
    )
    sums = presentation.sector_share(df).groupBy("year").agg(F.sum("share").alias("s")).collect()
    assert len(sums) == 5
    assert all(abs(r["s"] - 1) < 1e-9 for r in sums)
