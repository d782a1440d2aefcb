"""Every registered query: against SQL on a second engine, and its plan."""

from datetime import datetime

import duckdb
import pytest
from conftest import SF_DIR, plan_of

import __spark_entry__ as contract
from plumeledger.plans.oracle import ORACLE
from plumeledger.plans.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
#: Queries that write files or tables first; what they return is planned like any other.
WRITERS = {
    name
    for name in QUERIES
    if name.startswith(("stored_", "analysis_", "ingest_", "csv_", "stream_", "reject_", "reload_", "refresh_"))
}


@pytest.fixture(scope="module")
def engine(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def test_names():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_as_sql(spark, sf_dir, engine, name):
    df = QUERIES[name](spark, sf_dir)
    if name in WRITERS:
        check_plan(plan_of(df))
    result = engine.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    theirs = sorted(map(repr, result.fetchall()))
    assert sorted(repr(tuple(r)) for r in df.select(*[f"`{n}`" for n in names]).collect()) == theirs


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in WRITERS])
def test_plan(spark, sf_dir, name):
    check_plan(plan_of(QUERIES[name](spark, sf_dir)))


def check_plan(plan):
    for bad in ("EvalPython", "ArrowEval", "InPandas", "CartesianProduct", "NestedLoop"):
        assert bad not in plan
    for line in plan.splitlines():
        # A window over everything would sit on a single-partition exchange.
        if "Window [" in line:
            assert "specifiedwindowframe" in line
            inside = line.split("windowspecdefinition(", 1)[1]
            assert not inside.startswith("specifiedwindowframe")


@pytest.mark.parametrize("name", ["top_sources", "controlling_parent", "latest_rows", "top_owners_by_year"])
def test_rows_are_limited_before_the_shuffle(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    limits = [line for line in plan.splitlines() if "WindowGroupLimit" in line]
    assert any("Partial" in line for line in limits)
    assert any("Final" in line for line in limits)


@pytest.fixture(scope="module")
def few_rows(spark, tmp_path_factory):
    """Driver tables of a few rows: two subsectors and none, two years and none."""
    root = str(tmp_path_factory.mktemp("few"))
    rows = {
        "part": ("p_partkey long, p_type string", [(1, "PROMO"), (2, "SMALL"), (3, None)]),
        "supplier": ("s_suppkey long, s_name string, s_nationkey long, s_acctbal double", [(1, "a", 4, 5.0), (2, "b", 4, 6.0)]),
        "lineitem": (
            "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, "
            "l_returnflag string, l_shipdate timestamp_ntz",
            [
                (k, part, supplier, 1.0, price, "A", day)
                for k, (part, supplier, price, day) in enumerate(
                    (part, supplier, 10.0 * supplier, day)
                    for part in (1, 2, 3) for supplier in (1, 2)
                    for day in (datetime(1995, 1, 1), datetime(1998, 1, 1), None)
                )
            ],
        ),
    }
    for name, (schema, values) in rows.items():
        spark.createDataFrame(values, schema).coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return root


def test_maps_cover_every_subsector_and_year(spark, rows, few_rows):
    points = QUERIES["map_points_set"](spark, few_rows).select("subsector", "year", "source_id", "radius")
    radius = {1: round(4 + 26 * 0.5**0.5, 6), 2: 30.0}
    assert rows(points, sort=True) == sorted(
        ((s, y, k, radius[k]) for s in ("PROMO", "SMALL") for y in (1995, 1998) for k in (1, 2)), key=repr
    )
    summary = QUERIES["selection_summary_set"](spark, few_rows).select("subsector", "year", "facilities", "total")
    assert rows(summary, sort=True) == sorted(
        ((s, y, 2, 30.0) for s in ("PROMO", "SMALL", None) for y in (1995, 1998, None)), key=repr
    )


def test_only_needed_columns_are_read(spark, sf_dir):
    plan = plan_of(QUERIES["source_year_rollup"](spark, sf_dir))
    lineitem = next(line for line in plan.splitlines() if "l_suppkey:bigint" in line)
    assert "l_tax" not in lineitem.split("ReadSchema")[1]


def test_entry(spark):
    if SF_DIR != "/root/testdata/sf0.001":
        pytest.skip("other scale chosen")
    df = contract.entry(spark)
    assert df.columns == ["owner", "year", "emissions_quantity", "source_count"]
    assert df.count() > 0
