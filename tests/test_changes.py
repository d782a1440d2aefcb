"""Rollups kept up from changes against the whole job, with failures in between."""

import datetime
import random

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from plumeledger.operators import ownership, ranking, rollups
from plumeledger.plans import changes
from plumeledger.plans.standins import as_table
from plumeledger.sources.tables import read_table, write_table

KEYS = ("subsector", "source_id", "start_time")


def batch(spark, rng, size):
    rows = {}
    for _ in range(size):
        key = rng.choice(["coal", "steel", "ships"]), rng.randint(1, 30), datetime.datetime(rng.choice([2020, 2021]), rng.randint(1, 3), 1)
        quantity = rng.choice([None, 0.0, float("nan"), 0.1, round(rng.uniform(-1e5, 1e5), 2), 10.0 ** rng.randint(-20, 20)])
        rows[key] = (*key, rng.choice(["a", "b", None]), rng.choice([1.5, None]), 2.0, quantity)
    df = spark.createDataFrame(
        list(rows.values()),
        "subsector string, source_id long, start_time timestamp_ntz, source_name string, lat double, lon double, emissions_quantity double",
    )
    return as_table(df, "emissions_sources")


def whole_job(spark, root):
    years = rollups.source_year(read_table(spark, root, "emissions_sources"), exact=True)
    controlling = ownership.controlling_parent(read_table(spark, root, "emissions_sources_ownership"))
    return {
        "analysis_source_year": rollups.source_year_by_key(years),
        "analysis_top_sources": ranking.top_sources(years),
        "analysis_owner_year": ownership.owner_year(years, controlling, exact=True),
        "analysis_owner_trend": ownership.owner_year(years, controlling, exact=True),
    }


def check(spark, root):
    for name, df in whole_job(spark, root).items():
        stored = read_table(spark, root, name)
        ours, theirs = (sorted(map(repr, x.select(*stored.columns).collect())) for x in (stored, df))
        assert ours == theirs and ours, name


@pytest.fixture
def root(spark, tmp_path):
    root = str(tmp_path)
    write_table(batch(spark, random.Random(1), 150), root, "emissions_sources")
    parents = [("coal", i, f"p{i % 7}", f"company {i % 7}", float(i)) for i in range(1, 25)]
    owners = spark.createDataFrame(
        parents, "source_subsector string, source_id long, parent_entity_id string, parent_name string, overall_share_percent double"
    )
    write_table(as_table(owners, "emissions_sources_ownership"), root, "emissions_sources_ownership")
    changes.start(spark, root)
    return root


def test_equal_to_the_whole_job_after_every_batch(spark, root):
    check(spark, root)
    for seed in (2, 3):
        changes.apply(spark, root, batch(spark, random.Random(seed), 60))
        check(spark, root)


@pytest.mark.parametrize("failing", ["emissions_sources", "state_source_year", "state_owner_year", "analysis_owner_year"])
def test_a_batch_that_failed_is_finished_by_the_next_call(spark, root, monkeypatch, failing):
    def broken(df, where, name, *args, **kwargs):
        if name == failing:
            raise OSError("lost")
        return write_table(df, where, name, *args, **kwargs)

    with monkeypatch.context() as patched:
        patched.setattr(changes, "write_table", broken)
        with pytest.raises(OSError):
            changes.apply(spark, root, batch(spark, random.Random(7), 40))
    changes.finish(spark, root)
    check(spark, root)
    changes.finish(spark, root)


def test_only_touched_groups_are_written(spark, root):
    def files(name):
        found = read_table(spark, root, name).select("subsector", "year", F.input_file_name().alias("file")).distinct()
        return {(r["subsector"], r["year"]): r["file"] for r in found.collect()}

    before = {name: files(name) for name in ("analysis_source_year", "analysis_top_sources", "state_source_year")}
    one = batch(spark, random.Random(9), 40).where("subsector = 'coal' and year(start_time) = 2020")
    changes.apply(spark, root, one)
    for name, held in before.items():
        changed = {group for group, file in files(name).items() if held[group] != file}
        assert changed == {("coal", 2020)}, name
    check(spark, root)


def test_incoming_rows_are_ranked_once(spark, root, monkeypatch):
    """Old and new rows of the changes each read and ranked the incoming rows anew."""
    plans, real = [], changes.changes

    def seen(existing, incoming, keys):
        plans.append(plan_of(incoming))
        return real(existing, incoming, keys)

    monkeypatch.setattr(changes, "changes", seen)
    changes.apply(spark, root, batch(spark, random.Random(5), 40))
    assert plans and all("Window" not in plan for plan in plans)
    check(spark, root)
