"""Exact sums against Python's own exact sums."""

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from plumeledger.operators import exact


def bits(x):
    return None if x is None else "nan" if math.isnan(x) else struct.pack(">d", x + 0.0)


def summed(values):
    known = [v for v in values if v is not None]
    if not known:
        return None
    if any(math.isnan(v) for v in known) or {math.inf, -math.inf} <= set(known):
        return math.nan
    infinite = [v for v in known if math.isinf(v)]
    return infinite[0] if infinite else math.fsum(known)


def made(rng):
    kind = rng.randint(0, 6)
    if kind == 0:
        return rng.choice([0.0, -0.0, 1.0, -1.0, 2.0**26, 2.0**52, -(2.0**53), 1 - 2.0**-53, 0.1, 5e-324, -2.3e-308])
    if kind == 1:
        return rng.uniform(-1, 1) * 10.0 ** rng.randint(-300, 300)
    if kind == 2:
        return rng.choice([-1, 1]) * 2.0 ** rng.randint(-1070, 1000)
    return round(rng.uniform(-1e5, 1e5), 2)


@pytest.fixture(scope="module")
def groups():
    rng = random.Random(11)
    out = {}
    for g in range(300):
        values = [made(rng) for _ in range(rng.randint(1, 40))]
        if rng.random() < 0.4:  # nothing or next to nothing is left
            values += [-v for v in values]
            values += [made(rng) for _ in range(rng.randint(0, 2))]
        out[f"g{g}"] = values
    out["none"], out["null"] = [None, None], [None, 1.5, None]
    out["halves"] = [2.0**53, 1.0, 2.0**-30]  # rounds up only because of what follows
    out["even"] = [2.0**53, 1.0]
    out["cancel"] = [1e300, 1.0, -1e300]
    out["nan"], out["both"] = [1.0, math.nan], [math.inf, -math.inf, 3.0]
    out["inf"], out["-inf"] = [math.inf, 1.0, math.inf], [-math.inf, 1e308]
    out[None] = [0.1] * 10
    return out


@pytest.mark.parametrize("partitions", [1, 7])
def test_same_bits_under_any_partitioning(spark, groups, partitions):
    rng = random.Random(partitions)
    rows = [(g, v) for g, values in groups.items() for v in values]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, x double").repartition(partitions)
    found = {r["g"]: r["x"] for r in exact.exact_sum(df, ["g"], "x").collect()}
    assert set(found) == set(groups)
    wrong = {g: (found[g], summed(v), v) for g, v in groups.items() if bits(found[g]) != bits(summed(v))}
    assert not wrong


def test_rows_taken_away_leave_the_rest_exact(spark, groups):
    kept = [(g, v, 1) for g, values in groups.items() for v in values]
    rng = random.Random(2)
    gone = [(g, rng.choice([0.1, 1e308, -3e-200, math.nan, math.inf, None])) for g in groups for _ in range(3)]
    rows = kept + [(g, v, 1) for g, v in gone] + [(g, v, -1) for g, v in gone]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, x double, sign int").repartition(5)
    parts = exact.partial(df.limit(2000), ["g"], "x", "sign").unionByName(
        exact.partial(df.subtract(df.limit(0)).limit(0), ["g"], "x", "sign")
    )
    whole = exact.merged(exact.partial(df, ["g"], "x", "sign"), ["g"])
    found = {r["g"]: r["x"] for r in exact.finished(whole, ["g"], "x").collect()}
    assert {g: bits(x) for g, x in found.items()} == {g: bits(summed(v)) for g, v in groups.items()}
    assert parts.columns == whole.columns


def test_several_columns_and_null_keys(spark):
    df = spark.createDataFrame([("a", 0.1, 1.0), ("a", 0.2, 2.0), (None, 0.3, None)], "k string, x double, y double")
    found = exact.exact_sums(df, ["k"], ["x", "y"]).orderBy("k").collect()
    assert [tuple(r) for r in found] == [(None, 0.3, None), ("a", 0.1 + 0.2, 3.0)]
    plan = exact.exact_sum(df, ["k"], "x")._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "Python" not in plan
    assert exact.exact_sum(df.where(F.lit(False)), ["k"], "x").collect() == []
