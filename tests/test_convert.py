import math
import random
from datetime import datetime
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from plumeledger.functions.convert import (
    clean_text,
    pairs_to_map,
    parse_double,
    parse_long,
    parse_ts,
    year_prefix,
)


def converted(spark, function, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.repartition(2).orderBy("i").select(function("t")).collect()]


def check(spark, function, cases):
    found = converted(spark, function, list(cases))
    for (text, expected), value in zip(cases.items(), found, strict=True):
        if isinstance(expected, float) and math.isnan(expected):
            assert math.isnan(value), text
        else:
            assert value == expected, text


def test_timestamps(spark):
    day = datetime(2015, 1, 1)
    check(
        spark,
        parse_ts,
        {
            "2015-01-01 00:00:00.123456": datetime(2015, 1, 1, 0, 0, 0, 123456),
            "2015-01-01 00:00:00.5": datetime(2015, 1, 1, 0, 0, 0, 500000),
            "2015-01-01 00:00:00": day,
            "2015-01-01 \t 00:00:00": day,
            "2015-01-01": day,
            " 2015-01-01 ": day,
            "2015-1-5": datetime(2015, 1, 5),
            "2015-1-5 1:2:3": datetime(2015, 1, 5, 1, 2, 3),
            # Does not exist in the session zone.
            "2015-03-08 02:30:00": datetime(2015, 3, 8, 2, 30),
            "2015": None,
            "0000-01-01": None,
            "2015-01-01T00:00:00Z": None,
            "2015-01-01 00:00:00+05:00": None,
            "2015-13-01": None,
            "2015-02-29": None,
            "2015-01-01 24:00:00": None,
            "2015-01-01 00:00:60": None,
            "2015-01-01 00:00:00.1234567": None,
            "2015-01-01 00:00": None,
            "": None,
            " ": None,
            None: None,
        },
    )


def test_doubles(spark):
    nan, inf = float("nan"), float("inf")
    check(
        spark,
        parse_double,
        {
            "1.5": 1.5,
            " 1.5 \n": 1.5,
            "1e3": 1000.0,
            "-.5": -0.5,
            "5.": 5.0,
            "1e400": inf,
            "nan": nan,
            "+NaN": nan,
            "-nan": nan,
            "inf": inf,
            "-Infinity": -inf,
            "1_000": 1000.0,
            "1_0e1_0": 10e10,
            "_1": None,
            "1__0": None,
            "1_": None,
            "1.5d": None,
            "1f": None,
            "0x10": None,
            "n/a": None,
            "1 2": None,
            "": None,
            "  ": None,
            None: None,
        },
    )


def test_longs(spark):
    check(
        spark,
        parse_long,
        {
            "12": 12,
            "12.7": 12,
            "-12.7": -12,
            "1e3": 1000,
            "nan": None,
            "inf": None,
            "1e30": None,
            "x": None,
            "": None,
            None: None,
        },
    )


def test_text_and_year(spark):
    check(spark, clean_text, {" a ": "a", "\t\x1ca b　": "a b", " \r\n": None, "": None, None: None})
    check(
        spark,
        year_prefix,
        {"2015-01-01": 2015, "2015": 2015, " 2015": None, "201": None, "20a5-01": None, None: None},
    )


def written_number(rng):
    """(text, value) of a number that is known before it is written."""
    kind = rng.randrange(6)
    if kind == 0:
        value = rng.choice([math.nan, math.inf, -math.inf])
        word = {"nan": ["nan", "NaN", "NAN"], "inf": ["inf", "Infinity", "+inf"], "-inf": ["-inf", "-Infinity"]}
        return rng.choice(word[repr(value)]), value
    digits, scale, sign = rng.randint(0, 10**6), rng.randint(0, 5), rng.choice([1, -1])
    value = sign * float(Fraction(digits, 10**scale))
    whole, part = divmod(digits, 10**scale)
    if kind == 1 and not part:
        body = f"{whole:_}"
    elif kind == 2:
        body = f"{digits}{rng.choice('eE')}-{scale}"
    elif scale:
        body = f"{whole}.{part:0{scale}d}"
    else:
        body = f"{whole}{rng.choice(['', '.', '.0'])}"
    text = ("-" if sign < 0 else rng.choice(["", "+"])) + body
    return rng.choice(["", " ", "\t"]) + text + rng.choice(["", " "]), value


def spoiled(rng, text):
    """A text that is no number, made from one that is finite."""
    spoil = [text + "d", "x" + text, text.replace(".", ",") + ",", text + " 1", "_" + text.strip(), text.strip() + "_"]
    return rng.choice(spoil)


def test_numbers_known_beforehand(spark):
    rng = random.Random(7)
    cases = [written_number(rng) for _ in range(3000)]
    found = converted(spark, parse_double, [text for text, _ in cases])
    for (text, value), got in zip(cases, found, strict=True):
        assert repr(got + 0.0) == repr(value + 0.0), text
    finite = [text for text, value in cases if math.isfinite(value)]
    for text, got in zip(finite, converted(spark, parse_double, [spoiled(rng, t) for t in finite]), strict=True):
        assert got is None, text


def written_time(rng):
    """(text, moment) from numbers; the calendar decides whether they are a moment at all."""
    year, month, day = rng.choice([2015, 2016, 1999]), rng.randint(1, 13), rng.randint(1, 32)
    hour, minute, second = rng.randint(0, 25), rng.randint(0, 61), rng.randint(0, 61)
    form, micros, digits = rng.randrange(3), 0, 0
    wide = rng.random() < 0.5
    date = f"{year}-{month:02d}-{day:02d}" if wide else f"{year}-{month}-{day}"
    clock = f"{hour:02d}:{minute:02d}:{second:02d}" if wide else f"{hour}:{minute}:{second}"
    if form == 0:
        hour = minute = second = 0
        text = date
    else:
        text = date + " " * rng.randint(1, 2) + clock
    if form == 2:
        digits = rng.randint(1, 7)
        fraction = rng.randrange(10**digits)
        micros = fraction * 10 ** (6 - digits) if digits <= 6 else 0
        text += f".{fraction:0{digits}d}"
    try:
        moment = datetime(year, month, day, hour, minute, second, micros)
    except ValueError:
        moment = None
    return rng.choice(["", " "]) + text + rng.choice(["", "\t"]), None if digits > 6 else moment


def test_times_known_beforehand(spark):
    rng = random.Random(11)
    cases = [written_time(rng) for _ in range(4000)]
    for (text, moment), got in zip(cases, converted(spark, parse_ts, [t for t, _ in cases]), strict=True):
        assert got == moment, text


@pytest.mark.parametrize(
    ("pairs", "expected"),
    [
        ([("a", "1"), ("b", "2")], {"a": "1", "b": "2"}),
        ([("a", "1"), ("a", "2")], {"a": "2"}),
        ([("a", "1"), ("b", "2"), (" a ", " 3 ")], {"a": "3", "b": "2"}),
        ([("a", "1"), ("a", " ")], {"a": "1"}),
        ([("a", None), (None, "1")], None),
        ([], None),
    ],
)
def test_pairs_to_map(spark, pairs, expected):
    cells = {"id": "x"}
    for k, (key, value) in enumerate(pairs, start=1):
        cells |= {f"other{k}_def": key, f"other{k}": value}
    df = spark.createDataFrame([tuple(cells.values())], ", ".join(f"{c} string" for c in cells))
    assert df.select(pairs_to_map(df.columns).alias("m")).first()["m"] == expected


def test_pair_without_partner_column(spark):
    df = spark.range(1).select(F.lit("a").alias("other1_def"), F.lit("b").alias("other2"))
    assert df.select(pairs_to_map(df.columns)).first()[0] is None
