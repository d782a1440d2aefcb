import random
from decimal import ROUND_HALF_UP, Decimal

from plumeledger.functions.display import display_name, fmt_tonnes, pretty_label


def exact(value, unit, places):
    """Rounded from the exact binary value, halves away from zero."""
    text = str(Decimal(abs(value)).quantize(Decimal(places), ROUND_HALF_UP))
    return ("-" if value < 0 else "") + f"{text} {unit}"


def expected(t):
    if abs(t) >= 1e6:
        return exact(t / 1e6, "Mt", "0.1")
    if abs(t) >= 1e3:
        return exact(t / 1e3, "kt", "0.1")
    return exact(t, "t", "1")


def test_tonnes(spark):
    named = {1234567.0: "1.2 Mt", -4560.0: "-4.6 kt", 999.0: "999 t", 0.0: "0 t", 1450.0: "1.4 kt"}
    rng = random.Random(1)
    values = [*named, 0.5, 1.5, 2.5, 0.49999999999999994, -0.4, 999.5, 999999.0, 999950.0, 1e12 + 5e4]
    values += [rng.uniform(-1, 1) * 10 ** rng.uniform(0, 12) for _ in range(2000)]
    # Decimal ties, which fall to either side in binary.
    values += [s * (n / 10 + 0.05) * u for n in range(10, 300) for u in (1e3, 1e6) for s in (1, -1)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    found = [r[0] for r in df.orderBy("i").select(fmt_tonnes("v")).collect()]
    assert dict(zip(values, found, strict=True)) == {v: expected(v) for v in values}
    assert [named[v] for v in named] == found[: len(named)]


def test_tonnes_not_finite(spark):
    df = spark.createDataFrame(
        [(float("nan"),), (float("-inf"),), (None,)], "v double"
    )
    assert [r[0] for r in df.select(fmt_tonnes("v")).collect()] == ["NaN t", "-Infinity Mt", None]


def test_label(spark):
    cases = {
        "oil-and-gas": "Oil And Gas",
        "o'brien-AND_x": "O'Brien AND_x",
        "énergie-2a": "éNergie 2a",
        " x": " X",
        "": "",
        None: None,
    }
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "i int, t string")
    assert [r[0] for r in df.orderBy("i").select(pretty_label("t")).collect()] == list(cases.values())


def test_display_name(spark):
    df = spark.createDataFrame([("A", 1), (None, 2)], "n string, id bigint")
    found = df.select(display_name("n"), display_name("n", "id")).collect()
    assert [tuple(r) for r in found] == [("A", "A"), ("Unknown", "Source 2")]
