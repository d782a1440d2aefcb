"""Sums of doubles that do not depend on the order of addition.

A finite double is a whole number of at most 53 bits times a power of two. It is split into
three whole numbers, the digits of three neighbouring bins of ``WIDTH`` bits, which are added
as integers: by Spark's own aggregates, exactly, and in the map tasks first. The digits of
a group add up to its exact sum, which is rounded to a double once, at the end.

``partial`` gives the bins, which can be kept, merged and taken away from each other;
``finished`` gives the double. A sum with a NaN, or with both infinities, is NaN; with one of
them it is that one. Nulls are left out, and a group without any value has a null. A bin
holds up to 2 ** 37 values of a group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH = 26
#: One bin of a group: its number, the sum of its digits, and what the bin says of the group.
BIN = "bin"
COUNTS = ("n_values", "n_nan", "n_above", "n_below")
PARTS = ("high", "middle", "low")


def _power(exponent: Column) -> Column:
    """2 to the power of whole numbers within the range of normal doubles, exactly."""
    return F.pow(F.lit(2.0), exponent.cast("double"))


def _scaled(x: Column, exponent: Column) -> Column:
    """``x * 2 ** exponent`` in two steps, neither of which leaves the range."""
    half = F.floor(exponent / 2)
    return x * _power(half) * _power(exponent - half)


def _whole(x: Column) -> Column:
    """Towards zero."""
    return F.signum(x) * F.floor(F.abs(x))


def _split(df: DataFrame, column: str) -> DataFrame:
    """``df`` with ``bin`` and the three digits of a double; zeros for one that is no number."""
    x = F.col(column)
    finite = x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")) & (x != 0)
    df = df.withColumn("_x", F.when(finite, x))
    df = df.withColumn("_guess", F.floor(F.log2(F.abs("_x")) / WIDTH))
    # The logarithm may be off by its last bit; the power is exact.
    df = df.withColumn("_near", _scaled(F.abs("_x"), -F.col("_guess") * WIDTH))
    shift = F.when(F.col("_near") < 1, -1).when(F.col("_near") >= 2**WIDTH, 1).otherwise(0)
    df = df.withColumn("_place", F.col("_guess") + shift)
    rest = _scaled(F.col("_x"), -F.col("_place") * WIDTH)
    for part in PARTS:
        df = df.withColumn("_rest", rest).withColumn(f"_{part}", _whole(F.col("_rest")))
        rest = (F.col("_rest") - F.col(f"_{part}")) * float(2**WIDTH)
    whole = lambda c, kind: F.coalesce(F.col(c).cast(kind), F.lit(0).cast(kind))
    df = df.withColumns({BIN: whole("_place", "int"), **{p: whole(f"_{p}", "long") for p in PARTS}})
    return df.drop("_x", "_guess", "_near", "_place", "_rest", *[f"_{p}" for p in PARTS])


def partial(df: DataFrame, keys: Sequence[str], column: str, sign: str | None = None) -> DataFrame:
    """``keys, bin, high, middle, low``, counts of values and of those that are not numbers, and
    of all rows (``n_rows``), per key and bin. ``sign`` names a column of 1 and -1 by which
    rows are added or taken away."""
    x = F.col(column)
    times = F.lit(1) if sign is None else F.col(sign)
    flags = {
        "n_values": x.isNotNull(), "n_nan": F.isnan(x),
        "n_above": x == float("inf"), "n_below": x == float("-inf"),
    }
    split = df.select(*keys, x.alias("_value"), times.cast("long").alias("n_rows"), *[
        F.coalesce(f.cast("long"), F.lit(0).cast("long")).alias(n) for n, f in flags.items()
    ])
    split = _split(split, "_value")
    weighed = [F.sum(F.col(c) * F.col("n_rows")).alias(c) for c in (*PARTS, *COUNTS)]
    return split.groupBy(*keys, BIN).agg(*weighed, F.sum("n_rows").alias("n_rows"))


def merged(partials: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bins of several ``partial`` results added up."""
    return partials.groupBy(*keys, BIN).agg(*[F.sum(c).alias(c) for c in (*PARTS, *COUNTS, "n_rows")])


def _carried(digits_: Column) -> Column:
    """Digits from 0 to 2 ** WIDTH - 1, lowest first; the last one keeps the sign."""

    def step(done: Column, d: Column) -> Column:
        rest = F.call_function("shiftright", d + done["carry"], F.lit(WIDTH))
        digit = (d + done["carry"]).bitwiseAND(F.lit(2**WIDTH - 1).cast("long"))
        return F.struct(F.concat(done["out"], F.array(digit)).alias("out"), rest.alias("carry"))

    none = F.struct(F.array().cast("array<bigint>").alias("out"), F.lit(0).cast("long").alias("carry"))
    return F.aggregate(digits_, none, step, lambda d: F.concat(d["out"], F.array(d["carry"])))


def _rounded(df: DataFrame, bins: str, name: str) -> DataFrame:
    """``df`` with the double nearest to the sum of ``bins`` (bin, high, middle, low).

    Every step is a column of its own, read by the next ones, so that none is computed twice.
    """
    at = lambda k: F.transform(bins, lambda b: b[BIN] - k)
    # Sums of 63 bits reach two bins further up; a third takes the sign.
    df = df.withColumn("_low", F.array_min(at(2))).withColumn("_high", F.array_max(at(0)) + 3)

    def digit_of(place: Column) -> Column:
        def add(done: Column, b: Column) -> Column:
            k = b[BIN] - place
            found = F.when(k == 0, b["high"]).when(k == 1, b["middle"]).when(k == 2, b["low"]).otherwise(F.lit(0).cast("long"))
            return done + found

        return F.aggregate(bins, F.lit(0).cast("long"), add)

    df = df.withColumn("_dense", F.transform(F.sequence("_low", "_high"), digit_of))
    df = df.withColumn("_once", _carried(F.col("_dense")))
    # A negative sum ends with a negative carry: its opposite is carried instead.
    df = df.withColumn("_negative", F.element_at("_once", -1) < 0)
    opposite = _carried(F.transform("_dense", lambda d: -d))
    df = df.withColumn("_size", F.when(F.col("_negative"), opposite).otherwise(F.col("_once")))
    held = F.transform(F.reverse("_size"), lambda d: d != 0)
    df = df.withColumn("_top", F.size("_size") - F.array_position(held, F.lit(True)).cast("int"))
    # From the highest digit that is not zero: four digits hold 79 bits at least, and whether
    # anything follows them goes to the last bit, far below the one that is rounded.
    digit = lambda k: F.coalesce(F.get("_size", F.col("_top") - k), F.lit(0).cast("long"))
    two = lambda a, b: F.call_function("shiftleft", a, F.lit(WIDTH)) + b
    more = F.exists(F.slice("_size", F.lit(1), F.greatest(F.col("_top") - 3, F.lit(0))), lambda d: d != 0)
    df = df.withColumn("_upper", two(digit(0), digit(1)).cast("double"))
    df = df.withColumn("_lower", two(digit(2), digit(3)).bitwiseOR(more.cast("long")).cast("double"))
    value = F.col("_upper") * float(2 ** (2 * WIDTH)) + F.col("_lower")
    df = df.withColumn("_value", _scaled(value, (F.col("_low") + F.col("_top") - 3) * WIDTH))
    signed = F.when(F.col("_negative"), -F.col("_value")).otherwise(F.col("_value"))
    df = df.withColumn(name, F.when(F.col("_top") >= F.size("_size"), F.lit(0.0)).otherwise(signed))
    return df.drop("_low", "_high", "_dense", "_once", "_negative", "_size", "_top", "_upper", "_lower", "_value")


def finished(partials: DataFrame, keys: Sequence[str], name: str, *more: Column) -> DataFrame:
    """``keys`` and the exact sum, rounded once; ``more`` are further aggregates."""
    grouped = partials.groupBy(*keys).agg(
        F.collect_list(F.struct(BIN, *PARTS)).alias("_bins"), *[F.sum(c).alias(f"_{c}") for c in COUNTS], *more
    )
    grouped = _rounded(grouped, "_bins", "_sum")
    nan, above, below = (F.col(f"_{c}") > 0 for c in COUNTS[1:])
    total = (
        F.when(nan | (above & below), float("nan"))
        .when(above, float("inf"))
        .when(below, float("-inf"))
        .when(F.col("_n_values") > 0, F.col("_sum"))
    )
    return grouped.withColumn(name, total).drop("_sum", "_bins", *[f"_{c}" for c in COUNTS])


def exact_sum(df: DataFrame, keys: Sequence[str], column: str, name: str | None = None) -> DataFrame:
    """The sum of ``column`` per key: the same double whatever the partitioning."""
    return finished(partial(df, keys, column), keys, name or column)


def exact_sums(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Exact sums of several columns, by a join of the single ones on equal keys, nulls included."""
    single = [exact_sum(df, keys, c) for c in columns]
    return reduce(
        lambda a, b: a.join(
            b.toDF(*[f"_{k}" for k in keys], b.columns[-1]), [a[k].eqNullSafe(F.col(f"_{k}")) for k in keys]
        ).drop(*[f"_{k}" for k in keys]),
        single,
    )
