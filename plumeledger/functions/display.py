"""Numbers and names as a dashboard shows them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def served(col: Column | str) -> Column:
    """A quantity as lookups return it: null becomes 0."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(0.0))


def _nearest(x: Column, digits: int) -> Column:
    """The integer n with n / 10**digits nearest to the exact value of x >= 0, halves up.

    n is the largest integer with 2n - 1 <= 2 * 10**digits * x. For one digit 20x is
    16x + 4x, whose rounding error is recovered exactly, so that a double such as 1.45
    (really 1.4499...) goes down as its binary value says.
    """
    if digits == 0:
        high, low = x * 2, F.lit(0.0)
    else:
        a, b = x * 16, x * 4
        high = a + b
        back = high - a
        low = (a - (high - back)) + (b - back)
    n = F.floor((high + 1) / 2)
    return n - F.when((high - (n * 2 - 1).cast("double")) + low < 0, 1).otherwise(0)


def _fixed(x: Column, digits: int) -> Column:
    """x with a fixed number of decimals (0 or 1).

    The steps mention their input many times; as lambda variables they are small code.
    """
    nearest = F.transform(F.array(F.abs(x)), lambda v: _nearest(v, digits))
    text = F.transform(nearest, lambda n: F.format_string(f"%.{digits}f", n / 10**digits))
    return F.concat(F.when(x < 0, F.lit("-")).otherwise(F.lit("")), text[0])


def fmt_tonnes(col: Column | str) -> Column:
    """1234567 -> "1.2 Mt", -4560 -> "-4.6 kt", 999 -> "999 t"."""
    t = (F.col(col) if isinstance(col, str) else col).cast("double")
    size = F.abs(t)
    infinite = F.concat(F.when(t < 0, F.lit("-")).otherwise(F.lit("")), F.lit("Infinity Mt"))
    return (
        F.when(F.isnan(t), F.lit("NaN t"))
        .when(size == float("inf"), infinite)
        .when(size >= 1e6, F.concat(_fixed(t / 1e6, 1), F.lit(" Mt")))
        .when(size >= 1e3, F.concat(_fixed(t / 1e3, 1), F.lit(" kt")))
        .when(size >= 0, F.concat(_fixed(t, 0), F.lit(" t")))
    )


def pretty_label(col: Column | str) -> Column:
    """Hyphens to blanks and every word start upper-cased; the rest stays as it is.

    Word characters are ASCII letters, digits and underscore.
    """
    text = F.replace(F.col(col) if isinstance(col, str) else col, F.lit("-"), F.lit(" "))
    runs = F.regexp_extract_all(text, F.lit(r"(\w+|\W+)"), F.lit(1))
    return F.array_join(
        F.transform(
            runs,
            lambda run: F.when(
                run.rlike("^[a-z]"),
                F.concat(F.upper(F.substring(run, 1, 1)), F.substr(run, F.lit(2))),
            ).otherwise(run),
        ),
        "",
    )


def display_name(name: Column | str, source_id: Column | str | None = None) -> Column:
    """The name; without one "Unknown", or "Source <id>" where an id is given."""
    name = F.col(name) if isinstance(name, str) else name
    if source_id is None:
        return F.coalesce(name, F.lit("Unknown"))
    source_id = F.col(source_id) if isinstance(source_id, str) else source_id
    return F.coalesce(name, F.concat(F.lit("Source "), source_id.cast("string")))
