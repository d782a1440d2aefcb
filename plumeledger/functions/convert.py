"""Null-safe conversion of CSV text cells.

Every function takes and returns a Column, stays inside code generation and never
raises on bad input: what cannot be converted becomes null. Spark's own casts are
laxer than the formats wanted here in some places ("2015" as a timestamp, "1.5d" as
a number) and stricter in others ("1_000"), hence a pattern in front of each
``try_cast``. The result depends neither on the ANSI mode nor on the session zone.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space (every character that counts as such in Unicode, and the
# four ASCII separators) and the accepted text forms.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
GAP = f"[{SPACES}]"
DIGITS = "[0-9](?:_?[0-9])*+"
TIMESTAMP = (
    rf"^{GAP}*(?!0000)[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}"
    rf"(?:{GAP}+[0-9]{{1,2}}:[0-9]{{1,2}}:[0-9]{{1,2}}(?:\.[0-9]{{1,6}})?)?{GAP}*\z"
)
NUMBER = (
    rf"^{GAP}*[+-]?(?:{DIGITS}(?:\.(?:{DIGITS})?)?|\.{DIGITS})(?:[eE][+-]?{DIGITS})?{GAP}*\z"
)
NAN = rf"(?i)^{GAP}*[+-]?nan{GAP}*\z"
INFINITE = rf"(?i)^{GAP}*[+-]?inf(?:inity)?{GAP}*\z"
YEAR_PREFIX = r"^[0-9]{4}"
# Common forms that the cast alone gets right, whether it accepts or refuses them.
PLAIN_TIMESTAMP = r"^[1-9][0-9]{3}-[0-9]{2}-[0-9]{2}(?: [0-9]{2}:[0-9]{2}:[0-9]{2})?\z"
PLAIN_NUMBER = r"^[-.0-9]+\z"
# Text with no white space at either end: trimming looks every character up in ``SPACES``.
PLAIN_TEXT = r"\A[!-~](?s:.*[!-~])?\z"


def _column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _trimmed(col: Column) -> Column:
    return F.btrim(col, F.lit(SPACES))


def clean_text(col: Column | str) -> Column:
    """Trim all outer white space; blank becomes null."""
    cell = _column(col)
    return F.when(cell.rlike(PLAIN_TEXT), cell).otherwise(F.nullif(_trimmed(cell), F.lit("")))


# Most cells have a plain form, which one cheap pattern recognises; the others are put
# into a form that the cast understands. Only what matches is cast: a failing cast costs
# far more than a pattern.


def parse_ts(col: Column | str) -> Column:
    """Date, or date and time with up to six fraction digits, as TIMESTAMP_NTZ."""
    cell = _column(col)
    spaced = F.regexp_replace(_trimmed(cell), f"{GAP}+", " ")
    return F.when(cell.rlike(PLAIN_TIMESTAMP), cell.try_cast("timestamp_ntz")).when(
        cell.rlike(TIMESTAMP), spaced.try_cast("timestamp_ntz")
    )


def parse_double(col: Column | str) -> Column:
    """Decimal text as DOUBLE; "nan", "inf" and digit separators are accepted."""
    cell = _column(col)
    bare = F.replace(_trimmed(cell), F.lit("_"), F.lit(""))
    infinity = float("inf")
    return (
        F.when(cell.rlike(PLAIN_NUMBER), cell.try_cast("double"))
        .when(cell.rlike(NUMBER), bare.try_cast("double"))
        .when(cell.rlike(NAN), F.lit(float("nan")))
        .when(cell.rlike(INFINITE), F.when(cell.contains("-"), -infinity).otherwise(infinity))
    )


def parse_long(col: Column | str) -> Column:
    """Number text as BIGINT, cut toward zero; NaN and infinities become null."""
    return parse_double(col).try_cast("bigint")


def year_prefix(col: Column | str) -> Column:
    """The first four characters as INT if all are digits; the text is not trimmed."""
    text = _column(col)
    return F.when(text.rlike(YEAR_PREFIX), F.substring(text, 1, 4).try_cast("int"))


def pairs_to_map(columns: Collection[str], n: int = 10) -> Column:
    """Fold ``otherK_def`` / ``otherK`` (K = 1..n) into one MAP<STRING, STRING>.

    ``columns`` lists the columns at hand, since any pair may be absent. A pair counts
    when both sides are non-blank; of a repeated key the last pair wins; without any
    pair the map is null.
    """
    present = [k for k in range(1, n + 1) if {f"other{k}", f"other{k}_def"} <= set(columns)]
    if not present:
        return F.lit(None).cast("map<string,string>")
    pairs = F.filter(
        F.array(
            *[
                F.struct(
                    clean_text(f"other{k}_def").alias("key"),
                    clean_text(f"other{k}").alias("value"),
                )
                for k in present
            ]
        ),
        lambda p: p["key"].isNotNull() & p["value"].isNotNull(),
    )

    def last_wins(found: Column) -> Column:
        # map_from_entries refuses repeated keys: drop an entry that has its key again later.
        def again(p: Column, i: Column) -> Column:
            later = F.slice(found, i + F.lit(2), F.lit(len(present)))
            return F.exists(later, lambda q: q["key"] == p["key"])

        kept = F.filter(found, lambda p, i: ~again(p, i))
        return F.when(F.size(found) > 0, F.map_from_entries(kept))

    # As a lambda variable the pairs are built once per row, not once per mention.
    return F.transform(F.array(pairs), last_wins)[0]
