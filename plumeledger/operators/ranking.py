"""Rankings. Every order is total, so equal quantities rank the same way in every run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.display import served
from ..schemas import TABLES
from .rollups import QUANTITY, latest

# Fixed value: the most rows that an owner ranking serves.
MAX_LIMIT = 200


def largest_first(column: str = QUANTITY) -> Column:
    """Descending, nulls last; NaN counts as larger than every number."""
    return F.desc_nulls_last(column)


def facility_order() -> list[Column]:
    return [
        largest_first(),
        F.asc("source_id"),
        F.asc("source_name"),
        F.asc("lat"),
        F.asc("lon"),
    ]


def checked_limit(limit: int) -> int:
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be between 1 and {MAX_LIMIT}, not {limit}")
    return limit


def top_sources(source_years: DataFrame, n: int = 20) -> DataFrame:
    """The n largest facilities of every subsector and year, ranked from 1.

    The filter stands directly above the window, so each map task passes on at most n
    rows per group and no task ever sorts a whole group.
    """
    group = Window.partitionBy("subsector", "year").orderBy(*facility_order())
    return (
        source_years.withColumn("rank", F.row_number().over(group))
        .filter(F.col("rank") <= n)
        .select(*TABLES["analysis_top_sources"].columns)
    )


def latest_ranking(
    df: DataFrame, by: Sequence[str], n: int, years: DataFrame | None = None
) -> DataFrame:
    """The n largest rows of the latest year; ``by`` names the columns that break ties: all
    of the key but the year, so that the order is total.

    ``years`` may name a cheaper frame with the same years, e.g. the input of a rollup.
    """
    newest = latest(df if years is None else years)
    ties = [F.asc(column) for column in by]
    return df.filter(F.col("year") == newest).orderBy(largest_first(), *ties).limit(n)


def top_latest(
    top: DataFrame, subsector: str, n: int = 10, years: DataFrame | None = None
) -> DataFrame:
    """The first n ranks of one subsector in the latest year of all subsectors."""
    newest = latest(top if years is None else years)
    return (
        top.filter((F.col("subsector") == subsector) & (F.col("year") == newest))
        .orderBy("rank")
        .limit(n)
    )


def top_owners(owner_years: DataFrame, year: int, limit: int = 25) -> DataFrame:
    """The largest owners of a year. A null total counts as 0, before ranking."""
    return (
        owner_years.filter(F.col("year") == year)
        .select("owner", served(QUANTITY).alias(QUANTITY), "source_count")
        .orderBy(F.desc(QUANTITY), F.asc("owner"))
        .limit(checked_limit(limit))
    )


def top_owners_by_year(
    owner_years: DataFrame, limit: int = 25, years: DataFrame | None = None
) -> DataFrame:
    """``top_owners`` for many years at once: all, or those in the ``year`` column of ``years``."""
    if years is not None:
        owner_years = owner_years.join(years.select("year").distinct(), "year", "left_semi")
    order = Window.partitionBy("year").orderBy(F.desc(QUANTITY), F.asc("owner"))
    return (
        owner_years.select("year", "owner", served(QUANTITY).alias(QUANTITY), "source_count")
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= checked_limit(limit))
        .orderBy("year", "rank")
    )


def default_owners(top: DataFrame, n: int = 3) -> DataFrame:
    """The owners preselected for comparison: the first n of a year's ranking."""
    return top.orderBy(F.desc(QUANTITY), F.asc("owner")).select("owner").limit(n)
