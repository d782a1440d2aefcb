"""The batch job: base tables in, the five rollup tables out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.ownership import controlling_parent, owner_year
from ..operators.ranking import latest_ranking, top_latest, top_sources
from ..operators.rollups import (
    national_total,
    row_counts,
    sector_year,
    source_year,
    source_year_by_key,
)
from ..sources.tables import read_table, write_owner_tables, write_table
from ..sources.workspace import written

ROLLUPS = (
    "analysis_sector_year",
    "analysis_source_year",
    "analysis_top_sources",
    "analysis_owner_year",
    "analysis_owner_trend",
)


def run_analysis(spark: SparkSession, root: str) -> dict[str, int]:
    """Compute and refresh all rollups; table -> rows, counted while they were written.

    The facility rollup feeds three results and is written once to scratch in between; the
    stored table cannot serve, because it keeps one row per key where the rankings and the
    owner counts see every variant of a renamed or moved facility.
    """
    country = read_table(spark, root, "country_emissions")
    counts = {"analysis_sector_year": write_table(sector_year(country), root, "analysis_sector_year", mode="refresh")}

    sources = read_table(spark, root, "emissions_sources")
    ownership = read_table(spark, root, "emissions_sources_ownership")
    with written(source_year(sources), "source-year") as stage:
        facilities = stage.rows
        name = "analysis_source_year"
        counts[name] = write_table(source_year_by_key(facilities), root, name, mode="refresh")
        name = "analysis_top_sources"
        counts[name] = write_table(top_sources(facilities), root, name, mode="refresh")
        counts |= write_owner_tables(owner_year(facilities, controlling_parent(ownership)), root)
    return counts


def reports(
    spark: SparkSession, root: str, subsector: str = "electricity-generation"
) -> dict[str, DataFrame]:
    """The summaries of a run, from the stored rollups."""
    tables = {name: read_table(spark, root, name) for name in ROLLUPS}
    sectors, owners = tables["analysis_sector_year"], tables["analysis_owner_year"]
    return {
        "national total by year": national_total(sectors),
        "top sectors, latest year": latest_ranking(sectors, ["iso3_country", "sector"], 20),
        f"top {subsector} facilities, latest year": top_latest(
            tables["analysis_top_sources"], subsector
        ),
        "top owners, latest year": latest_ranking(owners, ["owner"], 10),
        "rows written": row_counts(tables),
    }
