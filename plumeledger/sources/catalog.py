"""The stored tables and the lookups by name, for queries written as SQL text.

``register`` makes a temporary view of every stored table, and a temporary SQL table function
of every lookup. The functions are SQL themselves: Spark puts their bodies into the plan of
the query, so that parameters prune directories and row groups as they do in the DataFrame
forms, and ``LATERAL`` joins answer many lookups in one job:

    SELECT * FROM top_owners_of(2023) LIMIT 25
    SELECT w.*, t.* FROM wanted w, LATERAL top_of(w.subsector, w.year) t

Functions give rows without an order; a query that needs one has an ``ORDER BY``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..schemas import TABLES
from .tables import read_table, table_exists

_ZERO = "coalesce(emissions_quantity, 0.0D)"

#: Function -> (parameters, columns, the table it reads, what it selects of it).
FUNCTIONS: dict[str, tuple[str, str, str, str]] = {
    "sectors_of": (
        "country STRING",
        "sector STRING",
        "country_emissions",
        "SELECT DISTINCT sector FROM {table} WHERE iso3_country = sectors_of.country",
    ),
    "top_owners_of": (
        "in_year INT",
        "owner STRING, emissions_quantity DOUBLE, source_count INT",
        "analysis_owner_year",
        f"SELECT owner, {_ZERO}, source_count FROM {{table}} WHERE year = top_owners_of.in_year",
    ),
    "trend_of": (
        "of_owner STRING",
        "year INT, emissions_quantity DOUBLE, source_count INT",
        "analysis_owner_trend",
        f"SELECT year, {_ZERO}, source_count FROM {{table}} WHERE owner = trend_of.of_owner",
    ),
    "subsectors_of": (
        "of_sector STRING, country STRING",
        "subsector STRING, year INT, emissions_quantity DOUBLE",
        "country_emissions",
        f"SELECT subsector, year, {_ZERO} FROM {{table}} "
        "WHERE sector = subsectors_of.of_sector AND iso3_country = subsectors_of.country",
    ),
    "timeseries_of": (
        "country STRING",
        "year INT, sector STRING, emissions_quantity DOUBLE",
        "analysis_sector_year",
        f"SELECT year, sector, {_ZERO} FROM {{table}} WHERE iso3_country = timeseries_of.country",
    ),
    "top_of": (
        "of_subsector STRING, in_year INT",
        "rank INT, source_id BIGINT, source_name STRING, lat DOUBLE, lon DOUBLE, emissions_quantity DOUBLE",
        "analysis_top_sources",
        f"SELECT rank, source_id, source_name, lat, lon, {_ZERO} FROM {{table}} "
        "WHERE subsector = top_of.of_subsector AND year = top_of.in_year",
    ),
    "points_of": (
        "of_subsector STRING, in_year INT",
        "source_id BIGINT, source_name STRING, lat DOUBLE, lon DOUBLE, emissions_quantity DOUBLE",
        "analysis_source_year",
        f"SELECT source_id, source_name, lat, lon, {_ZERO} FROM {{table}} "
        "WHERE subsector = points_of.of_subsector AND year = points_of.in_year",
    ),
    "months_of": (
        "of_subsector STRING, facility BIGINT",
        "start_time TIMESTAMP_NTZ, emissions_quantity DOUBLE, activity DOUBLE, capacity DOUBLE",
        "emissions_sources",
        "SELECT start_time, emissions_quantity, activity, capacity FROM {table} "
        "WHERE subsector = months_of.of_subsector AND source_id = months_of.facility",
    ),
    "owners_of": (
        "of_subsector STRING, facility BIGINT",
        "parent_name STRING, overall_share_percent DOUBLE, ownership_path STRING",
        "emissions_sources_ownership",
        "SELECT parent_name, overall_share_percent, ownership_path FROM {table} "
        "WHERE source_subsector = owners_of.of_subsector AND source_id = owners_of.facility",
    ),
}


def register(spark: SparkSession, root: str) -> list[str]:
    """Views of the tables under ``root`` and functions on those that exist; their names.

    Views stay on the snapshots of this moment: register again after a write.
    """
    names = [name for name in TABLES if table_exists(spark, root, name)]
    for name in names:
        read_table(spark, root, name).createOrReplaceTempView(name)
    made = []
    for name, (parameters, columns, table, body) in FUNCTIONS.items():
        if table in names:
            spark.sql(
                f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE ({columns}) "
                f"RETURN {body.format(table=table)}"
            )
            made.append(name)
    return [*names, *made]
