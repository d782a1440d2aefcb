"""The nine keyed tables, and two of state: columns, types, keys and storage layout.

A table's primary key is its partition columns followed by its cluster columns. Lookups
always name the partition columns, so these become directories (partition pruning); files
are range-split and sorted on the whole key, so that Parquet min/max statistics prune on
the cluster columns. High-cardinality keys such as ``owner`` never become directories.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Table:
    """One keyed table.

    ``derived`` are storage-only directory columns computed from key columns (name ->
    type and SQL expression). They split big partitions so that an upsert rewrites only
    what it touches; ``read_table`` does not return them.
    """

    columns: dict[str, str]
    partition: tuple[str, ...]
    cluster: tuple[str, ...]
    directories: tuple[str, ...]
    derived: dict[str, tuple[str, str]] = field(default_factory=dict)

    @property
    def key(self) -> tuple[str, ...]:
        return self.partition + self.cluster

    @property
    def storage_ddl(self) -> str:
        typed = self.columns | {name: kind for name, (kind, _) in self.derived.items()}
        return ", ".join(f"{name} {kind}" for name, kind in typed.items())

    def with_derived(self, df: DataFrame) -> DataFrame:
        return df.withColumns({name: F.expr(sql) for name, (_, sql) in self.derived.items()})


def _columns(**kinds: str) -> dict[str, str]:
    return kinds


_START_YEAR = {"start_year": ("int", "year(start_time)")}

_SUMS = dict.fromkeys(("high", "middle", "low", "n_values", "n_nan", "n_above", "n_below", "n_rows"), "bigint")

# Table names, column names, types and keys.
TABLES: dict[str, Table] = {
    "country_emissions": Table(
        columns=_columns(
            iso3_country="string",
            sector="string",
            subsector="string",
            year="int",
            gas="string",
            start_time="timestamp_ntz",
            end_time="timestamp_ntz",
            emissions_quantity="double",
            emissions_quantity_units="string",
            temporal_granularity="string",
            created_date="timestamp_ntz",
            modified_date="timestamp_ntz",
        ),
        partition=("iso3_country", "sector"),
        cluster=("subsector", "year", "gas"),
        directories=("iso3_country", "sector"),
    ),
    "emissions_sources": Table(
        columns=_columns(
            subsector="string",
            source_id="bigint",
            start_time="timestamp_ntz",
            end_time="timestamp_ntz",
            source_name="string",
            source_type="string",
            iso3_country="string",
            sector="string",
            lat="double",
            lon="double",
            geometry_ref="string",
            gas="string",
            emissions_quantity="double",
            temporal_granularity="string",
            activity="double",
            activity_units="string",
            emissions_factor="double",
            emissions_factor_units="string",
            capacity="double",
            capacity_units="string",
            capacity_factor="double",
            other="map<string,string>",
            created_date="timestamp_ntz",
            modified_date="timestamp_ntz",
        ),
        partition=("subsector",),
        cluster=("source_id", "start_time"),
        directories=("subsector", "start_year"),
        derived=_START_YEAR,
    ),
    "emissions_sources_confidence": Table(
        columns=_columns(
            subsector="string",
            source_id="bigint",
            start_time="timestamp_ntz",
            end_time="timestamp_ntz",
            source_name="string",
            iso3_country="string",
            sector="string",
            source_type="string",
            gas="string",
            capacity="string",
            capacity_factor="string",
            activity="string",
            emissions_factor="string",
            emissions_quantity="string",
            created_date="timestamp_ntz",
            modified_date="timestamp_ntz",
        ),
        partition=("subsector",),
        cluster=("source_id", "start_time"),
        directories=("subsector", "start_year"),
        derived=_START_YEAR,
    ),
    "emissions_sources_ownership": Table(
        columns=_columns(
            source_subsector="string",
            source_id="bigint",
            parent_entity_id="string",
            parent_name="string",
            parent_entity_type="string",
            parent_lei="string",
            parent_permid="string",
            parent_registration_country="string",
            parent_headquarter_country="string",
            overall_share_percent="double",
            ownership_path="string",
            immediate_source_owner="string",
            immediate_source_owner_entity_id="string",
            source_operator="string",
            source_operator_id="string",
            percentage_of_operation="double",
            source_name="string",
            source_sector="string",
            iso3_country="string",
        ),
        partition=("source_subsector",),
        cluster=("source_id", "parent_entity_id"),
        directories=("source_subsector",),
    ),
    "analysis_sector_year": Table(
        columns=_columns(
            iso3_country="string", year="int", sector="string", emissions_quantity="double"
        ),
        partition=("iso3_country",),
        cluster=("year", "sector"),
        directories=("iso3_country",),
    ),
    "analysis_source_year": Table(
        columns=_columns(
            subsector="string",
            year="int",
            source_id="bigint",
            source_name="string",
            lat="double",
            lon="double",
            emissions_quantity="double",
        ),
        partition=("subsector", "year"),
        cluster=("source_id",),
        directories=("subsector", "year"),
    ),
    "analysis_top_sources": Table(
        columns=_columns(
            subsector="string",
            year="int",
            rank="int",
            source_id="bigint",
            source_name="string",
            lat="double",
            lon="double",
            emissions_quantity="double",
        ),
        partition=("subsector", "year"),
        cluster=("rank",),
        directories=("subsector", "year"),
    ),
    "analysis_owner_year": Table(
        columns=_columns(
            year="int", owner="string", emissions_quantity="double", source_count="int"
        ),
        partition=("year",),
        cluster=("owner",),
        directories=("year",),
    ),
    "analysis_owner_trend": Table(
        columns=_columns(
            owner="string", year="int", emissions_quantity="double", source_count="int"
        ),
        partition=("owner",),
        cluster=("year",),
        directories=(),
    ),
    # Digits of exact sums, from which the rollups are kept up; see plans.changes.
    "state_source_year": Table(
        columns=_columns(
            subsector="string",
            year="int",
            source_id="bigint",
            variant="string",
            bin="int",
            source_name="string",
            lat="double",
            lon="double",
            **_SUMS,
        ),
        partition=("subsector", "year"),
        cluster=("source_id", "variant", "bin"),
        directories=("subsector", "year"),
    ),
    "state_owner_year": Table(
        columns=_columns(owner="string", year="int", bin="int", **_SUMS),
        partition=("year",),
        cluster=("owner", "bin"),
        directories=("year",),
    ),
}


# Shapes of lookup results; a trailing "?" marks columns that may be null.
RESULTS: dict[str, dict[str, str]] = {
    "sector_total": {"year": "int", "sector": "string", "emissions_quantity": "double"},
    "subsector_row": {"subsector": "string", "year": "int", "emissions_quantity": "double"},
    "source_point": {
        "source_id": "bigint",
        "source_name": "string?",
        "lat": "double?",
        "lon": "double?",
        "emissions_quantity": "double",
    },
    "top_source": {
        "rank": "int",
        "source_id": "bigint",
        "source_name": "string?",
        "lat": "double?",
        "lon": "double?",
        "emissions_quantity": "double",
    },
    "ownership_row": {
        "parent_name": "string?",
        "parent_entity_type": "string?",
        "parent_registration_country": "string?",
        "overall_share_percent": "double?",
        "immediate_source_owner": "string?",
        "ownership_path": "string?",
    },
    "owner_row": {"owner": "string", "emissions_quantity": "double", "source_count": "int"},
    "owner_trend_point": {"year": "int", "emissions_quantity": "double", "source_count": "int"},
}


def _conform(
    df: DataFrame, name: str, kinds: dict[str, str], filled: Sequence[str], keep: Sequence[str]
) -> DataFrame:
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    missing = [c for c in kinds if c not in found]
    if missing:
        raise ValueError(f"{name}: missing column(s) {', '.join(missing)}")
    wrong = [f"{c} is {found[c]}, not {kind}" for c, kind in kinds.items() if found[c] != kind]
    if wrong:
        raise ValueError(f"{name}: {'; '.join(wrong)}")
    if filled:
        # A filter leaves the columns as they are, and with them a partitioning by key.
        complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in filled])
        refuse = F.raise_error(F.lit(f"{name}: null in one of {', '.join(filled)}"))
        df = df.filter(F.when(complete, True).otherwise(refuse.cast("boolean")))
    return df.select(*kinds, *keep)


def conform(df: DataFrame, name: str, keep: Sequence[str] = ()) -> DataFrame:
    """``df`` as exactly the declared columns of a table, in order (and those to ``keep``).

    Missing columns and wrong types are refused at once. A null key makes the query that
    reads the result fail: the check rides along as a filter, without an extra pass.
    """
    table = TABLES[name]
    return _conform(df, name, table.columns, table.key, keep)


def conform_result(df: DataFrame, name: str) -> DataFrame:
    """``df`` as the columns of a lookup result, with the same checks."""
    declared = RESULTS[name]
    kinds = {c: kind.rstrip("?") for c, kind in declared.items()}
    filled = [c for c, kind in declared.items() if not kind.endswith("?")]
    return _conform(df, name, kinds, filled, ())
