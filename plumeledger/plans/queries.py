"""Every operator as a query on the driver tables: (spark, sf_dir) -> DataFrame.

Queries with a counterpart in ``oracle`` return the same columns under the same names.
Sums of doubles are rounded to cents before anything is ranked by them.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import convert, display
from ..operators import lookups, ownership, presentation, ranking, rollups
from ..operators.keyed import latest_by_key, upsert
from ..operators.rollups import QUANTITY
from ..schemas import TABLES, conform_result
from ..sources.catalog import register
from ..sources.csv_files import REJECT, read_named_csv
from ..sources.ingest import KINDS, ingest, listing, load, load_report, split_rejects
from ..sources.layouts import join_bucketed, write_bucketed, write_with_blooms
from ..sources.tables import read_table, write_table
from ..sources.workspace import file_system, scratch_path, written
from ..streaming.incremental import ingest_stream
from . import changes, standins
from .analysis import ROLLUPS, run_analysis
from .standins import as_table, driver_table, rounded

Query = Callable[[SparkSession, str], DataFrame]

ISO = "EUROPE"
SECTOR = "ECONOMY"
SUBSECTOR = "PROMO"
YEAR = 1998
PARTIAL = 2001
SOURCE = 7
OWNERS = ("Customer#000000087", "Customer#000000269", "Customer#000000045")
FIRST_QUANTITY = 1e9
SOME_YEARS = (1996, 1998, 1999, 2050)
SECTORS = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- shared steps ------------------------------------------------------------


def _sector_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rollups.sector_year(standins.country(spark, sf_dir)))


def _source_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rollups.source_year(standins.sources(spark, sf_dir)))


def _controlling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ownership.controlling_parent(standins.facility_ownership(spark, sf_dir))


def _owner_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        ownership.owner_year(_source_years(spark, sf_dir), _controlling(spark, sf_dir))
    )


def _top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top_sources(_source_years(spark, sf_dir))


def _ship_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The years of all stand-ins, from one column instead of from a rollup."""
    return driver_table(spark, sf_dir, "lineitem").select(F.year("l_shipdate").alias("year"))


# --- rollups -----------------------------------------------------------------


@query
def sector_year_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sector_years(spark, sf_dir)


@query
def national_total_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rollups.national_total(_sector_years(spark, sf_dir)), "national_total")


@query
def source_year_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _source_years(spark, sf_dir)


@query
def source_year_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facilities placed by nation instead of supplier, so that a key has many variants; -1 is
    the place of those without position."""
    nation = F.coalesce(F.col("lat").cast("bigint"), F.lit(-1))
    sources = standins.sources(spark, sf_dir).withColumn("source_id", nation)
    return rollups.source_year_by_key(rounded(rollups.source_year(sources)))


@query
def owner_year_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _owner_years(spark, sf_dir)


@query
def latest_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = _source_years(spark, sf_dir)
    return years.agg(F.max("year").alias("latest_year"))


@query
def latest_year_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = _sector_years(spark, sf_dir)
    return years.filter(F.col("year") == rollups.latest(_ship_years(spark, sf_dir)))


@query
def top_sectors_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.latest_ranking(
        _sector_years(spark, sf_dir), ["iso3_country", "sector"], 20, years=_ship_years(spark, sf_dir)
    )


@query
def top_owners_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In the latest year in which any facility has an owner."""
    return ranking.latest_ranking(_owner_years(spark, sf_dir), ["owner"], 10)


@query
def top_facilities_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top_latest(
        _top(spark, sf_dir), SUBSECTOR, 10, years=_ship_years(spark, sf_dir)
    )


@query
def top_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top(spark, sf_dir)


@query
def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.row_counts(
        {
            "sector_year": _sector_years(spark, sf_dir),
            "source_year": _source_years(spark, sf_dir),
            "top_sources": _top(spark, sf_dir),
            "owner_year": _owner_years(spark, sf_dir),
        }
    )


# --- exact rollups: sums that do not depend on the order of addition, not rounded ---


@query
def sector_year_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = standins.sources(spark, sf_dir).select(
        F.col("subsector").alias("sector"), F.year("start_time").alias("year"), QUANTITY
    )
    return rollups.sector_year(lines.withColumn("iso3_country", F.lit(ISO)), exact=True)


@query
def national_total_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = standins.sources(spark, sf_dir).select(F.year("start_time").alias("year"), QUANTITY)
    return rollups.national_total(lines, exact=True)


@query
def source_year_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.source_year(standins.sources(spark, sf_dir), exact=True)


@query
def owner_year_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact totals of exact facility years."""
    years = rollups.source_year(standins.sources(spark, sf_dir), exact=True)
    return ownership.owner_year(years, _controlling(spark, sf_dir), exact=True)


# --- owners ------------------------------------------------------------------


@query
def controlling_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _controlling(spark, sf_dir)


@query
def owner_attribution_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ownership.attribute(_source_years(spark, sf_dir), _controlling(spark, sf_dir))


def _with_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facility years, and customers as further facilities, which nobody owns."""
    customers = driver_table(spark, sf_dir, "customer").select(
        F.lit("EXTRA").alias("subsector"),
        F.lit(YEAR).alias("year"),
        (F.col("c_custkey") + 1_000_000).alias("source_id"),
        F.col("c_name").alias("source_name"),
        F.lit(None).cast("double").alias("lat"),
        F.lit(None).cast("double").alias("lon"),
        F.col("c_acctbal").alias(QUANTITY),
    )
    return _source_years(spark, sf_dir).unionByName(customers)


@query
def unowned_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ownership.unowned_sources(_with_customers(spark, sf_dir), _controlling(spark, sf_dir))


@query
def with_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings exist for the months in which more than half of the possible quantity moved."""
    months = _months(spark, sf_dir)
    keys = ("subsector", "source_id", "start_time")
    ratings = (
        standins.sources(spark, sf_dir)
        .groupBy(*keys)
        .agg(F.max("activity").alias("most"))
        .select(*keys, F.when(F.col("most") > 40, "high").when(F.col("most") > 25, "medium").alias("activity"))
        .where("activity is not null")
    )
    rated = ownership.with_confidence(months, ratings, keys)
    return rated.select(*keys, "source_name", QUANTITY, "activity", "activity_confidence")


@query
def sources_with_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = ranking.top_sources(_with_customers(spark, sf_dir))
    return ownership.sources_with_owners(top, standins.ownership(spark, sf_dir))


# --- lookups -----------------------------------------------------------------


def _wanted_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookup parameters: the countries but one, and one that has no data."""
    names = F.explode(F.array(F.when(F.col("r_name") != ISO, F.col("r_name")), F.lit("NOWHERE")))
    return driver_table(spark, sf_dir, "region").select(names.alias("iso3_country")).dropna().distinct()


@query
def list_sectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.list_sectors(standins.country(spark, sf_dir), ISO)


@query
def list_sectors_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.list_sectors_for(standins.country(spark, sf_dir), _wanted_countries(spark, sf_dir))


@query
def list_subsectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.list_subsectors(standins.country(spark, sf_dir), SECTOR, ISO)


@query
def list_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.list_years(_sector_years(spark, sf_dir), ISO)


@query
def top_owners_of_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top_owners(_owner_years(spark, sf_dir), YEAR)


@query
def top_owners_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top_owners_by_year(_owner_years(spark, sf_dir))


@query
def owner_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.owner_trend(_owner_years(spark, sf_dir), OWNERS[0])


@query
def owner_trend_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trends of all owners in one market segment."""
    wanted = (
        driver_table(spark, sf_dir, "customer")
        .filter(F.col("c_mktsegment") == "BUILDING")
        .select(F.col("c_name").alias("owner"))
    )
    return lookups.owner_trend_for(_owner_years(spark, sf_dir), wanted)


@query
def sector_timeseries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.sector_timeseries(_sector_years(spark, sf_dir), ISO)


@query
def sector_timeseries_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.sector_timeseries_for(_sector_years(spark, sf_dir), _wanted_countries(spark, sf_dir))


@query
def sector_subsectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.sector_subsectors(standins.country(spark, sf_dir), SECTOR, ISO)


@query
def sector_subsectors_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    sectors = F.explode(F.array(*map(F.lit, SECTORS[1:]))).alias("sector")
    wanted = _wanted_countries(spark, sf_dir).select("iso3_country", sectors)
    return lookups.sector_subsectors_for(standins.country(spark, sf_dir), wanted)


@query
def top_of_subsector_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.top_of(_top(spark, sf_dir), SUBSECTOR, YEAR)


def _selections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookup parameters: all subsectors but one, in some of the years with data and one without."""
    part = driver_table(spark, sf_dir, "part").filter(F.col("p_type") != SUBSECTOR)
    years = F.explode(F.array(*map(F.lit, SOME_YEARS))).alias("year")
    return part.select(F.col("p_type").alias("subsector")).distinct().select("subsector", years)


@query
def top_of_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.top_of_for(_top(spark, sf_dir), _selections(spark, sf_dir))


@query
def points_of_subsector_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.points_of(_source_years(spark, sf_dir), SUBSECTOR, YEAR)


@query
def points_of_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.points_of_for(_source_years(spark, sf_dir), _selections(spark, sf_dir))


@query
def ownership_of_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.ownership_of(standins.ownership(spark, sf_dir), SUBSECTOR, SOURCE)


@query
def ownership_of_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parents of every top facility of a year."""
    wanted = (
        _top(spark, sf_dir)
        .filter(F.col("year") == YEAR)
        .select(F.col("subsector").alias("source_subsector"), "source_id")
    )
    return lookups.ownership_of_for(standins.ownership(spark, sf_dir), wanted)


def _months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly rows: one per key, as the table has them."""
    return latest_by_key(
        standins.sources(spark, sf_dir),
        ("subsector", "source_id", "start_time"),
        [F.desc(QUANTITY), F.desc("activity")],
    )


@query
def facility_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.facility_months(_months(spark, sf_dir), SUBSECTOR, SOURCE)


@query
def facility_months_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first months of every facility in every subsector but one."""
    part = driver_table(spark, sf_dir, "part")
    supplier = driver_table(spark, sf_dir, "supplier")
    subsectors = part.select(F.col("p_type").alias("subsector")).distinct()
    ids = F.col("s_suppkey").alias("source_id")
    wanted = supplier.select(ids, F.explode(F.array(*map(F.lit, SECTORS[1:]))).alias("subsector"))
    wanted = wanted.join(subsectors, "subsector", "left_semi")
    return lookups.facility_months_for(_months(spark, sf_dir), wanted)


# --- presentation ------------------------------------------------------------


@query
def sector_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presentation.pivot_clamped(sector_timeseries(spark, sf_dir), SECTORS)


@query
def sector_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = presentation.sector_share(sector_timeseries(spark, sf_dir))
    return rounded(rounded(shares, "total"), "share", 6)


@query
def sector_share_of_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = presentation.sector_share(sector_timeseries(spark, sf_dir), YEAR)
    return rounded(rounded(shares, "total"), "share", 6)


@query
def map_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = presentation.map_points(points_of_subsector_year(spark, sf_dir))
    return rounded(points, "radius", 6)


def _all_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The points of every subsector in every year that has any, and those without either, which
    no parameter finds."""
    years = _source_years(spark, sf_dir)
    found = lookups.points_of_for(years, years.select("subsector", "year"))
    unnamed = years.filter(F.col("subsector").isNull() | F.col("year").isNull())
    return found.unionByName(unnamed.select(*found.columns))


@query
def map_points_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(presentation.map_points_by(_all_points(spark, sf_dir)), "radius", 6)


@query
def selection_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = presentation.selection_summary(points_of_subsector_year(spark, sf_dir))
    return rounded(summary, "total")


@query
def selection_summary_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = _all_points(spark, sf_dir)
    return rounded(presentation.selection_summary(points, ("subsector", "year")), "total")


@query
def owner_trend_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presentation.owner_trend_compare(_owner_years(spark, sf_dir), OWNERS, PARTIAL)


@query
def owner_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    change = presentation.owner_change(_owner_years(spark, sf_dir), PARTIAL)
    return rounded(change, "change", 6)


@query
def default_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.default_owners(top_owners_of_year(spark, sf_dir))


@query
def fmt_tonnes(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = _source_years(spark, sf_dir).select(
        "subsector", "year", "source_id", QUANTITY, display.fmt_tonnes(QUANTITY).alias("shown")
    )
    lines = driver_table(spark, sf_dir, "lineitem").select(
        F.col("l_linestatus").alias("subsector"),
        F.lit(None).cast("int").alias("year"),
        F.col("l_orderkey").alias("source_id"),
        F.col("l_quantity").alias(QUANTITY),
        display.fmt_tonnes(F.col("l_quantity")).alias("shown"),
    )
    return totals.unionByName(lines)


@query
def pretty_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = driver_table(spark, sf_dir, "part")
    slug = F.concat_ws("-", F.replace("p_name", F.lit(" "), F.lit("-")), F.lit("o'clock_x"), "p_type")
    return part.select("p_partkey", display.pretty_label(slug).alias("label"))


@query
def category_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations among those with suppliers; the others get 0."""
    nation = driver_table(spark, sf_dir, "nation")
    used = nation.join(
        driver_table(spark, sf_dir, "supplier"), F.col("n_nationkey") == F.col("s_nationkey"), "left_semi"
    )
    return presentation.category_index(nation.select("n_name"), "n_name", used)


@query
def category_index_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order keys as text among those of orders not yet filled: very many values."""
    orders = driver_table(spark, sf_dir, "orders")
    keys = orders.select(F.col("o_orderkey").cast("string").alias("key"), "o_orderstatus")
    return presentation.category_index(keys, "key", keys.where("o_orderstatus <> 'F'")).drop("o_orderstatus")


@query
def display_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = driver_table(spark, sf_dir, "supplier")
    name = F.when(F.col("s_acctbal") >= 0, F.col("s_name"))
    return supplier.select(
        "s_suppkey",
        display.display_name(name).alias("shown"),
        display.display_name(name, "s_suppkey").alias("heading"),
    )


@query
def year_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    domain = presentation.year_domain(spark, 1994, 2005)
    return presentation.year_coverage(domain, _source_years(spark, sf_dir))


# --- conversions -------------------------------------------------------------


def _cells(df: DataFrame, keys: Sequence[str], texts: dict[str, Column]) -> DataFrame:
    """Text columns as a file would provide them, made once in a projection of their own."""
    return df.select(*keys, *[text.alias(name) for name, text in texts.items()])


@query
def convert_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = F.col("ts").cast("string")
    day, time = F.substring(whole, 1, 10), F.substring(whole, 12, 8)
    texts = {
        "fraction": whole,
        "seconds": F.concat(F.lit("  "), day, F.lit(" "), time, F.lit("\t")),
        "wide_gap": F.concat_ws("   ", day, time),
        "day": day,
        "short_day": F.concat_ws("-", F.year("ts"), F.month("ts"), F.day("ts")),
        "year_only": F.substring(whole, 1, 4),
        "zoned": F.concat(day, F.lit("T"), time, F.lit("Z")),
        "offset": F.concat(day, F.lit(" "), time, F.lit("+05:00")),
        "bad_month": F.concat(F.substring(whole, 1, 4), F.lit("-13-"), F.substring(whole, 9, 2)),
        "long_fraction": F.concat(day, F.lit(" "), time, F.lit(".1234567")),
    }
    cells = _cells(driver_table(spark, sf_dir, "events"), ["event_id"], texts)
    return cells.select("event_id", *[convert.parse_ts(n).alias(n) for n in texts])


@query
def convert_doubles(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    number = F.col("l_linenumber").cast("string")
    texts = {
        "plain": price,
        "padded": F.concat(F.lit(" \t"), price, F.lit(" \n")),
        "signed": F.concat(F.lit("+"), price),
        "exponent": F.concat(number, F.lit("e2")),
        "separated": F.concat(F.lit("1_00"), number),
        "suffixed": F.concat(price, F.lit("d")),
        "hexadecimal": F.concat(F.lit("0x"), number),
        "word": F.col("l_returnflag"),
        "blank": F.lit("  "),
    }
    open_line = F.col("l_linestatus") == "O"
    special = F.when(open_line, F.lit("-nan")).otherwise(F.lit("+Infinity"))
    keys = ["l_orderkey", "l_linenumber", "l_linestatus"]
    cells = _cells(
        driver_table(spark, sf_dir, "lineitem"), keys, texts | {"special": special}
    )
    return cells.select(
        *keys,
        *[convert.parse_double(n).alias(n) for n in texts],
        F.isnan(convert.parse_double("special")).alias("is_nan"),
        (convert.parse_double("special") == float("inf")).alias("is_infinite"),
    )


@query
def convert_longs(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    texts = {
        "id": F.col("l_orderkey").cast("string"),
        "id_as_float": F.concat(F.col("l_orderkey").cast("string"), F.lit(".0")),
        "cut": price,
        "cut_negative": F.concat(F.lit("-"), price),
        "exponent": F.concat(F.col("l_linenumber").cast("string"), F.lit("e3")),
        "nan": F.lit("nan"),
        "infinite": F.lit("inf"),
        "word": F.col("l_linestatus"),
    }
    cells = _cells(driver_table(spark, sf_dir, "lineitem"), ["l_partkey"], texts)
    return cells.select("l_partkey", *[convert.parse_long(n).alias(n) for n in texts])


@query
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = driver_table(spark, sf_dir, "documents")
    padded = F.concat(F.lit("\t  "), F.col("text"), F.lit(" \r\n "))
    return documents.select(
        "doc_id",
        convert.clean_text(padded).alias("text"),
        convert.clean_text(F.regexp_replace("lang", "[a-z]", " ")).alias("blank"),
    )


@query
def year_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.substring(F.col("o_orderdate").cast("string"), 1, 10)
    return driver_table(spark, sf_dir, "orders").select(
        "o_orderkey",
        convert.year_prefix(day).alias("day"),
        convert.year_prefix(F.substring(day, 1, 4)).alias("year_only"),
        convert.year_prefix(F.concat(F.lit(" "), day)).alias("padded"),
        convert.year_prefix(F.substring(day, 1, 3)).alias("short"),
        convert.year_prefix(F.col("o_orderpriority")).alias("word"),
    )


def _map_text(column: str) -> Column:
    entries = F.array_sort(F.map_entries(column))
    return F.array_join(
        F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";"
    )


@query
def pairs_to_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The third pair repeats the first key for large orders; the fourth has no key."""
    large = F.col("o_totalprice") > 250000
    pairs = driver_table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.lit("status").alias("other1_def"),
        F.col("o_orderstatus").alias("other1"),
        F.lit(" priority ").alias("other2_def"),
        F.col("o_orderpriority").alias("other2"),
        F.lit("status").alias("other3_def"),
        F.when(large, F.lit("large")).otherwise(F.lit(" ")).alias("other3"),
        F.lit(None).cast("string").alias("other4_def"),
        F.col("o_orderstatus").alias("other4"),
    )
    mapped = pairs.select("o_orderkey", convert.pairs_to_map(pairs.columns).alias("other"))
    return mapped.select("o_orderkey", _map_text("other").alias("other"))


# --- keyed rows and tables ---------------------------------------------------

LINE_KEY = ("l_orderkey", "l_linenumber")
LINE_ORDER = ("l_shipdate", "l_extendedprice")
LINE_TIES = ("l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_returnflag")


def _line_order() -> list[Column]:
    return [*map(F.desc, LINE_ORDER), *map(F.asc, LINE_TIES)]


@query
def latest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_by_key(driver_table(spark, sf_dir, "lineitem"), LINE_KEY, _line_order())


@query
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed lines as the table, open ones as the batch that replaces them by key."""
    lines = driver_table(spark, sf_dir, "lineitem")
    closed = latest_by_key(lines.filter(F.col("l_linestatus") == "F"), LINE_KEY, _line_order())
    return upsert(closed, lines.filter(F.col("l_linestatus") == "O"), LINE_KEY, _line_order())


def _monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_table(standins.sources(spark, sf_dir), "emissions_sources")


@query
def stored_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written with the positive rows, then upserted with the others."""
    root = scratch_path(spark, "tables")
    rows = _monthly(spark, sf_dir)
    positive = F.col(QUANTITY) > 0
    write_table(rows.filter(positive), root, "emissions_sources")
    write_table(rows.filter(~positive), root, "emissions_sources")
    stored = read_table(spark, root, "emissions_sources")
    return stored.select("subsector", "source_id", "start_time", "source_name", QUANTITY, "activity")


@query
def reload_many_directories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of very many directories, written whole and once more with the positive rows
    changed."""
    root = scratch_path(spark, "tables")
    place = F.coalesce(F.col("lat").cast("int").cast("string"), F.lit("none"))
    rows = _months(spark, sf_dir).withColumn("subsector", F.concat_ws("/", "subsector", place))
    rows = as_table(rows, "emissions_sources")
    write_table(rows, root, "emissions_sources")
    changed = rows.filter(F.col(QUANTITY) > 0).withColumn(QUANTITY, F.col(QUANTITY) * 2)
    write_table(changed, root, "emissions_sources")
    stored = read_table(spark, root, "emissions_sources")
    return stored.select("subsector", "source_id", "start_time", QUANTITY, "activity")


@query
def refresh_shrinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ranking of twenty, then of five: nothing of the first is left."""
    root = scratch_path(spark, "tables")
    years = _source_years(spark, sf_dir)
    for n in (20, 5):
        write_table(ranking.top_sources(years, n), root, "analysis_top_sources", mode="refresh")
    return read_table(spark, root, "analysis_top_sources")


#: Tables that a session has analysed already: (application, files) -> root.
_ROOTS: dict[tuple[str, tuple], str] = {}
#: Root -> rows that the batch job counted while it wrote them.
_WRITTEN: dict[str, dict[str, int]] = {}


def _files(spark: SparkSession, sf_dir: str) -> tuple:
    """Path, size and time of every data file of the driver tables."""
    found = []
    for pattern in ("*.parquet", "*.parquet/*.parquet"):
        path, files = file_system(spark, f"{sf_dir}/{pattern}")
        found += [(f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in files.globStatus(path) or []]
    return tuple(sorted(found))


def _analysed(spark: SparkSession, sf_dir: str) -> str:
    """The root of a set of tables, base and rollup, made once by the batch job for as long as
    the files stay the same; all ``stored_*`` queries share it."""
    held = (spark.sparkContext.applicationId, _files(spark, sf_dir))
    if held not in _ROOTS:
        _ROOTS[held] = _analyse(spark, sf_dir)
    return _ROOTS[held]


def _analyse(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_path(spark, "tables")
    write_table(as_table(standins.country(spark, sf_dir), "country_emissions"), root, "country_emissions")
    write_table(_monthly(spark, sf_dir), root, "emissions_sources")
    name = "emissions_sources_ownership"
    write_table(as_table(standins.ownership(spark, sf_dir), name), root, name)
    _WRITTEN[root] = run_analysis(spark, root)
    return root


@query
def analysis_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _analysed(spark, sf_dir)
    return rollups.row_counts({name: read_table(spark, root, name) for name in ROLLUPS})


@query
def analysis_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same counts, taken by the writes themselves."""
    counts = _WRITTEN[_analysed(spark, sf_dir)]
    return spark.createDataFrame(list(counts.items()), "table_name string, row_count long")


@query
def analysis_owner_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _analysed(spark, sf_dir)
    return rounded(read_table(spark, root, "analysis_owner_trend"))


def _batches(months: DataFrame) -> list[DataFrame]:
    """Facility months in three batches: the positive ones; the others, and some of the first
    doubled or renamed; and some of the first turned negative."""
    positive, activity = F.col(QUANTITY) > 0, F.col("activity")
    renamed = F.when(activity > 40, F.concat("source_name", F.lit(" (new)"))).otherwise(F.col("source_name"))
    doubled = months.where(positive & (activity > 25)).withColumns({QUANTITY: F.col(QUANTITY) * 2, "source_name": renamed})
    turned = months.where(positive & activity.between(10, 25)).withColumn(QUANTITY, -F.col(QUANTITY))
    return [months.where(positive), months.where(~positive).unionByName(doubled), turned]


@query
def incremental_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rollups after three batches, of which the second and third came as changes."""
    root = scratch_path(spark, "tables")
    first, *later = _batches(as_table(_months(spark, sf_dir), "emissions_sources"))
    write_table(first, root, "emissions_sources")
    name = "emissions_sources_ownership"
    write_table(as_table(standins.ownership(spark, sf_dir), name), root, name)
    changes.start(spark, root)
    for batch in later:
        changes.apply(spark, root, batch)
    rows = lambda name, *columns: read_table(spark, root, f"analysis_{name}").select(
        F.lit(name).alias("rollup"), *[F.expr(c) for c in columns], QUANTITY
    )
    return (
        rows("source_year", "subsector as label", "year", "source_id as number", "source_name as name")
        .unionByName(rows("top_sources", "subsector as label", "year", "cast(rank as bigint) as number", "source_name as name"))
        .unionByName(rows("owner_year", "owner as label", "year", "cast(source_count as bigint) as number", "'' as name"))
    )


# --- lookups on stored tables ------------------------------------------------


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, _analysed(spark, sf_dir), name)


@query
def stored_list_sectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.list_sectors(_table(spark, sf_dir, "country_emissions"), ISO)


@query
def stored_top_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ranking.top_owners(_table(spark, sf_dir, "analysis_owner_year"), YEAR)
    return rounded(conform_result(found, "owner_row"))


@query
def stored_owner_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the owner that leads the ranking of a year."""
    leader = ranking.top_owners(_table(spark, sf_dir, "analysis_owner_year"), YEAR, 1).first()
    owner = leader["owner"] if leader else ""
    found = lookups.owner_trend(_table(spark, sf_dir, "analysis_owner_trend"), owner)
    return rounded(conform_result(found, "owner_trend_point"))


@query
def stored_sector_timeseries(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lookups.sector_timeseries(_table(spark, sf_dir, "analysis_sector_year"), ISO)
    return rounded(conform_result(found, "sector_total"))


@query
def stored_sector_subsectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lookups.sector_subsectors(_table(spark, sf_dir, "country_emissions"), SECTOR, ISO)
    return conform_result(found, "subsector_row")


@query
def stored_top_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lookups.top_of(_table(spark, sf_dir, "analysis_top_sources"), SUBSECTOR, YEAR)
    return rounded(conform_result(found, "top_source"))


@query
def stored_points_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lookups.points_of(_table(spark, sf_dir, "analysis_source_year"), SUBSECTOR, YEAR)
    return rounded(conform_result(found, "source_point"))


@query
def stored_ownership_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lookups.ownership_of(_table(spark, sf_dir, "emissions_sources_ownership"), SUBSECTOR, SOURCE)
    return conform_result(found, "ownership_row")


@query
def stored_facility_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.facility_months(_table(spark, sf_dir, "emissions_sources"), SUBSECTOR, SOURCE)


@query
def sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookups as SQL text: one by one, and for many parameters by lateral joins."""
    register(spark, _analysed(spark, sf_dir))
    return spark.sql(
        f"""
        SELECT 'top_owners' AS lookup, owner AS label, source_count AS number, round(emissions_quantity, 2) AS quantity
        FROM top_owners_of({YEAR})
        UNION ALL SELECT 'timeseries', sector, year, round(emissions_quantity, 2) FROM timeseries_of('{ISO}')
        UNION ALL SELECT 'subsectors', subsector, year, round(emissions_quantity, 2) FROM subsectors_of('{SECTOR}', '{ISO}')
        UNION ALL SELECT 'sectors', sector, 0, 0.0D FROM sectors_of('{ISO}')
        UNION ALL SELECT 'months', date_format(start_time, 'yyyy-MM-dd'), cast(activity AS int), round(emissions_quantity, 2)
                  FROM months_of('{SUBSECTOR}', {SOURCE})
        UNION ALL SELECT 'owners', parent_name, {SOURCE}, coalesce(overall_share_percent, 0.0D)
                  FROM owners_of('{SUBSECTOR}', {SOURCE})
        UNION ALL SELECT 'trend', w.owner, t.year, round(t.emissions_quantity, 2)
                  FROM (SELECT owner FROM analysis_owner_year WHERE year = {YEAR}) w, LATERAL trend_of(w.owner) t
        UNION ALL SELECT 'points', w.subsector, cast(p.source_id AS int), round(p.emissions_quantity, 2)
                  FROM (SELECT DISTINCT subsector, year FROM analysis_top_sources) w, LATERAL points_of(w.subsector, w.year) p
        UNION ALL SELECT 'top', w.subsector, t.rank, 0.0D
                  FROM (SELECT DISTINCT subsector, year FROM analysis_top_sources) w, LATERAL top_of(w.subsector, w.year) t
        """
    )


# --- layouts: buckets and bloom filters ---


@query
def bucketed_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facility months with their owners, both sides stored in buckets of the facility."""
    tables = {}
    for label, df in {"months": standins.sources(spark, sf_dir), "owners": _controlling(spark, sf_dir)}.items():
        tables[label] = write_bucketed(
            df, f"pl_{label}_{uuid.uuid4().hex}", f"{scratch_path(spark, 'buckets')}/t", "source_id", 16
        )
    joined = join_bucketed(tables["months"], tables["owners"], "source_id")
    return joined.groupBy("owner", "source_id").agg(F.count("*").alias("rows"), F.max(QUANTITY).alias("largest"))


@query
def bloom_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All months of one facility from files that are sorted by subsector."""
    rows = standins.sources(spark, sf_dir).select("subsector", "source_id", "start_time", QUANTITY, "activity")
    rows = rows.repartitionByRange(8, "subsector").sortWithinPartitions("subsector")
    stored = write_with_blooms(rows, scratch_path(spark, "blooms") + "/t", ["source_id"], 100_000)
    return stored.where(F.col("source_id") == SOURCE)


# --- CSV files ---------------------------------------------------------------


def _csv_text(df: DataFrame) -> DataFrame:
    """All columns as the text a CSV file would have."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


#: Compressed part files cannot be split, so that a file's rows are what one task reads.
CSV_ROWS = 1_000_000


def _write_csv(df: DataFrame, entry: str) -> None:
    df.write.options(header=True, escape='"', compression="gzip", maxRecordsPerFile=CSV_ROWS).csv(entry)


def _source_files(spark: SparkSession, sf_dir: str) -> str:
    """Facility files with three headers: in order, in reverse, and one without gas.

    Names have quotes and a line break; ids are written as floats; one extra pair. Rows
    stand in order of key and quantity, so that the last row of a key is known. One more
    entry, whose name begins with an underscore and whose path comes first, has all rows with
    one large quantity; the positive rows have files that are a month old. An entry is a folder
    of compressed part files, because the plain text is more than twenty times as large.
    """
    root = scratch_path(spark, "csv")
    rows = standins.filled(standins.sources(spark, sf_dir), "emissions_sources").drop("other")
    ordered = ["subsector", "source_id", "start_time", QUANTITY, "activity"]

    def text(df: DataFrame) -> DataFrame:
        name = F.concat(F.lit('"'), F.col("source_name"), F.lit('",\nunit'))
        return _csv_text(df.orderBy(*ordered)).withColumns(
            {
                "source_id": F.concat("source_id", F.lit(".0")),
                "source_name": name,
                "other1": F.col("activity"),
                "other1_def": F.lit("load"),
            }
        )

    pattern = KINDS["emissions_sources"].pattern
    quantity = F.col(QUANTITY)
    for label, chosen in {"a": quantity > 0, "b": quantity < 0, "c": quantity == 0}.items():
        part = text(rows.filter(chosen))
        columns = {"a": part.columns, "b": part.columns[::-1], "c": [c for c in part.columns if c != "gas"]}
        _write_csv(part.select(*columns[label]), f"{root}/trade/{label}{pattern}1.csv")
    whole = text(rows.withColumn(QUANTITY, F.lit(FIRST_QUANTITY)))
    _write_csv(whole, f"{root}/trade/_first{pattern}1.csv")
    aged, files = file_system(spark, f"{root}/trade/a{pattern}1.csv/part-*")
    for status in files.globStatus(aged):
        files.setTimes(status.getPath(), status.getModificationTime() - 30 * 86_400_000, -1)
    return root


def _entry(column: str = "_file") -> Column:
    """The entry of the sector folder that a file is or belongs to."""
    return F.regexp_extract(column, "/trade/([^/]+)", 1)


@query
def ingest_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ingest(spark, _source_files(spark, sf_dir), "emissions_sources")["emissions_sources"]
    return rows.withColumn("other", _map_text("other")).select(
        _entry().alias("entry"), *TABLES["emissions_sources"].columns, F.col(REJECT).alias("reason")
    )


@query
def reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ingest(spark, _source_files(spark, sf_dir), "emissions_sources")["emissions_sources"]
    good, rejects = split_rejects(rows, "emissions_sources")
    return rollups.row_counts({"good": good, "rejects": rejects})


@query
def ingest_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "csv")
    day = F.make_date("year", F.lit(1), F.lit(1)).cast("timestamp_ntz")
    rows = standins.country(spark, sf_dir).withColumn("start_time", day)
    text = _csv_text(standins.filled(rows, "country_emissions").drop("year"))
    _write_csv(text, f"{root}/all/x{KINDS['country_emissions'].pattern}1.csv")
    loaded = ingest(spark, root, "country_emissions")["country_emissions"]
    return loaded.select(*TABLES["country_emissions"].columns)


@query
def ingest_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings stay words, even where they are blank or look like numbers."""
    root = scratch_path(spark, "csv")
    labels = driver_table(spark, sf_dir, "labels")
    documents = driver_table(spark, sf_dir, "documents").select("doc_id", "lang")
    rows = labels.join(documents, "doc_id").select(
        F.col("lang").alias("subsector"),
        F.col("doc_id").alias("source_id"),
        F.lit("2015-01-01").cast("timestamp_ntz").alias("start_time"),
        F.when(F.col("quality") == 1, F.lit(" high ")).otherwise(F.lit(" ")).alias("activity"),
        F.col("toxic").cast("string").alias("capacity"),
    )
    text = _csv_text(standins.filled(rows, "emissions_sources_confidence"))
    _write_csv(text, f"{root}/all/x{KINDS['confidence'].pattern}1.csv")
    loaded = ingest(spark, root, "confidence")["confidence"]
    return loaded.select(*TABLES["emissions_sources_confidence"].columns)


@query
def ingest_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parents with a negative balance have no id in the files."""
    root = scratch_path(spark, "csv")
    known = F.col("overall_share_percent").isNotNull()
    rows = standins.ownership(spark, sf_dir).withColumn(
        "parent_entity_id", F.when(known, F.col("parent_entity_id"))
    )
    text = _csv_text(standins.filled(rows, "emissions_sources_ownership"))
    _write_csv(text, f"{root}/all/x{KINDS['ownership'].pattern}1.csv")
    loaded = ingest(spark, root, "ownership")["ownership"]
    return loaded.select(*TABLES["emissions_sources_ownership"].columns)


@query
def csv_load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _source_files(spark, sf_dir)
    by_entry = {kind: rows.withColumn("_file", _entry()) for kind, rows in ingest(spark, root).items()}
    names = {kind: sorted({p.split("/trade/")[1].split("/")[0] for p in paths}) for kind, paths in listing(spark, root).items()}
    return load_report(by_entry, names).withColumnRenamed("_file", "entry")


@query
def csv_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds by list, one of them unknown, and only files whose path names an entry."""
    frames = ingest(spark, _source_files(spark, sf_dir), "ownership, emissions_sources, nonsense", "/trade/b_")
    return rollups.row_counts(frames)


@query
def csv_rejects_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects of a set of files that is loaded twice: they are listed once."""
    root, csv_root = scratch_path(spark, "tables"), _source_files(spark, sf_dir)
    for _ in range(2):
        load(spark, csv_root, root, "emissions_sources")
    rejects = spark.read.parquet(f"{root}/_rejects/emissions_sources")
    return rejects.groupBy(_entry().alias("entry"), F.col(REJECT).alias("reason")).agg(F.count("*").alias("rows"))


@query
def csv_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files to table by the batch loader; the last file wins a key."""
    root = scratch_path(spark, "tables")
    load(spark, _source_files(spark, sf_dir), root, "emissions_sources")
    return _loaded(spark, root)


@query
def stream_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by the streaming loader, in several batches."""
    root = scratch_path(spark, "tables")
    running = ingest_stream(
        spark,
        _source_files(spark, sf_dir),
        "emissions_sources",
        root,
        scratch_path(spark, "stream"),
        max_files=7,
    )
    running.awaitTermination()
    return _loaded(spark, root)


@query
def stream_continuous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A loader that stays on: the positive rows are there when it starts, the others come later."""
    root, csv_root, checkpoint = (scratch_path(spark, label) for label in ("tables", "csv", "stream"))
    pattern = KINDS["emissions_sources"].pattern
    with written(_months(spark, sf_dir), "months") as staged:
        months = _csv_text(standins.filled(staged.rows, "emissions_sources").drop("other"))
        positive = F.col(QUANTITY).cast("double") > 0
        _write_csv(months.where(positive), f"{csv_root}/trade/a{pattern}1.csv")
        # No name of an entry yet: nothing finds these before they are renamed.
        _write_csv(months.where(~positive), f"{csv_root}/later")
    running = ingest_stream(spark, csv_root, "emissions_sources", root, checkpoint, continuous="1 second")

    def wait(batches: int) -> None:
        path, files = file_system(spark, f"{checkpoint}/done")
        while running.exception() is None and not (files.exists(path) and len(files.listStatus(path)) >= batches):
            time.sleep(0.2)

    wait(1)
    # Part files appear together, as a whole folder.
    path, files = file_system(spark, f"{csv_root}/later")
    files.rename(path, file_system(spark, f"{csv_root}/trade/b{pattern}1.csv")[0])
    wait(2)
    running.stop()
    if running.exception() is not None:
        raise running.exception()
    return _loaded(spark, root)


@query
def csv_line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts, with their line breaks and quotes, in one CSV file that is split when read."""
    root = scratch_path(spark, "csv")
    # The writer trims cells, so they are trimmed before.
    text = F.regexp_replace("text", r"^[\x00-\x20]+|[\x00-\x20]+$", "").alias("text")
    texts = driver_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), text, "lang")
    texts = texts.where("text <> ''")
    texts.coalesce(1).write.options(header=True, escape='"').csv(f"{root}/whole")
    found, files = file_system(spark, f"{root}/whole/part-*")
    paths = [f.getPath().toString() for f in files.globStatus(found)]
    rows = read_named_csv(spark, paths, ["doc_id", "lang", "text"])
    return rows.select("doc_id", "lang", F.md5(F.col("text").cast("binary")).alias("text_md5"))


def _loaded(spark: SparkSession, root: str) -> DataFrame:
    stored = read_table(spark, root, "emissions_sources")
    return stored.select("subsector", "source_id", "start_time", "source_name", QUANTITY, "activity")
