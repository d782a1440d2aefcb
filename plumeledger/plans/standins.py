"""Facility data in the shape of the keyed tables, made from the driver tables.

The driver tables hold no emissions, so suppliers act as facilities, part types as
subsectors (and sectors), regions as countries and customers as parent companies. Signed
quantities, null positions, null and tied shares occur. ``oracle`` has the same in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rollups import QUANTITY
from ..schemas import TABLES


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, column: str = QUANTITY, digits: int = 2) -> DataFrame:
    """Round away the summation order, so that equal totals compare as equal."""
    return df.withColumn(column, F.round(column, digits))


def _signed_price() -> Column:
    price = F.col("l_extendedprice")
    return (
        F.when(F.col("l_returnflag") == "R", -price)
        .when(F.col("l_returnflag") == "A", price)
        .otherwise(F.lit(0.0))
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return driver_table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "l_shipdate",
        _signed_price().alias("price"),
    )


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facility rows; no position where the supplier's balance is negative."""
    part = driver_table(spark, sf_dir, "part")
    supplier = driver_table(spark, sf_dir, "supplier")
    lat = F.when(F.col("s_acctbal") >= 0, F.col("s_nationkey").cast("double"))
    return (
        _lines(spark, sf_dir)
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.col("p_type").alias("subsector"),
            F.col("l_suppkey").alias("source_id"),
            F.col("l_shipdate").alias("start_time"),
            F.col("s_name").alias("source_name"),
            lat.alias("lat"),
            F.col("s_acctbal").alias("lon"),
            F.col("price").alias(QUANTITY),
            F.col("l_quantity").alias("activity"),
            F.lit(None).cast("double").alias("capacity"),
        )
    )


def country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annual totals per country, sector and subsector; about half of the sectors negative."""
    part = driver_table(spark, sf_dir, "part")
    supplier = driver_table(spark, sf_dir, "supplier")
    nation = driver_table(spark, sf_dir, "nation")
    region = driver_table(spark, sf_dir, "region")
    places = (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("s_suppkey", "r_name")
    )
    return (
        _lines(spark, sf_dir)
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(places, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy(
            F.col("r_name").alias("iso3_country"),
            F.col("p_type").alias("sector"),
            F.col("p_brand").alias("subsector"),
            F.year("l_shipdate").alias("year"),
            F.lit("co2").alias("gas"),
        )
        .agg(F.round(F.sum("price"), 2).alias(QUANTITY))
    )


def ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers served by a supplier as its parents, sharing by quantity.

    The key is (source_subsector, source_id, parent_entity_id). Shares are whole numbers,
    so ties occur; a negative balance makes the share null.
    """
    part = driver_table(spark, sf_dir, "part")
    orders = driver_table(spark, sf_dir, "orders")
    customer = driver_table(spark, sf_dir, "customer")
    supplier = driver_table(spark, sf_dir, "supplier")
    nation = driver_table(spark, sf_dir, "nation")
    held = (
        _lines(spark, sf_dir)
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("p_type", "l_suppkey", "o_custkey")
        .agg(F.sum("l_quantity").alias("quantity"))
    )
    return (
        held.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("p_type").alias("source_subsector"),
            F.col("l_suppkey").alias("source_id"),
            F.col("c_custkey").cast("string").alias("parent_entity_id"),
            F.col("c_name").alias("parent_name"),
            F.col("c_mktsegment").alias("parent_entity_type"),
            F.col("n_name").alias("parent_registration_country"),
            F.when(F.col("c_acctbal") >= 0, F.col("quantity")).alias("overall_share_percent"),
            F.col("s_name").alias("immediate_source_owner"),
            F.concat_ws(" -> ", "s_name", "c_name").alias("ownership_path"),
        )
    )


def facility_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ownership`` over all subsectors: one row per facility and parent."""
    orders = driver_table(spark, sf_dir, "orders")
    customer = driver_table(spark, sf_dir, "customer")
    held = (
        _lines(spark, sf_dir)
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("l_suppkey", "o_custkey")
        .agg(F.sum("l_quantity").alias("quantity"))
    )
    return held.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("l_suppkey").alias("source_id"),
        F.col("c_custkey").cast("string").alias("parent_entity_id"),
        F.col("c_name").alias("parent_name"),
        F.when(F.col("c_acctbal") >= 0, F.col("quantity")).alias("overall_share_percent"),
    )


def as_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` with the columns of a table that it lacks as nulls, in declared order."""
    return df.select(
        *[
            (F.col(c) if c in df.columns else F.lit(None)).cast(kind).alias(c)
            for c, kind in TABLES[name].columns.items()
        ]
    )


def filler(name: str, column: str) -> str | None:
    """SQL, the same for both engines, of what ``filled`` puts into a column."""
    kind, place = TABLES[name].columns[column], list(TABLES[name].columns).index(column)
    day = f"2020-01-{place + 1:02d} 10:20:30"
    return {
        "string": f"'{column}, \"{place}\"'",
        "double": f"cast({place}.25 as double)",
        "bigint": f"cast({place} as bigint)",
        "int": str(place),
        "timestamp_ntz": f"cast('{day}' as timestamp)",
    }.get(kind)


def filled(df: DataFrame, name: str) -> DataFrame:
    """``df`` with the columns of a table that it lacks, each with a value of its own."""
    columns = []
    for c, kind in TABLES[name].columns.items():
        value = F.col(c) if c in df.columns else F.expr((filler(name, c) or "null").replace("as timestamp)", "as timestamp_ntz)"))
        columns.append(value.cast(kind).alias(c))
    return df.select(*columns)
