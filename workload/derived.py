"""Taxi trips and zones derived from the order tables, as FIXTURES.md section 3 lays out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quaymill.functions.columns import month_key
from quaymill.operators.dimensions import broadcast_if_small


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _hits(column: str, divisor: int) -> Column:
    return F.col(column) % divisor == 0


def _cents(column: str) -> Column:
    return F.round(F.col(column) * 100).cast("bigint")


def _money(cents: Column) -> Column:
    return cents / F.lit(100.0)


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source columns and ``source_month``; one order in fifty has its rows twice.

    The narrow tables are joined first, so that the line items are shuffled once, by order.
    """
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    placed = orders.join(customers, orders.o_custkey == customers.c_custkey)
    placed = placed.select("o_orderkey", "o_orderdate", "c_nationkey")
    joined = lines.join(placed, lines.l_orderkey == placed.o_orderkey).join(
        broadcast_if_small(suppliers), lines.l_suppkey == suppliers.s_suppkey
    )

    part = "l_partkey"
    start = (F.col("l_orderkey") % 24 * 60 + F.col(part) % 60).cast("int")
    length = (
        F.when(_hits(part, 67), -5)
        .when(_hits(part, 71), 1441)
        .when(_hits(part, 73), 1440)
        .otherwise(F.col("l_quantity").cast("int") + 3)
    )
    fare_cents = _cents("l_extendedprice")
    fare = _money(fare_cents)
    joined = joined.withColumns(
        {"fare_c": fare_cents, "off_pct": _cents("l_discount"), "tax_pct": _cents("l_tax")}
    )
    copies = F.when(_hits("l_orderkey", 50), F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    order_day = F.col("o_orderdate")
    derived = joined.select(
        (F.col("l_suppkey") % 2 + 1).cast("int").alias("VendorID"),
        F.when(~_hits(part, 307), F.timestamp_add("MINUTE", start, order_day)).alias(
            "tpep_pickup_datetime"
        ),
        F.timestamp_add("MINUTE", start + length, order_day).alias("tpep_dropoff_datetime"),
        F.when(_hits(part, 29), None)
        .when(_hits(part, 151), 10)
        .otherwise(F.col("l_linenumber"))
        .alias("passenger_count"),
        F.when(_hits(part, 89), None)
        .when(_hits(part, 83), 0.0)
        .when(_hits(part, 79), 200.5)
        .otherwise(F.col("l_quantity") / 2)
        .alias("trip_distance"),
        (F.col("l_linenumber") % 6 + 1).alias("RatecodeID"),
        F.when(F.col("l_returnflag") == "R", "Y").otherwise("N").alias("store_and_fwd_flag"),
        F.when(_hits(part, 211), 999)
        .when(_hits(part, 223), None)
        .otherwise(F.col("c_nationkey"))
        .alias("PULocationID"),
        F.when(_hits(part, 227), 999).otherwise(F.col("s_nationkey")).alias("DOLocationID"),
        (F.col("l_linenumber") % 5).alias("payment_type"),
        F.when(_hits(part, 97), -fare).when(_hits(part, 103), None).otherwise(fare).alias(
            "fare_amount"
        ),
        F.lit(0.5).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        _money(F.expr("fare_c * off_pct div 100")).alias("tip_amount"),
        F.lit(0.0).alias("tolls_amount"),
        F.lit(1.0).alias("improvement_surcharge"),
        _money(F.expr("fare_c * (100 + tax_pct) div 100")).alias("total_amount"),
        F.lit(2.5).alias("congestion_surcharge"),
        (F.col("l_linenumber") % 3 * F.lit(1.25)).alias("Airport_fee"),
        month_key(
            F.when(_hits(part, 61), F.timestamp_add("DAY", F.lit(40), order_day)).otherwise(order_day)
        ).alias("source_month"),
        F.explode(copies).alias("copy"),
    )
    return derived.drop("copy")


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trips with audit columns whose values do not change from run to run."""
    return trips(spark, sf_dir).withColumns(
        {
            "source_file": F.lit("lineitem.parquet"),
            "batch_id": F.lit("derived"),
            "source_system": F.lit("parquet"),
        }
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    return nations.join(regions, nations.n_regionkey == regions.r_regionkey).select(
        F.col("n_nationkey").cast("string").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.lit("derived").alias("service_zone"),
    )
