"""Panels derived from order lines: the raw readings behind every query.

A reading is one order line; its zone is the nation (or the customer) behind the order
and its month is the ship month. Sums run over whole hundredths as integers, so they do
not depend on the order of addition.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonalis.functions import measures as m
from zonalis.session import stage
from zonalis.sources.panel import PANEL_COLUMNS

READINGS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sum_of_hundredths(column: str) -> Column:
    return F.sum(F.rint(F.col(column) * 100).cast("long")).alias(f"sum_{column}")


def _mean(column: str) -> Column:
    return F.col(f"sum_{column}") / 100.0 / F.col("readings")


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.trunc("l_shipdate", "month").alias("date"), *READINGS
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("custkey")
    )
    return lines.join(orders, "l_orderkey")


def _rollup(readings: DataFrame, keys: list[str]) -> DataFrame:
    sums = [_sum_of_hundredths(c) for c in READINGS]
    return readings.groupBy(*keys, "date").agg(*sums, F.count(F.lit(1)).alias("readings"))


def zone_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("custkey"), F.col("c_nationkey").alias("k")
    )
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("k"), F.col("n_name").alias("zone")
    )
    readings = _order_lines(spark, sf_dir).join(customers, "custkey").join(nations, "k")
    return _rollup(readings, ["k", "zone"])


def customer_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = _order_lines(spark, sf_dir).withColumnRenamed("custkey", "k")
    keyed = _rollup(readings, ["k"])
    return keyed.withColumn("zone", F.concat(F.lit("C"), F.col("k").cast("string")))


def zone_dimension(keyed: DataFrame) -> DataFrame:
    """Static attributes of a zone from its integer key ``k``."""
    k = F.col("k")
    soil = F.element_at(F.array(*[F.lit(s) for s in _SOILS]), (k % 5 + 1).cast("int"))
    return keyed.select(
        "*",
        F.round(12.90 + 0.01 * ((k * 7) % 25), 3).cast("double").alias("latitude"),
        F.round(80.10 + 0.01 * ((k * 11) % 25), 3).cast("double").alias("longitude"),
        (k % 3 == 0).cast("int").alias("is_coastal"),
        soil.alias("soil_type"),
    )


_SOILS = ["Sandy", "Clayey", "Loamy", "Rocky", "Alluvial"]


def _moments(rollup: DataFrame) -> Column:
    """Mean and spread of the monthly price over the panel, as a scalar subquery."""
    price = _mean("l_extendedprice")
    return rollup.agg(F.struct(F.avg(price).alias("mean"), F.stddev_samp(price).alias("std"))).scalar()


def panel_from_rollup(rollup: DataFrame) -> DataFrame:
    """Measures of a rollup, built in layers, so each expression is planned and evaluated once.

    The level needs the mean and spread of the whole rollup, so a rollup that comes from raw
    tables is staged first: the raw tables are read once, and what follows reads a row per zone and
    month, with the columns and filters of the query pushed down.
    """
    moments = _moments(rollup)
    years = F.year("date") - 1995
    raw = zone_dimension(rollup).select(
        F.col("date").cast("date").alias("date"),
        "zone",
        "latitude",
        "longitude",
        "is_coastal",
        "soil_type",
        (8 * _mean("l_quantity")).alias("rain"),
        (22 + 200 * _mean("l_discount")).alias("temperature"),
        (0.1 + 0.03 * years + 5 * _mean("l_tax")).alias("urban"),
        (12000 * F.exp(0.03 * years / 5)).alias("population"),
        (15 + 6 * (_mean("l_extendedprice") - moments["mean"]) / moments["std"]).alias("level"),
    )
    clipped = raw.withColumns(
        {"urban": m.bounded(F.col("urban"), 0, 1), "level": m.bounded(F.col("level"), 1, 35)}
    )
    measured = clipped.select(
        "date",
        "zone",
        "latitude",
        "longitude",
        "is_coastal",
        "soil_type",
        m.soil_permeability(F.col("soil_type")).alias("soil_permeability"),
        m.rounded(F.col("rain"), 2).alias("rainfall_mm"),
        m.rounded(F.col("temperature"), 2).alias("temperature_c"),
        m.rounded(F.col("urban"), 3).alias("urban_fraction"),
        m.rounded(F.col("population"), 0).alias("population_density"),
        m.rounded(F.col("level"), 3).alias("groundwater_level"),
    )
    proxies = measured.withColumns(
        {
            "evapotranspiration": F.col("temperature_c") * 0.6,
            "ndvi": m.bounded(0.55 - F.col("urban_fraction") * 0.3, 0, 1),
            "risk_level": m.risk_level(F.col("groundwater_level")),
        }
    )
    return proxies.withColumns(
        {
            "evapotranspiration": m.rounded(F.col("evapotranspiration"), 2),
            "ndvi": m.rounded(F.col("ndvi"), 3),
            "risk_code": m.risk_code(F.col("risk_level")),
        }
    ).select(*PANEL_COLUMNS)


def zone_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per nation and month."""
    return panel_from_rollup(stage(zone_rollup(spark, sf_dir), "rollup"))


def customer_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer and month: many short, gappy series."""
    return panel_from_rollup(stage(customer_rollup(spark, sf_dir), "rollup"))


def event_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily mean event value per user, shaped as (zone, date, level)."""
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("zone"), F.to_date("ts").alias("date"), "value"
    )
    return (
        events.groupBy("zone", "date")
        .agg(_sum_of_hundredths("value"), F.count(F.lit(1)).alias("readings"))
        .select("zone", "date", _mean("value").alias("groundwater_level"))
    )
