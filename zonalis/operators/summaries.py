"""Dashboard queries: summaries, counts, profiles and lists."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonalis.functions import fixed
from zonalis.functions import measures as m
from zonalis.operators.selection import at_latest_date, in_year, latest_date, running_start

MEASURES = [
    "rainfall_mm",
    "temperature_c",
    "evapotranspiration",
    "ndvi",
    "population_density",
    "urban_fraction",
    "groundwater_level",
    "latitude",
    "longitude",
    "is_coastal",
    "soil_permeability",
    "risk_code",
]


def modal_risk(column: str = fixed.RISK) -> Column:
    """Most frequent code, ties to the smallest, 1 for none; at most three codes are held."""
    return F.coalesce(F.mode(column, True), F.lit(1)).cast("int")


def zone_summary(panel: DataFrame, year: int | None = None) -> DataFrame:
    """Position, mean level, rain and urban share and modal risk per zone."""
    rows = at_latest_date(panel) if year is None else in_year(panel, year)
    return (
        rows.groupBy("zone")
        .agg(
            F.min("latitude").alias("latitude"),
            F.min("longitude").alias("longitude"),
            F.avg("groundwater_level").alias("gw_level"),
            modal_risk().alias("risk_code"),
            F.avg("rainfall_mm").alias("rainfall"),
            F.avg("urban_fraction").alias("urban_frac"),
        )
        .withColumn("risk_label", m.risk_label(F.col("risk_code")))
    )


def annual_trend(panel: DataFrame) -> DataFrame:
    return panel.groupBy("zone", F.year("date").alias("year")).agg(
        F.avg("groundwater_level").alias("gw_level")
    )


def annual_pivot(panel: DataFrame, years: list[int]) -> DataFrame:
    """Zone by year: a row per zone, whatever their number, and a column per given year."""
    return annual_trend(panel).groupBy("zone").pivot("year", years).agg(F.max("gw_level"))


def seasonal_profile(panel: DataFrame) -> DataFrame:
    return panel.groupBy("zone", F.month("date").alias("month")).agg(
        F.avg("groundwater_level").alias("gw_level")
    )


def kpis(panel: DataFrame) -> DataFrame:
    """Latest mean level, zones at high risk, row count and zone count in one pass."""
    latest = F.col("date") == latest_date(panel)
    return panel.agg(
        F.avg(F.when(latest, F.col("groundwater_level"))).alias("latest_mean_level"),
        F.count(F.when(latest & (F.col("risk_code") == 2), 1)).alias("high_risk_zones"),
        F.count(F.lit(1)).alias("records"),
        F.countDistinct("zone").alias("zones"),
    )


def risk_distribution(panel: DataFrame) -> DataFrame:
    """Counts and shares at the latest date for every label, zero where none."""
    latest = at_latest_date(panel)
    counted = latest.agg(
        *[F.count(F.when(F.col("risk_level") == label, 1)).alias(label) for label in fixed.RISK_LABELS]
    )
    items = [
        F.struct(F.lit(i).alias("risk_code"), F.lit(label).alias("risk_level"), F.col(label).alias("n"))
        for i, label in enumerate(fixed.RISK_LABELS)
    ]
    total = sum(F.col(label) for label in fixed.RISK_LABELS)
    return counted.select(total.alias("total"), F.explode(F.array(*items)).alias("item")).select(
        "item.*", F.coalesce(F.try_divide(F.col("item.n") * 100.0, "total"), F.lit(0.0)).alias("percent")
    )


def rain_level_corr(panel: DataFrame) -> DataFrame:
    return panel.groupBy("zone").agg(
        F.corr("rainfall_mm", "groundwater_level").alias("pearson_r"), F.count(F.lit(1)).alias("n")
    )


def zone_year_risk(panel: DataFrame, year: int) -> DataFrame:
    return (
        in_year(panel, year)
        .groupBy("zone")
        .agg(F.avg("groundwater_level").alias("gw_mean"), modal_risk().alias("risk_code"))
        .withColumn("risk_label", m.risk_label(F.col("risk_code")))
    )


def last_state(panel: DataFrame, columns: list[str]) -> DataFrame:
    """Per zone and column the last value that is not null: partial aggregates, no sort."""
    latest = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("date"))).alias(c) for c in columns]
    return panel.groupBy("zone").agg(*latest)


def zone_snapshot(panel: DataFrame) -> DataFrame:
    """Latest rows under their display names and formats."""
    shown = lambda c, d: F.format_string(f"%.{d}f", m.rounded(F.col(c), d))
    return at_latest_date(panel).select(
        F.col("zone").alias("Zone"),
        shown("groundwater_level", 2).alias("GW Level (m)"),
        F.col("risk_level").alias("Risk"),
        shown("rainfall_mm", 1).alias("Rainfall (mm)"),
        shown("temperature_c", 1).alias("Temp (C)"),
        shown("urban_fraction", 2).alias("Urban Frac"),
    )


def exact_quantiles(df: DataFrame, columns: list[str], probabilities: list[float]) -> DataFrame:
    """Interpolated quantiles of whole columns without gathering a column in one task.

    Values are counted first, so a hot value becomes one row; the counts are then summed
    in range partitions, which gives each distinct value the range of ranks it covers. A
    quantile is read where its rank falls.
    """
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value")) for c in columns])
    )
    histogram = (
        df.select(pairs.alias("pair"))
        .select("pair.*")
        .filter(F.col("value").isNotNull())
        .groupBy("measure", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = running_start(histogram, ["measure", "value"], "n", "start")
    # one row per measure
    totals = ranked.groupBy("measure").agg(F.sum("n").alias("total"), F.min("start").alias("first"))
    wanted = F.explode(F.array(*[F.lit(float(p)) for p in probabilities]))
    target = F.col("p") * (F.col("total") - 1)
    goals = totals.withColumn("p", wanted).withColumn("target", target)
    low = F.col("start") - F.col("first")
    spots = ranked.join(F.broadcast(goals), "measure").select(
        "measure", "p", "value", "target", low.alias("low"), (low + F.col("n")).alias("high")
    )
    holds = lambda rank: (F.col("low") <= rank) & (rank < F.col("high"))
    floor, ceil = F.floor("target"), F.ceil("target")
    return (
        spots.filter(holds(floor) | holds(ceil))
        .groupBy("measure", "p")
        .agg(
            F.max(F.when(holds(floor), F.col("value"))).alias("a"),
            F.max(F.when(holds(ceil), F.col("value"))).alias("b"),
            F.max(F.col("target") - floor).alias("weight"),
        )
        .select(
            "measure", "p", (F.col("a") + (F.col("b") - F.col("a")) * F.col("weight")).alias("quantile")
        )
    )


def profile(panel: DataFrame, columns: list[str] = MEASURES) -> DataFrame:
    """One row per measure: count, mean, std, min, quartiles, max, with zones and dates."""
    facts = panel.agg(
        F.count(F.lit(1)).alias("panel_rows"),
        F.countDistinct("zone").alias("zones"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        *[
            F.struct(
                F.lit(c).alias("measure"),
                F.count(c).alias("count"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            ).alias(c)
            for c in columns
        ],
    )
    long = facts.select(
        "panel_rows", "zones", "first_date", "last_date", F.explode(F.array(*columns)).alias("item")
    ).select("panel_rows", "zones", "first_date", "last_date", "item.*")
    quartiles = exact_quantiles(panel, columns, [0.25, 0.5, 0.75])
    at = lambda p, name: F.max(F.when(F.col("p") == p, F.col("quantile"))).alias(name)
    wide = quartiles.groupBy("measure").agg(at(0.25, "q25"), at(0.5, "q50"), at(0.75, "q75"))
    return long.join(wide, "measure")


def union_panels(*panels: DataFrame) -> DataFrame:
    out = panels[0]
    for other in panels[1:]:
        out = out.unionByName(other)
    return out
