"""Scenario projections from each zone's last state."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.functions import fixed
from zonalis.functions import measures as m
from zonalis.operators.summaries import annual_trend, last_state

STATE = ["rainfall_mm", "temperature_c", "urban_fraction", "soil_permeability", "groundwater_level"]


def project(panel: DataFrame, n_years: int = 30, scenarios=fixed.SCENARIOS) -> DataFrame:
    """n years x 12 months under every scenario for every zone.

    Scenarios, years and months are exploded from each zone's one state row: no join, no
    shuffle beyond the last-state aggregate. The months of a year are alike.
    """
    params = [
        F.struct(
            F.lit(name).alias("scenario"),
            F.lit(rain).alias("rainfall_delta"),
            F.lit(temp).alias("temp_delta"),
            F.lit(urban).alias("urban_delta"),
        )
        for name, rain, temp, urban in scenarios
    ]
    base_year = panel.agg(F.max(F.year("date"))).scalar()
    y = F.col("y")
    years = (
        last_state(panel, STATE)
        .withColumn("s", F.explode(F.array(*params)))
        .withColumn("y", F.explode(F.sequence(F.lit(1), F.lit(n_years))))
    )
    rain = F.col("rainfall_mm") * (1 + F.col("s.rainfall_delta"))
    temp = F.col("temperature_c") + F.col("s.temp_delta")
    urban = F.col("urban_fraction") + F.col("s.urban_delta") * y / n_years
    drivers = years.select(
        "zone",
        "y",
        "s.scenario",
        "soil_permeability",
        "groundwater_level",
        rain.alias("rain"),
        temp.alias("temp"),
        F.when(urban > 1.0, F.lit(1.0)).otherwise(urban).alias("urban"),
    )
    recharge = (1 - F.col("urban")) * F.col("soil_permeability") * F.col("rain") * 0.01
    extraction = 0.08 + F.col("urban") * 0.3
    change = -recharge + extraction + (F.col("temp") - 25) * 0.003
    level = m.bounded(F.col("groundwater_level") + change * y * 0.05, 0.5, 40.0)
    return drivers.select(
        "zone",
        (base_year + y).cast("int").alias("year"),
        F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month"),
        "scenario",
        m.rounded(F.col("rain"), 2).alias("rainfall_proj"),
        m.rounded(F.col("temp"), 2).alias("temp_proj"),
        m.rounded(F.col("urban"), 3).alias("urban_proj"),
        m.rounded(level, 3).alias("gw_level_proj"),
    )


def against_history(panel: DataFrame, n_years: int = 30) -> DataFrame:
    """Annual mean level per zone: each scenario and the history, under cleaned labels."""
    projected = (
        project(panel, n_years)
        .groupBy("zone", "scenario", "year")
        .agg(F.avg("gw_level_proj").alias("gw_level"))
        .withColumn("scenario", m.spaced(F.col("scenario")))
    )
    history = annual_trend(panel).withColumn("scenario", F.lit("Historical"))
    return projected.unionByName(history)


def growth_trends(panel: DataFrame) -> DataFrame:
    """Observed yearly change of population and urban share per zone, by least squares over the years."""
    year = F.year("date") - 1995  # small numbers keep the sums exact
    return panel.groupBy("zone").agg(
        F.regr_slope("population_density", year).alias("population_per_year"),
        F.regr_slope("urban_fraction", year).alias("urban_per_year"),
    )


def covariate_lines(panel: DataFrame) -> DataFrame:
    """Per zone, the line of evapotranspiration on temperature and of ndvi on the urban share."""
    return panel.groupBy("zone").agg(
        F.regr_slope("evapotranspiration", "temperature_c").alias("et_slope"),
        F.regr_intercept("evapotranspiration", "temperature_c").alias("et_intercept"),
        F.regr_slope("ndvi", "urban_fraction").alias("ndvi_slope"),
        F.regr_intercept("ndvi", "urban_fraction").alias("ndvi_intercept"),
    )
