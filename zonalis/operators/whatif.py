"""Batch what-if scoring: request rows to feature vectors, levels and risks."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.functions import fixed
from zonalis.functions import measures as m
from zonalis.operators.features import population_range


def zone_attributes(panel: DataFrame) -> DataFrame:
    """Zone dimension (position and coast flag), one row per zone."""
    return panel.groupBy("zone").agg(
        F.min("latitude").alias("latitude"),
        F.min("longitude").alias("longitude"),
        F.min("is_coastal").alias("is_coastal"),
    )


def request_vector(requests: DataFrame, zones: DataFrame, train: DataFrame) -> DataFrame:
    """Features of (zone, soil, climate, year, month) requests, defaults for unknown history.

    The soil index is alphabetical and the population share uses the training range, as in
    the features the models were trained on.
    """
    ends = population_range(train)
    soils = F.array(*[F.lit(s) for s in sorted(fixed.SOIL_PERMEABILITY)])
    share = (F.col("population_density") - ends["low"]) / (ends["high"] - ends["low"] + 1e-9)
    month = F.col("month")
    lags = []
    for k in fixed.LAG_STEPS:
        lags.append(F.lit(fixed.WHATIF_LEVEL_LAG).alias(f"gw_lag_{k}"))
        lags.append((F.col("rainfall_mm") * fixed.WHATIF_RAIN_LAG_SHARE).alias(f"rain_lag_{k}"))
    rolls = []
    for k in fixed.ROLLING_WINDOWS:
        rolls.append(F.col("rainfall_mm").alias(f"rain_roll_mean_{k}"))
        rolls.append(F.col("temperature_c").alias(f"temp_roll_mean_{k}"))
        rolls.append(F.lit(fixed.WHATIF_LEVEL_STD).alias(f"gw_roll_std_{k}"))
    return requests.join(zones, "zone").select(
        "zone",
        "latitude",
        "longitude",
        "is_coastal",
        (F.array_position(soils, F.col("soil_type")) - 1).cast("int").alias("soil_type_enc"),
        m.soil_permeability(F.col("soil_type")).alias("soil_permeability"),
        "rainfall_mm",
        "temperature_c",
        "evapotranspiration",
        "ndvi",
        "population_density",
        "urban_fraction",
        "year",
        "month",
        m.month_sin(month).alias("month_sin"),
        m.month_cos(month).alias("month_cos"),
        m.season(month).alias("season"),
        m.is_monsoon(month).alias("is_monsoon"),
        F.lit(fixed.WHATIF_SPI).alias("spi"),
        m.urbanization(F.col("urban_fraction"), share, F.col("ndvi")).alias("urbanization_index"),
        *lags,
        *rolls,
    )


def echo(requests: DataFrame) -> DataFrame:
    """The request as a JSON text next to its key columns."""
    names = {
        "Zone": "zone",
        "Soil": "soil_type",
        "Rainfall_mm": "rainfall_mm",
        "Temperature_C": "temperature_c",
        "NDVI": "ndvi",
        "Urban_Fraction": "urban_fraction",
        "Month": "month",
        "Year": "year",
    }
    body = F.to_json(F.struct(*[F.col(c).alias(n) for n, c in names.items()]))
    return requests.select("zone", "year", "month", body.alias("request"))


def requests_from(panel: DataFrame) -> DataFrame:
    """Every panel row as a request: what if these conditions came again."""
    return panel.select(
        "zone",
        "soil_type",
        "rainfall_mm",
        "temperature_c",
        "evapotranspiration",
        "ndvi",
        "population_density",
        "urban_fraction",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
    )
