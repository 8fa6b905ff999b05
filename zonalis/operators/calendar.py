"""Month spines and regular grids."""

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from zonalis.functions import measures as m

MONTH = "interval 1 month"


def months_between(df: DataFrame, low: str, high: str, out: str = "date") -> DataFrame:
    """One row per month from ``low`` to ``high`` of each input row."""
    spine = F.explode(F.sequence(F.col(low), F.col(high), F.expr(MONTH)))
    return df.withColumn(out, spine).drop(*({low, high} - {out}))


def zone_spine(panel: DataFrame) -> DataFrame:
    """Every month between a zone's first and last reading."""
    ends = panel.groupBy("zone").agg(F.min("date").alias("low"), F.max("date").alias("high"))
    return months_between(ends, "low", "high")


def fill_gaps(panel: DataFrame, value: str = "groundwater_level") -> DataFrame:
    """Regular monthly series with linear interpolation between readings.

    A reading emits its own month and the missing months up to the next reading, so no
    spine join is needed: one shuffle by zone. Months before the first non-null reading
    stay null, months after the last one carry it.
    """
    zone = Window.partitionBy("zone")
    ordered = zone.orderBy("date")
    series = panel.select("zone", "date", F.col(value).alias("value")).select(
        "*",
        F.min("date").over(zone).alias("first_date"),
        F.max("date").over(zone).alias("last_date"),
        F.count("value").over(zone).alias("known"),
    )
    anchors = series.filter(
        F.col("value").isNotNull() | ((F.col("known") == 0) & (F.col("date") == F.col("first_date")))
    ).select(
        "*",
        F.lead("date").over(ordered).alias("next_date"),
        F.lead("value").over(ordered).alias("next_value"),
        F.lag("date").over(ordered).isNull().alias("leads"),
    )
    start = F.when(F.col("leads"), F.col("first_date")).otherwise(F.col("date"))
    stop = F.when(F.col("next_date").isNull(), F.col("last_date")).otherwise(
        F.add_months("next_date", -1)
    )
    months = anchors.withColumn("month", F.explode(F.sequence(start, stop, F.expr(MONTH))))
    step = m.month_index(F.col("month")) - m.month_index(F.col("date"))
    gap = m.month_index(F.col("next_date")) - m.month_index(F.col("date"))
    filled = (
        F.when(F.col("month") < F.col("date"), F.lit(None))
        .when(F.col("next_date").isNull() | (step == 0), F.col("value"))
        .otherwise(F.col("value") + (F.col("next_value") - F.col("value")) * step / gap)
    )
    return months.select(
        "zone",
        F.col("month").cast("date").alias("date"),
        filled.alias(value),
        (F.col("month") != F.col("date")).cast("int").alias("filled"),
    )
