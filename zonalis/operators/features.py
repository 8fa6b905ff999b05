"""Calendar, lag, trailing, drought and urbanization features of a panel.

A panel holds one row per zone and month, so a zone's window partition is bounded by the
calendar (12 rows a year), however many zones or raw readings there are. For series with
a finer grain see ``blocks.on_blocks``, which cuts a series into bounded pieces.
All windows share one specification, so Spark plans one shuffle and one sort for them.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonalis.functions import fixed
from zonalis.functions import measures as m
from zonalis.operators.selection import running_start

SERIES = ("zone",)


def series(keys=SERIES):
    return Window.partitionBy(*keys).orderBy("date")


def trailing(rows: int, keys=SERIES):
    return series(keys).rowsBetween(-(rows - 1), 0)


def encode_soil(panel: DataFrame, column: str = "soil_type") -> DataFrame:
    """Alphabetical index of a small vocabulary (the soil types)."""
    vocabulary = panel.agg(F.array_sort(F.collect_set(column))).scalar()
    return panel.withColumn(f"{column}_enc", (F.array_position(vocabulary, F.col(column)) - 1).cast("int"))


def one_hot_zone(panel: DataFrame) -> DataFrame:
    """Sparse one-hot: the ``slot`` of the row's zone in name order, of ``slots`` in all.

    A row without a zone has no slot. The order is kept by range partitions, so zones are never
    listed on the driver, whatever their number.
    """
    names = panel.select("zone").filter(F.col("zone").isNotNull()).distinct().withColumn("one", F.lit(1))
    ranked = running_start(names, ["zone"], "one", "slot").drop("one")
    total = names.agg(F.count(F.lit(1))).scalar()
    return panel.join(ranked, "zone", "left").withColumn("slots", total)


def add_calendar(panel: DataFrame) -> DataFrame:
    month = F.month("date")
    return panel.select(
        "*",
        F.year("date").alias("year"),
        month.alias("month"),
        m.month_sin(month).alias("month_sin"),
        m.month_cos(month).alias("month_cos"),
        m.season(month).alias("season"),
        m.is_monsoon(month).alias("is_monsoon"),
    )


def add_lags(panel: DataFrame, keys=SERIES) -> DataFrame:
    over = series(keys)
    columns = []
    for k in fixed.LAG_STEPS:
        columns.append(F.lag("groundwater_level", k).over(over).alias(f"gw_lag_{k}"))
        columns.append(F.lag("rainfall_mm", k).over(over).alias(f"rain_lag_{k}"))
    return panel.select("*", *columns)


def add_trailing_means(panel: DataFrame, keys=SERIES) -> DataFrame:
    columns = []
    for k in fixed.ROLLING_WINDOWS:
        columns.append(F.avg("rainfall_mm").over(trailing(k, keys)).alias(f"rain_roll_mean_{k}"))
        columns.append(F.avg("temperature_c").over(trailing(k, keys)).alias(f"temp_roll_mean_{k}"))
    return panel.select("*", *columns)


def add_trailing_std(panel: DataFrame, keys=SERIES, lagged: bool = False) -> DataFrame:
    """Sample std of the level; one row gives 0. ``lagged`` leaves the current row out."""
    columns = []
    for k in fixed.ROLLING_WINDOWS:
        frame = series(keys).rowsBetween(-k, -1) if lagged else trailing(k, keys)
        spread = F.stddev_samp("groundwater_level").over(frame)
        columns.append(F.coalesce(spread, F.lit(0.0)).alias(f"gw_roll_std_{k}"))
    return panel.select("*", *columns)


def climatology(panel: DataFrame) -> DataFrame:
    """Rain mean and sample std per calendar month: twelve rows at most."""
    return panel.groupBy(F.month("date").alias("month")).agg(
        F.avg("rainfall_mm").alias("rain_monthly_mean"),
        F.stddev_samp("rainfall_mm").alias("rain_monthly_std"),
    )


def join_climatology(panel: DataFrame, fit_on: DataFrame | None = None) -> DataFrame:
    stats = climatology(panel if fit_on is None else fit_on)
    keyed = panel if "month" in panel.columns else panel.withColumn("month", F.month("date"))
    # twelve rows: safe to broadcast at any scale
    return keyed.join(F.broadcast(stats), "month", "left")


def add_drought(panel: DataFrame, fit_on: DataFrame | None = None) -> DataFrame:
    """Rain z-score within the calendar month; a zero std counts as 1, a null one stays null."""
    spread = F.col("rain_monthly_std")
    safe = F.when(spread == 0, F.lit(1.0)).otherwise(spread)
    joined = join_climatology(panel, fit_on)
    spi = (F.col("rainfall_mm") - F.col("rain_monthly_mean")) / safe
    return joined.withColumn("spi", spi).drop("rain_monthly_mean", "rain_monthly_std")


def population_range(panel: DataFrame):
    return panel.agg(
        F.struct(
            F.min("population_density").alias("low"), F.max("population_density").alias("high")
        )
    ).scalar()


def add_urbanization(panel: DataFrame, fit_on: DataFrame | None = None) -> DataFrame:
    ends = population_range(panel if fit_on is None else fit_on)
    share = (F.col("population_density") - ends["low"]) / (ends["high"] - ends["low"] + 1e-9)
    return panel.withColumn(
        "urbanization_index", m.urbanization(F.col("urban_fraction"), share, F.col("ndvi"))
    )


def add_physics(panel: DataFrame) -> DataFrame:
    recharge = m.darcy_recharge(
        F.col("rainfall_mm"), F.col("soil_permeability"), F.col("urban_fraction")
    )
    return panel.withColumn("darcy_recharge", recharge).withColumn(
        "water_balance",
        m.water_balance(F.col("darcy_recharge"), F.col("evapotranspiration"), F.col("urban_fraction")),
    )


def drop_incomplete(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.na.drop(subset=columns) if columns else df.na.drop()


def fill_missing(df: DataFrame, columns: list[str], value: float = 0.0) -> DataFrame:
    return df.na.fill(value, subset=columns)


def align_features(df: DataFrame, trained: list[str], keep: list[str] = ()) -> DataFrame:
    """Trained columns in trained order; a missing one is 0."""
    present = set(df.columns)
    aligned = [F.col(f"`{c}`") if c in present else F.lit(0).alias(c) for c in trained]
    return df.select(*keep, *aligned)


def add_window_features(panel: DataFrame, keys=SERIES) -> DataFrame:
    """Lags, trailing means and trailing std: one shuffle and one sort."""
    return add_trailing_std(add_trailing_means(add_lags(panel, keys), keys), keys)


def engineer(
    panel: DataFrame, fit_on: DataFrame | None = None, windows=add_window_features
) -> DataFrame:
    """The whole feature chain; rows without a full history are dropped.

    For series that are too long for one task pass ``windows=blocks.window_features``.

    ``zone`` stays a column and its one-hot form is made at model assembly, so the schema
    does not depend on the data.
    """
    return (
        panel.transform(encode_soil)
        .transform(add_calendar)
        .transform(windows)
        .transform(add_drought, fit_on)
        .transform(add_urbanization, fit_on)
        .transform(drop_incomplete)
    )
