"""Filters, splits and folds."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonalis.functions import fixed
from zonalis.session import stage


def latest_date(df: DataFrame) -> Column:
    return df.agg(F.max("date")).scalar()


def at_latest_date(df: DataFrame) -> DataFrame:
    return df.filter(F.col("date") == latest_date(df))


def in_year(df: DataFrame, year: int) -> DataFrame:
    """A date range, so the filter reaches the Parquet scan."""
    first, after = f"{year:04d}-01-01", f"{year + 1:04d}-01-01"
    return df.filter(
        (F.col("date") >= F.lit(first).cast("date")) & (F.col("date") < F.lit(after).cast("date"))
    )


def in_zones(df: DataFrame, zones: list[str] | None) -> DataFrame:
    return df if not zones else df.filter(F.col("zone").isin(list(zones)))


def cutoff_date(df: DataFrame, test_years: int = 3) -> Column:
    return df.agg(F.add_months(F.max("date"), -12 * test_years)).scalar()


def split_by_time(df: DataFrame, test_years: int = 3, cutoff: Column | None = None) -> DataFrame:
    """Adds ``role``: train up to the cutoff, test after it."""
    edge = cutoff_date(df, test_years) if cutoff is None else cutoff
    return df.withColumn("role", F.when(F.col("date") <= edge, "train").otherwise("test"))


def number_in_series(df: DataFrame) -> DataFrame:
    zone = Window.partitionBy("zone")
    return df.select(
        "*",
        F.row_number().over(zone.orderBy("date")).alias("row_in_series"),
        F.count(F.lit(1)).over(zone).alias("series_rows"),
    )


def split_by_position(
    df: DataFrame, train_share: float = 0.8, validation_share: float = 0.15
) -> DataFrame:
    """First rows of each series train (their tail validates), the rest tests.

    ``test_context`` marks the rows before the split that the first test sequences read.
    """
    row = F.col("row_in_series")
    split = F.floor(F.col("series_rows") * train_share)
    fit = F.floor(split * (1 - validation_share))
    return number_in_series(df).select(
        "*",
        F.when(row <= fit, "fit").when(row <= split, "validation").otherwise("test").alias("role"),
        ((row <= split) & (row > split - fixed.HISTORY_ROWS)).cast("int").alias("test_context"),
    )


def with_history(df: DataFrame, rows: int = 3 * fixed.HISTORY_ROWS) -> DataFrame:
    """Rows of the series that are long enough."""
    counted = df.withColumn("series_rows", F.count(F.lit(1)).over(Window.partitionBy("zone")))
    return counted.filter(F.col("series_rows") >= rows)


def first_zones(df: DataFrame, n: int = 3) -> DataFrame:
    """Rows of the first n zones by name."""
    names = df.select("zone").distinct().orderBy("zone").limit(n)
    return df.join(names, "zone", "left_semi")


def zone_list(df: DataFrame) -> DataFrame:
    return df.select("zone").distinct()


def date_ranks(df: DataFrame) -> DataFrame:
    """Distinct dates with their 0-based rank and count, ordered by range partitions."""
    dates = df.select("date").filter(F.col("date").isNotNull()).distinct().withColumn("one", F.lit(1))
    total = dates.agg(F.count(F.lit(1)).cast("int")).scalar()
    ranked = running_start(dates, ["date"], "one", "date_rank")
    return ranked.select("date", F.col("date_rank").cast("int").alias("date_rank"), total.alias("n_dates"))


def with_date_ranks(df: DataFrame) -> DataFrame:
    return df.join(date_ranks(df), "date")


def expanding_folds(df: DataFrame, folds: int = 5) -> DataFrame:
    """Rows of each expanding fold by date: every earlier date trains, the next block tests."""
    ranked = with_date_ranks(df)
    size = F.floor(F.col("n_dates") / (folds + 1)).cast("int")
    fold = F.explode(F.sequence(F.lit(1), F.lit(folds)))
    start = F.col("n_dates") - (folds - F.col("fold") + 1) * size
    role = F.when(F.col("date_rank") < start, "train").when(F.col("date_rank") < start + size, "test")
    return (
        ranked.withColumn("fold", fold)
        .withColumn("role", role)
        .filter(F.col("role").isNotNull())
        .drop("date_rank", "n_dates")
    )


def running_start(df: DataFrame, order: list[str], value: str, out: str) -> DataFrame:
    """Sum of ``value`` over all earlier rows of a globally ordered table.

    Range partitions are summed first, then rows inside each partition, so no task sees
    more than one partition. The partition number is written down with the rows before it
    is used, so a re-run task cannot change it.
    """
    ranged = stage(df.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ranged")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per shuffle partition
    parts = ranged.groupBy("part").agg(F.sum(value).alias("part_sum"))
    parts = parts.select("part", F.coalesce(F.sum("part_sum").over(earlier), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("inside_start", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return (
        local.join(F.broadcast(parts), "part")
        .withColumn(out, F.col("part_start") + F.col("inside_start"))
        .drop("part", "part_start", "inside_start")
    )


def row_folds(df: DataFrame, folds: int = 5) -> DataFrame:
    """Expanding folds by row order (zone, then date) instead of by date."""
    counts = df.groupBy("zone").agg(F.count(F.lit(1)).alias("zone_rows"))
    starts = running_start(counts, ["zone"], "zone_rows", "start").drop("zone_rows")
    total = df.agg(F.count(F.lit(1))).scalar()
    position = F.col("start") + F.row_number().over(Window.partitionBy("zone").orderBy("date")) - 1
    size = F.floor(F.col("n_rows") / (folds + 1))
    first = F.col("n_rows") - (folds - F.col("fold") + 1) * size
    role = F.when(F.col("position") < first, "train").when(F.col("position") < first + size, "test")
    return (
        df.join(starts, "zone")
        .withColumn("n_rows", total)
        .withColumn("position", position)
        .withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(folds))))
        .withColumn("role", role)
        .filter(F.col("role").isNotNull())
        .drop("start", "n_rows", "position")
    )


def _same(a: str, b: str, *columns: str) -> Column:
    """Equal columns of two sides, nulls included."""
    pairs = [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in columns]
    return reduce(lambda x, y: x & y, pairs)


def stratified_folds(df: DataFrame, folds: int = 5, label: str = fixed.RISK) -> DataFrame:
    """Deals each class over the folds in the order of (md5(zone), date).

    Rows without a label are a class of their own. The running number of a row is its place in its (class, zone) group plus the rows of
    the zones before it. The offsets are summed in two levels, 4,096 hash slices of zones
    and then the zones of a slice, so no class is ever sorted in one task.
    """
    digest = F.md5(F.col("zone"))
    counts = df.groupBy(label, "zone").agg(F.count(F.lit(1)).alias("group_rows")).withColumn(
        "slice", F.substring(digest, 1, 3)
    )
    slices = counts.groupBy(label, "slice").agg(F.sum("group_rows").alias("slice_rows"))
    earlier = Window.partitionBy(label).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select(
        label, "slice", F.coalesce(F.sum("slice_rows").over(earlier), F.lit(0)).alias("slice_start")
    )
    inside = (
        Window.partitionBy(label, "slice")
        .orderBy(F.md5(F.col("zone")), "zone")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = (
        counts.withColumn("zone_start", F.coalesce(F.sum("group_rows").over(inside), F.lit(0)))
        .alias("c")
        .join(slices.alias("s"), _same("c", "s", label, "slice"))
        .select(f"c.{label}", "c.zone", (F.col("slice_start") + F.col("zone_start")).alias("start"))
    )
    place = F.row_number().over(Window.partitionBy(label, "zone").orderBy("date")) - 1
    return (
        df.withColumn("place", place)
        .alias("d")
        .join(starts.alias("s"), _same("d", "s", label, "zone"))
        .select("d.*", "start")
        .withColumn("fold", ((F.col("start") + F.col("place")) % folds).cast("int"))
        .drop("start", "place")
    )
