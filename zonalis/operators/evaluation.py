"""Scores of predictions: frames hold ``model``, actual ``y`` and predicted ``p`` columns."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonalis.functions import fixed
from zonalis.operators.features import SERIES, series

LEVEL = fixed.TARGET


def regression_metrics(scored: DataFrame, by: tuple[str, ...] = ("model",)) -> DataFrame:
    """RMSE, MAE and R2 = 1 - SSE/SST in one aggregate per group, over rows that have both values."""
    error = F.col("y") - F.col("p")
    sums = scored.filter(F.col("y").isNotNull() & F.col("p").isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(error * error).alias("sse"),
        F.avg(F.abs(error)).alias("MAE"),
        F.regr_syy("y", "p").alias("sst"),
    )
    perfect = F.when(F.col("sse") == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    r2 = F.when(F.col("sst") == 0, perfect).otherwise(1 - F.try_divide("sse", "sst"))
    return sums.select(
        *by, "n", F.sqrt(F.col("sse") / F.col("n")).alias("RMSE"), "MAE", r2.alias("R2")
    )


def leaderboard(metrics: DataFrame) -> DataFrame:
    """Models by RMSE with a flag for the best of each metric (one row per model)."""
    best = metrics.agg(
        F.struct(
            F.min("RMSE").alias("RMSE"),
            F.min("MAE").alias("MAE"),
            F.max("R2").alias("R2"),
            F.min_by("model", F.struct("RMSE", "model")).alias("winner"),
        )
    ).scalar()
    flags = [(F.col(c) == best[c]).cast("int").alias(f"best_{c}") for c in ["RMSE", "MAE", "R2"]]
    return metrics.select("*", *flags, (F.col("model") == best["winner"]).cast("int").alias("winner")).orderBy(
        "RMSE", "model"
    )


def confusion_counts(scored: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Cells over the fixed 3x3 label grid, zero cells kept, from one aggregate."""
    codes = range(len(fixed.RISK_LABELS))
    cell = lambda a, p: F.count(F.when((F.col("y") == a) & (F.col("p") == p), 1))
    wide = scored.groupBy(*by).agg(*[cell(a, p).alias(f"c{a}{p}") for a in codes for p in codes])
    items = [
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(f"c{a}{p}").alias("n"))
        for a in codes
        for p in codes
    ]
    return wide.select(*by, F.explode(F.array(*items)).alias("cell")).select(*by, "cell.*")


def _report_rows(by):
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    codes = range(len(fixed.RISK_LABELS))
    cell = lambda a, p: F.col(f"c{a}{p}")
    rows, support_total = [], sum(cell(a, p) for a in codes for p in codes)
    per_class = []
    for c in codes:
        hit = cell(c, c)
        support = sum(cell(c, p) for p in codes)
        claimed = sum(cell(a, c) for a in codes)
        precision, recall = ratio(hit, claimed), ratio(hit, support)
        f1 = ratio(2 * precision * recall, precision + recall)
        per_class.append((precision, recall, f1, support))
        rows.append((fixed.RISK_LABELS[c], precision, recall, f1, support))
    accuracy = ratio(sum(cell(c, c) for c in codes), support_total)
    rows.append(("accuracy", accuracy, accuracy, accuracy, support_total))
    macro = [sum(x[i] for x in per_class) / len(per_class) for i in range(3)]
    weighted = [ratio(sum(x[i] * x[3] for x in per_class), support_total) for i in range(3)]
    rows.append(("macro avg", *macro, support_total))
    rows.append(("weighted avg", *weighted, support_total))
    return rows


def classification_report(scored: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Precision, recall, F1 and support per class with accuracy and averages; 0/0 is 0."""
    codes = range(len(fixed.RISK_LABELS))
    cell = lambda a, p: F.count(F.when((F.col("y") == a) & (F.col("p") == p), 1))
    wide = scored.groupBy(*by).agg(*[cell(a, p).alias(f"c{a}{p}") for a in codes for p in codes])
    items = [
        F.struct(
            F.lit(name).alias("label"),
            precision.cast("double").alias("precision"),
            recall.cast("double").alias("recall"),
            f1.cast("double").alias("f1"),
            support.cast("long").alias("support"),
        )
        for name, precision, recall, f1, support in _report_rows(by)
    ]
    return wide.select(*by, F.explode(F.array(*items)).alias("row")).select(*by, "row.*")


def _bin(value, ends, bins):
    """Equal-width bin; the last edge is closed, and a zero-width range is widened by a half."""
    low = F.when(ends["low"] == ends["high"], ends["low"] - 0.5).otherwise(ends["low"])
    high = F.when(ends["low"] == ends["high"], ends["high"] + 0.5).otherwise(ends["high"])
    at = F.least(F.floor((value - low) / (high - low) * bins), F.lit(bins - 1))
    return at.cast("int"), low, high


def residual_histogram(scored: DataFrame, bins: int = 40) -> DataFrame:
    """Counts of y - p over equal-width bins, empty bins included."""
    residuals = scored.select((F.col("y") - F.col("p")).alias("e")).filter(F.col("e").isNotNull())
    ends = residuals.agg(F.struct(F.min("e").alias("low"), F.max("e").alias("high"))).scalar()
    at, low, high = _bin(F.col("e"), ends, bins)
    counts = residuals.groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = scored.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    # one row per bin on either side
    return grid.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (low + (high - low) / bins * F.col("bin")).alias("low"),
        (low + (high - low) / bins * (F.col("bin") + 1)).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def value_range(scored: DataFrame) -> DataFrame:
    """Common range of actual and predicted values (the axis of a scatter)."""
    return scored.agg(
        F.least(F.min("y"), F.min("p")).alias("low"), F.greatest(F.max("y"), F.max("p")).alias("high")
    )


def persistence(df: DataFrame, rows: int = 1, model: str = "persistence") -> DataFrame:
    """The value ``rows`` earlier as the prediction."""
    return df.select(
        "zone",
        "date",
        F.lit(model).alias("model"),
        F.col(LEVEL).alias("y"),
        F.lag(LEVEL, rows).over(series()).alias("p"),
    ).filter(F.col("p").isNotNull())


def seasonal_naive(df: DataFrame) -> DataFrame:
    return persistence(df, 12, "seasonal")


def zone_climatology(df: DataFrame, cutoff) -> DataFrame:
    """Mean training level of the zone's calendar month as the prediction."""
    month = Window.partitionBy("zone", F.month("date"))
    return df.select(
        "zone",
        "date",
        F.lit("climatology").alias("model"),
        F.col(LEVEL).alias("y"),
        F.avg(F.when(F.col("date") <= cutoff, F.col(LEVEL))).over(month).alias("p"),
    ).filter(F.col("p").isNotNull())


def risk_persistence(df: DataFrame, keys=SERIES) -> DataFrame:
    """Last month's risk class as the predicted class."""
    return df.select(
        "zone", "date", F.col("risk_code").alias("y"), F.lag("risk_code").over(series(keys)).alias("p")
    ).filter(F.col("p").isNotNull() & F.col("y").isNotNull())


def align_predictions(frames: dict[str, DataFrame]) -> DataFrame:
    """Predictions of several models next to the actual value, by (zone, date)."""
    out = None
    for name, frame in frames.items():
        one = frame.select("zone", "date", "y", F.col("p").alias(name))
        out = one if out is None else out.join(one.drop("y"), ["zone", "date"])
    return out
