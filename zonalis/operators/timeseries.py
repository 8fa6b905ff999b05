"""Series operators: rolling z-scores, sequences, scaling, bounded balances, diagnostics."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonalis.functions import fixed
from zonalis.functions import measures as m
from zonalis.operators.features import SERIES, series

LEVEL = fixed.TARGET


def rolling_zscore(
    df: DataFrame,
    threshold: float = 1.5,
    window: int = fixed.ZSCORE_WINDOW,
    keys=SERIES,
    prior_only: bool = False,
) -> DataFrame:
    """Level against its trailing mean and sample std.

    A missing std (first row) counts as 1; a zero std gives no z and no flag. A frame that
    holds the current row bounds the sample z by (w-1)/sqrt(w), 2.04 for six rows; thresholds
    that no row can reach are refused, and ``prior_only`` compares with earlier rows alone.
    """
    bound = (window - 1) / window**0.5
    if not prior_only and threshold >= bound:
        raise ValueError(f"|z| stays below {bound:.2f} in a window of {window} rows: use prior_only")
    over = series(keys)
    frame = over.rowsBetween(-window, -1) if prior_only else over.rowsBetween(-(window - 1), 0)
    scored = df.select(
        "*",
        F.avg(LEVEL).over(frame).alias("gw_rolling_mean"),
        F.coalesce(F.stddev_samp(LEVEL).over(frame), F.lit(1.0)).alias("gw_rolling_std"),
    )
    z = F.try_divide(F.col(LEVEL) - F.col("gw_rolling_mean"), F.col("gw_rolling_std"))
    return scored.withColumn("z_score", z).withColumn(
        "z_anomaly", F.coalesce((F.abs("z_score") > threshold).cast("int"), F.lit(0))
    )


def sequences(
    df: DataFrame,
    covariates: list[str] = fixed.SEQUENCE_COVARIATES,
    history: int = fixed.HISTORY_ROWS,
    steps: int = fixed.FORECAST_STEPS,
    keep: list[str] = (),
    keys=SERIES,
) -> DataFrame:
    """Rows of history with the next targets, stride 1; only complete ones."""
    over = series(keys)
    past = over.rowsBetween(-(history - 1), 0)
    targets = [F.lead(covariates[0], k).over(over) for k in range(1, steps + 1)]
    rows = df.select(
        *keys,
        "date",
        *keep,
        F.collect_list(F.struct(*covariates)).over(past).alias("history"),
        F.lead("date", steps).over(over).alias("last_target_date"),
        F.array(*targets).alias("target"),
    )
    complete = (F.size("history") == history) & F.col("last_target_date").isNotNull()
    return rows.filter(complete).drop("last_target_date")


def minmax(
    df: DataFrame, columns: list[str], fit_when: Column | None = None, keys=SERIES
) -> DataFrame:
    """Per-series scaling to [0, 1]; a constant series becomes 0. Ends stay for the inverse."""
    zone = Window.partitionBy(*keys)
    used = (lambda c: F.col(c)) if fit_when is None else (lambda c: F.when(fit_when, F.col(c)))
    ends = []
    for c in columns:
        ends += [F.min(used(c)).over(zone).alias(f"{c}_min"), F.max(used(c)).over(zone).alias(f"{c}_max")]
    spread = df.select("*", *ends)
    scaled = [
        F.coalesce(
            F.try_divide(F.col(c) - F.col(f"{c}_min"), F.col(f"{c}_max") - F.col(f"{c}_min")), F.lit(0.0)
        ).alias(f"{c}_scaled")
        for c in columns
    ]
    return spread.select("*", *scaled)


def minmax_inverse(scaled: Column, column: str) -> Column:
    return scaled * (F.col(f"{column}_max") - F.col(f"{column}_min")) + F.col(f"{column}_min")


def bounded_balance(
    df: DataFrame, delta: str, start: float, low: float = 1.0, high: float = 35.0, keys=SERIES
) -> DataFrame:
    """x[t] = clip(x[t-1] + delta[t], low, high) from a given start, per series.

    A step maps x to clip(x + a, lo, hi), and such maps compose into one of the same form.
    Each series-year is folded into its map, the maps are chained over the years, and each
    year is then replayed from its own start: no task holds more than a year of readings
    or one map per year.
    """
    year_rows = (
        df.withColumn("year", F.year("date"))
        .groupBy(*keys, "year")
        .agg(F.sort_array(F.collect_list(F.struct("date", F.col(delta).alias("delta")))).alias("steps"))
    )
    identity = F.struct(
        F.lit(0.0).alias("a"), F.lit(float("-inf")).alias("lo"), F.lit(float("inf")).alias("hi")
    )

    def then(f, a):
        clip = lambda x: F.least(F.greatest(x + a, F.lit(low)), F.lit(high))
        return F.struct((f["a"] + a).alias("a"), clip(f["lo"]).alias("lo"), clip(f["hi"]).alias("hi"))

    maps = year_rows.select(
        *keys,
        "year",
        F.aggregate(F.transform("steps", lambda s: s["delta"]), identity, then).alias("map"),
    )
    chain = maps.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("year", "map"))).alias("years")
    )
    apply_map = lambda x, f: F.least(F.greatest(x + f["a"], f["lo"]), f["hi"])
    starts = chain.select(
        *keys,
        F.explode(
            F.aggregate(
                "years",
                F.struct(
                    F.lit(float(start)).alias("x"),
                    F.array().cast("array<struct<year:int,x:double>>").alias("out"),
                ),
                lambda acc, y: F.struct(
                    apply_map(acc["x"], y["map"]).alias("x"),
                    F.concat(
                        acc["out"], F.array(F.struct(y["year"].alias("year"), acc["x"].alias("x")))
                    ).alias("out"),
                ),
                lambda acc: acc["out"],
            )
        ).alias("s"),
    ).select(*keys, "s.year", F.col("s.x").alias("x0"))

    def replay(acc, step):
        x = F.least(F.greatest(acc["x"] + step["delta"], F.lit(low)), F.lit(high))
        point = F.struct(step["date"].alias("date"), x.alias("balance"))
        return F.struct(x.alias("x"), F.concat(acc["out"], F.array(point)).alias("out"))

    played = year_rows.join(starts, [*keys, "year"]).select(
        *keys,
        F.explode(
            F.aggregate(
                "steps",
                F.struct(
                    F.col("x0").alias("x"),
                    F.array().cast("array<struct<date:date,balance:double>>").alias("out"),
                ),
                replay,
                lambda acc: acc["out"],
            )
        ).alias("p"),
    )
    return played.select(*keys, "p.date", "p.balance")


def persistence_residuals(df: DataFrame, keys=SERIES) -> DataFrame:
    lagged = df.select(*keys, "date", (F.col(LEVEL) - F.lag(LEVEL).over(series(keys))).alias("residual"))
    return lagged.filter(F.col("residual").isNotNull())


def residual_diagnostics(residuals: DataFrame, lags: int = 10) -> DataFrame:
    """Per zone: spread and quartiles of the residuals and their autocorrelation by lag."""
    zone = Window.partitionBy("zone")
    centred = residuals.withColumn("e", F.col("residual") - F.avg("residual").over(zone))
    products = centred.select(
        "zone",
        "residual",
        "e",
        *[(F.col("e") * F.lag("e", k).over(series())).alias(f"p{k}") for k in range(1, lags + 1)],
    )
    # the percentile buffer is one zone's series, not the table
    sums = products.groupBy("zone").agg(
        F.stddev_samp("residual").alias("residual_std"),
        F.percentile("residual", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"),
        F.sum(F.col("e") * F.col("e")).alias("total"),
        *[F.sum(f"p{k}").alias(f"p{k}") for k in range(1, lags + 1)],
    )
    lagged = F.explode(
        F.array(*[F.struct(F.lit(k).alias("lag"), F.col(f"p{k}").alias("p")) for k in range(1, lags + 1)])
    )
    return sums.select(
        "zone",
        "residual_std",
        F.col("q")[0].alias("q25"),
        F.col("q")[1].alias("q50"),
        F.col("q")[2].alias("q75"),
        "total",
        lagged.alias("item"),
    ).select(
        "zone",
        "item.lag",
        F.try_divide("item.p", "total").alias("acf"),
        "residual_std",
        "q25",
        "q50",
        "q75",
    )


def standardised(residuals: DataFrame) -> DataFrame:
    zone = Window.partitionBy("zone")
    e = F.col("residual")
    score = F.try_divide(e - F.avg(e).over(zone), F.stddev_samp(e).over(zone))
    return residuals.withColumn("standardised", score)


def dickey_fuller(df: DataFrame, keys=SERIES) -> DataFrame:
    """Unit-root regression dx ~ 1 + x_lag per series (no augmentation terms).

    The critical value is the published 5% response surface for a constant:
    -2.86154 - 2.8903/n - 4.234/n^2 - 40.04/n^3.
    """
    pairs = df.select(*keys, F.col(LEVEL).alias("x"), F.lag(LEVEL).over(series(keys)).alias("x_lag"))
    pairs = pairs.filter(F.col("x_lag").isNotNull()).withColumn("dx", F.col("x") - F.col("x_lag"))
    fit = pairs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.regr_slope("dx", "x_lag").alias("slope"),
        F.regr_sxx("dx", "x_lag").alias("sxx"),
        F.regr_syy("dx", "x_lag").alias("syy"),
        F.regr_sxy("dx", "x_lag").alias("sxy"),
    )
    sse = F.col("syy") - F.col("slope") * F.col("sxy")
    error = F.sqrt(F.try_divide(F.try_divide(sse, F.col("n") - 2), F.col("sxx")))
    n = F.col("n").cast("double")
    critical = -2.86154 - F.try_divide(F.lit(2.8903), n) - F.try_divide(F.lit(4.234), n * n)
    critical = critical - F.try_divide(F.lit(40.04), n * n * n)
    return (
        fit.withColumn("t_stat", F.try_divide(F.col("slope"), error))
        .withColumn("critical", critical)
        .withColumn("stationary", F.coalesce((F.col("t_stat") < F.col("critical")).cast("int"), F.lit(0)))
        .select(*keys, "n", "slope", "t_stat", "critical", "stationary")
    )


def recursive_forecast(df: DataFrame, months: int = fixed.FUTURE_MONTHS, keys=SERIES) -> DataFrame:
    """AR(1) line per series, fed with its own predictions for the coming months."""
    pairs = df.select(*keys, "date", LEVEL, F.lag(LEVEL).over(series(keys)).alias("previous"))
    fit = pairs.groupBy(*keys).agg(
        F.regr_slope(LEVEL, "previous").alias("slope"),
        F.regr_intercept(LEVEL, "previous").alias("intercept"),
        F.max("date").alias("last_date"),
        F.max_by(LEVEL, "date").alias("last_level"),
    )
    unrolled = F.aggregate(
        F.sequence(F.lit(1), F.lit(months)),
        F.array(F.col("last_level")),
        lambda acc, _: F.concat(
            acc, F.array(F.col("intercept") + F.col("slope") * F.element_at(acc, -1))
        ),
    )
    return (
        fit.withColumn("path", unrolled)
        .select(*keys, "last_date", F.posexplode("path").alias("step", "predicted_gw"))
        .filter("step > 0")
        .select(
            *keys,
            "step",
            F.add_months("last_date", F.col("step")).alias("date"),
            "predicted_gw",
        )
    )
