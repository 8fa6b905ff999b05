"""Autoregressive moving-average forecasts per series, fitted by grouped sums.

Two least-squares passes (Hannan and Rissanen): a long autoregression gives residuals, then
level and residual lags are regressed together. Both need only sums of products per series,
so the fits are ordinary partial aggregates over all rows; Python solves the few normal
equations per series, one small matrix at a time. As in the modelled process there is no
constant term.
"""

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonalis.functions import fixed
from zonalis.operators.calendar import fill_gaps
from zonalis.operators.evaluation import regression_metrics
from zonalis.operators.selection import number_in_series
from zonalis.session import stage

LONG_LAGS = 6
MAX_P, MAX_Q = max(fixed.ARIMA_P), max(fixed.ARIMA_Q)
LEVEL = fixed.TARGET


def _products(columns: list[Column]) -> Column:
    """Upper triangle of the sum of outer products; rows with a null in a pair add nothing."""
    size = len(columns)
    return F.array(*[F.sum(columns[i] * columns[j]) for i in range(size) for j in range(i, size)])


def _squares(triangles: pd.Series, size: int) -> np.ndarray:
    """Symmetric matrices from their upper triangles, nan where a triangle is unknown."""
    rows, columns = np.triu_indices(size)
    blank = np.full(len(rows), np.nan)
    stacked = np.array(
        [blank if t is None else np.asarray(t, dtype=np.float64) for t in triangles]
    ).reshape(-1, len(rows))
    full = np.zeros((len(stacked), size, size))
    full[:, rows, columns] = stacked
    full[:, columns, rows] = stacked
    return full


def _solve(grams: np.ndarray, used: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Least squares of variable 0 on the used ones for a stack of sums, with squared errors."""
    moments = grams[:, used, 0]
    inverse = np.linalg.pinv(grams[:, used][:, :, used], hermitian=True)
    weights = (inverse @ moments[:, :, None])[:, :, 0]
    return weights, grams[:, 0, 0] - (weights * moments).sum(axis=1)


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def long_weights(gram: pd.Series) -> pd.Series:
    size = LONG_LAGS + 1
    grams = _squares(gram, size)
    known = ~np.isnan(grams).any(axis=(1, 2))
    weights = np.zeros((len(gram), LONG_LAGS))
    weights[known], _ = _solve(grams[known], list(range(1, size)))
    return pd.Series([w if k else None for w, k in zip(weights, known)], index=gram.index, dtype=object)


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def order_weights(gram: pd.Series, p: pd.Series, q: pd.Series) -> pd.Series:
    """Squared error, then the level weights and the residual weights, zero beyond the order."""
    size = 1 + MAX_P + MAX_Q
    grams = _squares(gram, size)
    known = ~np.isnan(grams).any(axis=(1, 2))
    solved = np.zeros((len(gram), size))
    for ar in set(p):
        for ma in set(q):
            rows = np.flatnonzero(known & (p == ar).to_numpy() & (q == ma).to_numpy())
            used = [*range(1, 1 + ar), *range(1 + MAX_P, 1 + MAX_P + ma)]
            if len(rows) and used:
                weights, solved[rows, 0] = _solve(grams[rows], used)
                solved[np.ix_(rows, used)] = weights
            elif len(rows):
                solved[rows, 0] = grams[rows, 0, 0]
    return pd.Series([w if k else None for w, k in zip(solved, known)], index=gram.index, dtype=object)


def regular_series(panel: DataFrame) -> DataFrame:
    """Gap-free monthly level with row numbers, written once: the fits read it twice."""
    return stage(number_in_series(fill_gaps(panel)).filter(F.col(LEVEL).isNotNull()), "series")


def _lagged(regular: DataFrame) -> DataFrame:
    """A row per month with the level in both difference orders and their long lags side by side.

    What follows stays partitioned by zone, so this is the only shuffle of rows.
    """
    zone = Window.partitionBy("zone").orderBy("date")
    step = F.col(LEVEL) - F.lag(LEVEL).over(zone)
    both = regular.select("zone", "date", "row_in_series", "fit_rows", LEVEL, step.alias("w1"))
    both = both.withColumn("w0", F.col(LEVEL))
    lags = range(1, LONG_LAGS + 1)
    return both.select("*", *[F.lag(f"w{d}", k).over(zone).alias(f"w{d}_{k}") for d in fixed.ARIMA_D for k in lags])


def candidate_fits(regular: DataFrame) -> DataFrame:
    """Every order of the grid with its weights, AIC and the state to forecast from.

    ``regular`` carries ``fit_rows``, the number of leading rows to fit on. All orders are
    compared on the same rows, so their AICs are comparable across difference orders.
    """
    rows = _lagged(regular).filter(F.col("row_in_series") <= F.col("fit_rows"))
    past = {d: [F.col(f"w{d}_{k}") for k in range(1, LONG_LAGS + 1)] for d in fixed.ARIMA_D}
    whole = lambda d: [F.when(past[d][-1].isNotNull(), c) for c in [F.col(f"w{d}"), *past[d]]]
    first = rows.groupBy("zone").agg(*[_products(whole(d)).alias(f"gram{d}") for d in fixed.ARIMA_D])
    long_fit = first.select("zone", *[long_weights(f"gram{d}").alias(f"long{d}") for d in fixed.ARIMA_D])
    # series without a full set of lags have no long fit and keep null residuals
    fitted = rows.join(long_fit, "zone", "left")
    error = lambda d: F.col(f"w{d}") - reduce(
        lambda a, b: a + b, [F.col(f"long{d}")[k] * lag for k, lag in enumerate(past[d])]
    )
    residuals = fitted.select("zone", "date", "row_in_series", LEVEL, *[
        F.col(c) for d in fixed.ARIMA_D for c in [f"w{d}", *[f"w{d}_{k}" for k in range(1, MAX_P + 1)]]
    ], *[error(d).alias(f"e{d}") for d in fixed.ARIMA_D])
    ordered = Window.partitionBy("zone").orderBy("date")
    before = [F.lag(f"e{d}", k).over(ordered).alias(f"e{d}_{k}") for d in fixed.ARIMA_D for k in range(1, MAX_Q + 1)]
    # the lags of the levels reach over the rows to fit on only
    before += [F.lag(f"w{d}", 1).over(ordered).alias(f"before{d}") for d in fixed.ARIMA_D]
    lags = residuals.select("*", *before)

    def form(d):
        """One difference order: the variables of its fit where all are usable, and its state."""
        # the trim of the highest difference order, for both
        usable = F.col(f"e{d}_{MAX_Q}").isNotNull() & (
            F.col("row_in_series") > LONG_LAGS + MAX_Q + max(fixed.ARIMA_D)
        )
        names = [f"w{d}", *[f"w{d}_{k}" for k in range(1, MAX_P + 1)], *[f"e{d}_{k}" for k in range(1, MAX_Q + 1)]]
        variables = [F.when(usable, F.col(c)) for c in names]
        state = F.struct(
            F.col(LEVEL).alias("x"),
            F.col(f"w{d}").alias("w1"),
            F.col(f"before{d}").alias("w2"),
            F.coalesce(f"e{d}", F.lit(0.0)).alias("e1"),
            F.coalesce(f"e{d}_1", F.lit(0.0)).alias("e2"),
            F.col("date").alias("last_date"),
        )
        return [
            F.count(variables[0]).alias(f"n{d}"),
            _products(variables).alias(f"gram{d}"),
            F.max_by(state, "date").alias(f"state{d}"),
        ]

    wide = lags.groupBy("zone").agg(*[c for d in fixed.ARIMA_D for c in form(d)])
    forms = [
        F.struct(F.lit(d).alias("d"), *[F.col(f"{c}{d}").alias(c) for c in ("n", "gram", "state")]) for d in fixed.ARIMA_D
    ]
    second = wide.select("zone", F.explode(F.array(*forms)).alias("form")).select("zone", "form.*")
    orders = [(p, q) for p in fixed.ARIMA_P for q in fixed.ARIMA_Q]
    grid = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(q).alias("q")) for p, q in orders])
    fits = (
        second.withColumn("order", F.explode(grid))
        .select("zone", "d", "n", "gram", "state", "order.p", "order.q")
        .filter("p + d + q > 0")
        .withColumn("solved", order_weights("gram", "p", "q"))
    )
    variance = F.greatest(F.col("solved")[0] / F.col("n"), F.lit(1e-12))
    aic = F.when(F.col("n") > MAX_P + MAX_Q, F.col("n") * F.log(variance) + 2 * (F.col("p") + F.col("q") + 1))
    return fits.select("zone", "p", "d", "q", "n", aic.alias("aic"), F.col("solved").alias("weights"), "state")


def best_orders(fits: DataFrame) -> DataFrame:
    """Lowest AIC per series; one too short for any fit gets the random walk (0,1,0)."""
    choice = F.struct("p", "d", "q", "aic", "weights", "state")
    rank = F.struct(F.coalesce("aic", F.lit(float("inf"))), "p", "d", "q")
    walk = (F.col("p") == 0) & (F.col("d") == 1) & (F.col("q") == 0)
    best = fits.groupBy("zone").agg(
        F.min_by(F.when(F.col("aic").isNotNull(), choice), F.when(F.col("aic").isNotNull(), rank)).alias("best"),
        F.max(F.when(walk, choice)).alias("walk"),
    )
    return best.select("zone", F.coalesce("best", "walk").alias("c")).select("zone", "c.*")


def forecast(orders: DataFrame, steps: Column) -> DataFrame:
    """Unrolls each chosen order for ``steps`` months from its state."""
    weight = lambda k: F.coalesce(F.col("weights")[k], F.lit(0.0))
    ar1, ar2, ma1, ma2 = (weight(k) for k in range(1, 5))
    s = F.col("state")
    start = F.struct(
        s["x"].alias("x"),
        F.coalesce(s["w1"], F.lit(0.0)).alias("w1"),
        F.coalesce(s["w2"], F.lit(0.0)).alias("w2"),
        s["e1"].alias("e1"),
        s["e2"].alias("e2"),
        F.array().cast("array<double>").alias("out"),
    )

    def advance(acc, _):
        w = ar1 * acc["w1"] + ar2 * acc["w2"] + ma1 * acc["e1"] + ma2 * acc["e2"]
        x = F.when(F.col("d") == 1, acc["x"] + w).otherwise(w)
        return F.struct(
            x.alias("x"),
            w.alias("w1"),
            acc["w1"].alias("w2"),
            F.lit(0.0).alias("e1"),
            acc["e1"].alias("e2"),
            F.concat(acc["out"], F.array(x)).alias("out"),
        )

    path = F.aggregate(F.sequence(F.lit(1), steps), start, advance, lambda acc: acc["out"])
    return orders.select("zone", "p", "d", "q", s["last_date"].alias("last_date"), F.posexplode(path)).select(
        "zone",
        F.add_months("last_date", F.col("pos") + 1).alias("date"),
        (F.col("pos") + 1).alias("step"),
        F.col("col").alias("predicted_gw"),
        "p",
        "d",
        "q",
    )


def select_orders(panel: DataFrame, train_share: float = 0.8) -> DataFrame:
    regular = regular_series(panel).withColumn(
        "fit_rows", F.floor(F.col("series_rows") * train_share)
    )
    return best_orders(candidate_fits(regular)).select("zone", "p", "d", "q", "aic")


def backtest(panel: DataFrame, train_share: float = 0.8) -> DataFrame:
    """Fit on the first rows of each series and predict the rest next to the actual level."""
    regular = regular_series(panel).withColumn(
        "fit_rows", F.floor(F.col("series_rows") * train_share)
    )
    orders = best_orders(candidate_fits(regular))
    lengths = regular.groupBy("zone").agg(F.max(F.col("series_rows") - F.col("fit_rows")).alias("h"))
    predicted = forecast_each(orders.join(lengths.filter("h > 0"), "zone"))
    actual = regular.select("zone", "date", F.col(LEVEL).alias("y"))
    return actual.join(predicted, ["zone", "date"]).withColumnRenamed("predicted_gw", "p_level")


def forecast_each(orders: DataFrame) -> DataFrame:
    return forecast(orders, F.col("h").cast("int"))


def backtest_metrics(panel: DataFrame, train_share: float = 0.8) -> DataFrame:
    scored = backtest(panel, train_share).select(
        F.concat(F.lit("ARIMA_"), "zone").alias("model"), "y", F.col("p_level").alias("p")
    )
    return regression_metrics(scored)


def future(panel: DataFrame, months: int = fixed.FUTURE_MONTHS) -> DataFrame:
    """Fit on the whole series and forecast the months after it."""
    regular = regular_series(panel).withColumn("fit_rows", F.col("series_rows"))
    return forecast(best_orders(candidate_fits(regular)), F.lit(months)).select(
        "date", "zone", "predicted_gw"
    )
