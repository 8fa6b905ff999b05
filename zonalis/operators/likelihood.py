"""Exact likelihood of autoregressive moving-average orders, for stacks of series at once.

The process w_t = phi1 w_(t-1) + phi2 w_(t-2) + e_t + theta1 e_(t-1) + theta2 e_(t-2) on the level or its
first difference is filtered by a Kalman filter with three states and a diffuse start; lower orders
have zero weights. Neither stationarity nor invertibility is required, and there is no constant term. The first rows
(those that also the two-pass least squares of ``forecasting`` leaves out) initialise the filter and do not
count, so the criteria of all orders compare the same rows. The scale is concentrated out.

All series of a batch, all orders, all trial points of a line search and all points of a numerical
gradient are one stack of numbers per state entry, so a step of the filter is some thirty array
operations whatever the number of fits. Quasi-Newton steps start at the best of the least-squares
weights and a fixed set of others and only improve, so no criterion is worse than at the start.

A series is one row of a batch; the number of series is spread by Spark.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.functions import fixed
from zonalis.operators import forecasting
from zonalis.session import stage

DIFFUSE = 1e6
#: Rows that only initialise, as in the least-squares fits.
BURN = forecasting.LONG_LAGS + forecasting.MAX_Q + max(fixed.ARIMA_D)
#: Counted rows that a fit needs.
ENOUGH = forecasting.MAX_P + forecasting.MAX_Q + 1
ORDERS = [(p, d, q) for p in fixed.ARIMA_P for d in fixed.ARIMA_D for q in fixed.ARIMA_Q if p + d + q]
#: Where no order can be fitted.
FALLBACK = (1, 1, 1)
SERIES_AT_ONCE = 32
ITERATIONS = 60
STEPS = np.array([1.0, 0.5, 0.25, 0.0625, 2.0**-7, 3.0])
PARAMETERS = 4
#: Further starts, as the likelihood of residual terms has several minima.
STARTS = np.array([[a, 0.0, b, c] for a in (0.0, 0.5, 0.95) for b in (-1.2, -0.8, -0.3, 0.0, 0.3, 0.8, 1.2) for c in (-0.4, 0.0, 0.4)])


def innovations(w: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Counted rows, sum of squared scaled innovations, sum of log variances and the state after the last row.

    ``w`` is fits by time (nan: missing, also after the end), ``weights`` fits by trials by parameters.
    """
    fits, length = w.shape
    phi1, phi2, theta1, theta2 = np.moveaxis(weights, 2, 0)
    shape = phi1.shape
    a0, a1, a2 = np.zeros(shape), np.zeros(shape), np.zeros(shape)
    p00, p11, p22 = (np.full(shape, DIFFUSE) for _ in range(3))
    p01, p02, p12 = np.zeros(shape), np.zeros(shape), np.zeros(shape)
    squares, logs, n = np.zeros(shape), np.zeros(shape), np.zeros(fits)
    known = ~np.isnan(w)
    last = np.where(known.any(1), length - 1 - known[:, ::-1].argmax(1), -1)
    c01, c11, c12, c22 = theta1, theta1 * theta1, theta1 * theta2, theta2 * theta2
    with np.errstate(over="ignore", invalid="ignore"):
        for t in range(int(last.max(initial=-1)) + 1):
            seen, alive = known[:, t, None], (last >= t)[:, None]
            y = np.where(seen, w[:, t, None], 0.0)
            v = y - a0
            if t >= BURN:
                n += known[:, t]
                squares += np.where(seen, v * v / p00, 0.0)
                logs += np.where(seen, np.log(p00), 0.0)
            k1, k2 = p01 / p00, p02 / p00
            b0, b1, b2 = np.where(seen, y, a0), a1 + np.where(seen, k1 * v, 0.0), a2 + np.where(seen, k2 * v, 0.0)
            q11, q12, q22 = (np.where(seen, p - k * r, p) for p, k, r in ((p11, k1, p01), (p12, k1, p02), (p22, k2, p02)))
            q00, q01, q02 = (np.where(seen, 0.0, p) for p in (p00, p01, p02))
            a0, a1, a2 = (np.where(alive, new, old) for new, old in
                          ((phi1 * b0 + b1, a0), (phi2 * b0 + b2, a1), (0.0, a2)))
            p00 = phi1 * phi1 * q00 + 2 * phi1 * q01 + q11 + 1
            p01 = phi1 * phi2 * q00 + phi1 * q02 + phi2 * q01 + q12 + c01
            p11 = phi2 * phi2 * q00 + 2 * phi2 * q02 + q22 + c11
            p02, p12, p22 = theta2, c12, c22
    return n, squares, logs, np.stack([a0, a1, a2], 2)


def criterion(w: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """n log(scale) + sum of log variances by fit and trial; infinite where the filter overflows."""
    n, squares, logs, _ = innovations(w, weights)
    with np.errstate(divide="ignore", invalid="ignore"):
        value = n[:, None] * np.log(np.maximum(squares / n[:, None], 1e-12)) + logs
    return np.where(np.isfinite(value), value, np.inf)


def gradient(w: np.ndarray, at: np.ndarray, free: np.ndarray) -> np.ndarray:
    """Central differences."""
    h = 1e-5 * np.maximum(1.0, np.abs(at))
    shift = np.eye(PARAMETERS) * h[:, None, :]
    values = criterion(w, np.concatenate([at[:, None] + shift, at[:, None] - shift], 1))
    with np.errstate(invalid="ignore"):
        slope = (values[:, :PARAMETERS] - values[:, PARAMETERS:]) / (2 * h)
    return np.where(free & np.isfinite(slope), slope, 0.0)


def minimise(w: np.ndarray, start: np.ndarray, free: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and criterion after quasi-Newton steps for every fit of the stack; none ends above its start."""
    trials = np.concatenate([start[:, None], np.broadcast_to(STARTS, (len(start), *STARTS.shape))], 1)
    trials = np.where(free[:, None], trials, 0.0)
    found = criterion(w, trials)
    rows, pick = np.arange(len(start)), found.argmin(1)
    at, value = trials[rows, pick], found[rows, pick]
    slope = gradient(w, at, free)
    inverse = np.eye(PARAMETERS) / np.maximum(1.0, np.abs(slope).max(1))[:, None, None]
    fresh = np.ones(len(at), bool)
    open_ = np.flatnonzero(free.any(1) & np.isfinite(value))
    for _ in range(ITERATIONS):
        if not len(open_):
            break
        here, down = at[open_], slope[open_]
        towards = -(inverse[open_] @ down[:, :, None])[:, :, 0]
        uphill = (towards * down).sum(1) >= 0
        towards[uphill] = -down[uphill]
        trials = here[:, None] + STEPS[:, None] * towards[:, None, :]
        found = criterion(w[open_], trials)
        pick = found.argmin(1)
        rows = np.arange(len(open_))
        lower = found[rows, pick]
        gain = value[open_] - lower
        moved = gain > 0
        new = np.where(moved[:, None], trials[rows, pick], here)
        new_slope = gradient(w[open_], new, free[open_])
        s, y = new - here, new_slope - down
        curve = (s * y).sum(1)
        keep = curve > 1e-12
        h = inverse[open_]
        rho = np.where(keep, 1 / np.where(keep, curve, 1.0), 0.0)[:, None, None]
        side = np.eye(PARAMETERS) - rho * s[:, :, None] * y[:, None, :]
        scale = np.where(fresh[open_] & keep, curve / np.maximum((y * y).sum(1), 1e-300), 1.0)[:, None, None]
        first = np.where((fresh[open_] & keep)[:, None, None], np.eye(PARAMETERS) * scale, h)
        h = np.where(keep[:, None, None], side @ first @ side.transpose(0, 2, 1) + rho * s[:, :, None] * s[:, None, :], h)
        stuck = ~moved
        # once more along the slope itself before a fit is closed
        h[stuck] = np.eye(PARAMETERS) / np.maximum(1.0, np.abs(down[stuck]).max(1, initial=0.0))[:, None, None] / 16
        again = stuck & ~fresh[open_]
        at[open_], slope[open_], inverse[open_] = new, new_slope, h
        value[open_] = np.where(moved, lower, value[open_])
        fresh[open_] = stuck
        open_ = open_[(moved & (gain > 1e-9)) | again]
    return at, value


def fit_stack(levels: list[np.ndarray], starts: list[np.ndarray]) -> dict[str, np.ndarray]:
    """Every order for every series: rows counted, criterion with and without search, weights and final state."""
    longest = max(map(len, levels))
    x = np.full((len(levels), longest), np.nan)
    for row, level in zip(x, levels, strict=True):
        row[: len(level)] = level
    forms = {0: x, 1: np.concatenate([np.full((len(x), 1), np.nan), np.diff(x, axis=1)], 1)}
    w = np.concatenate([forms[d] for _, d, _ in ORDERS])
    free = np.repeat(np.array([[p > 0, p > 1, q > 0, q > 1] for p, _, q in ORDERS]), len(x), 0)
    start = np.concatenate([np.array([s[k] for s in starts]) for k in range(len(ORDERS))])
    begun = criterion(w, np.where(free, start, 0.0)[:, None])[:, 0]
    weights, value = minimise(w, start, free)
    n, _, _, state = innovations(w, weights[:, None])
    price = 2 * (free.sum(1) + 1)
    enough = n >= ENOUGH
    shaped = lambda a: np.moveaxis(a.reshape(len(ORDERS), len(x), *a.shape[1:]), 0, 1)
    return {
        "n": shaped(n.astype(np.int64)), "aic": shaped(np.where(enough, value + price, np.nan)),
        "start_aic": shaped(np.where(enough, begun + price, np.nan)), "weights": shaped(weights), "state": shaped(state[:, 0]),
    }


_FIT = pa.struct([("p", pa.int32()), ("d", pa.int32()), ("q", pa.int32()), ("n", pa.int64()), ("aic", pa.float64()),
                  ("start_aic", pa.float64()), ("weights", pa.list_(pa.float64())), ("state", pa.list_(pa.float64()))])
_FIT_SQL = ("struct<p:int,d:int,q:int,n:bigint,aic:double,start_aic:double,weights:array<double>,state:array<double>>")


def candidate_fits(regular: DataFrame) -> DataFrame:
    """Every order of every series: rows counted, AIC, AIC of the least-squares weights under the same
    likelihood, weights (phi1, phi2, theta1, theta2; zero beyond the order) and the state to forecast from.

    ``regular`` is as in ``forecasting.candidate_fits``. AIC is null for a series with too few rows.
    """
    regular = stage(regular, "regular")
    fitted = regular.filter("row_in_series <= fit_rows")
    begun = forecasting.candidate_fits(regular).select("zone", F.struct("p", "d", "q", "weights").alias("fit"))
    begun = begun.groupBy("zone").agg(F.collect_list("fit").alias("starts"))
    level = F.struct("row_in_series", forecasting.LEVEL)
    series = fitted.groupBy("zone").agg(
        F.transform(F.array_sort(F.collect_list(level)), lambda r: r[forecasting.LEVEL]).alias("x"),
        F.max("date").alias("last_date"), F.max_by(forecasting.LEVEL, "row_in_series").alias("last_level"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), SERIES_AT_ONCE):
                part = batch.slice(at, SERIES_AT_ONCE)
                levels = [np.array(x, float) for x in part.column("x").to_pylist()]
                starts = [start_weights(s or []) for s in part.column("starts").to_pylist()]
                found = fit_stack(levels, starts)
                fits = []
                for i in range(len(part)):
                    fits.append([
                        {"p": p, "d": d, "q": q, "n": int(found["n"][i, k]), "weights": found["weights"][i, k].tolist(),
                         "state": found["state"][i, k].tolist(),
                         **{c: None if np.isnan(found[c][i, k]) else float(found[c][i, k]) for c in ("aic", "start_aic")}}
                        for k, (p, d, q) in enumerate(ORDERS)])
                columns = [part.column(c) for c in ("zone", "last_date", "last_level")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(fits, pa.list_(_FIT))], ["zone", "last_date", "last_level", "fits"])

    zone, date = (regular.schema[c].dataType.simpleString() for c in ("zone", "date"))
    rows = series.join(begun, "zone", "left").mapInArrow(
        run, f"zone {zone}, last_date {date}, last_level double, fits array<{_FIT_SQL}>")
    return rows.select("zone", "last_date", "last_level", F.inline("fits"))


def start_weights(fits: list[dict]) -> np.ndarray:
    """Least-squares weights by order; zeros where there was no fit."""
    out = np.zeros((len(ORDERS), PARAMETERS))
    for f in fits:
        if f["weights"] is not None:  # its first entry is the squared error
            out[ORDERS.index((f["p"], f["d"], f["q"]))] = f["weights"][1:]
    return out


def best_orders(fits: DataFrame) -> DataFrame:
    """Lowest AIC per series, ties to the lower order; ``fallback`` marks a series without any, which gets
    (1,1,1) with zero weights: its last level goes on."""
    choice = F.struct("p", "d", "q", "aic", "weights", "state")
    rank = F.when(F.col("aic").isNotNull(), F.struct("aic", "p", "d", "q"))
    p, d, q = FALLBACK
    last = (F.col("p") == p) & (F.col("d") == d) & (F.col("q") == q)
    plain = F.struct("p", "d", "q", "aic", F.array_repeat(F.lit(0.0), PARAMETERS).alias("weights"),
                     F.array_repeat(F.lit(0.0), 3).alias("state"))
    best = fits.groupBy("zone", "last_date", "last_level").agg(
        F.min_by(choice, rank).alias("best"), F.max(F.when(last, plain)).alias("plain"),
        F.min(F.col("aic").isNull()).alias("fallback"))
    chosen = F.when(F.col("fallback"), F.col("plain")).otherwise(F.col("best"))
    return best.select("zone", "last_date", "last_level", "fallback", chosen.alias("c")).select(
        "zone", "last_date", "last_level", "fallback", "c.*")


def forecast(orders: DataFrame, steps) -> DataFrame:
    """Unrolls each chosen order for ``steps`` months from its filtered state."""
    phi1, phi2, state = F.col("weights")[0], F.col("weights")[1], F.col("state")
    start = F.struct(F.col("last_level").alias("x"), state[0].alias("a0"), state[1].alias("a1"), state[2].alias("a2"),
                     F.array().cast("array<double>").alias("out"))

    def advance(acc, _):
        w = acc["a0"]
        x = F.when(F.col("d") == 1, acc["x"] + w).otherwise(w)
        return F.struct(x.alias("x"), (phi1 * w + acc["a1"]).alias("a0"), (phi2 * w + acc["a2"]).alias("a1"),
                        F.lit(0.0).alias("a2"), F.concat(acc["out"], F.array(x)).alias("out"))

    path = F.aggregate(F.sequence(F.lit(1), steps), start, advance, lambda acc: acc["out"])
    return orders.select("zone", "p", "d", "q", "fallback", "last_date", F.posexplode(path)).select(
        "zone", F.add_months("last_date", F.col("pos") + 1).alias("date"), (F.col("pos") + 1).alias("step"),
        F.col("col").alias("predicted_gw"), "p", "d", "q", "fallback")


def select_orders(panel: DataFrame, train_share: float = 0.8) -> DataFrame:
    regular = forecasting.regular_series(panel).withColumn("fit_rows", F.floor(F.col("series_rows") * train_share))
    return best_orders(candidate_fits(regular)).select("zone", "p", "d", "q", "aic", "fallback")


def backtest(panel: DataFrame, train_share: float = 0.8) -> DataFrame:
    """Fit on the first rows of each series and predict the rest next to the actual level."""
    regular = forecasting.regular_series(panel).withColumn("fit_rows", F.floor(F.col("series_rows") * train_share))
    lengths = regular.groupBy("zone").agg(F.max(F.col("series_rows") - F.col("fit_rows")).alias("h"))
    orders = best_orders(candidate_fits(regular)).join(lengths.filter("h > 0"), "zone")
    predicted = forecast(orders, F.col("h").cast("int")).withColumnRenamed("predicted_gw", "p_level")
    actual = regular.select("zone", "date", F.col(forecasting.LEVEL).alias("y"))
    return actual.join(predicted, ["zone", "date"])


def backtest_metrics(panel: DataFrame, train_share: float = 0.8) -> DataFrame:
    scored = backtest(panel, train_share)
    return forecasting.regression_metrics(
        scored.select(F.concat(F.lit("ARIMA_"), "zone").alias("model"), "y", F.col("p_level").alias("p")))


def future(panel: DataFrame, months: int = fixed.FUTURE_MONTHS) -> DataFrame:
    """Fit on the whole series and forecast the months after it."""
    regular = forecasting.regular_series(panel).withColumn("fit_rows", F.col("series_rows"))
    return forecast(best_orders(candidate_fits(regular)), F.lit(months)).select("date", "zone", "predicted_gw", "fallback")
