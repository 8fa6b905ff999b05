"""The Kalman likelihood against dense Gaussian densities, closed forms and simulated processes."""

import datetime

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from zonalis.operators import forecasting, likelihood


def dense(w, phi, theta):
    """log det and quadratic form of the observations' covariance, the state starting with variance DIFFUSE."""
    n = len(w)
    move = np.array([[phi[0], 1, 0], [phi[1], 0, 1], [0, 0, 0]])
    noise = np.array([1, *theta])
    covariances = [np.eye(3) * likelihood.DIFFUSE]
    for _ in range(n - 1):
        covariances.append(move @ covariances[-1] @ move.T + np.outer(noise, noise))
    sigma = np.zeros((n, n))
    for t in range(n):
        ahead = covariances[t]
        for u in range(t, n):
            sigma[t, u] = sigma[u, t] = ahead[0, 0]
            ahead = move @ ahead
    known = ~np.isnan(w)
    sigma, y = sigma[np.ix_(known, known)], w[known]
    return np.linalg.slogdet(sigma)[1], y @ np.linalg.solve(sigma, y)


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10_000), st.lists(st.floats(-0.9, 0.9), min_size=4, max_size=4), st.sets(st.integers(0, 11)))
def test_innovations_equal_the_dense_density(seed, weights, missing):
    burn, likelihood.BURN = likelihood.BURN, 0
    try:
        w = np.random.default_rng(seed).normal(size=12)
        w[list(missing)] = np.nan
        n, squares, logs, _ = likelihood.innovations(w[None], np.array(weights)[None, None])
    finally:
        likelihood.BURN = burn
    if len(missing) == 12:
        assert n[0] == 0
        return
    log_det, form = dense(w, weights[:2], weights[2:])
    assert n[0] == 12 - len(missing)
    assert logs[0, 0] == pytest.approx(log_det, abs=1e-5) and squares[0, 0] == pytest.approx(form, rel=1e-5, abs=1e-5)


def simulated(rng, n, phi, theta, d):
    e, w = rng.normal(size=n + 50), np.zeros(n + 50)
    for t in range(2, n + 50):
        w[t] = phi[0] * w[t - 1] + phi[1] * w[t - 2] + e[t] + theta[0] * e[t - 1] + theta[1] * e[t - 2]
    return 20 + np.cumsum(w[50:]) if d else w[50:]


def test_autoregressions_equal_least_squares_and_fits_stand_alone():
    rng = np.random.default_rng(1)
    levels = [simulated(rng, n, (0.6, 0.2), (0.0, 0.0), 0) for n in (90, 60, 200)]
    zeros = [np.zeros((len(likelihood.ORDERS), 4))] * 3
    together = likelihood.fit_stack(levels, zeros)
    for i, x in enumerate(levels):
        alone = likelihood.fit_stack([x], zeros[:1])
        np.testing.assert_allclose(alone["aic"][0], together["aic"][i], atol=1e-6)
        for k, (p, d, q) in enumerate(likelihood.ORDERS):
            if q:
                continue
            w = np.concatenate([[np.nan] * d, np.diff(x, d)])
            rows = np.arange(likelihood.BURN, len(x))
            past = np.stack([w[rows - j] for j in range(1, p + 1)], 1) if p else np.zeros((len(rows), 0))
            weights, *_ = np.linalg.lstsq(past, w[rows], rcond=None)
            error = ((w[rows] - past @ weights) ** 2).sum()
            assert together["aic"][i, k] == pytest.approx(len(rows) * np.log(error / len(rows)) + 2 * (p + 1), abs=1e-6)
            np.testing.assert_allclose(together["weights"][i, k, :p], weights, atol=1e-4)


def test_search_finds_planted_weights_and_never_ends_above_its_start():
    rng = np.random.default_rng(2)
    levels = [simulated(rng, 1500, (0.5, 0.0), (0.4, 0.0), 1) for _ in range(3)]
    starts = [rng.normal(size=(len(likelihood.ORDERS), 4)) * 0.3 for _ in levels]
    found = likelihood.fit_stack(levels, starts)
    k = likelihood.ORDERS.index((1, 1, 1))
    np.testing.assert_allclose(found["weights"][:, k, [0, 2]].mean(0), [0.5, 0.4], atol=0.06)
    begun = found["start_aic"]
    assert (found["aic"] <= np.where(np.isnan(begun), np.inf, begun) + 1e-9).all()


def panel(spark, levels):
    start = datetime.date(2000, 1, 1)
    rows = [(zone, datetime.date(start.year + i // 12, i % 12 + 1, 1), float(v)) for zone, x in levels.items() for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "zone string, date date, groundwater_level double")


def test_forecasts_follow_the_state_and_short_series_are_marked(spark):
    rng = np.random.default_rng(4)
    long = simulated(rng, 120, (0.7, 0.0), (0.0, 0.0), 0)
    rows = panel(spark, {"long": long, "short": [7.0, 8.0, 9.0], "flat": [5.0] * 40})
    regular = forecasting.regular_series(rows).withColumn("fit_rows", F.col("series_rows"))
    fits = likelihood.candidate_fits(regular)
    one = fits.filter("zone = 'long' AND p = 1 AND d = 0 AND q = 0").withColumn("fallback", F.lit(False))
    got = [r.predicted_gw for r in likelihood.forecast(one, F.lit(5)).orderBy("step").collect()]
    phi = one.first().weights[0]
    np.testing.assert_allclose(got, long[-1] * phi ** np.arange(1, 6), rtol=1e-9)
    made = likelihood.future(rows, 4)
    assert {(r.zone, r.fallback) for r in made.select("zone", "fallback").distinct().collect()} == {
        ("long", False), ("short", True), ("flat", False)}
    assert [r.predicted_gw for r in made.filter("zone = 'short'").orderBy("date").collect()] == [9.0] * 4
    assert all(abs(r.predicted_gw - 5) < 1e-3 for r in made.filter("zone = 'flat'").collect())
    assert [str(r.date) for r in made.filter("zone = 'short'").orderBy("date").collect()][0] == "2000-04-01"
    assert likelihood.future(rows.limit(0)).count() == 0
    scored = likelihood.backtest(rows)
    assert scored.filter("zone = 'long'").count() == 24
    assert {r.model for r in likelihood.backtest_metrics(rows).collect()} == {"ARIMA_long", "ARIMA_short", "ARIMA_flat"}
