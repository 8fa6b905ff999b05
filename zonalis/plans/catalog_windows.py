"""Registered queries: windows, series operators, folds, scenarios and maps."""

from pyspark.sql import functions as F

from zonalis.functions import fixed
from zonalis.functions import measures as m
from zonalis.operators import (
    anomaly,
    blocks,
    calendar,
    explain,
    features,
    models,
    scenarios,
    selection,
    spatial,
    summaries,
    timeseries,
    whatif,
)
from zonalis.plans.base import (
    COLOUR_CASE,
    PANEL_LIST,
    over_customers,
    over_events,
    over_panel,
    r,
    shown,
)
from zonalis.plans.catalog_aggregates import _MODE, _summary
from zonalis.plans.catalog_scalar import _FLOW, _SEASON, AR1, W, YEAR
from zonalis.session import fresh_path, stage
from zonalis.sources.tables import customer_panel, event_series, zone_panel

THRESHOLD = 1.5
LEVEL_KEYS = ["zone", "date", "groundwater_level"]
LAGS = [f"{v}_lag_{k}" for k in fixed.LAG_STEPS for v in ("gw", "rain")]
MEANS = [f"{v}_roll_mean_{k}" for k in fixed.ROLLING_WINDOWS for v in ("rain", "temp")]
STDS = [f"gw_roll_std_{k}" for k in fixed.ROLLING_WINDOWS]


# --- features over windows ------------------------------------------------------
def lag_features(spark, sf_dir):
    return features.add_lags(customer_panel(spark, sf_dir)).select("zone", "date", *LAGS)


def rolling_means(spark, sf_dir):
    rows = features.add_trailing_means(customer_panel(spark, sf_dir)).select("zone", "date", *MEANS)
    return shown(rows, 6, *MEANS)


def rolling_std(spark, sf_dir):
    rows = features.add_trailing_std(customer_panel(spark, sf_dir)).select("zone", "date", *STDS)
    return shown(rows, 6, *STDS)


def drought_index(spark, sf_dir):
    rows = features.add_drought(stage(customer_panel(spark, sf_dir).select("zone", "date", "rainfall_mm")))
    return shown(rows.select("zone", "date", "spi"), 6, "spi")


def engineer_features(spark, sf_dir):
    rows = features.engineer(stage(customer_panel(spark, sf_dir)))
    return shown(rows, 6, "month_sin", "month_cos", *MEANS, *STDS, "spi", "urbanization_index")


def blocked_features(spark, sf_dir):
    """The window features with every series cut into blocks of 40 rows."""
    rows = blocks.window_features(customer_panel(spark, sf_dir), 40).select("zone", "date", *LAGS, *MEANS, *STDS)
    return shown(rows, 6, *MEANS, *STDS)


def rolling_zscore(spark, sf_dir):
    rows = timeseries.rolling_zscore(customer_panel(spark, sf_dir).select(*LEVEL_KEYS), THRESHOLD)
    return shown(rows, 6, "gw_rolling_mean", "gw_rolling_std", "z_score")


def rolling_zscore_prior(spark, sf_dir):
    """Daily series against the six days before, where the threshold of 3 can fire."""
    rows = timeseries.rolling_zscore(event_series(spark, sf_dir), 3.0, prior_only=True)
    return shown(rows, 6, "groundwater_level", "gw_rolling_mean", "gw_rolling_std", "z_score")


def anomaly_rows(spark, sf_dir):
    flagged = anomaly.zscore_anomalies(customer_panel(spark, sf_dir), THRESHOLD)
    rows = anomaly.anomaly_rows(flagged, ["zone", "date", "groundwater_level", "z_score"])
    return shown(rows, 6, "z_score")


def anomaly_counts(spark, sf_dir):
    return anomaly.anomaly_counts(anomaly.zscore_anomalies(customer_panel(spark, sf_dir), THRESHOLD))


def gap_fill(spark, sf_dir):
    """The customer series, which have a row only for months with an order."""
    rows = customer_panel(spark, sf_dir).select(*LEVEL_KEYS)
    return shown(calendar.fill_gaps(rows), 6, "groundwater_level")


def sequence_windows(spark, sf_dir):
    """Every complete sequence, one row per history step."""
    rows = timeseries.sequences(zone_panel(spark, sf_dir))
    return rows.select(
        "zone",
        "date",
        F.posexplode("history").alias("step", "h"),
        *[F.col("target")[k].alias(f"target_{k + 1}") for k in range(fixed.FORECAST_STEPS)],
    ).select("zone", "date", "step", "h.*", *[f"target_{k + 1}" for k in range(fixed.FORECAST_STEPS)])


def minmax_scale(spark, sf_dir):
    scaled = timeseries.minmax(customer_panel(spark, sf_dir), ["groundwater_level", "rainfall_mm"])
    back = timeseries.minmax_inverse(F.col("groundwater_level_scaled"), "groundwater_level")
    rows = scaled.select("zone", "date", "groundwater_level_scaled", "rainfall_mm_scaled", back.alias("restored"))
    return shown(rows, 6, "groundwater_level_scaled", "rainfall_mm_scaled", "restored")


def expanding_folds(spark, sf_dir):
    return selection.expanding_folds(stage(customer_panel(spark, sf_dir).select("zone", "date")))


def row_folds(spark, sf_dir):
    return selection.row_folds(stage(customer_panel(spark, sf_dir).select("zone", "date")))


def stratified_folds(spark, sf_dir):
    rows = stage(customer_panel(spark, sf_dir).select("zone", "date", "risk_code"))
    return selection.stratified_folds(rows)


def bounded_balance(spark, sf_dir):
    """Balance of what evaporates against a tenth of the rain, kept between 1 and 35."""
    delta = F.col("evapotranspiration") - F.col("rainfall_mm") / 10
    steps = customer_panel(spark, sf_dir).withColumn("delta", delta)
    return shown(timeseries.bounded_balance(steps, "delta", 18.0), 6, "balance")


def residual_acf(spark, sf_dir):
    residuals = timeseries.persistence_residuals(zone_panel(spark, sf_dir))
    rows = timeseries.residual_diagnostics(residuals)
    return shown(rows, 6, "acf", "residual_std", "q25", "q50", "q75")


def standardised_residuals(spark, sf_dir):
    rows = timeseries.standardised(timeseries.persistence_residuals(zone_panel(spark, sf_dir)))
    return shown(rows, 6, "residual", "standardised")


# --- closed-form statistics -------------------------------------------------------
SCALED = ["rainfall_mm", "temperature_c", "urban_fraction", "population_density"]


def standard_scale(spark, sf_dir):
    rows = selection.split_by_time(stage(customer_panel(spark, sf_dir)))
    scaled = models.standard_scale(rows, rows.filter("role = 'train'"), SCALED)
    names = [f"{c}_z" for c in SCALED]
    return shown(scaled.select("zone", "date", "role", *names), 6, *names)


def physics_fit(spark, sf_dir):
    panel = stage(zone_panel(spark, sf_dir))
    line = models.physics_line(panel)
    rows = features.add_physics(panel).withColumn(
        "physics", line["intercept"] + line["slope"] * F.col("darcy_recharge")
    )
    return shown(rows.select("zone", "date", "darcy_recharge", "physics"), 6, "darcy_recharge", "physics")


def df_test(spark, sf_dir):
    return shown(timeseries.dickey_fuller(zone_panel(spark, sf_dir)), 6, "slope", "t_stat", "critical")


def recursive_forecast(spark, sf_dir):
    return shown(timeseries.recursive_forecast(zone_panel(spark, sf_dir)), 6, "predicted_gw")


CONTRIBUTION_COLUMNS = ["rainfall_mm", "temperature_c"]


def linear_contrib(spark, sf_dir):
    rows = stage(selection.split_by_time(customer_panel(spark, sf_dir)))
    test, train = rows.filter("role = 'test'"), rows.filter("role = 'train'")
    weights = explain.fitted_weights(train, CONTRIBUTION_COLUMNS)
    return shown(explain.linear_contributions(test, train, weights), 6, "mean_abs")


def whatif_vector(spark, sf_dir):
    panel = stage(zone_panel(spark, sf_dir))
    vector = whatif.request_vector(whatif.requests_from(panel), whatif.zone_attributes(panel), panel)
    return shown(vector, 6, "month_sin", "month_cos", "urbanization_index", *[c for c in LAGS if c[0] == "r"])


def whatif_echo(spark, sf_dir):
    requests = whatif.requests_from(zone_panel(spark, sf_dir))
    fields = ["Zone", "Soil", "Rainfall_mm", "Temperature_C", "NDVI", "Urban_Fraction", "Month", "Year"]
    body = whatif.echo(requests)
    return body.select(
        "zone", "year", "month", *[F.get_json_object("request", f"$.{c}").alias(f"echo_{c}") for c in fields[:2]],
        *[F.get_json_object("request", f"$.{c}").cast("double").alias(f"echo_{c}") for c in fields[2:]],
    )


# --- scenarios and maps ---------------------------------------------------------------
def scenario_projection(spark, sf_dir):
    return scenarios.project(stage(zone_panel(spark, sf_dir)))


def scenario_vs_history(spark, sf_dir):
    return shown(scenarios.against_history(stage(zone_panel(spark, sf_dir))), 6, "gw_level")


def _year_summary(spark, sf_dir):
    return stage(summaries.zone_summary(zone_panel(spark, sf_dir), YEAR), "summary")


def grid_mesh(spark, sf_dir):
    return shown(spatial.grid_mesh(_year_summary(spark, sf_dir)), 9, "longitude", "latitude")


def idw_grid(spark, sf_dir):
    return shown(spatial.interpolate(_year_summary(spark, sf_dir), "gw_level"), 6, "value")


def idw_exact(spark, sf_dir):
    """A grid of step 0.05 over positions on whole numbers: stations hit cells.

    A hit shows a mean as it is, and a mean of 80 readings can end in a 5 at the digit that
    is rounded; station values are therefore fixed at nine digits in both engines.
    """
    points = zone_panel(spark, sf_dir).groupBy("zone").agg(
        F.rint(F.min("longitude") * 20).alias("longitude"),
        F.rint(F.min("latitude") * 20).alias("latitude"),
        F.avg("groundwater_level").alias("gw_level"),
    )
    points = shown(points, 9, "gw_level")
    return shown(spatial.interpolate(stage(points), "gw_level", cells=103), 6, "value")


def map_features(spark, sf_dir):
    rows = spatial.map_features(_year_summary(spark, sf_dir))
    return shown(spatial.write_map(rows, fresh_path(spark, "map")), 6, "heat")


def risk_points(spark, sf_dir):
    return spatial.risk_points(_year_summary(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in [
        lag_features,
        rolling_means,
        rolling_std,
        drought_index,
        engineer_features,
        blocked_features,
        rolling_zscore,
        rolling_zscore_prior,
        anomaly_rows,
        anomaly_counts,
        gap_fill,
        sequence_windows,
        minmax_scale,
        expanding_folds,
        row_folds,
        stratified_folds,
        bounded_balance,
        residual_acf,
        standardised_residuals,
        standard_scale,
        physics_fit,
        df_test,
        recursive_forecast,
        linear_contrib,
        whatif_vector,
        whatif_echo,
        scenario_projection,
        scenario_vs_history,
        grid_mesh,
        idw_grid,
        idw_exact,
        map_features,
        risk_points,
    ]
}

# --- SQL counterparts -------------------------------------------------------------
_LAG_SQL = ", ".join(
    f"lag({c}, {k}) OVER {W} AS {v}_lag_{k}"
    for k in (1, 3, 6, 12)
    for v, c in (("gw", "groundwater_level"), ("rain", "rainfall_mm"))
)


def _frame(k: int) -> str:
    return f"(PARTITION BY zone ORDER BY date ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"


def _trailing(fn: str, column: str, k: int) -> str:
    return f"{fn}({column}) OVER {_frame(k)}"


_MEAN_SQL = ", ".join(
    f"{r(_trailing('avg', c, k), 6)} AS {v}_roll_mean_{k}"
    for k in (3, 6, 12)
    for v, c in (("rain", "rainfall_mm"), ("temp", "temperature_c"))
)
_STD_SQL = ", ".join(
    f"{r(f'''coalesce({_trailing('stddev_samp', 'groundwater_level', k)}, 0)''', 6)} AS gw_roll_std_{k}"
    for k in (3, 6, 12)
)
_MONTHS = """months AS (SELECT month(date) AS mon, avg(rainfall_mm) AS mu, stddev_samp(rainfall_mm) AS sd
  FROM customers GROUP BY 1)"""
_SPI = "(rainfall_mm - mu) / (CASE WHEN sd = 0 THEN 1 ELSE sd END)"


def _zscore(source: str, frame: str, threshold: float) -> str:
    over = f"(PARTITION BY zone ORDER BY date ROWS BETWEEN {frame})"
    return f"""framed AS (SELECT *, avg(groundwater_level) OVER {over} AS mu,
      coalesce(stddev_samp(groundwater_level) OVER {over}, 1) AS sd FROM {source}),
    scored AS (SELECT *, (groundwater_level - mu) / nullif(sd, 0) AS z FROM framed),
    flagged AS (SELECT *, coalesce(cast(abs(z) > {threshold}e0 AS integer), 0) AS flag FROM scored)"""


_KEPT = "kept AS (SELECT zone, date, groundwater_level AS v FROM customers)"
FILLED = """spine AS (SELECT zone, cast(unnest(generate_series(min(date), max(date), INTERVAL 1 MONTH)) AS date) AS date
    FROM kept GROUP BY zone),
  grid AS (SELECT s.zone, s.date, v, year(s.date) * 12 + month(s.date) - 1 AS t, k.date IS NULL AS gap
    FROM spine s LEFT JOIN kept k ON s.zone = k.zone AND s.date = k.date),
  sides AS (SELECT *, last_value(v IGNORE NULLS) OVER before AS v0, last_value(CASE WHEN v IS NOT NULL THEN t END
      IGNORE NULLS) OVER before AS t0, first_value(v IGNORE NULLS) OVER after AS v1,
      first_value(CASE WHEN v IS NOT NULL THEN t END IGNORE NULLS) OVER after AS t1 FROM grid
    WINDOW before AS (PARTITION BY zone ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
      after AS (PARTITION BY zone ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
  filled AS (SELECT zone, date, CASE WHEN v IS NOT NULL THEN v WHEN v0 IS NULL THEN NULL WHEN v1 IS NULL THEN v0
    ELSE v0 + (v1 - v0) * (t - t0) / (t1 - t0) END AS x, cast(v IS NULL AS integer) AS filled FROM sides)"""

_COVARIATES = ", ".join(fixed.SEQUENCE_COVARIATES)
_EXPAND = """ranked AS (SELECT zone, date, dense_rank() OVER (ORDER BY date) - 1 AS pos FROM customers),
  size AS (SELECT max(pos) + 1 AS n, (max(pos) + 1) // 6 AS ts FROM ranked),
  roles AS (SELECT zone, date, f AS fold, CASE WHEN pos < n - (6 - f) * ts THEN 'train'
    WHEN pos < n - (5 - f) * ts THEN 'test' END AS role
    FROM ranked, size, (SELECT unnest([1, 2, 3, 4, 5]) AS f))"""
_PERSIST = f"""resid AS (SELECT zone, date, groundwater_level - lag(groundwater_level) OVER {W} AS residual
  FROM panel QUALIFY residual IS NOT NULL)"""
_ACF = f"""centred AS (SELECT *, residual - avg(residual) OVER (PARTITION BY zone) AS e FROM resid),
  spread AS (SELECT zone, stddev_samp(residual) AS sd, quantile_cont(residual, 0.25) AS q25,
    quantile_cont(residual, 0.5) AS q50, quantile_cont(residual, 0.75) AS q75, sum(e * e) AS total
    FROM centred GROUP BY zone),
  shifted AS (SELECT zone, k, e * lag(e, cast(k AS integer)) OVER (PARTITION BY zone, k ORDER BY date) AS p
    FROM centred, (SELECT unnest(range(1, 11)) AS k))"""
_DELTA = "evapotranspiration - rainfall_mm / 10"
_BALANCE = f"""steps AS (SELECT zone, date, {_DELTA} AS delta,
    row_number() OVER (PARTITION BY zone ORDER BY date) AS rn FROM customers),
  walk(zone, rn, date, x) AS (
    SELECT zone, rn, date, least(35e0, greatest(1e0, 18e0 + delta)) FROM steps WHERE rn = 1
    UNION ALL SELECT s.zone, s.rn, s.date, least(35e0, greatest(1e0, x + delta))
    FROM walk w JOIN steps s ON s.zone = w.zone AND s.rn = w.rn + 1)"""

_SCALE_SQL = ", ".join(
    r(f"coalesce(({c} - m_{c}) / nullif(s_{c}, 0), 0)", 6) + f" AS {c}_z" for c in SCALED
)
_SCALE_FIT = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in SCALED)
_DF = f"""pairs AS (SELECT zone, groundwater_level AS x, lag(groundwater_level) OVER {W} AS xl FROM panel
    QUALIFY xl IS NOT NULL),
  fit AS (SELECT zone, count(*) AS n, regr_slope(x - xl, xl) AS b, regr_sxx(x - xl, xl) AS sxx,
    regr_syy(x - xl, xl) AS syy, regr_sxy(x - xl, xl) AS sxy FROM pairs GROUP BY zone),
  tests AS (SELECT zone, n, b, b / sqrt((syy - b * sxy) / (n - 2) / sxx) AS t,
    -2.86154e0 - 2.8903e0 / n - 4.234e0 / (n * n) - 40.04e0 / (n * n * n) AS crit FROM fit)"""

# ridge weights of level on both columns with a penalty of one, from centred sums of the training rows
_CONTRIB = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, avg(abs(({c} - {m}) * {w} / det)) AS v "
    "FROM customers, cut, (SELECT *, (s11 + 1) * (s22 + 1) - s12 * s12 AS det FROM sums) WHERE date > edge"
    for c, m, w in [("rainfall_mm", "m1", "((s22 + 1) * b1 - s12 * b2)"), ("temperature_c", "m2", "((s11 + 1) * b2 - s12 * b1)")]
)

_SCENARIO = """base AS (SELECT zone, arg_max(rainfall_mm, date) AS rain0, arg_max(temperature_c, date) AS temp0,
    arg_max(urban_fraction, date) AS urban0, arg_max(soil_permeability, date) AS perm,
    arg_max(groundwater_level, date) AS level0 FROM panel GROUP BY zone),
  params(scenario, dr, dt, du) AS (VALUES ('RCP_2.6_Optimistic', 0.05e0, 1.0e0, 0.02e0),
    ('RCP_4.5_Moderate', -0.10e0, 2.0e0, 0.04e0), ('RCP_8.5_Pessimistic', -0.20e0, 3.5e0, 0.08e0)),
  drivers AS (SELECT zone, y, scenario, perm, level0, rain0 * (1 + dr) AS rain, temp0 + dt AS temp,
    least(1e0, urban0 + du * y / 30) AS urban FROM base, params, (SELECT unnest(range(1, 31)) AS y)),
  levels AS (SELECT *, greatest(0.5e0, least(40e0, level0 + (-((1 - urban) * perm * rain * 0.01e0)
    + (0.08e0 + urban * 0.3e0) + (temp - 25) * 0.003e0) * y * 0.05e0)) AS level FROM drivers),
  projected AS (SELECT zone, cast((SELECT max(year(date)) FROM panel) + y AS integer) AS year,
    cast(mm AS integer) AS month, scenario, round(rain, 2) AS rainfall_proj, round(temp, 2) AS temp_proj,
    round(urban, 3) AS urban_proj, round(level, 3) AS gw_level_proj
    FROM levels, (SELECT unnest(range(1, 13)) AS mm))"""

_POINTS = f"""points AS (SELECT zone, min(longitude) AS x, min(latitude) AS y, avg(groundwater_level) AS v,
  avg(rainfall_mm) AS rainfall, avg(urban_fraction) AS urban_frac FROM panel
  WHERE year(date) = {YEAR} GROUP BY zone)"""
_COARSE = """points AS (SELECT zone, round_even(min(longitude) * 20, 0) AS x, round_even(min(latitude) * 20, 0) AS y,
  round(avg(groundwater_level), 9) AS v FROM panel GROUP BY zone)"""


def _mesh(cells: int) -> str:
    return f"""box AS (SELECT min(x) - 0.05e0 AS x0, max(x) + 0.05e0 AS x1, min(y) - 0.05e0 AS y0,
      max(y) + 0.05e0 AS y1 FROM points),
    mesh AS (SELECT cast(i AS integer) AS ix, cast(j AS integer) AS iy,
      x0 + cast(i AS double) * ((x1 - x0) / {cells - 1}) AS gx, y0 + cast(j AS double) * ((y1 - y0) / {cells - 1}) AS gy
      FROM box, (SELECT unnest(range({cells})) AS i), (SELECT unnest(range({cells})) AS j))"""


_IDW = f"""SELECT ix, iy, {r('coalesce(arg_min(v, zone) FILTER (d = 0), sum(v / (d * d)) FILTER (d > 0) / sum(1 / (d * d)) FILTER (d > 0))', 6)}
  AS value FROM (SELECT ix, iy, zone, v, sqrt((x - gx) * (x - gx) + (y - gy) * (y - gy)) AS d FROM mesh, points)
  GROUP BY ix, iy"""


def _txt(e: str, d: int) -> str:
    return f"printf('%.{d}f', {r(e, d)})"


ORACLE = {
    "lag_features": over_customers(f"SELECT zone, date, {_LAG_SQL} FROM customers"),
    "rolling_means": over_customers(f"SELECT zone, date, {_MEAN_SQL} FROM customers"),
    "rolling_std": over_customers(f"SELECT zone, date, {_STD_SQL} FROM customers"),
    "drought_index": over_customers(
        f"SELECT zone, date, {r(_SPI, 6)} AS spi FROM customers JOIN months ON mon = month(date)", _MONTHS
    ),
    "engineer_features": over_customers(
        f"""SELECT {PANEL_LIST}, soil_type_enc, cast(year(date) AS integer) AS year,
        cast(month(date) AS integer) AS month, {r('sin(2 * pi() * month(date) / 12)', 6)} AS month_sin,
        {r('cos(2 * pi() * month(date) / 12)', 6)} AS month_cos, cast({_SEASON} AS integer) AS season,
        cast(({_SEASON}) > 0 AS integer) AS is_monsoon, {', '.join(LAGS + MEANS + STDS)},
        {r(_SPI, 6)} AS spi, {r('''0.5e0 * urban_fraction + 0.3e0 * ((population_density - lo) / (hi - lo + 1e-9))
        + 0.2e0 * (1 - ndvi)''', 6)} AS urbanization_index
        FROM wide JOIN months ON mon = month(date), ends
        WHERE gw_lag_12 IS NOT NULL AND risk_level IS NOT NULL AND sd IS NOT NULL""",
        f"""wide AS (SELECT *, cast(dense_rank() OVER (ORDER BY soil_type) - 1 AS integer) AS soil_type_enc,
        {_LAG_SQL}, {_MEAN_SQL}, {_STD_SQL} FROM customers)""",
        _MONTHS,
        "ends AS (SELECT min(population_density) AS lo, max(population_density) AS hi FROM customers)",
    ),
    "blocked_features": over_customers(
        f"SELECT zone, date, {_LAG_SQL}, {_MEAN_SQL}, {_STD_SQL} FROM customers"
    ),
    "rolling_zscore": over_customers(
        f"""SELECT zone, date, groundwater_level, {r('mu', 6)} AS gw_rolling_mean, {r('sd', 6)} AS gw_rolling_std,
        {r('z', 6)} AS z_score, flag AS z_anomaly FROM flagged""",
        _zscore("customers", "5 PRECEDING AND CURRENT ROW", THRESHOLD),
    ),
    "rolling_zscore_prior": over_events(
        f"""SELECT zone, date, {r('groundwater_level', 6)} AS groundwater_level, {r('mu', 6)} AS gw_rolling_mean,
        {r('sd', 6)} AS gw_rolling_std, {r('z', 6)} AS z_score, flag AS z_anomaly FROM flagged""",
        _zscore("events_daily", "6 PRECEDING AND 1 PRECEDING", 3.0),
    ),
    "anomaly_rows": over_customers(
        f"SELECT zone, date, groundwater_level, {r('z', 6)} AS z_score FROM flagged WHERE flag = 1",
        _zscore("customers", "5 PRECEDING AND CURRENT ROW", THRESHOLD),
    ),
    "anomaly_counts": over_customers(
        "SELECT zone, cast(sum(flag) AS bigint) AS anomalies FROM flagged GROUP BY zone",
        _zscore("customers", "5 PRECEDING AND CURRENT ROW", THRESHOLD),
    ),
    "gap_fill": over_customers(
        f"SELECT zone, date, {r('x', 6)} AS groundwater_level, filled FROM filled", _KEPT, FILLED
    ),
    "sequence_windows": over_panel(
        f"""SELECT w.zone, w.date, cast(11 - back AS integer) AS step, {', '.join('h.' + c for c in fixed.SEQUENCE_COVARIATES)},
        w.target_1, w.target_2, w.target_3
        FROM numbered w CROSS JOIN (SELECT unnest(range(12)) AS back)
        JOIN numbered h ON h.zone = w.zone AND h.rn = w.rn - back
        WHERE w.rn >= 12 AND w.target_3 IS NOT NULL""",
        f"""numbered AS (SELECT zone, date, {_COVARIATES}, row_number() OVER {W} AS rn,
        lead(groundwater_level, 1) OVER {W} AS target_1, lead(groundwater_level, 2) OVER {W} AS target_2,
        lead(groundwater_level, 3) OVER {W} AS target_3 FROM panel)""",
    ),
    "minmax_scale": over_customers(
        f"""SELECT zone, date, {r('coalesce((groundwater_level - lo) / nullif(hi - lo, 0), 0)', 6)}
        AS groundwater_level_scaled, {r('coalesce((rainfall_mm - rlo) / nullif(rhi - rlo, 0), 0)', 6)}
        AS rainfall_mm_scaled, {r('groundwater_level', 6)} AS restored FROM (SELECT *,
        min(groundwater_level) OVER z AS lo, max(groundwater_level) OVER z AS hi, min(rainfall_mm) OVER z AS rlo,
        max(rainfall_mm) OVER z AS rhi FROM customers WINDOW z AS (PARTITION BY zone))"""
    ),
    "expanding_folds": over_customers(
        "SELECT zone, date, cast(fold AS integer) AS fold, role FROM roles WHERE role IS NOT NULL", _EXPAND
    ),
    "row_folds": over_customers(
        "SELECT zone, date, cast(fold AS integer) AS fold, role FROM roles WHERE role IS NOT NULL",
        _EXPAND.replace("dense_rank() OVER (ORDER BY date)", "row_number() OVER (ORDER BY zone, date)"),
    ),
    "stratified_folds": over_customers(
        """SELECT zone, date, risk_code, cast((row_number() OVER (PARTITION BY risk_code
        ORDER BY md5(zone), zone, date) - 1) % 5 AS integer) AS fold FROM customers"""
    ),
    "bounded_balance": over_customers(
        f"SELECT zone, date, {r('x', 6)} AS balance FROM walk", _BALANCE
    ).replace("WITH ", "WITH RECURSIVE ", 1),
    "residual_acf": over_panel(
        f"""SELECT zone, cast(k AS integer) AS lag, {r('sum(p) / any_value(total)', 6)} AS acf,
        {r('any_value(sd)', 6)} AS residual_std, {r('any_value(q25)', 6)} AS q25, {r('any_value(q50)', 6)} AS q50,
        {r('any_value(q75)', 6)} AS q75 FROM shifted JOIN spread USING (zone) GROUP BY zone, k""",
        _PERSIST,
        _ACF,
    ),
    "standardised_residuals": over_panel(
        f"""SELECT zone, date, {r('residual', 6)} AS residual, {r('''(residual - avg(residual) OVER
        (PARTITION BY zone)) / nullif(stddev_samp(residual) OVER (PARTITION BY zone), 0)''', 6)} AS standardised
        FROM resid""",
        _PERSIST,
    ),
    "standard_scale": over_customers(
        f"""SELECT zone, date, CASE WHEN date <= edge THEN 'train' ELSE 'test' END AS role, {_SCALE_SQL}
        FROM customers, cut, fit""",
        "cut AS (SELECT max(date) - INTERVAL 3 YEAR AS edge FROM customers)",
        f"fit AS (SELECT {_SCALE_FIT} FROM customers, cut WHERE date <= edge)",
    ),
    "physics_fit": over_panel(
        f"""SELECT zone, date, {r('flow', 6)} AS darcy_recharge, {r('a + b * flow', 6)} AS physics
        FROM flows, (SELECT regr_slope(groundwater_level, flow) AS b, regr_intercept(groundwater_level, flow) AS a
        FROM flows)""",
        f"flows AS (SELECT zone, date, groundwater_level, {_FLOW} AS flow FROM panel)",
    ),
    "df_test": over_panel(
        f"""SELECT zone, n, {r('b', 6)} AS slope, {r('t', 6)} AS t_stat, {r('crit', 6)} AS critical,
        cast(t < crit AS integer) AS stationary FROM tests""",
        _DF,
    ),
    "recursive_forecast": over_panel(
        f"""SELECT zone, step, cast(last_date + to_months(step) AS date) AS date, {r('value', 6)} AS predicted_gw
        FROM steps""",
        AR1.format(24),
    ).replace("WITH ", "WITH RECURSIVE ", 1),
    "linear_contrib": over_customers(
        f"SELECT feature, {r('v', 6)} AS mean_abs FROM ({_CONTRIB})",
        "cut AS (SELECT max(date) - INTERVAL 3 YEAR AS edge FROM customers)",
        """sums AS (SELECT avg(rainfall_mm) AS m1, avg(temperature_c) AS m2, var_pop(rainfall_mm) * count(*) AS s11,
        var_pop(temperature_c) * count(*) AS s22, covar_pop(rainfall_mm, temperature_c) * count(*) AS s12,
        covar_pop(rainfall_mm, groundwater_level) * count(*) AS b1,
        covar_pop(temperature_c, groundwater_level) * count(*) AS b2 FROM customers, cut WHERE date <= edge)""",
    ),
    "whatif_vector": over_panel(
        f"""SELECT zone, latitude, longitude, is_coastal, cast(CASE soil_type WHEN 'Alluvial' THEN 0 WHEN 'Clayey'
        THEN 1 WHEN 'Loamy' THEN 2 WHEN 'Rocky' THEN 3 WHEN 'Sandy' THEN 4 END AS integer) AS soil_type_enc,
        soil_permeability, rainfall_mm, temperature_c, evapotranspiration, ndvi, population_density,
        urban_fraction, cast(year(date) AS integer) AS year, cast(month(date) AS integer) AS month,
        {r('sin(2 * pi() * month(date) / 12)', 6)} AS month_sin, {r('cos(2 * pi() * month(date) / 12)', 6)} AS month_cos,
        cast({_SEASON} AS integer) AS season, cast(month(date) BETWEEN 6 AND 12 AS integer) AS is_monsoon,
        0e0 AS spi, {r('''0.5e0 * urban_fraction + 0.3e0 * ((population_density - lo) / (hi - lo + 1e-9))
        + 0.2e0 * (1 - ndvi)''', 6)} AS urbanization_index,
        {', '.join(f"10e0 AS gw_lag_{k}, {r('rainfall_mm * 0.9e0', 6)} AS rain_lag_{k}" for k in (1, 3, 6, 12))},
        {', '.join(f"rainfall_mm AS rain_roll_mean_{k}, temperature_c AS temp_roll_mean_{k}, 0.5e0 AS gw_roll_std_{k}"
                   for k in (3, 6, 12))}
        FROM panel, (SELECT min(population_density) AS lo, max(population_density) AS hi FROM panel)"""
    ),
    "whatif_echo": over_panel(
        """SELECT zone, cast(year(date) AS integer) AS year, cast(month(date) AS integer) AS month,
        zone AS "echo_Zone", soil_type AS "echo_Soil", rainfall_mm AS "echo_Rainfall_mm",
        temperature_c AS "echo_Temperature_C", ndvi AS "echo_NDVI", urban_fraction AS "echo_Urban_Fraction",
        cast(month(date) AS double) AS "echo_Month", cast(year(date) AS double) AS "echo_Year" FROM panel"""
    ),
    "scenario_projection": over_panel("SELECT * FROM projected", _SCENARIO),
    "scenario_vs_history": over_panel(
        f"""SELECT zone, replace(scenario, '_', ' ') AS scenario, year, {r('avg(gw_level_proj)', 6)} AS gw_level
        FROM projected GROUP BY 1, 2, 3 UNION ALL SELECT zone, 'Historical', cast(year(date) AS integer),
        {r('avg(groundwater_level)', 6)} FROM panel GROUP BY 1, 2, 3""",
        _SCENARIO,
    ),
    "grid_mesh": over_panel(
        f"SELECT ix, iy, {r('gx', 9)} AS longitude, {r('gy', 9)} AS latitude FROM mesh", _POINTS, _mesh(200)
    ),
    "idw_grid": over_panel(_IDW, _POINTS, _mesh(200)),
    "idw_exact": over_panel(_IDW, _COARSE, _mesh(103)),
    "map_features": over_panel(
        f"""SELECT zone, latitude, longitude, {COLOUR_CASE.format('risk_label')} AS colour,
        'GW Level: ' || {_txt('raw_level', 2)} || ' m; Risk: ' || risk_label || '; Rainfall: ' || {_txt('raw_rain', 1)}
        || ' mm; Urban Frac: ' || {_txt('raw_urban', 2)} AS popup, zone || ' (' || risk_label || ')' AS tooltip,
        {r('raw_level / (SELECT max(v) FROM points)', 6)} AS heat
        FROM (SELECT s.*, p.v AS raw_level, p.rainfall AS raw_rain, p.urban_frac AS raw_urban
        FROM summary s JOIN points p USING (zone))""",
        _MODE.format("panel", f"WHERE year(date) = {YEAR}"),
        f"summary AS ({_summary('panel', f'WHERE year(date) = {YEAR}')})",
        _POINTS,
    ),
    "risk_points": over_panel(
        f"""SELECT zone, longitude, latitude, risk_label, {COLOUR_CASE.format('risk_label')} AS colour,
        risk_code AS risk_order FROM ({_summary('panel', f'WHERE year(date) = {YEAR}')})""",
        _MODE.format("panel", f"WHERE year(date) = {YEAR}"),
    ),
}
