"""Registered queries: sources, projections, filters and joins."""

from pyspark.sql import functions as F

from zonalis.functions import measures as m
from zonalis.operators import calendar, evaluation, features, scenarios, selection, summaries, timeseries
from zonalis.plans.base import (
    PANEL_LIST,
    RISK_CODE_CASE,
    RISK_LABEL_CASE,
    RISK_LEVEL_CASE,
    SOIL_CASE,
    over_both,
    over_customers,
    over_panel,
    r,
    shown,
)
from zonalis.session import fresh_path, stage
from zonalis.sources import panel as io
from zonalis.sources import tables
from zonalis.sources.tables import customer_panel, zone_panel

YEAR = 1998
ZONES = ["NATION_3", "NATION_7", "NATION_11"]
EXPORTED = "NATION_7"


# --- sources and sinks --------------------------------------------------------
def panel_scan(spark, sf_dir):
    path = fresh_path(spark, "panel")
    io.write_panel(zone_panel(spark, sf_dir), path, by_year=True)
    return io.sorted_panel(io.read_panel(spark, path))


def panel_write_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "panel-csv")
    io.write_panel(customer_panel(spark, sf_dir), path, "csv")
    return io.read_panel(spark, path, "csv")


def forecast_sink(spark, sf_dir):
    path = fresh_path(spark, "forecasts")
    rows = timeseries.recursive_forecast(stage(zone_panel(spark, sf_dir)), 12)
    io.write_forecasts(shown(rows, 6, "predicted_gw").select("date", "zone", "predicted_gw"), path)
    return io.read_forecasts(spark, path)


def metrics_sink(spark, sf_dir):
    path = fresh_path(spark, "metrics")
    scored = evaluation.persistence(zone_panel(spark, sf_dir)).drop("model").withColumnRenamed("zone", "model")
    metrics = shown(evaluation.regression_metrics(scored), 6, "RMSE", "MAE", "R2")
    io.write_metrics(metrics, path)
    return io.read_metrics(spark, path, metrics.schema)


def zone_export(spark, sf_dir):
    path = fresh_path(spark, "export")
    io.export_zone(zone_panel(spark, sf_dir), EXPORTED, path)
    return io.read_panel(spark, path, "csv")


# --- projections -----------------------------------------------------------------
def date_spine(spark, sf_dir):
    return calendar.zone_spine(customer_panel(spark, sf_dir))


def risk_binning(spark, sf_dir):
    stretched = F.col("groundwater_level") * 1.2 - 2
    return zone_panel(spark, sf_dir).select(
        "zone", "date", m.risk_level(F.col("groundwater_level")).alias("risk"), m.risk_level(stretched).alias("stretched")
    )


def risk_code_map(spark, sf_dir):
    panel = zone_panel(spark, sf_dir)
    code = m.risk_code(F.col("risk_level"))
    return panel.select("zone", "date", code.alias("code"), m.risk_label(code).alias("label"))


def temporal_features(spark, sf_dir):
    rows = features.add_calendar(zone_panel(spark, sf_dir))
    kept = rows.select("zone", "date", "year", "month", "month_sin", "month_cos")
    return shown(kept, 9, "month_sin", "month_cos")


def season_flags(spark, sf_dir):
    return features.add_calendar(zone_panel(spark, sf_dir)).select("zone", "date", "season", "is_monsoon")


def label_encode(spark, sf_dir):
    return features.encode_soil(zone_panel(spark, sf_dir)).select("zone", "date", "soil_type", "soil_type_enc")


def one_hot_zone(spark, sf_dir):
    return features.one_hot_zone(stage(customer_panel(spark, sf_dir).select("zone", "date")))


def clip_round(spark, sf_dir):
    level, urban = F.col("groundwater_level"), F.col("urban_fraction")
    return zone_panel(spark, sf_dir).select(
        "zone",
        "date",
        m.rounded(m.bounded(level * 1.7 - 4, 1, 35), 3).alias("level"),
        m.rounded(m.bounded(urban * 1.3, 0, 1), 2).alias("urban"),
        m.rounded(F.col("population_density") * 1.01, 0).alias("population"),
    )


def slug(spark, sf_dir):
    return customer_panel(spark, sf_dir).select(
        "zone",
        "date",
        m.slug(F.concat_ws(" ", "zone", "soil_type", "risk_level")).alias("slug"),
        m.spaced(F.concat_ws("_", "zone", "soil_type")).alias("label"),
    )


def growth_trends(spark, sf_dir):
    rows = scenarios.growth_trends(zone_panel(spark, sf_dir))
    return shown(rows, 6, "population_per_year", "urban_per_year")


def covariate_proxies(spark, sf_dir):
    rows = scenarios.covariate_lines(zone_panel(spark, sf_dir))
    return shown(rows, 4, "et_slope", "et_intercept", "ndvi_slope", "ndvi_intercept")


def urbanization_index(spark, sf_dir):
    rows = features.add_urbanization(stage(zone_panel(spark, sf_dir)))
    return shown(rows.select("zone", "date", "urbanization_index"), 9, "urbanization_index")


def darcy_recharge(spark, sf_dir):
    rows = features.add_physics(customer_panel(spark, sf_dir))
    return shown(rows.select("zone", "date", "darcy_recharge"), 10, "darcy_recharge")


def water_balance(spark, sf_dir):
    rows = features.add_physics(customer_panel(spark, sf_dir))
    return shown(rows.select("zone", "date", "water_balance"), 10, "water_balance")


def null_policy(spark, sf_dir):
    lagged = features.add_lags(zone_panel(spark, sf_dir)).select("zone", "date", "gw_lag_12", "rain_lag_3")
    dropped = features.drop_incomplete(lagged, ["gw_lag_12"]).withColumn("policy", F.lit("drop"))
    filled = features.fill_missing(lagged, ["gw_lag_12", "rain_lag_3"]).withColumn("policy", F.lit("fill"))
    return summaries.union_panels(dropped, filled)


def feature_align(spark, sf_dir):
    trained = ["rainfall_mm", "gw_lag_1", "ndvi", "zone_elsewhere", "urban_fraction"]
    return features.align_features(zone_panel(spark, sf_dir), trained, keep=["zone", "date"])


def gauge_band(spark, sf_dir):
    share = m.gauge_share(F.col("groundwater_level"))
    return zone_panel(spark, sf_dir).select(
        "zone", "date", m.rounded(share, 9).alias("share"), m.gauge_colour(share).alias("colour")
    )


def zone_snapshot(spark, sf_dir):
    return summaries.zone_snapshot(stage(zone_panel(spark, sf_dir)))


# --- filters and splits -------------------------------------------------------------
def latest_snapshot(spark, sf_dir):
    return selection.at_latest_date(stage(zone_panel(spark, sf_dir)))


def year_slice(spark, sf_dir):
    return selection.in_year(zone_panel(spark, sf_dir), YEAR)


def zone_slice(spark, sf_dir):
    return selection.in_zones(zone_panel(spark, sf_dir), ZONES)


def time_split(spark, sf_dir):
    rows = stage(customer_panel(spark, sf_dir).select("zone", "date", "groundwater_level", "risk_code"))
    return selection.split_by_time(rows)


def positional_split(spark, sf_dir):
    rows = selection.split_by_position(customer_panel(spark, sf_dir).select("zone", "date"))
    return rows.withColumn("series_rows", F.col("series_rows").cast("long"))


def min_history(spark, sf_dir):
    return selection.with_history(customer_panel(spark, sf_dir).select("zone", "date", "groundwater_level"))


# --- joins ------------------------------------------------------------------------
def climatology_join(spark, sf_dir):
    rows = features.join_climatology(stage(customer_panel(spark, sf_dir).select("zone", "date", "rainfall_mm")))
    return shown(rows, 6, "rain_monthly_mean", "rain_monthly_std")


def dim_lookup(spark, sf_dir):
    """Rollup rows with the attributes of their zone and the permeability of its soil."""
    nations = tables.zone_dimension(
        tables.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("zone"))
    )
    soils = spark.createDataFrame(
        list(features.fixed.SOIL_PERMEABILITY.items()), "soil_type string, soil_permeability double"
    )
    facts = tables.zone_rollup(spark, sf_dir).select("zone", "date", "readings")
    # five soil rows are safe to broadcast; the zone side is left to the optimizer's size check
    return facts.join(nations.drop("k"), "zone").join(F.broadcast(soils), "soil_type")


def pred_actual(spark, sf_dir):
    panel = stage(customer_panel(spark, sf_dir).select("zone", "date", "groundwater_level"))
    return evaluation.align_predictions(
        {"persistence": evaluation.persistence(panel), "quarter": evaluation.persistence(panel, 3)}
    )


def panel_sorted(spark, sf_dir):
    return io.sorted_panel(customer_panel(spark, sf_dir))


def first_zones(spark, sf_dir):
    rows = stage(zone_panel(spark, sf_dir).select("zone", "date", "groundwater_level"))
    return selection.first_zones(rows)


def zone_list(spark, sf_dir):
    return selection.zone_list(customer_panel(spark, sf_dir))


def union_panels(spark, sf_dir):
    return summaries.union_panels(zone_panel(spark, sf_dir), customer_panel(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in [
        panel_scan,
        panel_write_roundtrip,
        forecast_sink,
        metrics_sink,
        zone_export,
        date_spine,
        risk_binning,
        risk_code_map,
        temporal_features,
        season_flags,
        label_encode,
        one_hot_zone,
        clip_round,
        slug,
        growth_trends,
        covariate_proxies,
        urbanization_index,
        darcy_recharge,
        water_balance,
        null_policy,
        feature_align,
        gauge_band,
        zone_snapshot,
        latest_snapshot,
        year_slice,
        zone_slice,
        time_split,
        positional_split,
        min_history,
        climatology_join,
        dim_lookup,
        pred_actual,
        panel_sorted,
        first_zones,
        zone_list,
        union_panels,
    ]
}

W = "(PARTITION BY zone ORDER BY date)"
AR1 = """lagged AS (SELECT zone, date, groundwater_level AS y,
  lag(groundwater_level) OVER (PARTITION BY zone ORDER BY date) AS x FROM panel),
fits AS (SELECT zone, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, max(date) AS last_date,
  arg_max(y, date) AS level FROM lagged GROUP BY zone),
steps(zone, step, value, a, b, last_date) AS (
  SELECT zone, 1, a + b * level, a, b, last_date FROM fits
  UNION ALL SELECT zone, step + 1, a + b * value, a, b, last_date FROM steps WHERE step < {0})"""

_NDVI = "greatest(0e0, least(1e0, 0.55e0 - 0.3e0 * urban_fraction))"
_FLOW = "greatest((1 - urban_fraction) * soil_permeability * rainfall_mm * 0.01e0, 0e0)"
_SEASON = "CASE WHEN month(date) IN (10, 11, 12) THEN 2 WHEN month(date) IN (6, 7, 8, 9) THEN 1 ELSE 0 END"


def _text(column: str, digits: int) -> str:
    return f"printf('%.{digits}f', {r(column, digits)})"


ORACLE = {
    "panel_scan": over_panel(f"SELECT {PANEL_LIST} FROM panel"),
    "panel_write_roundtrip": over_customers(f"SELECT {PANEL_LIST} FROM customers"),
    "forecast_sink": over_panel(
        f"""SELECT cast(last_date + to_months(step) AS date) AS date, zone, {r('value', 6)} AS predicted_gw,
        replace(zone, ' ', '_') AS zone_slug FROM steps""",
        AR1.format(12),
    ).replace("WITH ", "WITH RECURSIVE ", 1),
    "metrics_sink": over_panel(
        f"""SELECT zone AS model, count(*) AS n, {r('sqrt(avg((y - p) * (y - p)))', 6)} AS "RMSE",
        {r('avg(abs(y - p))', 6)} AS "MAE",
        {r('1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*))', 6)} AS "R2"
        FROM (SELECT zone, groundwater_level AS y, lag(groundwater_level) OVER {W} AS p FROM panel)
        WHERE p IS NOT NULL GROUP BY zone"""
    ),
    "zone_export": over_panel(f"SELECT {PANEL_LIST} FROM panel WHERE zone = '{EXPORTED}'"),
    "date_spine": over_customers(
        """SELECT zone, cast(unnest(generate_series(min(date), max(date), INTERVAL 1 MONTH)) AS date) AS date
        FROM customers GROUP BY zone"""
    ),
    "risk_binning": over_panel(
        f"""SELECT zone, date, {RISK_LEVEL_CASE.format('groundwater_level')} AS risk,
        {RISK_LEVEL_CASE.format('(groundwater_level * 1.2e0 - 2)')} AS stretched FROM panel"""
    ),
    "risk_code_map": over_panel(
        f"""SELECT zone, date, {RISK_CODE_CASE.format('risk_level')} AS code,
        {RISK_LABEL_CASE.format('risk_code')} AS label FROM panel"""
    ),
    "temporal_features": over_panel(
        f"""SELECT zone, date, cast(year(date) AS integer) AS year, cast(month(date) AS integer) AS month,
        {r('sin(2 * pi() * month(date) / 12)', 9)} AS month_sin,
        {r('cos(2 * pi() * month(date) / 12)', 9)} AS month_cos FROM panel"""
    ),
    "season_flags": over_panel(
        f"""SELECT zone, date, cast({_SEASON} AS integer) AS season,
        cast(({_SEASON}) > 0 AS integer) AS is_monsoon FROM panel"""
    ),
    "label_encode": over_panel(
        """SELECT zone, date, soil_type, cast(dense_rank() OVER (ORDER BY soil_type) - 1 AS integer)
        AS soil_type_enc FROM panel"""
    ),
    "one_hot_zone": over_customers(
        """SELECT zone, date, dense_rank() OVER (ORDER BY zone) - 1 AS slot,
        (SELECT count(DISTINCT zone) FROM customers) AS slots FROM customers"""
    ),
    "clip_round": over_panel(
        f"""SELECT zone, date,
        {r('greatest(1e0, least(35e0, groundwater_level * 1.7e0 - 4))', 3)} AS level,
        {r('greatest(0e0, least(1e0, urban_fraction * 1.3e0))', 2)} AS urban,
        {r('population_density * 1.01e0', 0)} AS population FROM panel"""
    ),
    "slug": over_customers(
        """SELECT zone, date, replace(concat_ws(' ', zone, soil_type, risk_level), ' ', '_') AS slug,
        replace(concat_ws('_', zone, soil_type), '_', ' ') AS label FROM customers"""
    ),
    "growth_trends": over_panel(
        f"""SELECT zone, {r('regr_slope(population_density, year(date) - 1995)', 6)} AS population_per_year,
        {r('regr_slope(urban_fraction, year(date) - 1995)', 6)} AS urban_per_year FROM panel GROUP BY zone"""
    ),
    "covariate_proxies": over_panel(
        f"""SELECT zone, {r('regr_slope(evapotranspiration, temperature_c)', 4)} AS et_slope,
        {r('regr_intercept(evapotranspiration, temperature_c)', 4)} AS et_intercept,
        {r('regr_slope(ndvi, urban_fraction)', 4)} AS ndvi_slope,
        {r('regr_intercept(ndvi, urban_fraction)', 4)} AS ndvi_intercept FROM panel GROUP BY zone"""
    ),
    "urbanization_index": over_panel(
        f"""SELECT zone, date, {r('''0.5e0 * urban_fraction + 0.3e0 * ((population_density - lo) / (hi - lo + 1e-9))
        + 0.2e0 * (1 - ndvi)''', 9)} AS urbanization_index
        FROM panel, (SELECT min(population_density) AS lo, max(population_density) AS hi FROM panel)"""
    ),
    "darcy_recharge": over_customers(f"SELECT zone, date, {r(_FLOW, 10)} AS darcy_recharge FROM customers"),
    "water_balance": over_customers(
        f"""SELECT zone, date, {r(f'{_FLOW} - (evapotranspiration * 0.05e0 + urban_fraction * 0.3e0)', 10)}
        AS water_balance FROM customers"""
    ),
    "null_policy": over_panel(
        """SELECT *, 'drop' AS policy FROM lags WHERE gw_lag_12 IS NOT NULL UNION ALL
        SELECT zone, date, coalesce(gw_lag_12, 0) AS gw_lag_12, coalesce(rain_lag_3, 0) AS rain_lag_3,
        'fill' AS policy FROM lags""",
        f"""lags AS (SELECT zone, date, lag(groundwater_level, 12) OVER {W} AS gw_lag_12,
        lag(rainfall_mm, 3) OVER {W} AS rain_lag_3 FROM panel)""",
    ),
    "feature_align": over_panel(
        """SELECT zone, date, rainfall_mm, 0 AS gw_lag_1, ndvi, 0 AS zone_elsewhere, urban_fraction FROM panel"""
    ),
    "gauge_band": over_panel(
        f"""SELECT zone, date, {r('s', 9)} AS share, CASE WHEN s < 0.33e0 THEN '#2ecc71'
        WHEN s < 0.66e0 THEN '#f39c12' ELSE '#e74c3c' END AS colour
        FROM (SELECT zone, date, greatest(0e0, least(1e0, groundwater_level / 35e0)) AS s FROM panel)"""
    ),
    "zone_snapshot": over_panel(
        f"""SELECT zone AS "Zone", {_text('groundwater_level', 2)} AS "GW Level (m)", risk_level AS "Risk",
        {_text('rainfall_mm', 1)} AS "Rainfall (mm)", {_text('temperature_c', 1)} AS "Temp (C)",
        {_text('urban_fraction', 2)} AS "Urban Frac"
        FROM panel WHERE date = (SELECT max(date) FROM panel)"""
    ),
    "latest_snapshot": over_panel(
        f"SELECT {PANEL_LIST} FROM panel WHERE date = (SELECT max(date) FROM panel)"
    ),
    "year_slice": over_panel(f"SELECT {PANEL_LIST} FROM panel WHERE year(date) = {YEAR}"),
    "zone_slice": over_panel(
        f"SELECT {PANEL_LIST} FROM panel WHERE zone IN ({', '.join(repr(z) for z in ZONES)})"
    ),
    "time_split": over_customers(
        """SELECT zone, date, groundwater_level, risk_code, CASE WHEN date <= cutoff THEN 'train'
        ELSE 'test' END AS role FROM customers,
        (SELECT max(date) - INTERVAL 3 YEAR AS cutoff FROM customers)"""
    ),
    "positional_split": over_customers(
        """SELECT zone, date, cast(rn AS integer) AS row_in_series, n AS series_rows,
        CASE WHEN rn <= floor(floor(n * 0.8e0) * 0.85e0) THEN 'fit' WHEN rn <= floor(n * 0.8e0)
        THEN 'validation' ELSE 'test' END AS role,
        cast(rn <= floor(n * 0.8e0) AND rn > floor(n * 0.8e0) - 12 AS integer) AS test_context
        FROM (SELECT zone, date, row_number() OVER (PARTITION BY zone ORDER BY date) AS rn,
        count(*) OVER (PARTITION BY zone) AS n FROM customers)"""
    ),
    "min_history": over_customers(
        """SELECT zone, date, groundwater_level, count(*) OVER (PARTITION BY zone) AS series_rows
        FROM customers QUALIFY series_rows >= 36"""
    ),
    "climatology_join": over_customers(
        f"""SELECT cast(month(date) AS integer) AS month, zone, date, rainfall_mm,
        {r('mu', 6)} AS rain_monthly_mean, {r('sd', 6)} AS rain_monthly_std
        FROM customers LEFT JOIN (SELECT month(date) AS m, avg(rainfall_mm) AS mu,
        stddev_samp(rainfall_mm) AS sd FROM customers GROUP BY 1) ON month(date) = m"""
    ),
    "dim_lookup": over_panel(
        f"""SELECT zone, date, readings, latitude, longitude, is_coastal, soil_type,
        {SOIL_CASE.format('soil_type')} AS soil_permeability
        FROM (SELECT n_name AS zone, cast(date_trunc('month', l_shipdate) AS date) AS date, count(*) AS readings,
          any_value(round(12.90e0 + 0.01e0 * ((n_nationkey * 7) % 25), 3)) AS latitude,
          any_value(round(80.10e0 + 0.01e0 * ((n_nationkey * 11) % 25), 3)) AS longitude,
          any_value(cast(n_nationkey % 3 = 0 AS integer)) AS is_coastal,
          any_value(['Sandy', 'Clayey', 'Loamy', 'Rocky', 'Alluvial'][n_nationkey % 5 + 1]) AS soil_type
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
          JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)"""
    ),
    "pred_actual": over_customers(
        f"""SELECT zone, date, y, persistence, quarter FROM (SELECT zone, date, groundwater_level AS y,
        lag(groundwater_level) OVER {W} AS persistence, lag(groundwater_level, 3) OVER {W} AS quarter
        FROM customers) WHERE quarter IS NOT NULL"""
    ),
    "panel_sorted": over_customers(f"SELECT {PANEL_LIST} FROM customers ORDER BY zone, date"),
    "first_zones": over_panel(
        """SELECT zone, date, groundwater_level FROM panel
        WHERE zone IN (SELECT DISTINCT zone FROM panel ORDER BY zone LIMIT 3)"""
    ),
    "zone_list": over_customers("SELECT DISTINCT zone FROM customers"),
    "union_panels": over_both(f"SELECT {PANEL_LIST} FROM panel UNION ALL SELECT {PANEL_LIST} FROM customers"),
}
