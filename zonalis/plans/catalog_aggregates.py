"""Registered queries: dashboard aggregates and scores of predictions."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.operators import evaluation, features, selection, summaries
from zonalis.plans.base import RISK_LABEL_CASE, over_customers, over_panel, r, shown
from zonalis.plans.catalog_scalar import W, YEAR
from zonalis.session import stage
from zonalis.sources.tables import customer_panel, zone_panel

YEARS = list(range(1992, 1999))  # of the order calendar
LAST_COLUMNS = ["rainfall_mm", "temperature_c", "groundwater_level"]


def zone_summary(spark, sf_dir):
    rows = summaries.zone_summary(zone_panel(spark, sf_dir), YEAR)
    return shown(rows, 6, "gw_level", "rainfall", "urban_frac")


def zone_summary_latest(spark, sf_dir):
    rows = summaries.zone_summary(stage(customer_panel(spark, sf_dir)))
    return shown(rows, 6, "gw_level", "rainfall", "urban_frac")


def modal_risk(spark, sf_dir):
    return customer_panel(spark, sf_dir).groupBy("zone").agg(summaries.modal_risk().alias("modal_code"))


def annual_trend(spark, sf_dir):
    return shown(summaries.annual_trend(customer_panel(spark, sf_dir)), 6, "gw_level")


def annual_pivot(spark, sf_dir):
    """Every customer by the years of the order calendar."""
    wide = summaries.annual_pivot(customer_panel(spark, sf_dir), YEARS)
    return shown(wide, 6, *map(str, YEARS))


def seasonal_profile(spark, sf_dir):
    return shown(summaries.seasonal_profile(zone_panel(spark, sf_dir)), 6, "gw_level")


def climatology(spark, sf_dir):
    rows = features.climatology(customer_panel(spark, sf_dir))
    return shown(rows, 6, "rain_monthly_mean", "rain_monthly_std")


def kpis(spark, sf_dir):
    panel = stage(customer_panel(spark, sf_dir).select("zone", "date", "groundwater_level", "risk_code"))
    return shown(summaries.kpis(panel), 6, "latest_mean_level")


def risk_distribution(spark, sf_dir):
    panel = stage(customer_panel(spark, sf_dir).select("zone", "date", "risk_level"))
    return shown(summaries.risk_distribution(panel), 6, "percent")


def rain_level_corr(spark, sf_dir):
    return shown(summaries.rain_level_corr(zone_panel(spark, sf_dir)), 6, "pearson_r")


def zone_year_risk(spark, sf_dir):
    return shown(summaries.zone_year_risk(customer_panel(spark, sf_dir), YEAR), 6, "gw_mean")


def last_state(spark, sf_dir):
    return summaries.last_state(customer_panel(spark, sf_dir), LAST_COLUMNS)


def panel_profile(spark, sf_dir):
    rows = summaries.profile(stage(customer_panel(spark, sf_dir)))
    return shown(rows, 6, "mean", "std", "q25", "q50", "q75")


def _test_rows(panel: DataFrame, scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("date") > selection.cutoff_date(panel))


def _baselines(panel: DataFrame) -> DataFrame:
    cutoff = selection.cutoff_date(panel)
    frames = [
        evaluation.persistence(panel),
        evaluation.seasonal_naive(panel),
        evaluation.zone_climatology(panel, cutoff),
    ]
    return _test_rows(panel, reduce(DataFrame.unionByName, frames))


def _levels(spark, sf_dir, source=customer_panel):
    return stage(source(spark, sf_dir).select("zone", "date", "groundwater_level", "risk_code"))


def regression_metrics(spark, sf_dir):
    rows = evaluation.regression_metrics(_baselines(_levels(spark, sf_dir)))
    return shown(rows, 6, "RMSE", "MAE", "R2")


def leaderboard(spark, sf_dir):
    metrics = stage(evaluation.regression_metrics(_baselines(_levels(spark, sf_dir, zone_panel))))
    return shown(evaluation.leaderboard(metrics), 6, "RMSE", "MAE", "R2")


def classification_report(spark, sf_dir):
    scored = evaluation.risk_persistence(_levels(spark, sf_dir))
    return shown(evaluation.classification_report(scored), 6, "precision", "recall", "f1")


def confusion_matrix(spark, sf_dir):
    return evaluation.confusion_counts(evaluation.risk_persistence(_levels(spark, sf_dir)))


def residual_histogram(spark, sf_dir):
    scored = stage(evaluation.persistence(_levels(spark, sf_dir)).select("y", "p"))
    return shown(evaluation.residual_histogram(scored), 9, "low", "high")


def value_range(spark, sf_dir):
    return evaluation.value_range(evaluation.persistence(_levels(spark, sf_dir)))


QUERIES = {
    f.__name__: f
    for f in [
        zone_summary,
        zone_summary_latest,
        modal_risk,
        annual_trend,
        annual_pivot,
        seasonal_profile,
        climatology,
        kpis,
        risk_distribution,
        rain_level_corr,
        zone_year_risk,
        last_state,
        panel_profile,
        regression_metrics,
        leaderboard,
        classification_report,
        confusion_matrix,
        residual_histogram,
        value_range,
    ]
}

_MODE = """modes AS (SELECT zone, risk_code FROM (SELECT zone, risk_code, count(*) AS n FROM {0} {1}
  GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY zone ORDER BY n DESC, risk_code) = 1)"""


def _summary(source: str, condition: str) -> str:
    return f"""SELECT zone, min(latitude) AS latitude, min(longitude) AS longitude,
      {r('avg(groundwater_level)', 6)} AS gw_level, any_value(m.risk_code) AS risk_code,
      {r('avg(rainfall_mm)', 6)} AS rainfall, {r('avg(urban_fraction)', 6)} AS urban_frac,
      {RISK_LABEL_CASE.format('any_value(m.risk_code)')} AS risk_label
      FROM {source} JOIN modes m USING (zone) {condition} GROUP BY zone"""


_LATEST = "WHERE date = (SELECT max(date) FROM {0})"

_BASELINES = f"""cut AS (SELECT max(date) - INTERVAL 3 YEAR AS edge FROM {{0}}),
guesses AS (SELECT zone, date, groundwater_level AS y, lag(groundwater_level) OVER {W} AS persistence,
  lag(groundwater_level, 12) OVER {W} AS seasonal,
  avg(CASE WHEN date <= edge THEN groundwater_level END) OVER (PARTITION BY zone, month(date)) AS climatology,
  edge FROM {{0}}, cut),
scored AS (UNPIVOT (SELECT zone, date, y, persistence, seasonal, climatology FROM guesses WHERE date > edge)
  ON persistence, seasonal, climatology INTO NAME model VALUE p),
metrics AS (SELECT model, count(*) AS n, sqrt(avg((y - p) * (y - p))) AS rmse, avg(abs(y - p)) AS mae,
  1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2 FROM scored GROUP BY model)"""

_CLASSES = f"""scored AS (SELECT risk_code AS y, lag(risk_code) OVER {W} AS p FROM customers
  QUALIFY p IS NOT NULL),
grid AS (SELECT a.i AS actual, b.i AS predicted, count(y) AS n
  FROM (SELECT unnest([0, 1, 2]) AS i) a CROSS JOIN (SELECT unnest([0, 1, 2]) AS i) b
  LEFT JOIN scored ON y = a.i AND p = b.i GROUP BY 1, 2)"""

_REPORT = """classes AS (SELECT c.i AS code,
  coalesce(sum(n) FILTER (actual = c.i AND predicted = c.i) / nullif(sum(n) FILTER (predicted = c.i), 0), 0) AS prec,
  coalesce(sum(n) FILTER (actual = c.i AND predicted = c.i) / nullif(sum(n) FILTER (actual = c.i), 0), 0) AS rec,
  sum(n) FILTER (actual = c.i) AS support
  FROM grid CROSS JOIN (SELECT unnest([0, 1, 2]) AS i) c GROUP BY 1),
scores AS (SELECT *, coalesce(2 * prec * rec / nullif(prec + rec, 0), 0) AS f1 FROM classes),
hits AS (SELECT sum(n) FILTER (actual = predicted) / sum(n) AS acc, sum(n) AS total FROM grid)"""


def _report_row(label: str, p: str, q: str, f: str, support: str, source: str) -> str:
    return (
        f"SELECT {label} AS label, {r(p, 6)} AS precision, {r(q, 6)} AS recall, {r(f, 6)} AS f1, "
        f"cast({support} AS bigint) AS support FROM {source}"
    )


def _weighted(c: str) -> str:
    return f"sum({c} * support) / sum(support)"


_EDGES = f"""e AS (SELECT groundwater_level - lag(groundwater_level) OVER {W} AS e FROM customers QUALIFY e IS NOT NULL),
ends AS (SELECT min(e) AS lo, max(e) AS hi FROM e),
bins AS (SELECT least(floor((e - lo) / (hi - lo) * 40), 39) AS bin, count(*) AS n FROM e, ends GROUP BY 1)"""

_MEASURES = ", ".join(summaries.MEASURES)
_AS_DOUBLES = ", ".join(f"cast({c} AS double) AS {c}" for c in summaries.MEASURES)

ORACLE = {
    "zone_summary": over_panel(
        _summary("panel", f"WHERE year(date) = {YEAR}"), _MODE.format("panel", f"WHERE year(date) = {YEAR}")
    ),
    "zone_summary_latest": over_customers(
        _summary("customers", _LATEST.format("customers")),
        _MODE.format("customers", _LATEST.format("customers")),
    ),
    "modal_risk": over_customers(
        "SELECT zone, risk_code AS modal_code FROM modes", _MODE.format("customers", "")
    ),
    "annual_trend": over_customers(
        f"""SELECT zone, cast(year(date) AS integer) AS year, {r('avg(groundwater_level)', 6)} AS gw_level
        FROM customers GROUP BY 1, 2"""
    ),
    "annual_pivot": over_customers(
        "SELECT zone, "
        + ", ".join(f"{r(f'avg(groundwater_level) FILTER (year(date) = {y})', 6)} AS \"{y}\"" for y in YEARS)
        + " FROM customers GROUP BY 1"
    ),
    "seasonal_profile": over_panel(
        f"""SELECT zone, cast(month(date) AS integer) AS month, {r('avg(groundwater_level)', 6)} AS gw_level
        FROM panel GROUP BY 1, 2"""
    ),
    "climatology": over_customers(
        f"""SELECT cast(month(date) AS integer) AS month, {r('avg(rainfall_mm)', 6)} AS rain_monthly_mean,
        {r('stddev_samp(rainfall_mm)', 6)} AS rain_monthly_std FROM customers GROUP BY 1"""
    ),
    "kpis": over_customers(
        f"""SELECT {r('avg(groundwater_level) FILTER (date = latest)', 6)} AS latest_mean_level,
        count(*) FILTER (date = latest AND risk_code = 2) AS high_risk_zones, count(*) AS records,
        count(DISTINCT zone) AS zones FROM customers, (SELECT max(date) AS latest FROM customers)"""
    ),
    "risk_distribution": over_customers(
        f"""SELECT code AS risk_code, label AS risk_level, count(risk_level) AS n,
        {r('100.0e0 * count(risk_level) / sum(count(risk_level)) OVER ()', 6)} AS percent
        FROM (VALUES (0, 'Low'), (1, 'Medium'), (2, 'High')) t(code, label)
        LEFT JOIN (SELECT risk_level FROM customers WHERE date = (SELECT max(date) FROM customers))
        ON risk_level = label GROUP BY 1, 2"""
    ),
    "rain_level_corr": over_panel(
        f"""SELECT zone, {r('corr(rainfall_mm, groundwater_level)', 6)} AS pearson_r, count(*) AS n
        FROM panel GROUP BY zone"""
    ),
    "zone_year_risk": over_customers(
        f"""SELECT zone, {r('avg(groundwater_level)', 6)} AS gw_mean, any_value(m.risk_code) AS risk_code,
        {RISK_LABEL_CASE.format('any_value(m.risk_code)')} AS risk_label
        FROM customers JOIN modes m USING (zone) WHERE year(date) = {YEAR} GROUP BY zone""",
        _MODE.format("customers", f"WHERE year(date) = {YEAR}"),
    ),
    "last_state": over_customers(
        """SELECT zone, arg_max(rainfall_mm, date) AS rainfall_mm,
        arg_max(temperature_c, date) AS temperature_c, arg_max(groundwater_level, date) AS groundwater_level
        FROM customers GROUP BY zone"""
    ),
    "panel_profile": over_customers(
        f"""SELECT any_value(panel_rows) AS panel_rows, any_value(zones) AS zones,
        any_value(first_date) AS first_date, any_value(last_date) AS last_date, measure, count(value) AS count,
        {r('avg(value)', 6)} AS mean, {r('stddev_samp(value)', 6)} AS std, min(value) AS min, max(value) AS max,
        {r('quantile_cont(value, 0.25)', 6)} AS q25, {r('quantile_cont(value, 0.5)', 6)} AS q50,
        {r('quantile_cont(value, 0.75)', 6)} AS q75
        FROM (UNPIVOT (SELECT {_AS_DOUBLES} FROM customers) ON {_MEASURES} INTO NAME measure VALUE value),
        (SELECT count(*) AS panel_rows, count(DISTINCT zone) AS zones, min(date) AS first_date,
         max(date) AS last_date FROM customers) GROUP BY measure"""
    ),
    "regression_metrics": over_customers(
        f"""SELECT model, n, {r('rmse', 6)} AS "RMSE", {r('mae', 6)} AS "MAE", {r('r2', 6)} AS "R2" FROM metrics""",
        _BASELINES.format("customers"),
    ),
    "leaderboard": over_panel(
        f"""SELECT model, n, {r('rmse', 6)} AS "RMSE", {r('mae', 6)} AS "MAE", {r('r2', 6)} AS "R2",
        cast(rmse = min(rmse) OVER () AS integer) AS "best_RMSE",
        cast(mae = min(mae) OVER () AS integer) AS "best_MAE",
        cast(r2 = max(r2) OVER () AS integer) AS "best_R2",
        cast(row_number() OVER (ORDER BY rmse, model) = 1 AS integer) AS winner FROM metrics""",
        _BASELINES.format("panel"),
    ),
    "classification_report": over_customers(
        " UNION ALL ".join(
            [
                _report_row(RISK_LABEL_CASE.format("code"), "prec", "rec", "f1", "support", "scores"),
                _report_row("'accuracy'", "acc", "acc", "acc", "total", "hits"),
                _report_row("'macro avg'", "avg(prec)", "avg(rec)", "avg(f1)", "sum(support)", "scores"),
                _report_row(
                    "'weighted avg'", _weighted("prec"), _weighted("rec"), _weighted("f1"), "sum(support)", "scores"
                ),
            ]
        ),
        _CLASSES,
        _REPORT,
    ),
    "confusion_matrix": over_customers("SELECT actual, predicted, n FROM grid", _CLASSES),
    "residual_histogram": over_customers(
        f"""SELECT cast(i AS integer) AS bin, {r('lo + (hi - lo) / 40 * i', 9)} AS low,
        {r('lo + (hi - lo) / 40 * (i + 1)', 9)} AS high, coalesce(n, 0) AS n
        FROM (SELECT unnest(range(40)) AS i) CROSS JOIN ends LEFT JOIN bins ON bin = i""",
        _EDGES,
    ),
    "value_range": over_customers(
        f"""SELECT least(min(y), min(p)) AS low, greatest(max(y), max(p)) AS high FROM
        (SELECT groundwater_level AS y, lag(groundwater_level) OVER {W} AS p FROM customers QUALIFY p IS NOT NULL)"""
    ),
}
