"""Shared pieces of the registered queries and of their SQL counterparts."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.functions import measures as m


def shown(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round computed columns for output."""
    chosen = set(columns)
    return df.select(
        *[m.rounded(F.col(f"`{c}`"), digits).alias(c) if c in chosen else F.col(f"`{c}`") for c in df.columns]
    )


def r(expression: str, digits: int) -> str:
    """SQL counterpart of ``shown``; adding zero turns a negative zero into zero."""
    return f"(round({expression}, {digits}) + 0.0)"


def _rollup_sql(name: str, key: str, zone: str, source: str) -> str:
    mean = "cast(sum(cast({0} as decimal(18,2))) as double) / count(*)"
    measures = ", ".join(
        f"{mean.format(c)} AS {a}"
        for c, a in [("l_quantity", "q"), ("l_extendedprice", "p"), ("l_discount", "disc"), ("l_tax", "tax")]
    )
    return (
        f"{name}_rollup AS (SELECT {key} AS k, {zone} AS zone, "
        f"cast(date_trunc('month', l_shipdate) AS date) AS date, {measures} "
        f"FROM lineitem JOIN orders ON l_orderkey = o_orderkey {source} GROUP BY 1, 2, 3)"
    )


SOIL_CASE = (
    "CASE {0} WHEN 'Sandy' THEN 0.9e0 WHEN 'Clayey' THEN 0.2e0 WHEN 'Loamy' THEN 0.6e0 "
    "WHEN 'Rocky' THEN 0.1e0 WHEN 'Alluvial' THEN 0.75e0 END"
)
RISK_LEVEL_CASE = (
    "CASE WHEN {0} > 0 AND {0} <= 12 THEN 'Low' WHEN {0} > 12 AND {0} <= 20 THEN 'Medium' "
    "WHEN {0} > 20 AND {0} <= 36 THEN 'High' END"
)
RISK_CODE_CASE = "cast(CASE {0} WHEN 'Low' THEN 0 WHEN 'Medium' THEN 1 WHEN 'High' THEN 2 END AS integer)"
RISK_LABEL_CASE = "CASE {0} WHEN 0 THEN 'Low' WHEN 1 THEN 'Medium' WHEN 2 THEN 'High' END"
COLOUR_CASE = (
    "CASE {0} WHEN 'Low' THEN '#2ecc71' WHEN 'Medium' THEN '#f39c12' WHEN 'High' THEN '#e74c3c' "
    "ELSE 'blue' END"
)


def _panel_sql(name: str) -> str:
    years = "(year(date) - 1995)"
    return f"""
{name}_moments AS (SELECT avg(p) AS mu, stddev_samp(p) AS sd FROM {name}_rollup),
{name}_measured AS (
  SELECT date, zone,
    cast(round(12.90e0 + 0.01e0 * ((k * 7) % 25), 3) AS double) AS latitude,
    cast(round(80.10e0 + 0.01e0 * ((k * 11) % 25), 3) AS double) AS longitude,
    cast(k % 3 = 0 AS integer) AS is_coastal,
    CASE k % 5 WHEN 0 THEN 'Sandy' WHEN 1 THEN 'Clayey' WHEN 2 THEN 'Loamy' WHEN 3 THEN 'Rocky'
      ELSE 'Alluvial' END AS soil_type,
    round(8 * q, 2) AS rainfall_mm,
    round(22 + 200 * disc, 2) AS temperature_c,
    round(greatest(0e0, least(1e0, 0.1e0 + 0.03e0 * {years} + 5 * tax)), 3) AS urban_fraction,
    round(12000 * exp(0.03e0 * {years} / 5), 0) AS population_density,
    round(greatest(1e0, least(35e0, 15 + 6 * (p - mu) / sd)), 3) AS groundwater_level
  FROM {name}_rollup, {name}_moments),
{name}_binned AS (
  SELECT *, {SOIL_CASE.format("soil_type")} AS soil_permeability,
    round(0.6e0 * temperature_c, 2) AS evapotranspiration,
    round(greatest(0e0, least(1e0, 0.55e0 - 0.3e0 * urban_fraction)), 3) AS ndvi,
    {RISK_LEVEL_CASE.format("groundwater_level")} AS risk_level
  FROM {name}_measured),
{name} AS (
  SELECT date, zone, latitude, longitude, is_coastal, soil_type, soil_permeability, rainfall_mm,
    temperature_c, evapotranspiration, ndvi, population_density, urban_fraction, groundwater_level,
    risk_level, {RISK_CODE_CASE.format("risk_level")} AS risk_code
  FROM {name}_binned)"""


_ZONES = _rollup_sql(
    "panel",
    "n_nationkey",
    "n_name",
    "JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey",
)
_CUSTOMERS = _rollup_sql("customers", "o_custkey", "'C' || cast(o_custkey AS varchar)", "")
_EVENTS = (
    "events_daily AS (SELECT cast(user_id AS varchar) AS zone, cast(ts AS date) AS date, "
    "cast(sum(cast(value AS decimal(18,2))) AS double) / count(*) AS groundwater_level "
    "FROM events GROUP BY 1, 2)"
)


def over_panel(body: str, *ctes: str) -> str:
    """SQL over the nation-by-month panel, with more named steps before the body."""
    return f"WITH {', '.join([_ZONES, _panel_sql('panel').strip(), *ctes])} {body}"


def over_customers(body: str, *ctes: str) -> str:
    return f"WITH {', '.join([_CUSTOMERS, _panel_sql('customers').strip(), *ctes])} {body}"


def over_both(body: str, *ctes: str) -> str:
    both = [_ZONES, _panel_sql("panel").strip(), _CUSTOMERS, _panel_sql("customers").strip()]
    return f"WITH {', '.join([*both, *ctes])} {body}"


def over_events(body: str, *ctes: str) -> str:
    return f"WITH {', '.join([_EVENTS, *ctes])} {body}"


PANEL_LIST = (
    "date, zone, latitude, longitude, is_coastal, soil_type, soil_permeability, rainfall_mm, "
    "temperature_c, evapotranspiration, ndvi, population_density, urban_fraction, groundwater_level, "
    "risk_level, risk_code"
)
