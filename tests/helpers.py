import datetime as dt

import numpy as np
import pandas as pd

from zonalis.sources.panel import PANEL_COLUMNS, PANEL_SCHEMA


def month(index, start=(2000, 1)):
    total = start[0] * 12 + start[1] - 1 + index
    return dt.date(total // 12, total % 12 + 1, 1)


def series(spark, values, zone="A", start=(2000, 1), months=None):
    """(zone, date, groundwater_level) from values in month order."""
    at = range(len(values)) if months is None else months
    rows = [(zone, month(i, start), None if v is None else float(v)) for i, v in zip(at, values)]
    return spark.createDataFrame(rows, "zone string, date date, groundwater_level double")


def make_panel(spark, zones=6, months=72, seed=3):
    """A panel with a learnable level: a base per zone, a seasonal swing and a rain response."""
    rng = np.random.default_rng(seed)
    soils = {"Sandy": 0.9, "Clayey": 0.2, "Loamy": 0.6, "Rocky": 0.1, "Alluvial": 0.75}
    names = list(soils)
    rows = []
    for z in range(zones):
        base = 8.0 + 2.2 * z
        for t in range(months):
            date = month(t)
            wet = 150 if date.month >= 10 else 40
            rain = round(float(rng.gamma(2, wet / 2)), 2)
            temp = round(28 + 6 * float(np.sin(t / 12 * 2 * np.pi)) + float(rng.normal(0, 0.5)), 2)
            urban = round(min(1.0, 0.3 + 0.05 * z + 0.002 * t), 3)
            swing = 4 * float(np.sin(t / 12 * 2 * np.pi))
            level = float(np.clip(base + swing - 0.004 * rain + rng.normal(0, 0.2), 1, 35))
            soil = names[z % 5]
            risk = "Low" if level <= 12 else "Medium" if level <= 20 else "High"
            rows.append(
                {
                    "date": date,
                    "zone": f"Zone {z}",
                    "latitude": 13.0 + 0.02 * z,
                    "longitude": 80.1 + 0.03 * z,
                    "is_coastal": z % 2,
                    "soil_type": soil,
                    "soil_permeability": soils[soil],
                    "rainfall_mm": rain,
                    "temperature_c": temp,
                    "evapotranspiration": round(0.6 * temp, 2),
                    "ndvi": round(0.55 - 0.3 * urban, 3),
                    "population_density": round(9000 + 500.0 * z + 10 * t, 0),
                    "urban_fraction": urban,
                    "groundwater_level": round(level, 3),
                    "risk_level": risk,
                    "risk_code": {"Low": 0, "Medium": 1, "High": 2}[risk],
                }
            )
    return spark.createDataFrame(pd.DataFrame(rows)[PANEL_COLUMNS], PANEL_SCHEMA)


def by(rows, *keys):
    return sorted(rows, key=lambda r: tuple(str(r[k]) for k in keys))
