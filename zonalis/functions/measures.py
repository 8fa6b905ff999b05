"""Column functions: everything here is a built-in expression, so it stays in codegen."""

import math
from pyspark.sql import Column
from pyspark.sql import functions as F

from zonalis.functions import fixed


def rounded(value: Column, digits: int) -> Column:
    """Round half away from zero using plain double arithmetic (cheaper than ``round``)."""
    scale = float(10**digits)
    up = F.floor(value * scale + 0.5) / scale
    down = -F.floor(-value * scale + 0.5) / scale
    return F.when(value >= 0, up).otherwise(down)


def bounded(value: Column, low: float, high: float) -> Column:
    """Clip to [low, high]; null stays null."""
    return F.when(value < low, F.lit(float(low))).when(value > high, F.lit(float(high))).otherwise(value)


def risk_level(level: Column) -> Column:
    """Right-closed risk bins; values outside every bin are null."""
    out = F.lit(None).cast("string")
    for low, high, label in reversed(fixed.RISK_BINS):
        out = F.when((level > low) & (level <= high), F.lit(label)).otherwise(out)
    return out


def risk_code(label: Column) -> Column:
    out = F.lit(None).cast("int")
    for code, name in enumerate(fixed.RISK_LABELS):
        out = F.when(label == name, F.lit(code)).otherwise(out)
    return out


def risk_label(code: Column) -> Column:
    out = F.lit(None).cast("string")
    for number, name in enumerate(fixed.RISK_LABELS):
        out = F.when(code == number, F.lit(name)).otherwise(out)
    return out


def risk_colour(label: Column) -> Column:
    out = F.lit(fixed.OTHER_COLOUR)
    for name, colour in fixed.RISK_COLOURS.items():
        out = F.when(label == name, F.lit(colour)).otherwise(out)
    return out


def soil_permeability(soil: Column) -> Column:
    out = F.lit(None).cast("double")
    for name, value in fixed.SOIL_PERMEABILITY.items():
        out = F.when(soil == name, F.lit(value)).otherwise(out)
    return out


def month_sin(month: Column) -> Column:
    return F.sin(F.lit(2 * math.pi) * month / 12)


def month_cos(month: Column) -> Column:
    return F.cos(F.lit(2 * math.pi) * month / 12)


def season(month: Column) -> Column:
    return (
        F.when(month.isin(fixed.NORTHEAST_MONSOON), 2)
        .when(month.isin(fixed.SOUTHWEST_MONSOON), 1)
        .otherwise(0)
    )


def is_monsoon(month: Column) -> Column:
    return (season(month) > 0).cast("int")


def slug(text: Column) -> Column:
    return F.translate(text, " ", "_")


def spaced(text: Column) -> Column:
    return F.translate(text, "_", " ")


def darcy_recharge(rain: Column, permeability: Column, urban: Column) -> Column:
    flow = (1 - urban) * permeability * rain * 0.01
    return F.when(flow < 0, F.lit(0.0)).otherwise(flow)


def water_balance(recharge: Column, evapotranspiration: Column, urban: Column) -> Column:
    return recharge - (evapotranspiration * 0.05 + urban * 0.3)


def urbanization(urban: Column, population_share: Column, ndvi: Column) -> Column:
    return urban * 0.5 + population_share * 0.3 + (1 - ndvi) * 0.2


def gauge_share(value: Column, low: float = 0.0, high: float = 35.0) -> Column:
    return bounded((value - low) / (high - low), 0, 1)


def gauge_colour(share: Column) -> Column:
    green, amber, red = fixed.RISK_COLOURS.values()
    return F.when(share < 0.33, green).when(share < 0.66, amber).otherwise(red)


def month_index(date: Column) -> Column:
    """Months since year 0: consecutive months differ by one."""
    return F.year(date) * 12 + F.month(date) - 1
