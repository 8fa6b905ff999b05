"""Lookups, bins, colours and parameters that results depend on."""

# --- Fixed values -----------------------------------------------------------
# Soil dimension: hydraulic conductivity proxy by soil type.
SOIL_PERMEABILITY = {
    "Sandy": 0.9,
    "Clayey": 0.2,
    "Loamy": 0.6,
    "Rocky": 0.1,
    "Alluvial": 0.75,
}

# Risk classes by depth below surface in metres; intervals are (low, high].
RISK_BINS = [(0.0, 12.0, "Low"), (12.0, 20.0, "Medium"), (20.0, 36.0, "High")]
RISK_LABELS = ["Low", "Medium", "High"]
RISK_COLOURS = {"Low": "#2ecc71", "Medium": "#f39c12", "High": "#e74c3c"}
OTHER_COLOUR = "blue"

# Calendar seasons.
NORTHEAST_MONSOON = [10, 11, 12]  # season 2
SOUTHWEST_MONSOON = [6, 7, 8, 9]  # season 1

# Lag and trailing-window lengths in rows.
LAG_STEPS = [1, 3, 6, 12]
ROLLING_WINDOWS = [3, 6, 12]
ZSCORE_WINDOW = 6

# Supervised sequences: rows of history and forecast steps.
HISTORY_ROWS = 12
FORECAST_STEPS = 3
SEQUENCE_COVARIATES = [
    "groundwater_level",
    "rainfall_mm",
    "temperature_c",
    "evapotranspiration",
    "ndvi",
    "urban_fraction",
]

# Climate scenarios: relative rain change, added degrees, added urban share.
SCENARIOS = [
    ("RCP_2.6_Optimistic", 0.05, 1.0, 0.02),
    ("RCP_4.5_Moderate", -0.10, 2.0, 0.04),
    ("RCP_8.5_Pessimistic", -0.20, 3.5, 0.08),
]

# Inputs of the hybrid physics + forest model.
HYBRID_FEATURES = [
    "darcy_recharge",
    "water_balance",
    "rainfall_mm",
    "temperature_c",
    "urban_fraction",
    "soil_permeability",
    "population_density",
    "ndvi",
]

# Inputs of the isolation forest and its settings.
ANOMALY_FEATURES = ["groundwater_level", "rainfall_mm", "temperature_c"]
CONTAMINATION = 0.05
FOREST_TREES = 100
FOREST_SAMPLE = 256

# What-if defaults for unknown history.
WHATIF_LEVEL_LAG = 10.0
WHATIF_RAIN_LAG_SHARE = 0.9
WHATIF_LEVEL_STD = 0.5
WHATIF_SPI = 0.0

# Search grids of the trained models.
RIDGE_ALPHAS = [0.1, 1.0, 10.0, 100.0]
FOREST_GRID = {
    "numTrees": [100, 200, 300],
    "maxDepth": [30, 10, 20],
    "minInstancesPerNode": [1, 2, 5],
    "featureSubsetStrategy": ["sqrt", "log2"],
}
BOOSTED_COLUMN_GRID = {
    "maxIter": [100, 200, 300],
    "maxDepth": [4, 6, 8],
    "stepSize": [0.01, 0.05, 0.1, 0.2],
    "subsamplingRate": [0.7, 0.8, 1.0],
    "featureSubsetStrategy": ["0.7", "0.8", "1.0"],
}
BOOSTED_GRID = {
    "maxIter": [100, 200],
    "maxDepth": [3, 5, 7],
    "stepSize": [0.05, 0.1, 0.2],
    "subsamplingRate": [0.8, 1.0],
}
LOGIT_C = [0.01, 0.1, 1.0, 10.0, 100.0]
FOREST_CLASSIFIER_GRID = {
    "numTrees": [100, 200, 300],
    "maxDepth": [30, 10, 20],
    "minInstancesPerNode": [1, 2],
}
BOOSTED_CLASSIFIER_GRID = {
    "maxIter": [100, 200],
    "maxDepth": [3, 5, 7],
    "stepSize": [0.05, 0.1, 0.2],
}
REGRESSION_DRAWS = 20
CLASSIFICATION_DRAWS = 15
SEED = 42

# Forecast order grid and horizon.
ARIMA_P = [0, 1, 2]
ARIMA_D = [0, 1]
ARIMA_Q = [0, 1, 2]
FUTURE_MONTHS = 24
# ---------------------------------------------------------------------------

KEYS = ["zone", "date"]
TARGET = "groundwater_level"
RISK = "risk_code"
