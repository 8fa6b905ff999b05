"""Regressors and classifiers on engineered panels, as ``pyspark.ml`` pipelines."""

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.feature import (
    FeatureHasher,
    OneHotEncoder,
    SQLTransformer,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonalis.functions import fixed
from zonalis.functions import measures as m
from zonalis.operators.features import add_physics
from zonalis.operators.timeseries import minmax, sequences
from zonalis.session import stage

LEVEL, RISK = fixed.TARGET, fixed.RISK
HASH_SLOTS = 1 << 18

NUMERIC_FEATURES = (
    ["latitude", "longitude", "is_coastal", "soil_permeability", "rainfall_mm", "temperature_c"]
    + ["evapotranspiration", "ndvi", "population_density", "urban_fraction", "soil_type_enc"]
    + ["year", "month_sin", "month_cos", "season", "is_monsoon"]
    + [f"{v}_lag_{k}" for k in fixed.LAG_STEPS for v in ("gw", "rain")]
    + [f"{v}_roll_mean_{k}" for k in fixed.ROLLING_WINDOWS for v in ("rain", "temp")]
    + [f"gw_roll_std_{k}" for k in fixed.ROLLING_WINDOWS]
    + ["spi", "urbanization_index"]
)


# --- scaling ----------------------------------------------------------------
def scaling_stats(train: DataFrame, columns: list[str]) -> Column:
    """Mean and population std of every column, one struct each, as a scalar subquery."""
    stats = [
        F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c) for c in columns
    ]
    return train.agg(F.struct(*stats)).scalar()


def standard_scale(df: DataFrame, train: DataFrame, columns: list[str]) -> DataFrame:
    """Train statistics applied to every row; a constant column becomes 0."""
    stats = scaling_stats(train, columns)
    scaled = [
        F.coalesce(F.try_divide(F.col(c) - stats[c]["mean"], stats[c]["std"]), F.lit(0.0)).alias(f"{c}_z")
        for c in columns
    ]
    return df.select("*", *scaled)


def _scaler(train: DataFrame, columns: list[str]) -> SQLTransformer:
    """The same scaling as a pipeline stage, so it is saved and loaded with the model."""
    row = train.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]
    ).first()
    terms = []
    for c in columns:
        mean, std = row[f"m_{c}"], row[f"s_{c}"]
        scaled = f"(`{c}` - {mean!r}D) / {std!r}D" if std else "0.0D"
        terms.append(f"{scaled} AS `{c}_z`")
    return SQLTransformer(statement=f"SELECT *, {', '.join(terms)} FROM __THIS__")


def prepare(
    train: DataFrame, columns: list[str] = NUMERIC_FEATURES, zone: str | None = "one_hot", slots: int = HASH_SLOTS
) -> PipelineModel:
    """Scaling, zone encoding and assembly fitted on the training rows.

    ``zone`` is the encoding, whatever the number of zones: ``one_hot`` has a slot per name and one
    for unknown names, and holds the names in the model; ``hash`` has ``slots`` slots, which names
    may share, and holds none; None leaves zones out.
    """
    if zone not in ("one_hot", "hash", None):
        raise ValueError(f"unknown zone encoding {zone!r}")
    stages = [_scaler(train, columns)]
    inputs = [f"{c}_z" for c in columns]
    if zone:
        if zone == "one_hot":
            stages.append(
                StringIndexer(
                    inputCol="zone",
                    outputCol="zone_index",
                    stringOrderType="alphabetAsc",
                    handleInvalid="keep",
                )
            )
            stages.append(OneHotEncoder(inputCol="zone_index", outputCol="zone_vector", dropLast=False))
        else:
            stages.append(FeatureHasher(inputCols=["zone"], outputCol="zone_vector", numFeatures=slots))
        inputs.append("zone_vector")
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
    return Pipeline(stages=stages).fit(train)


def prepared(df: DataFrame, prep: PipelineModel, keep: list[str] = ()) -> DataFrame:
    """Keys, target, class and feature vector only: what the fits read over and over."""
    return prep.transform(df).select(
        "zone",
        "date",
        F.col(LEVEL).alias("y"),
        F.col(RISK).cast("double").alias("risk"),
        *keep,
        "features",
    )


def with_model(prep: PipelineModel, model) -> PipelineModel:
    return PipelineModel(stages=[*prep.stages, model])


# --- regressors ---------------------------------------------------------------
def ridge(train: DataFrame, alpha: float = 1.0, label: str = "y", features: str = "features"):
    """Least squares with an L2 penalty of ``alpha`` on the weights, none on the intercept.

    The solver minimises the mean squared error of the label divided by its std, hence the
    conversion of the penalty.
    """
    row = train.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(label).alias("s")).first()
    return LinearRegression(
        labelCol=label,
        featuresCol=features,
        elasticNetParam=0.0,
        standardization=False,
        solver="normal",
        regParam=alpha / row["n"] * row["s"],
    )


def forest_regressor(**params):
    return RandomForestRegressor(labelCol="y", seed=fixed.SEED, **params)


def boosted_regressor(**params):
    return GBTRegressor(labelCol="y", seed=fixed.SEED, **params)


def predict(model, df: DataFrame, name: str) -> DataFrame:
    scored = model.transform(df)
    return scored.select("zone", "date", F.lit(name).alias("model"), "y", F.col("prediction").alias("p"))


# --- classifiers ----------------------------------------------------------------
def logit(train: DataFrame, c: float = 1.0):
    n = train.count()
    return LogisticRegression(
        labelCol="risk", family="multinomial", regParam=1.0 / (c * n), standardization=False, maxIter=200
    )


def forest_classifier(**params):
    return RandomForestClassifier(labelCol="risk", seed=fixed.SEED, **params)


def boosted_classifier(**params):
    base = GBTClassifier(labelCol="risk", seed=fixed.SEED, **params)
    return OneVsRest(classifier=base, labelCol="risk", rawPredictionCol="rawPrediction")


def probabilities(scored: DataFrame) -> Column:
    """Class probabilities: the model's own, or normalised sigmoids of one-vs-rest margins.

    One entry per risk label: a class above all trained ones gets 0.
    """
    labels = len(fixed.RISK_LABELS)
    padded = lambda a: F.slice(F.concat(a, F.array_repeat(F.lit(0.0), labels)), 1, labels)
    if "probability" in scored.columns:
        return padded(vector_to_array("probability"))
    odds = F.transform(vector_to_array("rawPrediction"), lambda x: 1 / (1 + F.exp(-2 * x)))
    total = F.aggregate(odds, F.lit(0.0), lambda a, x: a + x)
    return padded(F.transform(odds, lambda x: x / total))


def predict_class(model, df: DataFrame, name: str) -> DataFrame:
    scored = model.transform(df)
    return scored.select(
        "zone",
        "date",
        F.lit(name).alias("model"),
        F.col("risk").cast("int").alias("y"),
        F.col("prediction").cast("int").alias("p"),
        probabilities(scored).alias("probability"),
    )


def risk_scores(classified: DataFrame) -> DataFrame:
    """Predicted label and its probability map, rounded to three digits."""
    chances = F.transform("probability", lambda x: m.rounded(x, 3))
    names = F.array(*[F.lit(x) for x in fixed.RISK_LABELS])
    return classified.select(
        "zone",
        "date",
        m.risk_label(F.col("p")).alias("risk_label"),
        F.map_from_arrays(names, chances).alias("probabilities"),
    )


# --- physics line + forest --------------------------------------------------------
def physics_line(train: DataFrame) -> Column:
    """Straight line of level on recharge as a scalar subquery."""
    return (
        add_physics(train)
        .agg(
            F.struct(
                F.regr_slope(LEVEL, "darcy_recharge").alias("slope"),
                F.regr_intercept(LEVEL, "darcy_recharge").alias("intercept"),
            )
        )
        .scalar()
    )


def fit_hybrid(train: DataFrame, trees: int = 200, depth: int = 30) -> PipelineModel:
    """Physics line plus a forest on its residuals, saved and loaded as one pipeline."""
    line = add_physics(train).agg(
        F.regr_slope(LEVEL, "darcy_recharge").alias("slope"),
        F.regr_intercept(LEVEL, "darcy_recharge").alias("intercept"),
    ).first()
    flow = "greatest((1 - urban_fraction) * soil_permeability * rainfall_mm * 0.01D, 0.0D)"
    physics = SQLTransformer(
        statement=(
            f"SELECT *, {flow} AS darcy_recharge, "
            f"{flow} - (evapotranspiration * 0.05D + urban_fraction * 0.3D) AS water_balance, "
            f"{line['intercept']!r}D + {line['slope']!r}D * {flow} AS physics FROM __THIS__"
        )
    )
    filled = SQLTransformer(
        statement="SELECT *, "
        + ", ".join(f"coalesce({c}, 0.0D) AS {c}_in" for c in fixed.HYBRID_FEATURES)
        + f", {LEVEL} - physics AS residual FROM __THIS__"
    )
    assembler = VectorAssembler(
        inputCols=[f"{c}_in" for c in fixed.HYBRID_FEATURES], outputCol="hybrid_features"
    )
    forest = RandomForestRegressor(
        labelCol="residual",
        featuresCol="hybrid_features",
        predictionCol="correction",
        numTrees=trees,
        maxDepth=depth,
        seed=fixed.SEED,
    )
    total = SQLTransformer(statement="SELECT *, physics + correction AS p FROM __THIS__")
    return Pipeline(stages=[physics, filled, assembler, forest, total]).fit(train)


# --- direct multi-step forecaster -------------------------------------------------
def sequence_vectors(panel: DataFrame) -> DataFrame:
    """Scaled 12-month histories as vectors with the next targets and their split role.

    Scaling uses each zone's whole range, as the targets are scaled with it too.
    """
    columns = fixed.SEQUENCE_COVARIATES
    zone = Window.partitionBy("zone")
    scaled = minmax(panel, columns).select(
        "zone",
        "date",
        f"{LEVEL}_min",
        f"{LEVEL}_max",
        *[F.col(f"{c}_scaled").alias(c) for c in columns],
        F.row_number().over(zone.orderBy("date")).alias("row"),
        F.count(F.lit(1)).over(zone).alias("rows"),
    )
    kept = sequences(
        scaled, columns, keep=[f"{LEVEL}_min", f"{LEVEL}_max", "row", "rows"]
    )
    split = F.floor(F.col("rows") * 0.8)
    role = F.when(F.col("row") + fixed.FORECAST_STEPS <= split, "train").when(F.col("row") >= split, "test")
    flat = F.flatten(F.transform("history", lambda h: F.array(*[h[c] for c in columns])))
    return kept.select(
        "zone", "date", f"{LEVEL}_min", f"{LEVEL}_max", "target", role.alias("role"), flat.alias("flat")
    ).filter(F.col("role").isNotNull())


@dataclass(frozen=True)
class SequenceModel:
    """One linear form per forecast step over entries of the flattened window, and a shift by zone."""

    entries: list[int]
    weights: list[list[float]]
    intercepts: list[float]
    zones: dict[str, list[float]]


def _zone_encoder(train: DataFrame) -> PipelineModel:
    index = StringIndexer(inputCol="zone", outputCol="zone_index", stringOrderType="alphabetAsc", handleInvalid="keep")
    slots = OneHotEncoder(inputCol="zone_index", outputCol="zone_vector", dropLast=False)
    both = VectorAssembler(inputCols=["window", "zone_vector"], outputCol="features")
    return Pipeline(stages=[index, slots, both]).fit(train)


def fit_sequences(panel: DataFrame, alpha: float = 1.0, entries: list[int] | None = None, zones: bool = True) -> SequenceModel:
    """Ridge per step on the scaled windows of the training rows, pooled over zones.

    ``entries`` are the places in the flattened window (rows, oldest first, by covariates) that are
    inputs, by default all. With ``zones`` each zone is an input too; the model then holds their names.
    """
    size = fixed.HISTORY_ROWS * len(fixed.SEQUENCE_COVARIATES)
    entries = list(range(size)) if entries is None else list(entries)
    rows = sequence_vectors(panel).filter("role = 'train'")
    picked = array_to_vector(F.array(*[F.col("flat")[i] for i in entries]))
    targets = [F.col("target")[k].alias(f"t{k + 1}") for k in range(fixed.FORECAST_STEPS)]
    table = stage(rows.select("zone", *targets, picked.alias("window")), "windows")
    names = []
    if zones:
        encoder = _zone_encoder(table)
        names, table = encoder.stages[0].labels, encoder.transform(table)
    column, table = ("features", table.select("features", *[f"t{k + 1}" for k in range(fixed.FORECAST_STEPS)])) if zones else ("window", table)
    fits = [ridge(table, alpha, label=f"t{k + 1}", features=column).fit(table) for k in range(fixed.FORECAST_STEPS)]
    weights = [[float(w) for w in f.coefficients] for f in fits]
    shifts = {name: [w[len(entries) + i] for w in weights] for i, name in enumerate(names)}
    return SequenceModel(entries, [w[: len(entries)] for w in weights], [float(f.intercept) for f in fits], shifts)


def _steps(model: SequenceModel, flat: Column, shift: Column) -> list[Column]:
    """The scaled levels of the next steps from a flattened window."""
    picked = F.array(*[flat[i] for i in model.entries]) if len(model.entries) < fixed.HISTORY_ROWS * len(fixed.SEQUENCE_COVARIATES) else flat
    found = []
    for k, (weights, intercept) in enumerate(zip(model.weights, model.intercepts, strict=True)):
        products = F.zip_with(picked, F.array(*[F.lit(w) for w in weights]), lambda x, w: x * w)
        found.append(F.lit(intercept) + shift[k] + F.aggregate(products, F.lit(0.0), lambda a, x: a + x))
    return found


def _shifted(df: DataFrame, model: SequenceModel) -> DataFrame:
    """``shift`` by zone; zones that the model does not know have none."""
    none = F.array_repeat(F.lit(0.0), fixed.FORECAST_STEPS)
    if not model.zones:
        return df.withColumn("shift", none)
    shifts = df.sparkSession.createDataFrame(list(model.zones.items()), "zone string, shift array<double>")  # as large as the model
    return df.join(shifts, "zone", "left").withColumn("shift", F.coalesce("shift", none))


def sequence_backtest(model: SequenceModel, panel: DataFrame, step: int = 1) -> DataFrame:
    """Actual and predicted level of one step for every test window."""
    rows = _shifted(sequence_vectors(panel).filter("role = 'test'"), model)
    back = lambda c: c * (F.col(f"{LEVEL}_max") - F.col(f"{LEVEL}_min")) + F.col(f"{LEVEL}_min")
    made = _steps(model, F.col("flat"), F.col("shift"))[step - 1]
    return rows.select("zone", "date", back(F.col("target")[step - 1]).alias("y"), back(made).alias("p"))


def sequence_recursion(model: SequenceModel, panel: DataFrame, months: int = fixed.FUTURE_MONTHS) -> DataFrame:
    """Levels after the last row of each zone from the model's own predictions.

    Each round predicts all steps from the window, then the window moves on by them: a predicted row has
    the covariates of the row before it. Zones with less than a window of rows have no forecast.
    """
    columns, length = fixed.SEQUENCE_COVARIATES, fixed.HISTORY_ROWS
    scaled = minmax(panel, columns).select(
        "zone", "date", f"{LEVEL}_min", f"{LEVEL}_max", F.array(*[F.col(f"{c}_scaled") for c in columns]).alias("entry"))
    newest = F.row_number().over(Window.partitionBy("zone").orderBy(F.desc("date")))
    recent = scaled.withColumn("back", newest).filter(F.col("back") <= length)
    last = recent.groupBy("zone").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("date", "entry"))), lambda r: r["entry"]).alias("window"),
        F.max("date").alias("last_date"), F.first(f"{LEVEL}_min").alias("low"), F.first(f"{LEVEL}_max").alias("high"))
    last = _shifted(last.filter(F.size("window") == length), model)
    start = F.struct(F.col("window").alias("window"), F.array().cast("array<double>").alias("out"))

    def advance(acc, _):
        levels = F.array(*_steps(model, F.flatten(acc["window"]), F.col("shift")))
        held = F.slice(F.element_at(acc["window"], -1), 2, len(columns) - 1)
        grown = F.concat(acc["window"], F.transform(levels, lambda y: F.concat(F.array(y), held)))
        return F.struct(F.slice(grown, fixed.FORECAST_STEPS + 1, length).alias("window"), F.concat(acc["out"], levels).alias("out"))

    rounds = -(-months // fixed.FORECAST_STEPS)
    path = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, advance, lambda acc: F.slice(acc["out"], 1, months))
    made = last.select("zone", "last_date", "low", "high", F.posexplode(path).alias("pos", "scaled"))
    return made.select("zone", (F.col("pos") + 1).alias("step"), F.add_months("last_date", F.col("pos") + 1).alias("date"),
                       (F.col("scaled") * (F.col("high") - F.col("low")) + F.col("low")).alias("predicted_gw"))


def direct_multistep(panel: DataFrame, alpha: float = 1.0) -> DataFrame:
    """One pooled ridge per forecast step; actual and predicted levels of the test rows."""
    rows = sequence_vectors(panel)
    targets = [F.col("target")[k].alias(f"t{k + 1}") for k in range(fixed.FORECAST_STEPS)]
    vector = array_to_vector("flat").alias("features")
    table = stage(
        rows.select("zone", "date", f"{LEVEL}_min", f"{LEVEL}_max", "role", *targets, vector), "sequences"
    )
    train, scored = table.filter("role = 'train'"), table.filter("role = 'test'")
    for k in range(1, fixed.FORECAST_STEPS + 1):
        model = ridge(train, alpha, label=f"t{k}").setPredictionCol(f"p{k}").fit(train)
        scored = model.transform(scored)
    back = lambda c: F.col(c) * (F.col(f"{LEVEL}_max") - F.col(f"{LEVEL}_min")) + F.col(f"{LEVEL}_min")
    steps = F.explode(
        F.array(
            *[
                F.struct(F.lit(k).alias("step"), back(f"t{k}").alias("y"), back(f"p{k}").alias("p"))
                for k in range(1, fixed.FORECAST_STEPS + 1)
            ]
        )
    )
    return scored.select("zone", "date", steps.alias("s")).select("zone", "date", "s.*")
