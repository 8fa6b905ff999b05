"""Feature importances and explanations."""

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonalis.functions import fixed
from zonalis.operators import trees
from zonalis.operators.models import probabilities, ridge


def feature_names(df: DataFrame, column: str = "features") -> list[str]:
    """Names of the vector slots from the assembler's metadata."""
    groups = df.schema[column].metadata["ml_attr"]["attrs"]
    slots = [slot for group in groups.values() for slot in group]
    return [s.get("name", str(s["idx"])) for s in sorted(slots, key=lambda s: s["idx"])]


def top_features(df: DataFrame, model, k: int = 20) -> DataFrame:
    """The k largest importances of a tree model (one number per feature)."""
    rows = list(zip(feature_names(df), (float(x) for x in model.featureImportances.toArray())))
    table = df.sparkSession.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(k)


def fitted_weights(train: DataFrame, columns: list[str], label: str = fixed.TARGET, alpha: float = 1.0) -> dict[str, float]:
    """Ridge weights of the label on the columns, from the rows that have them all."""
    rows = VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="skip").transform(train)
    rows = rows.select(F.col(label).alias("y"), "features").where("y IS NOT NULL")
    return dict(zip(columns, (float(w) for w in ridge(rows, alpha).fit(rows).coefficients), strict=True))


def linear_contributions(test: DataFrame, train: DataFrame, weights: dict[str, float], k: int = 20) -> DataFrame:
    """Mean absolute coef * (x - train mean) per feature, largest first."""
    means = train.agg(F.struct(*[F.avg(c).alias(c) for c in weights])).scalar()
    parts = [F.avg(F.abs((F.col(c) - means[c]) * w)).alias(c) for c, w in weights.items()]
    items = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("mean_abs")) for c in weights]
    wide = test.agg(*parts)
    return wide.select(F.explode(F.array(*items)).alias("i")).select("i.*").orderBy(
        F.desc("mean_abs"), "feature"
    ).limit(k)


def class_contributions(model, train: DataFrame, test: DataFrame, outcome: int = 2, k: int = 20) -> DataFrame:
    """The k features with the largest mean absolute contribution to one class on the test rows.

    Trees: Shapley values of the class's probability or margin. A linear model: weight times the
    distance from the training mean, in the class's margin.
    """
    names = feature_names(train)
    if not isinstance(model, LogisticRegressionModel):
        ensemble = trees.from_model(model, train.sparkSession)
        return trees.mean_contributions(trees.explain(ensemble, test, outcome), names, k)
    slots = lambda df: df.select(F.posexplode(vector_to_array("features")).alias("slot", "x"))
    weights = [(i, n, float(w)) for i, (n, w) in enumerate(zip(names, model.coefficientMatrix.toArray()[outcome], strict=True))]
    forms = train.sparkSession.createDataFrame(weights, "slot int, feature string, weight double")  # a row per feature
    means = slots(train).groupBy("slot").agg(F.avg("x").alias("mean"))
    parts = slots(test).join(means, "slot").join(forms, "slot")
    added = F.abs(F.col("weight") * (F.col("x") - F.col("mean")))
    return parts.groupBy("feature").agg(F.avg(added).alias("mean_abs")).orderBy(F.desc("mean_abs"), "feature").limit(k)


def permutation_importance(
    model, df: DataFrame, outcome: int = 2, k: int = 20, seed: int = fixed.SEED, buckets: int = 64
) -> DataFrame:
    """Mean absolute change of one class's probability when a feature is shuffled.

    Rows are dealt into ``buckets`` by hash, however many rows there are; inside a bucket each row
    borrows the values of its neighbour in hash order (of itself where it is alone). Choose so
    many that a bucket fits in a task. Every (row, feature) variant is scored in one
    job and averaged by feature, so nothing is collected or self-joined.
    """
    names = feature_names(df)
    key = F.xxhash64(F.lit(seed), "zone", "date")
    known = model.transform(df.select("zone", "date", "features"))
    rows = known.select(
        "zone",
        "date",
        vector_to_array("features").alias("x"),
        probabilities(known)[outcome].alias("base"),
        key.alias("h"),
    ).withColumn("bucket", F.pmod("h", F.lit(buckets)))
    order = Window.partitionBy("bucket").orderBy("h", "zone", "date")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    borrowed = rows.select(
        "x", "base", F.coalesce(F.lag("x").over(order), F.last("x").over(whole)).alias("donor")
    )
    variants = borrowed.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(len(names) - 1))))
    changed = F.transform("x", lambda v, i: F.when(i == F.col("j"), F.col("donor")[i]).otherwise(v))
    scored = model.transform(variants.select("j", "base", array_to_vector(changed).alias("features")))
    shift = F.abs(probabilities(scored)[outcome] - F.col("base"))
    labels = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("j") + 1)
    return (
        scored.select("j", shift.alias("shift"))
        .groupBy("j")
        .agg(F.avg("shift").alias("importance"))
        .select(labels.alias("feature"), "importance")
        .orderBy(F.desc("importance"), "feature")
        .limit(k)
    )
