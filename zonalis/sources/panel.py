"""Reading and writing panels, forecasts, metrics and models."""

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonalis.functions import measures as m

PANEL_SCHEMA = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("zone", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("is_coastal", T.IntegerType()),
        T.StructField("soil_type", T.StringType()),
        T.StructField("soil_permeability", T.DoubleType()),
        T.StructField("rainfall_mm", T.DoubleType()),
        T.StructField("temperature_c", T.DoubleType()),
        T.StructField("evapotranspiration", T.DoubleType()),
        T.StructField("ndvi", T.DoubleType()),
        T.StructField("population_density", T.DoubleType()),
        T.StructField("urban_fraction", T.DoubleType()),
        T.StructField("groundwater_level", T.DoubleType()),
        T.StructField("risk_level", T.StringType()),
        T.StructField("risk_code", T.IntegerType()),
    ]
)
PANEL_COLUMNS = PANEL_SCHEMA.fieldNames()


def _matches(spark: SparkSession, path: str) -> bool:
    """Whether the path, which may be a glob, names anything."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop)
    return found is not None and len(found) > 0


def read_panel(
    spark: SparkSession, path: str, file_format: str = "parquet", empty_if_missing: bool = False
) -> DataFrame:
    """Panel with a declared schema from a folder, file or glob.

    A path that names nothing is an error unless ``empty_if_missing``. The columns of a CSV file
    must be named and ordered as declared, and a value that is not of its type is an error.
    """
    if not _matches(spark, path):
        if not empty_if_missing:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], PANEL_SCHEMA)
    reader = spark.read.schema(PANEL_SCHEMA)
    if file_format == "csv":
        return reader.option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)
    # a year folder is a partition column beside the declared ones
    return reader.format(file_format).load(path).select(*PANEL_COLUMNS)


def sorted_panel(df: DataFrame) -> DataFrame:
    return df.orderBy("zone", "date")


def write_panel(df: DataFrame, path: str, file_format: str = "parquet", by_year: bool = False) -> None:
    """One table; ``by_year`` lays it out so that date filters prune whole folders."""
    if by_year:
        # the sizes of the shuffled years decide how many tasks write each
        df = df.withColumn("year", F.year("date")).hint("rebalance", "year")
        df.write.mode("overwrite").partitionBy("year").format(file_format).option("header", True).save(path)
    else:
        df.write.mode("overwrite").format(file_format).option("header", True).save(path)


def write_forecasts(df: DataFrame, path: str) -> None:
    """One CSV folder per zone, named by the zone's slug."""
    keyed = df.withColumn("zone_slug", m.slug(F.col("zone"))).repartition("zone_slug")
    keyed.write.mode("overwrite").partitionBy("zone_slug").option("header", True).csv(path)


def read_forecasts(spark: SparkSession, path: str) -> DataFrame:
    schema = "date DATE, zone STRING, predicted_gw DOUBLE, zone_slug STRING"
    return spark.read.schema(schema).option("header", True).csv(path)


def write_metrics(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_metrics(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def export_zone(df: DataFrame, zone: str, path: str) -> None:
    df.filter(F.col("zone") == zone).write.mode("overwrite").option("header", True).csv(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
