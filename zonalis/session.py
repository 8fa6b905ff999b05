"""Session settings and the shared folder for data that outlives one plan."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution on; cluster settings win where they are given."""
    builder = (
        SparkSession.builder.appName("zonalis")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a private one only where none is set."""
    context = spark.sparkContext
    configured = context.getConf().get(CHECKPOINT_DIR) or spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="zonalis-"))
    return context.getCheckpointDir().rstrip("/")


_STAGED: dict[str, list[str]] = {}


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder, which ``drop_staged`` deletes with the staged tables."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _STAGED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def stage(df: DataFrame, name: str = "staged") -> DataFrame:
    """Write once to the shared folder and read back.

    Used where several passes follow: later passes prune columns and push filters into
    the Parquet scan, and a lost executor costs a re-read instead of the whole lineage.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession) -> int:
    """Delete what this application wrote, once no result needs it; the number of places deleted."""
    dropped = 0
    for path in _STAGED.pop(spark.sparkContext.applicationId, []):
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        dropped += target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    return dropped
