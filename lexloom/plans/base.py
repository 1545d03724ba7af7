"""Session defaults, tables, and the one way to cut a plan: a checkpoint in the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_fallback: dict[str, str] = {}


def session(app: str = "lexloom", cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A local session; on a cluster the submitted configuration stands."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; on a local master a temporary one where that is unset, as in tests."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _fallback:
        _fallback[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="lexloom-")
    return _fallback[context.applicationId]


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder for files that tasks write and read."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """``df``, checkpointed in the shared folder."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """``df``, written to the shared folder as Parquet and read back, for loops that join their own results.

    A checkpoint hands on the constraints of its plan; where a loop joins it with computed columns Catalyst infers more of
    them each round, until the plan alone fills the driver.  What is read from files has none.
    """
    path = scratch(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
