"""Append logs as streams: a folder in which files arrive is read once each, keys counted once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def read_drops(spark: SparkSession, path: str, schema: str, files_a_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_trigger).json(path)


def first_of_key(events: DataFrame, key: str, time: str, late: str = "1 hour") -> DataFrame:
    """Each key once, however often it arrives within ``late``; state older than that is dropped."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def counts_by_window(events: DataFrame, time: str, kind: str, width: str, late: str = "1 hour") -> DataFrame:
    told = events.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), kind)
    return told.agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), kind, "n")


def land(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """All that is there now, appended to Parquet exactly once; ends by itself."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def land_first(stream: DataFrame, path: str, checkpoint: str, key: str, order: str) -> StreamingQuery:
    """All that is there now, each key once for good, however late it comes again; ends by itself.

    What is known of keys is what has landed, not state in memory: each batch keeps its first row of a key by ``order``
    and leaves out the keys of all other batches.  A batch has its own folder, written anew if it runs again, so a crash
    loses and repeats nothing.  Null keys are one key.  ``read_first`` reads what has landed.
    """
    spark = stream.sparkSession

    def keep(batch: DataFrame, number: int) -> None:
        columns = batch.columns
        first = batch.groupBy(F.col(key).alias("_k")).agg(F.min_by(F.struct(*columns), order).alias("_r")).select("_k", "_r.*")
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(at):
            own = f"batch={number}"
            others = [s.getPath().toString() for s in fs.listStatus(at) if s.getPath().getName().startswith("batch=") and s.getPath().getName() != own]
            if others:
                held = spark.read.schema(batch.schema).parquet(*others).select(F.col(key).alias("_h"))
                first = first.join(held, F.col("_k").eqNullSafe(F.col("_h")), "left_anti")
        first.select(*columns).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_first(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows that ``land_first`` kept."""
    return spark.read.schema(schema).parquet(f"{path}/batch=*")
