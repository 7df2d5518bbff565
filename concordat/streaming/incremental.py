"""Incremental variants of batch operators, with the batch operator as their oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parquet_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A stream of one Parquet table; its schema comes from the files."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{folder}/{name}.parquet*")


def windowed_counts(events: DataFrame, ts: str, by: str, width: str = "1 day", delay: str = "2 days") -> DataFrame:
    """Counts in tumbling windows with a watermark for late rows."""
    e = events.withColumn("__ts", F.col(ts).cast("timestamp")).withWatermark("__ts", delay)
    w = e.groupBy(F.window("__ts", width).alias("w"), by).agg(F.count(F.lit(1)).alias("n"))
    return w.select(F.col("w.start").cast("timestamp_ntz").alias("start"), by, "n")


def to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Run a stream over all that is there into a Parquet folder, and read that."""
    q = stream.writeStream.outputMode(mode).format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def each_batch(stream: DataFrame, checkpoint: str, apply: Callable[[DataFrame, int], None]) -> None:
    """Run a batch operator on every arriving batch, once each."""
    q = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
