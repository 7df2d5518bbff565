"""Spark sessions with the settings that the engine expects."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def session(name: str = "concordat", master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, ANSI mode and UTC; a cluster's own settings stay."""
    b = SparkSession.builder.appName(name)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    return b.config(map=settings | conf).getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names. One of our own stands in on one machine only: the
    executors of a cluster couldn't read it."""
    sc = spark.sparkContext
    folder = sc._jsc.sc().getCheckpointDir()
    if folder.isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="concordat"))
        folder = sc._jsc.sc().getCheckpointDir()
    return folder.get()


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: cuts the lineage and survives lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffle_parts(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
