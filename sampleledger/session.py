"""Session settings for local runs; a cluster supplies its own."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def local_session(
    cores: str | int = "*", shuffle_partitions: int = 8, checkpoint_dir: str = "/tmp/checkpoints"
) -> SparkSession:
    """A local session. Adaptive execution stays on: it sizes shuffle partitions, turns a join
    whose side proves small into a broadcast join and splits skewed join partitions."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("sampleledger")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", checkpoint_dir)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SAMPLELEDGER_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def kept(df: DataFrame) -> DataFrame:
    """``df`` as a reliable checkpoint, computed now: with adaptive execution parts of a plan run
    while it is checkpointed, so this is an explicit step.

    The folder is the one named in ``spark.checkpoint.dir``. Only a local session that names none
    gets one of its own; on a cluster that is an error.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if named is None and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(named or "/tmp/checkpoints")
    return df.checkpoint()
