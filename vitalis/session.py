"""Spark session helpers.

Library code never creates a session on its own; callers (tests, bench, the
driver) hand one in.  ``local_session`` is only for tests and the bench.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "vitalis") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("VITALIS_DRIVER_MEMORY", "4g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts: ``spark.checkpoint.dir`` of the session.

    Unset, a local master (tests, bench) gets a folder in its warehouse; on a cluster that is an error, since no folder of
    one machine would do.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints"
        spark.conf.set("spark.checkpoint.dir", configured)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def size_for_data(spark: SparkSession, shuffled_bytes: int, target_mb: int = 128) -> int:
    """Opt-in sizing for a cluster run: enough shuffle partitions that each holds
    about ``target_mb`` (spill-free on a typical executor core), the same size as
    AQE's advisory partition and as the parquet split, and AQE skew-join handling
    on (splits a hot key's partition, e.g. a patient with a third of the rows).
    Returns the partition count chosen.  Library functions never change session
    settings on their own."""
    target = target_mb * 1024 * 1024
    parts = max(1, -(-int(shuffled_bytes) // target))
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target))
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(target))
    return parts
