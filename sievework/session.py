"""Session defaults and the few helpers that need to know about the cluster."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "sievework", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, skew handling and UTC dates; ``conf`` wins over the defaults."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Long texts make wide rows: small Arrow batches bound the Python worker's memory.
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
        "spark.sql.variant.allowDuplicateKeys": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def allow_repeated_fields(spark: SparkSession) -> None:
    """In JSON objects the last of several fields of one name counts, as most parsers have it."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only where a local session leaves it unset is it a folder beside the warehouse; on a cluster the
    setting is required, since a machine's own folder would be lost with the machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:")
    folder = os.path.join(os.path.dirname(warehouse.rstrip("/")), "spark-checkpoints")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder, so that several readers do not recompute it."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def spread_scan(df: DataFrame) -> DataFrame:
    """Spread a scan of fewer tasks than cores over all cores.

    One file of one row group is one task, however much work follows. A scan that keeps the cores busy
    comes back as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
