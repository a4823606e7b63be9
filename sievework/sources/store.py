"""Scans and versioned writes of the stored tables, the code dictionary, routed output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework import schemas
from sievework.operators.joins import has_url


def scan_notices(spark: SparkSession, path: str, labelled_only: bool = False) -> DataFrame:
    """The notice table; the label filter reaches the scan."""
    return labelled(spark.read.parquet(path)) if labelled_only else spark.read.parquet(path)


def scan_notices_jdbc(
    spark: SparkSession, url: str, table: str, key: str = "resource_id", low: int = 0, high: int = 10_000_000,
    parts: int = 64, labelled_only: bool = False, **options: str,
) -> DataFrame:
    """The same scan from a database, read in key ranges side by side."""
    reader = spark.read.format("jdbc").options(
        url=url, dbtable=table, partitionColumn=key, lowerBound=str(low), upperBound=str(high),
        numPartitions=str(parts), **options,
    )
    return labelled(reader.load()) if labelled_only else reader.load()


def labelled(notices: DataFrame) -> DataFrame:
    return notices.where(F.col("bid").isNotNull())


def parse_dictionary(lines: DataFrame, line: str = "value", position: Column | None = None) -> DataFrame:
    """Code lines to ``code`` and ``code_pos``: the text before the first comma, blanks dropped."""
    position = position if position is not None else F.monotonically_increasing_id()
    return lines.select(F.trim(F.substring_index(line, ",", 1)).alias("code"), position.alias("code_pos")).where("code <> ''")


def load_code_dictionary(spark: SparkSession, path: str) -> DataFrame:
    return parse_dictionary(spark.read.text(path))


def route_by_url(notices: DataFrame) -> DataFrame:
    """``route`` of each record: to the document stage with a URL, else straight on."""
    return notices.withColumn("route", F.when(has_url(), "documents").otherwise("direct"))


def write_routes(routed: DataFrame, path: str, mode: str = "append") -> None:
    """One folder per route from one pass over the records."""
    routed.write.mode(mode).partitionBy("route").parquet(path)


def write_version(df: DataFrame, root: str, version: int) -> str:
    """Write a merged table next to the one it was read from; returns the new path.

    A plain folder cannot be overwritten while it is read. The caller points readers to the new
    path once the write is through, so a lost job leaves the old version in force.
    """
    path = f"{root}/version={version}"
    df.write.mode("overwrite").parquet(path)
    return path


def migrate_notices(notices: DataFrame) -> DataFrame:
    """An older notice table with all columns of today."""
    return schemas.align_schema(notices, schemas.NOTICES, schemas.NOTICE_DEFAULTS)


def migrate_doc_content(docs: DataFrame) -> DataFrame:
    return schemas.align_schema(docs, schemas.DOC_CONTENT, schemas.DOC_CONTENT_DEFAULTS)
