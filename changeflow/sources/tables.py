"""Stored tables: the change log laid out by branch, and versions of state tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import branch_of


def scan_change_log(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """The stored log. Filters and column choice reach the Parquet scan.

    The branch folder names are read as text, or '0012' would become the number 12.
    """
    stored = spark.read.parquet(path).schema
    fields = [T.StructField("branch", T.StringType()) if f.name == "branch" else f for f in stored.fields]
    log = spark.read.schema(T.StructType(fields)).parquet(path)
    return log if columns is None else log.select(*columns)


def scan_change_log_jdbc(
    spark: SparkSession, url: str, table: str, column: str, bounds: tuple, partitions: int, **options: str
) -> DataFrame:
    """The log out of a database, read in ranges of a numeric or time column by many tasks."""
    lower, upper = bounds
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=column, numPartitions=partitions)
        .options(lowerBound=lower, upperBound=upper, **options)
        .load()
    )


def store_change_log(log: DataFrame, path: str, rows_per_file: int = 5_000_000) -> None:
    """Write the log by branch, keys sorted inside files, so branch filters prune folders and key bounds row groups.

    The rebalance hint splits a hot branch over several tasks and joins small ones.
    """
    rows = log.withColumn("branch", branch_of("sTransNox")).hint("rebalance", F.col("branch"))
    (
        rows.sortWithinPartitions("branch", "sTransNox")
        .write.partitionBy("branch")
        .option("maxRecordsPerFile", rows_per_file)
        .parquet(path)
    )


def save_version(df: DataFrame, root: str, version: int) -> str:
    """Write a new version of a state table next to the old ones, so what is being read is never overwritten.

    The version counts from the moment its number is added to the pointer table, which is done last.
    """
    path = f"{root}/version={version}"
    df.write.mode("overwrite").parquet(path)
    df.sparkSession.range(version, version + 1).write.mode("append").parquet(f"{root}/pointer")
    return path


def current_version(spark: SparkSession, root: str) -> DataFrame:
    """The newest complete version of a state table."""
    newest = spark.read.schema("id bigint").parquet(f"{root}/pointer").agg(F.max("id")).first()[0]
    return spark.read.parquet(f"{root}/version={newest}")
