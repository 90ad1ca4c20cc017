"""Table readers and writers."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession

INSERT_CHUNK = 100_000
FINGERPRINT_CHUNK = 150_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a folder of tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt out evenly where the source has fewer parts than the
    session has cores, as a table of one row group has; else as they lie."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def even_chunks(df: DataFrame, n_rows: int, chunk: int = FINGERPRINT_CHUNK) -> DataFrame:
    """Even partitions of at most ``chunk`` rows, given the row count."""
    return df.repartition(max(1, math.ceil(n_rows / chunk)))


def jdbc_table(
    spark: SparkSession,
    url: str,
    name: str,
    split_column: str,
    lower: int,
    upper: int,
    splits: int,
    **options: str,
) -> DataFrame:
    """A database table read in parallel by ranges of a numeric column."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=name, partitionColumn=split_column, **options)
        .options(lowerBound=lower, upperBound=upper, numPartitions=splits, fetchsize=10_000)
        .load()
    )


def append_jdbc(df: DataFrame, url: str, name: str, **options: str) -> None:
    """Append to a database table, in batches. Failures are raised."""
    df.write.format("jdbc").options(url=url, dbtable=name, batchsize=INSERT_CHUNK, **options).mode("append").save()
