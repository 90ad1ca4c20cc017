"""Checks that take the place of database keys and of log warnings."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from simmart.operators.dedup import repeated_keys

KEY_ROWS = 1 << 20  # rows of which a task counts the keys
PIECES = 16  # tasks at most that share the rows of one key


def primary_key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, or hold a null, with row counts.

    Nearly all keys are distinct, and a task holds all of those that it counts.
    Rows are therefore dealt into parts of some KEY_ROWS before any are held:
    first by key and piece of the input, so that several tasks share the rows of
    a hot key, then the counts of the pieces by key alone.
    """
    null_key = F.lit(False)
    for key in keys:
        null_key = null_key | F.col(key).isNull()
    parts = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(df.count() / KEY_ROWS))
    dealt = df.select(*keys, (F.spark_partition_id() % PIECES).alias("_piece")).repartition(parts, *keys, "_piece")
    pieces = dealt.groupBy(*keys, "_piece").agg(F.count("*").alias("n_rows"))
    counts = pieces.repartition(parts, *keys).groupBy(*keys).agg(F.sum("n_rows").alias("n_rows"))
    return counts.where((F.col("n_rows") > 1) | null_key)


def foreign_key_violations(fact: DataFrame, column: str, dim: DataFrame, key: str) -> DataFrame:
    """(key_column, key_value, n_rows) of fact keys missing from the dimension.
    Equal keys are counted first, so a hot key joins as one row."""
    used = fact.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("key_value"))
    return (
        used.agg(F.count("*").alias("n_rows"))
        .join(dim.select(F.col(key).alias("_key")), F.col("key_value") == F.col("_key"), "left_anti")
        .select(F.lit(column).alias("key_column"), "key_value", "n_rows")
    )


def reconcile(df: DataFrame, key: str, processed: DataFrame) -> DataFrame:
    """One row: distinct ids expected, rows processed, and whether they agree."""
    expected = df.agg(F.countDistinct(key).alias("n")).select(F.lit("expected").alias("what"), "n")
    actual = processed.agg(F.count("*").alias("n")).select(F.lit("actual").alias("what"), "n")

    def pick(what: str):
        return F.max(F.when(F.col("what") == what, F.col("n")))

    both = expected.unionByName(actual).agg(pick("expected").alias("expected"), pick("actual").alias("actual"))
    return both.withColumn("matches", F.col("expected") == F.col("actual"))


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The frame, and a row counter filled by the next action on it."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows")), seen


def write_counts(spark: SparkSession, counts: dict[str, int], path: str) -> DataFrame:
    """(step, n_rows), stored; the same run writes it again."""
    spark.createDataFrame(list(counts.items()), "step string, n_rows bigint").coalesce(1).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def count_distinct(df: DataFrame, key: str, approximate: bool = False) -> DataFrame:
    """One row: number of distinct ids."""
    count = F.approx_count_distinct(key) if approximate else F.countDistinct(key)
    return df.agg(count.alias("n_distinct"))


__all__ = [
    "count_distinct",
    "counted",
    "foreign_key_violations",
    "primary_key_violations",
    "reconcile",
    "repeated_keys",
    "write_counts",
]
