"""Duplicate ids: keep the first, or list every member."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from simmart.operators.skew import splittable_join


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in the given order. The rank filter lets each
    task cut a key to one row before the shuffle, so a hot key stays small."""
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(first)).where("_place = 1").drop("_place")


def drop_repeats(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Like ``keep_first``, for wide rows of which few repeat a key.

    Only keys and order columns are shuffled, to find the first row of the
    keys that repeat. The rows themselves then meet that short list, which
    Spark broadcasts where its measured size allows. Keys must not be null.
    """
    firsts = (
        df.groupBy(*keys)
        .agg(F.count("*").alias("_n"), F.min(F.struct(*order)).alias("_first"))
        .where("_n > 1")
        .drop("_n")
    )
    joined = splittable_join(df, firsts, keys, "left")
    return joined.where(F.col("_first").isNull() | (F.struct(*order) == F.col("_first"))).select(*df.columns)


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def duplicate_members(df: DataFrame, keys: list[str]) -> DataFrame:
    """Every row whose key occurs more than once.

    Counting first and joining back keeps a hot key out of a single window:
    the counts combine before the shuffle and the join can split the key.
    Rows with a null key count as one group, hence the null-safe comparison.
    """
    repeated = repeated_keys(df, keys).select(*[F.col(k).alias(f"_{k}") for k in keys])
    # The hash is a key of its own for the reason given in ``splittable_join``.
    same = F.xxhash64(*keys) == F.xxhash64(*[f"_{k}" for k in keys])
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_{key}"))
    return df.join(repeated, same, "left_semi")
