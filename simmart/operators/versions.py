"""Keys compared between tables over many versions, by stored sketches.

Counting and comparing the distinct keys of every version reads every version.
A HyperLogLog sketch of 2^12 registers, 4 KB for each version and table, is
stored instead; sketches of parts merge. Registers only rise as keys are added, so
that two sets with unlike registers surely differ, and which of them lacks keys
is sure too. Only the versions of which the sketches say so are read again.

Equal registers prove nothing: few keys more may raise none. With n keys in a
sketch of K registers a further key raises one with a probability of about
1 / (1 + n / (0.72 K)); ``unnoticed`` is how many keys one side may lack and
still go unnoticed with a probability of at most 0.05. Estimates of a number of
keys have a standard error of 1.04 / sqrt(K), 1.6 %.

Null keys are no keys; rows of a null version are a version of their own; a
version that one side has not has no keys there. Repeated keys count once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

LOG_REGISTERS = 12
MISSED = 0.05
BIAS = 0.7213  # of a harmonic mean of registers, for many of them


def key_sketches(df: DataFrame, key: str, by: list[str], log_registers: int = LOG_REGISTERS) -> DataFrame:
    """(*by, n_rows, n_keys, sketch): rows, rows whose key is not null, and the
    sketch of the keys. Keys are hashed first: the sketch passes over empty text."""
    known = F.col(key).isNotNull()
    return df.groupBy(*by).agg(
        F.count("*").alias("n_rows"),
        F.count(key).alias("n_keys"),
        F.hll_sketch_agg(F.when(known, F.xxhash64(key)), log_registers).alias("sketch"),
    )


def n_distinct(one: str | Column, other: str | Column) -> Column:
    """The estimate for a union of two sketches, by its registers alone: the
    estimate of a sketch hangs on how it was filled, until it is merged twice."""
    both = F.hll_union(one, other)
    return F.hll_sketch_estimate(F.hll_union(both, both))


def compared(expected: DataFrame, actual: DataFrame, by: list[str]) -> DataFrame:
    """(*by, n_expected, n_actual, lacks, exceeds) of two frames of sketches:
    the estimates, and whether the actual keys surely lack some of the expected
    ones, or surely have others. Several sketches of one version are merged."""
    none = F.lit(None).cast("binary")
    sides = expected.select(*by, F.col("sketch").alias("e"), none.alias("a")).unionByName(
        actual.select(*by, none.alias("e"), F.col("sketch").alias("a"))
    )
    merged = sides.groupBy(*by).agg(F.hll_union_agg("e").alias("e"), F.hll_union_agg("a").alias("a"))
    both, e, a = n_distinct("e", "a"), n_distinct("e", "e"), n_distinct("a", "a")
    return merged.select(*by, e.alias("n_expected"), a.alias("n_actual"), (both > a).alias("lacks"), (both > e).alias("exceeds"))


def changes(sketches: DataFrame, version: str, by: list[str]) -> DataFrame:
    """(*by, version, n_keys_about, n_new_about, n_gone_about, surely_new,
    surely_gone) of each version against the one before. The numbers are
    estimates; an absolute error of twice 1.6 % of the keys is usual for those
    of new and gone ones. The first version is compared with nothing."""
    before = F.lag("sketch").over(Window.partitionBy(*by).orderBy(version))
    first = F.col("before").isNull()
    both, a, b = n_distinct("before", "sketch"), n_distinct("before", "before"), n_distinct("sketch", "sketch")
    return sketches.withColumn("before", before).select(
        *by,
        version,
        b.alias("n_keys_about"),
        F.when(first, b).otherwise(both - a).alias("n_new_about"),
        F.when(first, 0).otherwise(both - b).alias("n_gone_about"),
        F.when(first, b > 0).otherwise(both > a).alias("surely_new"),
        F.when(first, F.lit(False)).otherwise(both > b).alias("surely_gone"),
    )


def unnoticed(n: int, log_registers: int = LOG_REGISTERS) -> int:
    """Keys by which a set of n may exceed another and not be told from it,
    with a probability of at most MISSED."""
    passed = n / (BIAS * 2**log_registers)  # (1 - p) / p of a key that raises a register with p
    return math.ceil(math.log(MISSED) / math.log(passed / (1 + passed))) if n else 0


def key_differences(expected: DataFrame, actual: DataFrame, key: str, by: list[str]) -> DataFrame:
    """(*by, n_missing, n_extra): distinct keys that only one side has, counted
    exactly. Keys combine before the only shuffle that grows with the rows."""
    sides = expected.select(*by, key, F.lit(1).alias("side")).unionByName(actual.select(*by, key, F.lit(2).alias("side")))
    keys = sides.where(F.col(key).isNotNull()).groupBy(*by, key).agg(F.bit_or("side").alias("side"))
    return keys.groupBy(*by).agg(
        F.count_if(F.col("side") == 1).alias("n_missing"), F.count_if(F.col("side") == 2).alias("n_extra")
    )


def reconciled(
    expected: DataFrame,
    actual: DataFrame,
    key: str,
    version: str,
    expected_sketches: DataFrame | None = None,
    actual_sketches: DataFrame | None = None,
) -> DataFrame:
    """(version, checked, n_missing, n_extra, unnoticed) of every version of
    two tables. Stored sketches are compared first; where they differ, and only
    there, keys are read and compared: `checked` is "keys", the numbers are
    exact. Elsewhere it is "sketch", no difference was found, and up to
    `unnoticed` keys may differ. A row for each version comes to the driver.
    """
    spark = expected.sparkSession
    es = key_sketches(expected, key, [version]) if expected_sketches is None else expected_sketches
    own = key_sketches(actual, key, [version]) if actual_sketches is None else actual_sketches
    found = compared(es, own, [version])
    kind = found.schema[version].dataType.simpleString()
    rows = found.collect()
    unlike = [r[version] for r in rows if r.lacks or r.exceeds]
    here = F.col(version).isin([v for v in unlike if v is not None])
    if None in unlike:
        here = F.coalesce(here, F.lit(True))
    exact = key_differences(expected.where(here), actual.where(here), key, [version])
    alike = [(r[version], "sketch", 0, 0, unnoticed(max(r.n_expected, r.n_actual))) for r in rows if not (r.lacks or r.exceeds)]
    names = "checked string, n_missing bigint, n_extra bigint, unnoticed bigint"
    told = spark.createDataFrame(alike, f"`{version}` {kind}, {names}")
    if not unlike:
        return told
    return told.unionByName(exact.select(version, F.lit("keys").alias("checked"), "n_missing", "n_extra", F.lit(0).cast("bigint").alias("unnoticed")))
