"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def splittable_join(
    many: DataFrame, one: DataFrame, keys: list[str], how: str = "inner", null_safe: bool = False
) -> DataFrame:
    """Join with a frame of one row per key.

    AQE divides a hot key only when each side of the join comes straight from
    its own exchange. A side that was aggregated or ranked by the key is
    already distributed by it and gets none; the hash as a further key makes
    Spark exchange it again, which costs one row per key. Below the broadcast
    threshold nothing is exchanged.

    Equal values of unlike types have unlike hashes, so that keys are cast to
    their common type first; types without one raise an error. With null_safe
    a null key equals a null key, else it equals none.
    """
    common = many.select(*keys).limit(0).unionByName(one.select(*keys).limit(0)).schema
    many, one = (df.withColumns({k: F.col(k).cast(common[k].dataType) for k in keys}) for df in (many, one))
    tag = F.xxhash64(*keys)
    many, one = many.withColumn("_tag", tag), one.withColumn("_tag", tag)
    if not null_safe:
        return many.join(one, [*keys, "_tag"], how).drop("_tag")
    one = one.withColumnsRenamed({k: f"_one_{k}" for k in [*keys, "_tag"]})
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_one_{k}")) for k in keys))
    joined = many.join(one, (F.col("_tag") == F.col("_one__tag")) & same, how)
    return joined.drop("_tag", "_one__tag", *(f"_one_{k}" for k in keys))
