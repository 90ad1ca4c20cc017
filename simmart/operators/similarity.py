"""All-pairs Tanimoto scoring and the best k per target.

Targets are one month's molecules, sources the whole fingerprint store. Targets
are written once to the shared folder, in order of their ids, and the tasks that
scan the sources walk them block by block. So neither side is shuffled, broadcast
or collected, a task's memory does not grow with either, and there is one plan
for every size. The shared folder must be of a kind that pyarrow reads (file,
hdfs, s3, gs).

A store in bands of set-bit counts needs not be read whole for the best k. A
first round reads the targets' own bands and gives each target a floor, its
(k + 1)-th best score so far; a second round reads the bands of which some
target's floor allows a member.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from simmart.functions.fingerprint import N_BITS, WORD, n_set
from simmart.operators.normalize import only
from simmart.operators.scoring import OTHER_BANDS, OWN_BAND, StoredTargets, all_scores, best_scores
from simmart.session import remove, shared_dir

Scorer = Callable[[Iterator[pa.RecordBatch], StoredTargets], Iterator[pa.RecordBatch]]
BAND = 32  # set-bit counts of a band
SORTED_PAIRS = 1 << 21  # scores that a task sorts, some 200 MB


def pair_scores(targets: DataFrame, sources: DataFrame, n_bits: int = N_BITS) -> DataFrame:
    """(target_chembl_id, source_chembl_id, similarity_score) of every target
    with every source but those of its own id. Both inputs hold (chembl_id,
    words); rows without words are left out, words of another width than
    n_bits raise an error. Null words are dropped on the task side: a filter
    here would be pushed down and evaluate the fingerprint twice."""
    return _score(_stored(targets, n_bits), targets, sources, all_scores)


def top_similar(targets: DataFrame, sources: DataFrame, k: int = 10, n_bits: int = N_BITS) -> DataFrame:
    """The k most similar sources of each target, with the tie flag.

    Tasks send on k + 1 rows per target for every 65,536 sources, so what is
    shuffled is a small part of the pairs.
    """
    return rank_top(_score(_stored(targets, n_bits), targets, sources, partial(best_scores, keep=k + 1)), k)


def top_of_all(targets: DataFrame, sources: DataFrame, k: int = 10, n_bits: int = N_BITS) -> DataFrame:
    """Like ``top_similar``, but ranked from the full scores. A task sorts the
    scores of its sources with all targets, so sources are dealt out, as packed
    words, into parts of so many that these are at most SORTED_PAIRS."""
    stored, spark = _stored(targets, n_bits), targets.sparkSession
    pairs = sources.count() * spark.read.parquet(stored.path).count()
    parts = max(spark.sparkContext.defaultParallelism, math.ceil(pairs / SORTED_PAIRS))
    dealt = sources.select("chembl_id", "words").repartition(parts)
    return rank_top(_score(stored, targets, dealt, all_scores), k)


def write_bands(sources: DataFrame, path: str, band: int = BAND) -> None:
    """Sources (chembl_id, words) as a store in bands of set-bit counts. They
    are dealt by count and id, so that a count that many share is divided and
    each task writes few bands; a folder is a band. Rows without words are
    left out. Spark reads rows twice to deal them by ranges, so that they are
    stored first: fingerprints are computed once."""
    spark, stage = sources.sparkSession, f"{shared_dir(sources.sparkSession)}/sources-{uuid.uuid4().hex}"
    sources.select("chembl_id", "words").write.parquet(stage)
    sized = spark.read.parquet(stage).withColumn("size", n_set(F.col("words")))
    dealt = sized.repartitionByRange("size", "chembl_id")
    parts = only(dealt, F.col("words").isNotNull()).withColumn("band", F.floor(F.col("size") / band).cast("int")).sortWithinPartitions("size")
    parts.write.mode("overwrite").partitionBy("band").parquet(path)
    remove(spark, stage)


def read_bands(spark: SparkSession, path: str, id_type: str = "string") -> DataFrame:
    return spark.read.schema(f"chembl_id {id_type}, words array<bigint>, size int, band int").parquet(path)


def wanted_bands(targets: DataFrame, band: int = BAND, n_bits: int = N_BITS) -> list[int]:
    """The bands that the second round must read: those of which a member may
    reach the floor of some target (chembl_id, words, floor). One row for each
    set-bit count comes to the driver."""
    floors = targets.groupBy(n_set(F.col("words")).alias("size")).agg(F.min("floor").alias("floor")).where("size >= 0").collect()
    found = set()
    for b in range(n_bits // band + 1):
        low, high = b * band, min(n_bits, (b + 1) * band - 1)
        for size, floor in floors:
            near = min(max(size, low), high)  # the count of the band that is nearest to the target's
            bound = 1.0 if near == size else min(near, size) / max(near, size)
            if b != size // band and bound >= floor:
                found.add(b)
                break
    return sorted(found)


def top_similar_stored(targets: DataFrame, store: DataFrame, k: int = 10, n_bits: int = N_BITS, band: int = BAND) -> DataFrame:
    """Like ``top_similar``, of sources in a store of bands, of which only the
    bands are read that can matter."""
    spark = targets.sparkSession
    first = _stored(targets, n_bits)
    targets = spark.read.parquet(first.path)
    own = [r.band for r in targets.select(F.floor(n_set(F.col("words")) / band).cast("int").alias("band")).distinct().where("band >= 0").collect()]
    near = _score(first, targets, store.where(F.col("band").isin(own)), partial(best_scores, keep=k + 1, which=OWN_BAND, band=band))
    path = f"{shared_dir(spark)}/floors-{uuid.uuid4().hex}"
    _cut(near, k + 1).write.parquet(path)
    near = spark.read.parquet(path)
    floors = near.groupBy(F.col("target_chembl_id").alias("chembl_id")).agg(
        F.when(F.count("*") > k, F.min("similarity_score")).otherwise(0.0).alias("floor")
    )
    floored = targets.join(floors, "chembl_id", "left").select("chembl_id", "words", F.coalesce("floor", F.lit(0.0)).alias("floor"))
    second = _stored(floored, n_bits)
    floored = spark.read.parquet(second.path)
    far = store.where(F.col("band").isin(wanted_bands(floored, band, n_bits)))
    far = _score(second, targets, far, partial(best_scores, keep=k + 1, which=OTHER_BANDS, band=band))
    return rank_top(near.unionByName(far), k)


def _order():
    return Window.partitionBy("target_chembl_id").orderBy(F.desc("similarity_score"), F.asc("source_chembl_id"))


def _cut(scored: DataFrame, k: int) -> DataFrame:
    return scored.withColumn("place", F.row_number().over(_order())).where(F.col("place") <= k).drop("place")


def rank_top(scored: DataFrame, k: int = 10) -> DataFrame:
    """Rank k per target by score down, then source id up, and flag row k when
    a further row has exactly its score. The rows are sorted, so row k + 1
    decides. ``lead`` comes after the rank filter: this lets Spark cut each
    group to k + 1 rows before and after the shuffle."""
    kept = scored.withColumn("place", F.row_number().over(_order())).where(F.col("place") <= k + 1)
    tied = F.coalesce(F.lead("similarity_score").over(_order()) == F.col("similarity_score"), F.lit(False))
    return (
        kept.withColumn("has_duplicates_of_last_largest_score", (F.col("place") == k) & tied)
        .where(F.col("place") <= k)
        .select(
            "target_chembl_id",
            "source_chembl_id",
            F.col("similarity_score").alias("tanimoto_similarity"),
            "has_duplicates_of_last_largest_score",
        )
    )


def _stored(targets: DataFrame, n_bits: int) -> StoredTargets:
    """Targets written in order of their ids: what is scored then lies in that
    order too, and files of scores tell by their statistics whose they hold."""
    path = f"{shared_dir(targets.sparkSession)}/targets-{uuid.uuid4().hex}"
    columns = [c for c in ("chembl_id", "words", "floor") if c in targets.columns]
    targets.select(*columns).sort("chembl_id").write.parquet(path)
    return StoredTargets(path, -(-n_bits // WORD))


def _score(stored: StoredTargets, targets: DataFrame, sources: DataFrame, scorer: Scorer) -> DataFrame:
    schema = (
        f"target_chembl_id {targets.schema['chembl_id'].dataType.simpleString()},"
        f"source_chembl_id {sources.schema['chembl_id'].dataType.simpleString()},"
        "similarity_score double"
    )
    return sources.select("chembl_id", "words").mapInArrow(lambda batches: scorer(batches, stored), schema)
