"""The five reporting views, as functions of fact, dimension and properties."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from simmart.functions.text import count_text
from simmart.operators.skew import splittable_join

# The ten molecules of the pivot report.
PIVOT_IDS = [
    "CHEMBL2",
    "CHEMBL112998",
    "CHEMBL267915",
    "CHEMBL6200",
    "CHEMBL414181",
    "CHEMBL6363",
    "CHEMBL6212",
    "CHEMBL6366",
    "CHEMBL269132",
    "CHEMBL6334",
]


def average_score(fact: DataFrame) -> DataFrame:
    """Mean score of each source."""
    return fact.groupBy("source_chembl_id").agg(F.avg("tanimoto_similarity").alias("avg"))


def average_deviation(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Mean |alogp(target) - alogp(source)| of each source.

    The dimension plays both roles. No broadcast is forced: Spark broadcasts
    it where its size allows, and otherwise splits hot keys of the joins.
    """

    def role(name: str) -> DataFrame:
        return dim.select(F.col("chembl_id").alias(f"{name}_chembl_id"), F.col("alogp").alias(f"{name}_alogp"))

    pairs = fact.select("source_chembl_id", "target_chembl_id")
    half = splittable_join(pairs, role("target"), ["target_chembl_id"])
    both = splittable_join(half, role("source"), ["source_chembl_id"])
    deviation = F.abs(F.col("target_alogp") - F.col("source_alogp"))
    return both.groupBy("source_chembl_id").agg(F.avg(deviation).alias("average_alogp_deviation"))


def pivot_scores(fact: DataFrame, ids: list = PIVOT_IDS) -> DataFrame:
    """Score of each target with each of the listed sources, one column per
    source, in target order. The list is also a filter, which reaches the scan."""
    source, score = F.col("source_chembl_id"), F.col("tanimoto_similarity")
    return (
        fact.where(source.isin(ids))
        .groupBy("target_chembl_id")
        .agg(*[F.max(F.when(source == i, score)).alias(str(i)) for i in ids])
        .orderBy("target_chembl_id")
    )


def next_most_similar(fact: DataFrame) -> DataFrame:
    """Each pair with the next lower score of its target, and, from the second
    pair of its source on, the target of that source's second pair. Equal
    scores are ordered by id; null scores come first. Self pairs are left out.

    A window over the pairs themselves would put all pairs of one popular
    source or target into one task. Both columns need less:

    * the next score only depends on the target's distinct scores, and on which
      of several equal pairs is last; scores are fractions of two counts of
      bits, of which 2,048 bits allow some hundred thousand, and no more;
    * the second pair of a source is among its two best, so all others are cut
      before the shuffle.

    Joined back, a hot key is an ordinary join key that Spark can split.
    """
    pairs = fact.where("source_chembl_id <> target_chembl_id").select(
        "source_chembl_id", "target_chembl_id", "tanimoto_similarity"
    )

    falling = Window.partitionBy("target_chembl_id").orderBy(F.desc_nulls_first("tanimoto_similarity"))
    steps = (
        pairs.groupBy("target_chembl_id", "tanimoto_similarity")
        .agg(F.max("source_chembl_id").alias("last_source"))
        .withColumn("next_score", F.lead("tanimoto_similarity").over(falling))
    )

    best = Window.partitionBy("source_chembl_id").orderBy(
        F.desc_nulls_first("tanimoto_similarity"), F.asc("target_chembl_id")
    )
    ranked = pairs.withColumn("place", F.row_number().over(best)).where("place <= 2")

    def at(place: int):
        return F.max(F.when(F.col("place") == place, F.col("target_chembl_id")))

    leaders = ranked.groupBy("source_chembl_id").agg(at(1).alias("first_target"), at(2).alias("second_target"))

    stepped = splittable_join(pairs, steps, ["target_chembl_id", "tanimoto_similarity"], null_safe=True)
    joined = splittable_join(stepped, leaders, ["source_chembl_id"])
    is_last = F.col("source_chembl_id") == F.col("last_source")
    is_first = F.col("target_chembl_id") == F.col("first_target")
    return joined.select(
        "source_chembl_id",
        "target_chembl_id",
        "tanimoto_similarity",
        F.when(is_last, F.col("next_score"))
        .otherwise(F.col("tanimoto_similarity"))
        .alias("next_most_similar_target"),
        F.when(~is_first, F.col("second_target")).alias("second_most_similar_target"),
    )


def grouped_averages(fact: DataFrame, properties: DataFrame) -> DataFrame:
    """Mean score by source, by (rings, atoms), by atoms, and over all. A key
    that is summed over prints TOTAL; a key that is null stays null.

    Every grouping is coarser than the source, so the fact is first reduced to
    one row per source; the join and the four groupings run on those.
    """
    per_source = fact.groupBy("source_chembl_id").agg(
        F.sum("tanimoto_similarity").alias("total"), F.count("tanimoto_similarity").alias("n")
    )
    rows = per_source.join(
        properties.select(F.col("chembl_id").alias("source_chembl_id"), "aromatic_rings", "heavy_atoms"),
        "source_chembl_id",
    ).withColumn("real", F.lit(1))
    # An empty fact has a grand total too: one more row, that counts for nothing.
    none = fact.sparkSession.range(1).select(F.lit(0).alias("real"))
    rows = rows.unionByName(none, allowMissingColumns=True)
    source, rings, atoms = F.col("source_chembl_id"), F.col("aromatic_rings"), F.col("heavy_atoms")
    grouped = rows.groupingSets([[source], [rings, atoms], [atoms], []], source, rings, atoms).agg(
        F.try_divide(F.sum("total"), F.sum("n")).alias("avg"),
        F.sum("real").alias("real"),
        F.grouping("source_chembl_id").alias("source"),
        F.grouping("aromatic_rings").alias("aromatic"),
        F.grouping("heavy_atoms").alias("heavy"),
    )
    grouped = grouped.where("real > 0 or source + aromatic + heavy = 3")
    return grouped.select(
        F.when(F.col("source") == 0, source.cast("string")).otherwise("TOTAL").alias("source_molecule"),
        F.when(F.col("aromatic") == 0, count_text(rings)).otherwise("TOTAL").alias("aromatic_rings"),
        F.when(F.col("heavy") == 0, count_text(atoms)).otherwise("TOTAL").alias("heavy_atoms"),
        "avg",
    )


def create_views(fact: DataFrame, dim: DataFrame, properties: DataFrame) -> None:
    """Create or replace the temporary views of the five reports."""
    views = {
        "average_score_per_mol": average_score(fact),
        "average_deviation_of_alogp": average_deviation(fact, dim),
        "pivot_similarity_score": pivot_scores(fact),
        "next_most_similar_molecule": next_most_similar(fact),
        "next_most_similar_molexule": next_most_similar(fact),  # the name in use so far
        "grouped_averages": grouped_averages(fact, properties),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
