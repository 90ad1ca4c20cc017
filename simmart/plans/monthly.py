"""Second job: score a month's targets and load the mart."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from simmart import schemas
from simmart.functions.fingerprint import N_BITS, RADIUS, fingerprint, pack
from simmart.operators.dedup import drop_repeats
from simmart.operators.quality import counted, write_counts
from simmart.operators.similarity import pair_scores, read_bands, top_similar_stored, write_bands
from simmart.operators.targets import accepted_targets, monthly_targets, observed_lines, refused_lines, refused_targets
from simmart.plans import mart
from simmart.sources import files


GROUP_BYTES = 1 << 20  # of a row group of scores


@dataclass(frozen=True)
class Month:
    """Where one monthly run reads and writes. Fact and dimension are tables
    into which each month puts its rows; scores are the month's own."""

    day: dt.date
    targets: str
    fingerprints: str
    properties: str
    dictionary: str
    scores: str
    refused: str
    fact: str
    dim: str

    def work(self, name: str) -> str:
        """Where stages that are read more than once are kept."""
        return f"{self.scores}-work/{name}"


WORDS = "chembl_id string, words array<bigint>"


def source_audit(spark: SparkSession, folder: str, radius: int = RADIUS, n_bits: int = N_BITS) -> DataFrame:
    """The files of the fingerprint store, with the fault of those that cannot
    be used: unreadable, without the columns, or made with other settings."""
    return files.file_audit(spark, folder, WORDS, {"radius": radius, "n_bits": n_bits})


def source_words(spark: SparkSession, folder: str, audit: DataFrame | None = None) -> DataFrame:
    """(chembl_id, words) of the fingerprint store: the first row of each id,
    in file and row order. The bit texts beside the words are not read. Any
    file that cannot be used fails the read; with a stored audit only the
    others are read."""
    found = source_audit(spark, folder) if audit is None else audit
    if audit is None:
        faulty = found.where("fault is not null").select("file", "fault").limit(3).collect()
        if faulty:
            raise ValueError("; ".join(f"{r.file}: {r.fault}" for r in faulty))
    prints = files.fingerprint_files(spark, folder, WORDS, "words", placed=True, only=files.usable_files(found))
    first = drop_repeats(prints.where("chembl_id is not null"), ["chembl_id"], ["file", "row"])
    return first.select("chembl_id", "words")


def target_words(targets: DataFrame, radius: int = RADIUS, n_bits: int = N_BITS, **rule) -> DataFrame:
    """(chembl_id, words) of target molecules; words are null where refused."""
    bits = fingerprint(F.col("smiles"), radius, n_bits, **rule)
    return targets.select("chembl_id", pack(bits, n_bits).alias("words"))


def write_scores(scores: DataFrame, path: str, group_bytes: int = GROUP_BYTES) -> None:
    """Write full scores from the tasks that made them. The pairs are not
    shuffled; in each file rows lie by targets in order of id, in row groups
    small enough that each holds few of them."""
    scores.write.mode("overwrite").option("parquet.block.size", group_bytes).parquet(path)


def scores_of(spark: SparkSession, path: str, targets: list[str]) -> DataFrame:
    """The full scores of some targets. Only row groups are read whose least
    and greatest target, in the files' footers, have one between them."""
    return spark.read.parquet(path).where(F.col("target_chembl_id").isin(targets))


def has_files(spark: SparkSession, folder: str, day: dt.date) -> bool:
    """Whether the month has any file."""
    return not (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", files.month_glob(day))
        .load(folder)
        .select("path")
        .isEmpty()
    )


class _Steps:
    """Writes stages that are read more than once, and counts their rows."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.counts = spark, {}

    def write(self, df: DataFrame, path: str, step: str) -> DataFrame:
        rows, seen = counted(df, f"{path} {step}")
        rows.write.mode("overwrite").parquet(path)
        self.counts[step] = seen.get["n_rows"]
        return self.spark.read.schema(df.schema).parquet(path)


def run(spark: SparkSession, month: Month) -> DataFrame:
    """One month: targets, full scores, top ten, fact, dimension. Returns the
    broken keys of the new mart. A month without files loads nothing new. Files
    of fingerprints that cannot be used are listed among what was refused. What
    each step found and made is counted in the table ``month.work("counts")``."""
    steps = _Steps(spark)
    # The files are numbered and decoded once; what follows reads the lines.
    lines, seen = observed_lines(files.target_file_lines(spark, month.targets, month.day), f"{month.scores} lines")
    lines.write.mode("overwrite").parquet(month.work("lines"))
    lines = spark.read.schema(lines.schema).parquet(month.work("lines"))
    steps.counts |= seen.get
    steps.write(refused_lines(lines), f"{month.refused}/lines", "refused lines written")
    targets = steps.write(monthly_targets(lines), month.work("targets"), "targets")
    steps.write(refused_targets(targets), f"{month.refused}/targets", "targets refused")
    words = steps.write(target_words(accepted_targets(targets)), month.work("words"), "targets scored")
    audit = steps.write(source_audit(spark, month.fingerprints), month.work("source_files"), "source files")
    faulty = audit.where("fault is not null")
    steps.write(faulty, f"{month.refused}/source_files", "source files refused")
    write_bands(source_words(spark, month.fingerprints, audit), month.work("bands"))
    sources = read_bands(spark, month.work("bands"))

    scores, n_scores = counted(pair_scores(words, sources), f"{month.scores} scores")
    write_scores(scores, month.scores)
    steps.counts |= {"sources": sources.count(), "scores": n_scores.get["n_rows"]}
    # Scored again rather than ranked from the full scores: the tasks cut to
    # eleven per target, with bounds, and the pairs are never sorted.
    top = top_similar_stored(words, sources)

    steps.counts["fact rows put"] = mart.put(spark, month.fact, mart.fact_rows(top), mart.FACT_KEYS, schemas.FACT)
    fact = mart.read(spark, month.fact, schemas.FACT)
    rows = mart.dim_rows(spark.read.parquet(month.properties), spark.read.parquet(month.dictionary), fact)
    steps.counts["dimension rows put"] = mart.put(spark, month.dim, rows, mart.DIM_KEYS, schemas.DIM)
    write_counts(spark, steps.counts, month.work("counts"))
    return mart.fact_faults(fact, mart.read(spark, month.dim, schemas.DIM))
