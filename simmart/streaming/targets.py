"""Incremental form of the monthly job: each new target file exactly once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from simmart import schemas
from simmart.operators.dedup import keep_first
from simmart.operators.quality import counted, write_counts
from simmart.operators.similarity import top_similar
from simmart.operators.targets import accepted_targets, molecules, observed_lines
from simmart.plans import mart
from simmart.plans.monthly import target_words
from simmart.session import shared_dir
from simmart.sources.files import numbered_lines, split_lines

FILES_PER_BATCH = 1000
FIRST = "chembl_id string, smiles string, file string, line bigint"
FIRST_COLUMNS = ["chembl_id", "smiles", "file", "line"]


def new_target_lines(
    spark: SparkSession, folder: str, glob: str = "data_*", files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """Stream of (file, start, value): lines of files not seen before, read in
    splits, so that a file may be larger than a task."""
    found = (
        spark.readStream.format("text")
        .option("pathGlobFilter", glob)
        .option("lineSep", "\n")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
    )
    return split_lines(found)


def load_new_targets(
    spark: SparkSession,
    folder: str,
    name: str,
    load: Callable[[DataFrame, int], None],
    glob: str = "data_*",
    files_per_batch: int = FILES_PER_BATCH,
) -> StreamingQuery:
    """Hand the numbered lines of new files to ``load(lines, batch_id)``, then
    stop. Progress is kept under ``name``, which must be the stream's own, in
    the cluster's shared folder. A batch may be handed over again after a
    failure, so ``load`` has to give the same result when repeated.
    """
    return (
        new_target_lines(spark, folder, glob, files_per_batch)
        .writeStream.foreachBatch(lambda lines, batch_id: load(numbered_lines(lines), batch_id))
        .option("checkpointLocation", f"{shared_dir(spark)}/{name}")
        .trigger(availableNow=True)
        .start()
    )


class FactLoader:
    """A ``load`` that scores each batch's targets against ``sources`` and puts
    their top ten into the fact table at ``root``/fact.

    Of the rows of an id, the first by file name and line counts, in whatever
    order and batches the files arrive. The first row so far of each id is kept
    in a table beside the fact. A batch's row that comes before it takes the id
    over: the id's old rows leave the fact, and the new molecule is scored, or
    refused. The fact is put first and the table of firsts last, so that a
    batch that broke off is done again, and one that is repeated, or comes
    again after the stream's progress was lost, changes nothing.

    What each batch found and did is counted in ``root``/counts.
    """

    def __init__(self, sources: DataFrame, root: str, run: str) -> None:
        self.sources, self.root, self.run = sources, root, run

    def __call__(self, lines: DataFrame, batch_id: int) -> None:
        spark, work = lines.sparkSession, f"{self.root}/work/{self.run}-{batch_id}"
        lines, seen = observed_lines(lines, work)
        found = keep_first(molecules(lines), ["chembl_id"], ["file", "line"]).select(*FIRST_COLUMNS)
        found.write.mode("overwrite").parquet(f"{work}/found")
        found = spark.read.parquet(f"{work}/found")
        held = mart.read_near(spark, f"{self.root}/firsts", FIRST, "chembl_id", found)
        held = held.select("chembl_id", F.struct("file", "line").alias("held"))
        before = F.col("held").isNull() | (F.struct("file", "line") < F.col("held"))
        changed, n_changed = counted(found.join(held, "chembl_id", "left").where(before).select(*FIRST_COLUMNS), f"{work} changed")
        changed.write.mode("overwrite").parquet(f"{work}/changed")
        changed = spark.read.parquet(f"{work}/changed")
        words, n_scored = counted(target_words(accepted_targets(changed)), f"{work} scored")
        words.write.mode("overwrite").parquet(f"{work}/words")
        rows = mart.fact_rows(top_similar(spark.read.parquet(f"{work}/words"), self.sources))
        fact = f"{self.root}/fact"
        n_put = mart.put(spark, fact, rows, mart.FACT_KEYS, schemas.FACT, gone=changed.select("chembl_id"))
        mart.put(spark, f"{self.root}/firsts", changed, ["chembl_id"], FIRST)
        counts = {**seen.get, "targets taken over": n_changed.get["n_rows"], "targets scored": n_scored.get["n_rows"], "fact rows put": n_put}
        write_counts(spark, counts, f"{self.root}/counts/run={self.run}/batch={batch_id}")
