"""Monthly target files and fingerprint files."""

from __future__ import annotations

import datetime as dt
import json
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from simmart.functions.text import decode_bytes, is_blank


def month_glob(day: dt.date) -> str:
    """Glob of a month's target files: data_MM_yyyy*."""
    return day.strftime("data_%m_%Y*")


def target_files(spark: SparkSession, folder: str, day: dt.date) -> DataFrame:
    """(file, text) of the month's files, blank files left out. A month
    without files gives an empty frame. Meant for files that fit a task; for
    larger ones use ``target_file_lines``."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", month_glob(day)).load(folder)
    return file_texts(found)


def file_texts(files: DataFrame) -> DataFrame:
    """(file, text) from the binaryFile columns, UTF-8 first, then Latin-1."""
    return files.select(F.col("path").alias("file"), decode_bytes(F.col("content")).alias("text")).where(
        ~is_blank(F.col("text"))
    )


def text_lines(files: DataFrame, file: str = "file", text: str = "text") -> DataFrame:
    """(file, line, content): one row per line, numbered from 1."""
    lines = F.posexplode(F.split(F.col(text), F.lit("\n"))).alias("pos", "content")
    return files.select(F.col(file).alias("file"), lines).select("file", (F.col("pos") + 1).alias("line"), "content")


def target_file_lines(spark: SparkSession, folder: str, day: dt.date) -> DataFrame:
    """(file, line, content) of the month's files, read in splits.

    One file may be far larger than a task, so it is read as text splits and
    lines are numbered from the line counts of the splits before. A line with
    bytes past ASCII is refused whichever way it is decoded, so decoding line
    by line gives the same molecules as decoding the whole file.
    """
    return numbered_lines(split_lines(spark.read.option("pathGlobFilter", month_glob(day)).option("lineSep", "\n").text(folder)))


def split_lines(lines: DataFrame) -> DataFrame:
    """(file, start, value) of what the text source reads: the file and where
    the split begins in it."""
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value"
    )


def numbered_lines(lines: DataFrame) -> DataFrame:
    """(file, line, content) of the lines of whole splits, as they were read."""
    raw = lines.select(
        "file", "start", F.monotonically_increasing_id().alias("id"), decode_bytes(F.col("value").cast("binary")).alias("content")
    )
    # One row per split. The ids of a split's lines are consecutive.
    splits = raw.groupBy("file", "start").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file", "start", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("passed"))
    return raw.join(splits, ["file", "start"]).select(
        "file", (F.col("passed") + F.col("id") - F.col("first") + 1).cast("bigint").alias("line"), "content"
    )


def fingerprint_files(
    spark: SparkSession,
    folder: str,
    schema: str = "chembl_id string, fingerprint string",
    bits: str = "fingerprint",
    skip_corrupt: bool = False,
    placed: bool = False,
    only: list[str] | None = None,
) -> DataFrame:
    """The named columns of a folder's Parquet files, rows without bits
    dropped; placed adds file and row. Other file types are ignored.

    The schema is declared, so that no file's fate depends on its name: an
    unreadable file fails the read, or on request is skipped wherever it
    stands, and then ``files_without_rows`` lists it. A column that a file
    lacks reads as null. To be told of all files that cannot be used before
    any is read, take the ``only`` that ``usable_files`` of an audit gives.
    """
    reader = spark.read.schema(schema).option("ignoreCorruptFiles", str(skip_corrupt).lower())
    if only is None:
        found = reader.option("pathGlobFilter", "*.parquet").parquet(folder)
    elif only:
        found = reader.parquet(*only)
    else:
        found = spark.createDataFrame([], schema)
    place = []
    if placed and only != []:
        place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]
    elif placed:
        place = [F.lit(None).cast("string").alias("file"), F.lit(None).cast("bigint").alias("row")]
    return found.select(*found.columns, *place).dropna(subset=[bits])


def files_without_rows(spark: SparkSession, folder: str, read: DataFrame) -> DataFrame:
    """(file) of a folder's Parquet files of which a ``placed`` read with
    ``skip_corrupt`` gave no row: the skipped ones, and any that are empty."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folder)
    return listed.select(F.col("path").alias("file")).join(read.select("file").distinct(), "file", "left_anti")


FOOTERS_A_TASK = 256
AUDIT = "file string, n_rows bigint, n_bytes bigint, fault string"
_SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"


def file_audit(spark: SparkSession, folder: str, schema: str, settings: dict | None = None) -> DataFrame:
    """(file, n_rows, n_bytes, fault) of every Parquet file of a folder, by its
    footer; the fault is null where the file can be used.

    A file can be used if its footer can be read and it has the columns of the
    schema with their types. With settings, it must also have been written
    with these as metadata of a column, as ``write_fingerprints`` does. Rows and
    bytes are null where the footer cannot be read. Footers are read by tasks,
    some at a time; names alone come to the driver, those of files without a
    byte among them, which Spark's readers pass over.
    """
    names = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folder).inputFiles()
    listed = spark.createDataFrame([(unquote(n),) for n in names], "file string")
    wanted = [(f.name, f.dataType.simpleString()) for f in spark.createDataFrame([], schema).schema.fields]

    def audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [footer_fault(name, wanted, settings) for name in batch.column(0).to_pylist()]
            rows, sizes, faults = zip(*found) if found else ((), (), ())
            columns = [batch.column(0), pa.array(rows, pa.int64()), pa.array(sizes, pa.int64()), pa.array(faults, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["file", "n_rows", "n_bytes", "fault"])

    return listed.repartition(max(1, -(-len(names) // FOOTERS_A_TASK))).mapInArrow(audit, AUDIT)


def opened(name: str) -> pa.NativeFile:
    """A file by the name that Spark gives it."""
    if name.startswith(("file:", "/")):
        return pafs.LocalFileSystem().open_input_file(re.sub("^file:/*", "/", name))
    system, path = pafs.FileSystem.from_uri(quote(name, safe=":/"))
    return system.open_input_file(path)


def footer_fault(name: str, wanted: list[tuple[str, str]], settings: dict | None) -> tuple[int | None, int | None, str | None]:
    """A file's rows and bytes, and why it cannot be used."""
    try:
        with opened(name) as file:
            size, footer = file.size(), pq.read_metadata(file)
        schema = footer.schema.to_arrow_schema()
    except Exception as problem:  # whatever a damaged file raises, it is the file's fault
        return None, None, f"unreadable: {type(problem).__name__}"
    own = json.loads((footer.metadata or {}).get(_SPARK_SCHEMA, b'{"type": "struct", "fields": []}'))
    known = {f.name: f for f in StructType.fromJson(own).fields}
    for column, kind in wanted:
        if column not in schema.names:
            return footer.num_rows, size, f"no column {column}"
        found = known[column].dataType.simpleString() if column in known else _spark_type(schema.field(column).type)
        if found != kind:
            return footer.num_rows, size, f"column {column} is {found}, not {kind}"
    if settings is not None and not any(f.metadata == settings for f in known.values()):
        made = next((dict(sorted(f.metadata.items())) for f in known.values() if f.metadata), None)
        return footer.num_rows, size, f"made with {made or 'unknown settings'}"
    return footer.num_rows, size, None


def _spark_type(kind: pa.DataType) -> str:
    from pyspark.sql.pandas.types import from_arrow_type

    return from_arrow_type(kind).simpleString()


def usable_files(audit: DataFrame) -> list[str]:
    """The files without a fault; a name for each comes to the driver."""
    return sorted(r.file for r in audit.where("fault is null").select("file").collect())
