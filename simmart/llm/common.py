"""What the operators share: session settings, stored stages, worker tables."""

from __future__ import annotations

import ctypes
import gc
import sys
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, GroupedData, SparkSession
from pyspark.sql.pandas.group_ops import PandasCogroupedOps

from simmart.session import shared_dir, tune

# Rows of one Arrow batch. Texts differ in length by four orders of magnitude,
# so that the default of 10,000 rows may be a gigabyte.
BATCH_ROWS = 500


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the settings that the operators rely on."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder that every executor reaches, in spark.checkpoint.dir."""
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame, written to the shared folder and read back: it is computed
    once, and outlives the executors that computed it."""
    spark, path = df.sparkSession, new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Stored stages of one computation, removed together when what comes of
    them is stored itself."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.path = spark, new_folder(spark, name)

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    """How many parts the cluster is told to cut a shuffle into; groups that
    must fit into memory are counted in multiples of it."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def kept(key: tuple, make: Callable):
    """make(), once in the life of a Python worker. Functions reach workers by
    value, so that a module-level cache would last for one task only."""
    store = vars(sys).setdefault("_simmart_kept", {})
    if key not in store:
        store[key] = make()
    return store[key]


def _stage_store() -> dict:
    """What this Python worker keeps for the stage of its task. A worker serves
    one stage after another: with the first task of another stage, what it kept
    and what that has left behind goes."""
    context = TaskContext.get()
    stage = context.stageId() if context else None
    held = vars(sys).setdefault("_simmart_kept_in_stage", [stage, {}])
    if held[0] != stage:
        held[:] = stage, {}
        gc.collect()
        give_back()
    return held[1]


def kept_in_stage(key: tuple, make: Callable):
    """make(), once in a Python worker and stage: for what is large."""
    store = _stage_store()
    if key not in store:
        store[key] = make()
    return store[key]


def give_back() -> None:
    """Returns memory that was freed to the system. Arrow and the C library hold
    it otherwise, in each worker as much as its largest task so far has used."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def texts(column: pa.Array) -> list[str]:
    """The texts of a batch; null is the empty text."""
    return pc.fill_null(column, "").to_pylist()


def per_batch(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """function over each Arrow batch of the frame, where the rows lie."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _stage_store()
        try:
            for batch in batches:
                if batch.num_rows:
                    yield function(batch)
        finally:
            give_back()

    return df.mapInArrow(run, schema)


def per_group(groups: GroupedData, function: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """function over the table of each group."""

    def run(table: pa.Table) -> pa.Table:
        _stage_store()
        return function(table)

    return groups.applyInArrow(run, schema)


def per_cogroup(groups: PandasCogroupedOps, function: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """function over the two tables of each group."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        _stage_store()
        return function(left, right)

    return groups.applyInArrow(run, schema)


def blob(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()
