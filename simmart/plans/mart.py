"""Fact and dimension of the star schema."""

from __future__ import annotations

import math
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from simmart import schemas
from simmart.operators.quality import counted, foreign_key_violations, primary_key_violations
from simmart.session import shared_dir

FACT_KEYS = ["source_chembl_id", "target_chembl_id"]
DIM_KEYS = ["chembl_id"]
PART_ROWS = 1_000_000
MOST_TASKS = 4_096  # that write parts which stay whole
FILE = "low {0}, high {0}, n_rows bigint, file string"


def fact_rows(top: DataFrame) -> DataFrame:
    """Top rows in the fact's column order."""
    return top.select(
        "target_chembl_id", "source_chembl_id", "tanimoto_similarity", "has_duplicates_of_last_largest_score"
    )


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``old`` with the rows of ``new`` put in place of, or added to, those of
    the same key. Keys are unique on both sides, so no key can be hot."""
    kept = old.join(new.select(*keys), keys, "left_anti")
    return kept.select(*old.columns).unionByName(new)


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _system(spark, path).exists(_path(spark, path))


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Versions of a table that were listed completely."""
    if not exists(spark, f"{path}/files"):
        return []
    found = [s.getPath() for s in _system(spark, path).listStatus(_path(spark, f"{path}/files"))]
    return sorted(int(p.getName()) for p in found if exists(spark, f"{p}/_SUCCESS"))


def table_files(spark: SparkSession, path: str, version: int | None = None) -> list[Row]:
    """(low, high, n_rows, file) of a table's files in order: each holds the
    rows of one range of clustering keys, and no two ranges overlap."""
    versions = _versions(spark, path)
    if not versions:
        return []
    return sorted(spark.read.parquet(f"{path}/files/{version or versions[-1]}").collect(), key=lambda f: f.low)


def _place(files: list[Row], column: str, kind: str) -> Column:
    """The number of the file in whose range a key falls. A key between two
    ranges belongs to the one before it, one before all to the first."""
    if len(files) < 2:
        return F.lit(0)
    lows = np.array([f.low for f in files[1:]], object if kind == "string" else None)

    @F.pandas_udf("int")
    def place(keys: pd.Series) -> pd.Series:
        found = np.zeros(len(keys), np.int32)
        known = keys.notna().to_numpy()
        found[known] = np.searchsorted(lows, keys[known].to_numpy(lows.dtype), side="right")
        return pd.Series(found)

    return place(F.col(column))


def put(
    spark: SparkSession,
    path: str,
    new: DataFrame,
    keys: list[str],
    schema: str,
    cluster: str | None = None,
    gone: DataFrame | None = None,
    part_rows: int = PART_ROWS,
) -> int:
    """Upsert into a table in place; ``gone`` lists clustering keys of which no
    old row stays.

    The table is clustered by one key (the last, unless told): each file holds
    a range of it, and a list of the files tells the ranges. Only files in
    whose range a new or a gone key falls are read and written anew; one of
    more than twice ``part_rows`` is cut, so that the number of files follows
    the table's size, and the table before the first put is cut as a whole.
    Many rows of one clustering key stay together in one file.

    New files have names of their own and the list is written last, so that
    a put that breaks off leaves the table as it was and may be repeated; a
    repeated put gives the same rows. Files of the list before the last one
    stay for readers at work, older ones are removed. Keys are unique and not
    null in the new rows. A row for each file comes to the driver. Returns how
    many rows were put.
    """
    cluster = cluster or keys[-1]
    kind = spark.createDataFrame([], schema).schema[cluster].dataType.simpleString()
    versions, files = _versions(spark, path), table_files(spark, path)
    version = versions[-1] + 1 if versions else 1
    mark = uuid.uuid4().hex
    stage = f"{shared_dir(spark)}/put-{mark}"
    columns = spark.createDataFrame([], schema).columns
    placed = new.select(*columns).withColumn("part", _place(files, cluster, kind))
    placed, put_rows = counted(placed, f"put {mark}")
    placed.write.parquet(f"{stage}/new")
    placed = spark.read.schema(f"{schema}, part int").parquet(f"{stage}/new")
    if files:
        hit = placed.select("part")
        if gone is not None:
            gone = gone.select(F.col(gone.columns[0]).alias(cluster)).distinct()
            hit = hit.unionByName(gone.select(_place(files, cluster, kind).alias("part")))
        sizes = {r.part: r.n for r in hit.groupBy("part").agg(F.count("*").alias("n")).collect()}
        if not sizes:
            _system(spark, stage).delete(_path(spark, stage), True)
            return 0
        old = spark.read.schema(schema).parquet(*(files[i].file for i in sizes))
        if gone is not None:
            old = old.join(gone, cluster, "left_anti").select(*columns)
        merged = upsert(old.withColumn("part", _place(files, cluster, kind)), placed, keys)
        sizes = {i: n + files[i].n_rows for i, n in sizes.items()}
    else:
        merged, sizes = placed, {0: put_rows.get["n_rows"]}
    large = [i for i, n in sizes.items() if n > 2 * part_rows]
    small = [i for i in sizes if i not in large]
    target = f"{path}/parts/{mark}"
    if small:
        some = merged.where(F.col("part").isin(small)) if large else merged
        some = some.repartition(min(len(small), MOST_TASKS), "part")
        _write(some, cluster, keys, f"{target}/whole")
    if large:
        some = merged.where(F.col("part").isin(large)) if small else merged
        n = math.ceil(sum(sizes[i] for i in large) / part_rows)
        _write(some.repartitionByRange(n, "part", cluster), cluster, keys, f"{target}/cut")
    written = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(target)
    listed = written.groupBy(F.col("_metadata.file_path").alias("file"))
    listed = listed.agg(F.min(cluster).alias("low"), F.max(cluster).alias("high"), F.count("*").alias("n_rows")).collect()
    kept = [f for i, f in enumerate(files) if i not in sizes]
    rows = [(f.low, f.high, f.n_rows, f.file) for f in [*kept, *listed]]
    spark.createDataFrame(rows, FILE.format(kind)).coalesce(1).write.parquet(f"{path}/files/{version}")
    _system(spark, stage).delete(_path(spark, stage), True)
    _forget(spark, path, versions)
    return put_rows.get["n_rows"]


def _write(rows: DataFrame, cluster: str, keys: list[str], path: str) -> None:
    """A file for each part and task; a range of the key does not go on in
    another part, as parts are written apart."""
    rows.sortWithinPartitions("part", cluster, *keys).write.partitionBy("part").parquet(path)


def _forget(spark: SparkSession, path: str, versions: list[int]) -> None:
    """Remove files and lists that only versions before the last one need."""
    if len(versions) < 2:
        return
    needed = {f.file for v in (versions[-1], versions[-1] + 1) for f in table_files(spark, path, v)}
    for version in versions[:-1]:
        for f in table_files(spark, path, version):
            if f.file not in needed:
                _system(spark, f.file).delete(_path(spark, f.file), False)
        _system(spark, path).delete(_path(spark, f"{path}/files/{version}"), True)


def read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table that ``put`` keeps; an absent one is empty."""
    return _read(spark, table_files(spark, path), schema)


def read_keys(spark: SparkSession, path: str, schema: str, cluster: str, values: list) -> DataFrame:
    """The rows of some clustering keys, from the files in whose ranges these
    fall."""
    files = [f for f in table_files(spark, path) if any(f.low <= v <= f.high for v in values)]
    return _read(spark, files, schema).where(F.col(cluster).isin(values))


def read_near(spark: SparkSession, path: str, schema: str, cluster: str, keys: DataFrame) -> DataFrame:
    """The rows of the files in whose ranges some of many clustering keys (the
    first column) fall: all rows of those keys, and others."""
    files = table_files(spark, path)
    if not files:
        return _read(spark, [], schema)
    kind = spark.createDataFrame([], schema).schema[cluster].dataType.simpleString()
    near = keys.select(_place(files, keys.columns[0], kind).alias("part")).distinct().collect()
    return _read(spark, [files[r.part] for r in near], schema)


def _read(spark: SparkSession, files: list[Row], schema: str) -> DataFrame:
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(f.file for f in files))


def keys_in_fact(fact: DataFrame) -> DataFrame:
    """Distinct source and target ids, from one scan of the fact."""
    both = F.explode(F.array("source_chembl_id", "target_chembl_id"))
    return fact.select(both.alias("chembl_id")).distinct()


def dim_rows(properties: DataFrame, dictionary: DataFrame, fact: DataFrame) -> DataFrame:
    """Dimension rows of the molecules seen in the fact. Text numbers that do
    not parse become null; whole-number columns round half to even."""

    def number(name: str):
        return F.col(name).try_cast("double").alias(name)

    def whole(name: str):
        return F.bround(name).try_cast("int").alias(name)

    used = properties.join(keys_in_fact(fact), "chembl_id", "left_semi")
    return (
        used.join(dictionary.select("chembl_id", "molecule_type"), "chembl_id")
        .select(
            "chembl_id", "molecule_type", number("mw_freebase"), number("alogp"), number("psa"),
            number("cx_logp"), "molecular_species", number("full_mwt"),
            whole("aromatic_rings"), whole("heavy_atoms"),
        )
        .distinct()
    )


def fact_faults(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """(rule, detail, n_rows) of every broken key of fact and dimension."""

    def listed(df: DataFrame, rule: str, columns: list[str]) -> DataFrame:
        return df.select(F.lit(rule).alias("rule"), F.concat_ws(",", *columns).alias("detail"), "n_rows")

    return (
        listed(primary_key_violations(fact, FACT_KEYS), "fact primary key", FACT_KEYS)
        .unionByName(listed(primary_key_violations(dim, DIM_KEYS), "dimension primary key", DIM_KEYS))
        .unionByName(
            listed(foreign_key_violations(fact, "source_chembl_id", dim, "chembl_id"), "source key", ["key_value"])
        )
        .unionByName(
            listed(foreign_key_violations(fact, "target_chembl_id", dim, "chembl_id"), "target key", ["key_value"])
        )
    )
