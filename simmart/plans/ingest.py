"""First job: paged records to staging tables, then fingerprints."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from simmart.functions.fingerprint import N_BITS, RADIUS, fingerprint, pack
from simmart.operators import normalize, versions
from simmart.operators.quality import counted, primary_key_violations, reconcile
from simmart.sources import paged
from simmart.sources.tables import FINGERPRINT_CHUNK, even_chunks

FingerprintFn = Callable[[DataFrame], DataFrame]


# The primary keys of the staging tables.
STAGING_KEYS = {
    "staging_chembl_id_lookup": ["chembl_id"],
    "staging_molecule_dictionary": ["chembl_id"],
    "staging_compound_properties": ["chembl_id"],
    "staging_compound_structures": ["chembl_id"],
}


@dataclass(frozen=True)
class Staging:
    """Paths of the staging area. Each run writes a version of its own, all
    tables anew, so that a run may be repeated; readers name the version."""

    root: str
    version: str = "1"
    counts: dict[str, int] = field(default_factory=dict)

    def path(self, name: str) -> str:
        return f"{self.root}/version={self.version}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """The table, written in place of any of this version, and read back.
        Its rows are counted as they are written."""
        rows, seen = counted(df, name)
        rows.write.mode("overwrite").parquet(self.path(name))
        self.counts[name] = seen.get["n_rows"]
        return df.sparkSession.read.parquet(self.path(name))


def stage_pages(fetched: DataFrame, out: Staging, kind: str, rows: int) -> DataFrame:
    """(record) of every page that can be used. Pages are fetched once, into a
    table; those that are lost, broken or short are listed in another."""
    pages = out.write(fetched, f"pages_{kind}")
    out.write(normalize.page_faults(pages, rows), f"page_faults_{kind}")
    return normalize.unnest_pages(paged.good_pages(pages)).select("record")


def stage_lookups(fetched: DataFrame, out: Staging, rows: int = paged.PAGE_ROWS) -> None:
    """Lookup pages to their staging table, refused records aside."""
    checked = out.write(normalize.check_lookups(stage_pages(fetched, out, "lookups", rows)), "checked_lookups")
    out.write(normalize.lookup_table(checked), "staging_chembl_id_lookup")
    out.write(normalize.refused(checked), "refused_lookups")


def stage_molecules(fetched: DataFrame, out: Staging, rows: int = paged.PAGE_ROWS) -> None:
    """Molecule pages to three staging tables, refused records aside.

    Pages are fetched and parsed once, into one nested table on shared
    storage; each staging table then reads only its own columns of it.
    """
    checked = out.write(normalize.check_molecules(stage_pages(fetched, out, "molecules", rows)), "checked_molecules")
    out.write(normalize.dictionary_table(checked), "staging_molecule_dictionary")
    out.write(normalize.properties_table(checked), "staging_compound_properties")
    out.write(normalize.structures_table(checked), "staging_compound_structures")
    out.write(normalize.refused(checked), "refused_molecules")


def staging_key_violations(tables: dict[str, DataFrame], keys: dict[str, list[str]] = STAGING_KEYS) -> DataFrame:
    """(table_name, key_value, n_rows) of keys that repeat or are null."""
    found = [
        primary_key_violations(df.select(*keys[name]), keys[name]).select(
            F.lit(name).alias("table_name"), F.concat_ws(",", *keys[name]).alias("key_value"), "n_rows"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, found)


def batch_fingerprints(
    structures: DataFrame, batch_fn: Callable, radius: int = RADIUS, n_bits: int = N_BITS, chunk: int = FINGERPRINT_CHUNK
) -> DataFrame:
    """Fingerprints by a caller's own function on pandas batches: it takes a
    Series of structure strings, the radius and the width, and returns a
    Series of bit texts, null where the structure is refused. As such a
    function is slow, the rows are dealt evenly into parts of chunk rows."""

    def run(batches):
        for batch in batches:
            bits = batch_fn(batch["smiles"], radius, n_bits)
            yield batch[["chembl_id"]].assign(fingerprint=bits)

    ident = structures.schema["chembl_id"].dataType.simpleString()
    pairs = structures.select("chembl_id", F.col("canonical_smiles").alias("smiles"))
    return even_chunks(pairs, structures.count(), chunk).mapInPandas(run, f"chembl_id {ident}, fingerprint string")


def fingerprints(structures: DataFrame, radius: int = RADIUS, n_bits: int = N_BITS, **rule) -> DataFrame:
    """(chembl_id, fingerprint) of the structures that are accepted."""
    text = F.col("canonical_smiles")
    return structures.select("chembl_id", fingerprint(text, radius, n_bits, **rule).alias("fingerprint"))


def write_fingerprints(prints: DataFrame, path: str, radius: int = RADIUS, n_bits: int = N_BITS) -> None:
    """Write fingerprints, nulls dropped, as text and as packed words, with the
    settings that made them. A filter in place of the generator would be pushed
    down and compute each fingerprint twice."""
    kept = normalize.only(prints.select("chembl_id", "fingerprint"), F.col("fingerprint").isNotNull())
    bits = F.col("fingerprint").alias("fingerprint", metadata={"radius": radius, "n_bits": n_bits})
    kept.select("chembl_id", bits, pack(F.col("fingerprint"), n_bits).alias("words")).write.mode("overwrite").parquet(path)


def require_settings(prints: DataFrame, radius: int = RADIUS, n_bits: int = N_BITS) -> DataFrame:
    """Refuse a fingerprint table made with other settings, or unknown ones."""
    found = prints.schema["fingerprint"].metadata
    if (found.get("radius"), found.get("n_bits")) != (radius, n_bits):
        raise ValueError(f"fingerprints were made with {found or 'unknown settings'}, not radius={radius}, n_bits={n_bits}")
    return prints


SKETCHES = "table_name string, n_rows bigint, n_keys bigint, sketch binary, version string"


def write_sketches(spark: SparkSession, out: Staging, names: list[str], key: str = "chembl_id") -> DataFrame:
    """(table_name, n_rows, n_keys, sketch) of some tables of a version, by
    which versions are compared later without reading them."""

    def sketched(name: str) -> DataFrame:
        rows = spark.read.parquet(out.path(name)).select(key, F.lit(name).alias("table_name"))
        return versions.key_sketches(rows, key, ["table_name"])

    return out.write(reduce(DataFrame.unionByName, map(sketched, names)), "key_sketches")


def stored_sketches(spark: SparkSession, root: str) -> DataFrame:
    """The sketches of all versions of a staging area, with the version."""
    return spark.read.schema(SKETCHES).option("basePath", root).parquet(f"{root}/version=*/key_sketches")


def version_changes(spark: SparkSession, root: str) -> DataFrame:
    """What each version of each staging table has gained and lost, estimated
    from the sketches; see ``versions.changes``."""
    return versions.changes(stored_sketches(spark, root), "version", ["table_name"])


def reconcile_versions(
    spark: SparkSession,
    root: str,
    expected: str = "staging_compound_structures",
    actual: str = "fingerprints",
    key: str = "chembl_id",
) -> DataFrame:
    """Whether one table has the keys of another in every version. Tables are
    read only of those versions whose sketches differ."""
    sketches = stored_sketches(spark, root)

    def side(name: str) -> tuple[DataFrame, DataFrame]:
        rows = spark.read.schema(f"{key} string, version string").option("basePath", root).parquet(f"{root}/version=*/{name}")
        return rows, sketches.where(F.col("table_name") == name)

    (first, firsts), (second, seconds) = side(expected), side(actual)
    return versions.reconciled(first, second, key, "version", firsts, seconds)


def run(
    spark: SparkSession,
    lookups: paged.PageFetcher,
    molecules: paged.PageFetcher,
    out: Staging,
    rows: int = paged.PAGE_ROWS,
) -> DataFrame:
    """The whole job. Returns (step, expected, actual, matches), stored as the
    version's reconciliation: records learnt and records staged or refused, no
    faulty pages, no broken keys, structures and fingerprints."""

    stage_lookups(paged.pages(spark, lookups, rows, "lookup_pages"), out, rows)
    stage_molecules(paged.pages(spark, molecules, rows, "molecule_pages"), out, rows)
    out.write(staging_key_violations({n: spark.read.parquet(out.path(n)) for n in STAGING_KEYS}), "key_violations")
    structures = spark.read.parquet(out.path("staging_compound_structures"))
    write_fingerprints(fingerprints(structures), out.path("fingerprints"))
    write_sketches(spark, out, [*STAGING_KEYS, "fingerprints"])

    printed = reconcile(structures, "chembl_id", spark.read.parquet(out.path("fingerprints"))).first()
    count = out.counts
    steps = [
        ("lookup records", lookups.total(), count["staging_chembl_id_lookup"] + count["refused_lookups"]),
        ("lookup page faults", 0, count["page_faults_lookups"]),
        ("molecule records", molecules.total(), count["staging_molecule_dictionary"] + count["refused_molecules"]),
        ("molecule page faults", 0, count["page_faults_molecules"]),
        ("broken keys", 0, count["key_violations"]),
        ("fingerprints", printed.expected, printed.actual),
    ]
    found = spark.createDataFrame([(*s, s[1] == s[2]) for s in steps], "step string, expected bigint, actual bigint, matches boolean")
    return out.write(found, "reconciliation")
