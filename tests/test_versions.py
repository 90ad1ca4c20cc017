import math
import re

import pytest
from pyspark.sql import functions as F

from simmart import schemas
from simmart.operators import versions
from simmart.plans import ingest


def keys(spark, sizes):
    """(v, k) with so many keys for each version, no key in two versions."""
    rows = spark.createDataFrame(list(enumerate(sizes)), "v int, n int")
    return rows.select("v", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("k")).select("v", (F.col("v") * 1_000_000 + F.col("k")).alias("k"))


def test_equal_keys_are_alike_and_fewer_keys_never_exceed(spark):
    """Sizes over every way a sketch is stored, parts in other orders, rows
    that repeat: equal sets never differ, a part of a set never exceeds it."""
    sizes = [int(1.4**i) for i in range(1, 30)]
    expected = keys(spark, sizes)
    same = F.col("v") % 3 > 0
    actual = expected.where(same | (F.col("k") % 2 == 0)).repartition(7, "k")
    actual = actual.unionByName(actual.where("k % 3 = 0"))
    found = versions.compared(*(versions.key_sketches(d, "k", ["v"]) for d in (expected, actual)), ["v"]).collect()
    assert len(found) == len(sizes) and not any(r.exceeds for r in found)
    assert {r.v for r in found if r.lacks} == set(range(0, len(sizes), 3))
    for r in found:
        assert r.n_expected == pytest.approx(sizes[r.v], rel=4 * 1.04 / math.sqrt(2**versions.LOG_REGISTERS), abs=1)


@pytest.mark.parametrize("n", [300, 3_000, 30_000])
def test_as_many_keys_as_stated_go_unnoticed_rarely(spark, n):
    """Sixty versions that lack that many keys: about one in twenty is missed,
    and far more at a third of it."""
    all_ = keys(spark, [n] * 60)
    lost = versions.unnoticed(n, 10)
    own = versions.key_sketches(all_, "k", ["v"], 10)

    def missed(gone: int) -> int:
        rest = versions.key_sketches(all_.where(f"k - v * 1000000 > {gone}"), "k", ["v"], 10)
        return versions.compared(own, rest, ["v"]).where("not lacks").count()

    assert missed(lost) <= 9
    assert n < 1_000 or missed(lost // 3) > missed(lost)


def test_reconciled_reads_only_versions_that_differ(spark, tmp_path):
    """Null and repeated keys, null and absent versions, empty text as a key."""
    expected = [("a", "x"), ("a", ""), ("a", None), ("b", "x"), ("b", "y"), ("b", "y"), (None, "n"), ("d", "d"), ("f", None)]
    actual = [("a", "x"), ("a", "x"), ("a", ""), ("b", "y"), ("b", "z"), ("b", "w"), (None, "m"), ("e", "e"), ("e", None)]
    one, two = (spark.createDataFrame(r, "version string, key string") for r in (expected, actual))
    found = {r.version: tuple(r)[1:] for r in versions.reconciled(one, two, "key", "version").collect()}
    assert found == {
        "a": ("sketch", 0, 0, found["a"][3]), "b": ("keys", 1, 2, 0), None: ("keys", 1, 1, 0),
        "d": ("keys", 1, 0, 0), "e": ("keys", 0, 1, 0), "f": ("sketch", 0, 0, 0),
    }
    assert versions.reconciled(one.limit(0), two.limit(0), "key", "version").count() == 0

    for name, rows in (("one", one), ("two", two)):
        rows.where("version < 'c'").write.partitionBy("version").parquet(f"{tmp_path}/{name}")
    one, two = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("one", "two"))
    exact = versions.reconciled(one, two, "key", "version")
    assert {(r.version, r.checked) for r in exact.collect()} == {("a", "sketch"), ("b", "keys")}
    plan = exact._jdf.queryExecution().executedPlan().toString()
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
    assert filters and all(f.endswith("= b)") for f in filters), filters  # of the final plan and the first


def test_versions_of_the_staging_area(spark, tmp_path):
    """Three runs' tables: fingerprints are short in one, and ids come and go."""
    runs = {"1": (range(100), range(100)), "2": (range(20, 150), range(20, 140)), "3": (range(20, 150), range(20, 150))}
    for version, (ids, printed) in runs.items():
        out = ingest.Staging(str(tmp_path), version)
        for name, own in (("staging_compound_structures", ids), ("fingerprints", printed)):
            rows = [(f"M{i}", "1") for i in own] + ([(None, "1")] if version == "1" else [])
            out.write(spark.createDataFrame(rows, schemas.FINGERPRINT), name)
        ingest.write_sketches(spark, out, ["staging_compound_structures", "fingerprints"])
    found = {r.version: (r.checked, r.n_missing, r.n_extra) for r in ingest.reconcile_versions(spark, str(tmp_path)).collect()}
    assert found == {"1": ("sketch", 0, 0), "2": ("keys", 10, 0), "3": ("sketch", 0, 0)}
    changes = ingest.version_changes(spark, str(tmp_path)).where("table_name = 'fingerprints'").orderBy("version").collect()
    assert [tuple(r)[1:] for r in changes] == [
        ("1", 100, 100, 0, True, False), ("2", 120, 40, 20, True, True), ("3", 130, 10, 0, True, False),
    ]
    counted = ingest.stored_sketches(spark, str(tmp_path)).where("version = '1'").collect()
    assert {(r.n_rows, r.n_keys) for r in counted} == {(101, 100)}
