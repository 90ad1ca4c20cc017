"""What a task reads or holds must not grow with the input."""

import hashlib
from pathlib import Path
from urllib.parse import urlparse

from pyspark.sql import functions as F

from checks import queries
from simmart.functions import fingerprint as fp
from simmart.operators import quality, similarity
from simmart.session import shared_dir


def documents(spark, folder, n, files=1):
    rows = spark.range(n).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.lit(9).cast("bigint").alias("n_chars")
    )
    rows.repartition(files).write.parquet(f"{folder}/documents.parquet")


def test_each_task_writes_its_own_files_of_a_part(spark, tmp_path):
    """No part of the store goes through one task, and its files add up."""
    documents(spark, tmp_path, 4000, files=4)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        shared = Path(urlparse(shared_dir(spark)).path)
        before = set(shared.glob("prints-*"))
        found = {r.part: (r.fault, r.n_rows, r.rows_read) for r in queries.fingerprint_file_faults(spark, str(tmp_path)).collect()}
        store = (set(shared.glob("prints-*")) - before).pop()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert all(len(list(store.glob(f"part={part}/*.parquet"))) >= 4 for part in range(8))
    assert {part: found[part] for part in (0, 1, 4, 7)} == {
        0: (None, 500, 500), 1: ("no column text", 500, None), 4: ("unreadable", None, None), 7: (None, 500, 500)
    }
    assert len(found) == 8


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keys_are_dealt_out_before_they_are_counted(spark, monkeypatch):
    """A task counts KEY_ROWS rows or so, and several share a hot key."""
    monkeypatch.setattr(quality, "KEY_ROWS", 100)
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 100 == 1, None).otherwise(F.col("id"))
    df = spark.range(0, 2000, 1, 8).select(key.alias("k"), (F.col("id") % 1).alias("n"))
    found = quality.primary_key_violations(df, ["k", "n"])
    dealt = [line for line in plan(found).splitlines() if "Exchange" in line]
    assert len(dealt) == 2 and all(", 20), REPARTITION_BY_NUM" in line for line in dealt)
    hot = [r.id for r in spark.range(2000).collect() if r.id % 3 == 0 or r.id == 7]
    null = [i for i in range(2000) if i % 3 and i % 100 == 1]
    assert {(r.k, r.n_rows) for r in found.collect()} == {(7, len(hot)), (None, len(null))}


def test_sources_ranked_in_full_are_dealt_by_the_pairs_that_a_task_sorts(spark, monkeypatch):
    monkeypatch.setattr(similarity, "SORTED_PAIRS", 500)
    bits = [(f"m{i}", format(i * 7919 % 65536, "0128b")) for i in range(300)]
    sources = spark.createDataFrame(bits, "chembl_id string, bits string").select("chembl_id", fp.pack(F.col("bits")).alias("words"))
    targets = sources.where("chembl_id < 'm11'")  # m0, m1, m10 and m100 to m109
    found = similarity.top_of_all(targets, sources.coalesce(1), n_bits=128)
    assert "RoundRobinPartitioning(8)" in plan(found)  # 13 targets x 300 sources / 500
    assert set(found.collect()) == set(similarity.top_similar(targets, sources, n_bits=128).collect())


def test_bands_compute_each_fingerprint_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def bits(i):
        seen.add(1)
        return format(i, "0128b")

    ids = spark.range(0, 200, 1, 4)
    rows = ids.select(F.concat(F.lit("m"), "id").alias("chembl_id"), fp.pack(bits("id")).alias("words"))
    similarity.write_bands(rows, f"{tmp_path}/bands")
    assert seen.value == 200 and similarity.read_bands(spark, f"{tmp_path}/bands").count() == 200


def test_texts_longer_than_a_block(spark, monkeypatch):
    """Blocks and groups of texts give what each text gives by itself, and the
    scan of a text is no JVM expression by code point."""
    monkeypatch.setattr(fp, "BLOCK", 50)
    texts = ["abc" * 100 + "é😀\n" + "x", "", None, "a", "ab", "😀", "C" * 49, "C" * 50, "C" * 51 + "N", "the last"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string").coalesce(1)
    found = rows.select("i", fp.bit_positions(F.col("x"), 2, 64).alias("p"), fp.fingerprint(F.col("x"), n_bits=64, valid=lambda t: F.length(t) > 0).alias("b"))
    assert "regexp_extract_all" not in plan(found)
    for r in found.collect():
        text = texts[r.i]
        grams = {text[a : a + n] for n in (1, 2, 3) for a in range(len(text) - n + 1)} if text is not None else None
        want = None if text is None else sorted({int(hashlib.md5(g.encode()).hexdigest()[:8], 16) % 64 for g in grams})
        assert r.p == want
        assert r.b == (None if not text else "".join("01"[i in want] for i in range(64)))
