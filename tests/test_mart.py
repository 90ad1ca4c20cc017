import datetime as dt
import random
import time
import uuid

import pytest
from pyspark.sql import functions as F

from simmart import schemas
from simmart.operators import dedup, quality
from simmart.operators.similarity import top_similar
from simmart.operators.skew import splittable_join
from simmart.plans import ingest, mart, monthly, views
from simmart.sources import files, tables
from simmart.streaming import targets as stream


def fact(spark, rows):
    return spark.createDataFrame([(t, s, v, False) for s, t, v in rows], schemas.FACT)


def test_upsert_replaces_appends_and_repeats(spark):
    old = fact(spark, [("a", "t", 0.1), ("b", "t", 0.2)])
    new = fact(spark, [("a", "t", 0.9), ("c", "t", 0.3)])
    once = mart.upsert(old, new, mart.FACT_KEYS)
    values = {(r.source_chembl_id, r.tanimoto_similarity) for r in once.collect()}
    assert values == {("a", 0.9), ("b", 0.2), ("c", 0.3)} and once.columns == old.columns
    twice = mart.upsert(once, new, mart.FACT_KEYS)
    assert sorted(twice.collect()) == sorted(once.collect())


def test_dimension_rows(spark):
    properties = spark.createDataFrame(
        [("a", "1.5", "NULL", 2.5), ("b", "x", "2", 3.5), ("c", "1", "1", 1.0), ("d", "1", "1", 1.0)],
        "chembl_id string, mw_freebase string, alogp string, aromatic_rings double",
    ).withColumns(
        {**{c: F.lit("7") for c in ("psa", "cx_logp", "full_mwt")}, "molecular_species": F.lit("ACID"), "heavy_atoms": F.lit(-2.5)}
    )
    dictionary = spark.createDataFrame([("a", "m"), ("b", None), ("d", "m")], "chembl_id string, molecule_type string")
    dim = mart.dim_rows(properties, dictionary, fact(spark, [("a", "b", 0.5), ("c", "a", 0.5)]))
    assert [f.simpleString() for f in dim.schema] == [f.simpleString() for f in spark.createDataFrame([], schemas.DIM).schema]
    rows = {r.chembl_id: r for r in dim.collect()}
    assert set(rows) == {"a", "b"}  # c has no dictionary row, d is not in the fact
    assert (rows["a"].mw_freebase, rows["a"].alogp, rows["a"].aromatic_rings) == (1.5, None, 2)
    assert (rows["b"].mw_freebase, rows["b"].alogp, rows["b"].aromatic_rings, rows["b"].heavy_atoms) == (None, 2.0, 4, -2)


def test_key_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), (None, 2)], "k string, n int")
    found = {(r.k, r.n, r.n_rows) for r in quality.primary_key_violations(df, ["k", "n"]).collect()}
    assert found == {("a", 1, 2), (None, 2, 1)}
    dim = spark.createDataFrame([("a",)], "id string")
    assert [tuple(r) for r in quality.foreign_key_violations(df, "k", dim, "id").collect()] == [("k", "b", 1)]


def test_duplicates(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5)], "k string, n int")
    assert sorted(r.n for r in dedup.duplicate_members(df, ["k"]).collect()) == [1, 2, 4, 5]
    assert sorted(r.n for r in dedup.keep_first(df, ["k"], ["n"]).collect()) == [1, 3, 4]


def test_drop_repeats_equals_keep_first(spark):
    rng = random.Random(9)
    rows = [("hot" if i % 3 == 0 else f"k{rng.randrange(80)}", f"f{rng.randrange(3)}", i) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, f string, i int").repartition(6)
    wide = dedup.drop_repeats(df, ["k"], ["f", "i"])
    assert sorted(wide.collect()) == sorted(dedup.keep_first(df, ["k"], ["f", "i"]).collect())


def test_sources_are_the_first_of_each_id(spark, tmp_path):
    a, b = "01" * 1024, "10" * 1024
    for rows in ([("a", a), ("b", None)], [("a", b), ("b", b), ("c", a)]):
        ingest.write_fingerprints(spark.createDataFrame(rows, schemas.FINGERPRINT).coalesce(1), f"{tmp_path}/{len(rows)}")
    both = spark.read.parquet(f"{tmp_path}/2").unionByName(spark.read.parquet(f"{tmp_path}/3"))
    meta = spark.read.parquet(f"{tmp_path}/2").schema["fingerprint"].metadata
    both.select("chembl_id", F.col("fingerprint").alias("fingerprint", metadata=meta), "words").coalesce(1).write.parquet(f"{tmp_path}/q")
    found = {r.chembl_id: r.words[0] for r in monthly.source_words(spark, f"{tmp_path}/q").collect()}
    assert found == {"a": 0x5555555555555555, "b": -0x5555555555555556, "c": 0x5555555555555555}


@pytest.mark.parametrize("name", ["a-first", "z-last"])
def test_a_corrupt_file_is_told_wherever_it_stands(spark, tmp_path, name):
    spark.createDataFrame([("a", "01"), ("b", None)], schemas.FINGERPRINT).coalesce(1).write.parquet(f"{tmp_path}/p")
    (tmp_path / "p" / f"{name}.parquet").write_bytes(b"PAR1 not a file of columns PAR1")
    with pytest.raises(Exception, match="(?i)parquet"):
        files.fingerprint_files(spark, f"{tmp_path}/p").collect()
    read = files.fingerprint_files(spark, f"{tmp_path}/p", skip_corrupt=True, placed=True)
    assert [r.chembl_id for r in read.collect()] == ["a"]
    skipped = [r.file for r in files.files_without_rows(spark, f"{tmp_path}/p", read).collect()]
    assert [f.rsplit("/", 1)[1] for f in skipped] == [f"{name}.parquet"]


def test_audit_tells_every_file_that_cannot_be_used(spark, tmp_path):
    """Read rows and listed rows add up to what the footers tell."""
    folder, bits = f"{tmp_path}/store", "01" * 1024
    prints = spark.createDataFrame([(f"m{i}", bits if i % 5 else None) for i in range(20)], schemas.FINGERPRINT)
    for name in "abcd":
        ingest.write_fingerprints(prints.coalesce(1), f"{folder}/{name}")
    other = spark.createDataFrame([(f"n{i}", "01" * 512) for i in range(7)], schemas.FINGERPRINT)
    ingest.write_fingerprints(other.coalesce(1), f"{folder}/width", n_bits=1024)
    good = spark.read.parquet(f"{folder}/a")
    good.withColumnRenamed("words", "word").coalesce(1).write.parquet(f"{folder}/column")
    plain = F.col("chembl_id").alias("chembl_id", metadata={})
    good.select(plain, "words").coalesce(1).write.parquet(f"{folder}/settings")
    good.limit(0).coalesce(1).write.parquet(f"{folder}/empty")
    file, = (tmp_path / "store" / "d").glob("*.parquet")
    file.write_bytes(file.read_bytes()[:-40])
    (tmp_path / "store" / "none.parquet").write_bytes(b"")

    flat = tmp_path / "flat"
    flat.mkdir()
    for i, found in enumerate(sorted((tmp_path / "store").rglob("*.parquet"))):
        (flat / f"{found.parent.name}-{i} x.parquet").write_bytes(found.read_bytes())
    audit = monthly.source_audit(spark, str(flat))
    told = {r.file.rsplit("/", 1)[1].split("-")[0]: (r.n_rows, r.fault) for r in audit.collect()}
    assert told.pop("d")[0] is None and told.pop("store") == (None, "unreadable: ArrowInvalid")
    assert told == {
        "a": (16, None), "b": (16, None), "c": (16, None), "empty": (0, None),
        "width": (7, "made with {'n_bits': 1024, 'radius': 2}"),
        "column": (16, "no column words"),
        "settings": (16, "made with unknown settings"),
    }
    read = files.fingerprint_files(spark, str(flat), monthly.WORDS, "words", placed=True, only=files.usable_files(audit))
    listed = audit.where("fault is not null").agg(F.sum("n_rows")).first()[0]
    assert read.count() + listed == audit.agg(F.sum("n_rows")).first()[0] == 16 * 5 + 7
    with pytest.raises(ValueError, match="unreadable|no column|made with"):
        monthly.source_words(spark, str(flat))
    assert monthly.source_words(spark, str(flat), audit).count() == 16
    assert files.fingerprint_files(spark, str(flat), monthly.WORDS, "words", placed=True, only=[]).count() == 0


def test_reconcile(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert quality.reconcile(df, "k", df).first()[:] == (2, 3, False)
    assert quality.reconcile(df, "k", df.distinct()).first()[:] == (2, 2, True)
    none = df.where("1 = 0")
    assert quality.reconcile(none, "k", none).first()[:] == (0, 0, True)


def test_row_counter(spark, tmp_path):
    df, seen = quality.counted(spark.range(7), "molecules")
    df.where("id > 2").write.parquet(str(tmp_path / "x"))
    assert seen.get == {"n_rows": 7}


def test_even_chunks(spark):
    df = spark.range(1000)
    sizes = [len(p) for p in tables.even_chunks(df, 1000, 300).rdd.glom().collect()]
    assert len(sizes) == 4 and max(sizes) - min(sizes) <= 4
    assert tables.even_chunks(df.where("id < 0"), 0).count() == 0


# --- views against their definition in plain SQL windows, with one hot source
# and one hot target that each hold about a third of the rows


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(5)
    pairs = {("s0", f"t{i}") for i in range(300)} | {(f"s{i}", "t0") for i in range(300)}
    pairs |= {(f"s{rng.randrange(40)}", f"t{rng.randrange(40)}") for _ in range(300)}
    pairs |= {("x", "x"), ("y", "y"), ("only", "t1")}
    return fact(spark, [(s, t, rng.choice([0.1, None, 0.25, 0.5, 0.5, 0.75, 1.0])) for s, t in sorted(pairs)])


@pytest.mark.parametrize(
    "left, right", [("int", "bigint"), ("bigint", "int"), ("float", "double"), ("date", "timestamp"), ("string", "string")]
)
@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_splittable_join_is_a_join(spark, left, right, null_safe, how):
    day = "'2024-01-0' || " if left == "date" else ""
    values = [1, 2, 2, None, 3]
    many = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v int, i int").selectExpr(f"cast({day} v as {left}) k", "i")
    one = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n"), (4, "d")], "v int, w string").selectExpr(f"cast({day} v as {right}) k", "w")
    found = splittable_join(many, one, ["k"], how, null_safe)
    assert found.columns == ["k", "i", "w"]
    partner = {1: "a", 2: "b"} | ({None: "n"} if null_safe else {})
    expected = {(i, partner.get(v)) for i, v in enumerate(values) if how == "left" or v in partner}
    assert {(r.i, r.w) for r in found.collect()} == expected


def test_deviation_with_unlike_key_types(spark):
    pairs = spark.createDataFrame([(1, 2, 0.5)], "source_chembl_id bigint, target_chembl_id bigint, tanimoto_similarity double")
    for kind in ("int", "bigint"):
        dim = spark.createDataFrame([(1, 1.0), (2, 4.0)], f"chembl_id {kind}, alogp double")
        assert views.average_deviation(pairs, dim).first()[:] == (1, 3.0)


def test_next_most_similar_equals_windows(spark, skewed):
    skewed.createOrReplaceTempView("skewed")
    plain = spark.sql("""
        SELECT source_chembl_id, target_chembl_id, tanimoto_similarity,
               lead(tanimoto_similarity, 1) OVER (PARTITION BY target_chembl_id
                   ORDER BY tanimoto_similarity DESC NULLS FIRST, source_chembl_id) AS next_most_similar_target,
               nth_value(target_chembl_id, 2) OVER (PARTITION BY source_chembl_id
                   ORDER BY tanimoto_similarity DESC NULLS FIRST, target_chembl_id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS second_most_similar_target
        FROM skewed WHERE source_chembl_id <> target_chembl_id""")
    ours = views.next_most_similar(skewed)
    assert ours.columns == plain.columns
    key = lambda r: (r.source_chembl_id, r.target_chembl_id)
    assert sorted(ours.collect(), key=key) == sorted(plain.collect(), key=key)


def test_grouped_averages(spark):
    f = fact(spark, [("a", "t1", 0.25), ("a", "t2", 0.5), ("b", "t1", 1.0), ("c", "t1", 0.5)])
    p = spark.createDataFrame([("a", 3.0, 20.0), ("b", None, 20.0), ("c", 2.5, None)], "chembl_id string, aromatic_rings double, heavy_atoms double")
    rows = {(r.source_molecule, r.aromatic_rings, r.heavy_atoms): r.avg for r in views.grouped_averages(f, p).collect()}
    assert rows == {
        ("a", "TOTAL", "TOTAL"): 0.375, ("b", "TOTAL", "TOTAL"): 1.0, ("c", "TOTAL", "TOTAL"): 0.5,
        ("TOTAL", "3", "20"): 0.375, ("TOTAL", None, "20"): 1.0, ("TOTAL", "2.5", None): 0.5,
        ("TOTAL", "TOTAL", "20"): pytest.approx(1.75 / 3), ("TOTAL", "TOTAL", None): 0.5,
        ("TOTAL", "TOTAL", "TOTAL"): 0.5625,
    }


def test_grouped_averages_of_nothing(spark):
    p = spark.createDataFrame([("a", 3.0, 20.0)], "chembl_id string, aromatic_rings double, heavy_atoms double")
    assert [tuple(r) for r in views.grouped_averages(fact(spark, []), p).collect()] == [("TOTAL",) * 3 + (None,)]


@pytest.fixture
def no_broadcast(spark):
    """Joins by shuffle, and skew thresholds scaled down to the test's size."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.shuffle.partitions": "8",
    }
    old = {key: spark.conf.get(key, None) for key in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    yield
    for key, value in old.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_hot_keys_are_split(spark, no_broadcast):
    """One source holds a third of the rows; its join partition is divided."""
    n = 200_000
    source = F.when(F.col("id") % 3 == 0, "s0").otherwise(F.concat(F.lit("s"), F.col("id") % 4001))
    rows = spark.range(0, n, 1, 8).select(
        F.concat(F.lit("t"), F.col("id") % 70001).alias("target_chembl_id"),
        source.alias("source_chembl_id"),
        (F.col("id") % 50 / 50).alias("tanimoto_similarity"),
    )
    names = rows.selectExpr("explode(array(source_chembl_id, target_chembl_id)) AS chembl_id").distinct()
    dim = names.withColumn("alogp", (F.abs(F.hash("chembl_id")) % 100).cast("double"))
    for df in (views.average_deviation(rows, dim), views.next_most_similar(rows.dropDuplicates(mart.FACT_KEYS))):
        df.write.format("noop").mode("overwrite").save()
        df.collect()
        assert "skew=true" in final_plan(df)
    firsts = dedup.drop_repeats(rows.withColumn("n", F.monotonically_increasing_id()), ["source_chembl_id"], ["n"])
    assert len(firsts.collect()) == rows.select("source_chembl_id").distinct().count()
    assert "skew=true" in final_plan(firsts)
    members = dedup.duplicate_members(rows, ["source_chembl_id"])
    assert len(members.collect()) == n
    assert "skew=true" in final_plan(members)


def test_other_views(spark):
    f = fact(spark, [("CHEMBL2", "t2", 0.25), ("CHEMBL2", "t1", 0.5), ("z", "t1", 1.0), ("CHEMBL6200", "t1", 0.75)])
    assert {tuple(r) for r in views.average_score(f).collect()} == {("CHEMBL2", 0.375), ("z", 1.0), ("CHEMBL6200", 0.75)}
    pivot = views.pivot_scores(f)
    assert pivot.columns == ["target_chembl_id", *views.PIVOT_IDS]
    assert [(r.target_chembl_id, r.CHEMBL2, r.CHEMBL6200, r.CHEMBL6334) for r in pivot.collect()] == [
        ("t1", 0.5, 0.75, None), ("t2", 0.25, None, None),
    ]
    dim = spark.createDataFrame([("CHEMBL2", 1.0), ("t1", 3.0), ("t2", None), ("z", None)], "chembl_id string, alogp double")
    assert {tuple(r) for r in views.average_deviation(f, dim).collect()} == {("CHEMBL2", 2.0), ("z", None)}
    views.create_views(f, dim, dim.withColumns({"aromatic_rings": F.lit(1.0), "heavy_atoms": F.lit(2.0)}))
    assert spark.sql("SELECT count(*) FROM next_most_similar_molecule").first()[0] == 4


def prepare(spark, root):
    """A fingerprint store of 40 molecules and their staging tables."""
    ids = spark.range(40).select(F.concat(F.lit("S"), "id").alias("chembl_id"), "id")
    smiles = F.concat(F.repeat(F.lit("C"), (F.col("id") % 7 + 1).cast("int")), F.repeat(F.lit("N"), (F.col("id") % 5).cast("int")))
    structures = ids.select("chembl_id", smiles.alias("canonical_smiles"))
    structures.write.parquet(f"{root}/structures")
    ingest.write_fingerprints(ingest.fingerprints(structures), f"{root}/prints")
    props = ids.withColumns({f.name: F.lit("1.5" if f.dtype == "string" else 1.5).cast(f.dtype) for f in schemas.PROPERTIES})
    props.drop("id").write.parquet(f"{root}/properties")
    ids.withColumns({f.name: F.lit(None).cast(f.dtype) for f in schemas.DICTIONARY}).drop("id").write.parquet(f"{root}/dictionary")


def month(root, day, name):
    return monthly.Month(
        day=day, targets=f"{root}/in", fingerprints=f"{root}/prints", properties=f"{root}/properties",
        dictionary=f"{root}/dictionary", scores=f"{root}/{name}/scores", refused=f"{root}/{name}/refused",
        fact=f"{root}/fact", dim=f"{root}/dim",
    )


def test_two_months(spark, tmp_path):
    root = str(tmp_path)
    prepare(spark, root)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "data_08_2024.csv").write_text("h\nS1,CCN\nS2,CCCNN\nS2,C\nS3,C(\nbad line\n")
    (tmp_path / "in" / "data_09_2024.csv").write_text("h\nS2,NNNN\nS4,CN\n")

    assert monthly.has_files(spark, f"{root}/in", dt.date(2024, 8, 1))
    assert not monthly.has_files(spark, f"{root}/in", dt.date(2024, 10, 1))
    faults = monthly.run(spark, month(root, dt.date(2024, 8, 1), "m8"))
    assert faults.count() == 0
    first = mart.read(spark, f"{root}/fact", schemas.FACT)
    assert {(r.target_chembl_id, r["count"]) for r in first.groupBy("target_chembl_id").count().collect()} == {("S1", 10), ("S2", 10)}
    assert spark.read.parquet(f"{root}/m8/scores").count() == 2 * 39
    assert [r.reason for r in spark.read.parquet(f"{root}/m8/refused/lines").collect()] == ["malformed"]
    assert [r.chembl_id for r in spark.read.parquet(f"{root}/m8/refused/targets").collect()] == ["S3"]
    assert first.where("target_chembl_id = source_chembl_id").count() == 0

    counts = {r.step: r.n_rows for r in spark.read.parquet(f"{root}/m8/scores-work/counts").collect()}
    assert counts["molecule lines"] + counts["silent lines"] + counts["refused lines"] == counts["lines"] == 6
    assert counts["refused lines"] == counts["refused lines written"] == counts["files"] == 1
    assert counts["targets refused"] + counts["targets scored"] == counts["targets"] == 3
    assert counts["scores"] == counts["targets scored"] * counts["sources"] - 2 == 78  # both are sources too
    assert counts["fact rows put"] == first.count() and counts["dimension rows put"] == mart.read(spark, f"{root}/dim", schemas.DIM).count()
    assert monthly.scores_of(spark, f"{root}/m8/scores", ["S2"]).count() == 39

    first = spark.createDataFrame(first.collect(), schemas.FACT)
    second = monthly.run(spark, month(root, dt.date(2024, 9, 1), "m9"))
    assert second.count() == 0
    both = mart.read(spark, f"{root}/fact", schemas.FACT)
    assert {r.target_chembl_id for r in both.select("target_chembl_id").distinct().collect()} == {"S1", "S2", "S4"}
    assert both.groupBy(*mart.FACT_KEYS).count().where("count > 1").count() == 0
    assert both.join(first.where("target_chembl_id = 'S1'"), first.columns, "left_semi").count() == 10

    both = both.collect()
    assert monthly.run(spark, month(root, dt.date(2024, 10, 1), "m10")).count() == 0
    assert sorted(mart.read(spark, f"{root}/fact", schemas.FACT).collect()) == sorted(both)


def values(spark, path):
    return {(r.source_chembl_id, r.target_chembl_id): r.tanimoto_similarity for r in mart.read(spark, path, schemas.FACT).collect()}


def put(spark, path, rows, **more):
    return mart.put(spark, path, fact(spark, rows).repartition(3), mart.FACT_KEYS, schemas.FACT, **more)


def ranges(spark, path):
    """The files of a table, checked: no ranges overlap, and counts hold."""
    files = mart.table_files(spark, path)
    assert all(a.high < b.low for a, b in zip(files, files[1:]))
    for f in files:
        held = spark.read.parquet(f.file)
        assert (held.count(), *held.agg(F.min("target_chembl_id"), F.max("target_chembl_id")).first()) == (f.n_rows, f.low, f.high)
    return files


def test_put_replaces_and_appends(spark, tmp_path):
    path = str(tmp_path / "fact")
    assert mart.read(spark, path, schemas.FACT).count() == 0
    rows = [(f"s{i}", f"t{i % 7}", i / 100) for i in range(100)]
    assert put(spark, path, rows) == 100
    new = [("s3", "t3", 0.9), ("x", "y", 0.8), ("x", "a", 0.7)]
    expected = {(s, t): v for s, t, v in [*rows, *new]}
    for _ in range(3):
        assert put(spark, path, new) == 3 and values(spark, path) == expected
    assert mart.read(spark, path, schemas.FACT).count() == len(expected)
    assert put(spark, path, []) == 0 and values(spark, path) == expected


def test_put_leaves_most_files_and_grows_with_the_table(spark, tmp_path):
    """A month of 40 new targets among 10,000 leaves more than half of the
    files as they are; ten times the rows are about ten times the files."""
    rng = random.Random(6)
    names = rng.sample(range(1_000_000), 10_040)
    rows = [(f"s{j}", f"t{n:07}", j / 16) for n in names[:10_000] for j in range(10)]
    small, large = str(tmp_path / "small"), str(tmp_path / "large")
    put(spark, small, rows[: len(rows) // 10], part_rows=1_000)
    put(spark, large, rows, part_rows=1_000)
    few, many = mart.table_files(spark, small), ranges(spark, large)[:]
    assert 7 <= len(few) <= 14 and 80 <= len(many) <= 130
    month = [(f"s{j}", f"t{n:07}", j / 16) for n in names[10_000:] for j in range(10)]
    put(spark, large, month, part_rows=1_000)
    after = mart.table_files(spark, large)
    assert len({f.file for f in many} & {f.file for f in after}) > len(many) / 2
    assert values(spark, large) == {(s, t): v for s, t, v in [*rows, *month]}
    # Nine times as many rows beyond the last key are cut into files of their own.
    beyond = [(f"s{j}", f"u{n:07}", j / 16) for n in range(900) for j in range(10)]
    put(spark, small, beyond, part_rows=1_000)
    assert len(mart.table_files(spark, small)) >= len(few) + 7
    assert values(spark, small) == {(s, t): v for s, t, v in [*rows[: len(rows) // 10], *beyond]}


def test_hot_target_stays_in_one_file(spark, tmp_path):
    path = str(tmp_path / "fact")
    rows = [(f"s{i}", "hot" if i % 3 == 0 else f"t{i}", 0.5) for i in range(600)]
    put(spark, path, rows, part_rows=50)
    ranges(spark, path)
    put(spark, path, [(f"n{i}", "hot", 0.25) for i in range(300)], part_rows=50)
    ranges(spark, path)
    found = mart.read_keys(spark, path, schemas.FACT, "target_chembl_id", ["hot", "t4"])
    assert found.count() == 501 and len(found.inputFiles()) <= 2


def test_gone_keys_leave_the_table(spark, tmp_path):
    path = str(tmp_path / "fact")
    put(spark, path, [(f"s{i}", f"t{i % 50:02}", 0.5) for i in range(500)], part_rows=40)
    gone = spark.createDataFrame([("t07",), ("t31",), ("t31",), ("zz",)], "id string")
    put(spark, path, [("a", "t07", 1.0)], part_rows=40, gone=gone)
    found = values(spark, path)
    assert len(found) == 481 and found[("a", "t07")] == 1.0 and not any(t == "t31" for _, t in found)
    everything = spark.createDataFrame([(f"t{i:02}",) for i in range(50)], "id string")
    assert put(spark, path, [], part_rows=40, gone=everything) == 0 and values(spark, path) == {}
    put(spark, path, [("b", "c", 0.5)])
    assert values(spark, path) == {("b", "c"): 0.5}


def test_put_that_broke_off_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "fact")
    rows = [(f"s{i}", f"t{i % 50:02}", 0.5) for i in range(500)]
    put(spark, path, rows, part_rows=40)
    before = values(spark, path)
    broken = fact(spark, [("x", "t01", 0.9)]).withColumn("tanimoto_similarity", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        mart.put(spark, path, broken, mart.FACT_KEYS, schemas.FACT, part_rows=40)
    with monkeypatch.context() as m:  # new files are written, the list is not
        m.setattr(mart, "FILE", "low nonsense")
        with pytest.raises(Exception):
            put(spark, path, [("x", "t01", 0.9)], part_rows=40)
    assert values(spark, path) == before
    put(spark, path, [("x", "t01", 0.9)], part_rows=40)
    assert values(spark, path) == before | {("x", "t01"): 0.9}


def test_old_files_are_removed_after_one_more_put(spark, tmp_path):
    path = str(tmp_path / "fact")
    rows = [(f"s{i}", f"t{i % 50:02}", 0.5) for i in range(500)]
    put(spark, path, rows, part_rows=40)
    earlier = mart.read(spark, path, schemas.FACT)
    put(spark, path, [("x", "t01", 0.9)], part_rows=40)
    assert earlier.count() == 500  # a reader of the list before is still served
    for i in range(3):
        put(spark, path, [("x", "t01", i / 4)], part_rows=40)
    held = {p.name for p in (tmp_path / "fact" / "parts").rglob("*.parquet")}
    listed = {f.file.rsplit("/", 1)[1] for f in mart.table_files(spark, path)}
    assert listed <= held and len(held - listed) <= 1
    assert values(spark, path) == {(s, t): v for s, t, v in [*rows, ("x", "t01", 0.5)]}


def test_number_keys(spark, tmp_path):
    schema, path = "k bigint, v string", str(tmp_path / "t")
    big = 2**60
    for rows in ([(big + i, "a") for i in range(100)], [(big + i, "b") for i in range(50, 150)], [(-5, "c")]):
        mart.put(spark, path, spark.createDataFrame(rows, schema), ["k"], schema, part_rows=10)
    found = {r.k: r.v for r in mart.read(spark, path, schema).collect()}
    assert found == {big + i: "a" if i < 50 else "b" for i in range(150)} | {-5: "c"}


STREAM = {"07": "h\nS1,CCN\nS3,C(\nS5,CCCC\n", "08": "h\nS1,NN\nS2,CCCNN\nS3,CN\nbad\n", "09": "h\nS3,CC\nS5,C)\nS4,CNCN\n\n"}


@pytest.mark.parametrize("files_per_batch, order", [(1, ("07", "08", "09")), (1, ("09", "08", "07")), (1000, ("08", "09", "07"))])
def test_stream_gives_one_fact_in_any_order(spark, tmp_path, files_per_batch, order):
    """The first row of an id by file and line counts, in whatever order files
    arrive and however many come in a batch, also when batches are repeated, and
    when the progress is lost."""
    root = str(tmp_path)
    prepare(spark, root)
    (tmp_path / "in").mkdir()
    sources = monthly.source_words(spark, f"{root}/prints")
    calls = []

    def run(name):
        load = stream.FactLoader(sources, f"{root}/stream", name)

        def twice(lines, batch_id):
            load(lines, batch_id)
            calls.append((name, batch_id))
            load(lines, batch_id)

        stream.load_new_targets(spark, f"{root}/in", name, twice, files_per_batch=files_per_batch).awaitTermination()
        return sorted(mart.read(spark, f"{root}/stream/fact", schemas.FACT).collect())

    first, other = (f"targets_{uuid.uuid4().hex}" for _ in range(2))
    for month_ in order:
        (tmp_path / "in" / f"data_{month_}_2024.csv").write_text(STREAM[month_])
        time.sleep(0.02)
    (tmp_path / "in" / "other.csv").write_text("h\nS9,CCN\n")
    # S3's first row is refused, so that later ones do not count either.
    rows = [("S1", "CCN"), ("S2", "CCCNN"), ("S4", "CNCN"), ("S5", "CCCC")]
    expected = sorted(mart.fact_rows(top_similar(monthly.target_words(spark.createDataFrame(rows, schemas.TARGET)), sources)).collect())
    assert run(first) == expected and len(expected) == 40
    assert run(first) == expected
    assert run(other) == expected
    assert len(calls) == 2 * (3 if files_per_batch == 1 else 1)
    again = {r.step: r.n_rows for r in spark.read.parquet(f"{root}/stream/counts/run={other}").groupBy("step").agg(F.sum("n_rows").alias("n_rows")).collect()}
    assert again["files"] == 3 and again["lines"] == 14 and again["fact rows put"] == again["targets taken over"] == 0
    assert again["molecule lines"] + again["silent lines"] + again["refused lines"] == again["lines"] and again["refused lines"] == 1


def test_stream_counts_add_up(spark, tmp_path):
    root = str(tmp_path)
    prepare(spark, root)
    (tmp_path / "in").mkdir()
    for month_, text in STREAM.items():
        (tmp_path / "in" / f"data_{month_}_2024.csv").write_text(text)
    load = stream.FactLoader(monthly.source_words(spark, f"{root}/prints"), f"{root}/stream", "once")
    stream.load_new_targets(spark, f"{root}/in", f"targets_{uuid.uuid4().hex}", load).awaitTermination()
    found = {r.step: r.n_rows for r in spark.read.parquet(f"{root}/stream/counts/run=once/batch=0").collect()}
    assert found == {
        "files": 3, "lines": 14, "molecule lines": 9, "silent lines": 4, "refused lines": 1,
        "targets taken over": 5, "targets scored": 4, "fact rows put": 40,
    }
