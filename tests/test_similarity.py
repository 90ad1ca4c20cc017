import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from simmart.functions.fingerprint import pack
from simmart.operators import scoring
from simmart.operators.similarity import (
    pair_scores, rank_top, read_bands, top_similar, top_similar_stored, wanted_bands, write_bands,
)
from simmart.plans import monthly

BITS = 128
FLAG = "has_duplicates_of_last_largest_score"


def words(spark, rows):
    return spark.createDataFrame(rows, "chembl_id string, bits string").select("chembl_id", pack(F.col("bits")).alias("words"))


def brute(targets, sources):
    scores = []
    for t, tb in targets:
        for s, sb in sources:
            if t != s and tb and sb and set(tb + sb) <= {"0", "1"}:
                both = sum(x == y == "1" for x, y in zip(tb, sb))
                either = sum("1" in (x, y) for x, y in zip(tb, sb))
                scores.append((t, s, both / either if either else 1.0))
    return scores


def brute_top(scores, k=10):
    out = set()
    for t in {t for t, _, _ in scores}:
        mine = sorted((-v, s) for tt, s, v in scores if tt == t)
        for i, (v, s) in enumerate(mine[:k]):
            tied = i == k - 1 and any(w == v for w, _ in mine[k:])
            out.add((t, s, -v, tied))
    return out


def random_rows(seed, n, prefix, copies=0.4):
    """Rows of which a share are copies of one another, so scores tie."""
    rng = random.Random(seed)
    pool = ["".join(rng.choice("0001") for _ in range(128)) for _ in range(max(1, n // 3))] + ["0" * 128]
    rows = []
    for i in range(n):
        bits = pool[0] if rng.random() < copies else rng.choice(pool)
        rows.append((f"{prefix}{i}", bits))
    return rows


@pytest.fixture(scope="module")
def case():
    targets = random_rows(1, 9, "m") + [("bad", "xx"), ("none", None)]
    sources = random_rows(2, 300, "m") + [("odd", None)]
    return targets, sources


@pytest.mark.parametrize("block, rows, near", [(1024, 65_536, 2_048), (4, 32, 2), (1024, 200, 12)])
def test_scores_equal_brute_force(spark, case, block, rows, near, monkeypatch):
    """With one block of targets, and with many blocks and refilled sources;
    with first floors and without."""
    for name, value in (("WIDTH", block), ("ALL_ROWS", rows), ("BEST_ROWS", rows), ("NEAR_ROWS", near), ("OUT_ROWS", 8 * rows)):
        monkeypatch.setattr(scoring, name, value)
    targets, sources = case
    scores = brute(targets, sources)
    t, s = words(spark, targets), words(spark, sources).repartition(5)
    full = pair_scores(t, s, BITS)
    assert {tuple(r) for r in full.collect()} == set(scores)
    assert full.count() == len(scores)
    top = top_similar(t, s, 10, BITS)
    assert {tuple(r) for r in top.collect()} == brute_top(scores)


@pytest.mark.parametrize("band", [1, 8, 64])
@pytest.mark.parametrize("k", [2, 10])
def test_stored_bands_equal_brute_force(spark, tmp_path, case, band, k):
    targets, sources = case
    write_bands(words(spark, sources).repartition(5), f"{tmp_path}/bands", band)
    store = read_bands(spark, f"{tmp_path}/bands")
    top = top_similar_stored(words(spark, targets), store, k, BITS, band)
    assert {tuple(r) for r in top.collect()} == brute_top(brute(targets, sources), k)
    assert store.count() == sum(b is not None for _, b in sources)


def test_second_round_reads_only_bands_that_can_matter(spark, tmp_path):
    """Targets of about 20 set bits among sources of 1 to 120: those that are
    alike have about as many."""
    rng = random.Random(3)

    def row(name, n):
        bits = ["0"] * 128
        for i in rng.sample(range(40), n) if n <= 40 else rng.sample(range(128), n):
            bits[i] = "1"
        return name, "".join(bits)

    sources = [row(f"s{i:04}", 1 + i % 120) for i in range(1200)]
    sources += [(f"t{i}-{j}", sources[19 + 120 * (i % 10)][1]) for i in range(10) for j in range(12)]
    targets = [(f"q{i}", sources[19 + 120 * i][1]) for i in range(10)]
    write_bands(words(spark, sources), f"{tmp_path}/bands", 8)
    store = read_bands(spark, f"{tmp_path}/bands")
    top = top_similar_stored(words(spark, targets), store, 10, BITS, 8)
    assert {tuple(r) for r in top.collect()} == brute_top(brute(targets, sources))
    floored = words(spark, targets).withColumn("floor", F.lit(0.9))
    assert wanted_bands(floored, 8, BITS) == []  # counts of 18 to 22, all within the own band
    assert wanted_bands(floored.withColumn("floor", F.lit(0.75)), 8, BITS) == [1, 3]


def test_scores_of_one_target_read_few_row_groups(spark, tmp_path):
    rng = random.Random(4)
    rows = [(f"m{i:04}", "".join(rng.choice("01") for _ in range(64))) for i in range(1000)]
    t = words(spark, rows)
    monthly.write_scores(pair_scores(t, words(spark, rows[:300]).coalesce(1), n_bits=64), f"{tmp_path}/scores", 4096)
    path = f"{tmp_path}/scores"
    found = monthly.scores_of(spark, path, ["m0500"])
    assert found.count() == 300
    assert "EqualTo(target_chembl_id,m0500)" in found._jdf.queryExecution().executedPlan().toString()  # pushed to the footers
    holding = total = 0
    for file in (tmp_path / "scores").glob("*.parquet"):
        footer = pq.ParquetFile(file).metadata
        for i in range(footer.num_row_groups):
            least = footer.row_group(i).column(0).statistics
            total += 1
            holding += least.min <= "m0500" <= least.max
    assert total >= 200 and holding <= total / 100


def test_rank_top_of_full_scores(spark, case):
    targets, sources = case
    full = pair_scores(words(spark, targets), words(spark, sources), n_bits=BITS)
    assert {tuple(r) for r in rank_top(full).collect()} == brute_top(brute(targets, sources))


@pytest.mark.parametrize("k", [1, 3])
def test_other_k(spark, case, k):
    targets, sources = case
    top = top_similar(words(spark, targets), words(spark, sources), k, n_bits=BITS)
    assert {tuple(r) for r in top.collect()} == brute_top(brute(targets, sources), k)


def test_hot_copies_keep_every_tie(spark):
    """A third of the sources are one fingerprint; ids decide, flag is set."""
    sources = [(f"c{i:03}", "1100" * 16) for i in range(120)] + random_rows(7, 240, "r", copies=0)
    targets = [("c000", "1100" * 16)]
    short = [(n, b[:64]) for n, b in sources]
    top = top_similar(words(spark, targets), words(spark, short).repartition(7), n_bits=64)
    rows = top.orderBy("source_chembl_id").collect()
    assert [r.source_chembl_id for r in rows] == [f"c{i:03}" for i in range(1, 11)]
    assert [r[FLAG] for r in rows] == [False] * 9 + [True]


def test_number_ids(spark):
    t = spark.createDataFrame([(1, "1100" * 16), (2, "1010" * 16)], "chembl_id bigint, bits string")
    w = t.select("chembl_id", pack(F.col("bits")).alias("words"))
    rows = top_similar(w, w, n_bits=64).collect()
    assert {(r.target_chembl_id, r.source_chembl_id) for r in rows} == {(1, 2), (2, 1)}


def test_no_targets_or_no_sources(spark):
    some, none = words(spark, random_rows(1, 4, "m")), words(spark, [("x", None)]).where("1 = 0")
    assert top_similar(none, some, n_bits=BITS).count() == 0
    assert top_similar(some, none, n_bits=BITS).count() == 0


def test_unlike_widths_raise(spark):
    wide, narrow = words(spark, [("a", "1100" * 32)]), words(spark, [("b", "1100" * 16)])
    for t, s, n in ((wide, narrow, 128), (narrow, wide, 128), (wide, wide, 64), (wide.unionByName(narrow).coalesce(1), wide, 128)):
        with pytest.raises(Exception, match="fingerprints of [12] words are needed"):
            pair_scores(t, s, n_bits=n).collect()


def test_repeated_target_ids_keep_no_self_pair(spark):
    t = words(spark, [("x", "1100" * 16), ("x", "1100" * 16), ("y", "1010" * 16)])
    rows = [tuple(r)[:2] for r in pair_scores(t, t, n_bits=64).collect()]
    assert sorted(rows) == [("x", "y")] * 2 + [("y", "x")] * 2


@pytest.mark.parametrize(
    "scores, flag",
    [
        # The known case of a tie.
        ([0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1, 0.05, 0.05], True),
        ([i / 12 for i in range(11, 0, -1)], False),
        ([i / 16 for i in range(10, 0, -1)], False),
        ([i / 16 for i in range(9, 0, -1)], False),
        ([0.75] * 3 + [i / 32 for i in range(8, 0, -1)], False),
    ],
)
def test_tie_flag(spark, scores, flag):
    rows = [("T", f"CHEMBL{i:02}", v) for i, v in enumerate(scores)]
    df = spark.createDataFrame(rows, "target_chembl_id string, source_chembl_id string, similarity_score double")
    top = rank_top(df).orderBy("source_chembl_id").collect()
    assert len(top) == min(10, len(scores))
    assert [r[FLAG] for r in top] == [False] * (len(top) - 1) + [flag]


def test_ranking_is_cut_before_the_shuffle(spark):
    df = spark.createDataFrame([("T", "S", 0.5)], "target_chembl_id string, source_chembl_id string, similarity_score double")
    plan = rank_top(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_neither_side_is_shuffled(spark, case):
    targets, sources = case
    plan = pair_scores(words(spark, targets), words(spark, sources), n_bits=BITS)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
