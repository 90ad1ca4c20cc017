"""Language, quality and top-k search."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from simmart.llm import covertree, language, quality
from tests.llm.conftest import DOCS, prose

ALPHABETS = {"aa": "abcdeinrst", "bb": "klmnoprstu", "cc": "уеиоабвгд"}


def tongue(name: str, seed: int, n: int = 60) -> str:
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list(ALPHABETS[name]), rng.integers(2, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def tongues(spark):
    rows = [(i, tongue(name, i * 3 + k), name, "s", 0) for i in range(0, 900, 3) for k, name in enumerate(ALPHABETS)]
    return spark.createDataFrame([(3 * i + 1, *r[1:]) for i, r in enumerate(rows)], DOCS).repartition(4)


def test_languages_held_out(tongues):
    found = language.identified(tongues).join(tongues.select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == tongues.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    held = [r for r in found if r.held_out]
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in found)


def test_languages_of_odd_documents(spark, tongues, odd_docs, no_docs):
    every = tongues.unionByName(odd_docs.select(*tongues.columns))
    rows = {r.doc_id: r for r in language.identified(every).where("doc_id <= 9 and doc_id % 3 <> 1 or doc_id is null").collect()}
    assert rows[3].lang_pred == rows[5].lang_pred == "und" and rows[3].score == 0 and rows[None].held_out is False
    assert language.identified(no_docs).count() == 0
    alone = language.identified(odd_docs.where("doc_id in (3, 5)")).collect()
    assert {r.lang_pred for r in alone} == {"und"}
    unlabelled = language.identified(tongues.withColumn("lang", F.lit(None).cast("string"))).limit(5).collect()
    assert {(r.lang_pred, r.score) for r in unlabelled} == {("und", 0.0)}


def test_rare_languages_are_learned_and_repeated_keys_kept_in_bounds(spark, monkeypatch):
    """Of 130 languages, one of which has nearly all rows and keys that repeat,
    all are learned, from as many texts each."""
    letters = [[chr(0x4E00 + 8 * n + i) for i in range(8)] for n in range(130)]

    def text(n: int, i: int) -> str:
        return " ".join(letters[n][i % 8] + letters[n][(i * 3 + k) % 8] for k in range(9))

    rows = [(1000 * n + i, text(n, i), f"l{n:03}", "s", 0) for n in range(130) for i in range(4)]
    rows += [(i % 3, text(0, i), "l000", "s", 0) for i in range(3000)] + [(-1, "12 34", "l999", "s", 0)]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    fitted = []
    fit = language.fit
    monkeypatch.setattr(language, "fit", lambda found, names: fitted.append(names) or fit(found, names))
    for sample, each in ((260, 2), (40, 1)):
        monkeypatch.setattr(language, "SAMPLE", sample)
        model = language.learned(docs, F.lit(True))
        assert model.languages == [f"l{n:03}" for n in range(130)]
        assert sorted(fitted[-1]) == sorted(model.languages * each)
    found = language.predicted(docs.where("doc_id >= 0"), model, keep=("lang",)).collect()
    assert np.mean([r.lang == r.lang_pred for r in found]) == 1


def test_kernel_is_shared_presence_over_the_mean():
    """Folded scores equal those by explicit kernel values and coefficients."""
    found = [language.presence(tongue(n, i)) for i in range(30) for n in ALPHABETS]
    names = [n for _ in range(30) for n in ALPHABETS]
    model = language.fit(found, names)
    texts = [language.presence(tongue(n, 1000 + i)) for i in range(5) for n in ALPHABETS]

    def kernel(x, y):
        return len(np.intersect1d(x, y)) / np.sqrt(len(x) * len(y))

    full = np.array([[kernel(x, y) for y in found] for x in found])
    target = np.where(np.array(names)[:, None] == np.array(model.languages)[None], 1.0, -1.0)
    exact = np.linalg.solve(full + language.RIDGE * len(found) * np.eye(len(found)), target)
    expected = np.array([[kernel(x, y) for y in found] for x in texts]) @ exact
    assert np.abs(model.scores(texts) - expected).max() < 0.02  # all texts are landmarks


# --- quality


def labelled(spark, n=600):
    good = [(i, prose(i, 50 + i % 40) + ".", "en", "s", 0) for i in range(0, n, 2)]
    bad = [(i, (prose(i, 8).upper() + "!! ") * (3 + i % 5), "en", "s", 0) for i in range(1, n, 2)]
    labels = [(i, 1 - i % 2, 0) for i in range(n)]
    labels += [(5, 0, 0), (None, 1, 0), (7, None, 0), (10**6, 1, 0)]
    return (
        spark.createDataFrame(good + bad, DOCS).repartition(3),
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
    )


def test_margin_does_not_depend_on_the_number_of_languages_or_runs(spark):
    """A text's margin of 0.5 to all others is 0.5, and told, among 4 and among
    15 languages, of which a score of 0.35 tells the first only; a
    quarter of a typical text's runs with half its value give as much."""
    slots = language.presence("abcdefgh")
    for n in (4, 15):
        for runs, value in ((len(slots), 0.5), (4 * len(slots), 0.25)):
            matrix = np.zeros((len(slots), n), np.float32)
            matrix[:, 1] = value / np.sqrt(len(slots))
            column = np.full(language.LENGTHS * language.SLOTS, -1, np.int32)
            column[slots] = np.arange(len(slots))
            model = language.Model([f"l{i:02}" for i in range(n)], column, matrix, runs)
            docs = spark.createDataFrame([(1, "abcdefgh"), (2, "!!"), (3, None)], "doc_id bigint, text string")
            found = {r.doc_id: r for r in language.predicted(docs, model, margin=True).collect()}
            assert found[1].margin == pytest.approx(0.5, abs=1e-5) and found[1].lang_pred == "l01"
            assert found[2].margin == found[3].margin == 0 and found[2].lang_pred == "und"
            assert (found[1].score >= 0.35) == (n == 4)
            assert found[1].margin >= corpus_pipeline.LEAST_LANGUAGE


def test_quality_held_out(spark):
    docs, labels = labelled(spark)
    found = quality.rated(docs, labels).collect()
    assert len(found) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)
    assert np.mean([r.predicted == 1 - r.doc_id % 2 for r in found if r.held_out]) > 0.97


def test_quality_of_odd_documents(spark, odd_docs, no_docs):
    docs, labels = labelled(spark, 60)
    every = docs.withColumn("doc_id", F.col("doc_id") + 100).unionByName(odd_docs.select(*docs.columns))
    rows = quality.rated(every, labels.withColumn("doc_id", F.col("doc_id") + 100)).collect()
    assert len(rows) == every.count() and all(0 <= r.score <= 1 for r in rows)
    empty = {r.score for r in rows if r.doc_id in (3, 4)}
    assert len(empty) == 1
    assert quality.rated(no_docs, labels).count() == 0
    assert {r.score for r in quality.rated(docs, labels.limit(0)).collect()} == {0.5}


def test_trees_traversal_equals_a_walk():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    trees = quality.grow(x, y)
    scores = trees.scores(x)
    assert np.mean((scores >= 0.5) == (y == 1)) > 0.97
    for row, score in zip(x[:20], scores):
        total = trees.base
        for f, t, v in zip(trees.feature, trees.threshold, trees.value):
            node = 0
            while node < len(f):
                node = 2 * node + 1 + int(row[f[node]] > t[node])
            total += v[node - len(f)]
        assert score == pytest.approx(1 / (1 + np.exp(-total)))
    assert quality.grow(np.zeros((0, 4)), np.zeros(0)).scores(x[:3]).tolist() == [0.5] * 3


# --- top-k search


def brute_best(rows, k, scale=256):
    usable = [
        (i, [int(np.floor(v * scale)) for v in e])
        for i, e in rows
        if i is not None and e is not None and all(v is not None and np.isfinite(v) for v in e)
    ]
    limits = np.iinfo(np.int64)
    found = {}
    for q in sorted({i for i, _ in usable if i % 50 == 0}):
        scored = [
            (min(max(sum(a * b for a, b in zip(x, y)), limits.min), limits.max), i)
            for j, x in usable if j == q
            for i, y in usable if i != q and len(x) == len(y)
        ]
        found[q] = sorted(scored, key=lambda s: (-s[0], s[1]))[:k]
    return found


@pytest.mark.parametrize("block", [16, 4096])
def test_search_equals_brute_force(spark, block):
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(5, 6))
    rows = [(i, [float(np.float32(v)) for v in centres[i % 5] + 0.1 * rng.normal(size=6)]) for i in range(300)]
    rows += [(1000 + i, rows[3][1]) for i in range(80)]  # one vector many times
    rows += [(2000, None), (2001, []), (2050, [float("nan")] * 6), (2100, [1.0] * 5 + [float("inf")]), (2150, [0.0, None] * 3)]
    rows += [(2200, [1.0, 2.0]), (2201, [0.5, 0.25]), (None, rows[0][1])]
    schema = "vec_id bigint, embedding array<float>, label int, id int, vector int"
    vectors = spark.createDataFrame([(i, e, 0, 1, 2) for i, e in rows], schema).repartition(3)
    found = {}
    for r in covertree.nearest(vectors, F.col("id") % 50 == 0, block=block).collect():
        found.setdefault(r.query_id, {})[r.rank] = (r.score, r.vec_id)
    expected = {q: {n: s for n, s in enumerate(best, 1)} for q, best in brute_best(rows, 5).items() if best}
    assert found == expected


def test_search_of_large_numbers_and_repeated_rows(spark):
    rows = [(i, [1e12 * (i % 7 + 1), 3.0 + i]) for i in range(60)] + [(i, [1e30, -1e30]) for i in (61, 62, 63)]
    rows += [(5, [1e12 * 6, 8.0])] * 9
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = {}
    for r in covertree.nearest(vectors, F.col("id") % 50 == 0).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    for q, best in brute_best(rows, 5).items():
        assert sorted(found[q]) == [(n, *s) for n, s in enumerate(best, 1)]
    assert covertree.nearest(vectors.limit(0), F.col("id") % 50 == 0).count() == 0


def test_far_blocks_and_nodes_are_left_out(spark):
    """Clustered vectors: fewer than half of the pairs are compared, and the
    result is that of brute force."""
    rng = np.random.default_rng(12)
    middles = rng.normal(size=(24, 12)) * 4
    x = (middles[np.arange(4800) % 24] + rng.normal(size=(4800, 12)) * 0.05).tolist()
    vectors = spark.createDataFrame(list(enumerate(x)), "vec_id bigint, embedding array<double>").repartition(4)
    whole = np.floor(np.array(x) * 256)
    score = (whole[::50] @ whole.T).astype(np.int64)
    score[np.arange(96), np.arange(96) * 50] = -(2**62)
    expected = {(50 * q, r + 1, int(i), int(score[q, i])) for q in range(96) for r, i in enumerate(np.lexsort([np.arange(4800), -score[q]])[:5])}
    asked = F.col("id") % 50 == 0
    assert {tuple(r) for r in covertree.nearest(vectors, asked, block=200).collect()} == expected
    found = covertree.rounds(vectors, asked, block=200).select("asked", "compared").collect()
    blocks = len({r.asked for r in found})
    assert sum(r.compared for r in found) < 0.5 * 96 * 4800
    assert len(found) < 0.7 * blocks * 24  # pairs of blocks that were joined


def test_tree_covers():
    x = np.floor(np.random.default_rng(1).normal(size=(700, 5)) * 256)
    x[100:200] = x[7]
    tree = covertree.build(x)
    assert sorted(tree.order) == list(range(700))
    for node in range(len(tree.radius)):
        members = tree.order[tree.begin[node] : tree.end[node]]
        away = np.sqrt(((x[members] - x[tree.centre[node]]) ** 2).sum(axis=1))
        assert away.max() <= tree.radius[node] + 1e-6
        if tree.children[node]:
            own = slice(tree.child[node], tree.child[node] + tree.children[node])
            assert (tree.begin[own], tree.end[own])[0][0] == tree.begin[node]
            assert (tree.end[own] - tree.begin[own]).sum() == len(members)
