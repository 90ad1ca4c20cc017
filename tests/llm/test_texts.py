"""Repeats, near duplicates, fingerprints and components."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from simmart.llm import graph, neardup, spots, substrings
from simmart.llm.words import Hasher, from_sorted_blob, sorted_blob, utf8
from tests.llm.conftest import DOCS, prose

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


# --- words


def test_word_hashes_are_of_words():
    hasher, seen = Hasher(), {}
    for text in ("a b  a\tccc\né a", "é", "", "   ", "b\x00 b", "ab a b", "a" * 100_000 + " a"):
        hashes, starts, ends = hasher.words(utf8(text))
        words = WORDS.findall(text)
        assert [text.encode()[s:e].decode() for s, e in zip(starts, ends)] == words
        for w, h in zip(words, hashes.tolist()):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)
    words = hasher.words(utf8("a b c d b c d"))[0]
    runs = hasher.runs(words, 3)
    assert runs[1] == runs[4] and len(set(runs.tolist())) == 4
    assert (hasher.runs(words, 1, skip=2, within=3) == hasher.runs(words[2:], 1)[:5]).all()


@pytest.mark.parametrize("values", [[], [0], [5, 5, 7], [1, 2**40, 2**64 - 1]])
def test_sorted_blob(values):
    values = np.array(values, np.uint64)
    assert (from_sorted_blob(sorted_blob(values)) == values).all()


# --- repeated passages


def brute_cut(rows, window=13):
    """Kept words of (key, text) rows; a null key is later than all."""
    rows = [(float("inf") if k is None else k, WORDS.findall(t or "")) for k, t in rows]
    first = {}
    for k, w in rows:
        for i in range(len(w) - window + 1):
            at = tuple(w[i : i + window])
            first[at] = min(k, first.get(at, k))
    found = []
    for k, w in rows:
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < k:
                gone.update(range(i, i + window))
        kept = [x for i, x in enumerate(w) if i not in gone]
        found.append((k, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(found)


def ours_cut(docs, **options):
    rows = substrings.without_repeats(docs, **options).collect()
    return sorted((float("inf") if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows)


def test_cut_equals_brute_force(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert ours_cut(odd_docs, with_text=False) == brute_cut(rows)
    assert ours_cut(no_docs) == []


def test_cut_of_shared_passages_hot_words_and_copies(spark):
    """Passages in many documents, words that hold most of the text, copies."""
    rng = random.Random(3)
    passages = [prose(i * 31, 13 + i) for i in range(6)]
    rows = []
    for i in range(240):
        parts = [prose(1000 + i * 17, rng.randrange(0, 40))]
        if i % 3 == 0:
            parts.append(passages[0])
        if rng.random() < 0.4:
            parts.append(rng.choice(passages))
        parts.append(" ".join(rng.choice(["the", "of"]) for _ in range(rng.randrange(0, 30))))
        rng.shuffle(parts)
        rows.append((rng.randrange(-500, 500), " \n".join(parts)))
    rows += [(600 + i, rows[5][1]) for i in range(80)]
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in rows], DOCS).repartition(7)
    assert ours_cut(docs) == brute_cut(rows)
    assert ours_cut(docs, window=5) == brute_cut(rows, 5)


def test_kept_text_and_repeats(spark):
    shared = prose(5, 20)
    rows = [(1, shared + "\nend"), (2, "start  " + shared + " x\ty"), (3, "as  it\nis")]
    docs = spark.createDataFrame([(k, t, "en", f"s{k}", 0) for k, t in rows], DOCS)
    found = {r.doc_id: r for r in substrings.without_repeats(docs, carry=("source",)).collect()}
    assert found[1].kept == rows[0][1] and found[3].kept == rows[2][1] and found[1].repeats == []
    assert found[2].kept == "start x y" and found[2].repeats == [[1, 20]] and found[2].source == "s2"


def thue_morse(n, letters):
    """Two unlike words of 2**n letters, equal in any polynomial hash modulo a
    power of two."""
    word = [0]
    for _ in range(n):
        word += [1 - x for x in word]
    return "".join(letters[x] for x in word), "".join(letters[1 - x] for x in word)


def test_long_unlike_words_are_told_apart(spark):
    for n in (3, 7, 8, 12):
        a, b = thue_morse(n, "ab")
        start = prose(3, 12)
        rows = [(1, f"{start} {a} end"), (2, f"{start} {b} end"), (3, f"{start} {a} other")]
        docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in rows], DOCS)
        found = {r.doc_id: r.n_removed for r in substrings.without_repeats(docs, with_text=False).collect()}
        assert found == {1: 0, 2: 0, 3: 13}
        long = " ".join(f"{a}{i}" for i in range(8))
        other = long.replace(a, b)
        docs = spark.createDataFrame([(1, long, "en", "s", 0), (2, other, "en", "s", 0), (3, long, "en", "s", 0)], DOCS)
        assert {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect()} == {1: 1, 2: 2, 3: 1}


def test_chunks_follow_the_size_of_the_texts(spark, odd_docs, monkeypatch):
    rows = sorted(map(tuple, substrings.without_repeats(odd_docs, with_text=False).collect()), key=str)
    monkeypatch.setattr(substrings, "CHUNK_BYTES", 10_000)
    assert sorted(map(tuple, substrings.without_repeats(odd_docs, with_text=False).collect()), key=str) == rows


# --- components


def test_components(spark):
    rng = random.Random(4)
    links = [(0, i) for i in range(1, 200)]  # a star
    links += [(1000 + i, 1001 + i) for i in range(60)]  # a path
    links += [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(150)]
    links += [(5000, 5000), (7, 3)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    found = {r.node: r.root for r in graph.components(frame).collect()}
    assert found == {x: find(x) for x in root}
    assert graph.components(frame.where("a < 0")).count() == 0


# --- near duplicates


def changed(text, rng, n):
    words = text.split(" ")
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def brute_classes(rows):
    """Class of each row by comparing all pairs of texts."""
    sets, rep = {}, {}
    for k, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = tuple(WORDS.findall(t or ""))
        rep.setdefault(w, k)
        sets[rep[w]] = {w[i : i + 5] for i in range(max(1, len(w) - 4))} if w else set()
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(sets[a] & sets[b])
            if both and both >= 0.8 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {(k, t or ""): None if k is None else find(rep[tuple(WORDS.findall(t or ""))]) for k, t in rows}


def test_near_duplicates_equal_all_pairs(spark):
    """Groups of copies and near copies, one of them large, of which many are
    near the first only."""
    rng = random.Random(8)
    rows = [(i, prose(i * 13, 20 + i % 60)) for i in range(120)]
    for i in range(40):
        rows.append((500 + i, changed(rows[i][1], rng, 1 + i % 3)))
    base = prose(7777, 120)
    rows.append((900, base))
    rows += [(1000 + i, changed(base, rng, 2)) for i in range(90)]
    rows += [(2000 + i, base) for i in range(60)]
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in rows], DOCS).repartition(5)
    found = {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect()}
    expected = {k: c for (k, _), c in brute_classes(rows).items()}
    assert found == expected
    assert len([k for k, c in found.items() if c == 900]) == 151


def test_near_duplicates_of_texts_that_repeat_unequally(spark):
    """The same sets of runs, but lines and passages that stand in one text
    several times as often as in the other."""
    rows = []
    for i in range(24):
        words = prose(i * 41, 104).split(" ")
        text = " ".join(words)
        other = " ".join(words[:34] * 16 + words[34:]) if i % 3 == 0 else "\n".join([text] * (2 + i % 7))
        rows += [(i, text), (100 + i, other)]
        rows.append((200 + i, "\n".join([text] + [" ".join(words[:8])] * (3 * i))))
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in rows], DOCS).repartition(5)
    found = {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect()}
    assert found == {k: c for (k, _), c in brute_classes(rows).items()}
    assert all(found[100 + i] == i for i in range(24))


def test_near_duplicates_of_odd_documents(odd_docs, no_docs):
    rows = neardup.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, set()).add(r.class_id)
    assert by_id[1] == by_id[2] == {1} and by_id[3] == by_id[4] == by_id[5] == {3}
    assert by_id[None] == {None} and by_id[6] == {6} and by_id[-10] == {-10}
    assert neardup.near_duplicates(no_docs).count() == 0


def test_rows_of_one_key_are_compared_by_their_own_texts(spark):
    rng = random.Random(2)
    x, y, z = prose(11, 80), prose(500, 80), prose(900, 80)
    rows = [(1, x), (1, y), (2, changed(y, rng, 1)), (3, changed(x, rng, 1)), (3, z), (4, z), (5, prose(70, 30))]
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in rows], DOCS).repartition(4)
    found = sorted((r.doc_id, r.text_id, r.class_id, r.n_links > 0) for r in neardup.near_duplicates(docs).collect())
    assert found == sorted([(1, 1, 1, True), (1, 1, 1, True), (2, 2, 1, True), (3, 3, 1, True), (3, 3, 3, False), (4, 3, 3, False), (5, 5, 5, False)])


def test_bitmap_holds_all_its_keys_and_few_others(spark, monkeypatch):
    keys = spark.range(0, 60_000, 3)
    held = neardup.KeyBitmap(keys, "id").marked(spark.range(60_000), "id").where("_may")
    assert held.columns == ["id", "_may"]
    assert held.where("id % 3 = 0").count() == 20_000 and held.count() < 22_000
    none = neardup.KeyBitmap(keys.limit(0), "id").marked(spark.range(100), "id")
    assert none.where("_may").count() == 0 and none.count() == 100
    monkeypatch.setattr(neardup, "SLOTS", (64, 64))  # full, and right still
    assert neardup.KeyBitmap(keys, "id").marked(spark.range(60_000), "id").where("_may and id % 3 = 0").count() == 20_000


def test_darts_estimate_weighted_likeness():
    rng = np.random.default_rng(5)
    shared, own = rng.integers(1, 2**63, 800, dtype=np.uint64), rng.integers(1, 2**63, 200, dtype=np.uint64)
    weighted = np.repeat(shared[:400], 4)  # a weight of three each
    runs = [np.concatenate([weighted, shared[400:]]), np.concatenate([weighted, own])]
    ranks = neardup.darts(*neardup.regions(runs), 2, 4096)
    expected = 3 * 400 / (3 * 400 + 400 + 200)
    assert abs((ranks[0] == ranks[1]).mean() - expected) < 0.03
    assert np.isfinite(ranks).all()
    tiny = neardup.darts(*neardup.regions([own[:1], own[:1], own[1:2], own[:0]]), 4, 150)
    assert (tiny[0] == tiny[1]).all() and not (tiny[0] == tiny[2]).any() and np.isinf(tiny[3]).all()


# --- fingerprints


def test_ring(spark, odd_docs, no_docs):
    rows = sorted((r for r in odd_docs.collect()), key=lambda r: (r.doc_id is None, -(r.doc_id or 0), r.text or ""))
    expected, named = [], [r for r in rows if r.doc_id is not None]
    for i, r in enumerate(named):
        after = named[(i + 1) % len(named)].text or ""
        expected.append((r.doc_id, r.text or "", after))
    expected += [(None, r.text or "", "") for r in rows if r.doc_id is None]
    wanted = []
    for key, text, after in expected:
        cut = len(text) // 3
        new = text[: len(text) - cut] + after[:cut]
        a, b, c = (spots.spots(x) for x in (text, new, after))
        wanted.append(
            (key, len(text), hashlib.sha256(new.encode()).hexdigest(), spots.fingerprint(a), spots.fingerprint(b), spots.likeness(a, b), spots.likeness(a, c))
        )
    found = spots.ring(odd_docs).collect()
    assert sorted(map(tuple, found), key=str) == sorted(wanted, key=str)
    assert all(0 <= x <= 1 for r in found for x in (r.near_edited, r.near_next))
    assert spots.ring(no_docs).count() == 0
    one = spots.ring(odd_docs.where("doc_id = 1")).first()
    assert one.near_next == 1.0


def test_likeness_and_equal_texts():
    a, b = spots.spots("the quick fox and the lazy dog"), spots.spots("The QUICK fox, and the lazy dog!")
    assert (a == b).all() and spots.likeness(a, b) == 1
    assert (spots.from_fingerprint(spots.fingerprint(a)) == a).all()
    assert spots.likeness(spots.spots(""), spots.spots("")) == 1 and spots.likeness(a, spots.spots("")) == 0
    assert spots.likeness(a[:1], a, least=0.9) == 0 and len(spots.spots("!!")) == 1
    assert len(spots.spots("the of and")) > 0


def test_alike_equals_all_pairs(spark, odd_docs):
    rng = random.Random(6)
    rows = [(i, " the ".join(prose(i * 13 % 200, 40).split(" "))) for i in range(60)]
    rows += [(100 + i, changed(rows[i][1], rng, 1 + i % 4)) for i in range(60)]
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in rows], DOCS).unionByName(odd_docs.select(*DOCS_COLUMNS))
    members, pairs = spots.alike(docs)
    sets = {}
    for r in docs.where("doc_id is not null").collect():
        own = spots.spots(r.text or "").tobytes()
        sets[own] = min(r.doc_id, sets.get(own, r.doc_id))
    own = [(k, np.frombuffer(s, np.uint32)) for s, k in sets.items()]
    expected = {
        (min(a, b), max(a, b)): spots.likeness(x, y)
        for i, (a, x) in enumerate(own)
        for b, y in own[:i]
        if len(x) and len(y) and spots.likeness(x, y) >= 0.8
    }
    assert {(r.a, r.b): r.likeness for r in pairs.collect()} == pytest.approx(expected) and expected
    assert {r.doc_id: r["first"] for r in members.collect()} == {
        r.doc_id: sets[spots.spots(r.text or "").tobytes()] for r in docs.where(F.col("doc_id").isNotNull()).collect()
    }


DOCS_COLUMNS = [c.split()[0] for c in DOCS.split(", ")]
