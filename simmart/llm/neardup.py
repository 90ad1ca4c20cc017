"""Near duplicates by DartMinHash signatures and banded joining.

A document is the set of its runs of five words (of all its words, if fewer).
Links are decided on the plain sets, so each document is signed as a plain set,
each run with a weight of one; where runs repeat also with the weights
1 + floor(log2(times it occurs)). The weight axis of a run is cut into unit
regions. Each region gets a stream of darts from its hash: their
ranks are the arrivals of a Poisson process, and each is thrown at one of the
signature's coordinates. Darts up to a rank that reaches all coordinates are
thrown for a document, so that a large document throws about as many as a small
one, and each coordinate keeps the earliest (Christiani, "DartMinHash: Fast
Sketching for Weighted Sets", 2020). Two documents agree in a coordinate with
the probability of their weighted Jaccard likeness.

Equal texts (word by word) are one class from the start. Texts that agree in all
rows of a band are in one bucket. Each bucket's texts are compared with two
pivots, which differ from band to band; links are pairs with a Jaccard likeness
of the sets of 0.8 or more, counted on the sets themselves. Then the components
of the links are taken, and where a bucket's texts lie in several components,
those outside the bucket's largest are compared with all texts of the others.
So every two texts of a bucket are compared or known to belong together, no
matter how large the bucket, and pairs are not enumerated within components. In
buckets of over SMALL texts that last comparison runs in blocks, as products of
matrices, and lists no pairs but the links.

A pair of likeness 0.8 shares a bucket with a probability of 0.99999 (30 bands
of 5 rows; 0.9997 at 0.75), by the signatures of the plain sets alone and so
however often runs repeat in either text.

Texts without words, null texts among them, are equal texts. It is texts that are
compared, told by a digest of their words: of rows of one key with several texts
each gets the class of its own text. (The smallest key of a class names it; unlike
texts of one key may both have that name.) Rows with a null key are kept, without
a class. Keys are integers; only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from simmart.llm.common import Scratch, blob, kept, per_batch, per_group, prepared, stored, texts
from simmart.llm.graph import components
from simmart.llm.words import Hasher, distinct, mix, utf8
from simmart.operators.skew import splittable_join

RUN = 5
LIKENESS = 0.8
BANDS, ROWS = 30, 5
SLOTS = 1 << 22, 1 << 26  # bits of a bitmap of keys, at least and at most
SLOTS_A_KEY = 16
SMALL = 64  # texts of a bucket of which pairs are listed; larger ones are compared in blocks
BLOCK, COLUMNS = 512, 4096  # texts of a block; runs compared at a time
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def regions(runs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Unit regions of the weighted elements: document and hash of each."""
    document = np.repeat(np.arange(len(runs)), [len(r) for r in runs])
    element = np.concatenate(runs) if runs else np.zeros(0, np.uint64)
    order = np.lexsort([element, document])
    document, element = document[order], element[order]
    new = np.ones(len(element), bool)
    new[1:] = (element[1:] != element[:-1]) | (document[1:] != document[:-1])
    starts = np.flatnonzero(new)
    weight = 1 + np.floor(np.log2(np.diff(starts, append=len(element)))).astype(np.int64)
    step = np.arange(weight.sum()) - np.repeat(np.cumsum(weight) - weight, weight)
    element = np.repeat(element[starts], weight)
    return np.repeat(document[starts], weight), mix(element + step.astype(np.uint64) * _GOLDEN)


def darts(document: np.ndarray, region: np.ndarray, documents: int, coordinates: int) -> np.ndarray:
    """The earliest rank for each document and coordinate; documents without
    regions keep infinite ranks."""
    ranks = np.full(documents * coordinates, np.inf)
    weight = np.bincount(document, minlength=documents)
    reach = (np.log(coordinates) + 4) * coordinates / np.maximum(weight, 1)
    while len(document):
        at, hashes, rank, number = document, region, np.zeros(len(document)), 0
        while len(at):
            number += 1
            dart = mix(hashes + np.uint64(number * int(_GOLDEN) % 2**64))
            # 53 bits make a number over 0 and up to 1.
            rank = rank - np.log(((dart >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53)
            near = rank <= reach[at]
            at, hashes, rank, dart = at[near], hashes[near], rank[near], dart[near]
            target = (mix(dart ^ _GOLDEN) % np.uint64(coordinates)).astype(np.int64)
            np.minimum.at(ranks, at * coordinates + target, rank)
        # Coordinates that no dart has reached: those documents throw farther.
        short = np.isinf(ranks.reshape(documents, coordinates)).any(axis=1)
        again = short[document]
        document, region, reach = document[again], region[again], reach * 2
    return ranks.reshape(documents, coordinates)


def band_hashes(ranks: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = ranks.view(np.uint64).reshape(len(ranks), bands, rows)
    found = np.broadcast_to(mix(np.arange(bands, dtype=np.uint64) + np.uint64(1)), parts.shape[:2])
    for i in range(rows):
        found = mix(found ^ (parts[:, :, i] * _GOLDEN))
    return found


def _signed(docs: DataFrame, key: str, text: str, bands: int, rows: int, run: int) -> DataFrame:
    """(key, digest, bands) of each document."""

    def sign(batch: pa.RecordBatch) -> pa.RecordBatch:
        hasher = kept(("hasher",), Hasher)
        words = [hasher.words(utf8(t))[0] for t in texts(batch.column(1))]
        digests = [xxhash.xxh3_128_digest(w.tobytes()) for w in words]
        runs = [hasher.runs(w, min(run, max(1, len(w)))) for w in words]
        # Where no run repeats, the weighted set is the plain one.
        plain = [distinct(r) for r in runs]
        again = [i for i, r in enumerate(runs) if len(plain[i]) < len(r)]
        ranks = darts(*regions(plain + [runs[i] for i in again]), len(runs) + len(again), bands * rows)
        hashes = band_hashes(ranks, bands, rows).view(np.int64)
        found = [hashes[i] if len(r) else hashes[i, :0] for i, r in enumerate(runs)]
        for i, own in zip(again, hashes[len(runs) :]):
            found[i] = np.unique(np.concatenate([found[i], own]))
        offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
        lists = pa.ListArray.from_arrays(offsets, np.concatenate(found))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(digests, pa.binary()), lists], ["key", "digest", "bands"]
        )

    columns = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    return per_batch(columns, sign, "key bigint, digest binary, bands array<bigint>")


class KeyBitmap:
    """A bitmap over hashes of keys, SLOTS_A_KEY bits for each up to its
    greatest size, in rows of 64 bits that a broadcast join looks up: which rows
    are surely none of them, so that only the others need be shuffled. More
    keys than fit fill it, which costs time and no result."""

    def __init__(self, keys: DataFrame, column: str) -> None:
        self.slots = min(SLOTS[1], max(SLOTS[0], 1 << (keys.count() * SLOTS_A_KEY).bit_length()))
        slot = keys.select(self._slot(column).alias("slot"))
        self.words = slot.groupBy(F.expr("slot DIV 64").alias("_word")).agg(
            F.expr("bit_or(shiftleft(1L, CAST(slot % 64 AS INT)))").alias("_bits")
        )

    def _slot(self, column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(self.slots))

    def marked(self, rows: DataFrame, column: str) -> DataFrame:
        """The rows with `_may`: whether the key may be one of them. There are
        SLOTS[1] / 64 words at most, a million."""
        rows = rows.withColumn("_slot", self._slot(column)).withColumn("_word", F.expr("_slot DIV 64"))
        found = rows.join(F.broadcast(self.words), "_word", "left")
        own = F.expr("shiftright(_bits, CAST(_slot % 64 AS INT)) & 1L")
        return found.withColumn("_may", F.coalesce(own == 1, F.lit(False))).drop("_word", "_slot", "_bits")


def _sets(docs: DataFrame, needed: DataFrame, key: str, text: str, run: int) -> DataFrame:
    """(id, runs): the sorted distinct runs of the needed texts (digest, id,
    first). So that texts are not shuffled, rows whose key is not the first of
    any are left out where they are read."""
    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text")).where("key is not null")
    rows = KeyBitmap(needed, "first").marked(rows, "key").where("_may")

    def sets(batch: pa.RecordBatch) -> pa.RecordBatch:
        hasher = kept(("hasher",), Hasher)
        words = [hasher.words(utf8(t))[0] for t in texts(batch.column(0))]
        digests = [xxhash.xxh3_128_digest(w.tobytes()) for w in words]
        found = [blob(distinct(hasher.runs(w, min(run, max(1, len(w)))))) for w in words]
        return pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(found, pa.binary())], ["digest", "runs"])

    found = per_batch(rows.select("text"), sets, "digest binary, runs binary")
    # One set for each text, for repeated rows too.
    once = found.groupBy("digest").agg(F.any_value("runs").alias("runs"))
    return once.join(needed.select("digest", "id").hint("merge"), "digest").select("id", "runs")


def _near(a: np.ndarray, b: np.ndarray, likeness: float) -> bool:
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if len(small) < likeness * len(large):
        return False
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    shared = int(np.count_nonzero(large[at] == small))
    return shared >= likeness * (len(small) + len(large) - shared)


def _linked(pairs: DataFrame, sets: DataFrame, likeness: float) -> DataFrame:
    """The pairs (a, b) of which the sets of runs are alike enough."""

    def compare(batch: pa.RecordBatch) -> pa.RecordBatch:
        left, right = (batch.column(i).to_pylist() for i in (2, 3))
        near = [_near(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), likeness) for x, y in zip(left, right)]
        return batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    # Neither side has a bounded size: never broadcast.
    left, right = (sets.withColumnsRenamed({"id": c, "runs": f"runs_{c}"}).hint("merge") for c in "ab")
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "runs_a", "runs_b")
    return per_batch(joined, compare, "a bigint, b bigint")


def _linked_in_blocks(mixed: DataFrame, sets: DataFrame, likeness: float) -> DataFrame:
    """Links of large buckets between texts outside the largest component and
    all others. The bucket's texts are dealt into blocks; each block of those
    outside meets each block of all in one task, as matrices of runs, so that
    only links come out."""
    parts = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    rows = mixed.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    every = rows.select("band", "id", "root", F.lit(False).alias("outside"), other.alias("i"), F.col("part").alias("j"))
    outside = rows.where("root <> main")
    outside = outside.select("band", "id", "root", F.lit(True).alias("outside"), F.col("part").alias("i"), other.alias("j"))
    met = every.unionByName(outside).join(sets.hint("merge"), "id")

    def compare(table: pa.Table) -> pa.Table:
        sets_ = [np.frombuffer(b, np.uint64) for b in table.column("runs").to_pylist()]
        out = table.column("outside").to_numpy(zero_copy_only=False).astype(bool)
        ids, roots = (table.column(c).to_numpy() for c in ("id", "root"))
        size = np.array([len(x) for x in sets_], np.int64)
        row = np.repeat(np.arange(len(sets_)), size)
        token, column, count = np.unique(np.concatenate(sets_), return_inverse=True, return_counts=True)
        # Runs of one text only are in no overlap.
        place = np.where(count > 1, np.cumsum(count > 1) - 1, -1)[column]
        row, place = row[place >= 0], place[place >= 0]
        line = np.full(len(sets_), -1)
        line[out], line[~out] = np.arange(out.sum()), np.arange((~out).sum())
        shared = np.zeros((int(out.sum()), int((~out).sum())), np.float32)
        for start in range(0, int(place.max(initial=-1)) + 1, COLUMNS):
            own = (place >= start) & (place < start + COLUMNS)
            both = [np.zeros((n, COLUMNS), np.float32) for n in shared.shape]
            for half, side in zip(both, (out, ~out)):
                at = own & side[row]
                half[line[row[at]], place[at] - start] = 1
            shared += both[0] @ both[1].T
        near = shared >= likeness * (size[out][:, None] + size[~out][None] - shared)
        x, y = np.nonzero(near & (roots[out][:, None] != roots[~out][None]))
        x, y = ids[out][x], ids[~out][y]
        return pa.table({"a": pa.array(np.minimum(x, y)), "b": pa.array(np.maximum(x, y))})

    return per_group(met.groupBy("band", "i", "j"), compare, "a bigint, b bigint").distinct()


def _pairs(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    likeness: float = LIKENESS,
    run: int = RUN,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One row per document: the key, text_id (the smallest key of an equal
    text), class_id (the smallest key of its group of near duplicates), and
    n_links (near texts that its text was linked with)."""
    scratch = Scratch(prepared(docs.sparkSession), "near-duplicates")
    signed = scratch.stored(_signed(docs, key, text, bands, rows, run), "signatures")
    once = signed.where("key is not null").groupBy("digest")
    once = once.agg(F.min("key").alias("first"), F.any_value("bands").alias("bands"))
    once = scratch.stored(once.withColumn("id", F.monotonically_increasing_id()), "distinct")

    members = once.select("id", F.explode("bands").alias("band"))
    flipped = F.col("id").bitwiseXOR(F.col("band"))  # an order of its own in each band
    buckets = members.groupBy("band").agg(F.min(flipped).alias("low"), F.max(flipped).alias("high"))
    buckets = scratch.stored(buckets.where("low <> high"), "buckets")
    members = scratch.stored(splittable_join(members, buckets, ["band"]), "members")
    pivot = F.explode(F.array("low", "high")).alias("pivot")
    compared = members.select("id", "band", pivot).select("id", F.col("pivot").bitwiseXOR(F.col("band")).alias("pivot"))
    compared = scratch.stored(compared.where("id <> pivot").select(*_pairs("id", "pivot")).distinct(), "pairs")
    needed = once.select("digest", "id", "first").join(members.select("id").distinct(), "id")
    needed = scratch.stored(needed, "needed")
    sets = scratch.stored(_sets(docs, needed, key, text, run), "sets")
    links = scratch.stored(_linked(compared, sets, likeness), "linked")
    classes = components(links)

    mixed = scratch.stored(_mixed(members.select("id", "band"), classes), "mixed")
    rest = _across(mixed.where(F.col("n") <= SMALL)).join(compared, ["a", "b"], "left_anti")
    large = _linked_in_blocks(mixed.where(F.col("n") > SMALL), sets, likeness)
    more = scratch.stored(_linked(rest, sets, likeness).unionByName(large), "linked")
    if not more.isEmpty():
        links = scratch.stored(links.unionByName(more).distinct(), "linked")
        classes = components(links)

    degree = links.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("n_links"))
    known = once.select("digest", "id", "first").join(degree, "id", "left")
    known = known.join(classes.select(F.col("node").alias("id"), "root"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    known = scratch.stored(known, "known")
    firsts = known.groupBy("root").agg(F.min("first").alias("class"), F.count("*").alias("n")).where("n > 1").drop("n")
    known = splittable_join(known, firsts, ["root"], "left")
    rows_ = stored(splittable_join(signed.select("key", "digest"), known, ["digest"], "left").drop("digest"), "classes")
    scratch.clear()
    named = F.col("key").isNotNull()
    return rows_.select(
        F.col("key").alias(key),
        F.when(named, F.col("first")).alias("text_id"),
        F.when(named, F.coalesce("class", "first")).alias("class_id"),
        F.when(named, F.coalesce("n_links", F.lit(0))).cast("bigint").alias("n_links"),
    )


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", ties: tuple[str, ...] = (), **more) -> DataFrame:
    """The rows that stay when of each group of near duplicates all but one go:
    the row of the smallest key, of several such that of the smallest text hash
    and then of the smallest further columns. Rows go by their own text, also
    where keys repeat; those with a null key are in no group and stay. Rows are
    numbered, and stored so, as numbers may change when they are given again."""
    scratch = Scratch(prepared(docs.sparkSession), "one-of-each")
    rows = stored(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    named = rows.where(F.col(key).isNotNull())
    found = scratch.stored(near_duplicates(named, "_row", text, **more).select("_row", "class_id"), "classes")
    several = found.groupBy("class_id").agg(F.count("*").alias("n")).where("n > 1").select("class_id")
    found = splittable_join(found, several, ["class_id"])
    order = F.struct(F.col(key).alias("key"), F.xxhash64(text).alias("hash"), *ties, "_row").alias("order")
    found = scratch.stored(named.select("_row", order).join(found.hint("merge"), "_row"), "grouped")
    firsts = found.groupBy("class_id").agg(F.min("order").alias("first")).select(F.col("first._row").alias("_row"))
    gone = scratch.stored(found.select("_row").join(firsts.hint("merge"), "_row", "left_anti"), "gone")
    # Rows that surely stay are not shuffled.
    rows = KeyBitmap(gone, "_row").marked(rows, "_row")
    left = rows.where("_may").join(gone.hint("merge"), "_row", "left_anti")
    return rows.where("not _may").unionByName(left.select(*rows.columns)).drop("_row", "_may")


def _mixed(members: DataFrame, classes: DataFrame) -> DataFrame:
    """(band, id, root, main, n) of buckets with texts of several components:
    the component of each text, the bucket's largest, and its texts."""
    placed = members.join(classes.select(F.col("node").alias("id"), "root"), "id", "left")
    placed = placed.withColumn("root", F.coalesce("root", "id"))
    sizes = placed.groupBy("band", "root").agg(F.count("*").alias("n"))
    main = sizes.groupBy("band").agg(
        F.max(F.struct("n", "root")).alias("largest"), F.count("*").alias("components"), F.sum("n").alias("n")
    )
    main = main.where("components > 1").select("band", F.col("largest.root").alias("main"), "n")
    return splittable_join(placed, main, ["band"])


def _across(mixed: DataFrame) -> DataFrame:
    """Pairs (a, b) of a small bucket's texts that lie in different components,
    one of them outside the bucket's largest."""
    outside = mixed.where("root <> main").select("band", F.col("id").alias("x"), F.col("root").alias("x_root"))
    pairs = mixed.select("band", "id", "root").join(outside, "band").where("root <> x_root")
    return pairs.select(*_pairs("id", "x")).distinct()
