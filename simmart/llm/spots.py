"""Document fingerprints by SpotSigs.

A spot is a common word (an anchor) with the next two content words, common
words skipped (Theobald, Siddharth & Paepcke, "SpotSigs", 2008). A fingerprint
is the set of a text's spots as sorted 32-bit hashes in base 64. In stretches
without common words every eighth content word is an anchor too. A text of no
word has one spot, the hash of the whole text; the empty text has none. Words
are runs of letters, digits and bytes over 127 in the lower-cased text.

Likeness is the Jaccard coefficient of two sets. Two empty sets are alike (1).

Null text is empty. In a ring of documents by descending key, equal keys follow
in order of their texts; rows with a null key stand alone: the text after them
is empty. Keys are integers; only the named columns are read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from simmart.llm.common import kept, partitions, per_batch, prepared, stored, texts
from simmart.llm.words import Hasher, mix, utf8, word_bytes
from simmart.operators.skew import splittable_join

CHAIN = 2
STRETCH = 8
LIKENESS = 0.8

# Frequent words of English, French, German and Spanish.
COMMON = """
a about after all also an and any are as at be because been but by can could did do for from had has have he her him
his how i if in into is it its just like may me more most my no not of on one only or other our out over she should so
some such than that the their them then there these they this those to two up was we were what when which who will
with would you your
au aux avec ce ces cette comme dans de des donc du elle en est et être il ils je la le les leur lui mais même ne nous
on ont ou où par pas plus pour qu que qui sa sans se ses son sont sur un une vous
aber als am auch auf aus bei bin bis das dass dem den der die durch ein eine einem einen einer er es für habe hat ich
im ihr ist mit nach nicht noch nur oder sein sich sie sind so über um und uns unter vom von vor war wie wir zu zum zur
al como con del el ella ellos era esta este ha hay las lo los más mi muy para pero por porque quien se ser si sin
sobre su sus también todo un una y ya
""".split()

_INSIDE = word_bytes(bytes(b for b in range(128) if not chr(b).isalnum()))


def _common_hashes() -> np.ndarray:
    hasher = kept(("hasher",), Hasher)
    return np.unique([hasher.words(utf8(w), _INSIDE)[0][0] for w in COMMON])


def spots(text: str) -> np.ndarray:
    """Sorted distinct 32-bit hashes of the spots of a text."""
    if not text:
        return np.zeros(0, np.uint32)
    words = kept(("hasher",), Hasher).words(utf8(text.lower()), _INSIDE)[0]
    if not len(words):
        return np.array([xxhash.xxh32_intdigest(text.encode("utf-8", "surrogatepass"))], np.uint32)
    common = kept(("common words",), _common_hashes)
    place = np.minimum(np.searchsorted(common, words), len(common) - 1)
    is_common = common[place] == words
    content = np.flatnonzero(~is_common)
    if not len(content):
        return np.unique(mix(words)).astype(np.uint32)
    # Content words since the last common word, from 0.
    at = np.arange(len(words))
    since = at - np.maximum.accumulate(np.where(is_common, at, -1)) - 1
    anchors = np.flatnonzero(is_common | (since % STRETCH == STRETCH - 1))
    if not len(anchors):
        anchors = content[:1]
    chain = np.concatenate([words[content], np.zeros(CHAIN, np.uint64)])
    first = np.searchsorted(content, anchors, side="right")
    found = words[anchors]
    for i in range(CHAIN):
        found = mix(found * np.uint64(0x9E3779B97F4A7C15) ^ chain[first + i])
    return np.unique((found >> np.uint64(32)).astype(np.uint32))


def fingerprint(found: np.ndarray) -> str:
    return base64.b64encode(found.tobytes()).decode()


def from_fingerprint(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), np.uint32)


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard coefficient of two sorted sets; 0 without counting if the sizes
    alone keep it below least."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(large):
        return 1.0
    if not len(small) or len(small) < least * len(large):
        return 0.0
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    shared = int(np.count_nonzero(large[at] == small))
    return shared / (len(small) + len(large) - shared)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint, n_spots) of each document."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [spots(t) for t in texts(batch.column(1))]
        columns = [batch.column(0), pa.array([fingerprint(f) for f in found]), pa.array([len(f) for f in found], pa.int32())]
        return pa.RecordBatch.from_arrays(columns, ["key", "fingerprint", "n_spots"])

    kind = dict(docs.dtypes)[key]
    found = per_batch(docs.select(key, text), run, f"key {kind}, fingerprint string, n_spots int")
    return found.withColumnRenamed("key", key)


def edited(text: str, after: str) -> str:
    """The text with its last third replaced by the beginning of another."""
    cut = len(text) // 3
    return text[: len(text) - cut] + after[:cut]


def ring(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document beside an edited version of itself and beside the next
    one by descending key (after the last: the first).

    Columns: the key, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next. Texts are dealt out by ranges of the key, with one
    shuffle; the first document of each range goes to the range before it too.
    """
    spark = prepared(docs.sparkSession)
    n = partitions(spark)
    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.coalesce(text, F.lit("")).alias("text"))
    steps = F.array(*(F.lit((i + 1) / n) for i in range(n)))
    bounds = rows.agg(F.percentile_approx("key", steps, F.lit(max(10_000, 10 * n))), F.max("key")).first()
    heads = sorted({*(bounds[0] or []), *([bounds[1]] if bounds[1] is not None else [])})
    many = max(1, len(heads))
    # Ranges end with a key that exists: the first document in descending order.
    ends = F.array(*(F.lit(h) for h in heads)).cast("array<bigint>")
    number = F.size(F.filter(ends, lambda h: h < F.col("key")))
    alone = F.col("key").isNull()
    head = F.array_contains(ends, F.col("key"))
    places = F.when(alone, F.array(F.struct(F.pmod(F.xxhash64("text"), F.lit(many)).cast("int").alias("part"), F.lit(0).alias("role"))))
    own = F.struct(number.alias("part"), F.lit(1).alias("role"))
    other = F.struct(((number + 1) % many).alias("part"), F.lit(2).alias("role"))
    places = places.when(head, F.array(own, other)).otherwise(F.array(own))
    dealt = rows.select("key", "text", F.explode(places).alias("place")).select("place.part", "place.role", "key", "text")
    dealt = dealt.repartitionById(many, F.col("part")).sortWithinPartitions("part", "role", F.desc_nulls_last("key"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None  # (part, key, text, spots) of the document before

        def row(before, after_text: str, after_spots: np.ndarray) -> tuple:
            _, k, t, own_spots = before
            new = edited(t, after_text)
            new_spots = spots(new)
            return (
                k,
                len(t),
                hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(),
                fingerprint(own_spots),
                fingerprint(new_spots),
                likeness(own_spots, new_spots),
                likeness(own_spots, after_spots),
            )

        for batch in batches:
            done = []
            for part, role, k, t in zip(*(c.to_pylist() for c in batch.columns)):
                if role == 2 and (waiting is None or waiting[0] != part):
                    continue  # only the first of several heads of one key counts
                here = (part, k, t, spots(t))
                if role == 0:
                    done.append(row(here, "", np.zeros(0, np.uint32)))
                    continue
                if waiting is not None and waiting[0] == part:
                    done.append(row(waiting, t, here[3]))
                waiting = here if role == 1 else None
            columns = list(zip(*done)) if done else [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    arrow = pa.schema(
        [
            ("key", pa.int64()),
            ("n_chars", pa.int64()),
            ("edited_sha256", pa.string()),
            ("fingerprint", pa.string()),
            ("edited_fingerprint", pa.string()),
            ("near_edited", pa.float64()),
            ("near_next", pa.float64()),
        ]
    )
    schema = (
        "key bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return dealt.mapInArrow(run, schema).withColumnRenamed("key", key)


def alike(docs: DataFrame, key: str = "doc_id", text: str = "text", least: float = LIKENESS) -> tuple[DataFrame, DataFrame]:
    """Members (key, first) of classes of equal fingerprints, named by their
    smallest key, and pairs (a, b, likeness) of classes alike enough.

    Classes are partitioned by the length of their sets, into bands of which
    each reaches from the one before by the factor `least`: sets farther apart
    than neighbouring bands cannot be alike. Within a band classes meet by the
    rarest spots of a set, as many as a pair must share one of, and are compared
    pruned by their sizes. Classes of empty sets are in no pair; null keys are
    no members.
    """
    found = stored(fingerprints(docs, key, text).where(F.col(key).isNotNull()), "spots")
    members = found.groupBy("fingerprint").agg(F.min(key).alias("first"), F.first("n_spots").alias("n"))
    members = stored(members, "spot-classes")

    def opened(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = [from_fingerprint(f) for f in batch.column(1).to_pylist()]
        sizes = [len(o) for o in own]
        flat = np.concatenate(own).astype(np.int64) if own else np.zeros(0, np.int64)
        first = np.repeat(batch.column(0).to_numpy(), sizes)
        return pa.RecordBatch.from_arrays([pa.array(first), pa.array(np.repeat(sizes, sizes)), pa.array(flat)], ["first", "n", "spot"])

    spread = per_batch(members.select("first", "fingerprint"), opened, "first bigint, n bigint, spot bigint")
    spread = stored(spread, "spread")
    often = spread.groupBy("spot").agg(F.count("*").alias("often"))
    ranked = splittable_join(spread, often, ["spot"]).groupBy("first", "n")
    # A pair alike enough shares one of so many rarest spots of each.
    prefix = F.col("n") - F.ceil(F.col("n") * least) + 1
    rare = ranked.agg(F.array_sort(F.collect_list(F.struct("often", "spot"))).alias("all"))
    rare = rare.select("first", "n", F.explode(F.slice("all", F.lit(1), prefix.cast("int"))["spot"]).alias("spot"))
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(float(-np.log(least))))
    rare = stored(rare.withColumn("band", band), "rare")
    left = rare.select("spot", "band", F.col("first").alias("a"), F.col("n").alias("n_a"))
    right = rare.select("spot", F.explode(F.array(F.col("band") - 1, "band", F.col("band") + 1)).alias("band"), F.col("first").alias("b"), F.col("n").alias("n_b"))
    sized = (F.col("n_a") >= F.col("n_b") * least) & (F.col("n_b") >= F.col("n_a") * least)
    met = left.join(right, ["spot", "band"]).where("a < b").where(sized).select("a", "b").distinct()

    def compare(batch: pa.RecordBatch) -> pa.RecordBatch:
        value = [
            likeness(from_fingerprint(x), from_fingerprint(y), least)
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
        ]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(value)], ["a", "b", "likeness"])

    prints = members.select("first", "fingerprint")
    met = met.join(prints.withColumnsRenamed({"first": "a", "fingerprint": "x"}), "a")
    met = met.join(prints.withColumnsRenamed({"first": "b", "fingerprint": "y"}), "b").select("a", "b", "x", "y")
    pairs = per_batch(met, compare, "a bigint, b bigint, likeness double").where(F.col("likeness") >= least)
    named = splittable_join(found, members.select("fingerprint", "first"), ["fingerprint"]).select(key, "first")
    return named, pairs
