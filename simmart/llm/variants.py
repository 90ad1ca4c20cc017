"""Spelling variants: words one edit apart, found by Bloom-guided neighbourhoods.

The vocabulary is counted, stored and indexed by blocked Bloom filters, one shard
or more for each word length, of 256-bit blocks with one bit in each of eight
lanes (Putze, Sanders & Singler, 2007). From each word, edits are generated and
probed: all deletions, and all replacements by a greater letter of those that the
vocabulary has. A pair of words one insertion or deletion apart is found from the
longer word, one of a replacement from the word of the smaller letter, so that no
insertions are generated. Only edits that a filter knows are shuffled, as 64-bit
hashes with the word's number, and joined with the vocabulary by hash; pairs so
found are compared letter by letter, so that neither filters nor hashes decide.

Filters are broadcast ROUND_BYTES at a time: lengths are put into rounds, and a
length whose filter is larger is divided by hash. A round probes only words whose
edits have its lengths. At most 90 letters occur, so that a word of l letters has
less than 100 * l edits and as many partners: no key of a join is hot.

Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, of which A-Z are
lower-cased. With h the CRC-32 of "id:run", where `divisor` divides h the
letter h % length is taken out; a null id is the empty text there. Null and empty
texts have no words. Repeated rows count as often as they come. Only the named
columns are read. Runs of any length are held as they are; edits are probed
PROBES at a time.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from simmart.llm.common import per_batch, prepared, stored, texts
from simmart.llm.words import mix
from simmart.operators.skew import splittable_join

LEAST_LETTERS, LEAST_COUNT, DIVISOR, FORM_FACTOR = 7, 2, 31, 10
WORDS_HELD = 200_000  # distinct words a task counts before it sends them on
LANES, LANE_BITS = 8, 32
BITS_PER_WORD = 16
BLOCK_BYTES = LANES * LANE_BITS // 8
ROUND_BYTES = 32 << 20
PROBES = 1 << 21
PROBED_WORDS = 50_000  # of a task
# Odd numbers that choose a lane's bit, from a rule.
_SALTS = (mix(np.arange(101, 101 + LANES, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def occurrences(key: str, text: str, least: int = LEAST_LETTERS, divisor: int = DIVISOR) -> Counter:
    """Words of a text, of at least that many letters, with their counts.
    Letters are Latin-1, a byte each, of which lower() changes A to Z only."""
    start = zlib.crc32(f"{key}:".encode())
    found: Counter = Counter()
    runs = Counter()
    for run, n in Counter(re.findall(r"[A-Za-zÀ-ÿ]{%d,}" % least, text)).items():
        runs[run.encode("latin-1").lower()] += n
    for run, n in runs.items():
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if h % divisor == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < least:
                continue
        found[run] += n
    return found


def counted(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of all words of at least LEAST_LETTERS letters."""

    def sent(counts: Counter) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in counts], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for k, t in zip(texts(batch.column(0)), texts(batch.column(1))):
                counts.update(occurrences(k, t))
                if len(counts) > WORDS_HELD:
                    yield sent(counts)
                    counts = Counter()
        if counts:
            yield sent(counts)

    rows = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


# --- hashes of words and of their edits


def _letter_hash(place: np.ndarray, letter: np.ndarray) -> np.ndarray:
    return mix((place.astype(np.uint64) << np.uint64(8)) | letter.astype(np.uint64))


def _xor(values: np.ndarray) -> np.ndarray:
    """Of each row, the exclusive or of the values before each place and all."""
    out = np.zeros((len(values), values.shape[1] + 1), np.uint64)
    np.bitwise_xor.accumulate(values, axis=1, out=out[:, 1:])
    return out


def hashes(letters: np.ndarray) -> np.ndarray:
    """Of rows of letters, words of one length: the exclusive or of a hash of
    every letter and its place, so that edits change few of its parts."""
    places = np.arange(letters.shape[1])[None]
    return np.bitwise_xor.reduce(_letter_hash(places, letters), axis=1, initial=0)


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in the list and rows of letters of the words of each length."""
    raw = [w.encode("latin-1") for w in words]
    sizes = np.array([len(r) for r in raw], np.int64)
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield at, np.frombuffer(b"".join(raw[i] for i in at), np.uint8).reshape(len(at), size)


def deletions(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each distinct word that a deletion makes: of equal
    letters in a row, the first is deleted."""
    n = letters.shape[1]
    places = np.arange(n)[None]
    before = _xor(_letter_hash(places, letters))[:, :n]
    moved = _xor(_letter_hash(places - 1, letters)[:, 1:] if n > 1 else np.zeros((len(letters), 0), np.uint64))
    after = moved[:, -1:] ^ moved
    distinct = np.ones(letters.shape, bool)
    distinct[:, 1:] = letters[:, 1:] != letters[:, :-1]
    row, at = np.nonzero(distinct)
    return row, (before ^ after)[row, at]


def replacements(letters: np.ndarray, alphabet: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each word that a greater letter at one of the places makes."""
    whole = hashes(letters)[:, None]
    own = letters[:, places]
    without = whole ^ _letter_hash(places[None], own)
    put = _letter_hash(places[None, :], alphabet[:, None])  # letter x place
    row, at, letter = np.nonzero(own[:, :, None] < alphabet[None, None, :])
    return row, without[row, at] ^ put[letter, at]


# --- blocked Bloom filters


@dataclass
class Shard:
    """The filter of the words of a length whose hash has a remainder."""

    length: int
    part: int
    parts: int
    blocks: int
    first: int  # of its blocks, in the round

    def block(self, hashed: np.ndarray) -> np.ndarray:
        high = mix(hashed) >> np.uint64(32)
        return self.first + ((high * np.uint64(self.blocks)) >> np.uint64(32)).astype(np.int64)

    def takes(self, hashed: np.ndarray) -> np.ndarray:
        return (hashed >> np.uint64(20)) % np.uint64(self.parts) == self.part


def lanes(hashed: np.ndarray) -> Iterator[np.ndarray]:
    """The bit set in each lane."""
    low = mix(hashed ^ np.uint64(0x5BF0)).astype(np.uint32)
    for salt in _SALTS:
        yield np.uint32(1) << ((low * salt) >> np.uint32(27))


def rounds(sizes: dict[int, int], round_bytes: int = ROUND_BYTES) -> list[list[Shard]]:
    """Shards for so many words of each length, in rounds of bounded size."""
    most = max(1, round_bytes // BLOCK_BYTES)
    found, left = [], 0
    for length, n in sorted(sizes.items()):
        blocks = max(1, -(-n * BITS_PER_WORD // (LANES * LANE_BITS)))
        parts = -(-blocks // most)
        each = -(-blocks // parts)
        for part in range(parts):
            if each > left:
                found.append([])
                left = most
            found[-1].append(Shard(length, part, parts, each, most - left))
            left -= each
    return found


def filled(vocabulary: DataFrame, shards: list[Shard]) -> np.ndarray:
    """The blocks of a round, set bits joined by Spark before the driver gets
    them: at most ROUND_BYTES and a number for each block."""
    of_length: dict[int, list[Shard]] = {}
    for s in shards:
        of_length.setdefault(s.length, []).append(s)

    def bits(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashed = batch.column(0).to_numpy().view(np.uint64)
        size = batch.column(1).to_numpy()
        blocks, of = [], []
        for length, own in of_length.items():
            for shard in own:
                chosen = hashed[size == length]
                chosen = chosen[shard.takes(chosen)]
                blocks.append(shard.block(chosen))
                of.append(chosen)
        chosen = np.concatenate(of)
        pairs = [m.astype(np.uint64) for m in lanes(chosen)]
        longs = [(pairs[i] | (pairs[i + 1] << np.uint64(32))).view(np.int64) for i in range(0, LANES, 2)]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(blocks)), *map(pa.array, longs)], ["block", *(f"b{i}" for i in range(LANES // 2))]
        )

    names = [f"b{i}" for i in range(LANES // 2)]
    rows = vocabulary.where(F.col("size").isin(list(of_length))).select("hash", "size")
    rows = per_batch(rows, bits, "block bigint, " + ", ".join(f"{n} bigint" for n in names))
    joined = rows.groupBy("block").agg(*(F.bit_or(n).alias(n) for n in names)).toArrow()
    table = np.zeros((sum(s.blocks for s in shards), LANES // 2), np.int64)
    table[joined["block"].to_numpy()] = np.stack([joined[n].to_numpy() for n in names], 1)
    return table.view(np.uint32)


def known(table: np.ndarray, shards: list[Shard], hashed: np.ndarray) -> np.ndarray:
    """Places of the hashes, all of words of one length, that the shards of
    that length may hold."""
    found = []
    for shard in shards:
        at = np.flatnonzero(shard.takes(hashed)) if shard.parts > 1 else np.arange(len(hashed))
        own = hashed[at]
        block = shard.block(own)
        for lane, bit in enumerate(lanes(own)):
            if not lane:
                bits, left = [bit], np.flatnonzero(table[block, 0] & bit)
                continue
            left = left[(table[block[left], lane] & bit[left]) > 0]
        found.append(at[left])
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def positives(vocabulary: DataFrame, shards: list[Shard], alphabet: np.ndarray) -> DataFrame:
    """(id, edit) of the generated edits that a round's filters know."""
    of_length: dict[int, list[Shard]] = {}
    for s in shards:
        of_length.setdefault(s.length, []).append(s)
    shared = vocabulary.sparkSession.sparkContext.broadcast(filled(vocabulary, shards))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for at, letters in by_length(batch.column(1).to_pylist()):
                size = letters.shape[1]
                if size - 1 in of_length:
                    step = max(1, PROBES // size)
                    for start in range(0, len(at), step):
                        row, hashed = deletions(letters[start : start + step])
                        yield _hits(ids[at[start : start + step]], row, hashed, table, of_length[size - 1])
                if size in of_length:
                    width = max(1, PROBES // max(1, len(alphabet)))
                    step = max(1, width // size)
                    for start in range(0, len(at), step):
                        for place in range(0, size, width):
                            places = np.arange(place, min(place + width, size))
                            row, hashed = replacements(letters[start : start + step], alphabet, places)
                            yield _hits(ids[at[start : start + step]], row, hashed, table, of_length[size])

    sizes = sorted({x for length in of_length for x in (length, length + 1)})
    rows = vocabulary.where(F.col("size").isin(sizes)).select("id", "word")
    rows = rows.repartition(-(-max(1, rows.count()) // PROBED_WORDS))  # a word is many probes
    return rows.mapInArrow(probe, "id bigint, edit bigint")


def _hits(ids: np.ndarray, row: np.ndarray, hashed: np.ndarray, table: np.ndarray, shards: list[Shard]) -> pa.RecordBatch:
    hit = known(table, shards, hashed)
    # Two edits of a word may share a hash: the word is joined with it once.
    pairs = np.unique(np.stack([ids[row[hit]], hashed[hit].view(np.int64)], 1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["id", "edit"])


# --- near words, forms and roots


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_COUNT) -> DataFrame:
    """(id, word, n, size, hash) of the words that occur often enough, stored."""

    def hashed(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = batch.column(0).to_pylist()
        found = np.zeros(len(words), np.uint64)
        for at, letters in by_length(words):
            found[at] = hashes(letters)
        size = pa.array([len(w) for w in words], pa.int64())
        return pa.RecordBatch.from_arrays(
            [*batch.columns, size, pa.array(found.view(np.int64))], ["word", "n", "size", "hash"]
        )

    words = counted(docs, key, text).where(F.col("n") >= least)
    words = per_batch(words, hashed, "word string, n bigint, size bigint, hash bigint")
    return stored(words.withColumn("id", F.monotonically_increasing_id()), "vocabulary")


def near_pairs(words: DataFrame, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """(word, n, other, other_n): each pair of near words once, of a stored
    vocabulary."""
    sizes = {r.size: r["count"] for r in words.groupBy("size").count().collect()}
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).where("letter <> ''").distinct().collect()
    alphabet = np.array(sorted(ord(r.letter) for r in letters), np.uint8)
    found = [stored(positives(words, shards, alphabet), "positives") for shards in rounds(sizes, round_bytes)]
    if not found:
        return words.select("word", "n", F.col("word").alias("other"), F.col("n").alias("other_n")).limit(0)
    edits = reduce(DataFrame.unionByName, found)
    others = words.select(F.col("hash").alias("edit"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    pairs = edits.join(others, "edit").join(words.select("id", "word", "n"), "id")
    return pairs.where(F.levenshtein("word", "other", 1) == 1).select("word", "n", "other", "other_n")


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text", round_bytes: int = ROUND_BYTES) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word that occurs twice
    or more. The form is the near word of largest n (ties: the smallest), where
    that is FORM_FACTOR times the word's n or more; forms are followed to the
    root."""
    prepared(docs.sparkSession)
    words = vocabulary(docs, key, text)
    pairs = stored(near_pairs(words, round_bytes), "pairs")
    both = pairs.unionByName(pairs.select(
        F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")
    ))
    first = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("first")
    near = both.groupBy("word", "n").agg(F.count("*").alias("n_near"), first)
    has = -F.col("first.less") >= FORM_FACTOR * F.col("n")
    near = near.select(
        "word", "n_near", F.when(has, F.col("first.form")).alias("form"), F.when(has, -F.col("first.less")).alias("form_n")
    )
    near = stored(near, "near")
    roots = near.where("form is not null").select("word", F.col("form").alias("root"))
    # A form's n is FORM_FACTOR times its word's: that bounds a chain, each step below doubles it.
    most = words.agg(F.max("n")).first()[0] or 1
    steps = max(1, math.ceil(math.log(most, FORM_FACTOR)))
    for _ in range(math.ceil(math.log2(steps))):
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        roots = splittable_join(roots, onward, ["root"], "left")
        roots = stored(roots.select("word", F.coalesce("onward", "root").alias("root")), "roots")
    found = words.select("word", "n").join(near, "word", "left").join(roots, "word", "left")
    return found.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form_n"
    )
