"""Ranked lexical search by scanning documents with an Aho-Corasick automaton.

No index of the documents is made. The distinct terms of the items, each between
two guards, make one automaton; a document's terms are folded and set apart by
the same guard, so that each output of the automaton is one occurrence of a whole
term. Outputs map to the items that hold the term. Documents are scanned twice:
for the corpus figures (documents, terms, documents with each term), which Spark
adds up, and for the scores, of which each task sends on the best of every item
only. Nothing else is shuffled.

Items are a query set, taken block by block of at most BLOCK_CHARS characters (or
one item), so that automaton and answers of a block are bounded. The rows of a
block's answers are stored if there are several blocks.

Terms are the maximal runs of ASCII letters and digits and of all characters
beyond ASCII, with A to Z lower-cased. Null and empty texts have none: such a
document counts nowhere and such an item has no answers. Each row is a document,
or an item, of its own, also if it repeats one or its id is null. Equal scores
rank by id, null last. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from simmart.llm.common import kept, prepared, stored, texts

BLOCK_CHARS = 1_000_000
BUFFER_ROWS = 100_000  # answers a task holds before it cuts them to the best
_GUARD = " "
_FOLDED = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else ord(_GUARD) for b in range(256)
)


def guarded(text: str) -> str:
    """The text's terms, a guard or more between any two and at both ends."""
    folded = text.encode("utf-8", "surrogatepass").translate(_FOLDED).decode("utf-8", "surrogatepass")
    return f"{_GUARD}{folded}{_GUARD}"


def terms(text: str) -> list[str]:
    return [t for t in guarded(text).split(_GUARD) if t]


def n_terms(text: str) -> int:
    """How many terms a guarded text has: places where a guard ends."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8) == ord(_GUARD)
    return int(np.count_nonzero(data[:-1] & ~data[1:]))


@dataclass
class Block:
    """Items and the distinct terms they hold: those of item i are
    own[first[i]:first[i + 1]] as numbers of terms."""

    items: pa.Array
    terms: list[str]
    holders: np.ndarray  # items of each term, one term after another
    first: np.ndarray

    @classmethod
    def of(cls, items: pa.Array, item_texts: list[str]) -> Block:
        sets = [set(terms(t)) for t in item_texts]
        names = sorted(set().union(*sets))
        number = {t: i for i, t in enumerate(names)}
        pairs = sorted((number[t], i) for i, own in enumerate(sets) for t in own)
        of_term = np.array([t for t, _ in pairs], np.int64)
        first = np.searchsorted(of_term, np.arange(len(names) + 1))
        return cls(items, names, np.array([i for _, i in pairs], np.int64), first)

    def digest(self) -> str:
        return hashlib.sha256("\n".join(self.terms).encode("utf-8", "surrogatepass")).hexdigest()


class Scanner:
    """Counts a block's terms in texts."""

    def __init__(self, names: list[str]) -> None:
        import ahocorasick

        self._automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, name in enumerate(names):
            self._automaton.add_word(f"{_GUARD}{name}{_GUARD}", i)
        if names:
            self._automaton.make_automaton()
        self._empty = not names

    def counts(self, text: str) -> Counter:
        """How often each term (by number) occurs in a guarded text. Two
        matches may share the guard between them: all are given."""
        return Counter() if self._empty else Counter(map(itemgetter(1), self._automaton.iter(text)))


def _scanner(digest: str, names: list[str]) -> Scanner:
    return kept(("scanner", digest), lambda: Scanner(names))


@dataclass
class Corpus:
    documents: int  # with a term at least
    terms: int
    holding: np.ndarray  # documents that hold each term


def measured(docs: DataFrame, block: Block, text: str) -> Corpus:
    """The corpus figures: a first scan, summed by Spark."""
    digest, names = block.digest(), block.terms

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, holding = _scanner(digest, names), np.zeros(len(names) + 2, np.int64)
        for batch in batches:
            for t in texts(batch.column(0)):
                t = guarded(t)
                n = n_terms(t)
                holding[-2] += n > 0
                holding[-1] += n
                holding[list(scanner.counts(t))] += 1
        at = np.flatnonzero(holding)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(holding[at])], ["term", "n"])

    found = docs.select(text).mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(len(names) + 2, np.int64)
    total[found["term"].to_numpy()] = found["n"].to_numpy()
    return Corpus(int(total[-2]), int(total[-1]), total[:-2])


def weights(corpus: Corpus) -> np.ndarray:
    n = corpus.documents
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(d) + 1))) for d in corpus.holding], np.int64)


def _best(rows: pa.Table, k: int) -> pa.Table:
    """The k best rows of each item."""
    rows = rows.sort_by([("item", "ascending"), ("score", "descending"), ("doc", "ascending")])  # null last
    item = rows["item"].to_numpy()
    place = np.arange(len(item)) - np.searchsorted(item, item)
    return rows.filter(pa.array(place < k))


def _answers(docs: DataFrame, block: Block, corpus: Corpus, k: int, key: str, text: str) -> DataFrame:
    """(item, doc, score) by a second scan: the best k of every item and task."""
    digest, names, first, holders = block.digest(), block.terms, block.first, block.holders
    weight, n_docs, all_terms, n_items = weights(corpus), corpus.documents, corpus.terms, len(block.items)
    kind = dict(docs.dtypes)[key]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, held, least = _scanner(digest, names), None, np.ones(n_items, np.int64)
        for batch in batches:
            total = np.zeros((batch.num_rows, n_items), np.int64)
            for row, t in enumerate(texts(batch.column(1))):
                t = guarded(t)
                found = scanner.counts(t)
                if not found:
                    continue
                term, tf = np.array(list(found), np.int64), np.array(list(found.values()), np.int64)
                m = 100 - 90 + (90 * n_terms(t) * n_docs) // all_terms
                part = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
                sizes = first[term + 1] - first[term]
                at = np.repeat(first[term] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
                np.add.at(total[row], holders[at], np.repeat(part, sizes))
            row, item = np.nonzero(total >= least)
            new = pa.table({"item": item, "doc": batch.column(0).take(pa.array(row)), "score": total[row, item]})
            held = new if held is None else pa.concat_tables([held, new])
            if held.num_rows > BUFFER_ROWS + n_items * k:
                held = _best(held, k)
                item, scores = held["item"].to_numpy(), held["score"].to_numpy()
                full = np.flatnonzero(np.bincount(item, minlength=n_items) >= k)
                least[full] = scores[np.searchsorted(item, full, side="right") - 1]
        if held is not None:
            yield from _best(held, k).combine_chunks().to_batches()

    return docs.select(F.col(key).alias("doc"), text).mapInArrow(score, f"item bigint, doc {kind}, score bigint")


def _blocks(items: DataFrame, key: str, text: str) -> Iterator[Block]:
    """The items, block by block: no more than a block is at the driver."""
    kind = items.select(key).limit(0).toArrow().schema.field(0).type
    keys, own, size = [], [], 0
    for row in items.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).toLocalIterator():
        if keys and size + len(row.text) > BLOCK_CHARS:
            yield Block.of(pa.array(keys, kind), own)
            keys, own, size = [], [], 0
        keys.append(row.key)
        own.append(row.text)
        size += len(row.text)
    if keys:
        yield Block.of(pa.array(keys, kind), own)


def ranked(
    docs: DataFrame, items: DataFrame, k: int = 10, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """The k documents of highest score above 0 of each item: item, rank, key
    and score."""
    spark = prepared(docs.sparkSession)
    kind = dict(items.dtypes)[item]
    parts = []
    for block in _blocks(items, item, item_text):
        if parts and len(parts) == 1:
            parts[0] = stored(parts[0], "ranked")
        found = _answers(docs, block, measured(docs, block, text), k, key, text)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
        best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame(
            pa.table({"item": np.arange(len(block.items)), "name": block.items}), f"item bigint, name {kind}"
        )
        best = best.join(F.broadcast(names), "item").select("name", "rank", "doc", "score")
        parts.append(stored(best, "ranked") if parts else best)
    if not parts:
        kinds = dict(docs.dtypes)
        return spark.createDataFrame([], f"`{item}` {kind}, rank int, `{key}` {kinds[key]}, score bigint")
    found = reduce(DataFrame.unionByName, parts)
    return found.select(F.col("name").alias(item), "rank", F.col("doc").alias(key), "score")
