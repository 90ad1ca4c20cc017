"""Quality classification by histogram gradient-boosted trees over document statistics.

Statistics of a text: lengths, classes of characters, words, lines, repetition.
Trees are grown level by level on binned statistics with the logistic loss, and
flattened into arrays of one row per tree in heap order, which a batch walks
down all at once, level by level.

The model is fitted on at most SAMPLE labelled documents, chosen by a hash of
the key; conflicting labels of a key are averaged, null labels are left out.
Every text is scored whole; a null text is the empty text, which has statistics
and a score like any other. Without any label every score is 0.5. Repeated rows
are repeated in the result. Rows with a null key are scored and not held out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from simmart.llm.characters import DIGIT, LETTER, MARKS, SPACE, STOP, UPPER, classes, code_points
from simmart.llm.common import kept, per_batch, prepared, texts
from simmart.llm.language import remainder
from simmart.llm.words import SPACED, Hasher, utf8, word_bytes

SAMPLE = 20_000
TREES, DEPTH, RATE, BINS, SMOOTHING = 120, 5, 0.15, 64, 1.0
_LINE = word_bytes(b"\n")


def _hasher() -> Hasher:
    return kept(("hasher",), Hasher)


def _repeated(values: np.ndarray) -> tuple[float, float]:
    """Share of values that are repeats, and of the most frequent one."""
    if not len(values):
        return 0.0, 0.0
    counts = np.unique(values, return_counts=True)[1]
    return 1 - len(counts) / len(values), counts.max() / len(values)


def statistics(text: str) -> list[float]:
    codes, data = code_points(text), utf8(text)
    n = max(1, len(codes))
    kind = classes()[codes]
    counts = [int(np.count_nonzero(kind & k)) for k in (LETTER, UPPER, DIGIT, SPACE, STOP, MARKS)]
    letters = max(1, counts[0])
    words, starts, ends = _hasher().words(data, SPACED)
    sizes = (ends - starts).astype(np.float64)
    n_words = max(1, len(words))
    last = data[ends - 1] if len(words) else np.zeros(0, np.uint8)
    first = data[starts] if len(words) else np.zeros(0, np.uint8)
    lines, line_starts, line_ends = _hasher().words(data, _LINE)
    line_sizes = (line_ends - line_starts).astype(np.float64)
    share = np.bincount(kind, minlength=64)[:64] / n
    share = share[share > 0]
    pairs = _hasher().runs(words, 2)
    same = np.flatnonzero(np.diff(codes) != 0)
    longest = np.diff(np.concatenate([[-1], same, [len(codes) - 1]])).max() if len(codes) else 0
    return [
        np.log1p(len(codes)),
        np.log1p(len(words)),
        sizes.mean() if len(words) else 0,
        sizes.std() if len(words) else 0,
        np.log1p(sizes.max()) if len(words) else 0,
        counts[0] / n,
        counts[1] / letters,
        counts[2] / n,
        counts[3] / n,
        counts[4] / n,
        counts[5] / n,
        1 - (sum(counts) - counts[1]) / n,
        *(np.count_nonzero(codes == ord(c)) / n_words for c in "!|*$%&#@."),
        np.log1p(len(lines)),
        line_sizes.mean() if len(lines) else 0,
        np.count_nonzero(line_sizes < 30) / max(1, len(lines)),
        *_repeated(lines),
        *_repeated(words),
        *_repeated(pairs),
        np.count_nonzero(words[1:] == words[:-1]) / n_words,
        np.count_nonzero(last == ord(".")) / n_words,
        np.count_nonzero((last < 128) & ((classes()[last] & (LETTER | DIGIT)) == 0)) / n_words,
        np.count_nonzero((first < 128) & ((classes()[first] & UPPER) > 0)) / n_words,
        np.count_nonzero(sizes <= 3) / n_words,
        float(-(share * np.log(share)).sum()),
        np.log1p(longest),
        len(np.unique(codes)) / np.sqrt(n),
    ]


@dataclass
class Trees:
    """Trees of one depth in heap order: the children of node i are 2 i + 1,
    taken where the statistic is not above the threshold, and 2 i + 2."""

    base: float
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    value: np.ndarray  # trees x leaves

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not len(self.feature):
            return np.full(len(x), 1 / (1 + np.exp(-self.base)))
        trees, rows = np.arange(len(self.feature))[None], np.arange(len(x))[:, None]
        node = np.zeros((len(x), len(self.feature)), np.int64)
        inner = self.feature.shape[1]
        for _ in range((inner + 1).bit_length() - 1):
            node = 2 * node + 1 + (x[rows, self.feature[trees, node]] > self.threshold[trees, node])
        total = self.base + self.value[trees, node - inner].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boosted trees of the statistics x for labels y of 0 to 1."""
    rows, features = x.shape
    if not rows:
        return Trees(0.0, np.zeros((0, 0), np.int64), np.zeros((0, 0)), np.zeros((0, 1)))
    edges = [np.unique(np.quantile(x[:, f], np.arange(1, BINS) / BINS)) for f in range(features)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], 1)
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(mean / (1 - mean)))
    inner = 2**DEPTH - 1
    feature = np.zeros((TREES, inner), np.int64)
    threshold = np.full((TREES, inner), np.inf)
    value = np.zeros((TREES, inner + 1))
    total = np.full(rows, base)
    for t in range(TREES):
        p = 1 / (1 + np.exp(-total))
        slope, bend = p - y, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(rows, np.int64)
        for depth in range(DEPTH):
            first, count = 2**depth - 1, 2**depth
            at = (((node - first)[:, None] * features + np.arange(features)) * BINS + binned).ravel()
            shape = (count, features, BINS)
            g = np.bincount(at, np.repeat(slope, features), count * features * BINS).reshape(shape).cumsum(2)
            h = np.bincount(at, np.repeat(bend, features), count * features * BINS).reshape(shape).cumsum(2)
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + SMOOTHING) + (all_g - g) ** 2 / (all_h - h + SMOOTHING) - all_g**2 / (all_h + SMOOTHING)
            gain[(h < 1) | (all_h - h < 1)] = 0
            gain = gain.reshape(count, -1)
            best = gain.argmax(axis=1)
            for i in np.flatnonzero(gain[np.arange(count), best] > 1e-6):
                f, b = divmod(int(best[i]), BINS)
                if b < len(edges[f]):
                    feature[t, first + i], threshold[t, first + i] = f, edges[f][b]
            own = x[np.arange(rows), feature[t, node]] > threshold[t, node]
            node = 2 * node + 1 + own
        leaf = node - inner
        g = np.bincount(leaf, slope, inner + 1)
        h = np.bincount(leaf, bend, inner + 1)
        value[t] = -RATE * g / (h + SMOOTHING)
        total += value[t, leaf]
    return Trees(base, feature, threshold, value)


def learned(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> Trees:
    """The model of labelled documents whose key's checksum is not held out."""
    usable = labels.select(F.col(key).alias("key"), F.col(label).cast("double").alias("label"))
    usable = usable.where(F.col("label").isNotNull() & (remainder("key", 3) != 1))
    usable = usable.groupBy("key").agg(F.avg("label").alias("label"))
    share = min(1.0, SAMPLE / max(1, usable.count()))
    place = F.pmod(F.xxhash64("key"), F.lit(2**62))
    # At most SAMPLE rows of two numbers, so that they can be broadcast.
    chosen = usable.where(place <= int(share * 2.0**62)).limit(SAMPLE)
    sample = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(chosen), "key")
    found = measured(sample, "text", ("key", "label")).limit(2 * SAMPLE).toArrow().sort_by("key")
    x = np.array(found["statistics"].to_pylist(), np.float64).reshape(found.num_rows, -1 if found.num_rows else 1)
    return grow(x, np.array(found["label"].to_pylist(), np.float64))


def measured(docs: DataFrame, text: str, keep: tuple[str, ...]) -> DataFrame:
    """The kept columns and the statistics of every text."""
    return _over(docs, text, keep, lambda x: {"statistics": pa.array(list(x), pa.list_(pa.float64()))}, "statistics array<double>")


def _over(docs: DataFrame, text: str, keep: tuple[str, ...], made, schema: str) -> DataFrame:
    kinds = dict(docs.dtypes)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = np.array([statistics(t) for t in texts(batch.column(batch.num_columns - 1))], np.float64)
        new = made(x)
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], *new.values()], [*batch.schema.names[:-1], *new])

    chosen = [F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)]
    schema = "".join(f"kept_{i} {kinds[c]}, " for i, c in enumerate(keep)) + schema
    result = per_batch(docs.select(*chosen, F.col(text).alias("text")), run, schema)
    return result.withColumnsRenamed({f"kept_{i}": c for i, c in enumerate(keep)})


def scored(docs: DataFrame, model: Trees, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, and score: how likely a text is of good quality."""
    return _over(docs, text, keep, lambda x: {"score": pa.array(model.scores(x))}, "score double")


def rated(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, held_out (one of three keys by checksum), score and predicted, by
    the model of the labels that are not held out."""
    prepared(docs.sparkSession)
    found = scored(docs, learned(docs, labels, key, text), text, (key,))
    held = F.coalesce(remainder(key, 3) == 1, F.lit(False))
    return found.select(key, held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
