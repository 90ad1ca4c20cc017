"""Toxicity by compression distance to two zstandard dictionaries.

A window is a word between blanks, in lower case; words beyond WINDOW_BYTES are
cut into several windows. Each window is compressed with a dictionary of
toxic text and with one of ordinary text; its gain is how many bytes fewer the
first takes. PADDING, the same for both, is put behind each window: without it
zstandard stores inputs of a few bytes as they are.

A dictionary's content is trained on labelled texts. The toxic one holds the
words whose share of documents is higher among toxic than among ordinary ones by
LEAST_CONTRAST standard errors or more, strongest last, where zstandard finds
them at least cost. The ordinary one holds the most frequent words of ordinary
documents. A word counts once for a document and once for equal neighbours, so
that copies of a passage count once.

A document's features are its three highest gains, its number of windows of a
gain at or above the threshold, and that number's share (of FEW_WINDOWS more, so
that one window of a short text is not all). The threshold is the gain that at
most TOO_MANY of the ordinary learned windows exceed. A logistic regression turns
features, cut to the range learned, into a score; it is fitted on labelled
documents that the dictionaries were not trained on.

The model is fitted on at most SAMPLE labelled documents, as many of either class
as there are up to half, chosen by a hash of the key, of each of which at most
LEARNED_WINDOWS windows, spread over the whole text, train the dictionaries.
Conflicting labels of a key are averaged, null labels are left out. Every text
is scored whole. A null text is the empty text, which has a score like any other.
If nothing can be learned every score is the share of toxic labels, 0 without
any. Repeated rows are repeated in the result. Rows with a null key are scored,
never learned from and not held out.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from simmart.llm.common import kept, per_batch, prepared, texts
from simmart.llm.language import remainder

SAMPLE = 4_000
LEARNED_WINDOWS = 1_000
WINDOW_BYTES = 64
TOXIC_BYTES, ORDINARY_BYTES = 4_096, 16_384
LEAST_CONTRAST = 3.5
TOO_MANY = 1e-4
FEW_WINDOWS = 50
PADDING = bytes(32)
TAIL = b"\x01" * 16  # unlike the padding, that the word before it is no special case
RIDGE = 1.0
GAINS_KEPT = 400_000  # windows whose gain a worker holds, some 60 MB
_WORD = re.compile(rb"[^\x00-\x20]{1,%d}" % WINDOW_BYTES)


def windows(text: str) -> list[bytes]:
    return _WORD.findall(text.lower().encode("utf-8", "surrogatepass"))


def surroundings(text: str) -> dict[bytes, int]:
    """The distinct windows of a text, each with the smallest checksum of its
    neighbours: at most LEARNED_WINDOWS of them, those of smallest checksum of
    their own."""
    own = windows(text)
    found: dict[bytes, int] = {}
    for i, w in enumerate(own):
        sides = zlib.crc32(own[i - 1] + b" " if i else b" ", zlib.crc32(own[i + 1] if i + 1 < len(own) else b""))
        if found.get(w, 1 << 32) > sides:
            found[w] = sides
    if len(found) > LEARNED_WINDOWS:
        found = {w: found[w] for w in sorted(found, key=lambda w: (zlib.crc32(w), w))[:LEARNED_WINDOWS]}
    return found


def _counted(documents: list[dict[bytes, int]]) -> dict[bytes, int]:
    sides = defaultdict(set)
    for own in documents:
        for w, s in own.items():
            sides[w].add(s)
    return {w: len(s) for w, s in sides.items()}


def _content(ranked: list[bytes], size: int) -> bytes:
    """As many words as fit, the first of them last, and a tail, as zstandard
    does not look up the last bytes of a dictionary."""
    chosen, left = [], size - 1 - len(TAIL)
    for w in ranked:
        if len(w) + 1 > left:
            break
        chosen.append(w)
        left -= len(w) + 1
    return b" " + b"".join(w + b" " for w in reversed(chosen)) + TAIL


def _contrast(n: int, m: int, of_n: int, of_m: int) -> float:
    """In how many standard errors n of one number is a larger share than m of
    another: the signed root of the likelihood ratio, which holds for rare
    words too."""
    share = (n + m) / (of_n + of_m)

    def own(k: int, of: int) -> float:
        hit = k * math.log(k / of / share) if k else 0.0
        return hit + ((of - k) * math.log((1 - k / of) / (1 - share)) if k < of else 0.0)

    root = math.sqrt(max(0.0, 2 * (own(n, of_n) + own(m, of_m)))) if share < 1 else 0.0
    return root if n / of_n > m / of_m else -root


def dictionaries(toxic: list[dict[bytes, int]], ordinary: list[dict[bytes, int]]) -> tuple[bytes, bytes] | None:
    """Contents of the two dictionaries; None where no word tells the classes
    apart."""
    if not toxic or not ordinary:
        return None
    a, b = _counted(toxic), _counted(ordinary)
    contrast = {w: _contrast(n, b.get(w, 0), len(toxic), len(ordinary)) for w, n in a.items()}
    telling = sorted((w for w, c in contrast.items() if c >= LEAST_CONTRAST), key=lambda w: (-contrast[w], w))
    if not telling:
        return None
    common = sorted((w for w in b if contrast.get(w, 0) < LEAST_CONTRAST), key=lambda w: (-b[w], w))
    return _content(telling, TOXIC_BYTES), _content(common, ORDINARY_BYTES)


class Gains:
    """Bytes that windows take fewer with the toxic dictionary."""

    def __init__(self, toxic: bytes, ordinary: bytes) -> None:
        import zstandard

        settings = zstandard.ZstdCompressionParameters(
            strategy=zstandard.STRATEGY_GREEDY, min_match=4, target_length=0, window_log=15, hash_log=14, chain_log=14,
            search_log=3, write_content_size=False, write_checksum=False, write_dict_id=False,
        )
        self._compressors = [
            zstandard.ZstdCompressor(
                dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
                compression_params=settings,
            )
            for content in (toxic, ordinary)
        ]
        self._known: dict[bytes, int] = {}

    def of(self, window: bytes) -> int:
        found = self._known.get(window)
        if found is None:
            if len(self._known) > GAINS_KEPT:
                self._known.clear()
            padded = b" " + window + b" " + PADDING
            toxic, ordinary = (len(c.compress(padded)) for c in self._compressors)
            found = self._known[window] = ordinary - toxic
        return found


@dataclass
class Model:
    contents: tuple[bytes, bytes] | None = None
    threshold: int = 0
    least: np.ndarray = field(default_factory=lambda: np.full(5, -np.inf))  # of each feature, in the learned texts
    most: np.ndarray = field(default_factory=lambda: np.full(5, np.inf))
    mean: np.ndarray = field(default_factory=lambda: np.zeros(5))
    spread: np.ndarray = field(default_factory=lambda: np.ones(5))
    weight: np.ndarray = field(default_factory=lambda: np.zeros(5))
    base: float = 0.0
    share: float = 0.0  # of toxic labels, the score if nothing was learned

    def gains(self) -> Gains:
        digest = hashlib.sha256(b"\0".join(self.contents)).hexdigest()
        return kept(("gains", digest), lambda: Gains(*self.contents))

    def features(self, batch: list[str]) -> np.ndarray:
        found = np.zeros((len(batch), 5))
        gains = self.gains()
        for row, text in enumerate(batch):
            counts = Counter(windows(text))
            if not counts:
                continue
            values = np.fromiter(map(gains.of, counts), np.int64, len(counts))
            times = np.fromiter(counts.values(), np.int64, len(counts))
            order = np.argsort(-values, kind="stable")[:3]
            top = np.repeat(values[order], np.minimum(times[order], 3))[:3]
            hits = int(times[values >= self.threshold].sum())
            total = int(times.sum())
            found[row, : len(top)] = top
            found[row, 3:] = np.log1p(hits), hits / (total + FEW_WINDOWS)
        return found

    def scores(self, batch: list[str]) -> np.ndarray:
        if self.contents is None:
            return np.full(len(batch), self.share)
        x = (np.clip(self.features(batch), self.least, self.most) - self.mean) / self.spread
        return 1 / (1 + np.exp(-np.clip(self.base + x @ self.weight, -500, 500)))


def threshold(gains: Gains, ordinary: list[dict[bytes, int]]) -> int:
    """The smallest gain above 0 that at most TOO_MANY of the windows reach."""
    values = np.sort(np.array([gains.of(w) for own in ordinary for w in own], np.int64))
    if not len(values):
        return 1
    return max(1, int(values[len(values) - 1 - int(TOO_MANY * len(values))]) + 1)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Ridge regression by Newton steps of weighted rows: weights and base."""
    x = np.concatenate([x, np.ones((len(x), 1))], 1)
    ridge = np.diag([RIDGE] * (x.shape[1] - 1) + [1e-6])
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (p - y)) + ridge @ beta
        bend = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge
        step = np.linalg.solve(bend, slope)
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    return beta[:-1], float(beta[-1])


def learned(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """The model of labelled documents whose key's checksum is not held out."""
    usable = labels.select(F.col(key).alias("key"), F.col(label).cast("double").alias("label"))
    usable = usable.where(F.col("label").isNotNull() & (remainder("key", 5) != 0))
    usable = usable.groupBy("key").agg((F.avg("label") >= 0.5).alias("toxic"))
    sizes = {r.toxic: r["count"] for r in usable.groupBy("toxic").count().collect()}
    if not sizes:
        return Model()
    place = F.pmod(F.xxhash64("key"), F.lit(2**62))
    bounds = {c: min(1.0, SAMPLE / 2 / n) for c, n in sizes.items()}
    chosen = F.lit(False)
    for toxic, bound in bounds.items():
        chosen = chosen | ((F.col("toxic") == toxic) & (place <= int(bound * 2.0**62)))
    # At most 2 * SAMPLE rows of two values, so that they can be broadcast.
    sample = usable.where(chosen).orderBy(place, "key").limit(2 * SAMPLE)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(sample), "key")
    rows = rows.withColumn("order", F.xxhash64("key", "text"))
    trains = F.pmod(F.xxhash64("key", F.lit(1)), F.lit(3)) > 0
    model = Model(share=sizes.get(True, 0) / sum(sizes.values()))

    def words(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [surroundings(t) for t in texts(batch.column(2))]
        return pa.RecordBatch.from_arrays(
            [
                *batch.columns[:2],
                pa.array([list(f) for f in found], pa.list_(pa.binary())),
                pa.array([list(f.values()) for f in found], pa.list_(pa.int64())),
            ],
            ["order", "toxic", "words", "sides"],
        )

    # Ids may repeat: of too many rows the same ones are taken each time.
    schema = "order bigint, toxic boolean, words array<binary>, sides array<bigint>"
    found = per_batch(rows.where(trains).select("order", "toxic", "text"), words, schema)
    found = found.orderBy("order").limit(2 * SAMPLE).toArrow()
    classes = {True: [], False: []}
    for toxic, own, sides in zip(*(found[c].to_pylist() for c in ("toxic", "words", "sides"))):
        classes[toxic].append(dict(zip(own, sides)))
    model.contents = dictionaries(classes[True], classes[False])
    if model.contents is None:
        return model
    model.threshold = threshold(model.gains(), classes[False])

    def measured(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = pa.array(list(model.features(texts(batch.column(2)))), pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([*batch.columns[:2], x], ["order", "toxic", "x"])

    calibrating = rows.where(~trains).select("order", "toxic", "text")
    calibrating = per_batch(calibrating, measured, "order bigint, toxic boolean, x array<double>")
    found = calibrating.orderBy("order").limit(2 * SAMPLE).collect()
    y = np.array([r.toxic for r in found], np.float64)
    if not 0 < y.sum() < len(y):
        model.contents = None
        return model
    x = np.array([r.x for r in found])
    model.least, model.most = x.min(axis=0), x.max(axis=0)
    model.mean, model.spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    # Classes were sampled unevenly: rows count as those they stand for.
    weight = np.where(y > 0, 1 / bounds[True], 1 / bounds[False])
    model.weight, model.base = logistic((x - model.mean) / model.spread, y, weight / weight.mean())
    return model


def scored(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, and score: how likely a text is toxic."""
    kinds = dict(docs.dtypes)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = pa.array(model.scores(texts(batch.column(batch.num_columns - 1))), pa.float64())
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], scores], [*batch.schema.names[:-1], "score"])

    chosen = [F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)]
    schema = "".join(f"kept_{i} {kinds[c]}, " for i, c in enumerate(keep)) + "score double"
    result = per_batch(docs.select(*chosen, F.col(text).alias("text")), run, schema)
    return result.withColumnsRenamed({f"kept_{i}": c for i, c in enumerate(keep)})


def rated(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, held_out (one of five keys by checksum), score and predicted, by
    the model of the labels that are not held out."""
    prepared(docs.sparkSession)
    found = scored(docs, learned(docs, labels, key, text), text, (key,))
    held = F.coalesce(remainder(key, 5) == 0, F.lit(False))
    return found.select(key, held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
