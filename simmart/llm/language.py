"""Language identification by string kernels.

The kernel of two texts is their count of common character runs of one to three
letters (a blended spectrum, presence only), over the geometric mean of their
own counts. Runs are taken from lower-cased letters, words apart, and hashed to
65,536 slots a length. Kernel ridge regression, one language against the rest,
is fitted over Nyström landmarks. As kernel values are products of presence
vectors, landmarks and coefficients fold into one matrix (slots x languages),
by which a batch of presence vectors is multiplied.

The model is fitted on at most SAMPLE labelled texts, or one of each language if
there are more languages than that: as many of every language, chosen by a hash
of key and text; repeated rows are learned from once. Every language with a text
that has a letter is learned and has a landmark, so that the model, and a list of
languages that comes to the driver, grow with their number. Every text is scored
whole. A text that is null or has no letter is "und" with score 0, as
all are if nothing can be learned. Repeated rows are repeated in the result.
Rows with a null key are scored, never learned from and not held out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from simmart.llm.characters import LETTER, classes, code_points
from simmart.llm.common import kept, per_batch, prepared, texts

LENGTHS = 3
SLOTS = 1 << 16
SAMPLE = 2_000
PLACES = 1 << 62
LANDMARKS = 256  # or one of each language
RIDGE = 1e-3
SHARPNESS = 4.0
UNKNOWN = "und"


def presence(text: str) -> np.ndarray | None:
    """Sorted slots of the character runs of a text; None without a letter."""
    codes = code_points(text.lower())
    letter = (classes()[codes] & LETTER) > 0
    if not letter.any():
        return None
    codes = np.where(letter, codes, np.uint32(32))
    codes = np.concatenate([[np.uint32(32)], codes, [np.uint32(32)]])
    stays = np.ones(len(codes), bool)
    stays[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
    codes = codes[stays].astype(np.uint32)
    flags = kept(("presence",), lambda: np.zeros(LENGTHS * SLOTS, bool))
    run = np.zeros(len(codes), np.uint32)
    for n in range(LENGTHS):
        run = run[: len(codes) - n] * np.uint32(0x01000193) + codes[n:]
        flags[((run * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64) + n * SLOTS] = True
    found = np.flatnonzero(flags)
    flags[found] = False
    return found


@dataclass
class Model:
    languages: list[str]
    column: np.ndarray  # of each slot in the matrix, -1: in no landmark
    matrix: np.ndarray
    runs: float = 1.0  # median number of runs of the texts learned from

    def scores(self, found: list[np.ndarray]) -> np.ndarray:
        """Regression values of each text and language."""
        batch = np.zeros((len(found), len(self.matrix)), np.float32)
        for i, slots in enumerate(found):
            own = self.column[slots]
            batch[i, own[own >= 0]] = 1 / np.sqrt(len(slots))
        return batch @ self.matrix


def fit(found: list[np.ndarray], languages: list[str]) -> Model | None:
    """The model of labelled presence lists, which come in an arbitrary but
    fixed order."""
    names = sorted(set(languages))
    if not names:
        return None
    target = np.where(np.array(languages)[:, None] == np.array(names)[None], 1.0, -1.0)
    # Landmarks: the languages in turn.
    turn = np.zeros(len(languages), np.int64)
    for name in names:
        own = np.array(languages) == name
        turn[own] = np.arange(own.sum())
    landmarks = np.argsort(turn, kind="stable")[: max(LANDMARKS, len(names))]
    slots = np.unique(np.concatenate([found[i] for i in landmarks]))
    column = np.full(LENGTHS * SLOTS, -1, np.int32)
    column[slots] = np.arange(len(slots))
    marks = np.zeros((len(landmarks), len(slots)), np.float32)
    for row, i in enumerate(landmarks):
        marks[row, column[found[i]]] = 1 / np.sqrt(len(found[i]))
    kernel = np.zeros((len(found), len(landmarks)))
    for i, own in enumerate(found):
        own = column[own]
        kernel[i] = marks[:, own[own >= 0]].sum(axis=1) / np.sqrt(len(found[i]))
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    large = values > 1e-6 * values.max()
    root = vectors[:, large] / np.sqrt(values[large])
    mapped = kernel @ root
    solved = np.linalg.solve(
        mapped.T @ mapped + RIDGE * len(found) * np.eye(mapped.shape[1]), mapped.T @ target
    )
    runs = float(np.median([len(f) for f in found]))
    return Model(names, column, (marks.T @ (root @ solved)).astype(np.float32), runs)


def learned(docs: DataFrame, where: Column, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model | None:
    """The model of the labelled rows for which a condition holds."""
    place = F.pmod(F.xxhash64(key, text), F.lit(PLACES))
    usable = where & F.col(lang).isNotNull() & F.col(key).isNotNull() & F.col(text).rlike(r"\p{L}")
    rows = docs.where(usable).select(place.alias("place"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    counts = rows.groupBy("lang").agg(F.approx_count_distinct("place", 0.02).alias("n")).collect()
    if not counts:
        return None
    each = max(1, SAMPLE // len(counts))
    # By about twice as many rows as wanted, and 40, a language has enough of
    # them but for one case in 10^15; only these are ranked, and repeated rows
    # count once, so that what a task gets of a hot language does not grow.
    bounds = [(r.lang, int(PLACES * min(1.0, (2.2 * each + 44) / r.n))) for r in counts]
    bounds = F.broadcast(docs.sparkSession.createDataFrame(bounds, "lang string, bound bigint"))
    near = rows.join(bounds, "lang").where("place <= bound").dropDuplicates(["lang", "place"])
    first = Window.partitionBy("lang").orderBy("place")
    chosen = near.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= each)

    def slots(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [presence(t) for t in texts(batch.column(1))]
        lists = [None if f is None else f.astype(np.int32).tobytes() for f in found]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(lists, pa.binary())], ["place", "lang", "slots"])

    sample = per_batch(chosen.select("place", "text", "lang"), slots, "place bigint, lang string, slots binary")
    sample = sample.where("slots is not null").toArrow()
    sample = sample.sort_by([("place", "ascending"), ("lang", "ascending"), ("slots", "ascending")])
    return fit([np.frombuffer(b, np.int32) for b in sample["slots"].to_pylist()], sample["lang"].to_pylist())


def _margin(values: np.ndarray) -> np.ndarray:
    if values.shape[1] == 1:
        return np.full(len(values), np.inf)
    ordered = np.sort(values, axis=1)
    best, others = ordered[:, -1], ordered[:, :-1]
    top = others[:, -1]
    return best - top - np.log(np.exp(others - top[:, None]).mean(axis=1))


def predicted(
    docs: DataFrame, model: Model | None, text: str = "text", keep: tuple[str, ...] = ("doc_id",), margin: bool = False
) -> DataFrame:
    """The kept columns, lang_pred and score (0 to 1) of every row. On request
    also margin: the best regression value less the mean (of exponentials) of
    the others, which does not depend on how many there are. Values grow with
    the root of a text's number of runs; the margin of a text of fewer than the
    learned texts' median is raised to that. It is infinite for one language
    only, and 0 for unknown."""
    kinds = dict(docs.dtypes)

    def predict(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [presence(t) for t in texts(batch.column(batch.num_columns - 1))]
        known = [i for i, f in enumerate(found) if f is not None and model]
        names, score, above = np.full(len(found), UNKNOWN, object), np.zeros(len(found)), np.zeros(len(found))
        for start in range(0, len(known), 64):
            part = known[start : start + 64]
            values = SHARPNESS * model.scores([found[i] for i in part]).astype(np.float64)
            share = np.exp(values - values.max(axis=1, keepdims=True))
            share /= share.sum(axis=1, keepdims=True)
            best = share.argmax(axis=1)
            names[part] = np.array(model.languages, object)[best]
            score[part] = share[np.arange(len(part)), best]
            if margin:
                short = np.sqrt([min(1.0, len(found[i]) / model.runs) for i in part])
                above[part] = _margin(values) / SHARPNESS / short
        columns = [*batch.columns[:-1], pa.array(names, pa.string()), pa.array(score), *[pa.array(above)] * margin]
        return pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "lang_pred", "score", *["margin"] * margin])

    chosen = [F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)]
    schema = "".join(f"kept_{i} {kinds[c]}, " for i, c in enumerate(keep)) + "lang_pred string, score double" + ", margin double" * margin
    result = per_batch(docs.select(*chosen, F.col(text).alias("text")), predict, schema)
    return result.withColumnsRenamed({f"kept_{i}": c for i, c in enumerate(keep)})


def remainder(key: str, divisor: int) -> Column:
    return F.crc32(F.col(key).cast("string")) % divisor


def identified(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Key, held_out (every fifth key by checksum), lang_pred and score, by the
    model of the rows that are not held out."""
    prepared(docs.sparkSession)
    held = F.coalesce(remainder(key, 5) == 0, F.lit(False))
    model = learned(docs, ~held, key, text, lang)
    found = predicted(docs, model, text, (key,))
    return found.select(key, held.alias("held_out"), "lang_pred", "score")
