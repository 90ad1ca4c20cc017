"""Task-side scoring of one batch of sources against a block of targets.

These helpers run inside Spark tasks on Arrow batches. Sources are held in order
of their set-bit counts, word by word, so that a target meets a contiguous run of
them: a score cannot exceed min(a, b) / max(a, b) of the two counts (Swamidass &
Baldi, 2007), which bounds the run for any least score wanted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.fs as pafs

WIDTH = 1024  # targets of a block
ALL_ROWS = 16_384  # sources held at a time; 4 MB of 2,048 bits
BEST_ROWS = 65_536  # larger, as each time up to k + 1 rows per target come out
NEAR_ROWS = 2_048  # sources of the nearest counts, which give a first floor
OUT_ROWS = 1 << 18  # scores of a batch that comes out

ALL, OWN_BAND, OTHER_BANDS = "all", "own band", "other bands"


def word_rows(column: pa.Array | pa.ChunkedArray, n_words: int) -> np.ndarray:
    """A list<int64> column as a (rows, words) matrix of unsigned words. Rows
    of another width raise an error: they would give plausible wrong scores."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    found = set(pc.unique(pc.list_value_length(column)).to_pylist())
    if found - {n_words}:
        raise ValueError(f"fingerprints of {n_words} words are needed; there are some of {sorted(found - {n_words})}")
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat).view(np.uint64).reshape(len(column), n_words)


def with_words(rows):
    """Rows (batch or table) that have a fingerprint in their second column."""
    return rows.filter(pc.is_valid(rows.column(1)))


class TargetBlock:
    """Some targets: ids, packed words, set-bit counts, and the least score
    wanted of each, where a third column tells it."""

    def __init__(self, ids: pa.Array, words: np.ndarray, floor: np.ndarray):
        self.ids, self.words, self.floor = ids, words, floor
        self.sizes = np.bitwise_count(words).sum(axis=1, dtype=np.int64)

    @classmethod
    def from_arrow(cls, batch: pa.RecordBatch, n_words: int) -> TargetBlock:
        batch = with_words(batch)
        floor = batch.column(2).to_numpy() if batch.num_columns > 2 else np.zeros(len(batch))
        return cls(batch.column(0), word_rows(batch.column(1), n_words), floor)

    def __len__(self) -> int:
        return len(self.ids)


class StoredTargets:
    """Targets in a folder of Parquet files that every task can read. They are
    walked block by block, so that no task holds more than one of them."""

    def __init__(self, path: str, n_words: int):
        self.path, self.n_words = path, n_words

    def __iter__(self) -> Iterator[TargetBlock]:
        system, path = pafs.FileSystem.from_uri(self.path)
        for batch in ds.dataset(path, format="parquet", filesystem=system).to_batches(batch_size=WIDTH):
            block = TargetBlock.from_arrow(batch, self.n_words)
            if len(block):
                yield block


class Sources:
    """Some sources in order of set-bit count."""

    def __init__(self, ids: pa.Array, words: np.ndarray) -> None:
        sizes = np.bitwise_count(words).sum(axis=1, dtype=np.int64)
        order = np.argsort(sizes, kind="stable")
        self.sizes, self.ids = sizes[order], ids.take(pa.array(order))
        self.by_word = np.ascontiguousarray(words[order].T)
        self.count_type = np.uint16 if 64 * len(self.by_word) < 1 << 16 else np.int32

    def __len__(self) -> int:
        return len(self.sizes)

    def scores(self, words: np.ndarray, size: int, start: int, stop: int) -> np.ndarray:
        """Tanimoto of one target with a run of sources: bits in common, by
        popcount of the words, over bits in either; two empty sets score 1."""
        common = np.zeros(stop - start, self.count_type)
        for w in np.flatnonzero(words):
            common += np.bitwise_count(self.by_word[w, start:stop] & words[w])
        either = self.sizes[start:stop] + size - common
        return np.where(either == 0, 1.0, common / np.maximum(either, 1))

    def reaching(self, size: int, floor: float) -> tuple[int, int]:
        """The run of sources whose counts allow a score of the floor. A count
        more is taken on either side than rounding could ask for."""
        if floor <= 0:
            return 0, len(self)
        low, high = int(size * floor) - 1, int(size / floor) + 2
        return int(np.searchsorted(self.sizes, low)), int(np.searchsorted(self.sizes, high, side="right"))

    def order_of_ids(self) -> np.ndarray:
        """The place of each source when sorted by id."""
        place = np.empty(len(self), np.int64)
        place[np.argsort(self.ids.to_numpy(zero_copy_only=False), kind="stable")] = np.arange(len(self))
        return place


def gathered(batches: Iterator[pa.RecordBatch], n_words: int, rows: int) -> Iterator[Sources]:
    """Up to `rows` sources at a time."""
    waiting, n = [], 0
    for batch in map(with_words, batches):
        while len(batch):
            part = batch.slice(0, rows - n)
            waiting.append(part)
            batch, n = batch.slice(len(part)), n + len(part)
            if n == rows:
                yield _sources(waiting, n_words)
                waiting, n = [], 0
    if waiting:
        yield _sources(waiting, n_words)


def _sources(parts: list[pa.RecordBatch], n_words: int) -> Sources:
    table = pa.Table.from_batches(parts)
    return Sources(table.column(0).combine_chunks(), word_rows(table.column(1), n_words))


def _codes(source_ids: pa.Array, block: TargetBlock) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the sources' and targets' ids; -1 for one that no target has."""
    values = pc.unique(block.ids.cast(source_ids.type))
    numbers = [pc.index_in(ids.cast(source_ids.type), value_set=values) for ids in (source_ids, block.ids)]
    return tuple(x.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) for x in numbers)


def _scored(block: TargetBlock, sources: Sources, found: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Rows of (target, places of sources, scores)."""
    target = np.repeat([t for t, _, _ in found], [len(at) for _, at, _ in found])
    return pa.RecordBatch.from_arrays(
        [
            block.ids.take(pa.array(target)),
            sources.ids.take(pa.array(np.concatenate([at for _, at, _ in found]))),
            pa.array(np.concatenate([s for _, _, s in found])),
        ],
        ["target_chembl_id", "source_chembl_id", "similarity_score"],
    )


def _batches(block: TargetBlock, sources: Sources, rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    found, n = [], 0
    for row in rows:
        if n and n + len(row[1]) > OUT_ROWS:
            yield _scored(block, sources, found)
            found, n = [], 0
        found.append(row)
        n += len(row[1])
    if n:
        yield _scored(block, sources, found)


def all_scores(batches: Iterator[pa.RecordBatch], targets: StoredTargets) -> Iterator[pa.RecordBatch]:
    """Every (target, source, score) of the batches, without pairs of one id,
    target after target."""
    for sources in gathered(batches, targets.n_words, ALL_ROWS):
        for block in targets:
            own, other = _codes(sources.ids, block)

            def rows() -> Iterator[tuple]:
                for t in range(len(block)):
                    at = np.flatnonzero(own != other[t])
                    yield t, at, sources.scores(block.words[t], block.sizes[t], 0, len(sources))[at]

            yield from _batches(block, sources, rows())


def _runs(sources: Sources, size: int, floor: float, which: str, band: int) -> list[tuple[int, int]]:
    """The runs of sources that a target meets: all that reach its floor, or
    those within its own band of counts, or those outside it."""
    start, stop = sources.reaching(size, floor)
    if which == ALL:
        return [(start, stop)]
    low = size // band * band
    first, last = np.searchsorted(sources.sizes, [low, low + band])
    if which == OWN_BAND:
        return [(max(start, int(first)), min(stop, int(last)))]
    return [(start, min(stop, int(first))), (max(start, int(last)), stop)]


def best_scores(
    batches: Iterator[pa.RecordBatch], targets: StoredTargets, keep: int, which: str = ALL, band: int = 1
) -> Iterator[pa.RecordBatch]:
    """The ``keep`` best sources of each target (score down, id up) among up to
    BEST_ROWS sources at a time. Those of the nearest counts give a floor,
    and only sources whose counts reach it are scored then; equal scores reach
    it, so that ties are never lost."""
    for sources in gathered(batches, targets.n_words, BEST_ROWS):
        place = sources.order_of_ids()
        for block in targets:
            own, other = _codes(sources.ids, block)

            def rows() -> Iterator[tuple]:
                for t in range(len(block)):
                    size, floor = int(block.sizes[t]), float(block.floor[t])

                    def met(start: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
                        at = start + np.flatnonzero(own[start:stop] != other[t])
                        return at, sources.scores(block.words[t], size, start, stop)[at - start]

                    middle = int(np.searchsorted(sources.sizes, size))
                    for start, stop in _runs(sources, size, floor, which, band):
                        low, high = max(start, middle - NEAR_ROWS), min(stop, middle + NEAR_ROWS)
                        if high - low > keep and high - low < stop - start:
                            near = met(low, high)[1]
                            if len(near) >= keep:
                                floor = max(floor, float(np.partition(near, len(near) - keep)[len(near) - keep]))
                                least, most = sources.reaching(size, floor)
                                start, stop = max(start, least), min(stop, most)
                        if start >= stop:
                            continue
                        at, score = met(start, stop)
                        at, score = at[score >= floor], score[score >= floor]
                        best = np.lexsort((place[at], -score))[:keep]
                        if len(best):
                            yield t, at[best], score[best]

            yield from _batches(block, sources, rows())
