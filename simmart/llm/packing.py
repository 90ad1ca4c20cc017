"""Sum-of-squares online packing of tokenised documents into windows.

A document longer than a window fills whole windows first. What remains of it,
an item shorter than a window, goes to the fill level that leaves the smallest
sum of squared counts of partially filled windows (Csirik, Johnson, Kenyon,
Orlin, Shor & Weber, 2006; ties to the fullest level). An array over the levels
holds the counts. The windows still open at the end of a part, or when there
are too many to hold, are evened out: the emptiest are cut into pieces that fill
the others up, and the last rest into powers of two, which need no padding.

Each part of the table is packed where it lies, so that nothing is shuffled and
a part that is computed again gives the same sequences. Sequence ids are the
part's number times 2**40 plus a count.

Null text is empty; an empty document is its end mark alone. Repeated rows are
packed as often as they come. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from simmart.llm.common import give_back, kept_in_stage, texts

WINDOW = 4096
END_ID = 2
OPEN_WINDOWS = 1_024  # at most 16 MB of ids; with more, all are evened out
WORDS_KEPT = 600_000  # tokenised words a worker holds, some 120 MB
_NO_SPACE = re.compile("[\x1c-\x1f]")  # white space to str.split(), not to tokenizers
_SPACE = re.compile("[ \n\t\r]+")
_TAIL = ".,!&*$%#|"
# Marks after a letter or digit at a word's end, but for a letter that the tokenizer takes apart.
_MARKS_BEHIND = re.compile(r"(?s)[%s](?<=[^\W_\u0130].)[%s]*(?=\s|\Z)" % (re.escape(_TAIL), re.escape(_TAIL)))


class Words:
    """Ids of texts by a tokenizer that drops white space, got word by word:
    such a tokenizer treats the parts between spaces alike wherever they stand,
    so each distinct part is tokenised once."""

    def __init__(self, definition: str) -> None:
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(definition)
        self._known: dict[str, bytes] = {}
        probe = "It's  Σας\n<|endoftext|> a\tNAÏVE é 12x, "
        whole = self._tokenizer.encode(probe, add_special_tokens=False).ids
        if np.frombuffer(self.ids(probe.encode().decode()), np.uint32).tolist() != whole:
            raise ValueError("the tokenizer does not treat the words of a text apart")

    def learn(self, words: set[str], apart: set[str]) -> None:
        """Words as they are, and words that may come apart."""
        if len(self._known) > WORDS_KEPT:
            self._known.clear()
        parts = {w: self._parts(w) for w in apart.difference(self._known)}
        self._encode(list(words.union(*parts.values()).difference(self._known)))
        self._known.update((w, b"".join(self._known[x] for x in p)) for w, p in parts.items())

    def _encode(self, words: list[str]) -> None:
        for start in range(0, len(words), 10_000):
            part = words[start : start + 10_000]
            found = self._tokenizer.encode_batch_fast(part, add_special_tokens=False)
            self._known.update((w, array("I", e.ids).tobytes()) for w, e in zip(part, found))

    @staticmethod
    def _parts(word: str) -> tuple[str, ...]:
        """A word in one or two parts that the tokenizer treats apart: marks
        that follow a letter or digit are split off it. ASCII is lower-cased
        here, as the tokenizer does, so that fewer words are distinct."""
        if "<|" in word:  # special tokens are told by case
            return (word,)
        if word.isascii():
            word = word.lower()
        stem = word.rstrip(_TAIL)
        if len(stem) < len(word) and stem and stem[-1].lower()[-1].isalnum():
            return stem, word[len(stem) :]
        return (word,)

    def ids(self, text: str) -> bytes:
        """Ids of a text, as 32-bit little-endian integers."""
        return self.batch([text])[0]

    def batch(self, batch: list[str]) -> list[bytes]:
        """Where no special token may be, which case tells, ASCII is lower-cased
        and marks are set apart in the whole text at once."""
        split = [self._split(text) for text in batch]
        special = ["<|" in text for text in batch]
        self.learn(*(set().union(*(w for w, s in zip(split, special) if s == mark)) for mark in (False, True)))
        return [b"".join(map(self._known.__getitem__, words)) for words in split]

    @staticmethod
    def _split(text: str) -> list[str]:
        if "<|" not in text:
            text = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
            text = _MARKS_BEHIND.sub(r" \g<0>", text)
        return _SPACE.split(text) if _NO_SPACE.search(text) else text.split()


class Packer:
    """Packs one part. Pieces are (row, start, length, ids, sequence, offset)."""

    def __init__(self, window: int = WINDOW, open_windows: int = OPEN_WINDOWS) -> None:
        self.window, self.open_windows = window, open_windows
        self.level = np.zeros(window + 1, np.int64)  # windows open at each fill
        self.at_level: dict[int, list[int]] = {}
        self.held: dict[int, list[tuple]] = {}  # pieces of the open windows
        self.next = 0
        self.done: list[tuple] = []

    def _new(self) -> int:
        self.next += 1
        return self.next - 1

    def place(self, row, ids: np.ndarray) -> None:
        """One document."""
        whole = len(ids) // self.window * self.window
        for start in range(0, whole, self.window):
            self.done.append((row, start, ids[start : start + self.window], self._new(), 0))
        if whole < len(ids):
            self._place_item(row, whole, ids[whole:].copy())  # a view would keep the whole document

    def _place_item(self, row, start: int, ids: np.ndarray) -> None:
        size = len(ids)
        fill = self._best_level(size)
        if fill:
            window = self.at_level[fill].pop()
            self.level[fill] -= 1
        else:
            window = self._new()
            self.held[window] = []
        self.held[window].append((row, start, ids, window, fill))
        fill += size
        if fill == self.window:
            self.done.extend(self.held.pop(window))
        else:
            self.level[fill] += 1
            self.at_level.setdefault(fill, []).append(window)
            if len(self.held) > self.open_windows:
                self.even_out()

    def _best_level(self, size: int) -> int:
        """The level that makes the sum of squares least, the fullest of
        several. Twice the change is compared: moving a window from level h to
        h + size adds 2 (N[h + size] - N[h]) + 2; filling one takes away
        2 N[h] - 1; a new window adds 2 N[size] + 1."""
        top = self.window - size
        change = 2 * (self.level[size : self.window] - self.level[:top]) + 2
        change[0] = 2 * self.level[size] + 1
        change[1:][self.level[1:top] == 0] = np.iinfo(np.int64).max
        best = top - 1 - int(np.argmin(change[::-1]))
        if self.level[top] and 1 - 2 * self.level[top] <= change[best]:
            return top
        return best

    def even_out(self) -> None:
        """Fills up the open windows, fullest first, with what is in the
        emptiest: their pieces are cut to the gaps, and the others stay where
        the level rule has put them. What is left at last, less than a window,
        is cut into powers of two."""
        fill = {w: sum(len(p[2]) for p in pieces) for w, pieces in self.held.items()}
        order = sorted(fill, key=lambda w: (-fill[w], w))
        first, last, pool = 0, len(order) - 1, []
        while first <= last:
            window = order[first]
            pieces, at = self.held[window], fill[window]
            while at < self.window and (pool or first < last):
                if not pool:
                    pool = [p[:3] for p in self.held[order[last]]]
                    last -= 1
                row, start, ids = pool.pop()
                part = ids[: self.window - at]
                if len(part) < len(ids):
                    pool.append((row, start + len(part), ids[len(part) :]))
                pieces.append((row, start, part, window, at))
                at += len(part)
            if at < self.window:
                pool = [p[:3] for p in pieces]
            else:
                self.done.extend(pieces)
            first += 1
        self.held, self.at_level = {}, {}
        self.level[:] = 0
        self._in_powers_of_two(pool)

    def _in_powers_of_two(self, pieces: list[tuple]) -> None:
        left = sum(len(p[2]) for p in pieces)
        room = offset = 0
        for row, start, ids in pieces:
            while len(ids):
                if not room:
                    room = 1 << (left.bit_length() - 1)
                    left -= room
                    sequence, offset = self._new(), 0
                part = ids[:room]
                self.done.append((row, start, part, sequence, offset))
                ids, start = ids[len(part) :], start + len(part)
                room, offset = room - len(part), offset + len(part)

    def taken(self) -> list[tuple]:
        done, self.done = self.done, []
        return done


def packed(
    docs: DataFrame,
    tokenizer_path: str,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    end_id: int = END_ID,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: the key, start (ids of the document before it),
    length, ids (array, only with_ids), ids_crc32, doc_tokens, sequence_id and
    offset in the sequence. Every sequence is full or a power of two long."""
    definition = Path(tokenizer_path).read_text(encoding="utf-8")
    digest = hashlib.sha256(definition.encode()).hexdigest()
    kind = dict(docs.dtypes)[key]
    end = np.array([end_id], np.uint32).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = kept_in_stage(("packing words", digest), lambda: Words(definition))
        packer = Packer(window)
        first = TaskContext.get().partitionId() << 40
        key_type = None

        def rows() -> pa.RecordBatch:
            done = packer.taken()
            ids = [p[2] for p in done]
            columns = [
                pa.array([p[0][0] for p in done], key_type),
                pa.array([p[1] for p in done], pa.int64()),
                pa.array([len(x) for x in ids], pa.int64()),
                pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()),
                pa.array([p[0][1] for p in done], pa.int64()),
                pa.array([first + p[3] for p in done], pa.int64()),
                pa.array([p[4] for p in done], pa.int64()),
            ]
            names = ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                flat = np.concatenate(ids) if ids else np.zeros(0)
                columns.append(pa.ListArray.from_arrays(offsets, flat.astype(np.int32)))
                names.append("ids")
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            key_type = batch.schema.field(0).type
            keys = batch.column(0).to_pylist()
            for k, raw in zip(keys, words.batch(texts(batch.column(1)))):
                ids = np.frombuffer(raw + end, np.uint32)
                packer.place((k, len(ids)), ids)
            yield rows()
        packer.even_out()
        if packer.done:
            yield rows()
        give_back()

    more = ", ids array<int>" if with_ids else ""
    schema = (
        f"key {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        f"sequence_id bigint, offset bigint{more}"
    )
    return docs.select(key, text).mapInArrow(run, schema).withColumnRenamed("key", key)
