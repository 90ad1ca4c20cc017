"""SentencePiece BPE with byte fallback: encoding by vectorised merge rounds, and decoding.

A text becomes words at its spaces, since no piece of such a model holds a
space mark after another character (checked when a model is read). The words
not met before are encoded together: their symbols lie in one flat array; in
each round every word's minimum pair rank is taken over its segment, the pairs
of that rank are merged from the left at the same time, and the array is
compacted, until no pair of the vocabulary remains. Segments of over LONG
symbols without any cut are merged by a queue instead.

The library merges one pair at a time, the best score first and the leftmost
among equals. Merging equal pairs at once gives the same unless the new piece
can itself join into a piece of a better (or an equal) score; for such pieces,
known from the vocabulary, a round merges the leftmost pair only.

Null and empty texts have no ids and decode to the empty text. Rows keep their
multiplicity; only the named columns are read.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from simmart.llm.common import kept, per_batch, texts

MARK = "▁"  # stands for a space
LONG = 2_000  # symbols of a segment above which a queue replaces the rounds
WORDS_KEPT = 800_000  # encoded words a worker holds, some 170 MB
CHUNK_CHARS = 4_000_000  # characters split into words at a time
_NONE = np.iinfo(np.int32).max


class Pieces:
    """A model's vocabulary as arrays."""

    def __init__(self, model: bytes) -> None:
        import sentencepiece

        reader = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = reader.get_piece_size()
        names = [reader.id_to_piece(i) for i in range(n)]
        special = [reader.is_unknown(i) or reader.is_control(i) or reader.is_byte(i) for i in range(n)]
        normal = [i for i in range(n) if not special[i]]
        byte_ids = {int(names[i][3:5], 16): i for i in range(n) if reader.is_byte(i)}
        if len(byte_ids) != 256:
            raise ValueError("a model with byte fallback is needed")
        if any(MARK in names[i].lstrip(MARK) for i in normal):
            raise ValueError("the model has pieces that reach over a space")
        self.n = n
        self._pair_dict: dict[int, tuple[int, int]] | None = None
        self._char_ids(names, normal)
        self._pairs(reader, names, normal)
        self._reach(names, normal, {i: reader.get_score(i) for i in normal})
        self._word_pattern(reader, names, normal)
        self._byte_ids = np.array([byte_ids[b] for b in range(256)], np.int32)
        self._spell = _Strings([b"" if special[i] else names[i].replace(MARK, " ").encode() for i in range(n)])
        for b, i in byte_ids.items():
            self._spell.replace(i, bytes([b]))
        self._decimal = _Strings([b"%d," % i for i in range(n)])
        probe = "  To be,  or\tnot\n\n to é中\U0001f600be <s> a▁b  "
        if self.encode([probe])[0].tolist() != reader.encode(probe):
            raise ValueError("the model normalises texts or is not BPE")

    def _char_ids(self, names: list[str], normal: list[int]) -> None:
        """Symbols: ids of pieces, then n + code point for other characters."""
        self._of_char = np.arange(self.n, self.n + 0x110000, dtype=np.int32)
        self._symbol = {names[i]: i for i in normal}
        for name, i in self._symbol.items():
            if len(name) == 1:
                self._of_char[ord(name)] = i
        for char in {c for name in self._symbol for c in name}:
            self._symbol.setdefault(char, self.n + ord(char))

    def _pairs(self, reader, names: list[str], normal: list[int]) -> None:
        """Sorted pairs of symbols with rank, merged symbol, and whether only
        the leftmost of several may be merged in a round."""
        score = {i: reader.get_score(i) for i in normal}
        rank = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        found, risky = [], set()
        for i in normal:
            name = names[i]
            for cut in range(1, len(name)):
                left, right = self._symbol.get(name[:cut]), self._symbol.get(name[cut:])
                if left is not None and right is not None:
                    found.append((left * (self.n + 0x110000) + right, rank[score[i]], i))
                    risky.update(x for x in (left, right) if x < self.n and score[x] <= score[i])
        found.sort()
        keys, ranks, merged = zip(*found)
        # One more entry stands for "no such pair".
        self._keys = np.array([*keys, np.iinfo(np.int64).max], np.int64)
        self._ranks = np.array([*ranks, _NONE], np.int32)
        self._merged = np.array([*merged, -1], np.int32)
        # Pieces of one score are merged one at a time too, whichever they are.
        pieces_of = np.bincount([rank[score[i]] for i in normal], minlength=len(rank))
        self._serial = np.isin(self._merged, list(risky)) | np.append(pieces_of[self._ranks[:-1]] > 1, False)

    def _reach(self, names: list[str], normal: list[int], score: dict[int, float]) -> None:
        """Character pairs that stand together in any piece: elsewhere a word
        can be cut. And how many characters the pieces have at most that a
        piece may grow into at once; beyond twice that, two places of a word
        do not affect each other."""
        inner = {ord(a) << 21 | ord(b) for i in normal for a, b in zip(names[i], names[i][1:])}
        self._together = np.array(sorted(inner), np.int64)
        reach = np.zeros(self.n, np.int32)
        for i in normal:
            name = names[i]
            for start in range(len(name)):
                for end in range(start + 1, len(name) + 1):
                    part = self._symbol.get(name[start:end], self.n)
                    if part < self.n and score[part] <= score[i]:
                        reach[part] = max(reach[part], len(name))
        self._apart = 2 * reach[self._merged]

    def _word_pattern(self, reader, names: list[str], normal: list[int]) -> None:
        """Words start with their space marks; a line end is a word of its own
        if no piece holds one. Pieces of marks alone that share one score below
        all others fill a long run of marks from the left, the longest each
        time, so that full ones are split off (but for the last mark, which may
        belong to the letters that follow)."""
        run = [i for i in normal if len(names[i]) > 1 and not names[i].strip(MARK)]
        sizes, scores = sorted(len(names[i]) for i in run), {reader.get_score(i) for i in run}
        lowest = min(reader.get_score(i) for i in normal)
        whole = run and scores == {lowest} and sizes == list(range(2, len(run) + 2))
        split = f"{MARK}{{{len(run) + 1}}}(?={MARK})|" if whole else ""
        line = "" if any("\n" in names[i] for i in normal) else "\n"
        self._words = re.compile(f"{split}{MARK}*[^{MARK}{line}]+|{line}|{MARK}+" if line else f"{split}{MARK}*[^{MARK}]+|{MARK}+")

    def words(self, text: str) -> list[str]:
        return self._words.findall(MARK + text.replace(" ", MARK)) if text else []

    def _pair_at(self, symbols: np.ndarray, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Entries of the pairs that begin at the given places."""
        last = len(self._keys) - 1
        right = np.minimum(at + 1, len(symbols) - 1)
        key = symbols[at].astype(np.int64) * (self.n + 0x110000) + symbols[right]
        entry = np.searchsorted(self._keys, key)
        good = (self._keys[entry] == key) & (word[at] == word[right]) & (right > at)
        return np.where(good, entry, last).astype(np.int32)

    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each word."""
        if not words:
            return []
        flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        place = np.arange(len(flat), dtype=np.int32)
        symbols = self._of_char[flat]
        # Segments: words, cut where no piece can reach over.
        starts = np.zeros(len(flat), bool)
        starts[np.cumsum(lengths) - lengths] = True
        starts[1:] |= ~_among(self._together, flat[:-1].astype(np.int64) << 21 | flat[1:])
        segment = np.cumsum(starts, dtype=np.int32)
        done_place, done_symbol = [], []
        sizes = np.bincount(segment)
        if sizes.max() > LONG:
            long = sizes[segment] > LONG
            for s in np.flatnonzero(sizes > LONG):
                own = place[segment == s]
                kept_at, kept_symbols = self._queued(symbols[own].tolist())
                done_place.append(own[kept_at])
                done_symbol.append(np.array(kept_symbols, np.int32))
            symbols, segment, place = symbols[~long], segment[~long], place[~long]
        entry = self._pair_at(symbols, segment, np.arange(len(symbols)))
        while len(symbols):
            first = np.flatnonzero(np.diff(segment, prepend=-1))
            size = np.diff(first, append=len(segment))
            rank = self._ranks[entry]
            best = np.minimum.reduceat(rank, first)
            over = best == _NONE
            if over.any():
                over_at = np.repeat(over, size)
                done_place.append(place[over_at])
                done_symbol.append(symbols[over_at])
                left = ~over_at
                symbols, segment, entry, rank, place = (x[left] for x in (symbols, segment, entry, rank, place))
                size, best = size[~over], best[~over]
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == np.repeat(best, size))
            at = at[self._leftmost(at, segment[at], entry[at])]
            symbols[at] = self._merged[entry[at]]
            stays = np.ones(len(symbols), bool)
            stays[at + 1] = False
            at -= np.arange(len(at))  # each merge before it removed one symbol
            symbols, segment, entry, place = (x[stays] for x in (symbols, segment, entry, place))
            entry[at] = self._pair_at(symbols, segment, at)
            before = at[at > 0] - 1
            entry[before] = self._pair_at(symbols, segment, before)
        place, symbols = np.concatenate(done_place), np.concatenate(done_symbol)
        # Symbols go back to the place of their first character.
        line = np.full(len(flat), -1, np.int32)
        line[place] = symbols
        word = np.repeat(np.arange(len(words)), lengths)[line >= 0]
        symbols = line[line >= 0]
        counts = np.bincount(word, minlength=len(words))
        cuts = np.cumsum(counts)
        odd = set(np.unique(np.repeat(np.arange(len(words)), counts)[symbols >= self.n]).tolist())
        return [
            self._spelled(symbols[e - c : e]) if i in odd else symbols[e - c : e]
            for i, (e, c) in enumerate(zip(cuts.tolist(), counts.tolist()))
        ]

    def _leftmost(self, at: np.ndarray, segment: np.ndarray, entry: np.ndarray) -> np.ndarray:
        """Which of the places merge in this round: in a row of neighbours
        every other one; of those that merge one at a time, the first of the
        segment and any that has none within reach before it."""
        order = np.arange(len(at))
        gap = np.diff(at, prepend=-2)
        every_other = (order - np.maximum.accumulate(np.where(gap > 1, order, 0))) % 2 == 0
        alone = (np.diff(segment, prepend=-1) > 0) | (gap > self._apart[entry])
        return every_other & (alone | ~self._serial[entry])

    def _queued(self, symbols: list[int]) -> tuple[list[int], list[int]]:
        """One very long segment: best pair first, from a queue. There the
        places that merge one at a time would need as many rounds."""
        if self._pair_dict is None:
            self._pair_dict = dict(zip(self._keys.tolist(), zip(self._ranks.tolist(), self._merged.tolist())))
        n, width = len(symbols), self.n + 0x110000
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue: list[tuple[int, int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (pair := self._pair_dict.get(symbols[i] * width + symbols[j])):
                queue.append((pair[0], i, symbols[i], symbols[j], pair[1]))

        for i in range(n):
            offer(i)
        heapq.heapify(queue)
        while queue:
            _, i, left, right, merged = heapq.heappop(queue)
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue
            symbols[i], symbols[j], after[i] = merged, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0:
                    known = len(queue)
                    offer(k)
                    if len(queue) > known:
                        heapq.heappush(queue, queue.pop())
        at = [i for i in range(n) if symbols[i] >= 0]
        return at, [symbols[i] for i in at]

    def _spelled(self, symbols: np.ndarray) -> np.ndarray:
        """Characters outside the vocabulary as the ids of their bytes."""
        ids = []
        for s in symbols.tolist():
            if s < self.n:
                ids.append(s)
            else:
                ids.extend(self._byte_ids[list(chr(s - self.n).encode("utf-8", "surrogatepass"))].tolist())
        return np.array(ids, np.int32)

    def encode(self, batch: list[str], cache: dict[str, bytes] | None = None) -> list[np.ndarray]:
        """Ids of each text. cache: bytes of the ids of words met before."""
        cache = {} if cache is None else cache
        found: list[np.ndarray] = []
        for chunk in _chunks(batch):
            split = [self.words(t) for t in chunk]
            needed = set().union(*split)
            if len(cache) > WORDS_KEPT:
                cache.clear()
            missing = list(needed - cache.keys())
            cache.update(zip(missing, (x.tobytes() for x in self.encode_words(missing))))
            found.extend(np.frombuffer(b"".join(map(cache.__getitem__, w)), np.int32) for w in split)
        return found

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, without the space put before its first word."""
        text = self._spell.joined(ids).tobytes().decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text

    def decimals(self, ids: np.ndarray) -> bytes:
        """Decimal ids, joined by commas."""
        return self._decimal.joined(ids)[:-1].tobytes()


class _Strings:
    """Byte strings in one flat array, joined by gathering."""

    def __init__(self, strings: list[bytes]) -> None:
        self._list = strings
        self._flat: np.ndarray | None = None

    def replace(self, i: int, string: bytes) -> None:
        self._list[i], self._flat = string, None

    def joined(self, ids: np.ndarray) -> np.ndarray:
        if self._flat is None:
            self._flat = np.frombuffer(b"".join(self._list), np.uint8)
            self._size = np.array([len(s) for s in self._list], np.int64)
            self._start = np.cumsum(self._size) - self._size
        size = self._size[ids]
        ends = np.cumsum(size)
        if not len(ids) or not ends[-1]:
            return np.zeros(0, np.uint8)
        return self._flat[np.arange(ends[-1]) + np.repeat(self._start[ids] - ends + size, size)]


def _among(ordered: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


def _chunks(batch: list[str]):
    start = n = 0
    for i, text in enumerate(batch):
        n += len(text)
        if n >= CHUNK_CHARS:
            yield batch[start : i + 1]
            start, n = i + 1, 0
    if start < len(batch):
        yield batch[start:]


def encoded(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text", with_ids: bool = True) -> DataFrame:
    """Ids of every text and the text they decode to.

    Columns: the key, ids (array of int, only with_ids), n_tokens, ids_sha256
    (of the decimal ids joined by commas), decoded (only with_ids) and
    decoded_sha256. The model file is read here and sent along with the tasks;
    its size is that of a vocabulary.
    """
    model = Path(model_path).read_bytes()
    digest = hashlib.sha256(model).hexdigest()
    kind = dict(docs.dtypes)[key]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        pieces = kept(("pieces", digest), lambda: Pieces(model))
        cache = kept(("pieces words", digest), dict)
        ids = pieces.encode(texts(batch.column(1)), cache)
        decoded = [pieces.decode(x) for x in ids]
        columns = [
            batch.column(0),
            pa.array([len(x) for x in ids], pa.int64()),
            pa.array([hashlib.sha256(pieces.decimals(x)).hexdigest() for x in ids]),
            pa.array([hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in decoded]),
        ]
        names = ["key", "n_tokens", "ids_sha256", "decoded_sha256"]
        if with_ids:
            offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            columns += [pa.ListArray.from_arrays(offsets, np.concatenate(ids).astype(np.int32)), pa.array(decoded)]
            names += ["ids", "decoded"]
        return pa.RecordBatch.from_arrays(columns, names)

    more = ", ids array<int>, decoded string" if with_ids else ""
    found = per_batch(
        docs.select(key, text), run, f"key {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string{more}"
    )
    return found.withColumnRenamed("key", key)
