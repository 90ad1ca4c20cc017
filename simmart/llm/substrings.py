"""Removal of repeated passages by prefix-partitioned suffix trees.

A passage repeats where a window of words occurs in a document with a smaller
key. Documents are dealt into chunks by key, and these steps follow:

1. Each chunk sends short fingerprints of its distinct windows, by value, to
   where those of all chunks meet; windows met in one chunk only are settled.
2. The suffixes that begin at the others are cut to the window, and sent to
   groups by a prefix of words. It ends with the first word that is not very
   frequent, so that it is the longer the more frequent its words are, and the
   groups fit into memory. A chunk sends a window once, with its smallest key.
3. A group sorts its suffixes into a tree. Edges are labelled by blocks of
   words of doubling length; inner nodes as deep as the window are the repeats,
   and the smallest key below a node settles which chunks must cut the window.
4. Each chunk marks the windows it was told, and those which an earlier
   document of its own holds, and cuts out the words that they cover. Marked
   windows that touch are one maximal repeat.

Steps 2 and 4 read the same shuffled texts as step 1, which are shuffled once.
Copies of a whole text are told by digest in step 1, and send no suffixes.

Null text has no words. Documents with a null key count as later than all
others, and not as earlier than one another, as rows with equal keys do. Keys
are integers. Only the named columns are read; the others may have any name.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from simmart.llm.common import blob, kept, partitions, per_batch, per_cogroup, per_group, prepared, texts
from simmart.llm.words import Hasher, among, distinct, from_sorted_blob, sorted_blob, utf8

WINDOW = 13
CHUNK_BYTES = 32 << 20  # of the texts of a chunk of documents
LAST = np.iinfo(np.int64).max  # stands for a null key
_FOUND = "bucket bigint, chunk bigint, hashes binary, copies binary, firsts binary"
_SUFFIXES = "grp bigint, chunk bigint, windows binary, edges binary, firsts binary, copies binary"
_MARKS = "chunk bigint, windows binary, copies binary"


def blocks(window: int) -> list[tuple[int, int]]:
    """First word and length of the edges from the root to a window's depth."""
    found, at, length = [], 0, 1
    while at < window:
        length = min(max(1, at), window - at)
        found.append((at, length))
        at += length
    return found


def _hasher() -> Hasher:
    return kept(("hasher",), Hasher)


class _Chunk:
    """The documents of a chunk in order of their keys, and their words."""

    def __init__(self, table: pa.Table, window: int) -> None:
        self.window = window
        keys = pc.fill_null(table.column("key").cast(pa.int64()), LAST).to_numpy()
        order = np.argsort(keys, kind="stable")
        self.table, self.keys = table.take(order), keys[order]
        self.data = [utf8(t) for t in texts(self.table.column("text").combine_chunks())]
        parsed = [_hasher().words(d) for d in self.data]
        self.words = [p[0] for p in parsed]
        self.bounds = [p[1:] for p in parsed]
        self.windows = [_hasher().runs(w, window) for w in self.words]
        digests = [xxhash.xxh3_128_digest(d) for d in self.data]
        self.digests = np.array(digests, "S16") if digests else np.zeros(0, "S16")
        first: dict[bytes, int] = {}
        for d, k in zip(digests, self.keys.tolist()):
            first.setdefault(d, k)
        self.first = first
        self.raw_digests = digests

    def flat(self, which: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Windows of some documents, with the documents' places."""
        if not which:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return (
            np.concatenate([self.windows[i] for i in which]),
            np.repeat(which, [len(self.windows[i]) for i in which]),
        )

    def originals(self, copies: set[bytes]) -> list[int]:
        """Documents that are no copy of one with a smaller key."""
        return [
            i
            for i, (d, k) in enumerate(zip(self.raw_digests, self.keys.tolist()))
            if d not in copies and self.first[d] == k
        ]


def _split(data: bytes) -> set[bytes]:
    return {data[i : i + 16] for i in range(0, len(data), 16)}


def _blobs(table: pa.Table, name: str) -> list[bytes]:
    return [x for x in table.column(name).to_pylist() if x is not None]


def heavy_words(docs: DataFrame, text: str, groups: int) -> np.ndarray:
    """Slots (of word hashes) that hold more than half a group's share of all
    words; two for each group at most."""
    slots = max(1 << 16, 32 * groups)

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        total = np.zeros(slots, np.int64)
        for t in texts(batch.column(0)):
            total += np.bincount((_hasher().words(utf8(t))[0] % np.uint64(slots)).astype(np.int64), minlength=slots)
        own = np.flatnonzero(total * 8 * groups > total.sum())
        return pa.RecordBatch.from_arrays(
            [pa.array([*own, -1], pa.int64()), pa.array([*total[own], total.sum()], pa.int64())], ["slot", "n"]
        )

    counts = per_batch(docs.select(text), count, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n"))
    everything = counts.where("slot = -1").select(F.col("n").alias("all"))
    total = (everything.first() or [0])[0]
    heavy = counts.where((F.col("slot") >= 0) & (F.col("n") * 2 * groups > F.lit(total)))
    return np.array(sorted(r.slot for r in heavy.select("slot").collect()), np.uint64)


def without_repeats(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    carry: tuple[str, ...] = (),
    with_text: bool = True,
) -> DataFrame:
    """One row per document: the key, the carried columns, n_words, n_removed,
    kept_sha256 (of the kept words joined by one space) and, with_text, kept
    (the text as it was if nothing was removed, else the kept words joined by
    one space) and repeats (first word and length of each maximal repeat)."""
    spark = prepared(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    chunks = max(2 * partitions(spark), -(-size // CHUNK_BYTES))
    n = groups = -(-chunks // 2)
    bits = min(64, 32 + (chunks - 1).bit_length())
    shift = np.uint64(64 - bits)
    edges = blocks(window)
    heavy = heavy_words(docs, text, groups)
    slots = np.uint64(max(1 << 16, 32 * groups))
    kinds = dict(docs.dtypes)

    chunk = F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("long"), F.xxhash64(text))), F.lit(chunks))
    dealt = docs.select(
        chunk.cast("long").alias("chunk"),
        F.col(key).alias("key"),
        F.col(text).alias("text"),
        *(F.col(c).alias(f"carried_{i}") for i, c in enumerate(carry)),
    ).repartition(n, "chunk")

    def fingerprints(table: pa.Table) -> pa.Table:
        own = _Chunk(table, window)
        number = table.column("chunk")[0].as_py()
        found = distinct(own.flat(own.originals(set()))[0] >> shift)
        step = -(-(1 << bits) // n)
        cuts = np.searchsorted(found, np.array([min(i * step, (1 << bits) - 1) for i in range(1, n)], np.uint64))
        parts = np.split(found, cuts)
        by: list[list[bytes]] = [[] for _ in range(n)]
        for d in own.first:
            by[int.from_bytes(d[:4], "little") % n].append(d)
        rows = [
            (i, sorted_blob(p), b"".join(ds), blob(np.array([own.first[d] for d in ds], np.int64)))
            for i, (p, ds) in enumerate(zip(parts, by))
            if len(p) or ds
        ]
        return pa.table(
            {
                "bucket": pa.array([r[0] for r in rows], pa.int64()),
                "chunk": pa.array([number] * len(rows), pa.int64()),
                "hashes": pa.array([r[1] for r in rows], pa.binary()),
                "copies": pa.array([r[2] for r in rows], pa.binary()),
                "firsts": pa.array([r[3] for r in rows], pa.binary()),
            }
        )

    def met_again(table: pa.Table) -> pa.Table:
        """For each chunk, its fingerprints that other chunks have too, and
        its texts of which another chunk has a smaller key."""
        numbers = table.column("chunk").to_pylist()
        hashes = [from_sorted_blob(b) for b in table.column("hashes").to_pylist()]
        values, counts = np.unique(np.concatenate(hashes), return_counts=True)
        values = values[counts > 1]
        texts_of = [
            list(zip((d[i : i + 16] for i in range(0, len(d), 16)), np.frombuffer(f, np.int64).tolist()))
            for d, f in zip(table.column("copies").to_pylist(), table.column("firsts").to_pylist())
        ]
        first: dict[bytes, int] = {}
        for pairs in texts_of:
            for d, k in pairs:
                first[d] = min(k, first.get(d, LAST))
        return pa.table(
            {
                "bucket": table.column("bucket"),
                "chunk": pa.array(numbers, pa.int64()),
                "hashes": pa.array([sorted_blob(h[among(values, h)]) for h in hashes], pa.binary()),
                "copies": pa.array([b"".join(d for d, k in p if first[d] < k) for p in texts_of], pa.binary()),
                "firsts": pa.array([b""] * len(numbers), pa.binary()),
            }
        )

    def suffixes(table: pa.Table, found: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table({c.split()[0]: [] for c in _SUFFIXES.split(", ")})
        own = _Chunk(table, window)
        number = table.column("chunk")[0].as_py()
        copies = _split(b"".join(_blobs(found, "copies")))
        hashes = [from_sorted_blob(b) for b in _blobs(found, "hashes")]
        again = np.sort(np.concatenate(hashes)) if hashes else np.zeros(0, np.uint64)
        values, keys, labels, routes = [], [], [], []
        for i in own.originals(copies):
            at = np.flatnonzero(among(again, own.windows[i] >> shift))
            if not len(at):
                continue
            words = own.words[i]
            values.append(own.windows[i][at])
            keys.append(np.full(len(at), own.keys[i]))
            labels.append(
                np.stack(
                    [_hasher().spans(words, at + skip, at + skip + size).astype(np.uint32) for skip, size in edges], 1
                )
            )
            # The next word that is not heavy ends the prefix.
            light = np.where(among(heavy, words % slots), len(words), np.arange(len(words)))
            upto = np.minimum(np.minimum.accumulate(light[::-1])[::-1][at], at + window - 1) + 1
            routes.append(_hasher().spans(words, at, upto) % np.uint64(groups))
        rows = []
        if values:
            value, first = np.unique(np.concatenate(values), return_index=True)
            key_, label, route = (np.concatenate(x)[first] for x in (keys, labels, routes))
            order = np.argsort(route, kind="stable")
            cuts = np.flatnonzero(np.diff(route[order])) + 1
            for part in np.split(order, cuts):
                rows.append((int(route[part[0]]), sorted_blob(value[part]), blob(label[part]), blob(key_[part]), b""))
        if copies:
            rows.append((number % groups, sorted_blob(np.zeros(0)), b"", b"", b"".join(sorted(copies))))
        columns = list(zip(*rows)) if rows else [[]] * 5
        return pa.table(
            {
                "grp": pa.array(columns[0], pa.int64()),
                "chunk": pa.array([number] * len(rows), pa.int64()),
                **{
                    name: pa.array(c, pa.binary())
                    for name, c in zip(("windows", "edges", "firsts", "copies"), columns[1:])
                },
            }
        )

    def tree(table: pa.Table) -> pa.Table:
        """Inner nodes as deep as the window, and for each chunk its windows
        below one that holds a smaller key than the chunk's own."""
        numbers = table.column("chunk").to_pylist()
        windows = [from_sorted_blob(b) for b in table.column("windows").to_pylist()]
        label = np.frombuffer(b"".join(table.column("edges").to_pylist()), np.uint32).reshape(-1, len(edges))
        keys = np.frombuffer(b"".join(table.column("firsts").to_pylist()), np.int64)
        earlier = np.zeros(len(keys), bool)
        if len(keys):
            order = np.lexsort(label.T[::-1])
            # Depth in words of the lowest node that a suffix shares with the one before it.
            same = np.logical_and.accumulate(label[order][1:] == label[order][:-1], axis=1)
            depth = same @ np.array([size for _, size in edges])
            starts = np.concatenate([[0], np.flatnonzero(depth < window) + 1])
            least = np.minimum.reduceat(keys[order], starts)
            earlier[order] = np.repeat(least, np.diff(starts, append=len(keys))) < keys[order]
        cuts = np.cumsum([len(w) for w in windows])[:-1]
        marked = [sorted_blob(w[e]) for w, e in zip(windows, np.split(earlier, cuts))]
        return pa.table(
            {
                "chunk": pa.array(numbers, pa.int64()),
                "windows": pa.array(marked, pa.binary()),
                "copies": table.column("copies"),
            }
        )

    def cut(table: pa.Table, marks: pa.Table) -> pa.Table:
        own = _Chunk(table, window)
        copies = _split(b"".join(_blobs(marks, "copies")))
        told = [from_sorted_blob(b) for b in _blobs(marks, "windows")]
        told = np.sort(np.concatenate(told)) if told else np.zeros(0, np.uint64)
        value, doc = own.flat(list(range(len(own.keys))))
        # Where each window first occurs in the chunk; the sort is stable.
        order = np.argsort(value, kind="stable")
        new = np.diff(value[order], prepend=np.uint64(0)) != 0
        if len(new):
            new[0] = True
        first = np.empty(len(value), np.int64)
        first[order] = doc[order][np.flatnonzero(new)][np.cumsum(new) - 1]
        marked = (own.keys[first] < own.keys[doc]) | among(told, value)
        cuts = np.cumsum([len(w) for w in own.windows])
        rows = []
        for i, end in enumerate(cuts):
            at = np.flatnonzero(marked[end - len(own.windows[i]) : end])
            if own.raw_digests[i] in copies:
                at = np.arange(len(own.windows[i]))
            rows.append(_cut_words(own.data[i], *own.bounds[i], at, window, with_text))
        n_words, n_removed, digest, kept_text, repeats = zip(*rows) if rows else [[]] * 5
        found = {
            "key": own.table.column("key"),
            **{f"carried_{i}": own.table.column(f"carried_{i}") for i in range(len(carry))},
            "n_words": pa.array(n_words, pa.int64()),
            "n_removed": pa.array(n_removed, pa.int64()),
            "kept_sha256": pa.array(digest, pa.string()),
        }
        if with_text:
            found["kept"] = pa.array(kept_text, pa.string())
            found["repeats"] = pa.array(repeats, pa.list_(pa.list_(pa.int64())))
        return pa.table(found)

    by_chunk = dealt.groupBy("chunk")
    found = per_group(per_group(by_chunk, fingerprints, _FOUND).groupBy("bucket"), met_again, _FOUND)
    sent = per_cogroup(by_chunk.cogroup(found.groupBy("chunk")), suffixes, _SUFFIXES)
    marks = per_group(sent.groupBy("grp"), tree, _MARKS)
    schema = f"key {kinds[key]}, " + "".join(f"carried_{i} {kinds[c]}, " for i, c in enumerate(carry))
    schema += "n_words bigint, n_removed bigint, kept_sha256 string"
    schema += ", kept string, repeats array<array<bigint>>" if with_text else ""
    result = per_cogroup(by_chunk.cogroup(marks.groupBy("chunk")), cut, schema)
    return result.withColumnsRenamed({"key": key, **{f"carried_{i}": c for i, c in enumerate(carry)}})


def _cut_words(data, starts, ends, at, window: int, with_text: bool) -> tuple:
    """Words, removed words, digest of the kept ones, text and repeats of a
    document of which windows begin `at` some words."""
    n = len(starts)
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + window, -1)
    covered = np.cumsum(steps[:-1]) > 0
    removed = int(covered.sum())
    keep = np.flatnonzero(~covered)
    # Bytes of the kept words, each with one more byte, which becomes the space.
    inside = np.zeros(len(data) + 2, np.int8)
    inside[starts[keep]] += 1
    inside[ends[keep] + 1] -= 1
    chosen = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    wide = np.append(data, np.uint8(32))
    wide[ends] = 32
    kept_bytes = wide[chosen][:-1].tobytes()
    digest = hashlib.sha256(kept_bytes).hexdigest()
    if not with_text:
        return n, removed, digest, None, None
    edge = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
    repeats = [[int(a), int(b - a)] for a, b in zip(edge[::2], edge[1::2])]
    raw = kept_bytes if removed else data.tobytes()
    return n, removed, digest, raw.decode("utf-8", "surrogatepass"), repeats
