"""Substring fingerprints, bit text, packed words and Tanimoto.

A structure string is described by the set of its substrings of length
``1 .. radius + 1`` (the q-gram idea published for line notations as LINGO:
Vidal, Thormann & Pons, 2005), each hashed into one of ``n_bits`` positions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

RADIUS = 2
N_BITS = 2048
WORD = 64
BLOCK = 1 << 20  # code points hashed at a time
KNOWN = 1 << 18  # substrings whose hashes a task keeps


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once for use inside ``body``. A column captured by a
    lambda is evaluated again for every element; a lambda argument is not."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _heads(grams: list[str], known: dict[str, int]) -> np.ndarray:
    """The first 32 bits of the MD5 of each; ``known`` holds those of before."""
    for gram in grams:
        if gram not in known:
            known[gram] = int.from_bytes(hashlib.md5(gram.encode(), usedforsecurity=False).digest()[:4])
    return np.array([known[gram] for gram in grams], np.int64)


def _set_bits(texts: list[np.ndarray], max_len: int, n_bits: int, known: dict[str, int]) -> np.ndarray:
    """A row of flags for each text, given as its code points.

    Substrings are told apart by numbers: that of length n by the number of its
    first n - 1 code points and its last one. Each is hashed once a block.
    """
    points, row = np.concatenate(texts), np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    bits = np.zeros((len(texts), n_bits), bool)
    for start in range(0, len(points), BLOCK):
        part, own = (x[start : start + BLOCK + max_len - 1] for x in (points, row))
        number, grams = np.zeros(len(part), np.int64), [""]
        for n in range(1, min(max_len, len(part)) + 1):
            first, last = own[: len(part) - n + 1], own[n - 1 :]
            found = pa.array(number[: len(first)] << 21 | part[n - 1 :]).dictionary_encode()
            grams = [grams[code >> 21] + chr(code & 0x1FFFFF) for code in found.dictionary.to_pylist()]
            number = found.indices.to_numpy().astype(np.int64)
            at = first * n_bits + (_heads(grams, known) % n_bits)[number]
            bits.reshape(-1)[at[first == last]] = True
    return bits


def bit_positions(text: Column, radius: int = RADIUS, n_bits: int = N_BITS) -> Column:
    """Sorted distinct bit positions set by ``text``: those of all its
    substrings of up to radius + 1 code points. Texts are taken some at a time
    and long ones in blocks, so that a task's memory is bounded."""
    known: dict[str, int] = {}

    def substrings_md5(texts: pa.Array) -> pa.Array:
        values, sizes, waiting, n = [np.empty(0, np.int32)], [0], [], 0

        def flush() -> None:
            if len(known) > KNOWN:
                known.clear()
            if waiting:
                row, at = np.nonzero(_set_bits(waiting, radius + 1, n_bits, known))
                values.append(at.astype(np.int32))
                sizes.extend(np.bincount(row, minlength=len(waiting)).tolist())
                waiting.clear()

        for text in texts.cast(pa.large_binary()):
            waiting.append(np.frombuffer((text.as_py() or b"").decode("utf-8", "replace").encode("utf-32-le"), np.uint32))
            n += len(waiting[-1]) + n_bits
            if n >= BLOCK:
                flush()
                n = 0
        flush()
        offsets = pa.array(np.cumsum(sizes, dtype=np.int32))
        return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(values)), mask=texts.is_null())

    return F.arrow_udf(substrings_md5, "array<int>")(text)


def bit_text(positions: Column, n_bits: int = N_BITS) -> Column:
    """Text of '0' and '1' with a '1' at each (sorted, distinct) position."""

    def spell(found: pa.Array) -> pa.Array:
        flags = np.full((len(found), n_bits), ord("0"), np.uint8)
        row, at = pc.list_parent_indices(found).to_numpy(), pc.list_flatten(found).to_numpy()
        flags[row[at < n_bits], at[at < n_bits]] = ord("1")
        ends = pa.array(np.arange(len(found) + 1) * n_bits, pa.int32())
        texts = pa.StringArray.from_buffers(len(found), ends.buffers()[1], pa.py_buffer(flags))
        return pc.if_else(found.is_valid(), texts, pa.scalar(None, pa.string()))

    return F.arrow_udf(spell, "string")(positions)


def is_structure(text: Column) -> Column:
    """Default acceptance rule for a structure string: not empty, no white
    space, brackets balanced in number."""
    return F.coalesce(structure_fault(text).isNull(), F.lit(False))


def structure_fault(text: Column) -> Column:
    """Why the default rule refuses ``text``; null when it is accepted."""

    def uneven(opening: str, closing: str) -> Column:
        return F.regexp_count(text, F.lit(opening)) != F.regexp_count(text, F.lit(closing))

    return (
        F.when(text.isNull() | (text == ""), "empty")
        .when(text.rlike(r"\s"), "white space")
        .when(uneven(r"\(", r"\)"), "parentheses")
        .when(uneven(r"\[", r"\]"), "brackets")
    )


def fingerprint(
    text: Column,
    radius: int = RADIUS,
    n_bits: int = N_BITS,
    valid: Callable[[Column], Column] = is_structure,
) -> Column:
    """Bit text of a structure string, null when ``valid`` refuses it."""
    return bit_text(bit_positions(F.when(valid(text), text), radius, n_bits), n_bits)


def is_bit_text(bits: Column, n_bits: int | None = None) -> Column:
    """True for text of only 0 and 1, of the given width if there is one."""
    ok = bits.rlike(r"^[01]+\z")
    if n_bits is not None:
        ok = ok & (F.length(bits) == n_bits)
    return F.coalesce(ok, F.lit(False))


def pack(bits: Column, n_bits: int | None = None) -> Column:
    """Bit text as an array of 64-bit words, first character = highest bit of
    the first word. Null for anything that is no bit text."""

    def words(text: Column) -> Column:
        chunks = F.regexp_extract_all(text, F.lit("[01]{1,%d}" % WORD), 0)
        packed = F.transform(chunks, lambda c: F.conv(F.rpad(c, WORD, "0"), 2, -10).cast("bigint"))
        return F.when(is_bit_text(text, n_bits), packed)

    return let(bits, words)


def n_set(words: Column) -> Column:
    """Number of bits set in packed words."""
    return F.aggregate(words, F.lit(0), lambda acc, w: acc + F.bit_count(w))


def tanimoto(a: Column, b: Column) -> Column:
    """|a and b| / |a or b| of two packed fingerprints; two empty ones score 1."""
    both = F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseAND(y))), F.lit(0), lambda s, n: s + n)
    return let(
        F.struct(both.alias("i"), (n_set(a) + n_set(b)).alias("n")),
        lambda v: F.when(v["n"] == 0, F.lit(1.0)).otherwise(v["i"] / (v["n"] - v["i"])),
    )
