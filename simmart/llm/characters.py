"""Classes of Unicode characters as a table over all code points."""

from __future__ import annotations

import numpy as np

from simmart.llm.common import kept

LETTER, UPPER, DIGIT, SPACE, STOP, MARKS = 1, 2, 4, 8, 16, 32


def _table() -> np.ndarray:
    found = np.zeros(0x110000, np.uint8)
    for code in range(0x110000):
        c = chr(code)
        if c.isalpha():
            found[code] = LETTER | (UPPER if c.isupper() else 0)
        elif c.isdigit():
            found[code] = DIGIT
        elif c.isspace():
            found[code] = SPACE
    found[[ord(c) for c in ".,;:?'\"-()"]] = STOP
    found[[ord(c) for c in "!|*$%&#@<>{}[]=_~^/\\+"]] |= MARKS
    return found


def classes() -> np.ndarray:
    return kept(("characters",), _table)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
