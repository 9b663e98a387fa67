"""Hashes of all words of many texts at once, on arrays."""

from __future__ import annotations

import numpy as np

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_STEP = 0x165667B19E3779F9
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# Fixed by a rule: one odd-looking value per byte.
_VALUES = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) ^ (
    np.arange(1, 257, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(29)
)
# Longer words are hashed in pieces, so that the table of powers stays small.
PIECE = 1 << 12


def mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


_POWERS = np.cumprod(np.append(np.uint64(1), np.full(PIECE - 1, _STEP, dtype=np.uint64)), dtype=np.uint64)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, A-Z lower-cased, and the number of words of each text."""
    lowered = [t.encode().lower() for t in texts]
    data = np.frombuffer(b"\n" + b"\n".join(lowered) + b"\n", dtype=np.uint8)
    white = _WHITE[data]
    begins = np.flatnonzero(white[:-1] & ~white[1:]) + 1
    text_ends = np.cumsum([len(x) + 1 for x in lowered])
    counts = np.diff(np.searchsorted(begins, np.concatenate([[0], text_ends]), side="right"))
    if not len(begins):
        return np.empty(0, dtype=np.uint64), counts
    ends = np.flatnonzero(~white[:-1] & white[1:]) + 1
    sizes = ends - begins
    letters = data[~white]
    first = np.cumsum(sizes) - sizes
    offset = np.arange(len(letters)) - np.repeat(first, sizes)
    terms = _VALUES.take(letters) * _POWERS.take(offset % PIECE)
    if sizes.max() > PIECE:
        terms *= mix((offset // PIECE).astype(np.uint64)) | np.uint64(1)
    return mix(np.add.reduceat(terms, first) + sizes.astype(np.uint64) * MULTIPLIER), counts
