"""Content-defined pieces of texts: where two texts share ``length`` bytes, they share an anchor.

Every window of ``length`` bytes has one anchor, the 32-byte string in it with the least hash (the
leftmost of ties), so equal windows have equal anchors at equal places. The windows of one anchor in a
text follow each other; together they cover a piece of at most ``2 * length - 32`` bytes. A window can be
repeated only where its anchor is.
"""

from __future__ import annotations

import numpy as np

from logsense.llm.texts import mix

_U64 = np.uint64
GRAM = 32
#: Bytes hashed at a time; a window's hashes stay in the processor's cache.
BLOCK = 1 << 17
_ODD = np.random.default_rng(20).integers(0, 2**63, 8, dtype=_U64) * _U64(2) + _U64(1)
_BYTE = mix(np.random.default_rng(21).integers(0, 2**63, 256, dtype=_U64))
_LOW = _U64((1 << 24) - 1)


def _gram_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all 32-byte and all 64-byte strings, each built from two of half the size."""
    h, width, gram = _BYTE[data], 1, None
    for factor in _ODD[:6]:
        h = h[:-width] * factor + h[width:]
        width *= 2
        if width == GRAM:
            gram = h
    return gram, h


def _least_in_windows(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive keys."""
    size = 1
    while size * 2 <= width:
        keys = np.minimum(keys[:-size], keys[size:])
        size *= 2
    return keys if size == width else np.minimum(keys[: len(keys) - (width - size)], keys[width - size :])


def pieces(text: bytes, length: int) -> np.ndarray:
    """The pieces of a text as rows (anchor hash, piece hash, start, number of windows), all uint64.

    A text shorter than ``length`` has none. Long texts are hashed in blocks that overlap by one window
    less a byte; a piece may be cut at a block's end, and then both parts keep their anchor, but the cut
    depends on the place in the text, so equal windows still meet by their anchor.
    """
    found = []
    with np.errstate(over="ignore"):
        for at in range(0, max(0, len(text) - length + 1), BLOCK):
            data = np.frombuffer(text, np.uint8, min(BLOCK + length - 1, len(text) - at), at)
            gram, wide = _gram_hashes(data)
            gram = mix(gram)
            keys = (gram & ~_LOW) | np.arange(len(gram), dtype=_U64)
            place = _least_in_windows(keys, length - GRAM + 1) & _LOW
            starts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
            counts = np.diff(np.concatenate([starts, [len(place)]]))
            ends = starts + counts + length - 1
            middle = starts + (ends - starts - 64) // 2
            whole = mix(wide[starts] * _ODD[6] + wide[middle] * _ODD[7] + mix(wide[ends - 64] + counts.astype(_U64)))
            found.append(np.stack([gram[place[starts].astype(np.int64)], whole, (starts + at).astype(_U64), counts.astype(_U64)], 1))
    return np.concatenate(found) if found else np.empty((0, 4), _U64)
