"""64-bit hashes of word shingles, computed in numpy inside Arrow tasks.

Words are the runs of bytes that are not ASCII white space, with A-Z
lower-cased. Two texts share a shingle when they share the words; the hashes
are 64 bits wide, so a false match of two given shingles has odds of 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from .coded import split_codes

#: A-Z to lower case, the white space of ASCII to spaces
_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + 5 * b" ")
_MUL = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX
    return h ^ (h >> np.uint64(27))


def _runs(hashes: np.ndarray, width: int) -> np.ndarray:
    if len(hashes) < width:
        return hashes[:0]
    out = np.full(len(hashes) - width + 1, width, dtype=np.uint64)
    for i in range(width):
        out = _mixed(out * _MUL + hashes[i : len(hashes) - width + 1 + i])
    return out


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``width`` words; of all words if fewer; none for none."""
    plain = [t.encode().translate(_PLAIN) if t else b"" for t in texts.to_pylist()]
    codes, offsets, words = split_codes(pc.split_pattern(pa.array(plain, pa.large_binary()), b" "))
    if not len(words):
        yield from (np.zeros(0, dtype=np.uint64) for _ in range(len(texts)))
        return
    own = np.array([xxhash.xxh3_64_intdigest(w) for w in words], dtype=np.uint64)
    real = np.array([len(w) > 0 for w in words])[codes]  # white space in a row leaves empty words
    hashes = own[codes][real]
    offsets = np.concatenate([[0], np.cumsum(real)])[offsets]
    whole = _runs(hashes, width)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        yield np.unique(whole[a : b - width + 1]) if b - a >= width else _runs(hashes[a:b], b - a) if b > a else hashes[:0]


def shingle_set(text: str | None, width: int) -> np.ndarray:
    return next(shingle_sets(pa.array([text], pa.large_string()), width))
