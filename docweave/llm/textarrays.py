"""Words of Arrow text columns as numpy arrays, used inside tasks.

Works on the UTF-8 bytes of a whole batch at once.  A word is a run of bytes
other than space and 9 to 13, which is the same as a run of such characters.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from docweave.llm import common

#: Bytes hashed at a time: bounds the temporary arrays, also for one long text.
CHUNK_BYTES = 2 << 20
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_PRIME = 0x9E3779B97F4A7C15 | 1


def slices(lengths: np.ndarray, most: int):
    """Row ranges whose lengths sum to at most ``most``, or of one row."""
    start, total = 0, 0
    for i, n in enumerate(lengths):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += int(n)
    if start < len(lengths):
        yield start, len(lengths)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offsets where each begins and ends; null is empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``data[start:end]`` for rising, non-empty, disjoint runs."""
    out = np.zeros(len(starts), np.uint64)
    if not len(starts):
        return out
    powers = np.cumprod(np.full(int((ends - starts).max()), _PRIME, np.uint64))
    cuts = [0, *(np.searchsorted(starts, np.arange(CHUNK_BYTES, len(data), CHUNK_BYTES))), len(starts)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if a == b:
            continue
        s, n = starts[a:b], ends[a:b] - starts[a:b]
        first = np.cumsum(n) - n
        within = np.arange(n.sum()) - np.repeat(first, n)
        at = within + np.repeat(s, n)
        out[a:b] = np.add.reduceat((data[at].astype(np.uint64) + np.uint64(1)) * powers[within], first) + n.astype(np.uint64)
    return mix(out)


#: Fixed ranges of code points of scripts written without spaces: Thai and Lao,
#: Myanmar, Khmer, CJK radicals to ideographs with kana, compatibility
#: ideographs, and the supplementary ideographic planes.
UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))


def unspaced(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and byte lengths of the characters of scripts without spaces."""
    lead = np.flatnonzero(data >= 0xE0)
    lead = lead[lead + np.where(data[lead] >= 0xF0, 3, 2) < len(data)]
    size = np.where(data[lead] >= 0xF0, 4, 3)
    low = lambda k: (data[lead + k] & 0x3F).astype(np.int64)
    point = ((data[lead] & 0x0F).astype(np.int64) << 12) | (low(1) << 6) | low(2)
    four = size == 4
    if four.any():
        wide = lead[four]
        point[four] = ((data[wide] & 7).astype(np.int64) << 18) | ((data[wide + 1] & 0x3F).astype(np.int64) << 12) | (
            (data[wide + 2] & 0x3F).astype(np.int64) << 6) | (data[wide + 3] & 0x3F)
    found = np.zeros(len(lead), bool)
    for a, b in UNSPACED:
        found |= (point >= a) & (point <= b)
    return lead[found], size[found]


def words(data: np.ndarray, offsets: np.ndarray, cut_scripts: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the number of the first word of each
    text (one more than texts).  With ``cut_scripts``, characters of scripts
    without spaces are words of their own."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    solid = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    if cut_scripts:
        at, size = unspaced(data)
        edge[at] = edge[at + size] = True
    before, after = np.empty_like(solid), np.empty_like(solid)
    before[0], before[1:] = True, ~solid[:-1]
    after[-1], after[:-1] = True, ~solid[1:]
    starts = np.flatnonzero(solid & (before | edge[:-1]))
    ends = np.flatnonzero(solid & (after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


common.by_value(__name__)
