"""Sets of hashed word shingles of whole texts, in numpy, a chunk of texts at a time."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are hashed at a time.
CHUNK_BYTES = 1 << 20
#: Bytes whose places and values are held at a time, however long a text or word is.
WINDOW_BYTES = 1 << 21
#: Places of a word with a value of their own; later ones take these again, times a factor for each round.
PLACES = 1 << 16
_U = np.uint64


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return np.random.default_rng(101).integers(0, 1 << 64, 256, _U)


@lru_cache(maxsize=1)
def _place_values() -> np.ndarray:
    return np.random.default_rng(102).integers(0, 1 << 64, PLACES, _U) | _U(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _weights(within: np.ndarray) -> np.ndarray:
    """Odd factors for places within a word."""
    if not len(within) or int(within.max()) < PLACES:
        return _place_values()[within]
    # mix(0) is 0, so the first round's factor is 1
    return _place_values()[within & (PLACES - 1)] * (mix((within >> 16).astype(_U) << _U(1)) | _U(1))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts in order, A-Z in lower case, and each text's first word (one more at
    the end). Words are what stands between the bytes 9 to 13 and 32; one that crosses windows is summed piece by
    piece, so memory beside the texts and hashes is that of a window."""
    joined = np.frombuffer(b"\n".join([*texts, b""]).lower(), np.uint8)
    starts, sizes, sums = [], [], []
    carried = 0  # bytes so far of the word that is open where a window begins
    for low in range(0, len(joined), WINDOW_BYTES):
        part = joined[low : low + WINDOW_BYTES]
        space = (part == 32) | ((part >= 9) & (part <= 13))
        edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).astype(np.int8)))
        begin, size = edge[::2], edge[1::2] - edge[::2]
        if not len(begin):
            carried = 0
            continue
        before = np.cumsum(size) - size
        within = np.arange(size.sum()) - np.repeat(before, size)
        goes_on = int(carried > 0 and begin[0] == 0)
        if goes_on:
            within[: size[0]] += carried
        total = np.add.reduceat(_byte_values()[part[~space]] * _weights(within), before)
        if goes_on:
            sums[-1][-1:] += total[:1]
            sizes[-1][-1] += size[0]
        if len(begin) > goes_on:
            starts.append(begin[goes_on:] + low)
            sizes.append(size[goes_on:])
            sums.append(total[goes_on:])
        carried = 0 if space[-1] else int(sizes[-1][-1])
    offsets = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts]))).astype(np.int64)
    if not starts:
        return np.empty(0, _U), np.zeros(len(offsets), np.int64)
    hashes = mix(np.concatenate(sums) + np.concatenate(sizes).astype(_U) * _U(0x9E3779B97F4A7C15))
    return hashes, np.searchsorted(np.concatenate(starts), offsets)


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its shingles of `width` words; of a text with fewer words, that of all
    its words as one; nothing for a text without words."""
    words, first = word_hashes(texts)
    rolled = np.zeros(max(0, len(words) - width + 1), _U)
    factors = np.random.default_rng(103).integers(0, 1 << 64, width, _U) | _U(1)
    for k in range(width):
        rolled += words[k : k + len(rolled)] * factors[k]
    rolled = mix(rolled)
    out = []
    for low, high in zip(first[:-1], first[1:]):
        n = high - low
        if n >= width:
            out.append(np.unique(rolled[low : high - width + 1]))
        elif n:
            out.append(mix((words[low:high] * factors[:n]).sum(keepdims=True, dtype=_U) + _U(n)))
        else:
            out.append(np.empty(0, _U))
    return out


def text_chunks(batch: pa.RecordBatch, column: int, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts as bytes) of up to chunk_bytes; null is empty, a longer text a chunk of its own. Only one
    chunk's texts are held as Python objects."""
    values = batch.column(column).cast(pa.binary())
    if not len(values):
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(values), 0))
    start, held = 0, 0
    for k, size in enumerate([*sizes.tolist(), None]):
        if size is None or (k > start and held + size > chunk_bytes):
            yield start, [x or b"" for x in values.slice(start, k - start).to_pylist()]
            start, held = k, 0
        held += size or 0
