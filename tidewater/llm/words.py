"""Words of a batch of texts as integer codes, split on ASCII bytes in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

WORD, BLANK, BORDER = 0, 1, 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
CHUNK_BYTES = 2_000_000


def byte_kinds(blanks: bytes, borders: bytes = b"") -> np.ndarray:
    kinds = np.full(256, WORD, np.uint8)
    kinds[list(blanks)] = BLANK
    kinds[list(borders)] = BORDER
    return kinds


class Words(NamedTuple):
    codes: np.ndarray  # per word, its place in ``values``
    values: pa.Array  # distinct words, binary
    text: np.ndarray  # per word, the number of its text
    piece: np.ndarray  # per word, a number that grows at every border byte and text


def words(texts: pa.Array, kinds: np.ndarray) -> Words:
    """The words of binary ``texts`` (no nulls) after lower-casing A-Z: runs of ``WORD`` bytes."""
    texts = texts.cast(pa.large_binary())
    _, at, raw = texts.buffers()
    off = np.frombuffer(at, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(raw, np.uint8)[off[0]:off[-1]] if raw is not None else np.empty(0, np.uint8)
    off = off - off[0]
    data = LOWER[data]
    kind = kinds[data]
    inside = kind == WORD
    cut = off[(off > 0) & (off < len(data))]
    before = np.concatenate(([False], inside[:-1]))
    before[cut] = False
    after = np.concatenate((inside[1:], [False]))
    after[cut - 1] = False
    if not len(data):
        before = after = inside
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    ends = np.concatenate(([0], np.cumsum(end - start))).astype(np.int64)
    packed = data[inside]
    spelled = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(packed)])
    coded = spelled.dictionary_encode()
    text = np.searchsorted(off, start, "right") - 1
    piece = np.cumsum(kind == BORDER, dtype=np.int64)[start] + text if len(start) else text
    return Words(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary, text, piece)


def chunks(batch: pa.RecordBatch, column: int, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of whole rows with about ``limit`` bytes in the binary ``column``."""
    texts = batch.column(column).cast(pa.large_binary())
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi
