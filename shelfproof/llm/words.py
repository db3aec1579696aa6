"""Words and shingles of Arrow text columns, whole arrays at a time.

Texts are UTF-8 bytes here. Both word patterns in use name ASCII bytes only, so cutting at bytes
gives the same words as cutting at characters. Words are compared as whole byte strings (a
dictionary per block); their 64-bit hashes serve where values from different blocks meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

BLOCK_BYTES = 4 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def _table(*spans: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for low, high in spans:
        table[low:high + 1] = True
    return table


#: Bytes between words: white space, or all ASCII but digits and lower-case letters.
WHITE = _table((0x20, 0x20), (0x09, 0x0D))
NOT_ALNUM = _table((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after the other, and where each begins and the last ends."""
    column = column.fill_null("") if column.null_count else column
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    buffer = column.buffers()[2]
    data = np.zeros(0, np.uint8) if buffer is None else np.frombuffer(buffer, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about `limit` bytes of text, one row at least."""
    for batch in batches:
        _, offsets = text_bytes(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
            to = max(at + 1, min(to, batch.num_rows))
            yield batch.slice(at, to - at)
            at = to


class Words:
    """The words of a column of texts.

    ids: number of each word in `values`, in text order; bounds: where each text's words begin in
    `ids`, and where the last one's end; starts, ends: byte positions in the joined texts.
    """

    def __init__(self, column: pa.Array, between: np.ndarray = WHITE):
        data, offsets = text_bytes(column)
        low = LOWER[data]
        inside = ~between[low]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        edges = offsets[:-1][np.diff(offsets) > 0]
        first[edges] = inside[edges]
        last[edges[1:] - 1] = inside[edges[1:] - 1]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        self.bounds = np.searchsorted(self.starts, offsets)
        joined = np.zeros(len(self.starts) + 1, np.int64)
        np.cumsum(self.ends - self.starts, out=joined[1:])
        array = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(self.starts),
            [None, pa.py_buffer(joined), pa.py_buffer(low[inside])])
        coded = array.dictionary_encode()
        self.ids = coded.indices.to_numpy()
        self.values = coded.dictionary

    def hashes(self) -> np.ndarray:
        """The 64-bit hash of each distinct word."""
        digest = xxhash.xxh3_64_intdigest
        return np.fromiter(map(digest, self.values.to_pylist()), np.uint64, len(self.values))


def mix(values: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of `size` values, order counting; empty if there are fewer."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64)
    out = mix(hashes[:len(hashes) - size + 1] + np.uint64(size))
    for i in range(1, size):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[i:len(hashes) - size + 1 + i])
    return out


def shingle_sets(column: pa.Array, size: int,
                 between: np.ndarray = WHITE) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of `size` words.

    A text with fewer words has its whole sequence as one; a text without words has none.
    """
    words = Words(column, between)
    hashes = words.hashes()[words.ids] if len(words.ids) else np.zeros(0, np.uint64)
    runs = windows(hashes, size)
    for low, high in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist()):
        if high - low >= size:
            yield np.unique(runs[low:high - size + 1])
        elif high > low:
            yield windows(hashes[low:high], high - low)
        else:
            yield np.zeros(0, np.uint64)
