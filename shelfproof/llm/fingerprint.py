"""Document fingerprints: bottom-k sketches of shingle hashes.

A shingle is a run of eight bytes of the UTF-8 text (a shorter text is one shingle). Eight bytes
are one 64-bit number, and the scrambling is one to one, so hashes of different runs never meet. A
sketch holds the k smallest distinct hashes. Sketches of parts merge into that of the whole (for
parts that overlap by seven bytes), and estimate resemblance, containment and the number of
distinct shingles; all three are exact while fewer than k hashes are held.

Null texts count as empty; an empty text has an empty sketch, which resembles only empty ones.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfproof.llm import ordered
from shelfproof.llm.words import mix, text_bytes

WIDTH = 8
SIZE = 128
EMPTY = np.zeros(0, np.uint64)


def shingles(data: np.ndarray) -> np.ndarray:
    """The hash of the shingle that begins at each byte."""
    if len(data) == 0:
        return EMPTY
    if len(data) < WIDTH:
        padded = np.zeros(WIDTH, np.uint8)
        padded[:len(data)] = data
        return mix(padded.view("<u8") ^ np.uint64(len(data) << 56))
    out = np.empty(len(data) - WIDTH + 1, np.uint64)
    raw = data.tobytes()
    for i in range(WIDTH):
        count = (len(raw) - i) // WIDTH
        if count:
            out[i::WIDTH] = np.frombuffer(raw, "<u8", count, i)
    return mix(out)


def sketch(hashes: np.ndarray, size: int = SIZE) -> np.ndarray:
    """The smallest distinct hashes, ascending."""
    if len(hashes) > 8 * size:  # most of a long text is above this bound
        bound = np.partition(hashes, 4 * size)[4 * size]
        low = np.unique(hashes[hashes <= bound])
        if len(low) >= size:
            return low[:size]
    return np.unique(hashes)[:size]


def merge(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> np.ndarray:
    """The sketch of both parts together."""
    return np.union1d(a, b)[:size]


def resemblance(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    """Estimated size of the intersection over that of the union."""
    if len(a) == 0 or len(b) == 0:
        return float(len(a) == len(b))
    both = merge(a, b, size)
    shared = np.intersect1d(a, b, assume_unique=True)
    return float(np.count_nonzero(shared <= both[-1]) / len(both))


def distinct(a: np.ndarray, size: int = SIZE) -> float:
    """Estimated number of distinct shingles."""
    return float(len(a)) if len(a) < size else (size - 1) / (float(a[size - 1]) / 2.0 ** 64)


def containment(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    """Estimated share of a's shingles that b has too."""
    if len(a) == 0:
        return 1.0
    shared = resemblance(a, b, size) * distinct(merge(a, b, size), size) if len(b) else 0.0
    return min(1.0, shared / distinct(a, size))


def to_text(a: np.ndarray) -> str:
    return base64.b64encode(a.astype("<u8").tobytes()).decode()


def from_text(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), "<u8")


def _edit(data: np.ndarray, following: np.ndarray) -> tuple[int, np.ndarray]:
    """Code points of a text; the text with its last half replaced from the following one."""
    begins = np.flatnonzero((data & 0xC0) != 0x80)
    chars, half = len(begins), len(begins) // 2
    kept = data[:begins[chars - half]] if half else data
    theirs = np.flatnonzero((following & 0xC0) != 0x80)
    taken = following[:theirs[half]] if half < len(theirs) else following
    return chars, np.concatenate([kept, taken])


SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_chars", T.LongType()),
    T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.StringType()),
    T.StructField("edited_fingerprint", T.StringType()),
    T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType()),
    T.StructField("n_distinct", T.DoubleType()), T.StructField("in_edited", T.DoubleType())])
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
    ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
    ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ("n_distinct", pa.float64()), ("in_edited", pa.float64())])
OUT_ROWS = 512


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come range by range in order, each range closed by a guest from the next one."""
    out: list[tuple] = []
    last = None  # (range, doc_id, bytes, sketch) of the row that waits for its successor
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        ids = batch.column("doc_id").to_pylist()
        ranges = batch.column(ordered.SHARD).to_pylist()
        guests = batch.column(ordered.GUEST).to_pylist()
        for i, (doc_id, at, guest) in enumerate(zip(ids, ranges, guests)):
            if guest and (last is None or last[0] != at):
                continue  # one guest is enough
            text = data[offsets[i]:offsets[i + 1]]
            own = sketch(shingles(text))
            if last is not None:
                chars, edited = _edit(last[2], text)
                other = sketch(shingles(edited))
                out.append((last[1], chars, hashlib.sha256(edited.tobytes()).hexdigest(),
                            to_text(last[3]), to_text(other), resemblance(last[3], other),
                            resemblance(last[3], own), distinct(last[3]),
                            containment(last[3], other)))
                if len(out) >= OUT_ROWS:
                    yield _rows(out)
                    out = []
            last = None if guest else (at, doc_id, text.copy(), own)
    if out:
        yield _rows(out)


def _rows(out: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*out), _ARROW)], schema=_ARROW)


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Per document its fingerprint, that of its edited text, and how like it others are.

    Takes doc_id (integer) and text. The edited text has the last half of the code points
    replaced by the first as many (or all) of the next document's; order is by doc_id, then
    text, rows without an id first, and the first follows the last. Repeated rows give a row each.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    dealt = ordered.with_next_heads(ordered.with_shards(rows, "doc_id"), "doc_id")
    return ordered.in_order(dealt, "doc_id", "text").mapInArrow(_compare, SCHEMA)
