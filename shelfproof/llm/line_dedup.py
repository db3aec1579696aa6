"""Repeated passages, found by shared lines and deleted by pairwise alignment.

1. Each line is hashed (white space at its ends apart). Keys are the lines of LINE_CHARS characters
   or more and, from each line up and down, the shortest run of adjacent lines that has BLOCK_CHARS
   characters. A text is paired with the first holder of each key that it shares, so the pairs of
   a key grow with its holders. Every line of a block that an earlier text has is in a run of
   that block, so each such line is met in a text that holds a whole block around it.
   Texts that are equal form a class, which goes on as one; its later rows pair with its first.
2. A pair is aligned by patience diff: lines that either text holds once are matched in the order
   that keeps most of them, matches are extended up and down, and the gaps between are aligned
   in the same way.
3. A run of aligned lines (blocks) with BLOCK_CHARS characters or more is deleted from the later
   document of the pair, by doc_id.

Only hashes and lengths of lines are joined; texts are read once more to apply the deletions. Null
texts count as empty and stay null. Rows that repeat an id are one document: the first text in
order counts as earlier. Rows without an id come after all others.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfproof.llm.graph import staged
from shelfproof.llm.words import blocks, mix

LINE_CHARS, BLOCK_CHARS = 20, 100
_STEP = 0x9E3779B97F4A7C15


def _hash(data: bytes) -> int:
    return xxhash.xxh3_64_intdigest(data) - 2 ** 63


def runs(hashes: list[int], sizes: list[int], least: int = BLOCK_CHARS) -> set[int]:
    """Names of the shortest runs of `least` characters that begin or end at each line.

    A run of one line has the line's hash; others are told by sums of powers, so that a run costs
    the same however many lines it has.
    """
    n = len(sizes)
    chars = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    if chars[-1] < least:
        return set()
    ends = np.searchsorted(chars, chars[:-1] + least)
    low, high = np.arange(n)[ends <= n], ends[ends <= n]
    up = np.flatnonzero(chars >= least)
    low = np.concatenate([low, np.searchsorted(chars, chars[up] - least, side="right") - 1])
    high = np.concatenate([high, up])
    powers = np.ones((2, n), np.uint64)
    powers[0, 1:], powers[1, 1:] = _STEP, pow(_STEP, -1, 2 ** 64)
    powers = np.multiply.accumulate(powers, axis=1)
    own = np.array(hashes, np.int64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(own.view(np.uint64) * powers[0], out=sums[1:])
    names = mix((sums[high] - sums[low]) * powers[1, low] + (high - low).astype(np.uint64))
    return set(np.where(high - low == 1, own[low], names.view(np.int64)).tolist())


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per row: doc_id, text's name, line hashes and lengths, keys (its long lines and its runs)."""
    schema = pa.schema([("doc_id", pa.int64()), ("name", pa.int64()), ("lines", pa.list_(pa.int64())),
                        ("sizes", pa.list_(pa.int32())), ("keys", pa.list_(pa.int64()))])
    for block in blocks(batches):
        rows = []
        for doc_id, text in zip(block.column("doc_id").to_pylist(), block.column("text").to_pylist()):
            lines = [line.strip() for line in (text or "").split("\n")]
            hashes = [_hash(line.encode()) for line in lines]
            sizes = [len(line) for line in lines]
            keys = list({h for h, n in zip(hashes, sizes) if n >= LINE_CHARS} | runs(hashes, sizes))
            rows.append((doc_id, _hash((text or "").encode()), hashes, sizes, keys))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest run of pairs that ascend in both places (pairs ascend in the first)."""
    tops: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for i, (_, y) in enumerate(pairs):
        k = bisect_left(tops, y)
        tops[k:k + 1] = [y]
        at[k:k + 1] = [i]
        back.append(at[k - 1] if k else -1)
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def patience(x: list[int], y: list[int]) -> list[tuple[int, int]]:
    """Aligned positions of two sequences, ascending."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(x), 0, len(y))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and x[a] == y[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and x[b - 1] == y[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a == b or c == d:
            continue
        once = [{}, {}]
        for places, values, low, high in ((once[0], x, a, b), (once[1], y, c, d)):
            for i in range(low, high):
                places[values[i]] = -1 if values[i] in places else i
        anchors = _increasing([(i, once[1][v]) for v, i in once[0].items()
                               if i >= 0 and once[1].get(v, -1) >= 0])
        edges = [*anchors, (b, d)] if anchors else []
        i, j = a, c
        for k, m in edges:
            todo.append((i, k, j, m))
            if (k, m) != (b, d):
                out.append((k, m))
            i, j = k + 1, m + 1
    return sorted(out)


def repeated(own: list[int], sizes: list[int], other: list[int], least: int = BLOCK_CHARS) -> list[int]:
    """Lines of the first sequence in aligned blocks of `least` characters or more."""
    out: list[int] = []
    run: list[int] = []
    last = (-2, -2)
    for i, j in [*patience(own, other), (-9, -9)]:
        if (i, j) != (last[0] + 1, last[1] + 1):
            if sum(sizes[k] for k in run) >= least:
                out += run
            run = []
        run.append(i)
        last = (i, j)
    return out


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names, gone = [], []
        for name, own, sizes, other in zip(*(
                batch.column(c).to_pylist() for c in ("name", "lines", "sizes", "other"))):
            found = repeated(own, sizes, other)
            if found:
                names.append(name)
                gone.append(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.int64()), pa.array(gone, pa.list_(pa.int32()))], names=["name", "gone"])


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches):
        texts, counts, cut, chars = [], [], [], []
        for text, gone in zip(block.column("text").to_pylist(), block.column("gone").to_pylist()):
            lines, drop = (text or "").split("\n"), set(gone or ())
            left = "\n".join(line for i, line in enumerate(lines) if i not in drop)
            texts.append(left if text is not None else None)
            counts.append(len(lines) if text else 0)
            cut.append(len(drop))
            chars.append(len(text or "") - len(left))
        yield pa.RecordBatch.from_arrays(
            [block.column("doc_id"), pa.array(counts, pa.int64()), pa.array(cut, pa.int64()),
             pa.array(chars, pa.int64()), pa.array(texts, pa.string())],
            names=["doc_id", "n_lines", "n_deleted", "chars_deleted", "text"])


def deduplicate(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_lines, n_deleted, chars_deleted, text (what is left).

    Takes doc_id (integer) and text.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    read = staged(rows.mapInArrow(
        _lines, "doc_id long, name long, lines array<long>, sizes array<int>, keys array<long>"))
    key = F.struct(F.coalesce("doc_id", F.lit(2 ** 63 - 1)).alias("id"), F.col("name").alias("name"))
    firsts = staged(read.groupBy("name").agg(F.min(key).alias("place")))
    # Keys of one row of each text; a key's first holder is its least place.
    held = read.join(firsts, "name").filter(key == F.col("place")) \
        .select("name", "place", F.explode("keys").alias("key")).distinct()
    holders = held.groupBy("key").agg(F.min("place").alias("holder"), F.count("*").alias("often")) \
        .filter("often > 1").select("key", "holder")
    pairs = held.join(holders, "key").filter(F.col("place") != F.col("holder")) \
        .select("name", F.col("holder.name").alias("first")).distinct()
    texts = read.select("name", "lines", "sizes").dropDuplicates(["name"])
    others = texts.select(F.col("name").alias("first"), F.col("lines").alias("other"))
    gone = pairs.join(texts, "name").join(others, "first").select("name", "lines", "sizes", "other") \
        .mapInArrow(_align, "name long, gone array<int>") \
        .groupBy("name").agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone"))
    # A later row of an equal text is aligned with the first as a whole.
    long = F.aggregate("sizes", F.lit(0), lambda a, n: a + n) >= BLOCK_CHARS
    every = F.when(long, F.sequence(F.lit(0), F.size("sizes") - 1))
    decided = read.join(firsts, "name").join(gone, "name", "left") \
        .withColumn("gone", F.when(key == F.col("place"), F.col("gone")).otherwise(every)) \
        .filter(F.size("gone") > 0) \
        .select(F.col("name").alias("_name"), F.col("doc_id").alias("_id"), "gone") \
        .dropDuplicates(["_name", "_id"])
    marked = rows.mapInArrow(_named, "doc_id long, text string, name long")
    return marked.join(decided, (F.col("name") == F.col("_name"))
                       & F.col("doc_id").eqNullSafe(F.col("_id")), "left") \
        .select("doc_id", "text", "gone") \
        .mapInArrow(_apply, "doc_id long, n_lines long, n_deleted long, chars_deleted long, text string")


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches):
        names = [_hash((t or "").encode()) for t in block.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [block.column("doc_id"), block.column("text"), pa.array(names, pa.int64())],
            names=["doc_id", "text", "name"])
