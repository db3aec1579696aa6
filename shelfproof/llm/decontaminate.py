"""Benchmark decontamination with suffix arrays of the training documents.

Documents are read in shards of a few MB; each shard gets the sorted order of all its word
suffixes (prefix doubling, down to the longest benchmark item). Every suffix of every benchmark
item is then looked up by binary search, which gives all verbatim occurrences of its first
`window` words. Occurrences that follow one another along both texts join into longest matches.
No shard meets another, so nothing is shuffled; the benchmark travels to the shards in blocks.

Null or empty texts have no words: such documents have no match, such items match nothing. An item
with fewer words than the window is matched as a whole. Repeated documents get a row each;
repeated items count once. Documents above a shard's size become a shard of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfproof.llm.words import NOT_ALNUM, Words, blocks

WINDOW = 10
#: Bytes of benchmark text that the driver holds and sends at a time.
QUERY_BYTES = 8 << 20

MATCH = T.StructType([
    T.StructField("item_id", T.StringType()), T.StructField("doc_word", T.IntegerType()),
    T.StructField("item_word", T.IntegerType()), T.StructField("n_words", T.IntegerType())])
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()), T.StructField("item_ids", T.ArrayType(T.StringType())),
    T.StructField("matches", T.ArrayType(MATCH))])
_MATCH = pa.struct([("item_id", pa.string()), ("doc_word", pa.int32()),
                    ("item_word", pa.int32()), ("n_words", pa.int32())])
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()),
                    ("item_ids", pa.list_(pa.string())), ("matches", pa.list_(_MATCH))])


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """Positions in order of what follows them, compared over `depth` words at least.

    words: numbers from 0. A suffix that ends sorts before those that go on.
    """
    n = len(words)
    rank = words.astype(np.uint64) + np.uint64(1)
    bits = max(int(max(n + 1, int(rank.max(initial=0)) + 1)).bit_length(), 1)
    index = np.arange(n, dtype=np.uint64)
    order, reach = None, 0
    while True:
        # By the rank over `reach` words, then by the rank of what follows these.
        after = np.zeros(n, np.uint64)
        if reach:
            after[:n - reach] = rank[reach:]
        key = (rank << np.uint64(bits)) | after if reach else rank
        if (3 if reach else 2) * bits <= 64:
            packed = np.sort((key << np.uint64(bits)) | index)
            order = (packed & np.uint64((1 << bits) - 1)).astype(np.int64)
            ranked = packed >> np.uint64(bits)
        else:
            order = np.argsort(key, kind="stable")
            ranked = key[order]
        reach = 2 * reach if reach else 1
        fresh = np.ones(n, np.uint64)
        fresh[1:] = ranked[1:] != ranked[:-1]
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(fresh)
        if reach >= min(depth, n) or (n and int(rank[order[-1]]) == n):
            return order


class Queries:
    """The suffixes of benchmark items: the first `window` words from each position on.

    Only suffixes with that many words are held, and items with fewer as a whole.
    """

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        items = sorted({(i, t) for i, t in items if t}, key=str)
        self.window = window
        words = Words(pa.array([t for _, t in items], pa.string()), NOT_ALNUM)
        self.values = words.values
        rows, owners, places, sizes = [], [], [], []
        self.longest = 1
        for number, (low, high) in enumerate(zip(words.bounds[:-1], words.bounds[1:])):
            self.longest = max(self.longest, int(high - low))
            for at in range(low, max(low + (high > low), high - window + 1)):
                size = int(min(window, high - at))
                row = np.full(window, -1, np.int64)
                row[:size] = words.ids[at:at + size]
                rows.append(row)
                owners.append(number)
                places.append(int(at - low))
                sizes.append(size)
        self.names = [str(i) if i is not None else "null" for i, _ in items]
        self.rows = np.array(rows, np.int64).reshape(len(rows), window)
        self.owners, self.places, self.sizes = (
            np.array(x, np.int64) for x in (owners, places, sizes))

    def search(self, words: np.ndarray, order: np.ndarray,
               values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of (position in words, number of the suffix that occurs there).

        words: numbers in `values` plus one; 0 closes a document.
        """
        code = pc.index_in(self.values, value_set=values).fill_null(-1).to_numpy() + 1
        coded = np.where(self.rows >= 0, code[self.rows], 0)
        real = np.arange(self.window) < self.sizes[:, None]
        known = np.flatnonzero(((coded > 0) | ~real).all(axis=1))
        if len(known) == 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        coded, sizes = coded[known], self.sizes[known]
        padded = np.concatenate([words, np.zeros(self.window, words.dtype)])

        def bound(upper: bool) -> np.ndarray:
            low = np.zeros(len(known), np.int64)
            high = np.full(len(known), len(order), np.int64)
            while (open_ := low < high).any():
                middle = (low + high) // 2
                at = order[np.minimum(middle, len(order) - 1)]
                sign = np.zeros(len(known), np.int8)
                for i in range(self.window):
                    same = (sign == 0) & (i < sizes)
                    there = padded[at + i]
                    sign[same & (there < coded[:, i])] = -1
                    sign[same & (there > coded[:, i])] = 1
                right = (sign < 0) | ((sign == 0) & upper)
                low = np.where(open_ & right, middle + 1, low)
                high = np.where(open_ & ~right, middle, high)
            return low

        first, last = bound(False), bound(True)
        counts = last - first
        suffix = np.repeat(known, counts)
        within = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
        return order[np.repeat(first, counts) + within], suffix


def _join_matches(at: np.ndarray, owner: np.ndarray, place: np.ndarray,
                  size: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(item, position, place in the item, words): occurrences joined along both texts."""
    order = np.lexsort((at, at - place, owner))
    at, owner, place, size = at[order], owner[order], place[order], size[order]
    fresh = np.ones(len(at), bool)
    fresh[1:] = ((owner[1:] != owner[:-1]) | (at[1:] - place[1:] != at[:-1] - place[:-1])
                 | (at[1:] != at[:-1] + 1))
    firsts = np.flatnonzero(fresh)
    lasts = np.append(firsts[1:], len(at)) - 1
    return [(int(owner[f]), int(at[f]), int(place[f]), int(at[e] - at[f] + size[e]))
            for f, e in zip(firsts, lasts)]


def _matcher(sent: list, window: int):
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            texts = Words(block.column("text"), NOT_ALNUM)
            count, rows = len(texts.ids), block.num_rows
            # A 0 after each document, so that no match runs on into the next one.
            owner = np.repeat(np.arange(rows), np.diff(texts.bounds))
            spread = np.zeros(count + rows, np.int64)
            spread[np.arange(count) + owner] = texts.ids + 1
            begins = texts.bounds[:-1] + np.arange(rows)
            cover = np.zeros(count + rows + 1, np.int32)
            found: dict[int, list[tuple]] = {}
            order = None
            for queries in (b.value for b in sent):
                if not len(queries.rows):
                    continue
                if order is None:
                    depth = max(window, *(b.value.longest for b in sent))
                    order = suffix_array(spread, depth)
                at, suffix = queries.search(spread, order, texts.values)
                if not len(at):
                    continue
                np.add.at(cover, at, 1)
                np.add.at(cover, at + queries.sizes[suffix], -1)
                for item, start, place, size in _join_matches(
                        at, queries.owners[suffix], queries.places[suffix], queries.sizes[suffix]):
                    doc = int(np.searchsorted(begins, start, side="right")) - 1
                    found.setdefault(doc, []).append(
                        (queries.names[item], start - int(begins[doc]), place, size))
            hit = np.concatenate([[0], np.cumsum(np.cumsum(cover[:-1]) > 0)])
            n_hit = hit[np.append(begins[1:], count + rows)] - hit[begins]
            items = [sorted({m[0] for m in found.get(i, ())}) for i in range(rows)]
            matches = [[dict(zip(("item_id", "doc_word", "item_word", "n_words"), m))
                        for m in sorted(found.get(i, ()), key=lambda m: (m[1], m[0], m[2]))]
                       for i in range(rows)]
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id").cast(pa.int64()), pa.array(np.diff(texts.bounds)),
                 pa.array(n_hit.astype(np.int64)), pa.array(items, pa.list_(pa.string())),
                 pa.array(matches, pa.list_(_MATCH))], schema=_ARROW)
    return match


def _query_blocks(items: DataFrame, window: int) -> list[Queries]:
    """Benchmark items in blocks that the driver reads one after the other."""
    held = items.select(F.col("item_id").cast("string"), F.col("text").cast("string")).distinct()
    size = held.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-size // QUERY_BYTES) or 1
    # Copies of an item id meet in one block, so that each block names an item once.
    block = F.pmod(F.xxhash64("item_id"), F.lit(count))
    for number in range(count):
        rows = held if count == 1 else held.filter(block == number)
        yield Queries([tuple(r) for r in rows.collect()], window)


def matches(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: words, words inside a match, items that match, and the longest matches.

    docs: doc_id (integer), text. items: item_id, text; ids are given back as strings.
    Matches name the item, the first word in document and item (from 0) and the length.
    """
    context = docs.sparkSession.sparkContext
    sent = [context.broadcast(q) for q in _query_blocks(items, window)]
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(_matcher(sent, window), SCHEMA)


def clean(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents, all columns, in which no item occurs.

    Rows are judged one by one; rows that repeat an id stay or go by their own text.
    """
    context = docs.sparkSession.sparkContext
    sent = [context.broadcast(q) for q in _query_blocks(items, window)]
    match = _matcher(sent, window)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            texts = pa.RecordBatch.from_arrays(
                [pa.array(range(block.num_rows), pa.int64()), block.column("text")],
                names=["doc_id", "text"])
            judged = next(match(iter([texts])), None)
            if judged is not None:
                yield block.filter(pc.equal(judged.column("n_hit"), 0))
    return docs.mapInArrow(keep, docs.schema)
