"""Removal of every byte run of `depth` bytes that occurs twice, within a document or across.

Suffixes are radix-sorted through their first `depth` bytes alone, most significant digit first: a
group of one leaves the sort, and groups of equal suffixes are the repeated windows. To sort all
suffixes of a corpus would shuffle several times its size, so digits are chosen in such a way that
the first passes deal with many suffixes at once:

1. A window's first digit is its anchor: the 32 bytes in it whose hash is lowest. Equal windows
   have equal anchors at the same place, and the windows of one anchor are adjacent: a segment, of
   which there is one in 70 bytes or so. An anchor that occurs once ends all its windows. Where all
   segments of an anchor are equal, their windows are repeated.
2. The other segments are cut at fixed distances from the anchor into runs of 16 windows. The digit
   is what all windows of a run have in common, nearly the whole depth.
3. Single windows of runs that are still in question, by all their bytes.

Each pass is a shuffle on the digit. Documents are dealt into blocks of a few MB first, and a block
sends one row per digit however often it has it: a passage that a third of all documents hold has a
row per block, and no group is larger than the number of blocks. Blocks are a table bucketed by
block, so that what a pass finds is joined to them without moving the texts again.

Rows are compared by two independent 64-bit hashes of the whole windows. Windows never cross
documents; null and empty texts have none, nor do texts shorter than `depth`. A very long text is
one block. Repeated rows, ids or no ids make no difference: rows are told apart by their place, and
of repeated texts of `depth` bytes or more nothing is left.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfproof.llm.graph import staged
from shelfproof.llm.words import blocks, mix, text_bytes
from shelfproof.session import shared_folder

GRAM, RUN = 32, 16
#: The least depth: a window holds several grams.
LEAST = GRAM + RUN
#: Windows whose anchors are looked for at a time; places among them take the low bits of a hash.
CHUNK, LOW_BITS = 1 << 17, np.uint64((1 << 24) - 1)
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
WHOLE, FURTHER = 1, 2


def _wide(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number; no copy."""
    return np.ndarray(max(0, len(data) - 7), "<u8", data.tobytes(), 0, (1,))


def fold(wide: np.ndarray, at: np.ndarray, length: int, seed: np.uint64 = _A) -> np.ndarray:
    """A hash of the `length` bytes, eight at least, from each of these places on."""
    out = np.full(len(at), seed)
    for j in (*range(0, length - 8, 8), length - 8):
        out = (out ^ wide[at + j]) * _B
        out ^= out >> np.uint64(32)
        out *= _C
    return mix(out ^ seed)


class Segments:
    """Runs of adjacent windows with one anchor: key (of the anchor), anchor, first, last (windows)."""

    def __init__(self, wide: np.ndarray, offsets: np.ndarray, depth: int):
        self.wide, self.depth = wide, depth
        own = [x for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist()) if hi - lo >= depth
               for x in (lo, hi - depth + 1)]
        bounds = np.array(own, np.int64)  # where windows begin and end, by turns
        total = int(bounds[-1]) if own else 0
        found = []
        for low in range(0, total, CHUNK):
            high = min(low + CHUNK, total)
            key, anchor, new, inside = self._chunk(low, high, bounds)
            first = np.flatnonzero(new & inside)
            ends = np.ones(high - low, bool)
            ends[:-1] = new[1:] | ~inside[1:]
            last = np.flatnonzero(ends & inside)
            found.append((key[anchor[first]], anchor[first] + low, first + low, last + low))
        empty = np.zeros(0, np.int64)
        self.key, self.anchor, self.first, self.last = (
            np.concatenate(x) for x in zip(*found)) if found else (empty.astype(np.uint64), empty, empty, empty)

    def _chunk(self, low: int, high: int, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
        """Hashes of grams, each window's anchor, whether it is another than the window before
        has, and whether the window lies in one text."""
        span = self.depth - GRAM + 1  # grams of a window
        eight = self.wide[low:high + self.depth - 8].copy()
        a = eight * _A
        a ^= a >> np.uint64(32)
        two = (a[:-8] + eight[8:]) * _B
        two ^= two >> np.uint64(29)
        gram = two[:-16] * _C + two[16:]
        gram ^= gram >> np.uint64(32)
        gram *= _B
        gram ^= gram >> np.uint64(31)
        least = (gram & ~LOW_BITS) | np.arange(len(gram), dtype=np.uint64)
        step = 1
        while 2 * step <= span:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        if span > step:
            least = np.minimum(least[:step - span], least[span - step:])
        anchor = (least & LOW_BITS).astype(np.int64)
        turns = np.zeros(high - low + 1, np.int64)
        here = bounds[np.searchsorted(bounds, low):np.searchsorted(bounds, high)] - low
        np.add.at(turns, here, 1)
        begun = int(np.searchsorted(bounds, low))
        inside = (np.cumsum(turns[:-1]) + begun) % 2 == 1
        new = np.ones(high - low, bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | ~inside[:-1]
        return gram, anchor, new, inside

    def same(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """A hash of all bytes of the windows from first to last, at most `depth` apart."""
        ends = fold(self.wide, first, self.depth) * _A + fold(self.wide, last, self.depth)
        return mix(ends ^ mix((last - first).astype(np.uint64)))

    def runs(self, which: np.ndarray) -> tuple[np.ndarray, ...]:
        """(digit, hash, first, last) of the runs of these segments."""
        near, far = self.anchor[which] - self.last[which], self.anchor[which] - self.first[which]
        count = far // RUN - near // RUN + 1
        of = np.repeat(np.arange(len(which)), count)
        run = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count) + (near // RUN)[of]
        anchor = self.anchor[which][of]
        first = anchor - np.minimum(far[of], run * RUN + RUN - 1)
        last = anchor - np.maximum(near[of], run * RUN)
        common = fold(self.wide, anchor - run * RUN, self.depth - RUN + 1)
        digit = mix(common ^ mix(self.key[which][of] + run.astype(np.uint64)))
        return digit, self.same(first, last) ^ mix((anchor - first).astype(np.uint64)), first, last

    def windows(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, ...]:
        """(digit, hash, window) of all windows from first to last."""
        count = last - first + 1
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
        return fold(self.wide, at, self.depth, _B), fold(self.wide, at, self.depth, _C), at


class Groups:
    """Items of one block by digit, and by digit and hash: copies of one another."""

    def __init__(self, digit: np.ndarray, same: np.ndarray):
        self.order = np.lexsort([same, digit])
        d, s = digit[self.order], same[self.order]
        new = np.ones(len(d), bool)
        new[1:] = d[1:] != d[:-1]
        other = new.copy()
        other[1:] |= s[1:] != s[:-1]
        self.first = np.flatnonzero(other)  # of each kind of copies
        self.copies = np.diff(np.append(self.first, len(d)))
        self.group = (np.cumsum(new) - 1)[self.first]  # of each kind
        self.digit, self.same = d[new], s[new]
        self.kinds = np.bincount(self.group, minlength=len(self.digit))
        self.single = self.kinds == 1
        self.many = self.single & (np.bincount(self.group, self.copies, len(self.digit)) > 1)

    def rows(self, block: int) -> pa.RecordBatch:
        """One row per digit; no hash if there are several."""
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(self.digit), block, np.int64)), pa.array(self.digit.view(np.int64)),
             pa.array(self.same.view(np.int64), mask=~self.single), pa.array(self.many)],
            names=["block", "digit", "same", "many"])

    def told(self, digits: np.ndarray, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(repeated items, items to go on with) by what the shuffle says of some digits."""
        flag = np.zeros(len(self.digit), np.int8)
        flag[np.searchsorted(self.digit, digits)] = flags
        asked = flag[self.group]
        whole = np.where(self.single[self.group], (asked & WHOLE) > 0, ((asked & FURTHER) > 0) & (self.copies > 1))
        return self.order[np.repeat(whole, self.copies)], self.order[self.first[(asked & FURTHER) > 0]]


def _verdicts(rows: DataFrame, level: int) -> DataFrame:
    """(block, level, digit, flags): what each block has to know of its digits."""
    kind = Window.partitionBy("digit", "same")
    digit = Window.partitionBy("digit")
    seen = rows.withColumns({"copies": F.count("*").over(kind.orderBy("block").rowsBetween(
                                 Window.unboundedPreceding, Window.unboundedFollowing)),
                             "turn": F.row_number().over(kind.orderBy("block"))}) \
        .withColumns({"low": F.min("same").over(digit), "high": F.max("same").over(digit),
                      "mixed": F.max(F.col("same").isNull()).over(digit)})
    whole = F.col("same").isNotNull() & ((F.col("copies") > 1) | F.col("many"))
    further = (F.col("mixed") | (F.col("low") != F.col("high"))) & (F.col("same").isNull() | (F.col("turn") == 1))
    flags = F.when(whole, WHOLE).otherwise(0) + F.when(further, FURTHER).otherwise(0)
    return seen.select("block", F.lit(level).cast("byte").alias("level"), "digit",
                       flags.cast("byte").alias("flags")).filter("flags > 0")


# ---- blocks --------------------------------------------------------------------------------------

BLOCK = "block long, ids array<long>, ends array<long>, data binary"
_BLOCK = pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())),
                    ("data", pa.binary())])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    for block in blocks(batches):
        data, offsets = text_bytes(block.column("text"))
        packed = pa.compress(data.tobytes(), "zstd", asbytes=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array([number]), pa.array([block.column("doc_id")], _BLOCK.field("ids").type),
             pa.array([offsets[1:]], _BLOCK.field("ends").type), pa.array([packed], pa.binary())], schema=_BLOCK)
        number += 1


def _blocks(docs: DataFrame) -> DataFrame:
    """The documents in blocks, a table bucketed by block."""
    spark = docs.sparkSession
    name = f"suffix_blocks_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_pack, BLOCK)
    rows.repartition(buckets, "block").write.format("parquet").bucketBy(buckets, "block") \
        .option("path", f"{shared_folder(spark)}/{name}").saveAsTable(name)
    return spark.table(name)


class Block:
    """A block's segments, and what is known of them from the passes before."""

    def __init__(self, batch: pa.RecordBatch, row: int, depth: int):
        self.ids = batch.column("ids")[row].as_py()
        ends = batch.column("ends")[row].values.to_numpy()
        self.offsets = np.concatenate([np.zeros(1, np.int64), ends])
        packed = batch.column("data")[row].as_buffer()
        size = int(self.offsets[-1])
        raw = pa.decompress(packed, size, "zstd", asbytes=True) if size else b""
        self.data = np.frombuffer(raw, np.uint8)
        self.segments = Segments(_wide(self.data), self.offsets, depth)
        self.told: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        if "told" in batch.schema.names and batch.column("told")[row].is_valid:
            flat = batch.column("told")[row].values
            level, digit, flags = (flat.field(k).to_numpy() for k in ("level", "digit", "flags"))
            for k in np.unique(level).tolist():
                own = level == k
                self.told[k] = (digit[own].view(np.uint64), flags[own])

    def passes(self, upto: int) -> tuple[Groups | None, list[tuple[np.ndarray, np.ndarray]]]:
        """The groups of pass `upto`, and (first, last) windows found repeated before it."""
        s = self.segments
        nothing = (np.zeros(0, np.uint64), np.zeros(0, np.int8))
        found = []
        first, last = s.first, s.last
        groups = Groups(s.key, s.same(first, last))
        for level in range(1, upto):
            whole, further = groups.told(*self.told.get(level, nothing))
            found.append((first[whole], last[whole]))
            if level == 3:
                return None, found
            if level == 1:
                digit, same, first, last = s.runs(further)
            else:
                digit, same, first = s.windows(first[further], last[further])
                last = first
            groups = Groups(digit, same)
        return groups, found


def _sender(depth: int, level: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                groups, _ = Block(batch, row, depth).passes(level)
                if len(groups.digit):
                    yield groups.rows(batch.column("block")[row].as_py())
    return send


OUT = "doc_id long, n_bytes long, spans array<struct<begin: long, end: long>>, kept binary"
_SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("spans", _SPANS), ("kept", pa.binary())])


def _remover(depth: int):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block = Block(batch, row, depth)
                _, found = block.passes(4)
                turns = np.zeros(len(block.data) + 1, np.int32)
                for first, last in found:
                    np.add.at(turns, first, 1)
                    np.add.at(turns, last + depth, -1)
                gone = np.cumsum(turns[:-1]) > 0
                spans, kept = [], []
                for lo, hi in zip(block.offsets[:-1].tolist(), block.offsets[1:].tolist()):
                    own = gone[lo:hi]
                    edges = np.flatnonzero(np.diff(own, prepend=False, append=False)).tolist()
                    spans.append([{"begin": b, "end": e} for b, e in zip(edges[::2], edges[1::2])])
                    kept.append(block.data[lo:hi][~own].tobytes() if edges else block.data[lo:hi].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.ids, pa.int64()), pa.array(np.diff(block.offsets)),
                     pa.array(spans, _SPANS), pa.array(kept, pa.binary())], schema=_OUT)
    return remove


def deduplicate(docs: DataFrame, depth: int = 200) -> DataFrame:
    """Per document: doc_id, n_bytes, spans (removed bytes from begin to before end), kept (bytes).

    docs: doc_id (integer), text. Every byte covered by a run of `depth` bytes that starts anywhere
    else too is removed; what is kept may be cut within a character.
    """
    if depth < LEAST:
        raise ValueError(f"depth must be {LEAST} at least")
    table = _blocks(docs)
    found: DataFrame | None = None
    for level in (1, 2, 3):
        known = table if found is None else table.join(_by_block(found, True), "block")
        rows = known.mapInArrow(_sender(depth, level), "block long, digit long, same long, many boolean")
        verdicts = staged(_verdicts(rows, level))
        found = verdicts if found is None else found.unionByName(verdicts)
    return table.join(_by_block(found, False), "block", "left").mapInArrow(_remover(depth), OUT)


def _by_block(found: DataFrame, open_only: bool) -> DataFrame:
    """(block, told): all that is known of a block's digits; of blocks in question alone."""
    told = found.groupBy("block").agg(F.collect_list(F.struct("level", "digit", "flags")).alias("told"),
                                      F.max(F.col("flags") >= FURTHER).alias("_open"))
    return told.filter("_open").drop("_open") if open_only else told.drop("_open")
