"""Token ids in bit-plane files.

Ids of all documents, each closed by an end id, follow one another in ascending doc_id order. They
are cut into chunks of a fixed number of ids; a chunk is transposed into byte planes (or bit
planes), each plane compressed by itself with zstandard. A chunk's payload is

    b"PLN1", kind (0 byte, 1 bit planes), planes, ids (uint32); per plane its offset, length and
    crc32 (uint32 each); the planes

all little-endian. The files are a folder of Parquet files with a row per chunk, which any
reader of Spark's stores opens; the other columns are the chunk index: shard (key range, in
order), chunk (number in it), first (its first id in the shard), n, and the documents it holds
(docs: row number in the shard, doc_id, number of ids). Chunks can be read in any order.

Null texts count as empty (the end id alone). Rows that repeat a doc_id follow one another, in
order of their texts; rows without an id come first. A very long text spans as many chunks as
it needs.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfproof.llm import ordered
from shelfproof.llm.words import blocks, text_bytes
from shelfproof.session import shared_folder

CHUNK_IDS = 1 << 16
KINDS = {"byte": 0, "bit": 1}
_HEAD, _PLANE = struct.Struct("<4sBBI"), struct.Struct("<III")


def pack(ids: np.ndarray, kind: str = "byte", level: int = 1) -> bytes:
    """A chunk's payload."""
    raw = ids.astype("<u4")
    if kind == "byte":
        rows = raw.view(np.uint8).reshape(-1, 4).T
    else:
        bits = np.unpackbits(raw.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
        rows = np.packbits(bits, axis=0, bitorder="little").T
    press = zstandard.ZstdCompressor(level=level)
    planes = [press.compress(np.ascontiguousarray(row).tobytes()) for row in rows]
    at = _HEAD.size + _PLANE.size * len(planes)
    index = b""
    for plane in planes:
        index += _PLANE.pack(at, len(plane), zlib.crc32(plane))
        at += len(plane)
    return _HEAD.pack(b"PLN1", KINDS[kind], len(planes), len(raw)) + index + b"".join(planes)


def unpack(payload: bytes) -> np.ndarray:
    """The ids of a chunk; a damaged payload raises ValueError."""
    magic, kind, count, n = _HEAD.unpack_from(payload)
    if magic != b"PLN1":
        raise ValueError("not a plane chunk")
    rows = []
    for i in range(count):
        at, size, crc = _PLANE.unpack_from(payload, _HEAD.size + i * _PLANE.size)
        plane = payload[at:at + size]
        if zlib.crc32(plane) != crc:
            raise ValueError(f"plane {i} is damaged")
        rows.append(np.frombuffer(zstandard.ZstdDecompressor().decompress(plane), np.uint8))
    if kind == KINDS["byte"]:
        return np.ascontiguousarray(np.stack(rows, axis=1)).reshape(-1).view("<u4")[:n]
    bits = np.unpackbits(np.stack(rows, axis=1), axis=0, bitorder="little")[:n]
    return np.packbits(bits, axis=1, bitorder="little").reshape(-1).view("<u4")


# ---- text to ids -----------------------------------------------------------------------

def _bytes_in(*spans: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in spans:
        table[low:high + 1] = True
    return table


_SPACE = _bytes_in((0x09, 0x0D), (0x20, 0x20))
#: Bytes that begin a character which is surely no white space.
_SOLID = _bytes_in((0x21, 0x7E), (0xC3, 0xDF), (0xE4, 0xF7))
_LETTER = _bytes_in((0x41, 0x5A), (0x61, 0x7A))
_MARK = _bytes_in((0x21, 0x26), (0x28, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))


def added_spans(data: np.ndarray, offsets: np.ndarray, pattern: re.Pattern) -> np.ndarray:
    """Begin and end of each place that the pattern finds within one text."""
    spans = []
    if pattern.search(data):
        for begin, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            spans += [m.span() for m in pattern.finditer(data, begin, end)]
    return np.array(spans, np.int64).reshape(-1, 2)


def pieces(data: np.ndarray, offsets: np.ndarray, added: re.Pattern | None = None) -> np.ndarray:
    """Where texts may be cut without changing their byte-level BPE ids.

    The library cuts a text into words before it merges bytes: white space before a word goes to
    words of its own, but for a last space, which goes to the word; letters and marks are in
    different words. So a text may be cut before the last white-space character in front of a
    word and, if that is no space, after it, and between an ASCII letter and an ASCII mark (but
    for the apostrophe, which may belong to the letters after it).

    Before all that it takes out what `added` finds, tokens with an id of their own: these are
    pieces, and the white space before one ends a text.
    """
    cut = np.zeros(len(data) + 1, bool)
    if len(data):
        left, right = data[:-1], data[1:]
        letter = _LETTER[data]
        accented = np.zeros(len(data), bool)  # the second byte of a letter like those of Latin-1
        accented[1:] = (left == 0xC3) & (right != 0x97) & (right != 0xB7)
        mark = _MARK[data]
        cut[1:-1] = ((letter[:-1] | accented[:-1]) & mark[1:]) | (mark[:-1] & letter[1:])
        begins = np.zeros(len(data) + 1, bool)
        begins[offsets] = True
        turn = np.flatnonzero(_SPACE[left] & _SOLID[right] & ~begins[1:-1]) + 1
        cut[turn - 1] = True
        cut[turn[data[turn - 1] != 0x20]] = True
        spans = np.zeros((0, 2), np.int64) if added is None else added_spans(data, offsets, added)
        for begin, end in spans.tolist():
            cut[begin + 1:end] = False
            cut[begin - 1] &= not _SPACE[data[begin - 1]]
        cut[spans] = True
    cut[offsets] = True
    return np.flatnonzero(cut)


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level vocabularies write bytes with: their own where these are
    visible in Latin-1, else those from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Encoder:
    """Byte-level BPE ids by the library, each distinct piece encoded once while it is held."""

    HELD, LONGEST = 1 << 18, 48

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.letters = str.maketrans(_byte_letters())
        # The library takes the longest where several begin. Texts stay whole if one of them takes
        # in the white space around it or asks for it.
        tokens = self.tokenizer.get_added_tokens_decoder().values()
        self.whole = any(t.lstrip or t.rstrip or t.single_word for t in tokens)
        self.added = {t.content.encode() for t in tokens}
        longest = sorted(self.added, key=len, reverse=True)
        self.pattern = re.compile(b"|".join(map(re.escape, longest))) if longest else None
        self._clear()

    def _clear(self) -> None:
        self.slots: dict[bytes, int] = {}
        self.flat, self.begins = array("I"), array("q", [0])

    def _encode(self, values: list[bytes]) -> list[list[int]]:
        """Pieces of one word go straight to the library's model, others the whole way."""
        out: list[list[int]] = [[]] * len(values)
        rest, merge = [], self.tokenizer.model.tokenize
        for i, value in enumerate(values):
            text = value.decode()
            if not self.whole and value not in self.added \
                    and (text[1:] if text[0] == " " else text).isalpha():
                out[i] = [t.id for t in merge(value.decode("latin-1").translate(self.letters))]
            else:
                rest.append((i, text))
        for low in range(0, len(rest), 10_000):
            part = rest[low:low + 10_000]
            coded = self.tokenizer.encode_batch_fast([t for _, t in part], add_special_tokens=False)
            for (i, _), one in zip(part, coded):
                out[i] = one.ids
        return out

    def __call__(self, column: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each closed by `end`, and the number of ids of each."""
        if len(self.slots) > self.HELD:
            self._clear()
        data, offsets = text_bytes(column)
        cuts = np.unique(offsets) if self.whole else pieces(data, offsets, self.pattern)
        coded = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(cuts) - 1,
            [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))],
        ).dictionary_encode()
        values = coded.dictionary.to_pylist()
        slot = np.fromiter((self.slots.get(v, -1) for v in values), np.int64, len(values))
        missing = [i for i in np.flatnonzero(slot < 0).tolist()]
        for i, ids in zip(missing, self._encode([values[i] for i in missing])):
            slot[i] = len(self.begins) - 1
            self.flat.extend(ids)
            self.begins.append(len(self.flat))
            if len(values[i]) <= self.LONGEST:
                self.slots[values[i]] = int(slot[i])
        flat = np.frombuffer(self.flat, np.uint32) if len(self.flat) else np.zeros(0, np.uint32)
        begins = np.frombuffer(self.begins, np.int64)
        used = slot[coded.indices.to_numpy()]
        sizes = begins[used + 1] - begins[used]
        # One more place after the last piece of each text, for the end id.
        after = np.searchsorted(cuts, offsets)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        counts = np.diff(ends[after]) + 1
        owner = np.repeat(np.arange(len(column)), np.diff(after))
        out = np.full(int(counts.sum()), end, np.uint32)
        at = np.repeat(ends[:-1] + owner, sizes) + (
            np.arange(ends[-1]) - np.repeat(ends[:-1], sizes))
        out[at] = flat[np.repeat(begins[used] - ends[:-1], sizes) + np.arange(ends[-1])]
        if len(self.flat) > 16 * self.HELD:
            del flat, begins
            self._clear()
        return out, counts


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """One per worker process, so that later tasks find the pieces of earlier ones."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


# ---- files -----------------------------------------------------------------------------

DOC = T.StructType([T.StructField("row", T.LongType()), T.StructField("doc_id", T.LongType()),
                    T.StructField("n", T.LongType())])
FILES = T.StructType([
    T.StructField("shard", T.IntegerType()), T.StructField("chunk", T.IntegerType()),
    T.StructField("first", T.LongType()), T.StructField("n", T.LongType()),
    T.StructField("docs", T.ArrayType(DOC)), T.StructField("payload", T.BinaryType())])
_DOC = pa.struct([("row", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64())])
_FILES = pa.schema([("shard", pa.int32()), ("chunk", pa.int32()), ("first", pa.int64()),
                    ("n", pa.int64()), ("docs", pa.list_(_DOC)), ("payload", pa.binary())])


class _Shard:
    """Ids of one shard on their way into chunks."""

    def __init__(self, number: int, size: int, kind: str):
        self.number, self.size, self.kind = number, size, kind
        self.chunk = self.row = self.first = self.held = 0
        self.ids: list[np.ndarray] = []
        self.docs: list[dict] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        while len(ids):
            part, ids = ids[:self.size - self.held], ids[self.size - self.held:]
            self.ids.append(part)
            self.docs.append({"row": self.row, "doc_id": doc_id, "n": len(part)})
            self.held += len(part)
            if self.held == self.size:
                yield from self.flush()
        self.row += 1

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            payload = pack(np.concatenate(self.ids), self.kind)
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip(
                    (self.number, self.chunk, self.first, self.held, self.docs, payload),
                    _FILES)], schema=_FILES)
            self.first += self.held
            self.chunk += 1
            self.held, self.ids, self.docs = 0, [], []


def _writer(path: str, end: int, chunk_ids: int, kind: str) -> Callable:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard = _encoder(path), None
        for block in blocks(batches, limit=2 << 20):
            ids, counts = encode(block.column("text"), end)
            at = 0
            for doc_id, number, n in zip(block.column("doc_id").to_pylist(),
                                         block.column(ordered.SHARD).to_pylist(),
                                         counts.tolist()):
                if shard is None or shard.number != number:
                    if shard is not None:
                        yield from shard.flush()
                    shard = _Shard(number, chunk_ids, kind)
                yield from shard.add(doc_id, ids[at:at + n])
                at += n
        if shard is not None:
            yield from shard.flush()
    return write


def write(docs: DataFrame, tokenizer: str, end: int, path: str | None = None,
          chunk_ids: int = CHUNK_IDS, kind: str = "byte") -> str:
    """Write the plane files of all texts and return their folder.

    docs: doc_id (integer), text; other columns are not read. tokenizer: file of a byte-level BPE
    tokenizer. Without a path, a new folder beside the session's checkpoints.
    """
    path = path or f"{shared_folder(docs.sparkSession)}/planes-{uuid.uuid4().hex}"
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ranged = ordered.in_order(ordered.with_shards(rows, "doc_id"), "doc_id", "text")
    ranged.mapInArrow(_writer(tokenizer, end, chunk_ids, kind), FILES).write.parquet(path)
    return path


PIECE = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("row", T.LongType()),
                      T.StructField("doc_id", T.LongType()), T.StructField("at", T.LongType()),
                      T.StructField("n", T.LongType()), T.StructField("crc", T.LongType())])
_PIECE = pa.schema([("shard", pa.int32()), ("row", pa.int64()), ("doc_id", pa.int64()),
                    ("at", pa.int64()), ("n", pa.int64()), ("crc", pa.int64())])


def _read_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for shard, first, docs, payload in zip(*(
                batch.column(c).to_pylist() for c in ("shard", "first", "docs", "payload"))):
            ids, at, rows = unpack(payload), 0, []
            for doc in docs:
                part = ids[at:at + doc["n"]]
                rows.append((shard, doc["row"], doc["doc_id"], first + at, len(part),
                             zlib.crc32(part.tobytes())))
                at += len(part)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), _PIECE)], schema=_PIECE)


def joined_crc(pieces_: list[tuple[int, int]]) -> int:
    """The crc32 of byte strings one after the other, from (crc32, length) of each.

    The crc is linear: appending b to a is appending as many zeros, taking off what these
    give by themselves, and adding b's own.
    """
    crc, _ = pieces_[0]
    for other, size in pieces_[1:]:
        zeros = bytes(size)
        crc = zlib.crc32(zeros, crc) ^ zlib.crc32(zeros) ^ other
    return crc


@F.arrow_udf(T.LongType())
def _whole_crc(parts: pa.Array) -> pa.Array:
    return pa.array([joined_crc([(p["crc"], 4 * p["n"]) for p in row])
                     for row in parts.to_pylist()], pa.int64())


def documents(files: DataFrame) -> DataFrame:
    """Per document, read back from the chunks: doc_id, start, n_tokens, ids_crc32."""
    read = files.select("shard", "first", "docs", "payload").mapInArrow(_read_pieces, PIECE)
    parts = F.sort_array(F.collect_list(F.struct("at", "n", "crc")))
    rows = read.groupBy("shard", "row").agg(
        F.first("doc_id").alias("doc_id"), F.min("at").alias("at"),
        F.sum("n").alias("n_tokens"), parts.alias("parts"))
    before = F.coalesce(F.sum("n").over(  # one row per shard
        Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = files.groupBy("shard").agg(F.sum("n").alias("n")) \
        .select("shard", before.alias("base"))
    crc = F.when(F.size("parts") == 1, F.col("parts")[0]["crc"]).otherwise(_whole_crc("parts"))
    return rows.join(bases, "shard").select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens",
        crc.alias("ids_crc32"), "shard")


def ids(files: DataFrame) -> DataFrame:
    """The ids themselves: shard, chunk, first, ids (array)."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [unpack(p).astype(np.int64) for p in batch.column("payload").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("shard"), batch.column("chunk"), batch.column("first"),
                 pa.array(values, pa.list_(pa.int64()))], names=["shard", "chunk", "first", "ids"])
    return files.select("shard", "chunk", "first", "payload").mapInArrow(
        read, "shard int, chunk int, first long, ids array<long>")
