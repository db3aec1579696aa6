"""Groups of spelling variants: words of a corpus and the likelier words that they are near to.

Words are near if they differ by exactly one inserted, deleted or replaced code point.

1. Words are counted per task, a bounded number at a time, and added up by Spark.
2. Every word's deletions and replacements are probed against Bloom filters of the vocabulary, one
   filter per word length (an insertion is the other word's deletion). Filters are blocked: all
   bits of a word lie in one 64-bit cell. A round broadcasts as many filters as fit in MAX_CELLS
   cells, so its size does not grow with the vocabulary, the number of rounds does; the filter of
   a length that does not fit is cut into parts by hash.
3. Only edits that a filter admits are shuffled to a join with the vocabulary, which removes the
   false ones. A filter admits every word that it holds, so no pair is missed.
4. A word's form is its most frequent near word, if that is frequent enough; forms are followed by
   pointer doubling. Counts grow by a factor with each step, so that there are few.

Null and empty texts have no words. A very long text is searched in pieces that end between words.
Rows that repeat a document count again; a null doc_id is written as nothing where words are spoilt.
Ties between near words go to the lower one in code-point order.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfproof.llm.graph import staged
from shelfproof.llm.words import blocks, mix

LETTERS = "A-Za-zÀ-ÿ"
#: Characters of a text that are searched at a time; distinct words that a task holds.
PIECE_CHARS, HELD_WORDS = 1 << 20, 300_000
#: Cells of 64 bits in the filters of one round (16 MB); cells per word; bits set per word.
MAX_CELLS, CELLS_PER_WORD, PROBES = 1 << 21, 0.4, 5
#: Edits that are hashed at a time.
EDITS = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _pieces(text: str, between: re.Pattern) -> Iterator[str]:
    at = 0
    while len(text) - at > PIECE_CHARS:
        cut = between.search(text, at + PIECE_CHARS)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def spoilt(run: str, before: int, every: int) -> str:
    """The run less one code point if `every` divides its checksum; `before`: that of the prefix."""
    drawn = zlib.crc32(run.encode(), before)
    if drawn % every:
        return run
    at = drawn % len(run)
    return run[:at] + run[at + 1:]


def _counter(least: int, every: int | None):
    found = re.compile(f"[{LETTERS}]{{{least},}}")
    between = re.compile(f"[^{LETTERS}]")
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def rows(total: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], schema=schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for block in blocks(batches):
            for doc_id, text in zip(block.column("doc_id"), block.column("text")):
                text = text.as_py()
                if not text:
                    continue
                before = zlib.crc32(f"{'' if doc_id.as_py() is None else doc_id.as_py()}:".encode())
                text = text.encode().lower().decode()  # bytes: A-Z alone
                for piece in _pieces(text, between):
                    runs = found.findall(piece)
                    if every is None:
                        total.update(runs)
                        continue
                    for run, n in Counter(runs).items():
                        run = spoilt(run, before, every)
                        if len(run) >= least:
                            total[run] += n
                    if len(total) > HELD_WORDS:
                        yield rows(total)
                        total = Counter()
            if len(total) > HELD_WORDS:
                yield rows(total)
                total = Counter()
        if total:
            yield rows(total)
    return count


def vocabulary(docs: DataFrame, least_length: int = 6, least_count: int = 5,
               every: int | None = None) -> DataFrame:
    """(word, n): runs of letters, A-Z in lower case, of at least these lengths and counts.

    docs: doc_id (integer), text. With `every`, a run r of document d loses the code point
    h mod length if `every` divides h, the crc32 of "d:r": spelling errors to be found again.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(_counter(least_length, every), "word string, n long") \
        .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


# ---- filters -----------------------------------------------------------------------------------

def _codes(words: list[str], length: int) -> np.ndarray:
    """A row of code points per word; all have this length."""
    raw = "".join(words).encode("utf-32-le")
    return np.frombuffer(raw, "<u4").reshape(len(words), length).astype(np.uint64)


def _powers(length: int) -> np.ndarray:
    out = np.full(length, _BASE, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def hashes(words: list[str], length: int) -> np.ndarray:
    """Sum of code point times power of its place: an edit changes it by a term or two."""
    return (_codes(words, length) * _powers(length)).sum(axis=1, dtype=np.uint64)


def _cells(values: np.ndarray, parts: int, cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each hash the part of its length's filter, its cell there, and its bits."""
    mixed = mix(values)
    part = (mixed >> np.uint64(52)) % np.uint64(parts)
    cell = (mixed & np.uint64(0xFFFFFFFF)) % np.uint64(cells)
    bits = np.zeros(len(values), np.uint64)
    again = mix(mixed ^ np.uint64(_BASE))
    for i in range(PROBES):
        bits |= np.uint64(1) << ((again >> np.uint64(6 * i)) & np.uint64(63))
    return part, cell, bits


def _shards(sizes: dict[int, int], most: int) -> list[dict[int, dict]]:
    """Rounds of filters: {length: parts, cells per part, the parts of this round}."""
    rounds: list[dict[int, dict]] = [{}]
    room = most
    for length, count in sorted(sizes.items()):
        cells = max(1, math.ceil(count * CELLS_PER_WORD))
        parts = math.ceil(cells / most)
        cells = math.ceil(cells / parts)
        for part in range(parts):
            if cells > room:
                rounds.append({})
                room = most
            shard = rounds[-1].setdefault(length, {"parts": parts, "cells": cells, "held": []})
            shard["held"].append(part)
            room -= cells
    return [r for r in rounds if r]


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str], list[int]]]:
    rows: dict[int, tuple[list[str], list[int]]] = {}
    for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
        own = rows.setdefault(len(word), ([], []))
        own[0].append(word)
        own[1].append(n)
    for length, (words, counts) in rows.items():
        yield length, words, counts


def _marker(shards: dict[int, dict]):
    schema = pa.schema([("length", pa.int32()), ("part", pa.int32()), ("cell", pa.int64()), ("bits", pa.int64())])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, words, _ in _by_length(batch):
                shard = shards[length]
                part, cell, bits = _cells(hashes(words, length), shard["parts"], shard["cells"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(words), length, np.int32)), pa.array(part.astype(np.int32)),
                     pa.array(cell.astype(np.int64)), pa.array(bits.view(np.int64))], schema=schema)
    return mark


def _filters(words: DataFrame, shards: dict[int, dict]) -> dict[int, dict]:
    """The shards with a table of cells for each part of this round: MAX_CELLS cells in all."""
    held = F.lit(False)
    for length, shard in shards.items():
        held = held | ((F.col("length") == length) & F.col("part").isin(shard["held"]))
    lengths = list(shards)
    cells = words.filter(F.char_length("word").isin(lengths)) \
        .mapInArrow(_marker(shards), "length int, part int, cell long, bits long") \
        .filter(held).groupBy("length", "part", "cell").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = {length: {**shard, "tables": {p: np.zeros(shard["cells"], np.uint64) for p in shard["held"]}}
           for length, shard in shards.items()}
    at = [cells.column(c).to_numpy() for c in ("length", "part", "cell", "bits")]
    for length, shard in out.items():
        for part, table in shard["tables"].items():
            own = (at[0] == length) & (at[1] == part)
            table[at[2][own]] = at[3][own].view(np.uint64)
    return out


def _admitted(values: np.ndarray, shard: dict) -> np.ndarray:
    """Which hashes the filters of this round admit."""
    part, cell, bits = _cells(values, shard["parts"], shard["cells"])
    out = np.zeros(len(values), bool)
    for p, table in shard["tables"].items():
        own = np.flatnonzero(part == p) if shard["parts"] > 1 else slice(None)
        out[own] = (table[cell[own]] & bits[own]) == bits[own]
    return out


def _deletions(codes: np.ndarray, shard: dict) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of admitted deletions; of a run of equal letters the last alone."""
    length = codes.shape[1]
    terms = codes * _powers(length)
    through = np.cumsum(terms, axis=1, dtype=np.uint64)
    values = (through - terms) + (through[:, -1:] - through) * np.uint64(_INVERSE)
    distinct = np.ones(codes.shape, bool)
    distinct[:, :-1] = codes[:, :-1] != codes[:, 1:]
    row, place = np.nonzero(distinct)
    ok = _admitted(values[row, place], shard)
    return row[ok], place[ok]


def _replacements(codes: np.ndarray, alphabet: np.ndarray, shard: dict) -> tuple[np.ndarray, ...]:
    """(row, place, letter) of admitted replacements by a higher letter: each pair once."""
    powers = _powers(codes.shape[1])
    whole = (codes * powers).sum(axis=1, dtype=np.uint64)
    found = []
    wide = max(1, EDITS // max(1, len(codes) * len(alphabet)))
    for low in range(0, codes.shape[1], wide):
        some = codes[:, low:low + wide]
        step = alphabet[None, None, :] - some[:, :, None]
        row, place, letter = np.nonzero(alphabet[None, None, :] > some[:, :, None])
        values = whole[row] + step[row, place, letter] * powers[low + place]
        ok = _admitted(values, shard)
        found.append((row[ok], place[ok] + low, alphabet[letter[ok]]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _prober(sent, alphabet: list[int]):
    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("other", pa.string())])
    letters = np.array(sorted(alphabet), np.uint64)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = sent.value
        for batch in batches:
            for length, words, counts in _by_length(batch):
                few = max(1, EDITS // (length * len(letters)))
                for low in range(0, len(words), few):
                    some = words[low:low + few]
                    codes = _codes(some, length)
                    rows, others = [], []
                    if length - 1 in shards:
                        for r, i in zip(*(x.tolist() for x in _deletions(codes, shards[length - 1]))):
                            rows.append(low + r)
                            others.append(some[r][:i] + some[r][i + 1:])
                    if length in shards:
                        hits = _replacements(codes, letters, shards[length])
                        for r, i, c in zip(*(x.tolist() for x in hits)):
                            rows.append(low + r)
                            others.append(some[r][:i] + chr(c) + some[r][i + 1:])
                    if rows:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([words[r] for r in rows], pa.string()),
                             pa.array([counts[r] for r in rows], pa.int64()),
                             pa.array(others, pa.string())], schema=schema)
    return probe


def near_pairs(words: DataFrame, most_cells: int = MAX_CELLS) -> DataFrame:
    """(word, n, other, other_n): every pair of near words of (word, n), once.

    Words must be distinct, not empty, and of LETTERS, whose 116 code points bound the alphabet.
    """
    spark = words.sparkSession
    sizes = {r[0]: r[1] for r in words.groupBy(F.char_length("word")).count().collect()}  # lengths
    alphabet = [ord(r[0]) for r in words.select(F.explode(F.split("word", "")).alias("c"))
                .filter("c != ''").distinct().collect()]
    exact = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pairs = None
    for shards in _shards(sizes, most_cells):
        filters = spark.sparkContext.broadcast(_filters(words, shards))
        asked = sorted({*shards, *(length + 1 for length in shards)})
        # Words are few bytes and many edits: as many tasks as a shuffle has, not as files have.
        hits = words.filter(F.char_length("word").isin(asked)).repartition(tasks, "word") \
            .mapInArrow(_prober(filters, alphabet), "word string, n long, other string")
        found = staged(hits.join(exact, "other").select("word", "n", "other", "other_n"))
        filters.destroy()
        pairs = found if pairs is None else pairs.unionByName(found)
    if pairs is None:
        return words.select("word", "n", F.col("word").alias("other"), F.col("n").alias("other_n")).limit(0)
    return pairs


def _roots(forms: DataFrame, steps: int) -> DataFrame:
    """(word, root): the end of each chain of forms of at most this many steps."""
    reach = staged(forms.select("word", F.col("form").alias("root")))
    for _ in range(math.ceil(math.log2(max(2, steps)))):
        on = reach.select(F.col("word").alias("root"), F.col("root").alias("further"))
        reach = staged(reach.join(on, "root", "left")
                       .select("word", F.coalesce("further", "root").alias("root")))
    return reach


def variants(words: DataFrame, factor: int = 5, most_cells: int = MAX_CELLS) -> DataFrame:
    """Per word of (word, n): form, root, n, n_near, form_n.

    form: the near word with the greatest n, if that is at least `factor` (two or more) times the
    word's; root: the last of the forms from word on; n_near: near words.
    """
    if factor < 2:
        raise ValueError("factor must be 2 at least")
    words = staged(words.select("word", "n"))
    pairs = near_pairs(words, most_cells)
    sides = F.inline(F.array(
        F.struct("word", F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form")).alias("near")),
        F.struct(F.col("other").alias("word"),
                 F.struct((-F.col("n")).alias("less"), F.col("word").alias("form")).alias("near"))))
    best = pairs.select(sides).groupBy("word").agg(
        F.min("near").alias("best"), F.count("*").alias("n_near"))
    enough = -F.col("best.less") >= factor * F.col("n")
    formed = staged(words.join(best, "word", "left").select(
        "word", F.when(enough, F.col("best.form")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, -F.col("best.less")).alias("form_n")))
    most = words.agg(F.max("n")).first()[0] or 1
    roots = _roots(formed.filter(F.col("form").isNotNull()), 1 + math.ceil(math.log(most, factor)))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
