"""Scoring texts with a hierarchical Pitman-Yor model of words.

The restaurant of a word is that of its context, the last two bytes of the word before it; all context
restaurants share one parent, the restaurant of all words, whose parent is the even distribution
over the training words and one unknown word. A customer is a use of a word in the training texts;
the tables that a word has in the contexts are its customers in the parent. Seating is sampled by
Gibbs: in a turn all customers of a cell leave and are seated anew, by one draw of their number of
tables, which is all that the model needs of a seating; probabilities are averaged over several.

All that a word needs is where the word is: uses are gathered by ranges of the word's hash, packed by
blocks of documents, so Spark shuffles a row per block and range. What the ranges share is one
number per context (its tables): in each of SWEEPS passes the ranges draw with the sampled tables of
the pass before (the first with one table per word and context), and these are summed. To score, blocks send their cells (word
and context) to the ranges and get back sums per document.

Null and empty texts have the end token alone. Rows that repeat an id are scored one by one; a
null id counts as the empty text in the split. Without training texts all words are unknown.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfproof.llm.graph import staged
from shelfproof.llm.words import Words, blocks

BLOCK = 16 << 20
CONTEXTS = 1 << 16
#: Context of a text's first word; no word ends in these bytes.
START = 0x2020
END = xxhash.xxh3_64_intdigest(b" end")
STRENGTH = 1.0
SWEEPS, BURN, SAMPLES = 3, 2, 3
#: Dishes of more tables than this in the mean have their number drawn from three cumulants.
DIRECT = 150
#: Rows of weights grow by one customer up to here, by leaps beyond.
SINGLE, LEAP = 1000, 0.2


# ---- arrays in binary columns --------------------------------------------------------------

def press(*arrays: np.ndarray) -> bytes:
    """Arrays by byte planes, compressed."""
    packer, out = zstandard.ZstdCompressor(level=1), []
    for a in arrays:
        a = np.ascontiguousarray(a)
        planes = a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T
        data = packer.compress(np.ascontiguousarray(planes).tobytes())
        head = np.array([len(a), len(data)], np.int64).tobytes() + a.dtype.str.encode().ljust(8)
        out.append(head + data)
    return b"".join(out)


def unpress(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        n, size = np.frombuffer(data, np.int64, 2, at)
        kind = np.dtype(data[at + 16:at + 24].decode().strip())
        raw = zstandard.ZstdDecompressor().decompress(
            data[at + 24:at + 24 + size], max_output_size=max(int(n) * kind.itemsize, 1))
        planes = np.frombuffer(raw, np.uint8).reshape(kind.itemsize, n).T
        out.append(np.ascontiguousarray(planes).reshape(-1).view(kind) if n else np.zeros(0, kind))
        at += 24 + int(size)
    return out


def _steps(sorted_hashes: np.ndarray) -> np.ndarray:
    return np.diff(sorted_hashes, prepend=np.uint64(0))


# ---- blocks of documents -------------------------------------------------------------------

@dataclass
class Block:
    """Cells of a block: (word hash, context), sorted; and each token's cell."""

    hashes: np.ndarray
    contexts: np.ndarray
    cell: np.ndarray
    owner: np.ndarray

    @classmethod
    def of(cls, column: pa.Array) -> Block:
        words = Words(column)
        names = np.append(words.hashes(), np.uint64(END))
        tails = words.values.to_pylist()
        tail = np.array([v[-1] | (v[-2] if len(v) > 1 else 0) << 8 for v in tails] + [START], np.int64)
        sizes = np.diff(words.bounds)
        owner = np.repeat(np.arange(len(column)), sizes + 1)
        ids = np.full(len(owner), len(tails), np.int64)  # the end, unless a word is here
        ids[np.arange(len(words.ids)) + np.repeat(np.arange(len(column)), sizes)] = words.ids
        before = np.concatenate([[len(tails)], ids[:-1]])  # after an end comes a start
        order = np.argsort(names)
        rank = np.empty(len(names), np.int64)
        rank[order] = np.arange(len(names))
        codes, cell = np.unique(rank[ids] * CONTEXTS + tail[before], return_inverse=True)
        return cls(names[order][codes // CONTEXTS], (codes % CONTEXTS).astype(np.uint16), cell, owner)

    def ranges(self, count: int) -> np.ndarray:
        """Where the cells of each range begin."""
        of = (self.hashes >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)
        return np.searchsorted(of, np.arange(count + 1, dtype=np.uint64))


def _counter(ranges: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, limit=BLOCK):
            block = Block.of(part.column("text"))
            uses = np.bincount(block.cell, minlength=len(block.hashes)).astype(np.uint32)
            edges = block.ranges(ranges)
            rows = [(r, press(_steps(block.hashes[a:b]), block.contexts[a:b], uses[a:b]))
                    for r, (a, b) in enumerate(zip(edges[:-1], edges[1:])) if b > a]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r for r, _ in rows], pa.int32()), pa.array([p for _, p in rows], pa.binary())],
                names=["range", "cells"])
    return count


def _merge(table: pa.Table) -> pa.Table:
    """All cells of a range, with what the whole model needs to know of them."""
    parts = [unpress(p) for p in table.column("cells").to_pylist()]
    hashes = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts])
    contexts = np.concatenate([p[1] for p in parts]).astype(np.uint64)
    uses = np.concatenate([p[2] for p in parts]).astype(np.int64)
    order = np.lexsort((contexts, hashes))
    hashes, contexts, uses = hashes[order], contexts[order], uses[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (contexts[1:] != contexts[:-1])
    first = np.flatnonzero(fresh)
    uses = np.add.reduceat(uses, first)
    hashes, contexts = hashes[first], contexts[first].astype(np.int64)
    spread = np.diff(np.append(np.flatnonzero(np.diff(hashes, prepend=~hashes[:1])), len(hashes)))
    seen = np.unique(contexts)
    totals = np.bincount(contexts, uses, CONTEXTS)[seen]
    kinds = np.bincount(contexts, minlength=CONTEXTS)[seen]
    return pa.table({
        "range": pa.array([table.column("range")[0].as_py()], pa.int32()),
        "cells": pa.array([press(_steps(hashes), contexts.astype(np.uint16), uses)], pa.binary()),
        "words": pa.array([len(spread)], pa.int64()),
        "ones": pa.array([[int((uses == 1).sum()), int((uses == 2).sum()),
                           int((spread == 1).sum()), int((spread == 2).sum())]], pa.list_(pa.int64())),
        "contexts": pa.array([[{"context": int(c), "uses": int(u), "kinds": int(k)}
                               for c, u, k in zip(seen, totals, kinds)]])})


_MERGED = ("range int, cells binary, words long, ones array<long>, "
           "contexts array<struct<context: long, kinds: long, uses: long>>")


# ---- seating -------------------------------------------------------------------------------

class Ratios:
    """Logarithms of R(c, t) = S(c, t) / S(c, 1) d^(t-1) (t-1)!, S(c, t) being the generalised
    Stirling numbers: the weight of all ways to seat c customers at t tables.

    One customer more multiplies the row by 1 - B / (c - d), with B the same matrix for all c. So the
    factors commute, and many customers at once are a polynomial in B whose coefficients are
    elementary symmetric sums: a leap, taken to the fourth order, over as many customers as keep
    the first term below LEAP. A row of c customers takes some width x log c steps, not c.
    """

    def __init__(self, discount: float):
        self.d = discount
        self.rows: dict[int, np.ndarray] = {}

    def hold(self, counts: np.ndarray, widths: np.ndarray) -> None:
        """Have the first `widths` places of the rows of `counts` (ascending)."""
        if all(len(self.rows.get(c, ())) >= w for c, w in zip(counts.tolist(), widths.tolist())):
            return
        widths = np.minimum(counts, widths + widths // 4)  # later turns need a few more
        # A row needs as many places as any later one.
        upto = np.maximum.accumulate(widths[::-1])[::-1]
        tables = np.arange(1, int(upto[0]) + 2)
        with np.errstate(divide="ignore"):
            join = np.log((tables - 1) * self.d)
        row, c, self.rows = np.zeros(1), 1, {}
        for count, width in zip(counts.tolist(), upto.tolist()):
            while c < count:
                n = min(c + 1, width)
                kept = row[:n]
                leap = min(count - c, int(LEAP * c / (self.d * n))) if c >= SINGLE else 1
                if leap > 4:
                    row = self._leap(kept, c, leap)
                    c += leap
                    continue
                stay = np.log(c - tables[:len(kept)] * self.d) + kept
                row = np.full(n, -np.inf)
                row[:len(kept)] = stay
                row[1:] = np.logaddexp(row[1:], join[1:n] + kept[:n - 1])
                row -= np.log(c - self.d)
                c += 1
            self.rows[count] = row[:width]

    def _leap(self, row: np.ndarray, c: int, more: int) -> np.ndarray:
        low, high = c - 0.5 - self.d, c + more - 0.5 - self.d
        s1, s2, s3, s4 = (np.log1p(more / low), 1 / low - 1 / high,
                          (low ** -2 - high ** -2) / 2, (low ** -3 - high ** -3) / 3)
        e1 = s1
        e2 = (e1 * s1 - s2) / 2
        e3 = (e2 * s1 - e1 * s2 + s3) / 3
        e4 = (e3 * s1 - e2 * s2 + e1 * s3 - s4) / 4
        rate = self.d * np.arange(len(row))
        out = power = np.exp(row)
        for e in (-e1, e2, -e3, e4):
            power = rate * np.diff(power, prepend=0.0, append=0.0)[:-1]
            out = out + e * power
        with np.errstate(divide="ignore"):
            return np.log(np.maximum(out, 0.0))


def _moments(customers: np.ndarray, pull: np.ndarray, d: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, variance and third cumulant of the number of tables, from a saddle point.

    pull^t S(c, t) is, but for a factor, the chance that a Poisson number t of tables with sizes of
    generating function 1 - (1 - z)^d holds c customers together. With z where the mean total is
    c, the sum over t is exp(K) / (z^c sqrt(2 pi V)); its derivatives by log pull are the cumulants.
    """
    much, least = np.log(pull), np.log(customers)
    low, high = np.full(len(pull), -700.0), np.zeros(len(pull))
    for _ in range(60):  # y = log(1 - z)
        y = (low + high) / 2
        more = much + np.log(-np.expm1(y)) + (d - 1) * y > least
        low, high = np.where(more, y, low), np.where(more, high, y)
    z, rest = -np.expm1(low), np.exp(low)
    tables, slope = -np.expm1(d * low) * pull / d, 1 - d * z
    spread = tables - customers * rest / slope
    skew = spread - customers * (1 - d) * z * rest / slope ** 3
    # Near z = 1 one table holds nearly all customers, and the mean is one above the others'.
    return tables + np.minimum(z * (1 - d) / (2 * slope ** 2), 1.0), np.maximum(spread, 0.0), skew


def reseated(customers: np.ndarray, pull: np.ndarray, ratios: Ratios,
             rng: np.random.Generator) -> np.ndarray:
    """Tables of dishes whose customers have all been seated anew.

    A new table weighs `pull`, a table of n customers n - d; t tables have the weight
    pull^t S(c, t), and t is drawn from that: the distribution that single moves tend to. Up to
    60 customers all t are weighed. Of more, those up to the mean + 12 standard deviations + 60:
    the number is a sum of independent yes-or-no draws, so a larger one has a chance below 1e-20.
    Dishes of more than DIRECT tables in the mean take the normal draw with mean, variance and third
    cumulant: an approximation whose distribution function is within 0.012 of the weights', measured
    for discounts 0.1 to 0.95 and 1,000 to 20,000 customers; its cost does not depend on the customers.
    """
    out = np.ones(len(customers), np.int64)
    if not len(customers):
        return out
    rate = np.log(pull / ratios.d)
    width = customers.astype(np.int64)
    big = np.flatnonzero(customers > 60)
    mean, spread, skew = _moments(customers[big].astype(float), pull[big], ratios.d)
    width[big] = np.minimum(width[big], np.ceil(mean + 12 * np.sqrt(np.minimum(mean, spread + 1)) + 60))
    draws = rng.random(len(customers))
    direct = big[mean > DIRECT]
    if len(direct):
        some = mean > DIRECT
        g, sd = rng.standard_normal(len(direct)), np.sqrt(spread[some])
        bend = skew[some] / np.maximum(spread[some], 1e-9) / 6
        t = np.rint(mean[some] + sd * g + bend * (g * g - 1))
        out[direct] = np.clip(t, 1, customers[direct])
    weighed = np.ones(len(customers), bool)
    weighed[direct] = False
    order = np.lexsort((width, customers))
    order = order[weighed[order]]
    if not len(order):
        return out
    counts, begins = np.unique(customers[order], return_index=True)
    ends = np.append(begins[1:], len(order))
    ratios.hold(counts, width[order[ends - 1]])
    for count, begin, end in zip(counts.tolist(), begins.tolist(), ends.tolist()):
        while begin < end:
            some = order[begin:min(end, begin + max(1, (1 << 18) // int(width[order[end - 1]])))]
            t = np.arange(int(width[some[-1]]))
            base = ratios.rows[count][:len(t)] - np.concatenate([[0.0], np.cumsum(np.log(t[1:]))])
            weight = base + rate[some][:, None] * t
            weight = np.cumsum(np.exp(weight - weight.max(axis=1, keepdims=True)), axis=1)
            out[some] += (weight[:, :-1] <= (draws[some] * weight[:, -1])[:, None]).sum(axis=1)
            begin += len(some)
    return out


class Seats:
    """Tables of many restaurants' dishes, each dish with two customers or more, moved one customer
    at a time: slow for many customers, and what `reseated` is held against in tests.

    sizes: customers per table, dish after dish, with some empty places in between.
    """

    def __init__(self, customers: np.ndarray, pull: np.ndarray, discount: float,
                 rng: np.random.Generator):
        self.c, self.d, self.rng = customers, discount, rng
        n = len(customers)
        # The first customers one by one, later ones as they come in expectation.
        few = 8
        early = np.zeros((n, few))
        early[:, 0] = 1
        t = np.ones(n, np.int64)
        for k in range(1, few):
            on = np.flatnonzero(customers > k)
            new = rng.random(len(on)) * (pull[on] + k - discount * t[on]) < pull[on]
            early[on[new], t[on[new]]] = 1
            t[on[new]] += 1
            stay = on[~new]
            weight = np.cumsum(np.maximum(early[stay] - discount, 0) * (early[stay] > 0), axis=1)
            pick = (weight < (rng.random(len(stay)) * weight[:, -1])[:, None]).sum(axis=1)
            early[stay, np.minimum(pick, few - 1)] += 1
        tables, at = t.astype(float), np.minimum(customers, few).astype(float)
        for _ in range(24):  # tables as customers grow, in even steps of the logarithm
            to = np.minimum(customers, at * 1.8)
            tables += (to - at) * pull / (pull + (at + to) / 2 - discount * tables)
            at = to
        tables += (customers - at) * pull / (pull + (at + customers) / 2 - discount * tables)
        t = np.minimum(np.maximum(np.floor(tables).astype(np.int64), t), customers)
        room = np.minimum(customers, t + 2 + t // 4)
        self.begin = np.concatenate([[0], np.cumsum(room)])
        self.dish = np.repeat(np.arange(n), room)
        place = np.arange(len(self.dish)) - self.begin[self.dish]
        self.sizes = np.where(place < few, early[self.dish, np.minimum(place, few - 1)], 0).astype(np.int64)
        self.sizes[(place >= few) & (place < t[self.dish])] = 1
        seated = np.add.reduceat(self.sizes, self.begin[:-1]) if n else np.zeros(0, np.int64)
        self.sizes[self.begin[:-1]] += customers - seated
        self.t = np.bincount(self.dish, self.sizes > 0, n).astype(np.int64)

    def move(self, pull: np.ndarray) -> None:
        """One customer of each dish leaves and chooses again."""
        n = len(self.c)
        if not n:
            return
        ends = np.cumsum(self.sizes)
        before = ends[self.begin[1:] - 1] - self.c
        table = np.searchsorted(ends, before + np.floor(self.rng.random(n) * self.c), side="right")
        self.sizes[table] -= 1
        self.t -= self.sizes[table] == 0
        held = self.c - 1 - self.d * self.t
        new = self.rng.random(n) * (pull + held) < pull
        weight = np.where(self.sizes > 0, self.sizes - self.d, 0.0)
        ends = np.cumsum(weight)
        before = np.where(self.begin[:-1] > 0, ends[self.begin[:-1] - 1], 0.0)
        to = np.searchsorted(ends, before + self.rng.random(n) * held, side="right")
        to = np.clip(to, self.begin[:-1], self.begin[1:] - 1)
        lost = ~new & (self.sizes[to] == 0)  # rounding at an edge: back to where it was
        to = np.where(lost, table, to)
        if new.any():
            empty = np.flatnonzero(self.sizes == 0)
            owners, at = np.unique(self.dish[empty], return_index=True)
            free = np.full(n, -1, np.int64)
            free[owners] = empty[at]
            full = new & (free < 0)
            to = np.where(new & ~full, free, to)
            np.add.at(self.sizes, to[~full], 1)
            if full.any():  # a place more for these
                dishes = np.flatnonzero(full)
                self.sizes = np.insert(self.sizes, self.begin[dishes + 1], 1)
                self.dish = np.insert(self.dish, self.begin[dishes + 1], dishes)
                self.begin = np.searchsorted(self.dish, np.arange(n + 1))
        else:
            np.add.at(self.sizes, to, 1)
        self.t = np.bincount(self.dish, self.sizes > 0, n).astype(np.int64)


@dataclass
class Shared:
    """What all ranges know: per context its uses and tables, the sums, the discounts."""

    uses: np.ndarray
    tables: np.ndarray
    root_tables: float
    words: int
    discount: float
    root_discount: float

    @property
    def root_uses(self) -> float:
        return float(self.tables.sum())

    @property
    def unknown(self) -> float:
        """The parent's probability of a word that it has not seen."""
        return (STRENGTH + self.root_discount * self.root_tables) / (STRENGTH + self.root_uses) \
            / (self.words + 1)


class Cells:
    """The cells of one range, sampled with the same draws whenever it is built."""

    def __init__(self, payload: bytes, number: int, shared: Shared):
        steps, contexts, self.uses = unpress(payload)
        self.hashes = np.cumsum(steps, dtype=np.uint64)
        self.contexts = contexts.astype(np.int64)
        self.names, self.word = np.unique(self.hashes, return_inverse=True)
        rng = np.random.default_rng(number)
        many = np.flatnonzero(self.uses > 1)
        t = np.ones(len(self.uses), np.int64)
        ratios, top = Ratios(shared.discount), Ratios(shared.root_discount)
        self.tables = np.zeros(len(self.uses))
        self.root, self.root_tables = np.zeros(len(self.names)), np.zeros(len(self.names))
        parent = self._parent(shared, t, np.ones(len(self.names)))
        for turn in range(BURN + SAMPLES):
            weight = STRENGTH + shared.discount * shared.tables[self.contexts[many]]
            pull = weight * parent[self.word[many]]
            t[many] = reseated(self.uses[many], pull, ratios, rng)
            served = np.bincount(self.word, t, len(self.names)).astype(np.int64)
            above = np.ones(len(self.names), np.int64)
            some = np.flatnonzero(served > 1)
            up = (STRENGTH + shared.root_discount * shared.root_tables) / (shared.words + 1)
            above[some] = reseated(served[some], np.full(len(some), up), top, rng)
            parent = self._parent(shared, t, above)
            if turn >= BURN:
                self.tables += t / SAMPLES
                self.root += served / SAMPLES
                self.root_tables += above / SAMPLES

    def _parent(self, shared: Shared, t: np.ndarray, above: np.ndarray) -> np.ndarray:
        served = np.bincount(self.word, t, len(self.names))
        return (served - shared.root_discount * above) / (STRENGTH + shared.root_uses) + shared.unknown

    def probabilities(self, shared: Shared) -> tuple[np.ndarray, np.ndarray]:
        """Averaged: what each cell has of its own, and the parent's probability of each word."""
        own = (self.uses - shared.discount * self.tables) / (STRENGTH + shared.uses[self.contexts])
        parent = (self.root - shared.root_discount * self.root_tables) \
            / (STRENGTH + shared.root_uses) + shared.unknown
        return own, parent


def _summer(shared: Shared):
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, payload in zip(batch.column("range").to_pylist(), batch.column("cells").to_pylist()):
                cells = Cells(payload, number, shared)
                tables = np.bincount(cells.contexts, cells.tables, CONTEXTS)
                at = np.flatnonzero(tables)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.append(at, -1)), pa.array(np.append(tables[at], cells.root_tables.sum()))],
                    names=["context", "tables"])
    return sums


def _swept(merged: DataFrame, shared: Shared) -> Shared:
    """What the ranges have together after a pass."""
    summed = merged.select("range", "cells").mapInArrow(_summer(shared), "context long, tables double") \
        .groupBy("context").agg(F.sum("tables").alias("tables")).collect()
    tables, root = np.zeros(CONTEXTS), 0.0
    for r in summed:
        if r["context"] < 0:
            root = r["tables"]
        else:
            tables[r["context"]] = r["tables"]
    return replace(shared, tables=tables, root_tables=root)


# ---- scoring -------------------------------------------------------------------------------

def _asker(ranges: int):
    schema = pa.schema([("range", pa.int32()), ("block", pa.int64()), ("ask", pa.binary()),
                        ("docs", pa.list_(pa.int64()))])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        for number, part in enumerate(blocks(batches, limit=BLOCK)):
            block = Block.of(part.column("text"))
            edges = block.ranges(ranges)
            # (range, document, cell) in order, with the number of uses.
            width = max(len(block.hashes), 1)
            of = np.searchsorted(edges, block.cell, side="right") - 1
            codes, uses = np.unique((of * part.num_rows + block.owner) * width + block.cell,
                                    return_counts=True)
            cell = codes % width
            owner = codes // width % part.num_rows
            bounds = np.searchsorted(codes // width // part.num_rows, np.arange(ranges + 1))
            rows = []
            home = (TaskContext.get().partitionId() + number) % ranges  # which answer brings the ids
            for r in range(ranges):
                a, b, i, j = edges[r], edges[r + 1], bounds[r], bounds[r + 1]
                if b > a or r == home:
                    rows.append((r, press(
                        _steps(block.hashes[a:b]), block.contexts[a:b],
                        np.diff(owner[i:j], prepend=0).astype(np.int32), (cell[i:j] - a).astype(np.uint32),
                        uses[i:j].astype(np.uint32), np.array([part.num_rows], np.int64))))
            ids = part.column("doc_id").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([r for r, _ in rows], pa.int32()), pa.array([base + number] * len(rows), pa.int64()),
                 pa.array([p for _, p in rows], pa.binary()),
                 pa.array([ids if r == home else None for r, _ in rows], pa.list_(pa.int64()))], schema=schema)
    return ask


_ANSWER = pa.schema([("block", pa.int64()), ("sums", pa.binary()), ("docs", pa.list_(pa.int64()))])


def _answerer(before: Shared, shared: Shared):
    train_tokens = float(shared.uses.sum())
    back = (STRENGTH + shared.discount * shared.tables) / (STRENGTH + shared.uses)

    def answer(key, model: Iterator[pa.RecordBatch], asked: pa.Table) -> pa.Table:
        rows = model.to_pylist()
        cells = Cells(rows[0]["cells"], rows[0]["range"], before) if rows else None
        if cells is not None:
            own, parent = cells.probabilities(shared)
            codes = cells.word * CONTEXTS + cells.contexts
            count = np.bincount(cells.word, cells.uses, len(cells.names))
        out = []
        for block, ask, docs in zip(*(asked.column(c).to_pylist() for c in ("block", "ask", "docs"))):
            steps, contexts, owner, cell, uses, rows_ = unpress(ask)
            hashes, contexts = np.cumsum(steps, dtype=np.uint64), contexts.astype(np.int64)
            above, mine, seen = (np.full(len(hashes), shared.unknown), np.zeros(len(hashes)),
                                 np.zeros(len(hashes)))
            if cells is not None and len(hashes):
                at = np.minimum(np.searchsorted(cells.names, hashes), len(cells.names) - 1)
                known = cells.names[at] == hashes
                above[known], seen[known] = parent[at[known]], count[at[known]]
                code = at * CONTEXTS + contexts
                slot = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
                same = known & (codes[slot] == code)
                mine[same] = own[slot[same]]
            log = np.log10(mine + back[contexts] * above)
            base = np.log10((seen + 1) / (train_tokens + shared.words + 1))
            owner = np.cumsum(owner)
            sums = [np.bincount(owner, uses * v[cell], rows_[0]) for v in (log, base)]
            sums += [np.bincount(owner, uses * (seen[cell] > 0), rows_[0]).astype(np.int32),
                     np.bincount(owner, uses, rows_[0]).astype(np.int32)]
            out.append((block, press(*sums), docs))
        return pa.table([pa.array([o[i] for o in out], f.type) for i, f in enumerate(_ANSWER)], schema=_ANSWER)
    return answer


def _total(table: pa.Table) -> pa.Table:
    """Sums of a block's documents over all ranges."""
    total, ids = None, []
    for sums, docs in zip(table.column("sums").to_pylist(), table.column("docs").to_pylist()):
        arrays = [a.astype(np.float64) for a in unpress(sums)]
        total = arrays if total is None else [x + y for x, y in zip(total, arrays)]
        ids = docs if docs is not None else ids
    log, base, known, tokens = total
    return pa.table({"doc_id": pa.array(ids, pa.int64()), "n_tokens": pa.array(tokens.astype(np.int64)),
                     "n_known": pa.array(known.astype(np.int64)), "base_score": pa.array(base),
                     "score": pa.array(log)})


def scores(docs: DataFrame, held_out: Column) -> DataFrame:
    """Per document: doc_id, n_tokens, n_known, train_tokens, base_score, score (log10).

    docs: doc_id, text; held_out: condition on doc_id, the documents not to learn from. base_score
    is that of single words, counts plus one.
    """
    spark = docs.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    merged = staged(
        rows.filter(~held_out).mapInArrow(_counter(ranges), "range int, cells binary")
        .groupBy("range").applyInArrow(_merge, _MERGED))
    uses, tables = np.zeros(CONTEXTS), np.zeros(CONTEXTS)
    seen = merged.select(F.explode("contexts").alias("c")).groupBy("c.context") \
        .agg(F.sum("c.uses").alias("uses"), F.sum("c.kinds").alias("kinds"))
    for r in seen.collect():  # CONTEXTS rows at most
        uses[r["context"]], tables[r["context"]] = r["uses"], r["kinds"]
    ones = merged.agg(F.sum("words"), *(F.sum(F.col("ones")[i]) for i in range(4))).first()
    words, n1, n2, m1, m2 = (x or 0 for x in ones)
    first = Shared(uses, tables, float(words), int(words), min(max(n1 / max(n1 + 2 * n2, 1), 0.1), 0.95),
                   min(max(m1 / max(m1 + 2 * m2, 1), 0.1), 0.95))
    shared = first
    for _ in range(SWEEPS):
        before, shared = shared, _swept(merged, shared)
    asked = rows.mapInArrow(_asker(ranges), "range int, block long, ask binary, docs array<long>")
    answers = merged.select("range", "cells").groupBy("range").cogroup(asked.groupBy("range")) \
        .applyInArrow(_answerer(before, shared), "block long, sums binary, docs array<long>")
    return answers.groupBy("block").applyInArrow(
        _total, "doc_id long, n_tokens long, n_known long, base_score double, score double") \
        .withColumn("train_tokens", F.lit(int(uses.sum())).cast("long"))
