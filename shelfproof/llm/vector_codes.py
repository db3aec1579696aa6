"""Codes of vectors: each of a vector's parts is named by the nearest entry of a codebook.

Codebooks are refined by Lloyd's rounds on integers, so that all results are exact and do not depend
on how rows are dealt out.

1. A task builds a cover tree for each part of each block of its vectors: centres of one level are
   farther apart than that level's radius, every vector lies within it of its centre, and a
   centre of one level is one of all deeper levels. Vectors are stored in tree order, so that a
   node is a range of rows that begins with its centre, and cumulative sums over the rows give
   the sum of any node. Trees are built once and written to the shared folder.
2. A round walks each tree from its root. If the nearest entry to a node's centre is nearer than
   any other by more than twice the node's radius, it is the nearest of the whole subtree, by the
   triangle inequality, and the subtree's sum is added to it. Only other nodes are descended
   into; nodes without extent, such as single vectors, are compared exactly.
3. A task gives its sums per entry, Spark adds them up, and the driver holds the codebooks alone:
   `entries` times the length of a vector, whatever the number of rows.

Vectors that are null, or hold null or non-finite components, are left out. All others must have
one length, a multiple of the number of parts; components times SCALE must lie within LIMIT, or the
job ends with an error, as does one whose distances overflow a long. Rows that repeat a vec_id are rows like others, in
the order of their vectors where ids decide; rows without one come last. Equal distances go to the
lower entry. Fewer rows than entries give fewer entries, an empty table none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfproof.llm.graph import staged

SCALE = 1024
#: The greatest whole component.
LIMIT = 1 << 28
#: Vectors of one tree: distances between all of them are held for a moment, 8 MB.
BLOCK_ROWS = 1024
#: Copies of a label's sum, so that the rows of a frequent label spread over as many tasks.
SALTS = 16

Tree = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def whole(components: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) for each component."""
    out = np.floor(components.astype(np.float64) * SCALE)
    if len(out) and np.abs(out).max(initial=0) > LIMIT:
        raise ArithmeticError(f"a component is larger than {LIMIT // SCALE}")
    return out.astype(np.int32)


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x to all rows of y.

    Doubles are exact for whole numbers below 2^53; larger ones take the slower way by longs.
    """
    most = 4 * int(max(np.abs(x).max(initial=0), np.abs(y).max(initial=0))) ** 2 * x.shape[1]
    if most >= 1 << 62:
        raise ArithmeticError("a squared distance does not fit a long")
    x, y = (v.astype(np.float64 if most < 1 << 53 else np.int64) for v in (x, y))
    return (x * x).sum(1)[:, None] - 2 * (x @ y.T) + (y * y).sum(1)[None, :]


# ---- trees ---------------------------------------------------------------------------------------

def _levels(apart: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The level at which each row becomes a centre, and each row's centre at each level.

    apart: squared distances. The radius of a level is half that of the level above. At each,
    the row that is farthest from all centres becomes one until none is farther than the radius.
    The last level has radius zero: each row's centre is equal to it.
    """
    n = len(apart)
    level = np.zeros(n, np.int64)
    far, centre = apart[0].copy(), np.zeros(n, np.int64)
    centres = [centre.copy()]
    radius = float(far.max())  # squared
    depth = 0
    at = int(far.argmax())
    while far[at] > 0:
        radius = radius / 4 if radius > 1 else 0.0
        if far[at] <= radius:
            continue
        depth += 1
        while far[at] > radius:
            level[at] = depth
            nearer = apart[at] < far
            far[nearer] = apart[at][nearer]
            centre[nearer] = at
            at = int(far.argmax())
        centres.append(centre.copy())
    return level, centres


def tree(points: np.ndarray) -> Tree:
    """(order, rows in that order, first, last, radius, level) of the nodes, level by level.

    A row is placed below its centre's centre and so on, so nodes are nested; the radius is that of
    the rows a node has. Nodes with the extent of the node above are left to that one; below a
    node without extent there is none.
    """
    apart = squared(points, points)
    level, centres = _levels(apart)
    last = len(centres) - 1
    # The ancestor of each row at each level, from the deepest up.
    above = [centres[last]]
    for depth in range(last, 0, -1):
        own = above[0]
        up = np.where(level[own] < depth, own, centres[depth - 1][own])
        above.insert(0, up)
    # A centre comes first below itself: keys of rows by ancestors, the centre's own line first.
    keys = []
    for depth in range(last, 0, -1):
        keys += [above[depth], above[depth] != above[depth - 1]]
    is_centre = above[last] == np.arange(len(points))
    order = np.lexsort([~is_centre, *keys, above[0]])
    first, after, radius, at_level = [], [], [], []
    open_ = np.ones(len(points), bool)  # rows below a node that has extent
    sizes = np.zeros(len(points), np.int64)
    for depth in range(last + 1):
        own = above[depth][order]
        new = np.ones(len(own), bool)
        new[1:] = own[1:] != own[:-1]
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(own))
        reach = np.maximum.reduceat(apart[own, order], starts)
        wanted = open_[starts] & ((ends - starts != sizes[starts]) | (depth == 0))
        first.append(starts[wanted])
        after.append(ends[wanted])
        radius.append(np.sqrt(reach[wanted]))
        at_level.append(np.full(wanted.sum(), depth))
        number = np.cumsum(new) - 1
        sizes = (ends - starts)[number]
        open_ = open_ & (reach[number] > 0)
    return (order, points[order], *(np.concatenate(x) for x in (first, after, radius, at_level)))


def assign(grown: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(first, last, entry) of subtrees that together hold all rows, and the centres compared."""
    _, rows, first, after, radius, level = grown
    best = np.full(len(rows), -1, np.int64)
    gap = np.zeros(len(rows))
    decided = np.zeros(len(rows), bool)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    compared = 0
    for depth in range(int(level[-1]) + 1 if len(level) else 0):
        own = np.flatnonzero(level == depth)
        own = own[~decided[first[own]]]
        centre = first[own]
        asked = centre[best[centre] < 0]
        if len(asked):
            compared += len(asked)
            away = squared(rows[asked], entries)
            nearest = away.argmin(1)
            best[asked] = nearest
            least = np.sqrt(away[np.arange(len(asked)), nearest])
            if len(entries) > 1:
                gap[asked] = np.sqrt(np.partition(away, 1, axis=1)[:, 1]) - least
            else:
                gap[asked] = np.inf
        # The margin covers the rounding of square roots.
        sure = (gap[centre] > 2 * radius[own] + 1e-6 * (1 + radius[own])) | (radius[own] == 0)
        lo, hi = centre[sure], after[own[sure]]
        out.append((lo, hi, best[lo]))
        edge = np.zeros(len(rows) + 1, np.int64)
        edge[lo] += 1
        edge[hi] -= 1
        decided |= np.cumsum(edge[:-1]) > 0
    lo, hi, entry = (np.concatenate(x) for x in zip(*out))
    return lo, hi, entry, compared


def _packed(grown: Tree) -> dict:
    order, rows, first, after, radius, level = grown
    return {"order_": order.astype(np.int32).tobytes(), "rows_": rows.astype(np.int32).tobytes(),
            "first_": first.astype(np.int32).tobytes(), "after_": after.astype(np.int32).tobytes(),
            "radius_": radius.astype(np.float64).tobytes(), "level_": level.astype(np.uint8).tobytes()}


def _unpacked(one: dict) -> Tree:
    order, first, after = (np.frombuffer(one[k], np.int32).astype(np.int64)
                           for k in ("order_", "first_", "after_"))
    rows = np.frombuffer(one["rows_"], np.int32).reshape(len(order), -1)
    return (order, rows, first, after, np.frombuffer(one["radius_"], np.float64),
            np.frombuffer(one["level_"], np.uint8))


_TREE = pa.list_(pa.struct([(k, pa.binary()) for k in ("order_", "rows_", "first_", "after_", "radius_", "level_")]))


# ---- tasks ---------------------------------------------------------------------------------------

def _matrix(column: pa.Array, length: int) -> np.ndarray:
    """The vectors of a list column as integer rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(flat) != length * len(column) or np.any(column.value_lengths().to_numpy() != length):
        raise ValueError(f"all vectors must have {length} components")
    return whole(flat).reshape(len(column), length)


def _grower(length: int, parts: int):
    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, BLOCK_ROWS):
                some = batch.slice(low, BLOCK_ROWS)
                vectors = _matrix(some.column("vector"), length)
                width = length // parts
                trees = [_packed(tree(vectors[:, p * width:(p + 1) * width])) for p in range(parts)]
                ends = pa.array([0, some.num_rows], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(ends, some.column("vec_id")),
                     pa.ListArray.from_arrays(ends, some.column("label")),
                     pa.array([trees], _TREE)], names=["ids", "labels", "trees"])
    return grow


def _summer(codebooks: list[np.ndarray]):
    schema = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("place", pa.int32()),
                        ("total", pa.int64()), ("n", pa.int64())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros(c.shape, np.int64) for c in codebooks]
        n = [np.zeros(len(c), np.int64) for c in codebooks]
        for batch in batches:
            for trees in batch.column("trees"):
                for p, one in enumerate(trees.as_py()):
                    grown = _unpacked(one)
                    lo, hi, entry, _ = assign(grown, codebooks[p])
                    sums = np.zeros((len(grown[0]) + 1, codebooks[p].shape[1]), np.int64)
                    np.cumsum(grown[1], axis=0, out=sums[1:])
                    np.add.at(total[p], entry, sums[hi] - sums[lo])
                    np.add.at(n[p], entry, hi - lo)
        for p, book in enumerate(codebooks):
            used = np.flatnonzero(n[p])
            width = book.shape[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(used) * width, p, np.int32)),
                 pa.array(np.repeat(used, width).astype(np.int32)),
                 pa.array(np.tile(np.arange(width, dtype=np.int32), len(used))),
                 pa.array(total[p][used].ravel()), pa.array(np.repeat(n[p][used], width))], schema=schema)
    return add


def _coder(codebooks: list[np.ndarray]):
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, labels = batch.column("ids")[i].values, batch.column("labels")[i].values
                named = np.zeros((len(ids), len(codebooks)), np.uint8)
                error = np.zeros(len(ids), np.int64)
                for p, one in enumerate(batch.column("trees")[i].as_py()):
                    grown = _unpacked(one)
                    lo, hi, entry, _ = assign(grown, codebooks[p])
                    by = np.argsort(lo)
                    entry = np.repeat(entry[by], (hi - lo)[by])
                    named[grown[0], p] = entry
                    off = grown[1].astype(np.int64) - codebooks[p][entry]
                    error[grown[0]] += (off * off).sum(1)
                codes = [row.tobytes().hex() for row in named]
                yield pa.RecordBatch.from_arrays(
                    [ids, labels, pa.array(codes, pa.string()), pa.array(error)], names=["vec_id", "label", "code", "error"])
    return code


# ---- the operator --------------------------------------------------------------------------------

def finite(vectors: DataFrame) -> DataFrame:
    """Rows whose vector is there and whole."""
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.filter(F.col("vector").isNotNull() & ~bad)


class Codes:
    """Codebooks fitted to a table of vectors, and the table's codes.

    vectors: vec_id, vector (an array of numbers), label. entries: at most 256 per part.
    """

    def __init__(self, vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4):
        if not 1 <= entries <= 256:
            raise ValueError("a code has a byte per part")
        rows = finite(vectors.select("vec_id", F.col("vector").cast("array<double>").alias("vector"), "label"))
        first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()
        length = len(first[0].vector) if first else 0
        if length % parts:
            raise ValueError(f"{length} components can't be cut into {parts} parts")
        if any(len(r.vector) != length for r in first):
            raise ValueError(f"all vectors must have {length} components")
        start = whole(np.array([r.vector for r in first], np.float64).reshape(len(first), length))
        self.types = (rows.schema["vec_id"].dataType, rows.schema["label"].dataType)
        self.codebooks = [x.astype(np.int64) for x in np.split(start, parts, axis=1)]
        fields = ["order_", "rows_", "first_", "after_", "radius_", "level_"]
        self.trees = staged(rows.mapInArrow(_grower(length, parts), T.StructType([
            T.StructField("ids", T.ArrayType(self.types[0])), T.StructField("labels", T.ArrayType(self.types[1])),
            T.StructField("trees", T.ArrayType(T.StructType([T.StructField(f, T.BinaryType()) for f in fields])))])))
        if first:
            for _ in range(rounds):
                self._refine()

    def _refine(self) -> None:
        """One round: each entry that vectors are nearest to becomes the floor of their mean."""
        schema = "part int, entry int, place int, total long, n long"
        sums = self.trees.select("trees").mapInArrow(_summer(self.codebooks), schema) \
            .groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).toArrow()
        part, entry, place, total, n = (sums.column(c).to_numpy() for c in ("part", "entry", "place", "total", "n"))
        for p, book in enumerate(self.codebooks):
            own = part == p
            book[entry[own], place[own]] = total[own] // n[own]

    def digest(self) -> str:
        """sha256 of all components by part, entry and place."""
        return hashlib.sha256(",".join(str(x) for b in self.codebooks for x in b.ravel().tolist()).encode()).hexdigest()

    def coded(self) -> DataFrame:
        """Per vector: vec_id, label, code (two hex digits per part), error (squared distance)."""
        return self.trees.mapInArrow(_coder(self.codebooks), T.StructType([
            T.StructField("vec_id", self.types[0]), T.StructField("label", self.types[1]),
            T.StructField("code", T.StringType()), T.StructField("error", T.LongType())]))


def with_label_error(coded: DataFrame) -> DataFrame:
    """Adds label_error: the errors of all rows of the same label, null being one."""
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error")) \
        .select(F.col("label").alias("_label"), "label_error",
                F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    salt = F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int")
    return coded.join(sums, coded["label"].eqNullSafe(sums["_label"]) & (salt == sums["_salt"])) \
        .drop("_label", "_salt")
