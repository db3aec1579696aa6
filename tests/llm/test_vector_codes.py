"""Vector codes: trees, whole results against plain rounds, hard rows."""

import hashlib
import math

import numpy as np
import pytest

from shelfproof.llm import vector_codes


def plain(rows, parts, entries, rounds):
    """Rounds over all rows, every entry compared with every row."""
    kept = sorted((r for r in rows if r[1] is not None and all(
        x is not None and math.isfinite(x) for x in r[1])), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    vectors = np.array([[math.floor(x * 1024) for x in r[1]] for r in kept], np.int64)
    books = np.split(vectors[:entries].copy(), parts, axis=1)
    cut = np.split(vectors, parts, axis=1)

    def nearest(p):
        away = ((cut[p][:, None, :] - books[p][None, :, :]) ** 2).sum(2)
        return away.argmin(1), away.min(1)
    for _ in range(rounds):
        for p in range(parts):
            at, _ = nearest(p)
            for e in set(at.tolist()):
                books[p][e] = cut[p][at == e].sum(0) // int((at == e).sum())
    found = [nearest(p) for p in range(parts)]
    digest = hashlib.sha256(",".join(str(x) for b in books for x in b.ravel()).encode()).hexdigest()
    error = sum(f[1] for f in found)
    totals = {}
    for r, e in zip(kept, error.tolist()):
        totals[r[2]] = totals.get(r[2], 0) + e
    return sorted(repr((r[0], r[2], "".join(f"{f[0][i]:02x}" for f in found), int(error[i]), totals[r[2]]))
                  for i, r in enumerate(kept)), digest


def made(n, width, seed):
    rng = np.random.default_rng(seed)
    heads = rng.normal(size=(12, width))
    out = []
    for i in range(n):
        kind = rng.integers(5)
        vector = heads[rng.integers(12)] + rng.normal(size=width) * 0.05
        if kind == 0:
            vector = heads[0]  # many copies
        elif kind == 1:
            vector = np.round(vector)  # ties
        out.append((i, [float(x) for x in vector], int(rng.integers(3)) if i % 7 else None))
    return out


@pytest.mark.parametrize("n,width,entries,scale", [(3000, 8, 16, 1.0), (700, 12, 256, 3.0), (400, 4, 9, 9e4)])
def test_codes_against_plain_rounds(spark, n, width, entries, scale):
    rows = [(i, [x * scale for x in v], label) for i, v, label in made(n, width, n)]
    table = spark.createDataFrame(rows, "vec_id long, vector array<double>, label int").repartition(3)
    codes = vector_codes.Codes(table, 4, entries, 3)
    got = vector_codes.with_label_error(codes.coded()).select(
        "vec_id", "label", "code", "error", "label_error").collect()
    want, digest = plain(rows, 4, entries, 3)
    assert sorted(repr(tuple(r)) for r in got) == want
    assert codes.digest() == digest


def test_trees_are_cover_trees():
    rng = np.random.default_rng(1)
    heads = rng.integers(-2000, 2000, (20, 4))
    points = heads[rng.integers(0, 20, 900)] + rng.integers(-30, 30, (900, 4))
    points[100:300] = points[0]
    grown = vector_codes.tree(points)
    order, rows, first, after, radius, level = grown
    assert np.array_equal(np.sort(order), np.arange(900)) and np.array_equal(rows, points[order])
    for lo, hi, r in zip(first, after, radius):
        assert np.sqrt(vector_codes.squared(rows[lo:lo + 1], rows[lo:hi]).max()) == pytest.approx(r)
    assert (first[0], after[0]) == (0, 900)
    for depth in range(1, level.max() + 1):  # nodes lie in one node of the level above, and do not meet
        own = np.flatnonzero(level == depth)
        assert np.all(after[own][:-1] <= first[own][1:])
    lo, hi, entry, compared = vector_codes.assign(grown, heads)
    assert sorted(zip(lo, hi))[0][0] == 0 and (hi - lo).sum() == 900
    whole = vector_codes.squared(rows, heads).argmin(1)
    assert all(set(whole[a:b]) == {e} for a, b, e in zip(lo, hi, entry))
    assert compared < 300  # most rows are assigned with their subtree


def test_hard_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(5, [1.0, 2.0], 1, "x"), (5, [1.0, 2.0], 1, "x"), (3, [0.5, -0.25], None, "y"),
            (None, [0.5, 1.5], None, None), (1, None, 1, None), (2, [None, 1.0], 1, ""),
            (4, [nan, 1.0], 2, ""), (6, [1.0, -inf], 2, "")]
    table = spark.createDataFrame(rows, "vec_id long, vector array<float>, label int, code string")
    codes = vector_codes.Codes(table, 2, 3, 2)
    got = vector_codes.with_label_error(codes.coded())
    want, digest = plain([r[:3] for r in rows], 2, 3, 2)
    assert sorted(repr((r.vec_id, r.label, r.code, r.error, r.label_error)) for r in got.collect()) == want
    assert codes.digest() == digest
    empty = vector_codes.Codes(table.limit(0), 2)
    assert empty.coded().count() == 0 and empty.digest() == hashlib.sha256(b"").hexdigest()
    with pytest.raises(Exception, match="larger"):
        vector_codes.Codes(spark.createDataFrame([(1, [1e9, 0.0], 1)], table.schema[:3]), 2)
    mixed = spark.createDataFrame([(1, [1.0, 0.0], 1), (2, [1.0], 1)], table.schema[:3])
    with pytest.raises(Exception, match="components"):
        vector_codes.Codes(mixed, 2).coded().count()
