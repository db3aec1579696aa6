"""Token set ratio on sorted distinct token arrays.

With I the shared tokens, s their joined length, and a, b the joined lengths of the tokens
only on one side, the score is 100 times the best of
  1                                     if one side is a subset of the other
  1 - indel / (S_a + S_b)               S_x = s + (1 if s else 0) + x
  1 - (1 + x) / (2 s + 1 + x)           for x in a, b, if s > 0
where indel counts inserted and deleted characters between the two rests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space as a Python string split sees it; (?U) makes \s follow Unicode.
_BLANK = r"(?U)[\s\x1c-\x1f]+"


def token_set(text: Column) -> Column:
    """Sorted distinct tokens. Null text gives an empty array."""
    parts = F.split(F.coalesce(text, F.lit("")), _BLANK)
    return F.array_sort(F.array_distinct(F.filter(parts, lambda t: t != F.lit(""))))


def joined(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


def with_indel(df: DataFrame, x: str, y: str, most: Column, name: str) -> DataFrame:
    """Adds the number of inserted and deleted characters between two text columns.

    Null if there are more than `most`, or if that is null. The built-in distance, which counts a
    replaced character once, is never greater, and at least half as large: it bounds the band, so
    that texts that differ little take a time linear in their length. Characters and lengths are
    columns of their own: a lambda would take them from the texts anew for each cell.
    """
    cut = df.withColumn("_most", most.cast("int")) \
        .withColumn("_fewest", F.expr(f"levenshtein({x}, {y}, _most)")) \
        .withColumns({"_xs": F.split(x, ""), "_ys": F.split(y, ""), "_n": F.length(x), "_m": F.length(y),
                      "_band": F.when(F.col("_fewest") >= 0, F.least(F.col("_most"), 2 * F.col("_fewest")))})
    return cut.withColumn(name, _indel_in_band(F.col("_band"))) \
        .drop("_most", "_fewest", "_band", "_xs", "_ys", "_n", "_m")


def _indel_in_band(most: Column) -> Column:
    """The distance of the characters _xs and _ys, _n and _m of them, if it is `most` at most.

    Cells of the edit table are taken by diagonals i - j from -most to most, and by steps i + j: a
    cell depends on the two cells beside it of the step before and on its own diagonal's of two
    steps before, so that the cells of a step do not depend on one another. One array holds the
    last value of each diagonal; the work is (_n + _m) * (2 * most + 1). Once every diagonal is
    beyond the bound the array is empty, and what is left costs nothing.
    """
    beyond = most + 1
    xs, ys, n, m = (F.col(c) for c in ("_xs", "_ys", "_n", "_m"))

    def step(row: Column, t: Column) -> Column:
        def cell(value: Column, place: Column) -> Column:
            twice = t + place - most  # 2 i; odd on diagonals that this step leaves alone
            i = F.shiftright(twice, 1)
            j = t - i
            beside = F.least(F.get(row, place - 1), F.get(row, place + 1)) + 1
            inside = (i >= 0) & (j >= 0) & (i <= n) & (j <= m)
            same = (i > 0) & (j > 0) & (F.get(xs, i - 1) == F.get(ys, j - 1))
            return F.when(F.pmod(twice, F.lit(2)) == 1, value).when(
                inside, F.least(F.when(same, value), beside, beyond)).otherwise(beyond)

        open_ = F.when(F.array_min(row) <= most, F.size(row)).otherwise(0)
        return F.transform(F.slice(row, F.lit(1), open_), cell)

    places = F.sequence(F.lit(0), 2 * most)
    start = F.transform(places, lambda p: F.when(p == most, 0).otherwise(beyond))
    steps = F.sequence(F.lit(1), F.greatest(F.lit(1), n + m))
    last = F.get(F.aggregate(steps, start, step), n - m + most)
    full = F.get(F.filter(F.array(last), lambda d: d <= most), 0)  # named once: evaluated once
    alone = n + m
    return F.when((n == 0) | (m == 0), F.when(alone <= most, alone)) \
            .when(F.abs(n - m) <= most, full)


def rest_lengths(tokens_a: Column, tokens_b: Column) -> dict[str, Column]:
    """Columns needed to score a pair: shared length and both rests."""
    return {
        "shared_len": F.length(joined(F.array_intersect(tokens_a, tokens_b))),
        "rest_a": joined(F.array_except(tokens_a, tokens_b)),
        "rest_b": joined(F.array_except(tokens_b, tokens_a)),
    }


def paths(shared: Column, rest_a: Column, rest_b: Column) -> dict[str, Column]:
    """Distance numerators and denominators of the three paths, all integers."""
    a, b = F.length(rest_a), F.length(rest_b)
    gap = F.when(shared > 0, 1).otherwise(0)
    return {
        "subset": (shared > 0) & ((a == 0) | (b == 0)),
        "indel_base": 2 * (shared + gap) + a + b,
        "short_a": 1 + a, "base_a": 2 * shared + 1 + a,
        "short_b": 1 + b, "base_b": 2 * shared + 1 + b,
    }
