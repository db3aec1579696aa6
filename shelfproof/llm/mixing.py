"""Mixing sources to target weights by temperature, with DataFrame functions only.

A source's share of the tokens is raised to an exponent and normalised again: 1 keeps the shares,
0 makes all sources equal. The exponent is the largest (the closest to the natural mix) at
which the mix meets a target: an entropy of its weights to reach at least, as a share of the
greatest possible, or a number of repetitions of a source not to pass (there the smallest). It is
bisected: each turn scores a grid of exponents in one job and keeps the interval in which the
target is crossed.

The budget's tokens are then dealt out. Each source's stream is its documents in a permutation
drawn anew per epoch, cut at the source's quota; a document belongs to the stream if it begins
before the quota ends. Streams are laid over the blocks in equal parts, so each block has about
the same mix, and a block's documents are permuted among themselves.

Running lengths come from sums per hash bucket of a stream, so that a source with a third of
all rows is spread over as many tasks as it has buckets.

A null source is a source of its own; null texts and texts without tokens have no length and are in
the stream if the place where they stand is. Rows that repeat an id and a source are used
together. Sources without tokens have weight 0. An empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfproof.llm.graph import staged

GRID, TURNS, DIGITS = 32, 6, 6
#: Hex digits of the permutation's hash that name a bucket.
BUCKET = 3


def tokens(text: Column) -> Column:
    """Words, the length that budgets count."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def shares(docs: DataFrame) -> DataFrame:
    """Per source: tokens, docs, share of all tokens."""
    sums = docs.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs"))
    total = sums.agg(F.sum("tokens").alias("all_tokens"), F.count_if(F.col("tokens") > 0).alias("sources"))
    return sums.crossJoin(F.broadcast(total)) \
        .withColumn("share", F.try_divide(F.col("tokens"), F.col("all_tokens")))


def _scored(table: DataFrame, low: float, high: float, budget: float) -> list:
    """Entropy (as a share of the greatest) and largest repetition for a grid of exponents."""
    step = (high - low) / GRID
    at = F.explode(F.transform(F.sequence(F.lit(0), F.lit(GRID)), lambda i: F.lit(low) + i * F.lit(step)))
    grid = table.filter("tokens > 0").select("*", at.alias("exponent")) \
        .withColumn("raised", F.pow("share", "exponent"))
    # With r the raised share and S its sum: -sum(r/S ln(r/S)) = ln S - sum(r ln r)/S.
    sums = grid.groupBy("exponent").agg(
        F.sum("raised").alias("s"), F.sum(F.col("raised") * F.ln("raised")).alias("e"),
        F.max(F.col("raised") / F.col("tokens")).alias("r"),
        F.max("all_tokens").alias("n"), F.max("sources").alias("k"))
    most = F.when(F.col("k") > 1, F.ln(F.col("k").cast("double"))).otherwise(1.0)
    return sums.select(
        "exponent", ((F.ln("s") - F.col("e") / F.col("s")) / most).alias("entropy"),
        (F.col("r") / F.col("s") * F.col("n") * budget).alias("repeats")).orderBy("exponent").collect()


def exponent(table: DataFrame, entropy: float | None = None, repeats: float | None = None,
             budget: float = 1.0) -> float:
    """The exponent in [0, 1] for shares(), rounded.

    entropy: to reach at least; the mix stays as near to the natural one as it allows. repeats:
    a source's epochs not to pass; the mix is as even as it allows. budget: tokens to deal
    out over tokens there are. With a budget above `repeats` the natural mix is the best there is.
    """
    if (entropy is None) == (repeats is None):
        raise ValueError("give an entropy or a number of repeats")
    low, high = 0.0, 1.0
    for _ in range(TURNS):
        rows = _scored(table, low, high, budget)
        if not rows:
            return 1.0
        if entropy is not None:  # falls as the exponent grows: the last that reaches it
            good = [i for i, r in enumerate(rows) if r["entropy"] >= entropy]
            at = max(good, default=0)
            low, high = rows[at]["exponent"], rows[min(at + 1, GRID)]["exponent"]
        else:  # falls as the exponent grows: the first that keeps to it
            good = [i for i, r in enumerate(rows) if r["repeats"] <= repeats]
            at = min(good, default=GRID)
            low, high = rows[max(at - 1, 0)]["exponent"], rows[at]["exponent"]
        if low == high:
            break
    return round(low if entropy is not None else high, DIGITS)


def weights(table: DataFrame, power: float, budget: float = 1.0) -> DataFrame:
    """shares() with weight and quota (tokens of the budget)."""
    raised = F.when(F.col("tokens") > 0, F.pow("share", F.lit(power))).otherwise(0.0)
    table = table.withColumn("raised", raised)
    total = table.agg(F.sum("raised").alias("raised_all"))
    return table.crossJoin(F.broadcast(total)) \
        .withColumn("weight", F.try_divide(F.col("raised"), F.col("raised_all"))) \
        .withColumn("quota", F.round(F.col("weight") * F.col("all_tokens") * budget).cast("long")) \
        .drop("raised", "raised_all")


def mix(docs: DataFrame, table: DataFrame, blocks: int, seed: int = 0) -> DataFrame:
    """(id, source, tokens, epoch, begins, block, place): the mix, a row per use of a document.

    docs: id, source, tokens. table: weights(). begins: where in the source's stream; place: order
    in the block.
    """
    quota = table.filter("quota > 0 AND tokens > 0").select(
        F.col("source").alias("_source"), F.col("tokens").alias("length"), "quota")
    epochs = F.sequence(F.lit(0).cast("long"), F.expr("(quota - 1) div length"))
    used = docs.join(quota, F.col("source").eqNullSafe(F.col("_source"))).drop("_source") \
        .withColumn("epoch", F.explode(epochs)) \
        .withColumn("name", F.coalesce(F.col("id").cast("string"), F.lit(""))) \
        .withColumn("key", F.md5(F.concat_ws(":", F.lit(seed), "epoch", "name").cast("binary"))) \
        .withColumn("bucket", F.substring("key", 1, BUCKET))
    # Length of the buckets before one, then of the documents before one in its bucket.
    sums = used.groupBy("source", "epoch", "bucket").agg(F.sum("tokens").alias("held"))
    earlier = Window.partitionBy("source", "epoch").orderBy("bucket") \
        .rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col("source").alias("_source"), F.col("epoch").alias("_epoch"), F.col("bucket").alias("_bucket"),
        F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("source", "epoch", "bucket").orderBy("key", "id", "tokens") \
        .rowsBetween(Window.unboundedPreceding, -1)
    placed = used.join(sums, F.col("source").eqNullSafe(F.col("_source"))
                       & (F.col("epoch") == F.col("_epoch")) & (F.col("bucket") == F.col("_bucket"))) \
        .withColumn("begins", F.col("epoch") * F.col("length") + F.col("before")
                    + F.coalesce(F.sum("tokens").over(inside), F.lit(0))) \
        .filter("begins < quota")
    return placed.withColumn("block", F.expr(f"(begins * {int(blocks)}) div quota")) \
        .withColumn("place", F.md5(F.concat_ws(":", "block", "key").cast("binary"))) \
        .select("id", "source", "tokens", "epoch", "begins", "block", "place")


def mixed(docs: DataFrame, blocks: int, entropy: float | None = None, repeats: float | None = None,
          budget: float = 1.0, seed: int = 0) -> DataFrame:
    """mix() of documents (doc_id, source, text) with the exponent that meets the target."""
    rows = staged(docs.groupBy(F.col("doc_id").alias("id"), "source")
                  .agg(F.sum(tokens(F.col("text"))).alias("tokens")))
    table = staged(shares(rows))
    return mix(rows, weights(table, exponent(table, entropy, repeats, budget), budget), blocks, seed)


def reweighted(docs: DataFrame, blocks: int = 64, **target) -> DataFrame:
    """The documents, all columns, as often as the mix uses each."""
    uses = mixed(docs, blocks, **target) \
        .groupBy(F.col("id").alias("_mix_id"), F.col("source").alias("_mix_source")) \
        .agg(F.count("*").alias("_mix_uses"))
    used = docs.join(uses, docs["doc_id"].eqNullSafe(uses["_mix_id"])
                     & docs["source"].eqNullSafe(uses["_mix_source"]))
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_mix_uses")))
    return used.withColumn("_mix_copy", copies).select(*docs.columns)
