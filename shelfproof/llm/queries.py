"""Registered queries of this subpackage: name -> function of (spark, folder of tables)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfproof.llm import (
    chat,
    decontaminate,
    fingerprint,
    html_text,
    line_dedup,
    mixing,
    near_dedup,
    pitman_yor,
    planes,
    spelling,
    suffix_dedup,
    toxicity,
    vector_codes,
)
from shelfproof.llm.graph import staged

Query = Callable[[SparkSession, str], DataFrame]

#: The id that closes a document in the token files.
END_ID = 2


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The group of each document: 3-word shingle sets at least 85 % alike, transitively."""
    return near_dedup.groups(_table(spark, folder, "documents"), size=3, percent=85)


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Each document without the passages that an earlier one has."""
    return line_dedup.deduplicate(_table(spark, folder, "documents"))


def op3_page_differencing(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of each page."""
    return html_text.main_text(_table(spark, folder, "pages"))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """The toxicity of each document; a fifth of the ids is never learned from."""
    docs = _table(spark, folder, "documents")
    model = toxicity.train(docs, _table(spark, folder, "labels"),
                           toxicity.remainder(F.col("_id"), 5) == 0)
    return toxicity.scores(docs, model).select(
        "doc_id", (toxicity.remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_pitman_yor(spark: SparkSession, folder: str) -> DataFrame:
    """The log probability of each document; a seventh of the ids is never learned from."""
    held_out = toxicity.remainder(F.col("doc_id"), 7) == 2
    return pitman_yor.scores(_table(spark, folder, "documents"), held_out).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score")


def op6_reply_trees(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation formatted, and what is read back from that.

    The table has no branches: a turn replies to the one before it, so each tree is one path.
    """
    spoken = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame(
        [(-7, 0, "user", spoken), (-7, 1, "assistant", spoken)],
        "conv_id long, turn long, role string, text string")
    rows = _table(spark, folder, "conversations").select(*planted.columns).unionByName(planted)
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    messages = rows.select(
        F.struct("conv_id").alias("tree"), F.row_number().over(order).cast("long").alias("node"),
        "role", "text") \
        .withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1)) \
        .withColumn("score", F.coalesce(F.length("text"), F.lit(0)).cast("double"))
    read = chat.digests(chat.conversations(staged(messages)))
    return read.select(F.col("tree.conv_id").alias("conv_id"), *read.columns[1:])


def op7_token_planes(spark: SparkSession, folder: str) -> DataFrame:
    """All document ids written to plane files and read back from them."""
    path = planes.write(_table(spark, folder, "documents"),
                        public_tokenizers.path("byte_bpe_50k.json"), END_ID)
    return planes.documents(spark.read.parquet(path))


def op8_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """What of the benchmark each document holds."""
    found = decontaminate.matches(_table(spark, folder, "documents"),
                                  _table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def op9_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """The fingerprint of each document and of its edited text, compared."""
    return fingerprint.compare_with_next(_table(spark, folder, "documents"))


def op10_temperature_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """A mix of all sources with nine tenths of the greatest entropy, as large as the input."""
    return mixing.mixed(_table(spark, folder, "documents"), blocks=16, entropy=0.9)


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all documents, some of them spoilt, with the words that they are variants of."""
    words = spelling.vocabulary(_table(spark, folder, "documents"), 6, 5, every=199)
    return spelling.variants(words, factor=5)


def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    """The code of each vector, four bytes of 256 entries each, and how far off it is."""
    vectors = _table(spark, folder, "embeddings").select(
        "vec_id", F.col("embedding").alias("vector"), "label")
    codes = vector_codes.Codes(vectors, parts=4, entries=256, rounds=4)
    return vector_codes.with_label_error(staged(codes.coded())).select(
        "vec_id", "code", "error", "label_error", F.lit(codes.digest()).alias("codebooks_sha256"))


def op13_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Each document less all bytes of 200-byte runs that occur elsewhere too."""
    rows = suffix_dedup.deduplicate(_table(spark, folder, "documents"), depth=200)
    kept = F.coalesce(F.octet_length("kept"), F.lit(0)).cast("long")
    return rows.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - kept).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_minhash_near_dedup, op2_line_dedup, op3_page_differencing, op4_toxicity, op5_pitman_yor,
    op6_reply_trees, op7_token_planes, op8_benchmark_decontamination, op9_fingerprints,
    op10_temperature_mixing, op11_spelling_variants,
    op12_vector_codes, op13_suffix_dedup)}
