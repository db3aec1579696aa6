"""The corpus pipeline: documents from raw rows to token files, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfproof.llm import decontaminate, mixing, near_dedup, planes, toxicity
from shelfproof.llm.graph import staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: The id that closes a document in the token files.
END_ID = 2


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go; all labels may be learned from."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, held_out=F.lit(False))
    return toxicity.clean(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each group whose 5-word shingle sets are 80 % alike."""
    return near_dedup.deduplicate(docs, size=5, percent=80)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark item's ten words in a row occur go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are used as often as a mix with nine tenths of the greatest entropy needs."""
    return mixing.reweighted(docs, blocks=16, entropy=0.9)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids in plane files; what they hold of each document, read back."""
    path = planes.write(docs, public_tokenizers.path("byte_bpe_50k.json"), END_ID)
    return planes.documents(spark.read.parquet(path))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxic_documents),
    ("near_dedup", near_duplicates),
    ("decontamination", benchmark_passages),
    ("mixing", source_mix),
    ("token_planes", token_files),
]

#: The stages learn, hash and encode beyond what SQL expresses.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over `documents`; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
