"""Outputs that survive failed and repeated runs, and totals taken while they are written.

A run writes its partitions under a folder of its own, then appends one row per partition to a
manifest. Readers follow the manifest alone: of a run that failed they see nothing, and a run that
wrote some partitions again replaces these and leaves the others as they were.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from shelfproof.sources import tables

MANIFEST = "partition string, version long, path string"


def _manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The last version of each partition: as many rows as partitions."""
    written = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    latest = Window.partitionBy("partition").orderBy(F.desc("version"), "path")
    return written.withColumn("_place", F.row_number().over(latest)).where("_place = 1").drop("_place")


def _last_version(spark: SparkSession, folder: str) -> int:
    try:
        return _manifest(spark, folder).agg(F.max("version")).first()[0] or 0
    except tables.AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return 0
        raise


def write_partitions(df: DataFrame, folder: str, by: str, partitions: Iterable[str],
                     metrics: dict[str, Column] | None = None) -> dict:
    """Write the rows of these partitions, the manifest last; gives metrics observed on the way.

    `partitions` names all that this run made anew, also those that have no rows now. One run
    at a time may write to a folder.
    """
    spark = df.sparkSession
    version = 1 + _last_version(spark, folder)
    path = f"{folder}/run-{version}-{uuid.uuid4().hex}"
    observation = Observation()
    rows = df.where(F.col(by).isin(list(partitions)))
    totals = [c.alias(name) for name, c in (metrics or {"rows": F.count(F.lit(1))}).items()]
    rows.observe(observation, *totals).write.partitionBy(by).parquet(path)
    seen = observation.get
    spark.createDataFrame([(p, version, path) for p in partitions], MANIFEST) \
        .coalesce(1).write.mode("append").parquet(f"{folder}/manifest")
    return seen


def read_partitions(spark: SparkSession, folder: str, by: str, schema) -> DataFrame:
    """The rows of the last version of every partition."""
    paths: dict[str, list[str]] = {}
    for row in _manifest(spark, folder).collect():  # a row per partition
        paths.setdefault(row.path, []).append(row.partition)
    out = spark.createDataFrame([], schema)
    for path, names in sorted(paths.items()):
        rows = spark.read.schema(schema).parquet(path)
        out = out.unionByName(rows.where(F.col(by).isin(names)).select(out.columns))
    return out
