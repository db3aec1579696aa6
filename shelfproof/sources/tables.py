"""Read and write the six tables and the outputs, as CSV or Parquet."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from functools import cache, partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfproof.schema import (
    EXCEPTION_SCHEMA,
    SCORECARD_SCHEMA,
    SchemaMismatch,
    TABLE_SCHEMAS,
    TRUTH_SCHEMA,
    Tables,
    check_columns,
)
from shelfproof.session import cut_lineage, shared_folder

OUTPUT_SCHEMAS = {
    "exceptions": EXCEPTION_SCHEMA,
    "ground_truth": TRUTH_SCHEMA,
    "scorecard": SCORECARD_SCHEMA,
}


class MissingInput(FileNotFoundError):
    """An input that an earlier step should have written is not there."""


# Which step writes what, for the message of MissingInput.
_WRITTEN_BY = {"exceptions": "the validation run", "scorecard": "the scoring run",
               "ground_truth": "the injection run"}


def read_frame(spark: SparkSession, path: str, schema: T.StructType, fmt: str,
               written_by: str = "the step that builds the tables") -> DataFrame:
    """One dataset with declared types. CSV text that does not parse becomes null.

    CSV columns are matched by header name, as the files may hold them in another order.
    """
    try:
        if fmt == "csv":
            raw = spark.read.option("header", True).csv(path)
            return raw.select([
                F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name)
                if f.name in raw.columns else F.col(f"`{f.name}`") for f in schema.fields])
        raw = spark.read.format(fmt).load(path)
        return raw.select([F.col(f"`{f.name}`").cast(f.dataType).alias(f.name)
                           for f in schema.fields])
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise MissingInput(f"{path} not found: run {written_by} first") from error
        raise


def unparsed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV values that have text but no value of the declared type, one row each."""
    raw = spark.read.option("header", True).csv(path)
    typed = [f for f in schema.fields
             if f.name in raw.columns and not isinstance(f.dataType, T.StringType)]
    found = [F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(),
                    F.struct(F.lit(f.name).alias("column_name"), F.col(f.name).alias("text")))
             for f in typed]
    return raw.select(F.inline(F.filter(F.array(*found), lambda x: x.isNotNull())))


def with_rejects(spark: SparkSession, path: str, schema: T.StructType,
                 keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows of a CSV dataset with declared types, and what does not parse, in one read.

    The second table has a row (keys as text, column_name, text) per value with text but no value of
    the declared type; the first has null there. Both come from one written parse.
    """
    raw = spark.read.option("header", True).csv(path)
    missing = [f.name for f in schema.fields if f.name not in raw.columns]
    if missing:
        raise SchemaMismatch(f"{path}: missing {missing}")
    parsed = {f.name: F.col(f"`{f.name}`").try_cast(f.dataType) for f in schema.fields}
    rejected = [F.when(F.col(f"`{n}`").isNotNull() & c.isNull(),
                       F.struct(F.lit(n).alias("column_name"), F.col(f"`{n}`").alias("text")))
                for n, c in parsed.items()]
    both = raw.select(F.struct(*[c.alias(n) for n, c in parsed.items()]).alias("row"),
                      F.struct(*[F.col(f"`{k}`").alias(k) for k in keys]).alias("keys"),
                      F.filter(F.array(*rejected), lambda x: x.isNotNull()).alias("rejected"))
    staged = cut_lineage(both)
    return staged.select("row.*"), staged.select("keys.*", F.inline("rejected"))


def inputs_found(spark: SparkSession, folder: str, fmt: str = "parquet") -> DataFrame:
    """Per output that later steps read: its rows, or that it is missing."""
    out = None
    for name in OUTPUT_SCHEMAS:
        try:
            one = read_output(spark, folder, name, fmt).agg(F.count(F.lit(1)).alias("n"))
        except MissingInput:
            one = spark.range(1).select(F.lit(None).cast("long").alias("n"))
        one = one.select(F.lit(name).alias("input"), "n", F.col("n").isNull().alias("missing"))
        out = one if out is None else out.unionByName(one)
    return out


def read_table(spark: SparkSession, folder: str, name: str, fmt: str = "parquet") -> DataFrame:
    suffix = ".csv" if fmt == "csv" else ""
    return read_frame(spark, f"{folder}/{name}{suffix}", TABLE_SCHEMAS[name], fmt)


def read_tables(spark: SparkSession, folder: str, fmt: str = "parquet",
                names: Iterable[str] = TABLE_SCHEMAS) -> Tables:
    return Tables({name: read_table(spark, folder, name, fmt) for name in names})


def read_output(spark: SparkSession, folder: str, name: str, fmt: str = "parquet") -> DataFrame:
    suffix = ".csv" if fmt == "csv" else ""
    return read_frame(spark, f"{folder}/{name}{suffix}", OUTPUT_SCHEMAS[name], fmt,
                      _WRITTEN_BY[name])


def _write(df: DataFrame, path: str, fmt: str, partition_by: str | None = None) -> None:
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.save(path)


def write_tables(tables: Tables, folder: str, fmt: str = "parquet") -> None:
    """Write each table present, after a check of its columns."""
    suffix = ".csv" if fmt == "csv" else ""
    for name, df in tables.items():
        check_columns(df, name)
        _write(df.select(TABLE_SCHEMAS[name].names), f"{folder}/{name}{suffix}", fmt)


def write_output(df: DataFrame, folder: str, name: str, fmt: str = "parquet",
                 partition_by: str | None = None) -> None:
    """Write worklist, truth log or scorecard. The scorecard has a row per rule: one file."""
    suffix = ".csv" if fmt == "csv" else ""
    df = df.select(OUTPUT_SCHEMAS[name].names)
    if name == "scorecard":
        df = df.coalesce(1)
    _write(df, f"{folder}/{name}{suffix}", fmt, partition_by)


def export_view(df: DataFrame, path: str) -> None:
    """Write a filtered worklist view as CSV."""
    _write(df, path, "csv")


def stage(tables: Tables, names: Iterable[str]) -> Tables:
    """Write the named tables to the shared folder once and read them from there."""
    frames = {name: tables[name] for name in names}
    spark = next(iter(frames.values())).sparkSession
    folder = f"{shared_folder(spark)}/tables-{uuid.uuid4().hex}"
    write_tables(Tables(frames), folder)
    return tables.replace(**read_tables(spark, folder, names=frames))


def stage_when_asked(tables: Tables, names: Iterable[str]) -> Tables:
    """`stage`, each table when it is first asked for: a job that needs one writes one."""
    def one(name: str) -> DataFrame:
        return stage(tables, [name])[name]

    # Cached, so that tables made of these by `replace` share what is written.
    return tables.replace(**{name: cache(partial(one, name)) for name in names})
