"""CSV extracts: paths, reading, audit columns, writing."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayline.fixed_values import SOURCE_FOLDER_VARIABLE
from assayline.operators.checks import standardize

DEFAULT_FOLDER = "data"


def resolve_source_path(filename: str, data_dir: str | None = None) -> str:
    """Folder argument, else the environment's folder, else ``data``; URLs keep their scheme."""
    folder = data_dir or os.environ.get(SOURCE_FOLDER_VARIABLE) or DEFAULT_FOLDER
    return f"{folder.rstrip('/')}/{filename}"


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    infer: bool = False,
    encoding: str = "UTF-8",
) -> DataFrame:
    """A CSV file or folder with a header; empty fields are NULL.

    By default every column is text named by the header, one pass and nothing lost. ``infer`` takes a
    second pass to find types. ``schema`` selects by column name, whatever the file's order, and
    casts; values that do not parse become NULL, so use it only for trusted files.
    """
    reader = spark.read.option("header", True).option("encoding", encoding)
    if infer:
        return reader.option("inferSchema", True).csv(path)
    landed = reader.csv(path)
    return landed if schema is None else standardize(landed, schema, trim_text=False)


def write_csv(df: DataFrame, path: str, encoding: str = "UTF-8") -> None:
    """A folder of CSV files with headers; NULL is written as an empty field."""
    df.write.mode("overwrite").option("header", True).option("encoding", encoding).csv(path)


def _path(spark: SparkSession, path: str):
    """A Hadoop path and the file system that it is on."""
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return there, there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove_folder(spark: SparkSession, path: str) -> None:
    there, store = _path(spark, path)
    store.delete(there, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none if it does not exist."""
    there, store = _path(spark, path)
    return [s.getPath().getName() for s in store.listStatus(there)] if store.exists(there) else []


def add_audit_columns(
    df: DataFrame, source_path: str | None, run_timestamp: Column | None = None
) -> DataFrame:
    """Ingestion time and source path; without a path, each row's own file is recorded."""
    source = F.col("_metadata.file_path") if source_path is None else F.lit(source_path)
    return df.select(
        "*",
        (F.current_timestamp() if run_timestamp is None else run_timestamp).alias("ingestion_timestamp"),
        source.alias("source_file"),
    )


def add_batch_row_count(df: DataFrame) -> DataFrame:
    """The batch's row count on every row; the broadcast side is a single aggregate row."""
    total = df.agg(F.count(F.lit(1)).alias("row_count"))
    return df.crossJoin(F.broadcast(total))
