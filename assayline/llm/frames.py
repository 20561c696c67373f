"""What the operators share: the two columns they read, Arrow mapping, settled tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayline.operators.lookup import shared_folder

ROOT = str(Path(__file__).resolve().parents[2])
ASCII_SPACE = " \t\n\x0b\x0c\r"


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, so that other columns of any name cannot clash.

    Columns of the right type are passed on without an alias, as one more alias in one of two equal
    plans would keep Spark from sharing their shuffle.
    """
    typed = [
        F.col(name) if docs.schema[name].dataType == kind else F.col(name).cast(kind).alias(name)
        for name, kind in (("doc_id", T.LongType()), ("text", T.StringType()))
    ]
    return docs.select(*typed)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def map_arrow(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema
) -> DataFrame:
    """``mapInArrow`` with this package on the workers' path, where they share the driver's disk."""
    df.sparkSession.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    return df.mapInArrow(function, schema)


def settled(df: DataFrame) -> DataFrame:
    """The rows as a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names that no column of the frame has, in any case: the given ones behind enough underscores."""
    taken = {c.lower() for c in df.columns}
    prefix = "_"
    while any(f"{prefix}{name}".lower() in taken for name in names):
        prefix += "_"
    return [f"{prefix}{name}" for name in names]


def text_key():
    """Two hashes of a text, which stand for it in join keys; NULL has a key of its own."""
    return [
        F.xxhash64("text", F.col("text").isNull()).alias("_a"),
        F.xxhash64(F.lit(7), "text", F.col("text").isNull()).alias("_b"),
    ]
