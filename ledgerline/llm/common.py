"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerline.session import cut_lineage

# Bytes of one Arrow batch: whole texts are sent, and may be megabytes long.
BATCH_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what is sent to a Python worker at once, by bytes: a batch of
    short rows stays large, a batch of long texts holds few of them."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder."""
    return cut_lineage(df, codec=None)


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]],
                schema: T.StructType | str) -> DataFrame:
    small_batches(df.sparkSession)
    return df.mapInArrow(fn, schema)


def texts_of(column: pa.Array) -> list[str]:
    """Python strings of a text column, NULL as empty."""
    return [t or "" for t in column.to_pylist()]
