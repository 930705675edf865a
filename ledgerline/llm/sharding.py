"""Rows dealt to weighted shards by rendezvous hashing of their keys.

Every shard draws a number for a key, from a hash of both, and the largest
draw, weighted as ``-weight / ln(u)``, takes the row.  A shard's share of the
keys is its share of the weights; adding a shard changes no other shard's
draw, so it takes rows only into itself (1 / (n + 1) of them with equal
weights), and removing one moves only its own rows.

``slot`` numbers the rows of a shard from 0 without gaps and without bringing
a shard into one task: each task sorts its own rows by shard, the sorted rows
are written once, and a row's slot is its place among its task's rows of that
shard plus the rows of that shard in earlier tasks - a running sum over one
number per task and shard.  The written table fixes tasks and places, so a
lost executor cannot give a slot twice.  No row is dealt by its shard, hence a
hot key or a heavy shard makes no hot task.

Defined results: keys are compared as text; NULL is a key like any other, so
rows without a key share a shard; repeated rows share a shard and have slots
of their own; texts of any length only add to ``size``; an empty table gives
no rows; other columns are carried along by ``assign``, which raises if one of
them already has an output's name.  Equal draws, which 53 bits make very rare,
go to the smaller shard number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

BITS = 53
FILE_ROWS = 1_000_000


def _draw(key: Column, shard: Column) -> Column:
    """A number in (0, 1) from the hash of key and shard number."""
    high = F.shiftrightunsigned(F.xxhash64(key, shard), 64 - BITS)
    return (high.cast("double") + 0.5) / F.lit(float(1 << BITS))


def _bid(key: Column, shard: Column, weight: Column) -> Column:
    return F.struct((-weight / F.ln(_draw(key, shard))).alias("bid"), (-shard).alias("negated"))


def _key(columns: list[str]) -> Column:
    """One text for all key columns; a NULL differs from every text."""
    return F.to_json(F.array(*[F.col(c).cast("string") for c in columns]))


def shard_of(key: Column, weights: list[float]) -> Column:
    """The winning (bid, negated shard number) among ``weights``' shards."""
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a weight above 0")
    shards = F.array(*[F.struct(F.lit(i).alias("n"), F.lit(float(w)).alias("w")) for i, w in enumerate(weights)])
    return F.array_max(F.transform(shards, lambda s: _bid(key, s["n"], s["w"])))


def assign(rows: DataFrame, shards: int | list[float], key: str | list[str] = "doc_id", grown: float | None = 1.0) -> DataFrame:
    """``rows`` with ``shard``, ``slot`` and, unless ``grown`` is None, ``grown_shard``.

    ``shards`` is a number of equal shards or a list of weights;
    ``grown_shard`` is the shard after one more of weight ``grown`` is added.
    """
    weights = [1.0] * shards if isinstance(shards, int) else list(shards)
    made = ["shard", "slot"] + (["grown_shard"] if grown is not None else [])
    if clash := {c.lower() for c in rows.columns} & set(made):
        raise ValueError(f"columns already there: {sorted(clash)}")
    # Numbered names, so that no column of the rows can clash with a step's own.
    names = [f"c{i}" for i in range(len(rows.columns))]
    keys = [names[rows.columns.index(k)] for k in ([key] if isinstance(key, str) else key)]
    dealt = rows.toDF(*names).withColumn("key", _key(keys))
    dealt = dealt.withColumn("won", shard_of(F.col("key"), weights))
    dealt = dealt.withColumn("shard", -F.col("won.negated"))
    if grown is not None:
        newcomer = _bid(F.col("key"), F.lit(len(weights)), F.lit(float(grown)))
        dealt = dealt.withColumn("grown_shard", -F.greatest("won", newcomer)["negated"])
    dealt = dealt.drop("key", "won").sortWithinPartitions("shard")
    fixed = written(dealt.withColumn("task", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id()))
    blocks = fixed.groupBy("shard", "task").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    # One row for each task and shard; a window holds as many rows as there are tasks.
    earlier = Window.partitionBy("shard").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("shard", "task", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"))
    placed = fixed.join(blocks, ["shard", "task"]).withColumn("slot", F.col("place") + F.col("shift"))
    return placed.select(*[F.col(n).alias(c) for n, c in zip(names, rows.columns)], *made)


def write_shards(assigned: DataFrame, path: str, file_rows: int = FILE_ROWS) -> None:
    """The rows of :func:`assign` as Parquet, a folder for each shard, in slot
    order, ``file_rows`` rows a file: a shard of any size is written by many tasks."""
    files = assigned.withColumn("shard_file", F.expr(f"slot DIV {int(file_rows)}"))
    (files.repartition("shard", "shard_file").sortWithinPartitions("shard", "slot")
     .drop("shard_file").write.option("maxRecordsPerFile", file_rows).partitionBy("shard").parquet(path))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, ``size`` (UTF-8 bytes of the text, NULL as none, plus 8) and ``text_crc32``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
