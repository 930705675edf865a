"""Dense surrogate keys 1..n in a sort order.

A dimension whose members come from fixed lists uses a global ``row_number``
window: one task, over the distinct members.  Any other table (the fact, the
products) must not go through one task, so it is range-partitioned on the
order column, sorted inside each partition and written; a row's key is then
the number of rows in all earlier partitions plus its position in its own
partition.  The written table fixes partition contents, so the per-partition
counts and positions come from the very same rows even if an executor is lost
and tasks re-run.  The numbers of earlier rows are a two-level prefix sum on
the executors (:func:`prefix_sums`); none of them passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.session import cut_lineage

# Partitions whose counts one window of the prefix sum adds up.
SCAN_BLOCK = 1024

# Target size of one range partition, in bytes of the written (compressed)
# input: roughly half a gigabyte once decoded.
RANGE_PARTITION_BYTES = 128 * 1024 * 1024


def range_partitions(df: DataFrame, size: int) -> int:
    """Partitions for a range partitioning of ``df``, of whose written form
    ``size`` bytes are known: at least the shuffle partitions, and one for
    each ``RANGE_PARTITION_BYTES``."""
    base = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(base, -(-size // RANGE_PARTITION_BYTES))


def prefix_sums(counts: DataFrame, order: str, weight: str, group: str | None = None) -> DataFrame:
    """(order[, group], _off): the sum of ``weight`` over the rows of smaller
    ``order`` (a whole number, unique within a group), restarting at every group.

    Two levels: blocks of ``SCAN_BLOCK`` neighbours are added up inside, each
    in a window of its own; a second window runs over one row per block.  With
    800,000 partitions the larger window holds 1,024 rows, the other 782.
    """
    own = [group] if group else []
    rows = counts.select(order, *own, F.col(weight).alias("_w"), F.expr(f"`{order}` DIV {SCAN_BLOCK}").alias("_block"))
    earlier = (Window.unboundedPreceding, -1)
    blocks = rows.groupBy(*own, "_block").agg(F.sum("_w").alias("_t"))
    blocks = blocks.select(*own, "_block", F.coalesce(
        F.sum("_t").over(Window.partitionBy(*own).orderBy("_block").rowsBetween(*earlier)), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*own, "_block").orderBy(order).rowsBetween(*earlier)
    rows = rows.withColumn("_inside", F.coalesce(F.sum("_w").over(inside), F.lit(0)))
    return rows.join(blocks, [*own, "_block"]).select(order, *own, (F.col("_before") + F.col("_inside")).alias("_off"))


def dense_key_small(df: DataFrame, order: list[str], key: str) -> DataFrame:
    """``key`` = 1..n by ``order`` (nulls first) over a bounded dimension."""
    w = Window.orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return df.select(F.row_number().over(w).cast("long").alias(key), *df.columns)


def in_key_order(ranged: DataFrame, order: str) -> DataFrame:
    """Rows in ranges of ``order`` (NULLs first), sorted inside each; a sort that is there already is not done again."""
    return ranged.sortWithinPartitions(F.col(order).asc_nulls_first())


def place_rows(ordered: DataFrame) -> DataFrame:
    """Rows with their partition and position, to be written as they lie."""
    return ordered.select("*", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_mid"))


def number_rows(placed: DataFrame, key: str, start: Column | int = 0) -> DataFrame:
    """``key`` = start + 1..n of a written table of :func:`place_rows`, in its order."""
    # One count per partition, and a written table of their prefix sums: its
    # known size lets Spark decide how to join it.
    counts = placed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = cut_lineage(prefix_sums(counts, "_pid", "_n"))
    tagged = placed.join(offsets, "_pid")
    offset = F.col("_off")
    position = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    base = start if isinstance(start, Column) else F.lit(start).cast("long")
    return tagged.select((base + offset + position + 1).alias(key), *[c for c in placed.columns if c not in ("_pid", "_mid")])


def dense_key_large(df: DataFrame, order: str, key: str, size: int, partitions: int | None = None,
                    start: Column | int = 0) -> DataFrame:
    """``key`` = start + 1..n by ``order`` over a table of any size.

    ``size`` is the byte size of the written table that ``df`` reads; it sets
    the number of range partitions unless ``partitions`` does.  ``order`` must identify rows (the fact's invoice id after dedup); ties
    would still get distinct keys, in an unspecified order.
    """
    # The size is that of zstd files, which decode to half as much again as the target supposes.
    n = partitions or range_partitions(df, size * 3 // 2)
    ranged = in_key_order(df.repartitionByRange(n, F.col(order).asc_nulls_first()), order)
    return number_rows(cut_lineage(place_rows(ranged)), key, start)
