"""Profiles of a frame: value counts, numeric summary, histogram, pivots.

The numeric summary's quartiles are exact and never gather, explode or range
partition a column: sketches bracket each rank and exact counts narrow the
brackets (see ``quantiles``).  For data that is already (value, count) pairs,
the pairs are range-partitioned and written, and running counts come from
per-partition totals plus a running sum inside each partition.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.money import round2, total
from ledgerline.operators.keys import prefix_sums, range_partitions
from ledgerline.operators.quantiles import SORT_ROWS, Span, as_double, order_statistics
from ledgerline.session import cut_lineage

QUANTILES = [("p25", 0.25), ("p50", 0.5), ("p75", 0.75)]
LARGE = 1e6
COUNT_PART = 10 ** 11
DESCRIBE_COLUMNS = ["column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max"]


def value_counts(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """Non-null values of ``col`` with their row counts, most frequent first."""
    name = name or col
    return (df.filter(F.col(col).isNotNull())
            .groupBy(F.col(col).alias(name)).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col(name)))


def running_counts(counted: DataFrame, group: str, order: str, weight: str, size: int,
                   partitions: int | None = None) -> DataFrame:
    """Adds ``_cum``: the running sum of ``weight`` in (group, order) order,
    restarting at every group.  ``size`` is the byte size of the written table
    that ``counted`` reads.  Distributed; see the module note."""
    n = partitions or range_partitions(counted, size * 3 // 2)  # zstd files, as in dense_key_large
    ranged = counted.repartitionByRange(n, group, order).sortWithinPartitions(group, order)
    tagged = cut_lineage(ranged.select("*", F.spark_partition_id().alias("_pid")))
    totals = tagged.groupBy("_pid", group).agg(F.sum(weight).alias("_t"))
    offsets = cut_lineage(prefix_sums(totals, "_pid", "_t", group))
    inside = Window.partitionBy("_pid", group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (tagged.join(offsets, ["_pid", group])
            .select(*counted.columns, (F.col("_off") + F.sum(weight).over(inside)).alias("_cum")))


def describe_numeric(df: DataFrame, cols: dict[str, str], places: int = 6, sort_rows: int = SORT_ROWS) -> DataFrame:
    """count, mean, sample std, min, exact interpolated quartiles, max.

    ``cols`` maps the reported name to a numeric column.  One pass gives
    counts, bounds and exact decimal sums, a second the squared deviations
    from the means; the quartiles interpolate linearly between two neighbouring
    ranks, like pandas, and come from :func:`order_statistics`.  Every pass is
    one aggregate whose tasks send one row; ``df`` should be a written table,
    since each pass reads it.  Results are rounded to ``places`` (from
    ``LARGE`` on, to ten significant digits).  NULLs are left out; a column
    without values has no row.
    """
    spark = df.sparkSession
    stats = []
    for c in cols.values():
        v, exact = as_double(c), as_double(c).try_cast("decimal(26,10)")
        # A sum beyond 36 digits is NULL and gives way to the double sum.
        summed = F.coalesce(F.try_sum(exact).cast("double"), F.sum(F.when(exact.isNotNull(), v)))
        beyond = F.sum(F.when(exact.isNull(), v))
        stats += [F.count(v), F.count_if(F.isnan(v)), F.min(v), F.max(v), F.try_divide(total(summed, beyond), F.count(v))]
    first = df.agg(*[x.alias(f"_{i}") for i, x in enumerate(stats)]).first()
    seen = {name: first[5 * i:5 * i + 5] for i, name in enumerate(cols) if first[5 * i]}
    schema = ", ".join(["column_name string", "count long"] + [f"{c} double" for c in DESCRIBE_COLUMNS[2:]])
    if not seen:
        return spark.createDataFrame([], schema)
    spread = df.agg(*[F.sum((as_double(cols[name]) - F.lit(mean)) ** 2).alias(f"_{i}")
                      for i, (name, (*_, mean)) in enumerate(seen.items())]).first()
    ranks = {name: {label: p * (n - 1) for label, p in QUANTILES} for name, (n, *_) in seen.items()}
    wanted: dict[str, set[int]] = {}
    for name, at in ranks.items():
        n = seen[name][0]
        wanted.setdefault(cols[name], set()).update(r for x in at.values() for r in (math.floor(x), min(math.floor(x) + 1, n - 1)))
    whole = {cols[name]: Span(cols[name], None, None, 0, n - nan, None) for name, (n, nan, *_) in seen.items()}
    values = order_statistics(df, wanted, whole, sort_rows)

    def quantile(name: str, at: float) -> float:
        low = math.floor(at)
        lower, upper = (values[cols[name], r] for r in (low, min(low + 1, seen[name][0] - 1)))
        return lower if lower == upper else lower + (upper - lower) * (at - low)

    rows = []
    for (name, (n, _, lo, hi, mean)), ss in zip(seen.items(), spread):
        std = math.sqrt(ss / (n - 1)) if n > 1 and ss is not None else None
        rows.append((name, n, mean, std, lo, *[quantile(name, at) for at in ranks[name].values()], hi))

    # One row per column.
    out = spark.createDataFrame(rows, schema)
    return out.select("column_name", "count", *[_rounded(F.col(c), places).alias(c) if c not in ("min", "max") else c
                                                for c in DESCRIBE_COLUMNS[2:]])


def _rounded(c: Column, places: int) -> Column:
    return F.when(F.abs(c) < LARGE, round2(c, places)).otherwise(F.format_string("%.9e", c).try_cast("double"))


def describe_counted(counted: DataFrame, size: int, places: int = 6) -> DataFrame:
    """The statistics of :func:`describe_numeric` for data that is already
    counted: a written table of (column_name, value, _w) triples and its byte
    size."""
    # A count of any size is summed in two parts, so that value times part
    # stays inside 38 digits; values beyond the decimal are summed as doubles
    # beside it.
    exact = F.col("value").try_cast("decimal(26,10)")
    high, low = F.expr(f"_w DIV {COUNT_PART}"), F.col("_w") % COUNT_PART
    first = counted.groupBy("column_name").agg(
        F.sum("_w").alias("count"),
        F.try_sum(exact * high.cast("decimal(11,0)")).alias("_high"),
        F.try_sum(exact * low.cast("decimal(11,0)")).alias("_low"),
        F.sum(F.when(exact.isNull(), F.col("value") * F.col("_w"))).alias("_beyond"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    ).withColumn("_sum", F.when(F.col("_high") == 0, F.col("_low").cast("double"))
                 .otherwise(F.col("_high").cast("double") * COUNT_PART + F.col("_low").cast("double"))
    ).select("*", F.try_divide(total("_sum", "_beyond"), F.col("count")).alias("mean"))
    spread = (counted.join(first.select("column_name", "mean"), "column_name")
              .groupBy("column_name")
              .agg(F.sum(F.col("_w") * (F.col("value") - F.col("mean")) ** 2).alias("_ss")))
    basic = first.join(spread, "column_name").select(
        "column_name", "count", "mean", "min", "max",
        F.sqrt(F.try_divide(F.col("_ss"), F.when(F.col("count") > 1, F.col("count") - 1))).alias("std"))
    cum = running_counts(counted, "column_name", "value", "_w", size)
    with_n = cum.join(basic.select("column_name", "count"), "column_name")
    picks = []
    for label, p in QUANTILES:
        pos = F.lit(p) * (F.col("count") - 1)
        lo = F.floor(pos)
        picks += [
            F.min(F.when(F.col("_cum") > lo, F.col("value"))).alias(f"_{label}_lo"),
            F.min(F.when(F.col("_cum") > lo + 1, F.col("value"))).alias(f"_{label}_hi"),
            F.first(pos - lo).alias(f"_{label}_f"),
        ]
    quant = with_n.groupBy("column_name").agg(*picks)
    out = basic.join(quant, "column_name")

    def interp(label: str) -> Column:
        lo_v, hi_v, f = F.col(f"_{label}_lo"), F.col(f"_{label}_hi"), F.col(f"_{label}_f")
        return lo_v + (F.coalesce(hi_v, lo_v) - lo_v) * f

    return out.select(
        "column_name", F.col("count").cast("long").alias("count"), _rounded(F.col("mean"), places).alias("mean"),
        _rounded(F.col("std"), places).alias("std"), F.col("min"),
        *[_rounded(interp(label), places).alias(label) for label, _ in QUANTILES], F.col("max"),
    )


def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """Equal-width bins between the column's min and max, last bin closed.

    Bin edges are ``lo + i * (hi - lo) / bins`` with the last edge exactly
    ``hi``; a value's bin comes from its scaled offset and is then corrected
    against those edges, so a value lying on an edge always opens the upper
    bin (the numpy/pandas rule).  The two bounds are one small aggregate
    read back to the driver; binning is a projection and a grouped count.
    """
    bounds = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    lo, hi = bounds["lo"], bounds["hi"]
    schema = "bin int, lower_edge double, upper_edge double, count bigint"
    if lo is None:
        return df.sparkSession.createDataFrame([], schema)
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    step = (hi - lo) / bins

    def edge(i: Column) -> Column:
        return F.when(i == bins, F.lit(hi)).otherwise(i.cast("double") * F.lit(step) + F.lit(lo))

    v = F.col(col)
    i0 = F.least(F.floor((v - F.lit(lo)) / F.lit(hi - lo) * F.lit(float(bins))).cast("int"), F.lit(bins - 1))
    i1 = F.when(v < edge(i0), i0 - 1).otherwise(i0)
    i2 = F.when((v >= edge(i1 + 1)) & (i1 != bins - 1), i1 + 1).otherwise(i1)
    counts = df.filter(v.isNotNull()).groupBy(i2.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    ids = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (ids.join(counts, "bin", "left")
            .select("bin", edge(F.col("bin")).alias("lower_edge"), edge(F.col("bin") + 1).alias("upper_edge"),
                    F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count")))


def column_profile(df: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """(column_name, data_type, non_null) for every column, one aggregate pass."""
    names = names or {c: c for c in df.columns}
    counts = df.agg(*[F.count(F.col(c)).alias(f"_{i}") for i, c in enumerate(df.columns)])
    types = dict(df.dtypes)
    rows = F.array(*[F.struct(F.lit(names.get(c, c)).alias("column_name"), F.lit(types[c]).alias("data_type"),
                              F.col(f"_{i}").cast("long").alias("non_null"))
                     for i, c in enumerate(df.columns)])
    return counts.select(F.inline(rows))


def null_counts(df: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """(column_name, null_count) for every column, one map-side aggregate."""
    names = names or {}
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(df.columns)])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(names.get(c, c)).alias("column_name"), F.col(f"_{i}").cast("long").alias("null_count"))
        for i, c in enumerate(df.columns)])))


def pivot_sum(df: DataFrame, row: str, col: str, values: list[str], measure: Column,
              finish=lambda c: c) -> DataFrame:
    """One row per ``row`` value, one column per listed ``col`` value."""
    return (df.groupBy(row).pivot(col, values).agg(finish(measure)))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
