"""Order statistics of columns of any size, exact or from stored sketches.

*Exact* (:func:`order_statistics`).  No column is gathered, exploded or range
partitioned:

1. A mergeable KLL sketch per column, one row per task, gives a grid of
   approximate quantiles; the two grid values around a wanted rank bracket it.
2. One more pass counts the rows below, at and above both ends of every
   bracket.  The counts are exact, so a rank that falls on an end is that
   value however often it repeats, a rank strictly inside keeps only the rows
   strictly inside, and one that the sketch missed goes on in the part where
   the counts say it is.
3. While more than ``sort_rows`` rows lie inside the open brackets, they are
   sketched and narrowed again (by two orders of magnitude each time); then
   only those rows are reduced to (value, count) pairs and put in order.

*Approximate* (:func:`column_sketches` and the following).  The sketches
themselves are rows that a load can store; sketches of many loads merge into
the quantiles of all their rows without reading the rows again.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SKETCH_K = 800          # rank error about 0.4 % of the rows
GRID = 256              # quantiles read from a sketch
SORT_ROWS = 200_000     # rows inside brackets that are put in order at last
RANK_ERROR = 0.01       # of merged sketches, with room to spare


def as_double(col: str) -> Column:
    return F.col(col).cast("double")


def _finite_order(value: Column) -> Column:
    """The value, without NaN: sketches know no place for it, so it is counted apart."""
    return F.when(~F.isnan(value), value)


def grid_of(value: Column) -> Column:
    """``GRID + 1`` quantiles of the non-NULL values, NULL if there is none."""
    sketch = F.kll_sketch_agg_double(value, F.lit(SKETCH_K))
    ranks = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    return F.when(F.count(value) > 0, F.kll_sketch_get_quantile_double(sketch, ranks))


@dataclass(frozen=True)
class Span:
    """The rows of a column strictly between two values (None: no bound)."""

    column: str
    above: float | None
    below: float | None
    before: int                    # rows up to ``above``
    rows: int
    grid: tuple[float, ...] | None  # approximate quantiles of these rows

    def inside(self, value: Column) -> Column:
        found = value.isNotNull()
        if self.above is not None:
            found = found & (value > self.above)
        return found if self.below is None else found & (value < self.below)

    def bracket(self, rank: int) -> tuple[float, float]:
        """Grid values around a rank (counted from 0 over the whole column)."""
        at = (rank - self.before) / max(1, self.rows - 1) * GRID
        return self.grid[max(0, math.floor(at) - 1)], self.grid[min(GRID, math.ceil(at) + 1)]


def _one_row(df: DataFrame, columns: list[Column]):
    return df.agg(*[c.alias(f"_{i}") for i, c in enumerate(columns)]).first()


def _with_grids(df: DataFrame, spans: list[Span]) -> list[Span]:
    """The spans with a grid each; one pass for those that lack it."""
    missing = [s for s in spans if s.grid is None]
    if missing:
        grids = _one_row(df, [grid_of(F.when(s.inside(v), v)) for s in missing for v in [F.col(s.column)]])
        filled = {s: Span(s.column, s.above, s.below, s.before, s.rows, tuple(g)) for s, g in zip(missing, grids)}
        spans = [filled.get(s, s) for s in spans]
    return spans


def _narrow(df: DataFrame, open_ranks: dict[Span, list[int]], found: dict) -> dict[Span, list[int]]:
    """One pass of exact counts at the ends of every rank's bracket."""
    probes = sorted({(s.column, end) for s, ranks in open_ranks.items() for r in ranks for end in s.bracket(r)})
    counts = _one_row(df, [F.count_if(test) for c, end in probes for v in [F.col(c)] for test in (v < end, v <= end)])
    less = {p: counts[2 * i] for i, p in enumerate(probes)}
    upto = {p: counts[2 * i + 1] for i, p in enumerate(probes)}
    parts: dict[Span, list[int]] = {}
    for span, ranks in open_ranks.items():
        for rank in ranks:
            low, high = span.bracket(rank)
            at = (span.column, low), (span.column, high)
            if less[at[0]] <= rank < upto[at[0]]:
                found[span.column, rank] = low
            elif less[at[1]] <= rank < upto[at[1]]:
                found[span.column, rank] = high
            else:
                if rank < less[at[0]]:
                    part = Span(span.column, span.above, low, span.before, less[at[0]] - span.before, None)
                elif rank < less[at[1]]:
                    part = Span(span.column, low, high, upto[at[0]], less[at[1]] - upto[at[0]], None)
                else:
                    part = Span(span.column, high, span.below, upto[at[1]], span.before + span.rows - upto[at[1]], None)
                parts.setdefault(part, []).append(rank)
    return parts


def _put_in_order(df: DataFrame, open_ranks: dict[Span, list[int]], found: dict) -> None:
    """Ranks inside spans of few rows: (value, count) pairs and running counts."""
    spans = list(open_ranks)
    entries = F.array(*[F.when(s.inside(v), F.struct(F.lit(i).alias("span"), v.alias("value")))
                        for i, s in enumerate(spans) for v in [F.col(s.column)]])
    somewhere = reduce(lambda a, b: a | b, [F.coalesce(s.inside(F.col(s.column)), F.lit(False)) for s in spans])
    pairs = (df.where(somewhere).select(F.inline(F.filter(entries, lambda e: e.isNotNull())))
             .groupBy("span", "value").agg(F.count("*").alias("n")))
    running = Window.partitionBy("span").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    pairs = pairs.withColumn("upto", F.sum("n").over(running))
    asked = [(i, s, r) for i, s in enumerate(spans) for r in open_ranks[s]]
    row = _one_row(pairs, [F.min(F.when((F.col("span") == i) & (F.col("upto") > r - s.before), F.col("value"))) for i, s, r in asked])
    for value, (_, s, r) in zip(row, asked):
        found[s.column, r] = value


def order_statistics(df: DataFrame, wanted: dict[str, set[int]], known: dict[str, Span], sort_rows: int = SORT_ROWS
                     ) -> dict[tuple[str, int], float]:
    """The values at the wanted ranks (from 0, in ascending order, NULLs left
    out) of each column; ``known`` has a column's span of all rows.

    A rank at or beyond a span's rows is NaN: the rows that are NaN come last.
    """
    # One projection for all passes: doubles, without NaN.
    df = df.select(*[_finite_order(as_double(c)).alias(c) for c in wanted])
    found: dict[tuple[str, int], float] = {}
    open_ranks: dict[Span, list[int]] = {}
    for column, ranks in wanted.items():
        for rank in sorted(ranks):
            if rank >= known[column].rows:
                found[column, rank] = math.nan
            else:
                open_ranks.setdefault(known[column], []).append(rank)
    while open_ranks and sum(s.rows for s in open_ranks) > sort_rows:
        gridded = _with_grids(df, list(open_ranks))
        open_ranks = _narrow(df, dict(zip(gridded, open_ranks.values())), found)
    if open_ranks:
        _put_in_order(df, open_ranks, found)
    return found


# -- stored sketches -------------------------------------------------------------

def column_sketches(df: DataFrame, cols: dict[str, str]) -> DataFrame:
    """(column_name, count, min, max, sketch) for every named numeric column:
    one pass, one row per column, to be stored with a load.  NULL and NaN are
    left out; a column without values has a NULL sketch."""
    made = df.agg(*[x.alias(f"{what}_{i}") for i, c in enumerate(cols.values()) for v in [_finite_order(as_double(c))]
                    for what, x in (("n", F.count(v)), ("lo", F.min(v)), ("hi", F.max(v)),
                                    ("s", F.kll_sketch_agg_double(v, F.lit(SKETCH_K))))])
    return made.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("column_name"), F.col(f"n_{i}").alias("count"), F.col(f"lo_{i}").alias("min"), F.col(f"hi_{i}").alias("max"),
                 F.when(F.col(f"n_{i}") > 0, F.col(f"s_{i}")).alias("sketch")) for i, name in enumerate(cols)])))


def merge_sketches(stored: DataFrame) -> DataFrame:
    """One row per column from the sketches of any number of loads."""
    held = stored.where("sketch IS NOT NULL")
    return held.groupBy("column_name").agg(F.sum("count").alias("count"), F.min("min").alias("min"), F.max("max").alias("max"),
                                           F.kll_merge_agg_double("sketch", F.lit(SKETCH_K)).alias("sketch"))


def sketch_quantiles(merged: DataFrame, quantiles: list[tuple[str, float]]) -> DataFrame:
    """column_name, count, min, the named approximate quantiles, max."""
    return merged.select("column_name", "count", "min",
                         *[F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias(label) for label, p in quantiles], "max")


def rank_shares(df: DataFrame, cols: dict[str, str], values: dict[tuple[str, str], float]) -> dict[tuple[str, str], tuple[int, int, int]]:
    """Rows below, rows up to, and all rows of given values' columns: one pass of exact counts.

    ``values`` is keyed by (reported column name, label)."""
    tests = [x for (name, _), value in values.items() for v in [_finite_order(as_double(cols[name]))]
             for x in (F.count_if(v < value), F.count_if(v <= value), F.count(v))]
    row = _one_row(df, tests)
    return {key: tuple(row[3 * i:3 * i + 3]) for i, key in enumerate(values)}
