"""Keyed upserts (MERGE semantics) on plain Parquet tables.

``target`` rows whose business key appears in ``source`` take the source
values (a NULL in the source overwrites) but keep their surrogate key;
source rows with a new key are inserted with fresh surrogate keys that
continue after the largest existing one, in business-key order; target rows
absent from the source stay as they are.  A NULL business key never matches,
as in SQL ``MERGE``.  A business key repeated in the source is an error.

Matched rows come from a left join of the target with the source, new rows
from an anti join of the source with the target's keys; the target is never
written on the way.  Applying the same source twice gives the same table as
applying it once.

With ``join="shuffle_hash"`` the source is the hashed side of both joins, so a
target bucketed by the key streams past it: no target row is shuffled or
sorted, and a row without a partner costs one probe.  The matched keys (no more
than the source has rows) then decide which source rows are new.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.keys import dense_key_large, dense_key_small


def assert_unique_source(source: DataFrame, keys: list[str]) -> None:
    """Raise if a business key without any NULL occurs twice."""
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    dup = (source.filter(whole).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
           .filter(F.col("_n") > 1).limit(1).collect())
    if dup:
        raise ValueError(f"Source repeats business key {[dup[0][k] for k in keys]}")


def upsert(target: DataFrame, source: DataFrame, keys: list[str], surrogate: str,
           size: int | None = None, partitions: int | None = None, check_unique: bool = True,
           join: str | None = None) -> DataFrame:
    """Merge ``source`` into ``target`` on ``keys``: both :func:`upsert_parts`."""
    kept, new = upsert_parts(target, source, keys, surrogate, size, partitions, check_unique, join)
    return kept.unionByName(new)


def upsert_parts(target: DataFrame, source: DataFrame, keys: list[str], surrogate: str,
                 size: int | None = None, partitions: int | None = None, check_unique: bool = True,
                 join: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The target's rows after the merge and the inserted rows; see the module note.

    ``source`` has every target column except ``surrogate``.  ``size`` (bytes
    of the written source) selects the distributed key assignment for
    inserted rows, ordered by the first key; without it they are numbered in
    one task (dimensions whose members come from fixed lists).
    ``check_unique=False`` skips the source check for a source that is
    unique by construction (deduplicated rows).  ``join`` is the join hint
    of the source; without it Spark chooses.
    """
    if check_unique:
        assert_unique_source(source, keys)
    columns = target.columns
    values = [c for c in columns if c != surrogate and c not in keys]
    s = source.select(*[F.col(c).alias(f"s_{c}") for c in keys + values], F.lit(True).alias("_in_s"))
    s = s.hint(join) if join else s
    matched = target.join(s, [F.col(k) == F.col(f"s_{k}") for k in keys], "left")
    in_s = F.col("_in_s").isNotNull()
    kept = matched.select(*[F.when(in_s, F.col(f"s_{c}")).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
                            for c in columns])
    known = target.select(*[F.col(k).alias(f"t_{k}") for k in keys])
    if join == "shuffle_hash":
        ids = source.select(*[F.col(k).alias(f"s_{k}") for k in keys]).hint(join)
        known = known.join(ids, [F.col(f"t_{k}") == F.col(f"s_{k}") for k in keys], "left_semi")
    fresh = source.join(known, [F.col(k) == F.col(f"t_{k}") for k in keys], "left_anti").select(*keys, *values)
    start = target.agg(F.coalesce(F.max(surrogate), F.lit(0)).cast("long").alias("m")).first()["m"]
    if size is not None:
        numbered = dense_key_large(fresh, keys[0], surrogate, size, partitions, start=start)
    else:
        numbered = dense_key_small(fresh, keys, surrogate).withColumn(
            surrogate, F.col(surrogate) + F.lit(start))
    return kept, numbered.select(*columns)


def insert_missing(target: DataFrame, source: DataFrame, keys: list[str], surrogate: str,
                   size: int | None = None) -> DataFrame:
    """Insert-if-absent for a dimension without value columns."""
    return upsert(target, source.select(*keys).distinct(), keys, surrogate, size, check_unique=False)
