"""Distributed key assignment and exact profiles against brute force."""

import random
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import profile
from ledgerline.operators.keys import dense_key_large, dense_key_small


def test_dense_key_large_matches_sorted_order(spark):
    rng = random.Random(7)
    ids = list({f"K{rng.randrange(10**6):06d}-{rng.randrange(50)}" for _ in range(3000)})
    df = spark.createDataFrame([(i, len(i)) for i in ids], "invoice_id string, n int")
    keyed = dense_key_large(df, "invoice_id", "k", size=0, partitions=7, start=100)
    got = {r["invoice_id"]: r["k"] for r in keyed.collect()}
    want = {v: 101 + i for i, v in enumerate(sorted(ids))}
    assert got == want


def test_dense_key_small_orders_nulls_first(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "x string")
    assert [tuple(r) for r in dense_key_small(df, ["x"], "k").orderBy("k").collect()] == [
        (1, None), (2, "a"), (3, "b")]


def test_describe_matches_pandas(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"a": rng.integers(0, 50, 997).astype(float) / 4,
                        "b": np.round(rng.normal(100, 20, 997), 2)})
    pdf.loc[::13, "b"] = None
    df = spark.createDataFrame(pdf)
    got = {r["column_name"]: r for r in profile.describe_numeric(df, {"a": "a", "b": "b"}).collect()}
    want = pdf.describe()
    for c in ["a", "b"]:
        assert got[c]["count"] == want.loc["count", c]
        for stat, name in [("mean", "mean"), ("std", "std"), ("min", "min"), ("25%", "p25"),
                           ("50%", "p50"), ("75%", "p75"), ("max", "max")]:
            assert got[c][name] == pytest.approx(want.loc[stat, c], abs=1e-6)


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(5)
    vals = np.round(rng.uniform(4, 10, 500), 1)
    df = spark.createDataFrame([(float(v),) for v in vals], "rating double")
    got = profile.histogram(df, "rating", 20).orderBy("bin").collect()
    counts, edges = np.histogram(vals, bins=20)
    assert [r["count"] for r in got] == list(counts)
    assert [r["lower_edge"] for r in got] == pytest.approx(list(edges[:-1]))


def test_value_counts_drop_nulls_and_sort(spark):
    df = spark.createDataFrame([("A",), ("B",), ("A",), (None,)], "branch string")
    assert [tuple(r) for r in profile.value_counts(df, "branch").collect()] == [("A", 2), ("B", 1)]


def test_column_profile(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 2.0)], "s string, d double")
    assert [tuple(r) for r in profile.column_profile(df).collect()] == [("s", "string", 1), ("d", "double", 2)]


def test_pivot(spark):
    df = spark.createDataFrame([("x", "A", 1.0), ("x", "B", 2.0), ("y", "A", 3.0)], "p string, b string, v double")
    out = {r["p"]: (r["A"], r["B"], r["C"]) for r in
           profile.pivot_sum(df, "p", "b", ["A", "B", "C"], F.sum("v")).collect()}
    assert out == {"x": (1.0, 2.0, None), "y": (3.0, None, None)}


def test_range_partitions_grow_with_written_size(spark, monkeypatch):
    from ledgerline.operators import keys
    from ledgerline.session import cut_table

    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    written, size = cut_table(spark.range(50000).selectExpr("id", "uuid() AS u"))
    assert keys.range_partitions(written, size) == base            # small table: the shuffle partitions
    assert keys.range_partitions(written, 1 << 60) == 1 << 33      # no cap
    monkeypatch.setattr(keys, "RANGE_PARTITION_BYTES", 10_000)
    assert keys.range_partitions(written, size) > base             # large relative to the target


def test_describe_is_exact_for_small_and_huge_values(spark):
    df = spark.createDataFrame([(4.9e-7, 1e30), (4.9e-7, 1.0), (4.9e-7, None)], "a double, b double")
    got = {r["column_name"]: r for r in profile.describe_numeric(df, {"a": "a", "b": "b"}, places=9).collect()}
    assert got["a"]["mean"] == 4.9e-7 and got["a"]["std"] == 0.0
    assert got["b"]["mean"] == 5e29 and got["b"]["max"] == 1e30


def test_null_counts_shuffle_no_rows(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 2.0), (None, None)], "s string, d double")
    counts = profile.null_counts(df, {"s": "S"})
    assert [tuple(r) for r in counts.collect()] == [("S", 2), ("d", 1)]
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan


def test_describe_counts_beyond_eleven_digits(spark):
    from ledgerline.session import cut_table

    hot, rest = 3 * 10 ** 13 + 7, 2 * 10 ** 11
    rows = [("a", 0.1, hot), ("a", 12.5, rest), ("b", -0.3, rest + 1), ("b", 0.3, rest + 1), ("b", 6.0, 2), ("c", 1e30, rest), ("c", 9e15, hot), ("d", 0.25, 3)]
    counted, size = cut_table(spark.createDataFrame(rows, "column_name string, value double, _w long"))
    got = {r["column_name"]: r for r in profile.describe_counted(counted, size, places=9).collect()}
    assert {c: r["count"] for c, r in got.items()} == {"a": hot + rest, "b": 2 * rest + 4, "c": hot + rest, "d": 3}
    assert got["a"]["mean"] == float(round((Fraction(1, 10) * hot + Fraction(25, 2) * rest) / (hot + rest), 9))
    assert (got["a"]["min"], got["a"]["p25"], got["a"]["p75"], got["a"]["max"]) == (0.1, 0.1, 0.1, 12.5)
    assert got["b"]["mean"] == 0 and (got["b"]["p25"], got["b"]["p75"]) == (-0.3, 0.3)
    assert got["c"]["mean"] == pytest.approx((1e30 * rest + 9e15 * hot) / (hot + rest), rel=1e-9)
    assert got["d"]["mean"] == 0.25 and got["d"]["std"] == 0
    # The plain cast, by the same count.
    assert spark.sql(f"SELECT try_cast({rest}L AS decimal(11,0))").first()[0] is None
