"""Exact order statistics by sketch brackets, and stored sketches."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import profile, quantiles
from ledgerline.operators.keys import SCAN_BLOCK, prefix_sums
from ledgerline.operators.quantiles import Span, order_statistics


def frame(spark, **columns):
    names = list(columns)
    size = max(map(len, columns.values()))
    rows = [tuple(float(c[i]) if i < len(c) and c[i] is not None else None for c in columns.values()) for i in range(size)]
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(5)


def shapes():
    rng = np.random.default_rng(11)
    return {
        "spread": rng.normal(0, 100, 6_000).tolist(),
        "hot": [7.0] * 3_000 + rng.uniform(0, 14, 3_000).tolist(),
        "two": [1.0] * 3_001 + [2.0] * 2_999,
        "constant": [3.5] * 500,
        "heavy": (rng.pareto(0.5, 5_000) * 1e3).tolist(),
        "some": [None, 4.0, None, 1.0, 2.0] * 400,
        "infinite": [math.inf] * 900 + [-math.inf] * 900 + rng.normal(size=900).tolist(),
        "one": [5.0],
    }


@pytest.mark.parametrize("sort_rows", [10 ** 6, 300, 0])
def test_order_statistics_are_exact(spark, sort_rows):
    data = shapes()
    df = frame(spark, **data).cache()
    held = {c: sorted(v for v in values if v is not None) for c, values in data.items()}
    wanted = {c: {0, len(v) // 4, len(v) // 2, min(len(v) // 2 + 1, len(v) - 1), 3 * len(v) // 4, len(v) - 1} for c, v in held.items()}
    known = {c: Span(c, None, None, 0, len(v), None) for c, v in held.items()}
    found = order_statistics(df, wanted, known, sort_rows)
    assert found == {(c, r): held[c][r] for c, ranks in wanted.items() for r in ranks}
    df.unpersist()


def test_a_wrong_grid_only_costs_passes(spark):
    df = frame(spark, v=list(range(2_000)))
    wrong = Span("v", None, None, 0, 2_000, tuple(500.0 + i / 10 for i in range(quantiles.GRID + 1)))
    found = order_statistics(df, {"v": {0, 505, 1_900}}, {"v": wrong}, sort_rows=50)
    assert found == {("v", 0): 0.0, ("v", 505): 505.0, ("v", 1_900): 1_900.0}


def test_nan_rows_come_last(spark):
    df = frame(spark, v=[math.nan] * 30 + [1.0, 2.0, 3.0])
    found = order_statistics(df, {"v": {0, 2, 3, 32}}, {"v": Span("v", None, None, 0, 3, None)}, sort_rows=0)
    assert found["v", 0] == 1.0 and found["v", 2] == 3.0 and math.isnan(found["v", 3]) and math.isnan(found["v", 32])


@pytest.mark.parametrize("sort_rows", [10 ** 6, 100])
def test_describe_equals_numpy(spark, sort_rows):
    data = {k: v for k, v in shapes().items() if k not in ("infinite", "heavy")}
    df = frame(spark, **data).cache()
    got = {r["column_name"]: r for r in profile.describe_numeric(df, {f"the {c}": c for c in data}, sort_rows=sort_rows).collect()}
    for c, values in data.items():
        held = np.array([v for v in values if v is not None])
        r = got[f"the {c}"]
        assert r["count"] == len(held) and r["min"] == held.min() and r["max"] == held.max()
        assert [r["p25"], r["p50"], r["p75"]] == pytest.approx(np.quantile(held, [.25, .5, .75]).tolist(), abs=1e-6)
        assert r["mean"] == pytest.approx(held.mean(), abs=1e-6)
        assert r["std"] == (None if len(held) == 1 else pytest.approx(held.std(ddof=1), abs=1e-6))
    df.unpersist()


def test_describe_without_values(spark):
    df = spark.createDataFrame([(None, 1.0)], "a double, b double")
    assert [r["column_name"] for r in profile.describe_numeric(df, {"a": "a", "b": "b"}).collect()] == ["b"]
    assert profile.describe_numeric(df.limit(0), {"a": "a"}).collect() == []


def test_describe_neither_explodes_nor_partitions_the_column(spark, monkeypatch):
    """Every pass over the rows is one aggregate that sends one row a task."""
    plans = []
    whole = type(spark.range(0)).agg
    monkeypatch.setattr(type(spark.range(0)), "agg", lambda self, *a: plans.append(out := whole(self, *a)) or out)
    df = frame(spark, v=np.random.default_rng(2).normal(size=5_000).tolist())
    profile.describe_numeric(df, {"v": "v"}, sort_rows=1_000)
    over_rows = [p._jdf.queryExecution().optimizedPlan().toString() for p in plans]
    assert len(over_rows) >= 4 and not any("RepartitionByExpression" in p and "rangepartitioning" in p for p in over_rows)
    assert sum("Generate" in p for p in over_rows) == 1  # the last, of the rows inside the brackets
    assert any("kll_sketch_agg_double" in p for p in over_rows)


def test_sketches_of_loads_merge(spark, tmp_path):
    rng = random.Random(4)
    loads = [[rng.gauss(10 * k, 5) for _ in range(4_000)] for k in range(3)]
    for k, values in enumerate(loads):
        df = frame(spark, v=values, w=[None] * 10 if k == 1 else [float(k)] * 10)
        quantiles.column_sketches(df, {"V": "v", "W": "w"}).write.mode("append").parquet(f"{tmp_path}/sketches")
    stored = spark.read.parquet(f"{tmp_path}/sketches")
    assert stored.count() == 6
    names = [("p10", .1), ("p50", .5), ("p99", .99)]
    got = {r["column_name"]: r for r in quantiles.sketch_quantiles(quantiles.merge_sketches(stored), names).collect()}
    held = np.sort(np.concatenate(loads))
    assert got["V"]["count"] == 12_000 and got["V"]["min"] == held[0] and got["V"]["max"] == held[-1]
    for label, p in names:
        rank = np.searchsorted(held, got["V"][label]) / len(held)
        assert abs(rank - p) <= quantiles.RANK_ERROR
    assert got["W"]["count"] == 20 and got["W"]["min"] == 0.0 and got["W"]["max"] == 2.0
    shares = quantiles.rank_shares(frame(spark, v=held.tolist()), {"V": "v"}, {("V", "p50"): got["V"]["p50"]})
    below, upto, rows = shares["V", "p50"]
    assert rows == 12_000 and below <= upto and abs(below / rows - .5) <= quantiles.RANK_ERROR


def test_prefix_sums_of_twenty_thousand_partitions(spark):
    n = 20_000
    weight = [(i * 7919) % 13 for i in range(n)]
    counts = spark.range(n).select(F.col("id").cast("int").alias("pid"), ((F.col("id") * 7919) % 13).alias("n"))
    got = {r.pid: r._off for r in prefix_sums(counts.where("n > 0"), "pid", "n").collect()}
    before = np.concatenate([[0], np.cumsum(weight)])
    assert got == {i: before[i] for i in range(n) if weight[i]}
    assert n > 4 * SCAN_BLOCK
    grouped = spark.range(n).select(F.expr("cast(id div 2 as int)").alias("pid"), F.expr("if(id % 2 = 0, 'a', 'b')").alias("g"), F.lit(2).alias("n"))
    rows = prefix_sums(grouped, "pid", "n", "g").collect()
    assert len(rows) == n and all(r._off == 2 * r.pid for r in rows)


def test_keys_never_pass_the_driver():
    import inspect

    from ledgerline.operators import keys

    for code in (inspect.getsource(keys), inspect.getsource(profile.running_counts)):
        assert "collect(" not in code and "createDataFrame" not in code
