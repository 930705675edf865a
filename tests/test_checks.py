"""Constraint violations, value assertions, lineage cuts."""

import os

import pytest

from pyspark.sql import functions as F

from ledgerline.operators import checks
from ledgerline.rules import RETAIL_RULES
from ledgerline.session import cut_lineage, cut_scope, cut_table, ensure_checkpoint_dir


def test_constraint_violations_are_counted(spark):
    dim_branch = spark.createDataFrame([(1, "A", "X"), (1, "A", "X"), (None, "B", None), (3, "B", None)],
                                       "branch_key long, branch_code string, city string")
    dim_product = spark.createDataFrame([(1, "p")], "product_key long, product_line string")
    fact = spark.createDataFrame([(1, "i1", 1, 1), (2, "i1", 9, None), (None, "i2", 1, 1)],
                                 "sales_key long, invoice_id string, branch_key long, product_key long")
    got = {(r["table_name"], r["check_name"]): r["violations"]
           for r in checks.constraint_report(dim_branch, dim_product, fact).collect()}
    assert got[("dim_branch", "pk_not_null")] == 1
    assert got[("dim_branch", "pk_unique")] == 1
    assert got[("dim_branch", "natural_key_unique")] == 2       # (A, X) twice, (B, NULL) twice
    assert got[("dim_product", "pk_unique")] == 0
    assert got[("fact_sales", "pk_not_null")] == 1
    assert got[("fact_sales", "natural_key_unique")] == 1
    assert got[("fact_sales", "fk_branch_key")] == 1           # key 9 is absent
    assert got[("fact_sales", "fk_product_key")] == 1          # NULL key
    dups = checks.duplicate_keys(dim_branch, ["branch_key"]).collect()
    assert [(r["branch_key"], r["rows"]) for r in dups] == [(1, 2)]


def test_constraint_report_counts_without_expanding_rows(spark):
    dim_branch = spark.createDataFrame([(1, "A", "X")], "branch_key long, branch_code string, city string")
    dim_product = spark.createDataFrame([(1, "p")], "product_key long, product_line string")
    fact = spark.createDataFrame([(1, "i1", 1, 1)], "sales_key long, invoice_id string, branch_key long, product_key long")
    plan = checks.constraint_report(dim_branch, dim_product, fact)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_fact_assertions_find_every_bad_value(spark):
    good = ("i1", "2019-01-05", 1, 1, "Member", "Male", "Cash", 10.0, 2, 21.0, 7.0)
    bad = (None, None, None, None, "VIP", None, "Cheque", 0.0, 0, -1.0, 11.0)
    fact = spark.createDataFrame([good, bad], "invoice_id string, sale_date string, branch_key long, product_key long, customer_type string, "
                                 "gender string, payment_method string, unit_price double, quantity long, total_amount double, rating double")
    branches = spark.createDataFrame([("A", "Yangon"), ("D", None)], "branch_code string, city string")
    products = spark.createDataFrame([("p",), (None,)], "product_line string")
    got = checks.fact_assertions(fact, branches, products, RETAIL_RULES).collect()
    assert len(got) == 14 and {r["violations"] for r in got} == {1}


def test_written_tables_are_released(spark):
    kept = cut_table(spark.range(10))
    with cut_scope(spark) as made:
        cut = cut_table(spark.range(10))
        assert cut.bytes > 0 and len(made) == 1
        files = [f.removeprefix("file://") for f in cut.table.inputFiles()]
        assert files and all(os.path.exists(f) for f in files)
    assert not any(os.path.exists(f) for f in files)
    assert kept.table.count() == 10


def test_cut_lineage_writes_under_checkpoint_dir(spark):
    folder = ensure_checkpoint_dir(spark)
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    cut = cut_lineage(df)
    assert sorted(r["x"] for r in cut.collect()) == list(range(0, 20, 2))

    def path(uri):
        return uri.split(":", 1)[-1].lstrip("/")

    assert all(path(f).startswith(path(folder)) for f in cut.inputFiles())


def keyed_fact(spark, keys, parts=4):
    """A fact whose rows lie in the given order, ``parts`` tasks of neighbours."""
    rows = [(k, f"i{n}", 1 + n % 3, 1 + n % 2) for n, k in enumerate(keys)]
    return spark.createDataFrame(spark.sparkContext.parallelize(rows, parts), "sales_key long, invoice_id string, branch_key long, product_key long")


def dims(spark):
    return (spark.createDataFrame([(i, f"b{i}", "x") for i in (1, 2, 3)], "branch_key long, branch_code string, city string"),
            spark.createDataFrame([(i, f"p{i}") for i in (1, 2)], "product_key long, product_line string"))


@pytest.mark.parametrize("name,keys,proved", [
    ("dense", list(range(1, 401)), True),
    ("shuffled tasks", [*range(301, 401), *range(1, 101), *range(201, 301), *range(101, 201)], True),
    ("gap between runs", [*range(1, 101), *range(500, 800)], True),
    ("repeated run", [*range(1, 101), *range(1, 101), *range(101, 201), *range(101, 201)], True),
    ("overlap", [*range(1, 101), *range(51, 151), *range(140, 340)], True),
    ("one key twice", [*range(1, 51), 50, *range(51, 400)], True),
    ("one key for all", [7] * 400, True),
    ("hole", [1, 2, 900, 4, 5, 900, 7, 8, 9, 10] * 40, False),
    ("NULL keys", [*range(1, 200), None, *range(201, 399), None, None], True),
    ("empty", [], True),
])
def test_runs_count_repeats_exactly(spark, name, keys, proved):
    fact = keyed_fact(spark, keys)
    held = [k for k in keys if k is not None]
    cells = cut_lineage(checks.key_runs(fact, "sales_key", ["branch_key", "product_key"]))
    repeats = checks.repeats_of_runs(cells)
    assert (repeats is not None) == proved
    assert repeats is None or repeats == len(held) - len(set(held))
    got = {tuple(r)[:2]: r["violations"] for r in checks.constraint_report(*dims(spark), fact, in_key_order=True).collect()}
    plain = {tuple(r)[:2]: r["violations"] for r in checks.constraint_report(*dims(spark), fact).collect()}
    assert got == plain and got["fact_sales", "pk_unique"] == len(held) - len(set(held))
    assert got["fact_sales", "pk_not_null"] == len(keys) - len(held)


def test_many_runs_fall_back(spark, monkeypatch):
    monkeypatch.setattr(checks, "MAX_RUNS", 3)
    fact = keyed_fact(spark, [*range(1, 101), *range(51, 151), *range(200, 400)])
    assert checks.repeats_of_runs(cut_lineage(checks.key_runs(fact, "sales_key", []))) is None
    got = {tuple(r)[:2]: r["violations"] for r in checks.constraint_report(*dims(spark), fact, in_key_order=True).collect()}
    assert got["fact_sales", "pk_unique"] == 50


def test_no_exchange_of_the_keys_in_order(spark):
    """A fact as the key assignment leaves it has about one run a task."""
    from ledgerline.operators.keys import dense_key_large

    ids = spark.range(20_000).selectExpr("concat('I', id) AS invoice_id", "1L AS branch_key", "1L AS product_key")
    fact = dense_key_large(ids, "invoice_id", "sales_key", size=0, partitions=12)
    cells = checks.key_runs(fact, "sales_key", ["branch_key", "product_key"])
    assert cells.count() <= 24
    text = cells._jdf.queryExecution().executedPlan().toString()
    assert all("sales_key" not in line for line in text.splitlines() if "Exchange hashpartitioning" in line)


def test_expected_counts_and_required_columns(spark):
    counts = spark.createDataFrame([("a", 5), ("b", 0), ("c", 9)], "table_name string, row_count long")
    got = checks.expected_counts(counts, {"a": (1, 5), "b": (1, None), "c": (None, 8), "d": (None, None)})
    assert {r["table_name"]: (r["row_count"], r["as_expected"]) for r in got.collect()} == {
        "a": (5, True), "b": (0, False), "c": (9, False), "d": (None, False)}
    raw = spark.createDataFrame([("x", None), ("y", "1"), (None, "2")], "` Total ` string, other string")
    assert [tuple(r) for r in checks.required_columns(raw, ["Total", "Rating"]).collect()] == [("Total", True, 2), ("Rating", False, None)]
    assert [tuple(r) for r in checks.required_columns(raw.limit(0), ["Total"]).collect()] == [("Total", True, 0)]
